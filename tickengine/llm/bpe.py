"""BPE encoding and decoding with forced boundaries.

``Codec`` reads a vocabulary file of the ``tokenizers`` library (BPE with word ends) and
encodes as that library does: NFC, lower case letter by letter, pieces by pattern, then
merges inside each piece. A pair of bytes that stands next to each other in no vocabulary
token can never be bridged by a merge, since every merge gives a vocabulary token: such a
pair is a certain cut. A piece is cut there, the fragments are encoded independently, and
their ids are concatenated. Pairs are kept apart by whether the second byte ends a word,
as the end is part of its symbol. The library's own encoder is not used.

Defined results: NULL and empty texts have no tokens. Strings of special tokens are found
in the raw text first and become their ids, as the library does. Rows are encoded one by
one: repeated rows, NULL ids and an empty table need no care. Columns besides id and text
are not read (``encode_stage`` in the pipeline keeps them). Texts are taken whole.

One pass over the scan's partitions, no shuffle; a task holds one Arrow batch and two
caches of bounded size.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, table

WORD_END = "</w>"
# Pieces and fragments that a worker remembers, about 25 MB each time.
CACHE = 100_000
# Fragments of more symbols are merged with a heap, in n log n steps; shorter ones by looking
# for the least rank each time, which is faster there and gives the same.
LONG = 200
# White space as the vocabulary's pattern means it.
_SPACE = r"\x09-\x0d\x20\x85\xa0  -     　"
# The vocabulary's own pattern for pieces: a fixed value, with white space written out.
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Cache(dict):
    """A dict that computes what it misses; full, it keeps its entries for one more turn.

    Keys of more than ``LONG`` letters or bytes are not kept, so its memory is bounded.
    """

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key if isinstance(key, str) else key[0]) > LONG:
            return value
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        vocab: dict[str, int] = model["vocab"]
        self.letters = byte_letters()
        self.strings = {i: s for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        del described
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # Symbols are ids from here on.
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(merges)}
        self.merged = [vocab[a + b] for a, b in merges]
        self.inner = [vocab[c] for c in self.letters]
        self.final = [vocab[c + WORD_END] for c in self.letters]
        self.joined = self.find_pairs(vocab)
        self.pattern = regex.compile(PIECES)
        self.beyond = regex.compile("[^\x00-\u0557]")
        self.path = path
        self.rules = None
        self.stops = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        # Ids are kept as the bytes that they have in the result, four each.
        self.fragments = Cache(lambda key: array("I", self.merge(*key)).tobytes(), CACHE // 2)
        self.pieces = Cache(self.encode_piece, CACHE)

    def find_pairs(self, vocab: dict[str, int]) -> tuple[set[bytes], set[bytes]]:
        """Byte pairs inside tokens: before the word's end, and with its last byte."""
        of = {c: i for i, c in enumerate(self.letters)}
        inside: set[bytes] = set()
        at_end: set[bytes] = set()
        for token in vocab:
            ends = token.endswith(WORD_END) and token != WORD_END
            raw = bytes(of[c] for c in (token[: -len(WORD_END)] if ends else token))
            pairs = [raw[i : i + 2] for i in range(len(raw) - 1)]
            if ends and pairs:
                at_end.add(pairs.pop())
            inside.update(pairs)
        return inside, at_end

    def cut(self, raw: bytes) -> list[tuple[bytes, bool]]:
        """The fragments of a piece between certain cuts; true for the one with its end."""
        inside, at_end = self.joined
        last = len(raw) - 2
        made, begin = [], 0
        for i in range(len(raw) - 1):
            if raw[i : i + 2] not in (at_end if i == last else inside):
                made.append((raw[begin : i + 1], False))
                begin = i + 1
        made.append((raw[begin:], True))
        return made

    def merge(self, raw: bytes, ends: bool) -> list[int]:
        """The merges of one fragment, lowest rank first, from left to right."""
        ids = [self.inner[b] for b in raw]
        if ends:
            ids[-1] = self.final[raw[-1]]
        if len(ids) > LONG:
            return self.merge_long(ids)
        none, rank, merged = len(self.merged), self.ranks.get, self.merged
        ranks = [rank(pair, none) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i] = merged[best]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), none)
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same for many symbols: a heap of pairs by rank and place over a linked list."""
        n, rank, merged = len(ids), self.ranks.get, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, pair in enumerate(zip(ids, ids[1:])) if (r := rank(pair)) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            # A pair that was merged, or whose symbols changed, is not there any more.
            if ids[i] < 0 or j >= n or rank((ids[i], ids[j])) != r:
                continue
            ids[i], ids[j] = merged[r], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank((ids[i], ids[k]))) is not None:
                    heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank((ids[h], ids[i]))) is not None:
                heappush(heap, (r, h))
        return [x for x in ids if x >= 0]

    def encode_piece(self, piece: str) -> bytes:
        return b"".join(map(self.fragments.__getitem__, self.cut(piece.encode())))

    def split(self, text: str) -> list[str]:
        """The pieces of a text without special tokens."""
        if text.isascii():
            return self.pattern.findall(text.lower())
        if self.beyond.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            return self.split_by_file(text)
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.pattern.findall(text.lower())

    def split_by_file(self, text: str) -> list[str]:
        """For letters newer than Python's Unicode tables: the file's own two rules."""
        if self.rules is None:
            from tokenizers import Tokenizer

            self.rules = Tokenizer.from_file(self.path)
        plain = self.rules.normalizer.normalize_str(text)
        of = {c: i for i, c in enumerate(self.letters)}
        found = self.rules.pre_tokenizer.pre_tokenize_str(plain)
        return [bytes(of[c] for c in piece).decode() for piece, _ in found]

    def ordinary(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode(self, text: str) -> np.ndarray:
        made, at = [], 0
        for stop in self.stops.finditer(text):
            made.append(self.ordinary(text[at : stop.start()]))
            made.append(array("I", [self.special[stop.group()]]).tobytes())
            at = stop.end()
        made.append(self.ordinary(text[at:] if at else text))
        return np.frombuffer(b"".join(made), dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        """Token strings with a blank between, as the file names no decoder."""
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, made once in each Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``; with ``with_ids`` also ``ids``."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        own = codec(path)
        for batch in batches:
            texts = batch.column(1)
            count, of_ids, of_text, kept = [], [], [], []
            for value in texts:
                ids = own.encode(value.as_py() or "")
                count.append(len(ids))
                of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
                if with_ids:
                    kept.append(pa.array(ids.astype(np.int32)))
            columns = [
                batch.column(0), pa.array(count, pa.int64()),
                pa.array(of_ids, pa.string()), pa.array(of_text, pa.string()),
            ]
            if with_ids:
                ends = np.cumsum([0, *map(len, kept)]).astype(np.int32)
                flat = pa.concat_arrays(kept) if kept else pa.array([], pa.int32())
                columns.append(pa.ListArray.from_arrays(pa.array(ends), flat))
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names)

    if with_ids:
        schema += ", ids array<int>"
    return mapped(docs.select(F.col(id_col), F.col(text_col)), run, schema)


def vocabulary() -> str:
    """The default vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), vocabulary())
