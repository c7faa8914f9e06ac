"""Alignment of two tokenizers by pointer jumping over overlapping tokens.

1. ``align`` encodes each text twice, with a byte-level vocabulary (A) and with a piece model
   (B), and lays both token sequences over the same bytes. Every token points to its
   farthest-right overlapping token: the one of the other side that holds its last byte, or,
   where both end together, the B token. Successors of all tokens of a chunk of texts are
   doubled at once until nothing changes; each token then points to the terminal token of its
   connected component, and components are the groups between common ends.
2. A link is a pair of tokens that end together. Each chunk of texts (one Arrow batch) writes
   its distinct id pairs once with their number, and its texts name pairs by their place in
   that list. So the corpus-wide count sees a row per pair and chunk, whatever the number
   of links.
3. Pairs are summed over all chunks, and their highest count per B id is marked. Counts go
   back to the chunks that hold the pair by a join (rows of a frequent pair are one per chunk,
   and Spark may split them); texts meet the counts of their chunk in a cogroup of bounded size.

Defined results: NULL and empty texts, and texts whose tokens do not spell them with a
leading space byte by byte (the piece model normalises some characters), have no tokens:
all numbers are 0 and the digest is ''. Strings of special tokens are plain text. Rows are
aligned one by one, so repeated rows, equal and NULL ids need no care, but every row counts
in the corpus. An empty table gives no rows. Columns besides id and text are not read,
whatever their names. Texts are taken whole, in pieces of rows of about a megabyte.

A is encoded by ``tiktoken`` with the vocabulary's own tokens as ranks, which gives the same
ids as the ``tokenizers`` library on the same file and costs a fifth; texts with a run of more
than ``LONG_RUN`` bytes without a blank, or of blanks, go to that library, whose merges do not
slow down there.
"""

from __future__ import annotations

import hashlib
import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import Scratch, mapped, table, written

BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
LONG_RUN = 2_000
PIECE_BYTES = 1 << 20
# The pattern that byte-level vocabularies of this kind split texts by: a fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(BYTE_FILE), public_tokenizers.path(PIECE_FILE)


class Tokenizers:
    """Both encoders, the bytes of each of their tokens, and ids as digits with a separator."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece
        import tiktoken

        with open(byte_file, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["content"] for t in described["added_tokens"]}
        of = {c: i for i, c in enumerate(byte_letters())}
        vocab = {t: i for t, i in described["model"]["vocab"].items() if t not in special}
        self.byte_file, self.library = byte_file, None
        self.a_bytes = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(of[c] for c in token)
        ranks = {raw: i for i, raw in enumerate(self.a_bytes) if raw}
        self.fast = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(names)
        ]
        self.lengths = [np.array([len(b) for b in table]) for table in (self.a_bytes, self.b_bytes)]
        # Digits of each id with each separator; np.array would guess a width, so filled by hand.
        self.n = max(len(self.a_bytes), len(self.b_bytes))
        self.digits = np.empty(4 * self.n, dtype=object)
        for k, separator in enumerate((b",", b"|", b";", b"")):
            self.digits[k * self.n : (k + 1) * self.n] = [b"%d" % i + separator for i in range(self.n)]

    def encode_a(self, text: str, long: bool) -> list[int]:
        if not long:
            return self.fast.encode_ordinary(text)
        if self.library is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.library = Tokenizer.from_file(self.byte_file)
            self.library.encode_special_tokens = True
            self.library.no_truncation()
            self.library.no_padding()
        return self.library.encode(text, add_special_tokens=False).ids


def long_runs(raws: list[bytes], most: int = LONG_RUN) -> np.ndarray:
    """Which byte strings hold a run of more than ``most`` bytes of blanks or of other bytes."""
    joined = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8)
    blank = (joined == 32) | ((joined >= 9) & (joined <= 13))
    edges = np.flatnonzero(np.diff(blank.view(np.int8)))
    begin = np.concatenate([[0], edges + 1])
    length = np.diff(np.append(begin, len(joined)))
    bad = begin[length > most]
    found = np.zeros(len(raws), dtype=bool)
    if len(bad):
        first = np.cumsum([0, *(len(r) + 1 for r in raws)])
        for b, n in zip(bad, length[length > most]):  # a run of blanks may cross texts
            a = np.searchsorted(first, b, side="right") - 1
            found[a : max(a + 1, np.searchsorted(first, b + n, side="left"))] = True
    return found[: len(raws)]


def groups_of(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terminal token of every A and B token, and which B tokens are terminal.

    Both sides tile the same bytes; terminals are numbers of B tokens.
    """
    n_a = len(end_a)
    to_b = np.searchsorted(end_b, end_a, side="left")
    to_a = np.searchsorted(end_a, end_b, side="left")
    terminal = end_a[to_a] == end_b
    own = np.arange(len(end_b)) + n_a
    step = np.concatenate([to_b + n_a, np.where(terminal, own, to_a)]).astype(np.int32)
    while True:
        double = step[step]
        if np.array_equal(double, step):
            break
        step = double
    return step[:n_a] - n_a, step[n_a:] - n_a, terminal


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in lists], dtype=np.int64)
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(counts.sum())), counts


def _spells(lists: list[list[int]], table: list[bytes], raws: list[bytes]) -> np.ndarray:
    """Which texts their tokens spell; one comparison where all do."""
    parts = [b"".join(map(table.__getitem__, ids)) for ids in lists]
    return np.array([a == b for a, b in zip(parts, raws)], dtype=bool)


class Aligned:
    """Numbers and digests of a run of texts, and the pair of every link with its text."""

    def __init__(self, texts: list[str], tok: Tokenizers):
        n = len(texts)
        self.n_a, self.n_b, self.n_groups = (np.zeros(n, dtype=np.int64) for _ in range(3))
        self.digest = [""] * n
        self.link_text = self.link_pair = np.zeros(0, dtype=np.int64)
        at = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in at]
        raws = [t.encode() for t in spaced]
        if not at:
            return
        a = [tok.encode_a(t, slow) for t, slow in zip(spaced, long_runs(raws).tolist())]
        b = tok.pieces.encode([texts[i] for i in at], num_threads=1)
        good = _spells(a, tok.a_bytes, raws) & _spells(b, tok.b_bytes, raws)
        keep = np.flatnonzero(good).tolist()
        if not keep:
            return
        at = np.array(at)[keep]
        ids_a, count_a = _flat([a[i] for i in keep])
        ids_b, count_b = _flat([b[i] for i in keep])
        del a, b, spaced, raws
        end_a, end_b = (np.cumsum(x[i]) for x, i in zip(tok.lengths, (ids_a, ids_b)))
        label_a, label_b, terminal = groups_of(end_a, end_b)
        group = np.cumsum(terminal) - 1  # of a terminal B token
        group_a, group_b = group[label_a], group[label_b]
        n_groups = int(terminal.sum())
        text_of_b = np.repeat(np.arange(len(at)), count_b)
        last_b = np.flatnonzero(terminal)
        last_a = np.searchsorted(end_a, end_b[last_b], side="left")
        self.n_a[at], self.n_b[at] = count_a, count_b
        per_text = np.bincount(text_of_b[last_b], minlength=len(at))
        self.n_groups[at] = per_text
        self.link_text = at[text_of_b[last_b]]
        self.link_pair = (ids_a[last_a] << 32) | ids_b[last_b]

        # Digits of all ids in the order of the digest: a group's A tokens, then its B tokens.
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=n_groups))])
        before_a = np.concatenate([[0], np.cumsum(np.bincount(group_a, minlength=n_groups))])
        mark_a, mark_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
        mark_a[last_a], mark_b[last_b] = 1, 2
        mark_b[np.cumsum(count_b) - 1] = 3
        order = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        order[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + tok.n * mark_a
        order[np.arange(len(ids_b)) + before_a[group_b + 1]] = ids_b + tok.n * mark_b
        edges = np.concatenate([[0], np.cumsum(count_a + count_b)]).tolist()
        for i, s, e in zip(at.tolist(), edges, edges[1:]):
            self.digest[i] = hashlib.sha256(b"".join(tok.digits[order[s:e]].tolist())).hexdigest()


def _runs(values: list[str], most: int):
    """Texts in runs of about ``most`` characters, or one longer text."""
    run, size = [], 0
    for value in values:
        if run and size + len(value) > most:
            yield run
            run, size = [], 0
        run.append(value)
        size += len(value)
    if run:
        yield run


_SCHEMA = (
    "n_a long, n_b long, n_groups long, groups_sha256 string, chunk long, place array<int>, "
    "times array<long>, pairs array<long>, counts array<long>"
)
_NAMES = ["id", "n_a", "n_b", "n_groups", "groups_sha256", "chunk", "place", "times", "pairs", "counts"]


def _lists(edges: np.ndarray, values: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values, kind))


def align(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per text (``pairs`` NULL), and one per chunk with its distinct pairs and counts."""

    def run(batches):
        tok = None
        for number, batch in enumerate(batches):
            tok = tok or Tokenizers(byte_file, piece_file)
            n = batch.num_rows
            done = [Aligned(t, tok) for t in _runs([v or "" for v in batch.column(1).to_pylist()], PIECE_BYTES)]
            first = np.cumsum([0, *(len(x.digest) for x in done)])
            text = np.concatenate([x.link_text + f for x, f in zip(done, first)] or [np.zeros(0, np.int64)])
            pair = np.concatenate([x.link_pair for x in done] or [np.zeros(0, np.int64)])
            # Distinct pairs of each text first; what is left to sort for the chunk is smaller.
            order = np.lexsort((pair, text))
            text, pair = text[order], pair[order]
            new = np.ones(len(pair), dtype=bool)
            new[1:] = (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(pair)))
            text, pair = text[at], pair[at]
            pairs, place = np.unique(pair, return_inverse=True)
            counts = np.bincount(place, weights=times, minlength=len(pairs)).astype(np.int64)
            chunk = (TaskContext.get().partitionId() << 32) | number
            edges = np.searchsorted(text, np.arange(n + 1), side="left")
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.concatenate([getattr(x, c) for x in done]), pa.int64())
                                    for c in ("n_a", "n_b", "n_groups")),
                 pa.array([d for x in done for d in x.digest], pa.string()),
                 pa.array(np.full(n, chunk)), _lists(edges, place, pa.int32()), _lists(edges, times, pa.int64()),
                 *(pa.nulls(n, pa.list_(k)) for k in kinds[2:])],
                _NAMES,
            )
            whole = np.array([0, len(pairs)])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, batch.column(0).type), *(pa.nulls(1, pa.int64()) for _ in range(3)),
                 pa.nulls(1, pa.string()), pa.array([chunk], pa.int64()),
                 *(pa.nulls(1, pa.list_(k)) for k in kinds[:2]),
                 _lists(whole, pairs, pa.int64()), _lists(whole, counts, pa.int64())],
                _NAMES,
            )

    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return mapped(own, run, f"id {kind}, {_SCHEMA}")


def pair_counts(chunks: DataFrame, scratch: Scratch) -> DataFrame:
    """Corpus-wide ``pair``, ``n`` and ``best``: whether n is the highest of its B id."""
    rows = chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    summed = scratch.keep(rows.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("n")))
    b = F.col("pair").bitwiseAND((1 << 32) - 1)
    top = summed.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return scratch.keep(
        summed.withColumn("b", b).join(top, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    )


def _resolve(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of each text of one chunk; ``counts`` are the chunk's pairs."""
    at = counts["at"].to_numpy()
    n = np.zeros(len(at), dtype=np.int64)
    best = np.zeros(len(at), dtype=np.int64)
    n[at], best[at] = counts["n"].to_numpy(), counts["best"].to_numpy().astype(np.int64)
    place = texts["place"].combine_chunks()
    edges = place.offsets.to_numpy()
    edges = edges - edges[0]
    where, times = place.flatten().to_numpy(), texts["times"].combine_chunks().flatten().to_numpy()

    def total(values: np.ndarray) -> pa.Array:
        sums = np.concatenate([[0], np.cumsum(values * times)])
        return pa.array(sums[edges[1:]] - sums[edges[:-1]], pa.int64())

    made = texts.drop_columns(["chunk", "place", "times"])
    return made.append_column("n_best", total(best[where])).append_column("count_sum", total(n[where]))


def alignments(
    docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``id``, ``n_a``, ``n_b``, ``n_groups``, ``groups_sha256``, ``n_best``, ``count_sum``.

    Every group ends in one link, so the number of links is ``n_groups``.
    """
    with Scratch(docs.sparkSession, "alignment") as scratch:
        done = scratch.keep(align(docs, byte_file, piece_file, id_col, text_col))
        chunks = done.filter(F.col("pairs").isNotNull()).select("chunk", "pairs", "counts")
        pairs = pair_counts(chunks, scratch)
        rows = chunks.select("chunk", F.posexplode("pairs").alias("at", "pair"))
        back = scratch.keep(rows.join(pairs, "pair").select("chunk", "at", "n", "best"))
        linked = done.filter(F.size("place") > 0).select(*_NAMES[:-2])
        found = linked.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(
            _resolve,
            f"id {docs.schema[id_col].dataType.simpleString()}, n_a long, n_b long, n_groups long, "
            "groups_sha256 string, n_best long, count_sum long",
        )
        rest = done.filter(F.col("pairs").isNull() & (F.size("place") == 0)).select(
            *_NAMES[:5], F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum")
        )
        return written(found.unionByName(rest), "alignments")


def query(spark, sf_dir) -> DataFrame:
    made = alignments(table(spark, sf_dir, "documents"), *vocabulary_files())
    return made.select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        "n_best", "count_sum", "groups_sha256",
    )
