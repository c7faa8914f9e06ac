"""Benchmark decontamination by SimHash of item-sized windows, then exact comparison of passages.

Words are runs without blanks, control spaces and ASCII signs; A-Z count as a-z. A window's
fingerprint has 64 bits: each word votes with its length on every bit, by its hash.

A passage starts at any word of a text and has as many words as the item, or those left. It
is a leak from ``similarity`` on: the weight of the five-word shingles in both, as a share of
those in either, where a shingle weighs as many bytes as its words have.

Candidates come from two sources, and all passages around each are compared exactly:

* Windows of about the item's size (6, 8 or 10 times a power of two, at least three quarters
  of its words), fingerprinted in the item at its start, middle and end and in a text at
  every word. The index holds the 64 bits in four blocks of 16. Of two fingerprints within
  ``radius``, one block differs in at most radius / 4 bits, so every block is entered under
  all values that near to it: no fingerprint within the radius is missed.
* What lies beyond the radius and is still a leak: a passage lacks at most a share of 1 -
  ``similarity`` of the item's weight. So of any shingles of the item that weigh more than
  that, it holds one unedited. The hashes of these, chosen among those in the fewest items,
  are looked up at each word of a text: no leak is without a candidate, whatever was
  replaced, inserted or deleted, and other texts beside it change nothing.

``by_window`` tells whether the best passage also came from the first source.

Defined results: NULL and empty texts hold nothing. An item of fewer than ``size`` words is
one shingle, its whole run of words, and is found where a text has these words in a row;
an item of one shingle is looked up by its hash alone.
Items without words (NULL, empty, only signs) are found nowhere. In scripts without blanks
a word is what stands between blanks or ASCII signs, a sentence or more: an item is found
where such pieces are equal as wholes, not inside longer ones. Rows are searched one by one:
repeated rows and NULL ids give rows of their own. Repeated items count once; of different
items with one id the best counts, in each slice. An empty table on either side gives no rows. Columns besides ids and texts
are not read, whatever their names. Texts are searched whole.

One pass over the texts, no shuffle. Items go to the tasks with the code, in slices of at
most about ``SLICE`` bytes of text. A larger benchmark is searched slice by slice, each in a
pass that is written before the driver takes the next, so the driver holds one slice.
Nothing depends on the size of the benchmark but time.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, mapped, table, written
from .shingles import Words, chunks, read_words, shingle_hashes

SIZE = 5
SIMILARITY = 0.8
RADIUS = 7
BLOCKS = 4
SLICE = 4_000_000
CHUNK = 500_000
# Sums of votes stay below 2**15 for windows of up to 1,600 words.
MOST_WEIGHT = 20
MOST_WINDOW = 1_280
# Words whose votes are summed at a time; they stay in a core's cache.
STRIDE = 4_096
_U = np.uint64


def window_size(words: int) -> int:
    """The largest of 6, 8 and 10 times a power of two that an item of ``words`` words holds."""
    if words <= 6:
        return words
    every = 1
    while 12 * every <= words:
        every *= 2
    return min(MOST_WINDOW, max(n * every for n in (6, 8, 10) if n * every <= words))


def window_starts(words: int, size: int) -> list[int]:
    """Where an item's windows start: at both ends, in the middle, and one beside another."""
    last = words - size
    return sorted({0, last // 2, last, *range(0, last + 1, size)})


def voted(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Each word's votes on 64 bits: its weight, for or against."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int16)
    bits *= 2
    bits -= 1
    bits *= weights[:, None].astype(np.int16)
    return bits


def fingerprints(hashes: np.ndarray, weights: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """Of each size, the fingerprints of the windows at every word.

    Votes are added up in runs of doubling length, which all sizes share.
    """
    n = len(hashes)
    made = {size: np.zeros(max(0, n - size + 1), dtype=_U) for size in sizes}
    more = max(sizes, default=1) - 1
    for at in range(0, n, STRIDE):
        runs = [voted(hashes[at : at + STRIDE + more], weights[at : at + STRIDE + more])]
        for size in sizes:
            windows = min(STRIDE, len(runs[0]) - size + 1)
            if windows < 1:
                continue
            total, begin = None, 0
            for power in range(size.bit_length()):
                if power == len(runs):
                    half, length = runs[-1], 1 << (power - 1)
                    runs.append(half[: len(half) - length] + half[length:])
                if size >> power & 1:
                    part = runs[power][begin : begin + windows]
                    total = part if total is None else total + part
                    begin += 1 << power
            made[size][at : at + windows] = np.packbits((total > 0).reshape(-1)).view(_U)
    return made


class Item(NamedTuple):
    words: list[bytes]
    size: int  # of its shingles
    shingles: dict[tuple[bytes, ...], int]
    weight: int
    hashes: np.ndarray  # of the shingles, sorted
    weights: np.ndarray


class SizeIndex(NamedTuple):
    """Fingerprints of one window size: where they come from, and blocks to fingerprints."""

    prints: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    first: list[np.ndarray]  # per block: start of each value's entries
    entries: list[np.ndarray]


def _near(radius: int) -> np.ndarray:
    """All 16-bit differences of at most ``radius`` bits."""
    return np.array(
        [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(16), n)],
        dtype=np.uint16,
    )


def _blocks(prints: np.ndarray) -> np.ndarray:
    return prints.view(np.uint16).reshape(-1, BLOCKS)


def index_size(prints: np.ndarray, item: np.ndarray, offset: np.ndarray, radius: int) -> SizeIndex:
    near = _near(radius // BLOCKS)
    firsts, entries = [], []
    for block in _blocks(prints).T:
        values = (block[:, None] ^ near).reshape(-1)
        order = np.argsort(values, kind="stable")
        firsts.append(np.searchsorted(values[order], np.arange(65_537)).astype(np.int32))
        entries.append((order // len(near)).astype(np.int32))
    return SizeIndex(prints, item, offset, firsts, entries)


def lower_words(text: str | None) -> tuple[list[bytes], np.ndarray]:
    words = read_words([(text or "").encode()], punctuation=False)
    raw = words.raw.tobytes()
    return [raw[a:b] for a, b in zip(words.start, words.end)], words.hash


class Shingles(NamedTuple):
    """Hashes of chosen shingles of one length, sorted, and their items."""

    hashes: np.ndarray
    item: np.ndarray
    low: np.ndarray  # which values the low 16 bits have

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``asked``, item)."""
        at = np.flatnonzero(self.low[(asked & _U(0xFFFF)).astype(np.int64)])
        begin = np.searchsorted(self.hashes, asked[at])
        n = np.searchsorted(self.hashes, asked[at], "right") - begin
        found = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.item[found]


def shingles_of(hashes: np.ndarray, item: np.ndarray) -> Shingles:
    order = np.argsort(hashes, kind="stable")
    low = np.zeros(1 << 16, dtype=bool)
    low[(hashes & _U(0xFFFF)).astype(np.int64)] = True
    return Shingles(hashes[order], item[order], low)


class Index:
    """All items of a slice of the benchmark, for leaks of at least ``least``."""

    def __init__(
        self,
        texts: list[str | None],
        size: int = SIZE,
        radius: int = RADIUS,
        least: float = SIMILARITY,
    ):
        self.size, self.radius = size, radius
        self.items: dict[int, Item] = {}
        hashed: dict[int, np.ndarray] = {}
        windows: dict[int, list[tuple]] = {}
        for number, text in enumerate(texts):
            words, hashes = lower_words(text)
            if not words:
                continue
            short = min(size, len(words))
            shingles = weighted(words, short)
            hashed[number] = shingle_hashes(hashes, short)
            own, first = np.unique(hashed[number], return_index=True)
            weights = np.array([sum(map(len, words[i : i + short])) for i in first.tolist()])
            self.items[number] = Item(words, short, shingles, sum(shingles.values()), own, weights)
            if len(words) > size:
                window = window_size(len(words))
                at = np.array(window_starts(len(words), window))
                prints = fingerprints(hashes, _weights(np.array([len(w) for w in words])), [window])
                windows.setdefault(window, []).append((prints[window][at], np.full(len(at), number), at))
        holders = Counter(s for item in self.items.values() for s in item.shingles)
        rare: dict[int, list[tuple]] = {}
        for number, item in self.items.items():
            at = np.array(chosen(item, holders, least))
            rare.setdefault(item.size, []).append((hashed[number][at], np.full(len(at), number)))
        self.by_size = {
            own: index_size(*(np.concatenate(x) for x in zip(*parts)), radius)
            for own, parts in sorted(windows.items())
        }
        self.rare = {own: shingles_of(*(np.concatenate(x) for x in zip(*parts))) for own, parts in rare.items()}


def chosen(item: Item, holders: Counter, least: float) -> list[int]:
    """Where the shingles start of which a passage of ``least`` must hold one.

    They weigh more than such a passage may lack; those in few items and heavy ones first.
    """
    place: dict[tuple, int] = {}
    for i, shingle in enumerate(zip(*(item.words[i:] for i in range(item.size)))):
        place.setdefault(shingle, i)
    lacks, taken = (1 - least) * item.weight + 1e-6, []
    for shingle in sorted(place, key=lambda s: (holders[s], -item.shingles[s], place[s])):
        taken.append(place[shingle])
        lacks -= item.shingles[shingle]
        if lacks < 0:
            break
    return taken


def _weights(lengths: np.ndarray) -> np.ndarray:
    return np.minimum(lengths, MOST_WEIGHT)


def weighted(words: list[bytes], size: int) -> dict[tuple[bytes, ...], int]:
    """The distinct shingles with their weight, the bytes of their words."""
    return {s: sum(map(len, s)) for s in zip(*(words[i:] for i in range(size)))}


def similarity(a: dict, b: dict) -> float:
    both = sum(w for s, w in a.items() if s in b)
    either = sum(a.values()) + sum(b.values()) - both
    return both / either if either else 0.0


def near_windows(own: SizeIndex, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (asked window, indexed fingerprint) within ``radius``, from all four blocks."""
    windows, prints = [], []
    for block, first, entries in zip(_blocks(asked).T, own.first, own.entries):
        n = np.diff(first)
        hit = np.flatnonzero((n > 0)[block])
        if not len(hit):
            continue
        block = block[hit]
        begin, n = first[block], n[block]
        window = np.repeat(hit, n)
        inside = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
        found = entries[np.repeat(begin, n) + inside]
        near = np.bitwise_count(asked[window] ^ own.prints[found]) <= radius
        windows.append(window[near])
        prints.append(found[near])
    if not windows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    pairs = np.unique(np.concatenate(windows) * len(own.prints) + np.concatenate(prints))
    return np.divmod(pairs, len(own.prints))


def search(
    texts: list[bytes], index: Index, least: float
) -> list[tuple[int, int, int, int, float, bool]]:
    """Leaks of a run of texts: text, item, first word, end word, similarity, whether an
    item-sized window told of it.

    All passages from ``least`` on, which is not below that of the index.
    """
    words = read_words(texts, punctuation=False)
    if not len(words.hash):
        return []
    text_of = np.repeat(np.arange(len(texts)), np.diff(words.first))

    def by_text(window, item, size):
        inside = text_of[window] == text_of[window + size - 1]  # a window of one text
        window = window[inside]
        return zip(zip(text_of[window].tolist(), item[inside].tolist()), window.tolist())

    near: dict[tuple[int, int], list[int]] = {}
    prints = fingerprints(words.hash, _weights(words.end - words.start), list(index.by_size))
    for size, own in index.by_size.items():
        window, found = near_windows(own, prints[size], index.radius)
        for key, w in by_text(window, own.item[found], size):
            near.setdefault(key, []).append(w)
    hits = {key: set(at) for key, at in near.items()}
    for size, own in index.rare.items():
        if len(words.hash) >= size:
            for key, w in by_text(*own.find(shingle_hashes(words.hash, size)), size):
                hits.setdefault(key, set()).add(w)
    raw = words.raw.tobytes() if hits else b""
    made = []
    for (text, item), at in hits.items():
        own, told = index.items[item], np.array(near.get((text, item), []), dtype=np.int64)
        base, end = int(words.first[text]), int(words.first[text + 1])
        for first, last, score in passages(words, raw, base, end, sorted(at), own, least):
            by_window = bool(((told >= first) & (told <= first + len(own.words) - own.size)).any())
            made.append((text, item, first - base, last - base, score, by_window))
    return made


def passages(
    words: Words, raw: bytes, first: int, end: int, hits: list[int], item: Item, least: float
) -> list[tuple[int, int, float]]:
    """The passages of the text ``words[first:end]`` that hold a hit and are similar enough.

    ``hits`` ascend. Where the shingles of the item in a passage, repeated ones included,
    weigh too little, the passage is not compared.
    """
    n, size = len(item.words), item.size
    if n == size:  # one shingle, in a passage as well
        own = ((w, [raw[a:b] for a, b in zip(words.start[w : w + n], words.end[w : w + n])]) for w in hits)
        return [(w, w + n, 1.0) for w, passage in own if passage == item.words]
    ranges: list[list[int]] = []  # starts of passages
    for hit in hits:
        low = max(first, hit - n + size)
        if ranges and low <= ranges[-1][1] + 1:
            ranges[-1][1] = hit
        else:
            ranges.append([low, hit])
    made = []
    for low, high in ranges:
        hashes = shingle_hashes(words.hash[low : min(end, high + n)], size)
        at = np.minimum(np.searchsorted(item.hashes, hashes), len(item.hashes) - 1)
        shared = np.where(item.hashes[at] == hashes, item.weights[at], 0)
        upto = np.concatenate([[0], np.cumsum(shared)])
        start = np.arange(high - low + 1)
        most = upto[np.minimum(start + n - size + 1, len(hashes))] - upto[start]
        likely = np.flatnonzero(most >= least * item.weight - 1e-6)
        if len(likely):
            made += slid(words, raw, low + int(likely[0]), low + int(likely[-1]), end, item, least)
    return made


def slid(
    words: Words, raw: bytes, low: int, high: int, end: int, item: Item, least: float
) -> list[tuple[int, int, float]]:
    """Similar passages that start from ``low`` to ``high``, by adding and dropping shingles."""
    n, size = len(item.words), item.size
    to = min(end, high + n)
    own = [raw[a:b] for a, b in zip(words.start[low:to].tolist(), words.end[low:to].tolist())]
    shingles = list(zip(*(own[i:] for i in range(size))))
    made, held = [], Counter()
    both, either, right = 0, item.weight, 0
    for left in range(high - low + 1):
        while right < min(left + n - size + 1, len(shingles)):
            shingle = shingles[right]
            if not held[shingle]:
                if shingle in item.shingles:
                    both += item.shingles[shingle]
                else:
                    either += sum(map(len, shingle))
            held[shingle] += 1
            right += 1
        if both / either >= least:
            made.append((low + left, min(end, low + left + n), both / either))
        shingle = shingles[left]
        held[shingle] -= 1
        if not held[shingle]:
            if shingle in item.shingles:
                both -= item.shingles[shingle]
            else:
                either -= sum(map(len, shingle))
    return made


def apart(spans: list[tuple[int, int]]) -> int:
    """The most passages, all of one length or up to the end, that do not overlap."""
    n, reach = 0, -1
    for first, end in sorted(spans):
        if first >= reach:
            n, reach = n + 1, end
    return n


def slices(benchmark: DataFrame, slice_bytes: int, item_col: str, text_col: str):
    """Ids and texts of the items, in parts of about ``slice_bytes`` of text, and whether
    the part is the only one."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull()
    ).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0]
    if total:
        n = -(-total // slice_bytes)
        number = F.pmod(F.xxhash64("item", "text"), F.lit(n))
        for i in range(n):
            rows = items.filter(number == i).orderBy("item", "text").collect()
            yield [r["item"] for r in rows], [r["text"] for r in rows], n == 1


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least: float = SIMILARITY,
    radius: int = RADIUS,
    size: int = SIZE,
    slice_bytes: int = SLICE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per row and item found in it: ``id``, ``item_id``, ``similarity`` and the words
    (``first_word``, ``end_word``) of the best passage, ``n_passages`` and ``by_window``."""
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType
    schema = (
        f"id {kind}, item_id {item_kind.simpleString()}, similarity double, first_word long, "
        "end_word long, n_passages long, by_window boolean"
    )
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def searched(ids: list, texts: list[str]) -> DataFrame:
        made: list[Index] = []

        def run(batches):
            if not made:
                made.append(Index(texts, size, radius, least))
            for batch in batches:
                best: dict[tuple, list] = {}
                before = 0
                for run_ in chunks(batch.column(1).to_pylist(), CHUNK):
                    for text, item, first, end, score, by_window in search(run_, made[0], least):
                        seen = best.setdefault((before + text, ids[item]), [0.0, 0, 0, [], False])
                        if score > seen[0]:
                            seen[:3], seen[4] = [score, first, end], by_window
                        seen[3].append((first, end))
                    before += len(run_)
                rows_ = [(t, i, s, a, b, apart(n), w) for (t, i), (s, a, b, n, w) in best.items()]
                columns = list(zip(*rows_)) or [[]] * 7
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(list(columns[0]), pa.int64())),
                     pa.array(list(columns[1]), _arrow(item_kind)), pa.array(list(columns[2]), pa.float64()),
                     *(pa.array(list(c), pa.int64()) for c in columns[3:6]),
                     pa.array(list(columns[6]), pa.bool_())],
                    ["id", "item_id", "similarity", "first_word", "end_word", "n_passages", "by_window"],
                )

        return mapped(own, run, schema)

    parts = []
    for ids, texts, only in slices(benchmark, slice_bytes, item_col, item_text_col):
        part = searched(ids, texts)
        parts.append(part if only else written(part, "leaks"))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def _clean(texts: list[bytes], index: Index, least: float) -> np.ndarray:
    stays = np.ones(len(texts), dtype=bool)
    stays[[text for text, *_ in search(texts, index, least)]] = False
    return stays


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    least: float = SIMILARITY,
    radius: int = RADIUS,
    size: int = SIZE,
    slice_bytes: int = SLICE,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows, with all columns, that hold no item.

    With several slices, each writes the digests of the texts that it finds, and the rows
    with these texts leave in one join.
    """
    place = docs.columns.index(text_col)

    def judged(part: DataFrame, at: int, texts: list[str], keep: bool) -> DataFrame:
        made: list[Index] = []

        def run(batches):
            if not made:
                made.append(Index(texts, size, radius, least))
            for batch in batches:
                stays = [_clean(run_, made[0], least) for run_ in chunks(batch.column(at).to_pylist(), CHUNK)]
                stays = np.concatenate(stays) if stays else np.ones(0, dtype=bool)
                yield batch.filter(pa.array(stays == keep))

        return mapped(part, run, part.schema)

    digest = F.sha2(F.col(text_col).cast("binary"), 256)
    found = []
    for _, texts, only in slices(benchmark, slice_bytes, item_col, item_text_col):
        if only:
            return judged(docs, place, texts, keep=True)
        leaks = judged(docs.select(F.col(text_col)), 0, texts, keep=False)
        found.append(written(leaks.select(digest.alias("digest")).distinct(), "leaks"))
    if not found:
        return docs
    key = free_name(docs, "digest")
    leaks = reduce(DataFrame.union, found).distinct().withColumnRenamed("digest", key)
    left = docs.withColumn(key, digest).join(leaks, key, "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def query(spark, sf_dir) -> DataFrame:
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.withColumnRenamed("id", "doc_id")
