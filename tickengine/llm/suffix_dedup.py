"""Repeated passages by suffix arrays: bytes of 400-byte strings that occur twice are cut.

1. ``cut`` reads each text once. Every 400-byte window has an anchor, its 64-byte piece of
   least hash (the leftmost of equals), which depends on the window's bytes alone. Runs of
   windows with one anchor in one place form a string; equal windows have equal anchors, so
   they lie in strings of one anchor, wherever they stand.
2. Equal strings are counted by 128 bits of hash before anything is fetched, so a passage in
   a million texts is one string from here on; a string that occurs twice is repeated as a whole.
3. Windows of a string are told apart by how many bytes they have before the anchor: class
   ``[low, high]``. All windows of a class hold the same piece around the anchor, the core,
   and strings with equal cores form a bucket. The first two classes have cores of 232 bytes.
   Buckets of a single string hold no repeats. A bucket of more than ``BLOCK`` bytes is split
   by the content of longer cores: each of its classes is cut in two, until its buckets fit or
   a class is a single window, which is the core itself. So common anchors, and passages in many
   surroundings, never come together in one task, and no string is left out.
4. Strings of the buckets are fetched once each and dealt by bucket into tasks of about
   ``BLOCK`` bytes. A task builds the suffix array in two stages: suffixes smaller than their
   successors are sorted directly, to the depth of a window; all others are induced by one scan
   over the 256 buckets of first bytes. Adjacent common prefixes are computed on the bytes, and
   neighbours whose prefix reaches a window's length are repeated.
5. Spans go back to the texts, where overlapping ones unite.

Defined results: NULL and empty texts have no bytes; texts shorter than a window lose
nothing; rows of equal text, repeated rows included, repeat each other and are cut whole if
they have a window's length. Ids are only carried, so NULL ids and ties need no care. An
empty table gives no rows. Columns besides id and text are not read. Texts of any length
are read in pieces of at most ``PIECE`` bytes that overlap by a window.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mapped, table, written
from .shingles import Rolling, mix

WINDOW = 400
GRAM = 64
PIECE = 1 << 18
BLOCK = 1 << 19
_U = np.uint64
_POS = _U((1 << 26) - 1)
_one, _two = Rolling(0xD1B54A32D192ED03), Rolling(0xE7037ED1A0B428DB)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, by least values of block heads and tails."""
    n = len(values)
    padded = np.full(-(-n // width) * width, ~_U(0), dtype=_U)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    heads = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    tails = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(tails[: n - width + 1], heads[width - 1 : n])


def classes(window: int, gram: int) -> list[tuple[int, int]]:
    """The first classes: fewest and most bytes before the anchor of their windows."""
    most = window - gram
    return [(0, most // 2), (most // 2 + 1, most)] if most else [(0, 0)]


def anchored(raw: np.ndarray, valid: np.ndarray, window: int, gram: int):
    """Start, end and anchor's place of the strings of a byte array, their hashes, and the hash
    of each class's core with whether the string has it; ``valid`` marks windows."""
    width = window - gram + 1
    sums = _one.sums(raw)
    at = np.arange(len(raw) - gram + 1)
    hashed = _one.pieces(sums, at, at + gram)
    least = sliding_least((hashed & ~_POS) | at.astype(_U), width)
    starts = np.flatnonzero(valid[: len(least)])
    if not len(starts):
        return None
    place = (least[starts] & _POS).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    begin, end, place = starts[first], starts[last] + window, place[first]
    more, cores = _two.sums(raw), []
    own = [_one.pieces(sums, begin, end).view(np.int64), _two.pieces(more, begin, end).view(np.int64)]
    for low, high in classes(window, gram):
        has = (place - low >= begin) & (place + window - high <= end)
        core = _two.pieces(more, np.where(has, place - low, 0), np.where(has, place + window - high, 0))
        cores.append((mix(core + _U(low)).view(np.int64), has))
    return begin, end, place, own, cores


def _joined(values: Iterable[tuple[int, bytes]], window: int, piece: int):
    """``(numbers, offsets, parts, raw, valid)`` of joined pieces of numbered byte strings.

    ``valid`` marks the windows; each starts in one piece only.
    """
    texts, offsets, parts, size = [], [], [], 0

    def joined():
        raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
        valid = np.zeros(len(raw), dtype=bool)
        at = 0
        for part in parts:
            valid[at : at + max(0, len(part) - window + 1)] = True
            at += len(part)
        return texts, offsets, parts, raw, valid

    for number, data in values:
        for offset in range(0, max(0, len(data) - window + 1), piece):
            part = data[offset : offset + piece + window - 1]
            if parts and size + len(part) > piece:
                yield joined()
                texts, offsets, parts, size = [], [], [], 0
            texts.append(number)
            offsets.append(offset)
            parts.append(part)
            size += len(part)
    if parts:
        yield joined()


def cut(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, piece: int = PIECE) -> DataFrame:
    """All strings of all texts (k1, k2, text): where they are and their anchor (from the string's
    start), their two hashes, and the cores of their classes, NULL where a string lacks one."""

    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data = enumerate((v.as_py() or "").encode() for v in batch.column(2))
            for texts, offsets, parts, raw, valid in _joined(data, window, piece):
                found = anchored(raw, valid, window, gram)
                if found is None:
                    continue
                begin, end, place, own, cores = found
                edges = np.cumsum([0, *map(len, parts)])
                part = np.searchsorted(edges, begin, side="right") - 1
                number = np.array(texts)[part]
                shift = np.array(offsets)[part] - edges[part]
                plain = (k1[number], k2[number], begin + shift, end + shift, place - begin, *own)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, plain), *(pa.array(x, mask=~has) for x, has in cores)],
                    ["k1", "k2", "start", "end", "anchor", "s1", "s2", *(f"c{i}" for i in range(len(cores)))],
                )

    cores = "".join(f", c{i} long" for i in range(len(classes(window, gram))))
    return mapped(docs.select("k1", "k2", "text"), run,
                  "k1 long, k2 long, start long, end long, anchor long, s1 long, s2 long" + cores)


def direct_sort(text: bytes, starts: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` bytes: eight as a number, the rest where these are equal."""
    if not len(starts):
        return starts
    near = min(8, depth)
    padded = np.concatenate([np.frombuffer(text, dtype=np.uint8), np.zeros(8, dtype=np.uint8)])
    head = np.zeros(len(starts), dtype=_U)
    for i in range(near):
        head = (head << _U(8)) | padded[starts + i].astype(_U)
    # Past its end a text is less than any byte, zero included.
    inside = np.minimum(len(text) - starts, near)
    order = np.lexsort((inside, head))
    starts, head, inside = starts[order], head[order], inside[order]
    same = (head[1:] == head[:-1]) & (inside[1:] == inside[:-1])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    made = starts.tolist()
    for a, b in zip(edges[::2].tolist(), (edges[1::2] + 1).tolist()):
        made[a:b] = sorted(made[a:b], key=lambda i: text[i + near : i + depth])
    return np.array(made, dtype=np.int64)


def suffix_order(text: bytes, depth: int) -> np.ndarray:
    """Suffix array in two stages; suffixes equal in their first ``depth`` bytes in any order."""
    t = np.frombuffer(text, dtype=np.uint8)
    n = len(t)
    order = np.zeros(n, dtype=np.int64)
    if not n:
        return order
    # A suffix is small if it is less than its successor: by the next byte that differs.
    differs = np.flatnonzero(t[:-1] != t[1:])
    following = np.searchsorted(differs, np.arange(n))
    small = np.zeros(n, dtype=bool)
    inner = following < len(differs)
    at = differs[following[inner]]
    small[inner] = t[at] < t[at + 1]

    # Stage one: direct sort of the small suffixes; they end their buckets.
    direct = direct_sort(text, np.flatnonzero(small), depth)
    ends = np.cumsum(np.bincount(t, minlength=256))
    heads = ends - np.bincount(t, minlength=256)
    n_small = np.bincount(t[direct], minlength=256) if len(direct) else np.zeros(256, dtype=np.int64)
    taken = np.cumsum(n_small)
    for c in np.flatnonzero(n_small):
        order[ends[c] - n_small[c] : ends[c]] = direct[taken[c] - n_small[c] : taken[c]]

    # Stage two: bucket by bucket, each suffix puts its larger predecessor next in its bucket.
    fill = heads.copy()

    def put(found: np.ndarray) -> None:
        if len(found):
            first = t[found]
            by = np.argsort(first, kind="stable")
            first, found = first[by], found[by]
            counts = np.bincount(first, minlength=256)
            before = np.cumsum(counts) - counts
            order[fill[first] + np.arange(len(found)) - before[first]] = found
            fill[:] += counts

    put(np.array([n - 1]))
    for c in np.flatnonzero(ends > heads):
        done = heads[c]
        while done < fill[c]:
            now = order[done : fill[c]] - 1
            done = fill[c]
            now = now[now >= 0]
            put(now[t[now] >= c])
        now = order[ends[c] - n_small[c] : ends[c]] - 1
        now = now[now >= 0]
        put(now[t[now] > c])
    return order


def common_prefixes(text: bytes, order: np.ndarray, depth: int) -> np.ndarray:
    """Length, up to ``depth``, of what each suffix but the last has in common with the next."""
    padded = text + bytes(depth + 8)
    eight = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded, strides=(1,))
    a, b = order[:-1], order[1:]
    length = np.full(len(a), depth, dtype=np.int64)
    alive = np.arange(len(a))
    for k in range(0, depth, 8):
        differs = eight[a[alive] + k] ^ eight[b[alive] + k]
        ends = np.flatnonzero(differs)
        x = differs[ends]
        same = sum(((x & _U((1 << 8 * i) - 1)) == 0).astype(np.int64) for i in range(1, 8))
        length[alive[ends]] = k + same
        alive = alive[differs == 0]
        if not len(alive):
            break
    return np.minimum(length, np.minimum(depth, len(text) - np.maximum(a, b)))


def repeated_windows(strings: list[bytes], window: int) -> list[np.ndarray]:
    """Per string: starts of windows that occur again in these strings."""
    text = b"".join(strings)
    edges = np.cumsum([0, *map(len, strings)])
    valid = np.zeros(len(text), dtype=bool)
    for a, b in zip(edges, edges[1:]):
        valid[a : max(a, b - window + 1)] = True
    order = suffix_order(text, window)
    order = order[valid[order]]
    same = common_prefixes(text, order, window) >= window
    again = np.zeros(len(text), dtype=bool)
    again[order[:-1][same]] = again[order[1:][same]] = True
    return [np.flatnonzero(again[a:b]) for a, b in zip(edges, edges[1:])]


def covered(starts: np.ndarray, window: int) -> list[dict]:
    """The spans that windows at sorted ``starts`` cover."""
    if not len(starts):
        return []
    new = np.flatnonzero(np.diff(starts) > window) + 1
    first = np.concatenate([[0], new])
    last = np.append(new, len(starts)) - 1
    return [dict(s=int(a), e=int(b) + window) for a, b in zip(starts[first], starts[last])]


_SPANS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
_STRING = ["s1", "s2"]


def sorted_spans(pieces: DataFrame, tasks: int, window: int) -> DataFrame:
    """Repeated spans of strings that occur once, from their pieces (bucket, s1, s2, n, at, bytes)."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found = repeated_windows([bytes(x) for x in frame["bytes"]], window)
        spans = [covered(x + at, window) if n == 1 else [] for x, n, at in zip(found, frame["n"], frame["at"])]
        made = frame[_STRING].assign(spans=spans)
        return made[[len(x) > 0 for x in spans]]

    dealt = pieces.withColumn("task", F.pmod(F.xxhash64("bucket"), F.lit(tasks)))
    found = dealt.groupBy("task").applyInPandas(run, "s1 long, s2 long, spans array<struct<s:long,e:long>>")
    return found.select(*_STRING, F.explode("spans").alias("span")).select(*_STRING, "span.s", "span.e")


def trimmed(low: Column, high: Column, anchor: Column, size: Column, window: int) -> tuple[Column, Column]:
    """Start and end of the windows of a class in a string of ``size`` bytes."""
    return F.greatest(F.lit(0), anchor - high), F.least(size, anchor - low + window)


def part(data: Column, start: Column, end: Column) -> Column:
    return F.substring(data, (start + 1).cast("int"), (end - start).cast("int"))


def shared_buckets(pieces: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The buckets of several strings, with their ``bytes`` in all; and the pieces."""
    pieces = scratch.keep(pieces)
    size = F.sum(F.octet_length("bytes")).alias("total")
    buckets = pieces.groupBy("bucket").agg(F.count("*").alias("m"), size).filter(F.col("m") > 1)
    return scratch.keep(buckets.select("bucket", "total")), pieces


def halved(pieces: DataFrame, window: int) -> DataFrame:
    """Pieces of the two halves of each class, in the buckets of their longer cores."""
    middle = F.floor((F.col("low") + F.col("high")) / 2)
    halves = F.array(
        F.struct(F.col("low").alias("l"), middle.alias("h")), F.struct((middle + 1).alias("l"), F.col("high").alias("h"))
    )
    rows = pieces.withColumn("half", F.explode(halves))
    size, anchor, low, high = F.octet_length("bytes").cast("long"), F.col("anchor"), F.col("half.l"), F.col("half.h")
    has = (anchor - low >= 0) & (anchor + window - high <= size)
    core = part(F.col("bytes"), anchor - low, anchor + window - high)
    start, end = trimmed(low, high, anchor, size, window)
    return rows.filter(has).select(
        # A core that is a window of its own stands for itself; any two hashes may meet otherwise.
        F.xxhash64(core, low).alias("bucket"), low.alias("low"), high.alias("high"), *_STRING, "n",
        (F.col("at") + start).alias("at"), (anchor - start).alias("anchor"),
        part(F.col("bytes"), start, end).alias("bytes"),
    )


def bucket_spans(pieces: DataFrame, window: int, block: int, scratch: Scratch) -> list[DataFrame]:
    """Repeated spans (s1, s2, s, e) of the strings of all buckets."""
    found = []
    while True:
        buckets, pieces = shared_buckets(pieces, scratch)
        (total,) = buckets.filter(F.col("total") <= block).agg(F.sum("total")).first()
        if total:
            small = pieces.join(buckets.filter(F.col("total") <= block), "bucket")
            found.append(scratch.keep(sorted_spans(small, -(-total // block), window)))
        large = buckets.filter(F.col("total") > block)
        if large.isEmpty():
            return found
        pieces = scratch.keep(pieces.join(large.select("bucket"), "bucket"))
        single = pieces.filter(F.col("low") == F.col("high"))
        again = single.groupBy("bytes").agg(F.count("*").alias("m")).filter(F.col("m") > 1).select("bytes")
        window_span = F.col("at").alias("s"), (F.col("at") + window).alias("e")
        found.append(
            scratch.keep(single.filter(F.col("n") == 1).join(again, "bytes", "left_semi").select(*_STRING, *window_span))
        )
        pieces = halved(pieces.filter(F.col("low") < F.col("high")), window)


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), text).alias(f"k{seed}") for seed in (1, 2)]


def find_spans(docs: DataFrame, scratch: Scratch, window: int = WINDOW, gram: int = GRAM,
               block: int = BLOCK, piece: int = PIECE) -> DataFrame:
    """Per text (k1, k2) with repeated windows: all its repeated spans, unmerged."""
    long_ = docs.filter(F.octet_length("text") >= window).select("k1", "k2", "text")
    cuts = scratch.keep(cut(long_, window, gram, piece))
    kinds = classes(window, gram)
    place = [F.first(c).alias(c) for c in ("k1", "k2", "start", "end", "anchor", *(f"c{i}" for i in range(len(kinds))))]
    strings = scratch.keep(cuts.groupBy(*_STRING).agg(F.count("*").alias("n"), *place))
    posts = strings.select(
        *_STRING,
        F.explode(F.array(*(F.struct(F.lit(a).cast("long").alias("low"), F.lit(b).cast("long").alias("high"),
                                     F.col(f"c{i}").alias("bucket")) for i, (a, b) in enumerate(kinds)))).alias("post"),
    ).select(*_STRING, "post.*").filter(F.col("bucket").isNotNull())
    # Written first, so that Spark can split the rows of a common core in the join.
    shared = scratch.keep(posts.groupBy("bucket").agg(F.count("*").alias("m")).filter(F.col("m") > 1).select("bucket"))
    members = scratch.keep(posts.join(shared, "bucket"))
    asked = scratch.keep(strings.join(members.select(*_STRING).distinct(), _STRING).select(
        *_STRING, "n", "k1", "k2", "start", "end", "anchor"
    ))
    texts = (
        long_.join(asked.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
        .dropDuplicates(["k1", "k2"])
    )
    size = F.col("end") - F.col("start")
    fetched = asked.join(texts, ["k1", "k2"]).select(
        *_STRING, "n", "anchor", part(F.col("text").cast("binary"), F.col("start"), F.col("end")).alias("bytes")
    )
    low, high = F.col("low"), F.col("high")
    start, end = trimmed(low, high, F.col("anchor"), F.octet_length("bytes").cast("long"), window)
    pieces = members.join(fetched, _STRING).select(
        "bucket", "low", "high", *_STRING, "n", start.alias("at"), (F.col("anchor") - start).alias("anchor"),
        part(F.col("bytes"), start, end).alias("bytes"),
    )
    found = bucket_spans(pieces, window, block, scratch)
    # A string that occurs once has one place; one that occurs more often is repeated whole.
    placed = cuts.join(strings.filter(F.col("n") > 1).select(*_STRING), _STRING).select(
        "k1", "k2", F.col("start").alias("s"), F.col("end").alias("e")
    )
    if found:
        at = F.col("start")
        spans = reduce(DataFrame.unionByName, found)
        placed = placed.unionByName(
            spans.join(strings.select(*_STRING, "k1", "k2", "start"), _STRING)
            .select("k1", "k2", (at + F.col("s")).alias("s"), (at + F.col("e")).alias("e"))
        )
    return (
        placed.distinct().groupBy("k1", "k2")
        .agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("spans"))
    )


def united(spans: list[dict]) -> list[tuple[int, int]]:
    """Sorted spans, with overlapping and touching ones in one."""
    made: list[tuple[int, int]] = []
    for span in spans:
        s, e = span["s"], span["e"]
        if made and s <= made[-1][1]:
            made[-1] = (made[-1][0], max(e, made[-1][1]))
        else:
            made.append((s, e))
    return made


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **sizes
) -> DataFrame:
    """Per row: ``id``, ``n_bytes``, ``n_removed``, ``removed`` (united spans) and ``kept``, the rest."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    own = docs.select(F.col(id_col).alias("id"), text).select("id", "text", *_keys(F.col("text")))
    with Scratch(spark, "suffix") as scratch:
        spans = written(find_spans(own, scratch, window, **sizes), "repeats")

    def run(batches):
        for batch in batches:
            n_bytes, removed, kept = [], [], []
            for value, found in zip(batch.column(1), batch.column(2).to_pylist()):
                data = value.as_py().encode()
                whole = united(found or [])
                edges = [0, *(x for span in whole for x in span), len(data)]
                n_bytes.append(len(data))
                removed.append([dict(s=s, e=e) for s, e in whole])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()),
                 pa.array([sum(x["e"] - x["s"] for x in r) for r in removed], pa.int64()),
                 pa.array(removed, _SPANS), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "n_removed", "removed", "kept"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    joined = own.join(spans, ["k1", "k2"], "left").select("id", "text", "spans")
    return mapped(joined, run, f"id {kind}, n_bytes long, n_removed long, "
                  "removed array<struct<s:long,e:long>>, kept binary")  # fmt: skip


def query(spark, sf_dir) -> DataFrame:
    made = remove_repeats(table(spark, sf_dir, "documents"))
    return made.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )
