"""Quality scores: ridge regression on random Fourier features of document statistics.

1. ``statistics`` reads each whole text once and gives ``len(STATS)`` numbers: lengths, shares of
   kinds of bytes, repetition of words, word pairs and lines. They are written; all later
   steps read this narrow table.
2. Labels are summed per id and joined to the statistics. Of these rows, two parts of three fit the
   ridge, one calibrates; the parts go by a hash of the id.
3. Standardised statistics go through ``n_features`` cosines of random projections, whose inner
   products approximate a Gaussian kernel. Every task sums its rows' normal equations
   to one matrix, matrices are summed by row in a grouping, and the driver solves the
   system, whose size depends on ``n_features`` alone.
4. Scores of the calibrating rows are summed in ``BINS`` equal bins by Spark; the driver merges
   bins until the share of label 1 never falls (isotonic regression by pooling neighbours) and the
   score of any text is read off between the pools' centres.

All labelled rows are used, no sample. What the driver holds - one matrix, ``BINS`` rows - has
a fixed size. Labels, languages, sources and ids are no inputs of a score: equal texts have
equal scores.

Defined results: NULL and empty texts have statistics of 0 and are scored like others. Labels
other than 0 and 1, NULL labels and labels of NULL ids are not read; of an id with several
labels their mean counts, and of an id with several rows each row. Without labels in the fitting
part every score is 0.5; without labels in the calibrating part, the ridge's own value is cut to
0..1. Empty tables give no rows. Extra columns are not read. Texts of any length are taken whole.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mapped, table, written
from .shingles import Rolling, chunks, mix, read_words

N_FEATURES = 256
BINS = 4_096
RIDGE = 1e-3
ROWS_PER_SUM = 20_000
LOW, HIGH = -0.5, 1.5
STATS = (
    "log_bytes", "log_words", "log_lines", "word_length", "log_longest_word", "symbols", "stops", "shouts",
    "digits", "letters", "blanks", "upper", "upper_words", "symbol_words", "short_words", "distinct_words",
    "words_like_last", "commonest_word", "repeated_pairs", "repeated_lines",
)
_U = np.uint64
_lines = Rolling(0x8EBC6AF09C88C6E3)


def _kind(members: bytes | range) -> np.ndarray:
    made = np.zeros(256, dtype=bool)
    made[list(members)] = True
    return made


_UPPER, _LOWER, _DIGIT = _kind(range(65, 91)), _kind(range(97, 123)), _kind(range(48, 58))
_LETTER = _UPPER | _LOWER | _kind(range(128, 256))
_SYMBOL = _kind(b"#*$%&|<>@^~_=+\\/{}[]")
_STOP = _kind(b".,;:?")
_SHOUT = _kind(b"!")
_BLANK = _kind(b" \t\n\x0b\x0c\r")


def _repeats(text: np.ndarray, key: np.ndarray, n: int, weight: np.ndarray | None = None):
    """Per text: distinct keys, the count of its commonest, and the weight of all but each first."""
    order = np.lexsort((key, text))
    t, k = text[order], key[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(k)))
    most = np.zeros(n, dtype=np.int64)
    np.maximum.at(most, t[at], run)
    again = np.bincount(t[~new], weights=None if weight is None else weight[order][~new], minlength=n)
    return np.bincount(t[at], minlength=n), most, again


def text_statistics(texts: list[bytes]) -> np.ndarray:
    """A row of ``STATS`` per text."""
    n = len(texts)
    words = read_words(texts)
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    size = np.array([len(t) for t in texts])
    first = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    begin, end = first, first + size

    def in_texts(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[raw])])
        return sums[end] - sums[begin]

    def in_words(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[raw])])
        return sums[words.end] - sums[words.start]

    n_words = np.diff(words.first)
    of = np.repeat(np.arange(n), n_words)
    length = words.end - words.start

    def share_of_words(which: np.ndarray) -> np.ndarray:
        return np.bincount(of[which], minlength=n) / np.maximum(n_words, 1)

    longest = np.zeros(n, dtype=np.int64)
    np.maximum.at(longest, of, length)
    distinct, commonest, _ = _repeats(of, words.hash, n)
    same = np.zeros(len(of), dtype=bool)
    next_to = of[1:] == of[:-1]
    same[1:] = next_to & (words.hash[1:] == words.hash[:-1])
    pairs = mix(words.hash[:-1] * _U(0x9E3779B97F4A7C15) + words.hash[1:])[next_to]
    _, _, pairs_again = _repeats(of[1:][next_to], pairs, n)

    # Lines that hold a word; those equal to an earlier one count with their bytes.
    breaks = np.concatenate([np.flatnonzero(raw == 10), end])
    breaks.sort()
    starts = np.concatenate([[0], breaks[:-1] + 1])
    full = np.searchsorted(words.start, breaks) > np.searchsorted(words.start, starts)
    starts, breaks = starts[full], breaks[full]
    line_of = np.searchsorted(first, starts, side="right") - 1
    hashed = _lines.pieces(_lines.sums(raw), starts, breaks)
    _, _, lines_again = _repeats(line_of, hashed, n, (breaks - starts).astype(float))

    bytes_, letters = np.maximum(size, 1), in_texts(_LETTER)
    upper = in_words(_UPPER)
    lower = in_words(_LOWER)
    return np.stack([
        np.log1p(size), np.log1p(n_words), np.log1p(np.bincount(line_of, minlength=n)),
        np.bincount(of, weights=length, minlength=n) / np.maximum(n_words, 1), np.log1p(longest),
        in_texts(_SYMBOL) / bytes_, in_texts(_STOP) / bytes_, in_texts(_SHOUT) / bytes_,
        in_texts(_DIGIT) / bytes_, letters / bytes_, in_texts(_BLANK) / bytes_,
        in_texts(_UPPER) / np.maximum(letters, 1), share_of_words((upper > 1) & (lower == 0)),
        share_of_words(in_words(_SYMBOL) > 0), share_of_words(length <= 3), distinct / np.maximum(n_words, 1),
        share_of_words(same), commonest / np.maximum(n_words, 1), pairs_again / np.maximum(n_words - 1, 1),
        lines_again / bytes_,
    ], axis=1)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id`` and its ``stats``."""

    def run(batches):
        for batch in batches:
            made = [text_statistics(t) for t in chunks(batch.column(1).to_pylist())]
            if made:
                whole = np.concatenate(made)
                offsets = np.arange(len(whole) + 1, dtype=np.int32) * len(STATS)
                stats = pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), stats], ["id", "stats"])

    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return mapped(own, run, f"id {kind}, stats array<double>")


class Model(NamedTuple):
    """Scaling, projections, weights, and the curve from ridge values to scores."""

    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    score: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """The cosines, and a constant. Statistics far from all others count as 6 deviations off."""
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        made = np.cos(x @ self.turn + self.shift) * np.sqrt(2 / len(self.shift))
        return np.concatenate([made, np.ones((len(x), 1))], axis=1)

    def values(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.values(stats), self.at, self.score)


def projections(n_stats: int, n_features: int, width: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Random projections and shifts whose cosines have the kernel exp(-|x - y|^2 / (2 width^2))."""
    rng = np.random.default_rng(seed)
    return rng.normal(0, 1 / width, (n_stats, n_features)), rng.uniform(0, 2 * np.pi, n_features)


def normal_equations(rows: DataFrame, model: Model) -> np.ndarray:
    """Sum over rows (stats, y) of z z' and z y, for features z: one matrix per task, then one."""
    n = len(model.weights)

    def run(batches):
        total = np.zeros((n, n + 1))
        for batch in batches:
            if batch.num_rows:
                z = model.features(_stats(batch.column(0)))
                y = batch.column(1).to_numpy(zero_copy_only=False)
                total += z.T @ np.concatenate([z, y[:, None]], axis=1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (n + 1)), pa.array(total.reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), lists], ["i", "sums"])

    parts = mapped(rows.select("stats", "y"), run, "i long, sums array<double>")
    summed = parts.groupBy("i").agg(*(F.sum(F.col("sums")[j]).alias(str(j)) for j in range(n + 1)))
    made = np.zeros((n, n + 1))
    for row in summed.collect():  # as many as there are features
        made[row["i"]] = row[1:]
    return made


def _stats(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(STATS))


def pooled(total: np.ndarray, ones: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of ones/total on ``at`` (ascending): centres and shares of the pools."""
    pools: list[list[float]] = []
    for n, y, x in zip(total.tolist(), ones.tolist(), at.tolist()):
        pools.append([n, y, n * x])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    n, y, x = np.array(pools).T
    return x / n, y / n


def labelled(stats: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """``id``, ``stats`` and ``y``, the mean label of the id."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    mean = known.groupBy(F.col(id_col).alias("label_id")).agg(F.avg(F.col(label_col).cast("double")).alias("y"))
    return stats.join(mean, F.col("id") == F.col("label_id")).select("id", "stats", "y")


def train(
    rows: DataFrame, calibrates, scratch: Scratch, n_features: int = N_FEATURES, width: float = 4.0, ridge: float = RIDGE
) -> Model:
    """Fits labelled statistics (id, stats, y); ``calibrates`` marks the rows for the curve."""
    known = scratch.keep(rows.withColumn("calibrates", calibrates))
    fit, rest = (known.filter(F.col("calibrates") == flag).select("stats", "y") for flag in (False, True))
    each = [F.col("stats")[i] for i in range(len(STATS))]
    n, *moments = fit.agg(F.count("*"), *map(F.avg, each), *map(F.stddev_pop, each)).first()
    turn, shift = projections(len(STATS), n_features, width)
    zero, flat = np.zeros(n_features + 1), (np.array([LOW, HIGH]), np.array([0.5, 0.5]))
    if not n:
        return Model(np.zeros(len(STATS)), np.ones(len(STATS)), turn, shift, zero, *flat)
    mean, scale = np.array(moments[: len(STATS)]), np.array(moments[len(STATS) :])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), turn, shift, zero, *flat)
    sums = normal_equations(fit.coalesce(max(1, -(-n // ROWS_PER_SUM))), model)
    # The constant is not held back, so that scores keep the labels' mean.
    hold = np.full(n_features + 1, ridge * n)
    hold[-1] = 1e-9 * n
    model = model._replace(weights=np.linalg.solve(sums[:, :-1] + np.diag(hold), sums[:, -1]))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(model.values(_stats(batch.column(0)))), batch.column(1)], ["value", "y"]
                )

    width_of_bin = (HIGH - LOW) / BINS
    cut = F.least(F.greatest(F.floor((F.col("value") - LOW) / width_of_bin), F.lit(0)), F.lit(BINS - 1))
    bins = (
        mapped(rest, run, "value double, y double").groupBy(cut.alias("bin"))
        .agg(F.count("*").alias("n"), F.sum("y").alias("ones"), F.avg("value").alias("at"))
        .orderBy("bin").toPandas()
    )
    if len(bins):
        at, score = pooled(*(bins[c].to_numpy(dtype=float) for c in ("n", "ones", "at")))
    else:
        at, score = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model._replace(at=at, score=score)


def score_stats(stats: DataFrame, model: Model) -> DataFrame:
    """``id`` and ``score``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                score = pa.array(model.scores(_stats(batch.column(1))))
                yield pa.RecordBatch.from_arrays([batch.column(0), score], ["id", "score"])

    return mapped(stats.select("id", "stats"), run, f"id {stats.schema['id'].dataType.simpleString()}, score double")


def _remainder(of, divisor: int):
    return F.coalesce(F.crc32(of.cast("string")) % divisor, F.lit(0))


def classify(
    docs: DataFrame, labels: DataFrame, learns, label_col: str = "quality",
    id_col: str = "doc_id", text_col: str = "text", **sizes,
) -> DataFrame:
    """``id`` and ``score`` of every row; labels are read from rows where ``learns``, over ``id``, holds."""
    with Scratch(docs.sparkSession, "quality") as scratch:
        stats = scratch.keep(statistics(docs, id_col, text_col))
        rows = labelled(stats.filter(learns), labels, label_col, id_col)
        part = F.floor(F.crc32(F.concat(F.lit("part "), F.col("id").cast("string"))) / 64) % 3 == 0
        model = train(rows, part, scratch, **sizes)
        return written(score_stats(stats, model), "quality-scores")


LEAST_SCORE = 0.7


def query(spark, sf_dir) -> DataFrame:
    held_out = _remainder(F.col("id"), 4) == 2
    made = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return made.select(
        F.col("id").alias("doc_id"), held_out.alias("held_out"), "score",
        (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"),
    )
