"""Hard negatives by a vertical scan over columnar vectors, in the manner of BOND.

Rows and anchors are dealt into blocks by a hash of their id, and every block of anchors meets
every block of rows in a task of its own (a stated query set against all rows). A block of rows
is held by dimension. For an anchor, dimensions are read in the order of its descending
magnitudes; after each few of them a candidate's score is known up to what the dimensions
left can add, and the block's least and greatest value per dimension bound that. Candidates whose
bounds leave all windows asked, or that enough others are sure to beat, drop out of the
candidate bitmap; what is left after the last dimension has its exact score.

1. Positives: the first ``n_positive`` rows of the anchor's label. The window is open, so only
   better rows drop a candidate.
2. Negatives: per positive, the first ``n_negative`` rows of other labels whose score lies in
   the window that the positive's score sets. All windows of an anchor are resolved in one scan.

Each block gives at most that many rows per anchor and positive; the best of all blocks are
ranked by a window function, which keeps only the first ones of each task before the shuffle.
Scores are exact integers: doubles while no sum can pass 2^53, whole numbers of any size beyond.

Defined results: rows with a NULL id, label or vector, or a NULL or non-finite component, take no
part. Rows that repeat an id count once, as the one of the least label, then the least vector.
So "other rows" are rows of other ids. Missing components of shorter vectors are 0; empty vectors
score 0. Ties go to the smaller id. Scores beyond 64 bits are given as the nearest 64-bit number.
An anchor without positives, or a positive without negatives, gives no rows; an empty table
neither. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, mapped, table, written

ROWS, ANCHORS = 2_048, 1_024
STEP = 8
_EXACT = float(1 << 53)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """``id``, ``label``, ``vector`` of the rows that take part, one per id."""
    finite = F.forall(
        F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"),
        F.struct(label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector")).alias("own"),
    )
    least = rows.filter(F.col("own.label").isNotNull()).groupBy("id").agg(F.min("own").alias("own"))
    return least.select("id", "own.label", "own.vector")


def columns_of(vectors: pa.ChunkedArray, scale: float, dims: int = 0) -> np.ndarray:
    """Vectors as whole numbers, a row per dimension; missing components are 0."""
    lists = vectors.combine_chunks()
    offsets = lists.offsets.to_numpy()
    values = np.floor(scale * lists.flatten().to_numpy())
    offsets = offsets - offsets[0]
    size = np.diff(offsets)
    dims = max(dims, int(size.max(initial=0)))
    made = np.zeros((dims, len(size)))
    row = np.repeat(np.arange(len(size)), size)
    made[np.arange(len(values)) - offsets[row], row] = values
    return made


def exact(anchors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if no sum of products can pass 2^53, else as Python's whole numbers."""
    most = [float(np.abs(x).max(initial=0)) for x in (anchors, rows)]
    if max(1, len(rows)) * most[0] * most[1] < _EXACT:
        return anchors, rows
    whole = np.frompyfunc(int, 1, 1)
    return whole(anchors), whole(rows)


def scan(
    anchor: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray, mask: np.ndarray,
    windows: list[tuple], most: int, step: int = STEP,
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``mask`` that may be among the ``most`` highest of a window, with exact scores.

    ``rows`` has a row per dimension, ``low`` and ``high`` the least and greatest value in it.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([anchor * low, anchor * high])[:, order]
    zero = ends[:, :1].sum(axis=1)[:, None] * 0 if ends.size else np.zeros((2, 1))
    left = [np.concatenate([np.cumsum(x[::-1])[::-1], z]) for x, z in zip((ends.min(axis=0), ends.max(axis=0)), zero)]
    alive = np.flatnonzero(mask)
    score = np.zeros(len(alive), dtype=rows.dtype)
    for begin in range(0, len(order), step):
        dims = order[begin : begin + step]
        part = rows[dims] if len(alive) == rows.shape[1] else rows[np.ix_(dims, alive)]
        score = score + anchor[dims] @ part
        end = min(begin + step, len(order))
        least, greatest = score + left[0][end], score + left[1][end]
        stays = np.zeros(len(alive), dtype=bool)
        for bottom, top in windows:
            fits = (greatest >= bottom) & (least <= top)
            sure = least[fits & (least >= bottom) & (greatest <= top)]
            if len(sure) >= most:
                fits &= greatest >= np.sort(sure)[-most]
            stays |= fits
        alive, score = alive[stays], score[stays]
        if not len(alive):
            break
    return alive, score


def first_of(ids: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Places of the highest scores, ties by id."""
    return np.lexsort((ids, -score.astype(np.float64) if score.dtype != object else _ranked(score)))[:most]


def _ranked(score: np.ndarray) -> np.ndarray:
    values = sorted(set(score.tolist()), reverse=True)
    place = {v: i for i, v in enumerate(values)}
    return np.array([place[v] for v in score.tolist()])


def _long(values: list) -> pa.Array:
    ends = (1 << 63) - 1
    return pa.array([max(-ends - 1, min(ends, int(v))) for v in values], pa.int64())


class Block:
    """A block of rows, and the anchors that meet it."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, scale: float):
        both = [columns_of(t["vector"], scale) for t in (anchors, rows)]
        dims = max(map(len, both))
        both = [np.concatenate([x, np.zeros((dims - len(x), x.shape[1]))]) for x in both]
        self.anchors, self.rows = exact(*both)
        self.anchors = self.anchors.T
        self.low, self.high = self.rows.min(axis=1), self.rows.max(axis=1)
        self.ids, self.labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        self.of = list(zip(anchors["id"].to_pylist(), anchors["label"].to_pylist()))

    def find(self, i: int, mask: np.ndarray, windows: list[tuple], most: int):
        return scan(self.anchors[i], self.rows, self.low, self.high, mask, windows, most)


_POSITIVE = "anchor_id long, positive_id long, positive_score long"
_NEGATIVE = f"{_POSITIVE}, negative_id long, negative_score long"


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def positives_of(block: Block, most: int) -> pa.Table:
    """The first rows of each anchor's label in the block."""
    made = []
    for i, (anchor, label) in enumerate(block.of):
        mask = (block.labels == label) & (block.ids != anchor)
        at, score = block.find(i, mask, [(-np.inf, np.inf)], most)
        made += [(anchor, block.ids[at[j]], score[j]) for j in first_of(block.ids[at], score, most)]
    ids, others, scores = zip(*made) if made else ((), (), ())
    return pa.table([pa.array(ids, pa.int64()), pa.array(others, pa.int64()), _long(scores)], _names(_POSITIVE))


def window_of(score: int, least: int, greatest: int) -> tuple[int, int]:
    """Whole scores s with ``least * score <= 100 s <= greatest * score``."""
    return -(-least * score // 100), greatest * score // 100


def negatives_of(block: Block, positives: list[list[dict]], most: int, least: int, greatest: int) -> pa.Table:
    """The first rows of other labels in the window of each positive of each anchor."""
    made = []
    for i, (anchor, label) in enumerate(block.of):
        windows = [window_of(p["score"], least, greatest) for p in positives[i]]
        at, score = block.find(i, block.labels != label, [w for w in windows if w[0] <= w[1]] or [(1, 0)], most)
        for p, (bottom, top) in zip(positives[i], windows):
            inside = np.flatnonzero((score >= bottom) & (score <= top))
            found = inside[first_of(block.ids[at[inside]], score[inside], most)]
            made += [(anchor, p["id"], p["score"], block.ids[at[j]], score[j]) for j in found]
    ids, ps, scores, ns, other = zip(*made) if made else ((),) * 5
    return pa.table(
        [pa.array(ids, pa.int64()), pa.array(ps, pa.int64()), _long(scores), pa.array(ns, pa.int64()), _long(other)],
        _names(_NEGATIVE),
    )


def _dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
    """Each row in its block, once for every block of the other side."""
    block = F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int")
    return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))


def first_rows(df: DataFrame, keys: list[str], score: str, other: str, most: int) -> DataFrame:
    """The first rows of each key with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), other)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine(
    vectors: DataFrame, label: Column, is_anchor: Column, n_positive: int = 5, n_negative: int = 10,
    least: int = 30, greatest: int = 90, scale: float = 256.0,
    id_col: str = "vec_id", vector_col: str = "embedding", rows_block: int = ROWS, anchors_block: int = ANCHORS,
) -> DataFrame:
    """Per anchor and positive its first negatives: ids, ``rank`` from 1 and both scores.

    ``label`` is an expression over ``vectors``, ``is_anchor`` one over the column ``id``. Bounds are
    percents of the positive's score.
    """
    with Scratch(vectors.sparkSession, "negatives") as scratch:
        rows = scratch.keep(usable(vectors, id_col, vector_col, label))
        n, n_anchors = rows.agg(F.count("*"), F.count_if(is_anchor)).first()
        blocks = max(1, -(-n // rows_block)), max(1, -(-n_anchors // anchors_block))
        dealt = _dealt(rows, "r", blocks[0], "a", blocks[1]).groupBy("a", "r")

        def searched(anchors: DataFrame, run, schema: str) -> DataFrame:
            return _dealt(anchors, "a", blocks[1], "r", blocks[0]).groupBy("a", "r").cogroup(dealt).applyInArrow(
                lambda left, right: run(left, right) if len(left) and len(right) else _none(schema), schema
            )

        anchors = rows.filter(is_anchor)
        found = searched(anchors, lambda a, r: positives_of(Block(a, r, scale), n_positive), _POSITIVE)
        first = first_rows(found, ["anchor_id"], "positive_score", "positive_id", n_positive)
        positives = scratch.keep(
            first.groupBy(F.col("anchor_id").alias("id")).agg(
                F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))
                .alias("positives")
            )
        )
        asked = scratch.keep(anchors.join(positives, "id"))
        found = searched(
            asked,
            lambda a, r: negatives_of(Block(a, r, scale), a["positives"].to_pylist(), n_negative, least, greatest),
            _NEGATIVE,
        )
        keys = ["anchor_id", "positive_id"]
        made = first_rows(found, keys, "negative_score", "negative_id", n_negative)
        return written(made.select(*keys, "rank", "negative_id", "positive_score", "negative_score"), "negatives")


def _none(schema: str) -> pa.Table:
    return pa.table({name: pa.array([], pa.int64()) for name in _names(schema)})


def query(spark, sf_dir) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), label, F.col("id") % 100 == 0)


SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(coalesce(list_sum([p[1] * p[2] FOR p IN list_zip(a.q, b.q)]), 0) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS place
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE place <= 10
"""
