"""Hard negatives against plain loops over all rows."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickengine.llm import hard_negatives

NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string, positives string, a string, r string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, *"zzzzz") for r in rows], SCHEMA)


def brute(rows, every=100):
    """Rows of (id, vector, label) as loops, with whole numbers of any size."""
    known = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        known[i] = min(known.get(i, (label, v)), (label, v))
    full = {i: (label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, (label, v) in known.items()}
    made = []
    for a, (label, q) in full.items():
        if a % every:
            continue
        scores = [(-sum(x * y for x, y in zip(q, v)), i, other) for i, (other, v) in full.items() if i != a]
        scores.sort()
        for neg, p, _ in [s for s in scores if s[2] == label][:5]:
            ps = -neg
            inside = [(-s, i) for s, i, other in scores if other != label and 30 * ps <= -100 * s <= 90 * ps]
            made += [(a, p, rank, i, ps, s) for rank, (s, i) in enumerate(inside[:10], 1)]
    return sorted(made)


def found(df):
    return sorted(tuple(r) for r in df.select(*NAMES).collect())


def mined(spark, rows, **sizes):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return found(hard_negatives.mine(vectors_of(spark, rows), label, F.col("id") % 100 == 0, **sizes))


def test_query_equals_sql_and_loops(spark, sf_dir, rows_of):
    made = found(hard_negatives.query(spark, sf_dir))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    assert made == sorted(con.sql(f"SELECT {', '.join(NAMES)} FROM ({hard_negatives.SQL})").fetchall())
    assert made == brute(rows_of("embeddings", "vec_id, embedding, label"))


@pytest.mark.parametrize("sizes", [{}, {"rows_block": 40, "anchors_block": 2}])
def test_ties_copies_and_bad_rows(spark, sizes):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 12)], i % 3) for i in range(400)]
    hot = rows[200][1]
    rows += [(1_000 + i, hot, 1 + i % 2) for i in range(150)]  # many equal vectors, in two labels
    rows += [(2_000 + i, [x * 0.6 for x in hot], 5) for i in range(30)]  # ties inside the window
    rows += [(2_100, None, 1), (2_101, [1.0, None], 1), (2_102, [float("nan")], 1), (2_103, [float("inf")], 1),
             (2_104, [0.5] * 12, None), (None, hot, 2), (2_200, [], 3), (2_300, [0.25], 1), (2_301, [0.0] * 20, 2),
             rows[300], rows[300], (300, hot, 9), (-100, hot, 4)]
    expected = brute(rows)
    assert len(expected) > 100
    assert mined(spark, rows, **sizes) == expected


def test_scores_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 3e6, 6)], i % 2) for i in range(120)]
    assert mined(spark, rows) == brute(rows)
    huge = [(i, [3e38, 1.0 + i], i % 2) for i in range(20)]
    assert all(abs(r[4]) < 1 << 63 for r in mined(spark, [(0, [3e38], 1), *huge[1:]]))


def test_empty_and_alone(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(None, None, None)]) == []


def test_scan_drops_candidates_and_loses_none():
    rng = np.random.default_rng(4)
    rows = np.floor(256 * rng.normal(0, 0.1, (64, 3_000)))
    anchor = np.floor(256 * rng.normal(0, 0.02, 64))
    anchor[:6] *= 40  # some dimensions decide
    score = anchor @ rows
    order = np.sort(score)
    windows = [(order[-400], order[-50]), (order[-900], order[-300])]
    low, high = rows.min(axis=1), rows.max(axis=1)
    at, got = hard_negatives.scan(anchor, rows, low, high, np.ones(3_000, dtype=bool), windows, 10)
    assert (got == score[at]).all() and len(at) < 100
    for bottom, top in windows:
        inside = np.flatnonzero((score >= bottom) & (score <= top))
        best = np.sort(score[inside])[-10]
        assert set(inside[score[inside] >= best]) <= set(at)


def test_windows_are_whole_numbers():
    for score in range(-200, 200):
        bottom, top = hard_negatives.window_of(score, 30, 90)
        inside = [s for s in range(-300, 300) if 30 * score <= 100 * s <= 90 * score]
        assert inside == list(range(bottom, top + 1))
