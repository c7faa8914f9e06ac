"""Statistics, normal equations and isotonic curve against plain versions; held-out accuracy."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickengine.llm import quality_classifier as quality

SYMBOLS, BLANKS = "#*$%&|<>@^~_=+\\/{}[]", " \t\n\x0b\x0c\r"


def plain(text):
    raw = text.encode()
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    words, lows = raw.split(), low.split()
    lines = [x for x in raw.split(b"\n") if x.split()]
    seen, again = set(), 0
    for line in lines:
        again += len(line) if line in seen else 0
        seen.add(line)
    n, m = max(1, len(raw)), max(1, len(words))
    letters = sum(chr(b).isascii() and chr(b).isalpha() or b > 127 for b in raw)
    upper = sum(65 <= b <= 90 for b in raw)

    def share(signs):
        return sum(chr(b) in signs for b in raw) / n

    pairs = Counter(zip(lows, lows[1:]))
    return [
        math.log1p(len(raw)), math.log1p(len(words)), math.log1p(len(lines)), sum(map(len, words)) / m,
        math.log1p(max(map(len, words), default=0)), share(SYMBOLS), share(".,;:?"), share("!"), share("0123456789"),
        letters / n, share(BLANKS), upper / max(1, letters),
        sum(sum(65 <= b <= 90 for b in w) > 1 and not any(97 <= b <= 122 for b in w) for w in words) / m,
        sum(any(chr(b) in SYMBOLS for b in w) for w in words) / m, sum(len(w) <= 3 for w in words) / m,
        len(set(lows)) / m, sum(a == b for a, b in zip(lows, lows[1:])) / m,
        max(Counter(lows).values(), default=0) / m, sum(c - 1 for c in pairs.values()) / max(1, len(words) - 1),
        again / n,
    ]


TEXTS = [
    "", " ", "word", "A a a B.\nA a a B.\n\nx y x y x y", "LOUD!! WORDS!! HERE", "a$$$ b### | c | 12 34", "\n\n\n",
    "é ÀÉ ünï 日本 日本", "tab\tone\rtwo\x0bthree", "line\nLine\nline ", "x" * 3_000, "to to to to",
]


def test_statistics_equal_plain_ones(prose):
    texts = [*TEXTS, prose(400, 1), prose(30, 2) + "\n" + prose(30, 2)]
    made = quality.text_statistics([t.encode() for t in texts])
    assert np.allclose(made, [plain(t) for t in texts])


def auc(rows):
    """Chance that a text of label 1 scores higher than one of label 0."""
    ones, zeros = ([s for s, y in rows if y == k] for k in (1, 0))
    return np.mean([(a > b) + (a == b) / 2 for a in ones for b in zeros])


@pytest.mark.parametrize("folder, least", [("sf0.001", 0.85), ("sf0.01", 0.97)])
def test_held_out_accuracy(spark, folder, least):
    sf_dir = f"/root/testdata/{folder}"
    made = quality.query(spark, sf_dir)
    assert made.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = made.filter("held_out").join(labels, "doc_id").select("score", "quality", "predicted").collect()
    assert auc([(r[0], r[1]) for r in rows]) >= least
    assert np.mean([r[1] == r[2] for r in rows]) >= 0.9
    all_ = made.collect()
    assert len(all_) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in all_)


def test_odd_rows_and_equal_texts(spark, docs_of, prose):
    texts = [None, "", *TEXTS, *(prose(40, i) for i in range(20)), prose(60_000, 99), "$$$ ### " * 50]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x"), (3, "word"), (3, "word")]
    labels = spark.createDataFrame(
        [(i, i % 2, "e") for i in range(40)] + [(None, 1, "e"), (5, None, "e"), (6, 7, "e"), (3, 0, "e"), (3, 0, "e")],
        "doc_id long, quality int, stats string",
    )
    made = quality.classify(docs_of(rows), labels, F.lit(True)).collect()
    assert len(made) == len(rows) and all(0 <= r.score <= 1 for r in made)
    score = {}
    for (_, text), r in zip(sorted(rows, key=str), sorted(made, key=lambda r: str((r.id,)))):
        score.setdefault(text or "", set()).add(r.score)
    assert len(score[""]) == 1


def test_without_rows_or_labels(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.classify(docs_of([]), labels, F.lit(True)).count() == 0
    made = quality.classify(docs_of([(1, "a"), (2, None)]), labels, F.lit(True)).collect()
    assert [r.score for r in made] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.classify(docs_of([(1, "a"), (2, "b")]), one, F.lit(True)).collect())


def test_labels_of_held_out_rows_do_not_matter(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held_out = quality._remainder(F.col("id"), 4) == 2
    turned = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    made = [{r.id: round(r.score, 9) for r in quality.classify(docs, x, ~held_out).collect()} for x in (labels, turned)]
    assert made[0] == made[1]


def test_normal_equations_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(0, 1, (300, len(quality.STATS))), rng.integers(0, 2, 300).astype(float)
    turn, shift = quality.projections(len(quality.STATS), 16, 4.0)
    zero, one = np.zeros(len(quality.STATS)), np.ones(len(quality.STATS))
    model = quality.Model(zero, one, turn, shift, np.zeros(17), zero, zero)
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "stats array<double>, y double")
    z = model.features(x)
    for n in (1, 7):
        made = quality.normal_equations(rows.repartition(n), model)
        assert np.allclose(made[:, :-1], z.T @ z) and np.allclose(made[:, -1], z.T @ y)


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (30, 5))
    turn, shift = quality.projections(5, 20_000, 2.0)
    z = np.cos(x @ turn + shift) * np.sqrt(2 / 20_000)
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-distance / 8)).max() < 0.04


def test_pools_equal_a_search_over_all_cuts():
    rng = np.random.default_rng(7)
    for _ in range(100):
        n = int(rng.integers(1, 9))
        total = rng.integers(1, 5, n).astype(float)
        ones = np.array([rng.integers(0, t + 1) for t in total], dtype=float)
        at, share = quality.pooled(total, ones, np.arange(n, dtype=float))
        assert (np.diff(share) > 0).all() and (np.diff(at) > 0).all()
        # The max-min formula of isotonic regression.
        best = [
            max(min(ones[a:b].sum() / total[a:b].sum() for b in range(i + 1, n + 1)) for a in range(i + 1))
            for i in range(n)
        ]
        assert np.allclose(sorted(set(np.round(best, 9))), share)
