"""Counts against plain Python; the compiled table against its rules one by one."""

import re
from collections import Counter

import duckdb

from tickengine.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(hit), n < 20 or 100 * len(hit) > 30 * n)


EDGE = [
    None, "", "   \n\t", "a\x0bb\x0cc\x85d\u3000e", "one\none\n one\n\none\r", "🙂 # * $", "w" * 50_000,
    " ".join("abcdefgh" for _ in range(40)), "x y z a b c d e f " * 3, "a b c d e f g h i a b c d e f g h",
    " ".join(f"w{i}" for i in range(20_000)) + " " + " ".join(f"w{i}" for i in range(12)),
]


def test_counts(docs_of):
    rows = [(i, t) for i, t in enumerate(EDGE)] + [(None, "a b"), (0, None)]
    found = q.judge(q.measure(docs_of(rows))).collect()
    assert len(found) == len(rows)
    for row in found:
        text = "a b" if row["doc_id"] is None else EDGE[row["doc_id"]]
        got = tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == plain(text)
        assert not (row["kept"] and row["base_failed"])


def test_rules_are_compiled(spark):
    names = sorted({n for r in q.RULES for n in (r.numerator, r.denominator)} - {"one"})
    rows = [tuple((7 * i + 3 * j) % 50 + (i % 3) * 40 for j in range(len(names))) for i in range(60)]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))
    for row in frame.select("*", q.compile_rules().alias("ok")).collect():
        good = True
        for rule in q.RULES:
            over = 1 if rule.denominator == "one" else row[rule.denominator]
            good &= rule.low is None or 1000 * row[rule.numerator] >= rule.low * over
            good &= rule.high is None or 1000 * row[rule.numerator] <= rule.high * over
        assert row["ok"] == good


def test_no_user_function_and_no_shuffle(docs_of):
    plan = q.judge(q.measure(docs_of([(1, "a")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_empty_table(docs_of):
    assert q.judge(q.measure(docs_of([]))).count() == 0


def test_query_equals_its_sql(spark, sf_dir):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    wanted = duckdb.sql(q.SQL)
    names = sorted(wanted.columns)
    found = q.query(spark, sf_dir)
    assert sorted(found.columns) == names
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(wanted.project(", ".join(names)).fetchall())


def test_good_documents_are_kept(spark, sf_dir, rows_of):
    good = {d for d, quality in rows_of("labels", "doc_id, quality") if quality == 1}
    found = [r for r in q.query(spark, sf_dir).collect() if r["doc_id"] in good and not r["base_failed"]]
    assert sum(r["kept"] for r in found) == len(found)
