"""Quality rules: a table of thresholds compiled into one Spark projection.

``measure`` counts, ``compile_rules`` turns the table into one boolean expression and
``judge`` applies it. Only built-in expressions are used; nothing is shuffled.

Defined results: a NULL or empty text has no words, so all counts are 0 and the base
rule fails. Rows are judged one by one, so repeated rows, ties and NULL ids change
nothing; an empty table gives an empty result. Columns besides id and text are not
read, whatever their names. Texts are taken whole: the work on a text of n words is
O(n), and O(n log n) where it repeats a window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, table, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "with",
    "der", "die", "das", "und", "ist", "nicht", "ein", "eine", "von", "zu",
    "le", "la", "les", "de", "des", "et", "en", "un", "une", "que",
    "el", "los", "las", "y", "por", "con", "del", "se", "no", "es",
)


class Rule(NamedTuple):
    """``low <= 1000 * numerator / denominator <= high``; None leaves a side open."""

    name: str
    numerator: str
    denominator: str
    low: int | None
    high: int | None


RULES = (
    Rule("length in words", "n_words", "one", 20_000, 100_000_000),
    Rule("mean word length", "word_chars", "n_words", 2_000, 15_000),
    Rule("symbols per word", "n_symbols", "n_words", None, 100),
    Rule("stop words", "n_stop_words", "n_words", 30, None),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, 500),
    Rule("lines ending in an ellipsis", "n_ellipsis_lines", "n_lines", None, 300),
)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and all counts the rules use."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col), text.alias("text"))
    lines = base.select(
        F.col(id_col),
        words(F.col("text")).alias("words"),
        F.char_length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        F.filter(
            F.split("text", "\n"), lambda line: F.translate(line, SPACES, "") != ""
        ).alias("lines"),
    )
    windows = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    hashed = lines.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")))
        .cast("long")
        .alias("n_ellipsis_lines"),
        F.size(F.filter("words", lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(*STOP_WORDS)))
        .cast("long")
        .alias("n_stop_words"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(windows, lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("hashes"),
    )
    # All hashes distinct: no window repeats. Otherwise the windows themselves are compared.
    keyed = hashed.select(
        "*",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.sort_array(
                F.transform(
                    windows,
                    lambda i: F.struct(
                        F.concat_ws(" ", F.slice("words", i, WINDOW)).alias("k"), i.alias("i")
                    ),
                )
            ),
        )
        .otherwise(F.array().cast("array<struct<k:string,i:int>>"))
        .alias("keyed"),
    )

    def repeated(x: Column, at: Column) -> Column:
        before, after = F.get("keyed", at - 1)["k"], F.get("keyed", at + 1)["k"]
        return x["k"].eqNullSafe(before) | x["k"].eqNullSafe(after)

    starts = F.sort_array(F.transform(F.filter("keyed", repeated), lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(
            (i + WINDOW).alias("end"),
            (acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    return keyed.select(
        F.col(id_col), "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        "n_ellipsis_lines", "n_stop_words", covered.cast("long").alias("n_repeat_words"),
    )


def compile_rules(rules: Sequence[Rule] = RULES) -> Column:
    """One boolean expression in whole numbers: true where every rule holds."""
    checks = [F.lit(True)]
    for rule in rules:
        number = F.lit(1000) * F.col(rule.numerator)
        against = F.lit(1) if rule.denominator == "one" else F.col(rule.denominator)
        if rule.low is not None:
            checks.append(number >= rule.low * against)
        if rule.high is not None:
            checks.append(number <= rule.high * against)
    return reduce(and_, checks)


def judge(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``measure``'s rows with ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.withColumns({"base_failed": failed, "kept": ~failed & compile_rules(rules)})


def rules_sql(rules: Sequence[Rule] = RULES) -> str:
    """The expression of ``compile_rules`` as SQL text."""
    checks = ["true"]
    for rule in rules:
        against = "1" if rule.denominator == "one" else rule.denominator
        if rule.low is not None:
            checks.append(f"1000 * {rule.numerator} >= {rule.low} * {against}")
        if rule.high is not None:
            checks.append(f"1000 * {rule.numerator} <= {rule.high} * {against}")
    return " AND ".join(checks)


COLUMNS = [
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_stop_words", "base_failed", "kept",
]


def query(spark, sf_dir) -> DataFrame:
    return judge(measure(table(spark, sf_dir, "documents"))).select(*COLUMNS)


_CLASS = r"[\x20\x09-\x0D]"
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{_CLASS}+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)),
        lambda x: regexp_replace(x, '{_CLASS}', '', 'g') <> '') AS lines FROM d),
n AS (SELECT r, doc_id, words, len(words) AS n_words,
    length(regexp_replace(text, '{_CLASS}', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(list_filter(lines, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…'))
        AS n_ellipsis_lines,
    len(list_filter(words, lambda x: lower(rtrim(x, '.,;:!?')) IN ({_STOPS}))) AS n_stop_words
    FROM w),
win AS (SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS k
    FROM (SELECT r, words, unnest(range(1, n_words - {WINDOW - 2})) AS i FROM n)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n_repeat_words
    FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM rep) GROUP BY r),
m AS (SELECT n.*, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM n LEFT JOIN cov USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words,
    base_failed, NOT base_failed AND ({rules_sql()}) AS kept FROM b
"""
