"""The corpus pipeline: five stages over ``documents``, each of them one operator of ``llm``.

A stage takes ``(spark, docs, sf_dir)`` and gets what its predecessor kept; ``run`` writes
each stage's result as Parquet in the shared folder and reads it for the next. All stages
but the last return the columns of ``documents``.

Defined results: rows whose text has no letter, or no language with at least half of its
letters, leave in the first stage. Rows that are told apart by nothing (equal id and text)
are one row after the second stage; of other groups of near copies (five words, 0.8) the
row of the smallest id stays, NULL ids last, then that of the smallest text hash. Rows that
hold a benchmark item leave in the third; a row leaves or stays with all others of its id
and text. The fourth replaces secrets in the texts and counts ``n_chars`` anew where that
column exists. Empty tables pass through. Extra columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickengine.llm import bpe, decontaminate, language_id, minhash, secrets
from tickengine.llm.common import table, written

LEAST_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that are mostly in one language; the label ``lang`` only trains."""
    return language_id.keep_identified(docs, language_id.train(docs), LEAST_SHARE)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies."""
    return minhash.keep_first(docs, size=5, percent=80)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets replaced in the text."""
    hidden = secrets.redact(docs, secrets.train(docs))
    if "n_chars" not in hidden.columns:
        return hidden
    kind = docs.schema["n_chars"].dataType
    return hidden.withColumn("n_chars", F.char_length("text").cast(kind))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row."""
    return bpe.encode_texts(docs, bpe.vocabulary(), with_ids=True)


STAGES = [
    ("language ID", identify_language),
    ("near copies", remove_near_copies),
    ("benchmark leaks", remove_leaks),
    ("secrets", hide_secrets),
    ("BPE", encode),
]

# The language model, MinHash and BPE have no SQL; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
