"""Small helpers of the operators: reading tables, written intermediate tables, free names."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickengine.session import new_dir

# What separates words: the blank and the control characters from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: its lineage ends here."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written intermediate tables of one operator, dropped when its result is written.

    They lie in the shared folder, so a lost executor loses nothing of them.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.n = spark, new_dir(spark, label), 0

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


# Bytes in one batch for Python: a worker's memory does not follow the length of texts.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _tidy(run: Callable) -> Callable:
    """``run``, giving freed memory back at the end of a partition, as workers are used again."""

    def tidied(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # a C library of another kind
            ctypes.CDLL(None).malloc_trim(0)

    return tidied


def mapped(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` in batches of bounded size.

    The package is put on the path of Python workers that lack it. Where executors have
    other folders, ship it with ``--py-files`` as usual. The session's limit of bytes in a
    batch is lowered where it is Spark's default.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH) == "67108864b":
        conf.set(_BATCH, str(BATCH_BYTES))
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = df.sparkSession.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, home])
    return df.mapInArrow(_tidy(run), schema)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name in any case."""
    taken = {name.lower() for name in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def words(text: Column) -> Column:
    """The words of a text: maximal runs without the characters of ``SPACES``."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def sampled(docs: DataFrame, most: int, *keys: str, seed: int = 17) -> DataFrame:
    """About ``most`` rows of ``docs``, chosen by a hash of ``keys``; all rows if there are fewer.

    For fitting models only. Rows that repeat in ``keys`` are taken once.
    """
    n = docs.count()
    if n <= most:
        return docs
    share = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000))
    return docs.filter(share < int(1_000_000 * most / n)).dropDuplicates([*keys])
