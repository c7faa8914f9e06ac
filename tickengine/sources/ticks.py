"""Batch reads of ticks: tables by name or path, and the shipped test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_named(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the catalog."""
    return spark.table(name)


def read_path(
    spark: SparkSession, path: str, fmt: str = "parquet", *, merge_schema: bool = False
) -> DataFrame:
    """A table by path, in any installed format (``delta`` where it is deployed).

    ``merge_schema`` shows columns that only newer files have; it reads all footers.
    """
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def ticks_from_events(events: DataFrame) -> DataFrame:
    """The ``events`` table seen as ticks.

    The type of the time column is kept, so that filters on it reach the scan; a
    stream needs TIMESTAMP for its watermark and gets it.
    """
    time = F.col("ts").cast("timestamp") if events.isStreaming else F.col("ts")
    return events.select(
        F.col("event_type").alias("ticker"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("volume"),
        F.lit(None).cast("double").alias("market_cap"),
        time.alias("event_time"),
        F.lit(None).cast("string").alias("exchange"),
        "event_id",
    )


def ticks_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The ``lineitem`` table seen as ticks: three tickers and whole days."""
    return lineitem.select(
        F.col("l_returnflag").alias("ticker"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("long").alias("volume"),
        F.col("l_shipdate").alias("event_time"),
    )


def list_files(spark: SparkSession, path: str | list[str], *, pattern: str = "*", uri: bool = False) -> DataFrame:
    """Path, modification time and length of the files below a folder, or several.

    With ``uri`` also ``file``, the path as ``_metadata.file_path`` of any reader tells it. The contents are not read. The listing stays a DataFrame; a separate session
    packs many files into one task, since a task only asks for their status.
    """
    listing = spark.newSession()
    listing.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 42))
    listing.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
    listing.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return (
        listing.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "modificationTime", "length", *([F.col("_metadata.file_path").alias("file")] if uri else []))
    )
