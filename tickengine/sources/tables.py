"""Date-partitioned tables on Spark's own writers and readers, and their DDL.

A table is a Parquet folder partitioned by ``date_partition``. Appended rows carry the name of
their batch in ``batch_id``, so a batch that is written again can replace itself. Everything
that changes rows already written - a repeated batch, an upsert, a compaction - reads the dates
it touches and writes them back with Spark's dynamic partition overwrite, which swaps
the date's folder when all tasks are done.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickengine.functions import times
from tickengine.schemas import RAW_COMMENTS, RAW_SCHEMA, vwap_comments, vwap_schema

# --- writing -----------------------------------------------------------------------


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` first (NULL where absent), then the new ones of ``df``."""
    known = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return df.select(*known, *[c for c in df.columns if c not in schema.fieldNames()])


def overwrite_dates(
    df: DataFrame, root: str, *, rebalance: bool = True, fmt: str = "parquet", **options: str
) -> None:
    """Replace the dates that ``df`` has rows of, and no others; ``df`` may read the same table."""
    if rebalance:
        df = df.hint("rebalance", "date_partition")
    (
        df.write.format(fmt)
        .mode("overwrite")
        .options(partitionOverwriteMode="dynamic", **options)
        .partitionBy("date_partition")
        .save(root)
    )


def write_batch(
    df: DataFrame,
    root: str,
    batch_id: str | int | None = None,
    *,
    rebalance: bool = True,
    fmt: str = "parquet",
    written_before: bool = True,
) -> str:
    """Append a batch and return its name; writing a batch of the same name again replaces it.

    Without a name the batch gets a new one. A named batch is looked for in the dates it has
    rows of, which must be the same each time; ``written_before=False`` says that it cannot be
    there and saves the look. ``rebalance`` gathers the rows of a date into files of the advisory
    partition size, and AQE splits a date that is too large for one.
    """
    name = uuid.uuid4().hex if batch_id is None else str(batch_id)
    rows = df.withColumn("batch_id", F.lit(name))
    if batch_id is not None and written_before:
        same = stored_dates(df.sparkSession, root, days_of(rows), fmt=fmt)
        if same is not None and "batch_id" in same.columns:
            if not same.filter(F.col("batch_id") == name).isEmpty():
                others = same.filter(~F.col("batch_id").eqNullSafe(name))
                overwrite_dates(others.unionByName(rows, allowMissingColumns=True), root, rebalance=rebalance, fmt=fmt)
                return name
    if rebalance:
        rows = rows.hint("rebalance", "date_partition")
    rows.write.format(fmt).mode("append").partitionBy("date_partition").save(root)
    return name


def days_of(df: DataFrame) -> list[dt.date | None]:
    """The dates that ``df`` has rows of, as many as there are days in it."""
    return [r[0] for r in df.select("date_partition").distinct().collect()]


def on_days(days: list[dt.date | None]) -> F.Column:
    """A condition on ``date_partition``."""
    return F.col("date_partition").isin([d for d in days if d is not None]) | (
        F.col("date_partition").isNull() if None in days else F.lit(False)
    )


def upsert(
    df: DataFrame,
    root: str,
    keys: tuple[str, ...] = ("window_start", "ticker"),
    *,
    fmt: str = "parquet",
) -> None:
    """Write rows by key: new keys are added, known ones replaced.

    The dates that ``df`` has rows of are read, united with it and written back, so a batch costs
    the size of these dates, whatever the table holds beside them. All versions of a key lie in one date. Within ``df`` keys must be
    unique. Writing the same rows again changes nothing.
    """
    stored = stored_dates(df.sparkSession, root, days_of(df), fmt=fmt)
    if stored is None:
        overwrite_dates(df, root, fmt=fmt)
        return
    versions = stored.withColumn("_version", F.lit(0)).unionByName(
        df.withColumn("_version", F.lit(1)), allowMissingColumns=True
    )
    merged = latest_rows(versions, ["date_partition", *keys], "_version")
    overwrite_dates(merged.select([c for c in versions.columns if c != "_version"]), root, fmt=fmt)


def dump_messages(messages: DataFrame, path: str, *, rebalance: bool = True) -> None:
    """Append messages (``raw_value``) as they were sent, one folder per date and ticker.

    Ticker and time only choose the folder. A message without a readable time is filed
    under today, one without a ticker under the default folder; none is left out.
    """
    day = F.to_date(F.coalesce("event_time", F.current_timestamp()))
    filed = messages.select(F.col("raw_value").alias("value"), day.alias("_date"), F.col("ticker").alias("_ticker"))
    filed = filed.filter(F.col("value").isNotNull())
    if rebalance:
        filed = filed.hint("rebalance", "_date", "_ticker")
    filed.write.mode("append").partitionBy("_date", "_ticker").text(path)


def dump_jsonl(
    ticks: DataFrame, path: str, *, time: str = "timestamp", rebalance: bool = True
) -> None:
    """Append ticks as JSON lines, one folder per date and ticker.

    The folder columns are copies, hence ``ticker`` stays in the JSON. A tick without
    a time is filed under today.
    """
    day = F.to_date(F.coalesce(F.try_to_timestamp(F.col(time).cast("string")), F.current_timestamp()))
    filed = ticks.withColumns({"_date": day, "_ticker": F.col("ticker")})
    if rebalance:
        filed = filed.hint("rebalance", "_date", "_ticker")
    to_micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    (
        filed.write.mode("append")
        .options(timestampFormat=to_micros, timestampNTZFormat=to_micros)
        .partitionBy("_date", "_ticker")
        .json(path)
    )


# --- reading -----------------------------------------------------------------------


# How Spark says that a table's folder is not there, or holds no file.
NOTHING_STORED = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def stored_rows(spark: SparkSession, root: str, *, fmt: str = "parquet", merge_schema: bool = True) -> DataFrame | None:
    """A table as it is, or None where nothing was written yet."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    try:
        return reader.load(root)
    except AnalysisException as error:
        if error.getCondition() in NOTHING_STORED:
            return None
        raise


# The folder of rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _folder(root: str, day: dt.date | None) -> str:
    return f"{root}/date_partition={NO_DATE if day is None else day}"


def table_days(spark: SparkSession, root: str) -> list[dt.date]:
    """The dates a table has folders of, oldest first: one listing of its root, no file is looked at."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = (status.getPath().getName() for status in files.listStatus(path))
    days = (name.removeprefix("date_partition=") for name in names if name.startswith("date_partition="))
    return sorted(dt.date.fromisoformat(day) for day in days if day != NO_DATE)


def stored_dates(
    spark: SparkSession,
    root: str,
    days: list[dt.date | None],
    *,
    fmt: str = "parquet",
    merge_schema: bool = True,
) -> DataFrame | None:
    """The rows of some dates, or None where the table has none of them.

    Only the folders of these dates are listed, and only their footers read for the schema, so
    the cost of a micro-batch does not follow the age of its table. Formats that keep a
    log of their files are read by it.
    """
    if fmt != "parquet":
        stored = stored_rows(spark, root, fmt=fmt, merge_schema=merge_schema)
        return None if stored is None else stored.filter(on_days(days))
    conf = spark._jsc.hadoopConfiguration()
    folders = [spark._jvm.org.apache.hadoop.fs.Path(_folder(root, day)) for day in days]
    found = [_folder(root, day) for day, path in zip(days, folders) if path.getFileSystem(conf).exists(path)]
    if not found:
        return None
    reader = spark.read.option("basePath", root).option("mergeSchema", str(merge_schema).lower())
    try:
        rows = reader.parquet(*found)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # folders without a file
            return None
        raise
    return rows.withColumn("date_partition", F.col("date_partition").cast("date"))


def newest(
    spark: SparkSession, root: str, column: str, *, apart_from: str | None = None, fmt: str = "parquet"
) -> dt.datetime | None:
    """The greatest ``column``, one that grows with the date, read from the newest date that has any.

    ``apart_from`` names a batch that does not count.
    """

    def most(rows: DataFrame):
        if apart_from is not None:
            rows = rows.filter(~F.col("batch_id").eqNullSafe(apart_from))
        return rows.agg(F.max(column)).first()[0]

    if fmt != "parquet":
        rows = stored_rows(spark, root, fmt=fmt)
        return None if rows is None else most(rows)
    for day in reversed(table_days(spark, root)):
        rows = stored_dates(spark, root, [day])
        found = None if rows is None else most(rows)
        if found is not None:
            return found
    return None


def read_table(
    spark: SparkSession,
    root: str,
    *,
    date=None,
    first=None,
    last=None,
    with_batch: bool = False,
    merge_schema: bool = True,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """The rows of a table, of one ``date`` or of the dates ``first`` to ``last``.

    Dates prune partitions. Columns that only some files have are NULL in the others;
    ``merge_schema=False`` saves the look into all file footers where no column was added.
    ``with_batch`` keeps the names of the batches. With a ``schema``, a table that nothing was
    written to yet has no rows, of these columns; without, reading it is an error.
    """
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    try:
        rows = reader.load(root)
    except AnalysisException as error:
        if schema is None or error.getCondition() not in NOTHING_STORED:
            raise
        rows = spark.createDataFrame([], schema)
    if date is not None:
        first = last = date
    if first is not None:
        rows = rows.filter(F.col("date_partition") >= F.lit(str(first)).cast("date"))
    if last is not None:
        rows = rows.filter(F.col("date_partition") <= F.lit(str(last)).cast("date"))
    return rows if with_batch else rows.drop("batch_id")


def latest_rows(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The newest version of each key.

    ``max_by`` per column merges before the shuffle, so a key that was written many
    times reaches it once per task. Within a version a key must be unique.
    """
    values = [c for c in rows.columns if c not in (*keys, version)]
    return rows.groupBy(*keys).agg(*[F.max_by(c, version).alias(c) for c in values])


def versions_as_of(
    versions: DataFrame, as_of, keys: tuple[str, ...] = ("window_start", "ticker"), *, known_at: str = "known_at"
) -> DataFrame:
    """A keyed table as it was known at a moment, from a table that keeps every version of a row.

    Per key the version that became known last, not after ``as_of``; keys unknown by then have no row.
    """
    moment = times.moment(as_of, times.time_type(versions, known_at))
    known = versions.filter(F.col(known_at) <= moment)
    if "date_partition" in versions.columns:
        keys = ("date_partition", *keys)
    return latest_rows(known, list(keys), known_at).select([c for c in versions.columns if c != known_at])


# --- DDL ---------------------------------------------------------------------------

# Table properties where the format is ``delta``.
RAW_DELTA = {
    "delta.autoOptimize.optimizeWrite": "true",
    "delta.autoOptimize.autoCompact": "true",
    "delta.dataSkippingNumIndexedCols": "4",
}
VWAP_DELTA = {"delta.autoOptimize.optimizeWrite": "true"}


def _create(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    comments: dict[str, str],
    location: str,
    fmt: str,
    properties: dict[str, str],
) -> None:
    def column(f: T.StructField) -> str:
        told = f" COMMENT '{comments[f.name]}'" if f.name in comments else ""
        return f"{f.name} {f.dataType.simpleString()}{told}"

    columns = ", ".join(map(column, schema))
    told = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} "
        f"PARTITIONED BY (date_partition) LOCATION '{location}'"
        + (f" TBLPROPERTIES ({told})" if told else "")
    )


def create_raw(
    spark: SparkSession,
    name: str,
    location: str,
    *,
    fmt: str = "parquet",
    properties: dict[str, str] | None = None,
) -> None:
    """The raw tick table in the catalog, partitioned by date, with a comment for each column.

    ``location`` may be the root of a table that streams write; ``find_dates`` shows its dates.
    """
    if properties is None:
        properties = RAW_DELTA if fmt == "delta" else {}
    _create(spark, name, RAW_SCHEMA, RAW_COMMENTS, location, fmt, properties)


def create_vwap(
    spark: SparkSession,
    name: str,
    location: str,
    *,
    suffix: str = "1m",
    fmt: str = "parquet",
    properties: dict[str, str] | None = None,
) -> None:
    """The VWAP table of one window length, partitioned by the date of its start."""
    if properties is None:
        properties = VWAP_DELTA if fmt == "delta" else {}
    _create(spark, name, vwap_schema(suffix), vwap_comments(suffix), location, fmt, properties)


def find_dates(spark: SparkSession, name: str) -> None:
    """Make the dates that were written to a table's folder since the last time visible by name."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def insert_into(df: DataFrame, name: str, *, overwrite_dates: bool = False) -> None:
    """Write into a catalog table by column name, appending or replacing dates.

    ``insertInto`` takes the overwrite mode from the session only; without it, replacing
    some dates would remove all others.
    """
    spark = df.sparkSession
    table = spark.table(name)
    ready = align_schema(df, table.schema).select(*table.columns).hint("rebalance", "date_partition")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        ready.write.insertInto(name, overwrite=overwrite_dates)
    finally:
        spark.conf.set(mode, before)


def register_views(spark: SparkSession, **tables: DataFrame) -> None:
    """Make tables usable in SQL text, such as the stock queries, by these names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
