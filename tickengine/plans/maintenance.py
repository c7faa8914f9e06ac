"""Table maintenance as Spark jobs: compaction, clustering, retention, what was loaded.

Rewrites are meant for closed dates, i.e. dates older than the stream's watermark: they read
the dates and write them back, so a batch that arrives in between would be lost.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickengine.functions import times
from tickengine.functions.clustering import with_z_value
from tickengine.sources.tables import on_days, overwrite_dates, read_table, stored_dates, write_batch
from tickengine.sources.ticks import list_files

logger = logging.getLogger(__name__)

TARGET_FILE_BYTES = 512 * 1024 * 1024
# A file of the target size has about 32 row groups, in memory a few more bytes each.
ROW_GROUP_BYTES = 16 * 1024 * 1024
RETENTION_HOURS = 168  # Fixed value: seven days.
REWRITES = "rewrite-"  # begins the folders that ``compact_beside`` makes


class MaintenanceError(RuntimeError):
    """The maintenance of a table failed."""


def table_files(spark: SparkSession, root: str, date=None) -> DataFrame:
    """Data files of a table, or of one of its dates, with the date that their path tells."""
    place = root if date is None else f"{root}/date_partition={date}"
    day = F.regexp_extract("path", r"/date_partition=(\d{4}-\d{2}-\d{2})/", 1)
    return list_files(spark, place).select(
        "path", "modificationTime", "length", F.nullif(day, F.lit("")).cast("date").alias("date_partition")
    )


def listed_files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All data files below the root of a catalog table, and whether readers of the table use them.

    ``is_live`` files lie where the catalog's partitions are; ``rewritten`` ones were made by ``compact_beside``.
    """
    live = spark.table(name).select(F.col("_metadata.file_path").alias("file")).distinct()
    day = F.regexp_extract("path", r"/date_partition=(\d{4}-\d{2}-\d{2})/", 1)
    return list_files(spark, root, pattern="*.parquet", uri=True).join(live.withColumn("_live", F.lit(True)), "file", "left").select(
        "file", "path", "modificationTime", "length", F.nullif(day, F.lit("")).cast("date").alias("date_partition"),
        F.col("_live").isNotNull().alias("is_live"), F.col("path").contains(f"/{REWRITES}").alias("rewritten"),
    )


def file_batches(spark: SparkSession, root: str) -> DataFrame:
    """The batches that have rows in each data file below a root, live or not: (``file``, ``batch_id``)."""
    rows = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(root)
    return rows.select(F.col("_metadata.file_path").alias("file"), "batch_id").distinct()


def _closed(spark: SparkSession, before: dt.date | None):
    """The session's current date, or a given one: dates before it are closed."""
    return F.current_date() if before is None else F.lit(str(before)).cast("date")


def _sizes(files: DataFrame, target_bytes: int) -> DataFrame:
    """Per date its files, bytes and the files it would need."""
    needed = F.greatest(F.lit(1), F.ceil(F.sum("length") / target_bytes))
    return files.groupBy("date_partition").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), needed.alias("needed")
    )


def _chosen(
    spark: SparkSession, root: str, date, before: dt.date | None, min_files: int, target_bytes: int
) -> dict[dt.date, int]:
    """The dates to rewrite, oldest first, with the files that each needs; a given date always."""
    return _needed(spark, table_files(spark, root, date), date, before, min_files, target_bytes)


def _needed(
    spark: SparkSession, files: DataFrame, date, before: dt.date | None, min_files: int, target_bytes: int
) -> dict[dt.date, int]:
    """The same, of a table's files."""
    found = _sizes(files, target_bytes)
    if date is not None:
        found = found.filter(F.col("date_partition") == F.lit(str(date)).cast("date"))
    else:
        found = found.filter(F.col("date_partition") < _closed(spark, before))
        if min_files > 1:
            found = found.filter(F.col("files") >= min_files * F.col("needed"))
    rows = found.select("date_partition", "needed").orderBy("date_partition").collect()
    return {r["date_partition"]: r["needed"] for r in rows}


def dates_to_rewrite(
    spark: SparkSession,
    root: str,
    before: dt.date | None = None,
    *,
    min_files: int = 2,
    target_bytes: int = TARGET_FILE_BYTES,
) -> list[dt.date]:
    """Closed dates with at least ``min_files`` times the files they need, oldest first; with 1 all."""
    return list(_chosen(spark, root, None, before, min_files, target_bytes))


def _rows_of(spark: SparkSession, root: str, dates: list[dt.date]) -> DataFrame:
    """All rows of some dates, batches included."""
    return stored_dates(spark, root, dates)


def _gathering(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session of its own, because the size of what is gathered is a setting."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return session


def _tell(spark: SparkSession, log: str | None, operation: str, root: str, dates: list[dt.date]) -> None:
    """Append to the table ``log`` what an operation wrote: a row per date, with its rows and files."""
    if log is None or not dates:
        return
    told = _rows_of(spark, root, dates).groupBy(F.col("date_partition").alias("date_rewritten")).agg(
        F.count(F.lit(1)).alias("rows_written"), F.count_distinct("_metadata.file_path").alias("files_written")
    )
    now = F.current_timestamp()
    told = told.withColumns({"operation": F.lit(operation), "root": F.lit(root), "at": now, "date_partition": F.to_date(now)})
    write_batch(told, log)


def operations(spark: SparkSession, log: str) -> DataFrame:
    """What ``compact`` and ``zorder`` did, by the log they were given: a row per operation and date."""
    return read_table(spark, log).select("at", "root", "operation", "date_rewritten", "rows_written", "files_written")


def compact(
    spark: SparkSession,
    root: str,
    date=None,
    *,
    before: dt.date | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    min_files: int = 2,
    log: str | None = None,
) -> list[dt.date]:
    """Merge the small files of a date, or of all closed dates in one job; returns the dates.

    Rows of a date are gathered into files of about ``target_bytes`` as shuffled. ``log`` is a
    table that keeps what was done, see ``operations``.
    """
    dates = list(_chosen(spark, root, date, before, min_files, target_bytes))
    if dates:
        overwrite_dates(_rows_of(_gathering(spark, target_bytes), root, dates), root)
        _tell(spark, log, "COMPACT", root, dates)
    return dates


def compact_beside(
    spark: SparkSession,
    root: str,
    name: str,
    date=None,
    *,
    before: dt.date | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    min_files: int = 2,
) -> list[dt.date]:
    """Merge the small files of a catalog table's dates in a new folder, and point its partitions there.

    The files replaced stay for readers that have begun; ``replaced_files`` lists them and ``vacuum``
    removes them. From then on the table is to be read and written by its name, not by its root.
    """
    live = listed_files(spark, root, name).filter("is_live")
    dates = list(_needed(spark, live, date, before, min_files, target_bytes))
    if dates:
        place = f"{root}/{REWRITES}{uuid.uuid4().hex}"
        rows = _gathering(spark, target_bytes).table(name).filter(on_days(dates))
        rows.hint("rebalance", "date_partition").write.partitionBy("date_partition").parquet(place)
        for day in dates:
            spark.sql(f"ALTER TABLE {name} PARTITION (date_partition='{day}') SET LOCATION '{place}/date_partition={day}'")
        spark.catalog.refreshTable(name)
    return dates


def replaced_files(
    spark: SparkSession, root: str, name: str, *, as_of=None, retention_hours: int = RETENTION_HOURS
) -> DataFrame:
    """Files of a catalog table that no reader uses any more, and that were replaced before the retention.

    A file counts as replaced when the oldest live file of its date was written, or when it was
    itself, if that is later; a rewrite that is running is protected by that.
    """
    files = listed_files(spark, root, name)
    since = files.filter("is_live").groupBy(F.col("date_partition").alias("_day")).agg(
        F.min("modificationTime").alias("_since")
    )
    limit = times.moment(as_of, times.time_type(files, "modificationTime")) - times.interval(f"{retention_hours} hours")
    found = files.filter("NOT is_live").join(since, F.col("date_partition").eqNullSafe(F.col("_day")), "left")
    return found.filter(F.greatest("modificationTime", "_since") <= limit).drop("_day", "_since", "is_live")


def vacuum(
    spark: SparkSession, root: str, name: str, *, as_of=None, retention_hours: int = RETENTION_HOURS, dry_run: bool = True
) -> list[str]:
    """List the files that ``replaced_files`` has; with ``dry_run=False`` remove them."""
    found = replaced_files(spark, root, name, as_of=as_of, retention_hours=retention_hours)
    paths = [r[0] for r in found.select("path").orderBy("path").collect()]
    if not dry_run:
        for each in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(each)
            if not path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False):
                raise MaintenanceError(f"{each} could not be deleted")
    return paths


def clustered(
    rows: DataFrame,
    columns: list[str],
    files: int,
    *,
    keys: list[str] | None = None,
    bits: int = 8,
) -> DataFrame:
    """Rows in about ``files`` ranges of the date and the clustering columns, sorted within each.

    One column is a plain range; several are woven into a Z value. A hot value would
    be one range, so finer columns follow: the unique ``keys`` if there are any, else
    the event time and a running number, which also spreads copies of one row.
    (The number is stable when a task is repeated, as rows without keys come straight
    from files.)
    """
    helpers = []
    if len(columns) > 1:
        rows = with_z_value(rows, columns, bits=bits)
        helpers.append("_z")
    finer = keys or (["event_time"] if "event_time" in rows.columns else [])
    day = ["date_partition"] if "date_partition" in rows.columns else []
    order = [*day, *helpers, *columns, *[c for c in finer if c not in columns]]
    split = list(order)
    if not keys:
        rows = rows.withColumn("_row", F.monotonically_increasing_id())
        helpers.append("_row")
        split.append("_row")
    return rows.repartitionByRange(files, *split).sortWithinPartitions(*order).drop(*helpers)


def zorder(
    spark: SparkSession,
    root: str,
    date=None,
    columns: list[str] | None = None,
    *,
    before: dt.date | None = None,
    keys: list[str] | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    bits: int = 8,
    min_files: int = 1,
    row_group_bytes: int = ROW_GROUP_BYTES,
    log: str | None = None,
) -> list[dt.date]:
    """Rewrite a date, or all closed dates in one job, clustered by ``columns`` (default: ticker).

    Files hold several row groups, sorted, with the least and greatest value of each column, and Bloom
    filters for clustering columns of text: readers skip the groups that cannot hold a value,
    also one that lies between least and greatest. Dates of one file's size are gathered and sorted; the rows of larger ones are dealt into as many
    ranges of the date and the clustering columns as they need files.
    """
    needed = _chosen(spark, root, date, before, min_files, target_bytes)
    if needed:
        by = columns or ["ticker"]
        small = [day for day, n in needed.items() if n == 1]
        large = {day: n for day, n in needed.items() if n > 1}
        parts = []
        if small:
            rows = _rows_of(spark, root, small)
            finer = [c for c in [*(keys or []), "event_time"] if c in rows.columns and c not in by]
            parts.append(rows.hint("rebalance", "date_partition").sortWithinPartitions("date_partition", *by, *finer))
        if large:
            rows = _rows_of(spark, root, list(large))
            parts.append(clustered(rows, by, sum(large.values()), keys=keys, bits=bits))
        made = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        texts = [c for c in by if made.schema[c].dataType == T.StringType()]
        skipping = {f"parquet.bloom.filter.enabled#{c}": "true" for c in texts}
        overwrite_dates(made, root, rebalance=False, **skipping, **{"parquet.block.size": str(row_group_bytes)})
        _tell(spark, log, f"ZORDER BY ({', '.join(by)})", root, list(needed))
    return list(needed)


# Types whose least and greatest value Spark takes from footers; texts may be cut off there.
_IN_FOOTERS = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


def statistics(spark: SparkSession, root: str, columns: list[str], *, scan: bool = False) -> DataFrame:
    """Per date: ``rows``, and of each column ``<name>_count``, ``_min`` and ``_max``, from the footers alone.

    Spark's Parquet reader takes counts and bounds from the row groups' statistics where they are
    all that is asked for, so a date costs its footers, however many rows it has. That holds for
    numbers, dates and booleans; other types are an error. A row group in which a column is NULL
    throughout, or holds a NaN, or a file without the column, has no bounds, and Spark ends with
    an error that says so: ``scan`` reads the columns instead, with the same results, of any type.
    A session of its own, as the reader and the push-down are settings.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    if not scan:
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    rows = session.read.option("mergeSchema", "true").parquet(root)
    without = [c for c in columns if not isinstance(rows.schema[c].dataType, _IN_FOOTERS)]
    if without and not scan:
        raise ValueError(f"no bounds in the footers for {', '.join(without)}")
    told = [
        made
        for c in columns
        for made in (F.count(c).alias(f"{c}_count"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))
    ]
    return rows.groupBy("date_partition").agg(F.count(F.lit(1)).alias("rows"), *told)


def loads(spark: SparkSession, root: str) -> DataFrame:
    """What each batch added: its dates, rows and newest arrival, as the rows themselves tell.

    Compaction and clustering keep the batch of each row, so nothing is lost by them.
    """
    rows = read_table(spark, root, with_batch=True)
    newest = [F.max("ingest_time").alias("newest_arrival")] if "ingest_time" in rows.columns else []
    return rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("date_partition").alias("first_date"),
        F.max("date_partition").alias("last_date"), *newest,
    )


def history(spark: SparkSession, root: str, n: int = 5) -> DataFrame:
    """The last ``n`` batches by arrival, newest first."""
    return loads(spark, root).orderBy(F.desc("newest_arrival"), "batch_id").limit(n)


def expired_dates(spark: SparkSession, root: str, *, as_of=None, retention_hours: int = RETENTION_HOURS) -> DataFrame:
    """Dates that ended before the retention: their files and bytes."""
    files = table_files(spark, root)
    end = times.moment(as_of, times.time_type(files, "modificationTime"))
    limit = F.to_date(end - times.interval(f"{retention_hours} hours"))
    return (
        files.filter(F.col("date_partition") < limit)
        .groupBy("date_partition").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def expire(
    spark: SparkSession, root: str, *, as_of=None, retention_hours: int = RETENTION_HOURS, dry_run: bool = True
) -> list[dt.date]:
    """List the dates that ended before the retention; with ``dry_run=False`` remove their folders."""
    found = expired_dates(spark, root, as_of=as_of, retention_hours=retention_hours)
    dates = [r[0] for r in found.select("date_partition").orderBy("date_partition").collect()]
    if not dry_run:
        for date in dates:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/date_partition={date}")
            if not path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
                raise MaintenanceError(f"{path} could not be deleted")
    return dates


def run_all(
    spark: SparkSession,
    tables: dict[str, str],
    date=None,
    *,
    before: dt.date | None = None,
    cluster_by: dict[str, list[str]] | None = None,
    keys: dict[str, list[str]] | None = None,
    min_files: int = 2,
    retention_hours: int | None = None,
    dry_run: bool = True,
    raise_on_error: bool = True,
) -> DataFrame:
    """Cluster each table's closed dates, and list or remove what the retention ended.

    One result row per table. A failing table does not keep the others from running, but it
    is reported, and raised at the end. Without ``retention_hours`` all dates are kept.
    """
    results = []
    for name, root in tables.items():
        done, gone = 0, 0
        try:
            by, own = (cluster_by or {}).get(name), (keys or {}).get(name)
            done = len(zorder(spark, root, date, by, before=before, keys=own, min_files=min_files))
            if retention_hours is not None:
                gone = len(expire(spark, root, retention_hours=retention_hours, dry_run=dry_run))
            results.append((name, done, gone, None))
        except Exception as error:  # whatever ends one table's maintenance, the next has its turn
            logger.exception("maintenance of %s failed", name)
            results.append((name, done, gone, str(error)))
    if raise_on_error:
        failed = [f"{name}: {error}" for name, _, _, error in results if error]
        if failed:
            raise MaintenanceError("; ".join(failed))
    return spark.createDataFrame(results, "table string, dates_rewritten long, dates_expired long, error string")
