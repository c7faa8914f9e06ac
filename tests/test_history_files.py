"""What was done to a table, and the files that a rewrite beside them leaves."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tickengine.plans import maintenance, registry
from tickengine.session import new_dir
from tickengine.sources import tables

DAYS = ["2024-06-03", "2024-06-04"]


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def root(spark):
    path = new_dir(spark, "h")
    rows = [(f"T{i % 3}", float(i), day) for day in DAYS for i in range(60)]
    made = spark.createDataFrame(rows, "ticker string, price double, day string")
    made = made.select("ticker", "price", F.col("day").cast("date").alias("date_partition"))
    for number in (0, 1):
        tables.write_batch(made.repartition(3), path, number, rebalance=False)
    return path


@pytest.fixture
def name(spark, root):
    made = f"t_{uuid.uuid4().hex}"
    spark.catalog.createTable(made, path=root, source="parquet")
    tables.find_dates(spark, made)
    yield made
    spark.sql(f"DROP TABLE {made}")


def test_log_of_operations(spark, root):
    log, day = new_dir(spark, "log"), dt.date.fromisoformat(DAYS[0])
    maintenance.compact(spark, root, before=dt.date(2100, 1, 1), log=log)
    maintenance.zorder(spark, root, DAYS[0], ["ticker", "price"], log=log)
    told = maintenance.operations(spark, log)
    other = dt.date.fromisoformat(DAYS[1])
    assert bag(told.select("operation", "date_rewritten", "rows_written", "files_written")) == sorted(
        [("COMPACT", day, 120, 1), ("COMPACT", other, 120, 1), ("ZORDER BY (ticker, price)", day, 120, 1)], key=repr
    )
    assert {r["root"] for r in told.collect()} == {root}


def test_compaction_beside_leaves_files_to_vacuum(spark, root, name):
    before = bag(spark.table(name))
    files = maintenance.listed_files(spark, root, name)
    assert [tuple(r) for r in files.select("is_live", "rewritten").distinct().collect()] == [(True, False)]
    old = bag(files.filter(F.col("date_partition") == DAYS[0]).select("path"))
    started = spark.table(name)
    assert maintenance.compact_beside(spark, root, name, DAYS[0]) == [dt.date.fromisoformat(DAYS[0])]
    assert bag(spark.table(name)) == before == bag(started)
    files = maintenance.listed_files(spark, root, name)
    assert files.filter("is_live AND rewritten").count() == 1
    assert bag(files.filter("NOT is_live").select("path")) == old
    assert maintenance.vacuum(spark, root, name) == []  # not seven days yet
    assert maintenance.vacuum(spark, root, name, as_of="2100-01-01 00:00:00") == [p for (p,) in old]
    again = spark.table(name).filter(F.col("date_partition") == DAYS[0])
    tables.insert_into(again, name)  # goes to the new folder
    assert spark.table(name).count() == 360
    maintenance.vacuum(spark, root, name, as_of="2100-01-01 00:00:00", dry_run=False)
    assert maintenance.listed_files(spark, root, name).filter("NOT is_live").isEmpty()
    assert spark.table(name).count() == 360


def test_closed_dates_are_compacted_beside_once(spark, root, name):
    both = [dt.date.fromisoformat(d) for d in DAYS]
    assert maintenance.compact_beside(spark, root, name, before=dt.date(2100, 1, 1)) == both
    assert maintenance.compact_beside(spark, root, name, before=dt.date(2100, 1, 1)) == []
    replaced = maintenance.replaced_files(spark, root, name, as_of="2100-01-01 00:00:00")
    batches = replaced.join(maintenance.file_batches(spark, root), "file").select("date_partition", "batch_id").distinct()
    assert bag(batches) == [(d, n) for d in both for n in "01"]


def test_every_date_is_told(spark):
    """All dates and operations, not the batches or the old dates alone."""
    sf = "/root/testdata/sf0.001"
    days = spark.read.parquet(f"{sf}/events.parquet").select(F.to_date("ts")).distinct().count()
    assert registry.QUERIES["table_history"](spark, sf).count() == 2 * days
    assert registry.QUERIES["vacuum_candidates"](spark, sf).count() == days + 1
    assert registry.QUERIES["file_listing"](spark, sf).count() == days + 1
