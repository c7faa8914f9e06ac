import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickengine.functions.clustering import text_boundaries, text_rank
from tickengine.operators import windows
from tickengine.plans import maintenance, replay
from tickengine.session import new_dir
from tickengine.sources import tables

DAY, OTHER = "2024-06-03", "2024-06-04"


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def batch(ticks_of):
    """Ticks of three tickers, one per second, distinct by batch number."""

    def make(number, day=DAY, n=300):
        rows = [
            (f"T{i % 3}", float(number * 1000 + i), 1, f"{10 + i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}")
            for i in range(n)
        ]
        return ticks_of(rows, day).withColumn("date_partition", F.to_date("event_time")).repartition(3)

    return make


@pytest.fixture
def root(spark, batch):
    path = new_dir(spark, "m")
    for number in range(3):
        both = batch(number).unionByName(batch(number, OTHER))
        tables.write_batch(both, path, number, rebalance=False)
    return path


def files(spark, root, day=DAY):
    return maintenance.table_files(spark, root, day).count()


@pytest.mark.parametrize(
    "rewrite",
    [
        maintenance.compact,
        maintenance.zorder,
        lambda *a: maintenance.zorder(*a, ["ticker", "event_time"]),
    ],
)
def test_rewrite_keeps_rows_and_merges_files(spark, root, rewrite):
    before, many = bag(tables.read_table(spark, root, with_batch=True)), files(spark, root)
    other = files(spark, root, OTHER)
    assert rewrite(spark, root, DAY) == [dt.date.fromisoformat(DAY)]
    assert bag(tables.read_table(spark, root, with_batch=True)) == before
    assert files(spark, root) == 1 < many
    assert files(spark, root, OTHER) == other


def test_a_rewrite_that_fails_changes_nothing(spark, root, monkeypatch):
    before = bag(tables.read_table(spark, root))
    broken = F.raise_error(F.lit("broken row")).cast("long")
    monkeypatch.setattr(
        maintenance, "clustered", lambda rows, *a, **k: rows.withColumn("volume", F.when(F.col("price") > 2200, broken))
    )
    with pytest.raises(Exception, match="broken row"):
        maintenance.zorder(spark, root, DAY, target_bytes=1_000)
    assert bag(tables.read_table(spark, root)) == before


def test_reading_a_rewritten_table_is_one_scan(spark, root):
    maintenance.compact(spark, root, DAY)
    plan = tables.read_table(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_dates_prune_partitions(spark, root):
    assert tables.read_table(spark, root, first=OTHER, last="2024-07-01").count() == 900
    one = tables.read_table(spark, root, last=DAY)
    assert one.count() == 900
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_partition" in plan


def test_batches_after_a_rewrite_stay_visible(spark, root, batch):
    maintenance.compact(spark, root, DAY)
    tables.write_batch(batch(7), root, 3)
    assert tables.read_table(spark, root, date=DAY).count() == 1200
    maintenance.zorder(spark, root, DAY)
    assert tables.read_table(spark, root, date=DAY).count() == 1200
    assert files(spark, root) == 1


def test_a_batch_written_again_after_a_rewrite_replaces_itself(spark, root, batch):
    """Its rows keep their batch through a rewrite."""
    maintenance.zorder(spark, root)
    both = batch(1).unionByName(batch(1, OTHER))
    before = bag(tables.read_table(spark, root))
    tables.write_batch(both, root, 1)
    assert bag(tables.read_table(spark, root)) == before


def test_a_new_column_outlives_rewrites(spark, root, batch):
    tables.write_batch(batch(7).withColumn("currency", F.lit("USD")), root, 3)
    for rewrite in (maintenance.compact, maintenance.zorder):
        rewrite(spark, root, DAY)
        found = tables.read_table(spark, root)
        assert found.filter("currency = 'USD'").count() == 300
        assert found.filter("currency IS NULL").count() == 1800


def test_long_texts_with_a_common_start_are_clustered(spark, ticks_of):
    rows = ticks_of([(f"SAME_BEGINNING_{i % 50:02d}", 1.0, i, "10:00:00") for i in range(5000)])
    by = ["ticker", "volume"]
    placed = maintenance.clustered(rows, by, 16).withColumn("part", F.spark_partition_id())
    parts = placed.groupBy("ticker").agg(F.count_distinct("part").alias("n"))
    assert max(r["n"] for r in parts.collect()) < 12
    cuts = text_boundaries(rows, "ticker", 256)
    rank = {r["ticker"]: r["k"] for r in rows.select("ticker", text_rank(F.col("ticker"), cuts).alias("k")).collect()}
    assert [t for t, _ in sorted(rank.items(), key=lambda x: x[1])] == sorted(rank)
    assert len(set(rank.values())) > 45


def test_clustering_narrows_what_a_filter_reads(spark, root):
    def touched(condition):
        rows = tables.read_table(spark, root, date=DAY)
        return rows.filter(condition).select("_metadata.file_path").distinct().count()

    maintenance.zorder(spark, root, DAY, ["ticker", "event_time"], target_bytes=1500)
    many = files(spark, root)
    assert many >= 4
    assert touched("ticker = 'T1'") < many
    assert touched("event_time < '2024-06-03 10:00:30'") < many


def test_row_groups_that_cannot_match_are_skipped(spark, ticks_of):
    """One file of sorted row groups."""
    path = new_dir(spark, "m")
    rows = ticks_of([(f"T{2 * (i % 400):04d}", i / 7, i, "10:00:00") for i in range(40_000)])
    tables.write_batch(rows.withColumn("date_partition", F.to_date("event_time")).repartition(4), path)

    def scanned(ticker):
        found = spark.read.parquet(path).filter(F.col("ticker") == ticker)
        rows_found = len(found.collect())
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return rows_found, leaf.metrics().apply("numOutputRows").value()

    assert scanned("T0400") == (100, 40_000)
    maintenance.zorder(spark, path, row_group_bytes=60_000)
    assert files(spark, path) == 1
    name = maintenance.table_files(spark, path).first()["path"].removeprefix("file:")
    footer = pq.ParquetFile(name).metadata
    column = next(i for i in range(footer.num_columns) if footer.schema.column(i).name == "ticker")
    ranges = [footer.row_group(i).column(column).statistics for i in range(footer.num_row_groups)]
    fitting = [i for i, r in enumerate(ranges) if r.min <= "T0400" <= r.max]
    assert len(ranges) >= 5 and len(fitting) <= 2
    found, read = scanned("T0400")
    assert found == 100 and read <= sum(footer.row_group(i).num_rows for i in fitting) < 40_000
    assert scanned("T0401") == (0, 0)  # between least and greatest of a group, but not in it


def test_one_ticker_fills_several_files(spark, ticks_of):
    """A single hot value, and even copies of a single row, are split."""
    rows = ticks_of([("HOT", 1.0, 1, "10:00:00")] * 4000)
    parts = maintenance.clustered(rows, ["ticker"], 4).groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in parts.collect()]
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 2000


def test_compacting_an_upserted_table(spark, batch):
    root = new_dir(spark, "m")
    for number in (0, 1):
        tables.upsert(windows.with_date(windows.vwap(batch(number))), root)
    before = bag(tables.read_table(spark, root))
    maintenance.compact(spark, root, DAY)
    assert bag(tables.read_table(spark, root)) == before
    assert len(before) == windows.vwap(batch(1)).count()
    tables.upsert(windows.with_date(windows.vwap(batch(2))), root)
    assert bag(tables.read_table(spark, root).drop("date_partition")) == bag(windows.vwap(batch(2)))


def test_loads_and_history(spark, root):
    maintenance.compact(spark, root, DAY)
    told = {r["batch_id"]: (r["rows"], str(r["first_date"]), str(r["last_date"])) for r in maintenance.loads(spark, root).collect()}
    assert told == {str(n): (600, DAY, OTHER) for n in range(3)}
    arrived = new_dir(spark, "m")
    for number in range(3):
        at = F.lit(f"2024-06-05 0{number}:00:00").cast("timestamp")
        tables.write_batch(tables.read_table(spark, root, date=DAY).withColumn("ingest_time", at), arrived, number)
    assert [r["batch_id"] for r in maintenance.history(spark, arrived, 2).collect()] == ["2", "1"]


def test_dates_behind_the_retention(spark, root):
    assert maintenance.expire(spark, root, as_of="2024-06-10 12:00:00") == []
    found = maintenance.expired_dates(spark, root, as_of="2024-06-11 12:00:00").first()
    assert str(found["date_partition"]) == DAY and found["files"] == files(spark, root) and found["bytes"] > 0
    assert maintenance.expire(spark, root, as_of="2024-06-11 12:00:00") == [dt.date.fromisoformat(DAY)]
    assert tables.read_table(spark, root).count() == 1800  # listed only
    maintenance.expire(spark, root, as_of="2024-06-11 12:00:00", dry_run=False)
    assert {str(r[0]) for r in tables.read_table(spark, root).select("date_partition").distinct().collect()} == {OTHER}


def test_a_failing_table_is_reported_and_does_not_stop_the_others(spark, root):
    roots = {"missing": new_dir(spark, "none"), "raw": root}
    result = maintenance.run_all(spark, roots, DAY, raise_on_error=False)
    told = {r["table"]: (r["dates_rewritten"], r["error"] is None) for r in result.collect()}
    assert told == {"missing": (0, False), "raw": (1, True)}
    with pytest.raises(maintenance.MaintenanceError, match="missing"):
        maintenance.run_all(spark, roots, DAY)


def test_a_corrupt_table_does_not_stop_the_others(spark, root, batch):
    bad = new_dir(spark, "bad")
    tables.write_batch(batch(1), bad, 0)
    spark.range(9).selectExpr("'no parquet' AS value").coalesce(1).write.mode("append").text(
        f"{bad}/date_partition={DAY}"
    )
    result = maintenance.run_all(spark, {"bad": bad, "raw": root}, raise_on_error=False)
    told = {r["table"]: (r["dates_rewritten"], r["error"] is None) for r in result.collect()}
    assert told == {"bad": (0, False), "raw": (2, True)}


def test_all_closed_dates_of_several_files(spark, root, batch):
    before = bag(tables.read_table(spark, root))
    closed = dt.date(2024, 6, 4)
    assert maintenance.dates_to_rewrite(spark, root, closed) == [dt.date(2024, 6, 3)]
    row = maintenance.run_all(spark, {"raw": root}).first()
    assert (row["dates_rewritten"], row["error"]) == (2, None)
    assert bag(tables.read_table(spark, root)) == before
    assert maintenance.dates_to_rewrite(spark, root) == []
    tables.write_batch(batch(9, OTHER), root, 3)
    assert maintenance.dates_to_rewrite(spark, root) == [dt.date(2024, 6, 4)]


def test_replay(spark, root):
    maintenance.compact(spark, root, DAY)
    expected = windows.with_date(windows.vwap(tables.read_table(spark, root, date=DAY)))
    again = replay.replay_vwap(spark, root, DAY, DAY)
    assert bag(again) == bag(expected)
    vwap_root = new_dir(spark, "v")
    wrong = expected.withColumn("vwap_1m", F.lit(0.0))
    tables.upsert(wrong, vwap_root)
    replay.replay_into(spark, root, vwap_root, DAY, DAY)
    assert bag(tables.read_table(spark, vwap_root).select(*expected.columns)) == bag(expected)


def test_statistics_come_from_the_footers(spark, ticks_of):
    root = new_dir(spark, "t")
    for day in ("2024-06-03", "2024-06-04"):
        found = ticks_of([("A", 1.5, 1, "10:00:00"), ("B", None, 9, "10:00:01"), ("B", -2.0, None, "10:00:02")], day)
        tables.write_batch(found.withColumn("date_partition", F.to_date("event_time")), root)
    told = maintenance.statistics(spark, root, ["price", "volume"])
    plan = told._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)" in plan and "MIN(price)" in plan
    assert [tuple(r)[1:] for r in told.collect()] == [(3, 2, -2.0, 1.5, 2, 1, 9)] * 2
    scanned = maintenance.statistics(spark, root, ["price", "volume"], scan=True)
    assert sorted(map(tuple, scanned.collect())) == sorted(map(tuple, told.collect()))


def test_statistics_of_other_types_need_a_scan(spark, ticks_of):
    root = new_dir(spark, "t")
    found = ticks_of([("A", None, 1, "10:00:00"), ("B", None, 2, "10:00:01")])
    tables.write_batch(found.withColumn("date_partition", F.to_date("event_time")), root)
    with pytest.raises(ValueError, match="ticker"):
        maintenance.statistics(spark, root, ["ticker"])
    told = maintenance.statistics(spark, root, ["ticker", "price"], scan=True).first()
    assert tuple(told)[1:] == (2, 2, "A", "B", 0, None, None)
