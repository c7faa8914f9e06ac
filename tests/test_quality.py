import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from tickengine.operators import quality
from tickengine.schemas import EXPECTED_TICKERS, TICK_SCHEMA
from tickengine.sources.ticks import list_files


def test_fresh_and_stale(ticks_of):
    ticks = ticks_of([("A", 1.0, 1, "10:00:00"), ("A", 1.0, 1, "09:00:00")])
    check = lambda at: quality.freshness(ticks, at, time="event_time").first()
    assert not check("2024-06-03 10:10:59")["is_stale"]
    assert check("2024-06-03 10:11:00")["is_stale"]


def test_days_count_in_the_age(ticks_of):
    row = quality.freshness(
        ticks_of([("A", 1.0, 1, "10:00:00")]), "2024-06-04 10:05:00", time="event_time"
    ).first()
    assert (row["age_minutes"], row["is_stale"]) == (1445, True)


def test_fresh_looks_at_recent_partitions_only(spark, ticks_of, tmp_path):
    path = str(tmp_path / "t")
    for day in ("2024-06-01", "2024-06-03"):
        made = ticks_of([("A", 1.0, 1, "10:00:00")], day)
        made.withColumn("date_partition", F.to_date("event_time")).write.mode("append").partitionBy(
            "date_partition"
        ).parquet(path)
    stored = spark.read.parquet(path)
    check = lambda at: quality.freshness(stored, at, time="event_time", days=1)
    scan = check("2024-06-03 10:05:00")._jdf.queryExecution().executedPlan().toString()
    assert ">= 2024-06-02" in scan.split("PartitionFilters")[1]
    assert check("2024-06-03 10:05:00").first()["age_minutes"] == 5
    assert check("2024-06-09 10:05:00").first()["is_stale"]


def test_no_data_is_stale(ticks_of):
    empty = ticks_of([("A", 1.0, 1, "10:00:00")]).filter("false")
    assert quality.freshness(empty, time="event_time").first()["is_stale"]
    with pytest.raises(quality.DataQualityError, match="no data"):
        quality.require_fresh(empty, time="event_time")


def test_require_fresh(ticks_of):
    ticks = ticks_of([("A", 1.0, 1, "10:00:00")])
    assert quality.require_fresh(ticks, "2024-06-03 10:03:30", time="event_time") == 3
    with pytest.raises(quality.DataQualityError, match="stale"):
        quality.require_fresh(ticks, "2024-06-03 12:00:00", time="event_time")


def test_freshness_of_files(spark, ticks_of, tmp_path):
    ticks_of([("A", 1.0, 1, "10:00:00")]).write.parquet(str(tmp_path / "t"))
    files = list_files(spark, str(tmp_path / "t"))
    assert files.columns == ["path", "modificationTime", "length"]
    assert quality.require_fresh(files, time="modificationTime") == 0


def test_coverage(ticks_of):
    present = [t for t in EXPECTED_TICKERS if t != "JPM"]
    ticks = ticks_of(
        [(t, 1.0, 1, "10:00:00") for t in present] + [("JPM", 1.0, 1, "09:00:00"), ("X", 1.0, 1, "10:00:00")]
    )
    missing = quality.coverage(ticks, as_of="2024-06-03 10:04:00").collect()
    assert [r["ticker"] for r in missing] == ["JPM"]
    assert quality.coverage(ticks, lookback=None).count() == 0
    quality.require_coverage(ticks, lookback=None)
    with pytest.raises(quality.DataQualityError, match="JPM"):
        quality.require_coverage(ticks, as_of="2024-06-03 10:04:00")


@pytest.mark.parametrize("cells_per_chunk", [1, 2, 7, 4096])
def test_gaps_against_brute_force(spark, cells_per_chunk):
    random.seed(cells_per_chunk)
    start = dt.datetime(2024, 6, 3, tzinfo=dt.timezone.utc)
    times = {
        t: sorted(start + dt.timedelta(microseconds=random.randrange(20 * 3600 * 10**6)) for _ in range(80))
        for t in "AB"
    }
    # exactly the limit is no gap; one microsecond more is
    times["C"] = [start, start + dt.timedelta(minutes=10), start + dt.timedelta(minutes=20, microseconds=1)]
    times["A"] += [times["A"][-1]] * 100  # copies
    limit = dt.timedelta(minutes=10)
    expected = sorted(
        (t, int(((b - a)).total_seconds()), a.microsecond, b.microsecond)
        for t, ts in times.items() for a, b in zip(ts, ts[1:]) if b - a > limit
    )
    ticks = spark.createDataFrame(
        [(t, at) for t, ts in times.items() for at in ts], "ticker string, event_time timestamp"
    )
    found = quality.gaps(ticks, "10 minutes", cells_per_chunk=cells_per_chunk)
    micro = lambda c: (F.unix_micros(c) % 1000000).cast("int")
    rows = found.select("ticker", "gap_seconds", micro(F.col("gap_start")), micro(F.col("gap_end"))).collect()
    assert sorted(map(tuple, rows)) == expected
    assert ("C", 600, 0, 1) in expected


def test_an_outage_that_goes_on(ticks_of):
    ticks = ticks_of([("A", 1.0, 1, "10:00:00"), ("B", 1.0, 1, "10:00:00"), ("B", 1.0, 1, "10:50:00")])
    found = quality.gaps(ticks, "30 minutes", as_of="2024-06-03 11:00:00", expected=["A", "C"])
    rows = {(r["ticker"], r["gap_seconds"]) for r in found.collect()}
    assert rows == {("A", 3600), ("B", 3000), ("C", None)}
    with pytest.raises(quality.DataQualityError, match="A: 1"):
        quality.require_no_gaps(ticks.filter("ticker = 'A'"), as_of="2024-06-03 11:00:00")


def test_how_many_more_gaps(ticks_of):
    ticks = ticks_of([(f"T{i:02d}", 1.0, 1, at) for i in range(13) for at in ("10:00:00", "11:00:00")])
    with pytest.raises(quality.DataQualityError, match="3 more"):
        quality.require_no_gaps(ticks)


def test_late_arrivals_are_fresh(ticks_of):
    ticks = ticks_of([("A", 1.0, 1, "10:00:00")]).withColumns(
        {"date_partition": F.to_date("event_time"), "ingest_time": F.lit("2024-08-01 10:00:00").cast("timestamp")}
    )
    assert quality.require_fresh(ticks, "2024-08-01 10:05:00", days=1) == 5


def test_silent_intervals(ticks_of):
    ticks = ticks_of([("A", 1.0, 1, "10:00:00"), ("A", 1.0, 1, "10:03:00"), ("B", 1.0, 1, "10:01:00")])
    rows = {(r["ticker"], str(r["window_start"])[14:16], r["tick_count"]) for r in quality.tick_rate(ticks).collect()}
    assert rows == {("A", "00", 1), ("A", "01", 0), ("A", "02", 0), ("A", "03", 1), ("B", "01", 1)}
    found = quality.tick_rate(ticks, first="2024-06-03 10:00:00", last="2024-06-03 10:04:30")
    assert found.count() == 10 and found.filter("is_low").count() == 10
    assert quality.tick_rate(ticks, silent=False).count() == 3


def test_require_no_gaps(ticks_of):
    ticks = ticks_of([("A", 1.0, 1, "10:00:00"), ("A", 1.0, 1, "10:20:00"), ("A", 1.0, 1, "11:00:00")])
    quality.require_no_gaps(ticks, "1 hour")
    with pytest.raises(quality.DataQualityError, match="A: 1"):
        quality.require_no_gaps(ticks)


def test_rules(spark):
    ticks = spark.createDataFrame(
        [("A", 1.0, 1, 1), (None, -1.0, 1, None), ("B", None, -2, 1), ("C", float("nan"), 1, 1)],
        "ticker string, price double, volume long, event_time int",
    )
    rows = {r["rule"]: (r["rows_checked"], r["rows_failed"], r["passed"]) for r in quality.rules(ticks).collect()}
    assert rows == {
        "ticker_missing": (4, 1, False),
        "price_missing": (4, 1, False),
        "event_time_missing": (4, 1, False),
        "price_not_a_number": (4, 1, False),
        "price_not_positive": (4, 1, False),
        "volume_negative": (4, 1, False),
    }
    with pytest.raises(quality.DataQualityError, match="price_missing: 1"):
        quality.require_rules(ticks)
    quality.require_rules(ticks.limit(0))


def test_missing_columns(spark):
    df = spark.createDataFrame([], "ticker string, price string")
    assert quality.missing_columns(df, T.StructType(TICK_SCHEMA[:2].fields)) == ["price"]


def test_tick_rate(ticks_of):
    ticks = ticks_of([("A", 1.0, 1, f"10:00:{s:02d}") for s in range(0, 60, 5)] + [("A", 1.0, 1, "10:01:00")])
    rows = quality.tick_rate(ticks).orderBy("window_start").collect()
    assert [(r["tick_count"], r["rate"], r["is_low"]) for r in rows] == [(12, 1.0, False), (1, 1 / 12, True)]
