import random

import pytest
from pyspark.sql import functions as F

from tickengine.functions import times
from tickengine.operators import analytics, windows

TICKS = [
    ("A", 10.0, 1, "10:00:00"),
    ("A", 30.0, 1, "10:00:30"),
    ("A", 20.0, 2, "10:01:00"),
    ("A", 26.0, 2, "10:01:59.5"),
    ("B", 5.0, 4, "10:00:10"),
    ("B", 5.0, 1, "10:02:00"),
    ("B", 9.0, 1, "10:02:01"),
]


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def literal_join(ticks, vwap, threshold, both_ends):
    """The range condition as one would write it in SQL."""
    start, end = F.col("v.window_start"), F.col("v.window_end")
    at = F.col("r.event_time")
    inside = at.between(start, end) if both_ends else (at >= start) & (at < end)
    away = F.abs(F.col("price") - F.col("vwap_1m")) / F.col("vwap_1m")
    return (
        ticks.alias("r")
        .join(vwap.alias("v"), (F.col("r.ticker") == F.col("v.ticker")) & inside)
        .filter(away > threshold)
        .select("r.ticker", "event_time", "price", "vwap_1m", F.round(away * 100, 2))
    )


def test_top_movers(ticks_of):
    rows = analytics.top_movers(ticks_of(TICKS), lookback=None).collect()
    assert [tuple(r) for r in rows] == [
        ("A", 10.0, 26.0, 160.0, 6),
        ("B", 5.0, 9.0, 80.0, 6),
    ]


def test_top_movers_orders_by_size_of_change(ticks_of):
    ticks = ticks_of(
        [("UP", 10.0, 1, "10:00:00"), ("UP", 11.0, 1, "10:00:01"),
         ("DOWN", 10.0, 1, "10:00:00"), ("DOWN", 5.0, 1, "10:00:01"),
         ("ZERO", 0.0, 1, "10:00:00"), ("ZERO", 5.0, 1, "10:00:01")]
    )
    rows = analytics.top_movers(ticks, lookback=None, n=None).collect()
    assert [(r["ticker"], r["pct_change"]) for r in rows] == [
        ("DOWN", -50.0), ("UP", 10.0), ("ZERO", None),
    ]
    assert analytics.top_movers(ticks, lookback=None, n=1).count() == 1


def test_tie_breaker_decides_equal_times(ticks_of):
    ticks = ticks_of([("A", float(i), i, "10:00:00") for i in (3, 1, 2)])
    row = analytics.top_movers(ticks, lookback=None, tie="volume").first()
    assert (row["open_price"], row["close_price"]) == (1.0, 3.0)


def test_aggregation_stays_hash_based(ticks_of):
    for tie in (None, "volume"):
        plan = analytics.top_movers(ticks_of(TICKS), lookback=None, tie=tie)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in text
        assert "TakeOrderedAndProject" in text


def test_recent(ticks_of):
    ticks = ticks_of(TICKS)
    assert analytics.recent(ticks, "2024-06-03 10:02:01", "1 minute").count() == 3
    until = analytics.recent(ticks, "2024-06-03 10:02:00", "1 minute", until_as_of=True)
    assert until.count() == 3
    newest = analytics.recent(ticks, times.newest(ticks), "1 second")
    assert bag(newest.select("ticker", "price")) == [("B", 5.0), ("B", 9.0)]


def test_recent_default_is_now(spark):
    df = spark.sql("SELECT current_timestamp() - INTERVAL 5 MINUTES AS event_time "
                   "UNION ALL SELECT current_timestamp() - INTERVAL 2 HOURS")
    assert analytics.recent(df).count() == 1


def test_recent_prunes_partitions_and_reaches_the_scan(spark, ticks_of, tmp_path):
    path = str(tmp_path / "t")
    ticks_of(TICKS).withColumn("date_partition", F.to_date("event_time")).write.partitionBy(
        "date_partition"
    ).parquet(path)
    found = analytics.recent(spark.read.parquet(path), "2024-06-03 10:02:00", "1 hour")
    scan = [l for l in found._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in l][0]
    assert "date_partition" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(event_time" in scan


def test_ticks_as_of(ticks_of):
    ticks = ticks_of(TICKS).withColumn("ingest_time", F.col("event_time") + F.expr("INTERVAL 1 MINUTE"))
    assert analytics.ticks_as_of(ticks, "2024-06-03 10:02:00").count() == 4


@pytest.mark.parametrize("closed", ["left", "both"])
@pytest.mark.parametrize("salts", [1, 2, 7])
def test_deviation_equals_the_range_join(ticks_of, closed, salts):
    ticks = ticks_of(TICKS)
    vwap = windows.vwap(ticks)
    found = analytics.vwap_deviation(ticks, vwap, closed=closed, salts=salts)
    assert bag(found) == bag(literal_join(ticks, vwap, 0.01, closed == "both"))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("closed", ["left", "both"])
def test_random_ticks_with_many_on_boundaries(ticks_of, seed, closed):
    draw = random.Random(seed)
    ticks = ticks_of(
        [
            (draw.choice("AB"), draw.randrange(1, 500) / 100, draw.randrange(0, 9),
             f"10:{draw.randrange(8):02d}:{draw.choice(['00', '00', '17', '59.999999'])}")
            for _ in range(120)
        ]
    )
    vwap = windows.vwap(ticks, decimals=2)
    found = analytics.vwap_deviation(ticks, vwap, closed=closed, salts=5)
    # a literal division by a missing VWAP would be the same NULL
    assert bag(found) == bag(literal_join(ticks, vwap, 0.01, closed == "both"))


@pytest.mark.parametrize("salts", [1, 3])
def test_two_versions_of_a_window_join_alike_whatever_their_counts(ticks_of, salts):
    ticks = ticks_of([("A", 1.0, 1, "10:00:30"), ("A", 3.0, 1, "10:00:31")])
    both = windows.vwap(ticks).unionByName(windows.vwap(ticks.limit(1)))
    assert analytics.ticks_with_vwap(ticks, both, salts=salts).count() == 4


def test_movers_skip_missing_prices(ticks_of):
    ticks = ticks_of([("A", None, 1, "10:00:00"), ("A", 2.0, 1, "10:00:01"), ("A", 3.0, 1, "10:00:02"),
                      ("A", None, 1, "10:00:03"), ("B", None, 5, "10:00:00")])
    rows = {r["ticker"]: tuple(r)[1:] for r in analytics.top_movers(ticks, lookback=None).collect()}
    assert rows == {"A": (2.0, 3.0, 50.0, 4), "B": (None, None, None, 5)}


def test_nothing_runs_while_the_join_is_declared(spark, ticks_of):
    ticks = ticks_of(TICKS)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    analytics.ticks_with_vwap(ticks, windows.vwap(ticks), salts=4)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_boundary_tick(ticks_of):
    ticks = ticks_of([("A", 1.0, 1, "10:00:30"), ("A", 3.0, 1, "10:01:00")])
    vwap = windows.vwap(ticks)
    boundary = F.col("price") == 3.0
    one = analytics.ticks_with_vwap(ticks, vwap).filter(boundary)
    two = analytics.ticks_with_vwap(ticks, vwap, closed="both").filter(boundary)
    assert [r["vwap_1m"] for r in one.collect()] == [3.0]
    assert sorted(r["vwap_1m"] for r in two.collect()) == [1.0, 3.0]


def test_deviation_is_sorted_and_skips_undefined(ticks_of):
    ticks = ticks_of(TICKS + [("Z", 1.0, 0, "10:00:00")] * 3)
    found = analytics.vwap_deviation(ticks, windows.vwap(ticks)).collect()
    values = [r["deviation_pct"] for r in found]
    assert values == sorted(values, reverse=True)
    assert all(r["ticker"] != "Z" for r in found)


def test_copies_of_a_tick_are_all_kept(ticks_of):
    ticks = ticks_of([("A", 1.0, 1, "10:00:00")] * 50 + [("A", 9.0, 1, "10:00:01")] * 50)
    assert analytics.vwap_deviation(ticks, windows.vwap(ticks), salts=10).count() == 100


def test_join_has_equality_keys_only(ticks_of):
    ticks = ticks_of(TICKS)
    plan = analytics.vwap_deviation(ticks, windows.vwap(ticks), ordered=False)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    join = [l for l in text.split("\n") if "Join Inner" in l][0]
    assert "window_start" in join and "window_end" not in join
    assert "NestedLoop" not in plan._jdf.queryExecution().executedPlan().toString()


def test_date_filter_on_ticks_prunes_windows(spark, ticks_of, tmp_path):
    made = ticks_of(TICKS).withColumn("date_partition", F.to_date("event_time"))
    paths = {"ticks": made, "vwap": windows.with_date(windows.vwap(made))}
    for name, df in paths.items():
        df.write.partitionBy("date_partition").parquet(str(tmp_path / name))
    ticks, vwap = (spark.read.parquet(str(tmp_path / name)) for name in paths)
    found = analytics.vwap_deviation(
        analytics.recent(ticks, "2024-06-03 10:02:00"), vwap, ordered=False
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    on_windows = [line for line in plan.split("\n") if "Filter" in line and "isnotnull(vwap_1m" in line]
    assert on_windows and all(">= 2024-06-03)" in line for line in on_windows)


def test_unknown_interval_end(ticks_of):
    with pytest.raises(ValueError):
        analytics.ticks_with_vwap(ticks_of(TICKS), windows.vwap(ticks_of(TICKS)), closed="right")
