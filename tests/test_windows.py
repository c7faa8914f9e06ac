import math
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tickengine.functions import times
from tickengine.operators import windows


def test_formula(spark):
    df = spark.createDataFrame(
        [("AAPL", 100.0, 1000), ("AAPL", 110.0, 2000)], "ticker string, price double, volume long"
    )
    row = windows.vwap(df, None).first()
    assert abs(row["vwap"] - 320000 / 3000) < 0.001
    assert (row["total_volume"], row["tick_count"]) == (3000, 2)


def test_columns_and_bounds(ticks_of):
    made = windows.vwap(ticks_of([("A", 2.0, 5, "10:00:59.999999"), ("A", 4.0, 5, "10:01:00")]))
    assert made.columns == [
        "window_start", "window_end", "ticker", "vwap_1m", "total_volume_1m", "tick_count_1m",
    ]
    rows = made.orderBy("window_start").collect()
    assert [r["vwap_1m"] for r in rows] == [2.0, 4.0]
    assert [(r["window_end"] - r["window_start"]).seconds for r in rows] == [60, 60]


def test_five_minutes_with_high_and_low(ticks_of):
    ticks = ticks_of([("A", 2.0, 1, "10:00:00"), ("A", 8.0, 3, "10:04:59"), ("A", 5.0, 1, "10:05:00")])
    made = windows.vwap(ticks, "5 minutes", high_low=True)
    first = made.orderBy("window_start").first()
    assert (first["vwap_5m"], first["price_high_5m"], first["price_low_5m"]) == (6.5, 8.0, 2.0)


@pytest.mark.parametrize("decimals", [None, 2])
def test_no_volume_gives_null(ticks_of, decimals):
    row = windows.vwap(ticks_of([("A", 2.0, 0, "10:00:00")]), decimals=decimals).first()
    assert row["vwap_1m"] is None and row["total_volume_1m"] == 0


@pytest.mark.parametrize("decimals", [None, 2])
def test_missing_price(ticks_of, decimals):
    ticks = ticks_of([("A", None, 5, "10:00:00"), ("A", 2.0, 5, "10:00:01")])
    assert windows.vwap(ticks, decimals=decimals).first()["vwap_1m"] == 2.0
    literal = windows.vwap(ticks, complete_rows=False, decimals=decimals).first()
    assert literal["vwap_1m"] == 1.0
    assert literal["tick_count_1m"] == 2


def test_exact_sums_do_not_overflow(ticks_of):
    ticks = ticks_of([("A", 90000000.25, 4_000_000_000_000, "10:00:00")] * 2)
    assert windows.vwap(ticks, decimals=2).first()["vwap_1m"] == 90000000.25


def test_price_that_is_no_number(ticks_of):
    ticks = ticks_of([("A", float("nan"), 5, "10:00:00"), ("A", 2.0, 5, "10:00:01")])
    row = windows.vwap(ticks, decimals=2).first()
    assert (row["vwap_1m"], row["tick_count_1m"]) == (2.0, 2)


@pytest.mark.parametrize("price", [1e18, 0.0049, 1.125, -1e17])
def test_prices_that_do_not_fit_are_refused(ticks_of, price):
    ticks = ticks_of([("A", price, 5, "10:00:00"), ("A", 2.0, 5, "10:00:01")])
    with pytest.raises(Exception, match="price does not fit 2 decimals"):
        windows.vwap(ticks, decimals=2).collect()
    whole = windows.vwap(ticks).first()["vwap_1m"]
    assert whole == pytest.approx((price + 2.0) / 2)


def test_prices_as_doubles_tell_them_fit(ticks_of):
    prices = [0.07, 490.02, 1.15, 0.29, 1234567.89, 99999999999.99]
    ticks = ticks_of([("A", p, 1, f"10:{i:02d}:00") for i, p in enumerate(prices)])
    assert sorted(r["vwap_1m"] for r in windows.vwap(ticks, decimals=2).collect()) == sorted(prices)


def test_types_of_zone_less_times(spark, ticks_of):
    zone_less = ticks_of([("A", 2.0, 5, "10:00:59")]).withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz")
    )
    assert windows.vwap(zone_less).schema["window_start"].dataType.typeName() == "timestamp_ntz"


def test_partial_aggregation_before_the_only_shuffle(ticks_of):
    plan = windows.vwap(ticks_of([("A", 2.0, 5, "10:00:00")]), high_low=True, decimals=2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


@pytest.mark.parametrize("text,secs,label", [("1 minute", 60, "1m"), ("5 minutes", 300, "5m"), ("2 days", 172800, "2d")])
def test_durations(text, secs, label):
    assert times.seconds(text) == secs
    assert times.label(text) == label


tick = st.tuples(
    st.sampled_from(["A", "B"]),
    st.integers(1, 100000).map(lambda cents: cents / 100),
    st.integers(0, 1000),
    st.integers(0, 7199),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(tick, min_size=1, max_size=40))
def test_against_brute_force(ticks_of, rows):
    at = lambda s: f"{10 + s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}"
    made = windows.vwap(ticks_of([(t, p, v, at(s)) for t, p, v, s in rows]), "5 minutes").collect()
    expected = defaultdict(list)
    for t, p, v, s in rows:
        expected[(t, s // 300)].append((p, v))
    assert len(made) == len(expected)
    for r in made:
        start = r["window_start"]
        # collected times are local; only the offset within the data matters here
        second = (start - min(m["window_start"] for m in made)).seconds
        offset = min(s for *_, s in rows) // 300
        group = expected[(r["ticker"], second // 300 + offset)]
        volume = sum(v for _, v in group)
        assert (r["total_volume_5m"], r["tick_count_5m"]) == (volume, len(group))
        if volume:
            assert math.isclose(r["vwap_5m"], sum(p * v for p, v in group) / volume)
        else:
            assert r["vwap_5m"] is None
