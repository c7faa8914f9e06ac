"""Queries over ticks and their VWAP windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickengine.functions import prices, times


def recent(
    ticks: DataFrame,
    as_of=None,
    lookback: str = "1 hour",
    *,
    time: str = "event_time",
    until_as_of: bool = False,
) -> DataFrame:
    """Ticks not older than ``lookback`` before ``as_of`` (default: now).

    A table partitioned by ``date_partition`` also gets the implied predicate on it,
    so that only the partitions in question are listed and read. ``until_as_of``
    leaves out ticks after a reference time that lies in the past.
    """
    end = times.moment(as_of, times.time_type(ticks, time))
    start = end - times.interval(lookback)
    found = ticks.filter(F.col(time) >= start)
    if until_as_of:
        found = found.filter(F.col(time) <= end)
    if "date_partition" in ticks.columns:
        found = found.filter(F.col("date_partition") >= F.to_date(start))
        if until_as_of:
            found = found.filter(F.col("date_partition") <= F.to_date(end))
    return found


def ticks_as_of(ticks: DataFrame, as_of, *, time: str = "ingest_time") -> DataFrame:
    """The append-only table as it was at a moment in the past."""
    return ticks.filter(F.col(time) <= times.moment(as_of, times.time_type(ticks, time)))


def top_movers(
    ticks: DataFrame,
    as_of=None,
    lookback: str | None = "1 hour",
    n: int | None = 10,
    *,
    tie: str | None = None,
) -> DataFrame:
    """Open, close, change and volume per ticker, largest change first.

    Open and close are the prices at the first and last event time that has a price.
    ``tie`` names a LONG column that orders ticks with equal times. ``n=None`` returns
    all tickers.
    """
    if lookback is not None:
        ticks = recent(ticks, as_of, lookback)
    order = F.when(F.col("price").isNotNull(), prices.time_order("event_time", tie))
    per_ticker = ticks.groupBy("ticker").agg(
        F.min_by("price", order).alias("open_price"),
        F.max_by("price", order).alias("close_price"),
        F.sum("volume").alias("total_volume"),
    )
    change = prices.pct_change(F.col("open_price"), F.col("close_price"))
    ranked = per_ticker.select(
        "ticker",
        "open_price",
        "close_price",
        F.round(change, 2).alias("pct_change"),
        "total_volume",
    ).orderBy(F.abs("pct_change").desc_nulls_last(), "ticker")
    return ranked if n is None else ranked.limit(n)


def ticks_with_vwap(
    ticks: DataFrame,
    vwap: DataFrame,
    duration: str = "1 minute",
    *,
    closed: str = "left",
    carry: tuple[str, ...] = (),
    salts: int = 1,
) -> DataFrame:
    """Every tick next to the VWAP of its window, joined on window start and ticker.

    The window start is computed from the event time, so the range condition becomes
    an equality and no tick is compared with more windows than it lies in.
    ``closed="left"`` is the window's own ``[start, end)``; ``closed="both"`` also
    matches a tick on a boundary to the window that ends there. ``carry`` names further
    columns of the windows.

    A window that holds a large part of all ticks is split by Spark's skew join where
    both sides are stored tables. Where one is computed in the same query, ``salts``
    spreads the ticks of each window over so many parts, and repeats each window row as
    often; it does the same for every window, so rows do not depend on counts.

    If both sides have ``date_partition``, it is a join key as well (for windows that
    divide a day, in a UTC session), so that a date filter on the ticks also prunes the
    windows.
    """
    if closed not in ("left", "both"):
        raise ValueError("closed must be 'left' or 'both'")
    suffix = times.label(duration)
    value = f"vwap_{suffix}"
    start = times.bucket_start("event_time", duration)
    if closed == "left":
        placed = ticks.withColumn("window_start", start)
    else:
        first = F.col("_first")
        starts = F.when(
            F.col("event_time") == first, F.array(first, first - times.interval(duration))
        ).otherwise(F.array(first))
        placed = (
            ticks.withColumn("_first", start)
            .withColumn("window_start", F.explode(starts))
            .drop("_first")
        )
    keys = ["window_start", "ticker"]
    dated = "date_partition" in ticks.columns and "date_partition" in vwap.columns
    utc = ticks.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC"
    divides = times.seconds("1 day") % times.seconds(duration) == 0
    if dated and utc and divides and closed == "left":
        keys.append("date_partition")
    windows = vwap.select(*keys, value, *carry)
    if salts == 1:
        return placed.join(windows, keys)
    part = F.pmod(F.xxhash64("event_time", *placed.columns, F.spark_partition_id()), F.lit(salts))
    salted = placed.withColumn("_salt", part.cast("int"))
    repeated = windows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, "_salt"]).drop("_salt")


def vwap_deviation(
    ticks: DataFrame,
    vwap: DataFrame,
    duration: str = "1 minute",
    *,
    threshold: float = 0.01,
    closed: str = "left",
    ordered: bool = True,
    salts: int = 1,
) -> DataFrame:
    """Ticks whose price lies more than ``threshold`` away from their window's VWAP.

    The sort takes all output columns after the deviation, and last a running number,
    so that many equal deviations or copies of a tick do not end up in one range. A
    sort reads its input twice, to sample and to shuffle; the rebalance before it keeps
    that from running the join twice.
    """
    value = f"vwap_{times.label(duration)}"
    date = [c for c in ("date_partition",) if c in ticks.columns]
    slim = ticks.select("ticker", "event_time", "price", *date)
    joined = ticks_with_vwap(slim, vwap, duration, closed=closed, salts=salts)
    away = prices.deviation(F.col("price"), F.col(value))
    alerts = joined.filter(away > threshold).select(
        "ticker",
        "event_time",
        "price",
        value,
        F.round(away * 100, 2).alias("deviation_pct"),
    )
    if not ordered:
        return alerts
    return (
        alerts.hint("rebalance", "ticker", "event_time")
        .withColumn("_row", F.monotonically_increasing_id())
        .orderBy(F.col("deviation_pct").desc(), "ticker", "event_time", "price", value, "_row")
        .drop("_row")
    )
