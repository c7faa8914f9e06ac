"""Data-quality checks. Each returns a small result table; ``require_*`` raise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickengine.functions import times
from tickengine.operators.analytics import recent
from tickengine.operators.windows import vwap
from tickengine.schemas import EXPECTED_TICKERS


class DataQualityError(RuntimeError):
    """A check found data missing, late or wrong."""


def freshness(
    df: DataFrame,
    as_of=None,
    max_age_minutes: int = 10,
    *,
    time: str = "ingest_time",
    days: int | None = None,
) -> DataFrame:
    """One row: newest time, its age in whole minutes, and whether that is too old.

    No data at all counts as stale. For a file listing pass ``time="modificationTime"``.
    ``days`` looks only at the partitions of that many days before ``as_of``, instead of
    at the whole history of the table.
    """
    reference = times.moment(as_of, times.time_type(df, time))
    if days is not None:
        df = df.filter(F.col("date_partition") >= F.date_sub(F.to_date(reference), days))
    age = times.whole_minutes(F.col("newest"), reference)
    return df.agg(F.max(time).alias("newest")).select(
        "newest",
        age.alias("age_minutes"),
        F.coalesce(age > max_age_minutes, F.lit(True)).alias("is_stale"),
    )


def require_fresh(
    df: DataFrame,
    as_of=None,
    max_age_minutes: int = 10,
    *,
    time: str = "ingest_time",
    days: int | None = None,
) -> int:
    """The age in minutes; raises when there is no data or it is too old.

    If the last ``days`` hold nothing, the whole table is looked at.
    """
    row = freshness(df, as_of, max_age_minutes, time=time, days=days).first()
    if row["newest"] is None and days is not None:
        # Late data may have arrived just now, under a date further back.
        row = freshness(df, as_of, max_age_minutes, time=time).first()
    if row["newest"] is None:
        raise DataQualityError("no data found")
    if row["is_stale"]:
        raise DataQualityError(f"data is stale: newest is {row['age_minutes']} minutes old")
    return row["age_minutes"]


def coverage(
    ticks: DataFrame,
    expected: list[str] = EXPECTED_TICKERS,
    as_of=None,
    lookback: str | None = "5 minutes",
) -> DataFrame:
    """Expected tickers without a tick in the lookback.

    Ticks are first reduced to the expected tickers, so the side that is broadcast
    has no more rows than the list that was passed in.
    """
    if lookback is not None:
        ticks = recent(ticks, as_of, lookback)
    seen = ticks.filter(F.col("ticker").isin(list(expected))).select("ticker").distinct()
    wanted = ticks.sparkSession.createDataFrame([(t,) for t in expected], "ticker string")
    return wanted.join(F.broadcast(seen), "ticker", "left_anti")


def require_coverage(
    ticks: DataFrame,
    expected: list[str] = EXPECTED_TICKERS,
    as_of=None,
    lookback: str | None = "5 minutes",
) -> None:
    missing = sorted(r["ticker"] for r in coverage(ticks, expected, as_of, lookback).collect())
    if missing:
        raise DataQualityError(f"no recent ticks for: {', '.join(missing)}")


def gaps(
    ticks: DataFrame,
    max_gap: str = "30 minutes",
    *,
    as_of=None,
    expected: list[str] = (),
    cells_per_chunk: int = 4096,
) -> DataFrame:
    """Stretches longer than ``max_gap`` without a tick, per ticker.

    With ``as_of`` also those that still go on then: from a ticker's last tick to that
    time. A ticker of ``expected`` that never came has a gap without a start.

    Two ticks in the same time cell of width ``max_gap`` are never too far apart, so
    the first and last time of each cell are all that matters. Ticks are reduced to
    that before any shuffle, whatever their number or skew. Cells are compared with
    their predecessor inside chunks of ``cells_per_chunk`` cells, and chunks with the
    chunk before, so that no ticker is ordered as a whole in one task.
    """
    chunk_width = f"{times.seconds(max_gap) * cells_per_chunk} seconds"
    cells = ticks.groupBy("ticker", times.bucket_start("event_time", max_gap).alias("_cell")).agg(
        F.min("event_time").alias("_first"), F.max("event_time").alias("_last")
    )
    # A cell key is a time of the same type, hence a chunk is a window over cells.
    cells = cells.withColumn("_chunk", times.bucket_start("_cell", chunk_width))
    chunks = cells.groupBy("ticker", "_chunk").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last")
    )

    def between(parts: DataFrame, partition: list[str], order: str) -> DataFrame:
        before = F.lag("_last").over(Window.partitionBy(*partition).orderBy(order))
        return parts.withColumn("gap_start", before).select(
            "ticker", "gap_start", F.col("_first").alias("gap_end")
        )

    pairs = between(cells, ["ticker", "_chunk"], "_cell").unionByName(
        between(chunks, ["ticker"], "_chunk")
    )
    if as_of is not None:
        end = times.moment(as_of, times.time_type(ticks, "event_time"))
        newest = chunks.groupBy("ticker").agg(F.max("_last").alias("gap_start"))
        if expected:
            wanted = ticks.sparkSession.createDataFrame([(t,) for t in expected], "ticker string")
            newest = newest.join(wanted, "ticker", "full")
        pairs = pairs.unionByName(newest.withColumn("gap_end", end))
    silent = F.col("gap_end") > F.col("gap_start") + times.interval(max_gap)
    if as_of is not None:
        # A first tick has no tick before it either, but that is no gap.
        silent = silent | (F.col("gap_start").isNull() & (F.col("gap_end") == end) & F.col("ticker").isin(*expected))
    return pairs.filter(silent).select(
        "ticker",
        "gap_start",
        "gap_end",
        F.timestamp_diff("SECOND", F.col("gap_start"), F.col("gap_end")).alias("gap_seconds"),
    )


def require_no_gaps(ticks: DataFrame, max_gap: str = "30 minutes", *, as_of=None, expected: list[str] = ()) -> None:
    """Raises with the number of gaps per ticker if there are any."""
    found = gaps(ticks, max_gap, as_of=as_of, expected=expected).groupBy("ticker").count()
    worst = found.orderBy(F.desc("count"), "ticker").limit(10).collect()
    if worst:
        more = found.count() - len(worst)
        told = ", ".join(f"{r['ticker']}: {r['count']}" for r in worst) + (f", {more} more" if more else "")
        raise DataQualityError(f"gaps longer than {max_gap} (most by ticker: {told})")


def tick_rules() -> dict[str, Column]:
    """Rule name to the condition of a row that breaks it."""
    return {
        "ticker_missing": F.col("ticker").isNull(),
        "price_missing": F.col("price").isNull(),
        "event_time_missing": F.col("event_time").isNull(),
        "price_not_a_number": F.isnan("price"),
        "price_not_positive": F.col("price") <= 0,
        "volume_negative": F.col("volume") < 0,
    }


def rules(ticks: DataFrame, checks: dict[str, Column] | None = None) -> DataFrame:
    """Rows checked and rows failing, per rule, from one pass over the ticks."""
    checks = tick_rules() if checks is None else checks
    counted = ticks.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count_if(condition).alias(name) for name, condition in checks.items()],
    )
    unpivoted = counted.unpivot("rows_checked", list(checks), "rule", "rows_failed")
    return unpivoted.select(
        "rule",
        "rows_checked",
        "rows_failed",
        (F.col("rows_failed") == 0).alias("passed"),
    )


def missing_columns(df: DataFrame, required: T.StructType) -> list[str]:
    """Required columns that are absent or of another type."""
    have = {f.name: f.dataType for f in df.schema}
    return [f.name for f in required if have.get(f.name) != f.dataType]


def require_rules(ticks: DataFrame, checks: dict[str, Column] | None = None) -> None:
    broken = rules(ticks, checks).filter(~F.col("passed")).collect()
    if broken:
        told = ", ".join(f"{r['rule']}: {r['rows_failed']}" for r in broken)
        raise DataQualityError(f"rules broken ({told})")


def tick_rate(
    ticks: DataFrame,
    interval: str = "1 minute",
    expected_ticks: int = 12,
    *,
    silent: bool = True,
    first=None,
    last=None,
) -> DataFrame:
    """Ticks per ticker and interval against the number a healthy producer sends.

    An interval without any tick has a row with 0, from a ticker's first interval to its
    last, or from the time ``first`` to the time ``last`` for all tickers.
    ``silent=False`` leaves these rows out.
    """
    suffix = times.label(interval)
    counted = vwap(ticks, interval).select("window_start", "ticker", F.col(f"tick_count_{suffix}").alias("tick_count"))
    if silent:
        like = times.time_type(counted, "window_start")

        def bound(given, own: Column) -> Column:
            return own if given is None else times.bucket_start(times.moment(given, like), interval)

        spans = counted.groupBy("ticker").agg(F.min("window_start").alias("_first"), F.max("window_start").alias("_last"))
        # One window expression a step; two in one are refused.
        spans = spans.withColumn("_first", bound(first, F.col("_first")))
        spans = spans.withColumn("_last", bound(last, F.col("_last"))).filter("_first <= _last")
        slots = spans.select(
            "ticker", F.explode(F.sequence("_first", "_last", times.interval(interval))).alias("window_start")
        )
        # Rows outside the bounds stay, as they have ticks.
        counted = slots.join(counted, ["ticker", "window_start"], "full").withColumn(
            "tick_count", F.coalesce("tick_count", F.lit(0).cast("long"))
        )
    return counted.select(
        "window_start",
        "ticker",
        "tick_count",
        (F.col("tick_count") / F.lit(expected_ticks)).alias("rate"),
        (F.col("tick_count") < expected_ticks).alias("is_low"),
    )
