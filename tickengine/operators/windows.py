"""Volume-weighted average price over event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickengine.functions import times
from tickengine.functions.prices import vwap_expr, vwap_of, vwap_sums


def vwap(
    ticks: DataFrame,
    duration: str | None = "1 minute",
    *,
    watermark: str | None = "2 minutes",
    high_low: bool = False,
    suffix: str | None = None,
    complete_rows: bool = True,
    decimals: int | None = None,
    exact: bool = False,
) -> DataFrame:
    """VWAP, volume and tick count per ticker and tumbling window.

    Works on batch and streaming ticks; the watermark only matters for streams.
    ``duration=None`` aggregates per ticker without a window. Column names carry the
    window length (``vwap_1m``) unless ``suffix`` says otherwise; the windowless form
    has plain names. All aggregates are mergeable, so ticks are summed where they are
    read and a hot ticker reaches the shuffle as one row per window and task.
    """
    if suffix is None:
        suffix = times.label(duration) if duration else ""
    tail = f"_{suffix}" if suffix else ""
    aggregates = [
        vwap_expr(complete_rows=complete_rows, decimals=decimals, exact=exact).alias(f"vwap{tail}"),
        F.sum("volume").alias(f"total_volume{tail}"),
        F.count(F.lit(1)).alias(f"tick_count{tail}"),
    ]
    if high_low:
        aggregates += [
            F.max("price").alias(f"price_high{tail}"),
            F.min("price").alias(f"price_low{tail}"),
        ]
    if duration is None:
        return ticks.groupBy("ticker").agg(*aggregates)

    if ticks.isStreaming and watermark:
        ticks = ticks.withWatermark("event_time", watermark)
    grouped = ticks.groupBy(F.window("event_time", duration), "ticker").agg(*aggregates)
    measures = [c for c in grouped.columns if c not in ("window", "ticker")]
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "ticker",
        *measures,
    )


def chained_vwap(
    ticks: DataFrame,
    durations: tuple[str, ...] = ("1 minute", "5 minutes"),
    *,
    watermark: str | None = "2 minutes",
    high_low: bool = False,
    decimals: int | None = None,
) -> DataFrame:
    """VWAP windows of several lengths from one read of the ticks, in one streaming query.

    The shortest windows are aggregated from ticks, each further length from the sums of the
    length before, a stateful step after another. A row is a window of the longest length, with the shorter
    windows inside it in ``parts``: ``chain_rows`` takes any length out. So short windows appear
    when the long one closes; start a query per length where that is too late.

    Each length must be a multiple of the one before.
    """
    for shorter, longer in zip(durations, durations[1:]):
        if times.seconds(longer) % times.seconds(shorter):
            raise ValueError(f"{longer} is no multiple of {shorter}")
    if ticks.isStreaming and watermark:
        ticks = ticks.withWatermark("event_time", watermark)
    units, weight = vwap_sums(decimals=decimals)
    sums = {"units": units, "weight": weight, "volume": F.sum("volume"), "ticks": F.count(F.lit(1))}
    merged = {name: F.sum(name) for name in sums}
    if high_low:
        sums |= {"high": F.max("price"), "low": F.min("price")}
        merged |= {"high": F.max("high"), "low": F.min("low")}
    window = F.window("event_time", durations[0])
    found = ticks.groupBy(window.alias("window"), "ticker").agg(*(c.alias(n) for n, c in sums.items()))
    inside: list[str] = []
    for duration in durations[1:]:
        part = F.struct("window", *sums, *inside)
        inside = ["parts"]
        found = found.groupBy(F.window(F.window_time("window"), duration).alias("window"), "ticker").agg(
            *(c.alias(n) for n, c in merged.items()), F.sort_array(F.collect_list(part)).alias("parts")
        )
    return found


def chain_rows(
    chained: DataFrame, durations: tuple[str, ...], duration: str, *, decimals: int | None = None
) -> DataFrame:
    """The windows of one length out of ``chained_vwap``, with the columns of ``vwap``."""
    found = chained.drop("parts") if duration == durations[-1] else chained
    for longer in reversed(durations[1:]):
        if longer == duration:
            break
        found = found.select("ticker", F.explode("parts").alias("part")).select("ticker", "part.*")
    tail = f"_{times.label(duration)}"
    edges = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    measures = [
        vwap_of(F.col("units"), F.col("weight"), decimals).alias(f"vwap{tail}"),
        F.col("volume").alias(f"total_volume{tail}"),
        F.col("ticks").alias(f"tick_count{tail}"),
    ]
    if "high" in found.columns:
        measures += [F.col("high").alias(f"price_high{tail}"), F.col("low").alias(f"price_low{tail}")]
    return found.select(*edges, "ticker", *measures)


def with_date(windows: DataFrame) -> DataFrame:
    """Add the partition date of the window start, which the VWAP table needs."""
    return windows.withColumn("date_partition", F.to_date("window_start"))
