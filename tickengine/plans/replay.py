"""Recomputing derived tables from the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickengine.operators.windows import vwap, with_date
from tickengine.sources.tables import read_table, upsert


def replay_vwap(
    spark: SparkSession,
    raw_root: str,
    first_date,
    last_date,
    duration: str = "1 minute",
    **options,
) -> DataFrame:
    """VWAP windows of whole days, computed again from the raw ticks of those days.

    Window lengths that divide a day never reach over the end of one.
    """
    raw = read_table(spark, raw_root, first=first_date, last=last_date)
    return with_date(vwap(raw, duration, **options))


def replay_into(
    spark: SparkSession, raw_root: str, vwap_root: str, first_date, last_date,
    duration: str = "1 minute", **options,
) -> None:
    """Put replayed windows in the place of those that the table holds.

    For dates that no stream writes any more, as both would write the date back.
    """
    upsert(replay_vwap(spark, raw_root, first_date, last_date, duration, **options), vwap_root)
