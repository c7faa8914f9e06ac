"""Ticks as bus messages: key = ticker, value = JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickengine.functions import times
from tickengine.schemas import CONTRACT, TICK_SCHEMA


def to_messages(ticks: DataFrame) -> DataFrame:
    """Binary ``key`` and ``value`` columns, as a bus sink expects them.

    A tick without the time text gets it from ``event_time``, and a field the contract
    allows to be absent is NULL. NULL fields are written, so every message has all keys.
    """
    if "timestamp" not in ticks.columns:
        ticks = ticks.withColumn("timestamp", times.to_iso("event_time"))
    optional = [f for f in CONTRACT if f.nullable and f.name not in ticks.columns]
    ticks = ticks.withColumns({f.name: F.lit(None).cast(f.dataType) for f in optional})
    body = F.to_json(F.struct(*TICK_SCHEMA.fieldNames()), {"ignoreNullFields": "false"})
    return ticks.select(
        F.encode("ticker", "UTF-8").alias("key"), F.encode(body, "UTF-8").alias("value")
    )


def in_order(ticks: DataFrame, *, time: str = "event_time", finer: tuple[str, ...] = ()) -> DataFrame:
    """Ticks of each ticker in one task, by time and the ``finer`` columns.

    A bus keeps the order in which one producer sends the messages of a key, and here that
    is one task. So a ticker is never split, and the busiest one sets the time it takes.
    """
    return ticks.repartition("ticker").sortWithinPartitions("ticker", time, *finer)


def publish(ticks: DataFrame, fmt: str = "kafka", *, ordered: bool = False, **options: str) -> None:
    """Write ticks as messages (``kafka`` needs the connector on the classpath).

    ``ordered`` sends those of a ticker in the order of their event time.
    """
    if ordered:
        ticks = in_order(ticks)
    to_messages(ticks).write.format(fmt).mode("append").options(**options).save()
