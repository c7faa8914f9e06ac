"""Streaming reads of tick messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickengine.functions.times import seconds

# Defaults of the bus source.
BUS_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def read_tick_stream(
    spark: SparkSession,
    location: str,
    fmt: str = "text",
    schema=None,
    **options: str,
) -> DataFrame:
    """Messages as they arrive, with the body in ``value``.

    ``text`` watches a folder of JSON lines; ``maxFilesPerTrigger`` bounds a batch, and
    ``ignoreMissingFiles="true"`` skips files that vanish, which is an error otherwise. ``kafka`` subscribes to the topic ``location`` and
    needs ``kafka.bootstrap.servers`` (and the connector); ``maxOffsetsPerTrigger``
    bounds a batch there.
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "kafka":
        return reader.options(**{**BUS_OPTIONS, "subscribe": location, **options}).load()
    return reader.options(**options).load(location)


def read_backlog(spark: SparkSession, location: str, fmt: str = "text", **options: str) -> DataFrame:
    """The same source from its beginning; run it with ``available_now`` and a
    checkpoint to catch up once and to resume there the next time."""
    earliest = {"startingOffsets": "earliest"} if fmt == "kafka" else {}
    return read_tick_stream(spark, location, fmt, **{**earliest, **options})


def trigger(every: str | None = "30 seconds") -> dict:
    """Trigger arguments: a processing interval, or ``None`` to drain and stop."""
    if every is None:
        return {"availableNow": True}
    return {"processingTime": f"{seconds(every)} seconds"}
