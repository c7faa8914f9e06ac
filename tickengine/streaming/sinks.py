"""Streaming writes into date-partitioned tables."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from tickengine.sources.tables import dump_messages, upsert, write_batch
from tickengine.streaming.source import trigger


class BatchWriter:
    """Appends micro-batches of one query, named after the query and Spark's own batch number.

    A query's id lies in its checkpoint: it outlives restarts, and another checkpoint has
    another. Only the first batch after a start can have been written before, so only that
    one is looked for.
    """

    def __init__(self, rebalance: bool = True):
        self.rebalance, self.started = rebalance, False

    def name_of(self, rows: DataFrame, batch_id: int) -> str:
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        return f"{query}-{batch_id}"

    def append(self, rows: DataFrame, root: str, batch_id: int) -> None:
        name = self.name_of(rows, batch_id)
        write_batch(rows, root, name, rebalance=self.rebalance, written_before=not self.started)

    def done(self) -> None:
        self.started = True


@contextlib.contextmanager
def kept(batch: DataFrame):
    """A micro-batch that is used several times: its source is read and its state advanced once."""
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield batch
    finally:
        batch.unpersist()


def each_batch(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    mode: str = "append",
    every: str | None = "30 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to a batch writer."""
    writer = (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
    )
    return (writer.queryName(name) if name else writer).start()


def append_stream(
    df: DataFrame,
    root: str,
    checkpoint: str,
    *,
    every: str | None = "30 seconds",
    name: str | None = None,
    rebalance: bool = True,
) -> StreamingQuery:
    """Append each micro-batch to a table; a replayed batch replaces itself.

    Batch writes instead of the file sink: the sink's own metadata log would keep out
    the rows of other writers, and those that maintenance wrote anew.
    """
    writer = BatchWriter(rebalance)

    def write(batch: DataFrame, batch_id: int) -> None:
        with contextlib.nullcontext(batch) if writer.started else kept(batch) as rows:
            writer.append(rows, root, batch_id)
        writer.done()

    return each_batch(df, write, checkpoint, every=every, name=name)


def upsert_stream(
    df: DataFrame,
    root: str,
    checkpoint: str,
    *,
    every: str | None = "30 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Replace the windows each micro-batch changed, by key.

    Update mode makes windows visible before they close. A batch costs the size of the
    dates it touches, which for windows are few rows; a replay changes nothing.
    """

    def write(batch: DataFrame, _: int) -> None:
        with kept(batch) as rows:
            upsert(rows, root)

    return each_batch(df, write, checkpoint, mode="update", every=every, name=name)


def dump_stream(
    messages: DataFrame, path: str, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Debug dump of parsed messages as they were sent, per date and ticker (at least once)."""
    return each_batch(messages, lambda batch, _: dump_messages(batch, path), checkpoint, every=every)


def publish_stream(
    messages: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    *,
    every: str | None = "30 seconds",
    **options: str,
) -> StreamingQuery:
    """Send a stream of messages (``to_messages``) to a sink format."""
    return (
        messages.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .trigger(**trigger(every))
        .start()
    )
