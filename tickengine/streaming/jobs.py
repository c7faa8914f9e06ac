"""Running streams: the tick job, backfill, alerts and progress."""

from __future__ import annotations

import logging
import threading

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from tickengine.functions import prices, times
from tickengine.operators.parse import parse_events, raw_columns, split_valid
from tickengine.operators.analytics import vwap_deviation
from tickengine.operators.quality import tick_rules
from tickengine.operators.windows import chain_rows, chained_vwap, vwap, with_date
from tickengine.sources.tables import (
    days_of,
    latest_rows,
    newest as newest_stored,
    read_table,
    stored_dates,
    stored_rows,
    upsert as upsert_rows,
)
from tickengine.streaming.sinks import BatchWriter, append_stream, dump_stream, each_batch, upsert_stream
from tickengine.streaming.source import read_backlog

logger = logging.getLogger(__name__)


def run_streams(
    messages: DataFrame,
    tables: str,
    checkpoints: str,
    *,
    durations: tuple[str, ...] = ("1 minute", "5 minutes"),
    watermark: str = "2 minutes",
    high_low: bool = False,
    decimals: int | None = None,
    every: str | None = "30 seconds",
    upsert: bool = False,
    max_ahead: str | None = None,
    exact: bool = False,
    chained: bool = False,
) -> list[StreamingQuery]:
    """Start the raw query and one VWAP query per window length, or one for all (``chained``).

    Tables are ``<tables>/raw``, ``<tables>/vwap_1m`` and so on; each query has its own
    checkpoint. Rows that break the contract, or whose time lies more than ``max_ahead``
    after their arrival, go to ``<tables>/quarantine``, under the date of their arrival,
    and into no other table. ``upsert`` publishes open windows too.

    The raw query reads and parses each message once: the parsed batch is kept, on disk
    where memory is short, until ticks and rejects are written. Each window length reads
    the source once, as queries of their own do; chained, all lengths together read it once,
    and short windows appear when the long one that holds them closes.
    """
    parsed = parse_events(messages, keep_raw=True)

    def places(name: str) -> tuple[str, str]:
        return f"{tables}/{name}", f"{checkpoints}/{name}"

    writer = BatchWriter()

    def write_parsed(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid, rejected = split_valid(batch, max_ahead=max_ahead)
            writer.append(raw_columns(valid.drop("raw_value")), places("raw")[0], batch_id)
            dated = rejected.withColumn("date_partition", F.to_date("ingest_time"))
            writer.append(dated, places("quarantine")[0], batch_id)
            writer.done()
        finally:
            batch.unpersist()

    queries = [each_batch(parsed, write_parsed, places("raw")[1], every=every, name="raw")]
    ticks, _ = split_valid(parsed.drop("raw_value"), max_ahead=max_ahead)
    if chained and durations:
        if upsert or exact:
            raise ValueError("chained windows are appended when they close, and not summed exactly")
        sums = chained_vwap(ticks, durations, watermark=watermark, high_low=high_low, decimals=decimals)
        queries.append(
            chain_stream(sums, tables, places("vwap")[1], durations, decimals=decimals, every=every, name="vwap")
        )
        return queries
    start = upsert_stream if upsert else append_stream
    for duration in durations:
        name = f"vwap_{times.label(duration)}"
        windows = with_date(
            vwap(ticks, duration, watermark=watermark, high_low=high_low, decimals=decimals, exact=exact)
        )
        queries.append(start(windows, *places(name), every=every, name=name))
    return queries


def chain_stream(
    chained: DataFrame,
    tables: str,
    checkpoint: str,
    durations: tuple[str, ...],
    *,
    decimals: int | None = None,
    every: str | None = "30 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Append the windows of every length of ``chained_vwap`` to its table, ``<tables>/vwap_1m`` and so on."""
    writer = BatchWriter()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for duration in durations:
                rows = with_date(chain_rows(batch, durations, duration, decimals=decimals))
                writer.append(rows, f"{tables}/vwap_{times.label(duration)}", batch_id)
            writer.done()
        finally:
            batch.unpersist()

    return each_batch(chained, write, checkpoint, every=every, name=name)


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait until all queries have ended; if one fails, stop the rest and raise."""
    spark = SparkSession.builder.getOrCreate()
    running = list(queries)
    while running:
        try:
            spark.streams.awaitAnyTermination()
        except StreamingQueryException:
            pass  # the failed query is identified below
        spark.streams.resetTerminated()
        ended = [q for q in running if not q.isActive]
        running = [q for q in running if q.isActive]
        failed = next((q.exception() for q in ended if q.exception() is not None), None)
        if failed is not None:
            for query in running:
                query.stop()
            raise failed


def backfill(
    spark: SparkSession,
    location: str,
    path: str,
    checkpoint: str,
    fmt: str = "text",
    **options: str,
) -> StreamingQuery:
    """Dump a source from its beginning as it was sent, resuming where it last ended.

    Every message is kept, unreadable ones too; see ``dump_messages`` for the folders.
    """
    return dump_stream(parse_events(read_backlog(spark, location, fmt, **options), keep_raw=True), path, checkpoint)


def deviation_alerts(
    ticks: DataFrame,
    duration: str = "1 minute",
    *,
    watermark: str = "2 minutes",
    threshold: float = 0.01,
    salts: int = 16,
    decimals: int | None = None,
) -> DataFrame:
    """Live ticks that lie too far from the VWAP of their window, once it closed.

    Ticks wait in state for their window's VWAP. Both sides carry the window struct,
    which lets the watermark clear that state; the event time beside it is a plain
    column, because a stream may have one watermarked column only. A hot ticker would put all its waiting
    ticks into one task, so ticks are spread over ``salts`` parts of each window and
    the few VWAP rows are repeated for each part. The part depends on the tick and its
    input partition: copies are spread too, and a repeated task decides the same way.
    """
    suffix = times.label(duration)
    value = f"vwap_{suffix}"
    timed = ticks.withWatermark("event_time", watermark)
    place = F.xxhash64("event_time", "price", "volume", F.spark_partition_id())
    salt = F.pmod(place, F.lit(salts)).cast("int")
    waiting = timed.select(
        F.window("event_time", duration).alias("window"),
        "ticker",
        F.timestamp_micros(F.unix_micros("event_time")).alias("event_time"),
        "price",
        salt.alias("salt"),
    )
    windows = (
        timed.groupBy(F.window("event_time", duration).alias("window"), "ticker")
        .agg(prices.vwap_expr(decimals=decimals).alias(value))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    away = prices.deviation(F.col("price"), F.col(value))
    return (
        waiting.join(windows, ["window", "ticker", "salt"])
        .filter(away > threshold)
        .select(
            "ticker",
            "event_time",
            "price",
            value,
            F.round(away * 100, 2).alias("deviation_pct"),
        )
    )


def stored_alerts(
    ticks: DataFrame,
    vwap_root: str,
    root: str,
    checkpoint: str,
    duration: str = "1 minute",
    *,
    threshold: float = 0.01,
    every: str | None = "30 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Deviation alerts by a look into the stored VWAP table, as each tick arrives.

    No tick waits in state: a micro-batch reads the windows of its own dates, joins them and appends
    the alerts. A tick whose window is not stored yet has none; ``deviation_alerts`` waits for it.
    """
    writer = BatchWriter()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("date_partition", F.to_date("event_time")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            windows = stored_dates(batch.sparkSession, vwap_root, days_of(batch))
            if windows is not None:
                alerts = vwap_deviation(batch.drop("date_partition"), windows, duration, threshold=threshold)
                writer.append(alerts.withColumn("date_partition", F.to_date("event_time")), root, batch_id)
            writer.done()
        finally:
            batch.unpersist()

    return each_batch(ticks, write, checkpoint, every=every, name=name)


def append_with_late(
    ticks: DataFrame,
    root: str,
    late_root: str,
    checkpoint: str,
    *,
    watermark: str = "2 minutes",
    every: str | None = "30 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Append ticks to a raw table, and those that came behind the watermark also to ``late_root``.

    The watermark is the newest event time of all earlier batches less the delay. It is looked up
    in the table when the query starts and kept up to date from then on. A tick that the window
    queries just kept may be among the late ones; ``repair_windows`` gives the same for it.
    """
    writer, newest = BatchWriter(), []
    delay = times.interval(watermark)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("date_partition", F.to_date("event_time")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not newest:
                newest.append(newest_stored(spark, root, "event_time", apart_from=writer.name_of(batch, batch_id)))
            late = batch.filter(F.col("event_time") < F.lit(newest[0]).cast("timestamp") - delay)
            writer.append(batch, root, batch_id)
            writer.append(late, late_root, batch_id)
            writer.done()
            latest = batch.agg(F.max("event_time")).first()[0]
            newest[0] = max((x for x in (newest[0], latest) if x is not None), default=None)
        finally:
            batch.unpersist()

    return each_batch(ticks, write, checkpoint, every=every, name=name)


def repair_windows(
    spark: SparkSession,
    raw_root: str,
    late_root: str,
    vwap_root: str,
    duration: str = "1 minute",
    *,
    first=None,
    last=None,
    **options,
) -> DataFrame | None:
    """Compute the windows that late ticks touch again, from all raw ticks, and put them in place.

    Only windows that are closed, i.e. end no later than the last one the table holds: open ones
    are still the stream's. ``first`` and ``last`` choose dates of late ticks. Only the dates touched are read
    from the raw table, and of these only the windows touched are aggregated. Returns the repaired
    windows, None if there are none to repair. Window lengths have to divide a day.
    """
    closed = newest_stored(spark, vwap_root, "window_end")
    if closed is None or stored_rows(spark, late_root) is None:
        return None
    late = read_table(spark, late_root, first=first, last=last)
    span = F.window("event_time", duration)
    touched = (
        late.select(span.alias("span"), "ticker", "date_partition")
        .filter(F.col("span.end") <= F.lit(closed).cast("timestamp"))
        .select("date_partition", F.col("span.start").alias("window_start"), "ticker").distinct()
    )
    raw = stored_dates(spark, raw_root, days_of(touched))
    if raw is None:  # no window touched is closed
        return None
    rows = raw.drop("batch_id").withColumn("window_start", times.bucket_start("event_time", duration)).join(
        touched.drop("date_partition"), ["window_start", "ticker"], "left_semi"
    )
    made = with_date(vwap(rows.drop("window_start"), duration, **options))
    upsert_rows(made, vwap_root)
    return made


def outage_stream(
    ticks: DataFrame,
    root: str,
    checkpoint: str,
    max_gap: str = "30 minutes",
    *,
    watermark: str = "2 minutes",
    every: str | None = "30 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Outages longer than ``max_gap`` per ticker, from the moment they are that long.

    Ticks less than ``max_gap`` apart are one session window. When the watermark closes one, its ticker has
    been silent for that long: a row (ticker, ``gap_start``) without ``gap_end`` appears in the
    keyed table ``root``. When the ticker's next session closes, ``gap_end`` is filled in. State holds
    a row per open session; the open outages, one a ticker at most, are read from the table.
    Batches that run again change nothing. ``outages`` reads the table.
    """
    timed = ticks.withWatermark("event_time", watermark)
    sessions = (
        timed.groupBy(F.session_window("event_time", max_gap).alias("session"), "ticker")
        .agg(F.min("event_time").alias("first"), F.max("event_time").alias("last"))
        .select("ticker", "first", "last")
    )
    empty = F.lit(None).cast("timestamp")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            known = stored_rows(batch.sparkSession, root, merge_schema=False)
            rows = batch
            if known is not None:
                open_ = known.filter("gap_end IS NULL").join(
                    batch.groupBy("ticker").agg(F.min("first").alias("_first")), "ticker"
                )
                # Rows of this very batch, if it runs again, start no earlier than its sessions.
                before = open_.filter("gap_start < _first")
                rows = rows.unionByName(before.select("ticker", empty.alias("first"), F.col("gap_start").alias("last")))
            following = F.lead("first").over(Window.partitionBy("ticker").orderBy("last"))
            made = rows.select("ticker", F.col("last").alias("gap_start"), following.alias("gap_end"))
            upsert_rows(made.withColumn("date_partition", F.to_date("gap_start")), root, ("ticker", "gap_start"))
        finally:
            batch.unpersist()

    return each_batch(sessions, write, checkpoint, every=every, name=name)


OUTAGES = "ticker string, gap_start timestamp, gap_end timestamp, date_partition date"


def outages(spark: SparkSession, root: str, max_gap: str = "30 minutes") -> DataFrame:
    """Outages that ``outage_stream`` found, maybe none; those that still go on have no end."""
    rows = read_table(spark, root, schema=OUTAGES)
    longer = F.col("gap_end").isNull() | (F.col("gap_end") > F.col("gap_start") + times.interval(max_gap))
    return rows.filter(longer).select(
        "ticker", "gap_start", "gap_end", F.timestamp_diff("SECOND", F.col("gap_start"), F.col("gap_end")).alias("gap_seconds")
    )


def silent_tickers(
    ticks: DataFrame, expected: list[str], duration: str = "5 minutes", *, watermark: str = "2 minutes"
) -> DataFrame:
    """Expected tickers without a tick, per window, as the watermark closes it.

    A window's state is the set of expected tickers seen, never more than were asked for. Windows
    in which no ticker at all had a tick are not known to the stream; ``outage_stream`` tells those.
    """
    wanted = F.array_distinct(F.array(*map(F.lit, expected)))
    seen = F.collect_set(F.when(F.col("ticker").isin(list(expected)), F.col("ticker")))
    if ticks.isStreaming:
        ticks = ticks.withWatermark("event_time", watermark)
    return (
        ticks.groupBy(F.window("event_time", duration).alias("window")).agg(seen.alias("seen"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            F.explode(F.array_except(wanted, "seen")).alias("ticker"),
        )
    )


def observe_rules(ticks: DataFrame, name: str, checks: dict | None = None, *, time: str = "event_time") -> DataFrame:
    """The same ticks, while each micro-batch counts its rows, the rows that break each rule, and its newest time.

    The numbers come with the query's progress, without a scan of their own; ``ObservedBatches`` takes them.
    """
    checks = tick_rules() if checks is None else checks
    counted = [F.count_if(F.coalesce(broken, F.lit(False))).alias(rule) for rule, broken in checks.items()]
    return ticks.observe(name, F.count(F.lit(1)).alias("rows_checked"), *counted, F.max(time).alias("newest"))


class ObservedBatches(StreamingQueryListener):
    """Keeps what ``observe_rules`` counted, a row per micro-batch, until it is taken or written."""

    def __init__(self, name: str) -> None:
        self.name, self.batches = name, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = event.progress.observedMetrics.get(self.name)
        if told is not None:
            self.batches.append((str(event.progress.id), event.progress.batchId, told.asDict()))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def rows(self, spark: SparkSession) -> DataFrame:
        """Per batch and rule: rows checked, rows failing, newest time."""
        made = [
            (query, batch, rule, told["rows_checked"], told[rule], told["newest"])
            for query, batch, told in list(self.batches)
            for rule in told
            if rule not in ("rows_checked", "newest")
        ]
        return spark.createDataFrame(
            made, "query string, batch long, rule string, rows_checked long, rows_failed long, newest timestamp"
        )

    def flush(self, spark: SparkSession, root: str) -> None:
        """Write the rows kept so far to a table, by query, batch and rule, and forget them."""
        taken = len(self.batches)
        dated = self.rows(spark).withColumn("date_partition", F.to_date(F.coalesce("newest", F.current_timestamp())))
        if taken:
            upsert_rows(dated, root, ("query", "batch", "rule"))
            del self.batches[:taken]


def progress_rows(query: StreamingQuery) -> DataFrame:
    """Recent micro-batches of a query: rows in, rows dropped as late, rows in state.

    Spark keeps a fixed number of progress reports, so this is always small.
    """
    rows = []
    for report in query.recentProgress:
        states = report["stateOperators"]
        rows.append(
            (
                report["name"],
                report["batchId"],
                report["timestamp"],
                report["numInputRows"],
                report["eventTime"].get("watermark"),
                sum(s["numRowsDroppedByWatermark"] for s in states),
                sum(s["numRowsTotal"] for s in states),
                report["batchDuration"],
            )
        )
    return SparkSession.builder.getOrCreate().createDataFrame(
        rows,
        "name string, batch_id long, timestamp string, input_rows long, watermark string, "
        "late_rows_dropped long, state_rows long, duration_ms long",
    )


class Ends(StreamingQueryListener):
    """Tells when a query's reports have all come: its end is the last of them.

    Listeners that were added before this one have heard them then.
    """

    def __init__(self) -> None:
        self.runs: set[str] = set()
        self.heard = threading.Condition()

    def _hear(self, *runs: str) -> None:
        with self.heard:
            self.runs.update(runs)
            self.heard.notify_all()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._hear()

    def onQueryIdle(self, event) -> None:
        self._hear()

    def onQueryTerminated(self, event) -> None:
        self._hear(str(event.runId))

    def wait(self, query: StreamingQuery, silence: float = 300.0) -> None:
        """Returns when the end of ``query`` was told; fails if nothing is told for ``silence`` seconds."""
        with self.heard:
            while str(query.runId) not in self.runs:
                if not self.heard.wait(silence):
                    raise TimeoutError(f"no report of query {query.runId} for {silence} s")


class LateRows(StreamingQueryListener):
    """Counts rows dropped as late, per query name, for as long as the session lives.

    ``progress_rows`` knows the last reports only; this adds each report as it comes.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        name = report.name or str(report.id)
        late = sum(state.numRowsDroppedByWatermark for state in report.stateOperators)
        self.dropped[name] = self.dropped.get(name, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class DeliveryLog(StreamingQueryListener):
    """Logs each delivered micro-batch with its offsets, and failures as errors."""

    def onQueryStarted(self, event) -> None:
        logger.info("started %s (%s)", event.name, event.runId)

    def onQueryProgress(self, event) -> None:
        report = event.progress
        for source in report.sources:
            logger.info(
                "delivered %s batch %s: %s rows up to %s",
                report.name, report.batchId, source.numInputRows, source.endOffset,
            )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            logger.error("query %s failed: %s", event.id, event.exception)
        else:
            logger.info("query %s ended", event.id)


class Deliveries(DeliveryLog):
    """The same log, kept as rows as well: per batch and source its rows and offsets, and how queries ended.

    Rows are kept on the driver until ``flush`` writes them, one per batch and source.
    """

    def __init__(self) -> None:
        self.batches: list[tuple] = []
        self.ended: list[tuple[str, str | None]] = []

    def onQueryProgress(self, event) -> None:
        super().onQueryProgress(event)
        report = event.progress
        for number, source in enumerate(report.sources):
            self.batches.append(
                (str(report.id), report.name, report.batchId, number, source.description,
                 source.numInputRows, source.startOffset, source.endOffset, report.timestamp)
            )

    def onQueryTerminated(self, event) -> None:
        super().onQueryTerminated(event)
        self.ended.append((str(event.id), event.exception))

    def rows(self, spark: SparkSession, taken: int | None = None) -> DataFrame:
        """Per query, batch and source: rows delivered, the offsets they lie between, and when."""
        made = spark.createDataFrame(
            self.batches[:taken],
            "query string, name string, batch_id long, source int, description string, "
            "input_rows long, start_offset string, end_offset string, at string",
        )
        return made.withColumn("at", F.col("at").cast("timestamp"))

    def flush(self, spark: SparkSession, root: str) -> None:
        """Write the rows kept so far to a table, by query, batch and source, and forget them.

        A batch that ran again counts as its last run told.
        """
        taken = len(self.batches)
        if not taken:
            return
        dated = self.rows(spark, taken).withColumn("date_partition", F.to_date("at"))
        keys = ["query", "batch_id", "source"]
        upsert_rows(latest_rows(dated.withColumn("_at", F.col("at")), ["date_partition", *keys], "_at"), root, tuple(keys))
        del self.batches[:taken]
