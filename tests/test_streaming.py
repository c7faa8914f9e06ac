import json
import logging
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tickengine.operators import analytics, parse, windows
from tickengine.plans import maintenance
from tickengine.session import new_dir
from tickengine.sources import messages, tables
from tickengine.streaming import jobs, sinks
from tickengine.streaming.source import read_backlog, read_tick_stream, trigger


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def body(ticker, price, volume, at):
    return json.dumps({"ticker": ticker, "price": price, "volume": volume, "timestamp": f"2024-06-03T{at}"})


class Feed:
    """A folder of JSON-line files that are read in the order they were added."""

    def __init__(self, folder):
        self.folder, self.files = str(folder), 0
        os.makedirs(self.folder, exist_ok=True)

    def add(self, *bodies):
        path = os.path.join(self.folder, f"{self.files:04d}.txt")
        with open(path, "w") as f:
            f.write("\n".join(bodies) + "\n")
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def stream(self, spark):
        return read_tick_stream(spark, self.folder, maxFilesPerTrigger="1")

    def batch(self, spark):
        return spark.read.text(self.folder)


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path / "feed")


TICKS = [
    ("A", 10.0, 1, "10:00:00"), ("B", 5.0, 2, "10:00:10"), ("A", 30.0, 1, "10:00:50"),
    ("A", 20.0, 2, "10:01:00"), ("B", 6.0, 1, "10:03:00"), ("A", 20.5, 2, "10:07:30"),
    ("B", 9.0, 1, "10:12:00"), ("A", 1.0, 1, "10:12:30"),
]


def fill(feed):
    for tick in TICKS:
        feed.add(body(*tick))


def run(df, root, checkpoint, start=sinks.append_stream):
    query = start(df, root, checkpoint, every=None)
    query.awaitTermination()
    return query


def parsed(spark, feed):
    return parse.parse_events(feed.stream(spark))


@pytest.mark.parametrize("duration", ["1 minute", "5 minutes"])
def test_stream_equals_batch_on_closed_windows(spark, feed, duration):
    fill(feed)
    root, checkpoint = new_dir(spark, "s"), new_dir(spark, "c")
    run(windows.with_date(windows.vwap(parsed(spark, feed), duration, high_low=True)), root, checkpoint)
    batch = windows.with_date(
        windows.vwap(parse.parse_events(feed.batch(spark)), duration, high_low=True)
    )
    closed = batch.filter("window_end <= timestamp'2024-06-03 10:10:30'")
    streamed = tables.read_table(spark, root)
    assert bag(streamed.select(*closed.columns)) == bag(closed)
    assert streamed.count() < batch.count()


def test_update_mode_shows_open_windows(spark, feed):
    fill(feed)
    root, checkpoint = new_dir(spark, "s"), new_dir(spark, "c")
    made = windows.with_date(windows.vwap(parsed(spark, feed), "5 minutes"))
    run(made, root, checkpoint, sinks.upsert_stream)
    batch = windows.with_date(windows.vwap(parse.parse_events(feed.batch(spark)), "5 minutes"))
    assert bag(tables.read_table(spark, root).select(*batch.columns)) == bag(batch)


def late_run(spark, feed):
    root, checkpoint = new_dir(spark, "s"), new_dir(spark, "c")
    query = run(windows.with_date(windows.vwap(parsed(spark, feed))), root, checkpoint)
    dropped = jobs.progress_rows(query).agg(F.sum("late_rows_dropped")).first()[0]
    first = tables.read_table(spark, root).filter("window_start = timestamp'2024-06-03 10:00:00'").first()
    return dropped, first["tick_count_1m"]


def test_late_tick_in_the_next_batch_is_kept(spark, feed):
    feed.add(body("A", 1.0, 1, "10:00:00"))
    feed.add(body("A", 1.0, 1, "10:10:00"))
    feed.add(body("A", 9.0, 1, "10:00:30"))  # compared with the previous batch's watermark
    assert late_run(spark, feed) == (0, 2)


def test_late_tick_one_batch_later_is_dropped(spark, feed):
    feed.add(body("A", 1.0, 1, "10:00:00"))
    feed.add(body("A", 1.0, 1, "10:10:00"))
    feed.add(body("A", 1.0, 1, "10:10:01"))
    feed.add(body("A", 9.0, 1, "10:00:30"))
    assert late_run(spark, feed) == (1, 1)


def test_state_shrinks_behind_the_watermark(spark, feed):
    fill(feed)
    root, checkpoint = new_dir(spark, "s"), new_dir(spark, "c")
    query = run(windows.with_date(windows.vwap(parsed(spark, feed))), root, checkpoint)
    rows = jobs.progress_rows(query).orderBy("batch_id").collect()
    assert rows[-1]["state_rows"] < max(r["state_rows"] for r in rows)
    assert sum(r["input_rows"] for r in rows) == len(TICKS)


def test_restart_continues_without_duplicates(spark, feed):
    root, checkpoint = new_dir(spark, "s"), new_dir(spark, "c")
    for at in range(4):
        feed.add(body(*TICKS[at]))
        run(parse.raw_columns(parsed(spark, feed)), root, checkpoint)
    assert tables.read_table(spark, root).count() == 4
    assert tables.read_table(spark, root, with_batch=True).select("batch_id").distinct().count() == 4


def test_a_batch_that_failed_after_writing_is_replayed_once(spark, feed):
    """The write went through, the commit did not: the batch runs again."""
    feed.add(body(*TICKS[0]), body(*TICKS[1]))
    root, checkpoint = new_dir(spark, "s"), new_dir(spark, "c")
    ticks = parse.raw_columns(parsed(spark, feed))

    def write_then_fail(batch, batch_id):
        sinks.BatchWriter().append(batch, root, batch_id)
        raise RuntimeError("driver lost")

    with pytest.raises(StreamingQueryException, match="driver lost"):
        sinks.each_batch(ticks, write_then_fail, checkpoint, every=None).awaitTermination()
    assert tables.read_table(spark, root).count() == 2
    run(ticks, root, checkpoint)
    assert tables.read_table(spark, root).count() == 2


def test_a_new_checkpoint_continues_the_table(spark, feed):
    root = new_dir(spark, "s")
    for at in range(2):
        feed.add(body(*TICKS[at]))
        run(parse.raw_columns(parsed(spark, feed)), root, new_dir(spark, "c"))
        maintenance.compact(spark, root, "2024-06-03")
    # the second checkpoint reads the first file again, as its own batch
    assert tables.read_table(spark, root).count() == 3


def test_times_far_ahead_do_not_stop_the_others(spark, feed):
    feed.add(body("A", 1.0, 1, "10:00:00"))
    feed.add('{"ticker":"A","price":1.0,"volume":1,"timestamp":"9000-01-01T00:00:00"}')
    for minute in range(1, 4):
        feed.add(body("A", 1.0, 1, f"10:{minute:02d}:00"))
    out = new_dir(spark, "job")
    jobs.await_all(jobs.run_streams(feed.stream(spark), f"{out}/t", f"{out}/c", every=None,
                                    durations=("1 minute",), upsert=True, max_ahead="1 day"))
    assert tables.read_table(spark, f"{out}/t/vwap_1m").count() == 4
    reject = tables.read_table(spark, f"{out}/t/quarantine").first()
    assert reject["missing_fields"] == ["event_time_ahead"]


def test_each_message_is_parsed_once_by_the_raw_query(spark, feed):
    fill(feed)
    out = new_dir(spark, "job")
    queries = jobs.run_streams(feed.stream(spark), f"{out}/t", f"{out}/c", every=None, durations=())
    jobs.await_all(queries)
    rows = jobs.progress_rows(queries[0]).collect()
    assert sum(r["input_rows"] for r in rows) == len(TICKS)


def test_late_rows_are_added_up(spark, feed):
    class Event:
        def __init__(self, late):
            state = type("S", (), {"numRowsDroppedByWatermark": late})()
            self.progress = type("P", (), {"name": "q", "id": 1, "stateOperators": [state, state]})()

    log = jobs.LateRows()
    for late in (0, 2, 3):
        log.onQueryProgress(Event(late))
    assert log.dropped == {"q": 10}


def test_copies_of_a_tick_are_all_reported(spark, feed):
    feed.add(*[body("A", 1.0, 1, "10:00:00")] * 20, *[body("A", 9.0, 1, "10:00:01")] * 20)
    feed.add(body("A", 9.0, 1, "10:30:00"))
    root, checkpoint = new_dir(spark, "s"), new_dir(spark, "c")
    alerts = jobs.deviation_alerts(parsed(spark, feed), "5 minutes")
    run(alerts.withColumn("date_partition", F.to_date("event_time")), root, checkpoint)
    assert tables.read_table(spark, root).count() == 40


def test_tick_job(spark, feed):
    fill(feed)
    feed.add("not json", body("A", None, 1, "10:12:31"))
    out = new_dir(spark, "job")
    queries = jobs.run_streams(feed.stream(spark), f"{out}/t", f"{out}/c", every=None, high_low=True)
    jobs.await_all(queries)
    assert sorted(q.name for q in queries) == ["raw", "vwap_1m", "vwap_5m"]
    raw = tables.read_table(spark, f"{out}/t/raw")
    assert bag(raw.select("ticker", "price", "volume")) == sorted([t[:3] for t in TICKS], key=repr)
    assert "timestamp" not in raw.columns
    rejected = tables.read_table(spark, f"{out}/t/quarantine")
    assert rejected.count() == 2
    assert "not json" in [r["raw_value"] for r in rejected.collect()]
    made = tables.read_table(spark, f"{out}/t/vwap_5m")
    assert {"price_high_5m", "price_low_5m", "date_partition"} <= set(made.columns)
    batch = windows.vwap(raw, "5 minutes", high_low=True)
    closed = batch.filter("window_end <= timestamp'2024-06-03 10:10:30'")
    assert bag(made.select(*batch.columns)) == bag(closed)


def test_a_failing_query_stops_the_others_and_is_raised(spark, feed, tmp_path):
    fill(feed)
    ticks = parsed(spark, feed)

    def fail(batch, batch_id):
        raise RuntimeError("no space left")

    good = sinks.append_stream(ticks, new_dir(spark, "s"), new_dir(spark, "c"), every="1 second")
    bad = sinks.each_batch(ticks, fail, new_dir(spark, "c"), every=None)
    with pytest.raises(StreamingQueryException, match="no space left"):
        jobs.await_all([good, bad])
    assert not good.isActive


def test_alerts_equal_batch_deviation(spark, feed):
    fill(feed)
    root, checkpoint = new_dir(spark, "s"), new_dir(spark, "c")
    alerts = jobs.deviation_alerts(parsed(spark, feed), "5 minutes", salts=3)
    run(alerts.withColumn("date_partition", F.to_date("event_time")), root, checkpoint)
    ticks = parse.parse_events(feed.batch(spark))
    batch = analytics.vwap_deviation(ticks, windows.vwap(ticks, "5 minutes"), "5 minutes")
    expected = batch.filter("event_time < timestamp'2024-06-03 10:10:00'")
    found = tables.read_table(spark, root).select(*expected.columns)
    assert bag(found) == bag(expected) and found.count() > 0


def test_alerts_release_their_state(spark, feed):
    fill(feed)
    alerts = jobs.deviation_alerts(parsed(spark, feed), "1 minute", salts=2)
    query = run(
        alerts.withColumn("date_partition", F.to_date("event_time")),
        new_dir(spark, "s"), new_dir(spark, "c"),
    )
    rows = jobs.progress_rows(query).orderBy("batch_id").collect()
    # At the end only what belongs to the last, open windows waits: two tickers' ticks
    # and their sums at 10:12.
    assert max(r["state_rows"] for r in rows) > rows[-1]["state_rows"]
    assert rows[-1]["state_rows"] <= 4


def test_backfill_resumes_where_it_ended(spark, feed, tmp_path):
    path, checkpoint = str(tmp_path / "dump"), new_dir(spark, "c")
    fill(feed)
    feed.add("not json")
    jobs.backfill(spark, feed.folder, path, checkpoint).awaitTermination()
    feed.add(body("C", 1.0, 1, "11:00:00"))
    jobs.backfill(spark, feed.folder, path, checkpoint).awaitTermination()
    stored = [r["value"] for r in spark.read.text(path).select("value").collect()]
    assert sorted(stored) == sorted([*(body(*t) for t in TICKS), "not json", body("C", 1.0, 1, "11:00:00")])


def test_publishing_a_stream(spark, feed, tmp_path):
    fill(feed)
    out = messages.to_messages(parsed(spark, feed))
    query = sinks.publish_stream(out, new_dir(spark, "c"), "parquet", every=None, path=str(tmp_path / "topic"))
    query.awaitTermination()
    again = parse.parse_events(spark.read.parquet(str(tmp_path / "topic")))
    assert bag(again.select("ticker", "price", "volume")) == sorted([t[:3] for t in TICKS], key=repr)


def test_streamed_windows_carry_the_watermark(spark, feed):
    fill(feed)
    made = windows.vwap(parsed(spark, feed))
    assert made.isStreaming and "EventTimeWatermark" in made._jdf.queryExecution().analyzed().toString()


def test_triggers():
    assert trigger() == {"processingTime": "30 seconds"}
    assert trigger(None) == {"availableNow": True}


def test_bus_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_backlog(spark, "stock-ticks", "kafka", **{"kafka.bootstrap.servers": "localhost:9"})


def test_delivery_log(spark, feed, caplog):
    fill(feed)
    listener = jobs.DeliveryLog()
    spark.streams.addListener(listener)
    try:
        with caplog.at_level(logging.INFO, logger="tickengine.streaming.jobs"):
            run(parsed(spark, feed), new_dir(spark, "s"), new_dir(spark, "c"))
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert any("delivered" in r.getMessage() for r in caplog.records)


def test_chained_windows_equal_single_ones(spark, feed):
    fill(feed)
    feed.add(body("A", 1.0, 1, "10:40:00"))
    lengths, root = ("1 minute", "5 minutes", "15 minutes"), new_dir(spark, "s")
    ticks = parse.parse_events(feed.batch(spark))
    chained = windows.chained_vwap(parsed(spark, feed), lengths, high_low=True)
    query = jobs.chain_stream(chained, root, new_dir(spark, "c"), lengths, every=None)
    query.awaitTermination()
    assert sum(r["input_rows"] for r in jobs.progress_rows(query).collect()) == len(TICKS) + 1
    for length, name in zip(lengths, ("1m", "5m", "15m")):
        single = windows.vwap(ticks, length, high_low=True).filter("window_start < timestamp'2024-06-03 10:15:00'")
        made = tables.read_table(spark, f"{root}/vwap_{name}")
        assert bag(made.select(*single.columns)) == bag(single)
        batch = windows.chain_rows(windows.chained_vwap(ticks, lengths, high_low=True), lengths, length)
        assert bag(batch) == bag(windows.vwap(ticks, length, high_low=True))
    with pytest.raises(ValueError, match="multiple"):
        windows.chained_vwap(ticks, ("2 minutes", "5 minutes"))


def test_tick_job_with_chained_windows(spark, feed):
    fill(feed)
    out = new_dir(spark, "job")
    queries = jobs.run_streams(feed.stream(spark), f"{out}/t", f"{out}/c", every=None, chained=True)
    jobs.await_all(queries)
    assert sorted(q.name for q in queries) == ["raw", "vwap"]
    made = tables.read_table(spark, f"{out}/t/vwap_5m")
    expected = windows.vwap(tables.read_table(spark, f"{out}/t/raw"), "5 minutes")
    assert bag(made.select(*expected.columns)) == bag(expected.filter("window_end <= timestamp'2024-06-03 10:10:30'"))
    assert tables.read_table(spark, f"{out}/t/vwap_1m").agg(F.sum("tick_count_1m")).first()[0] == 6


def test_late_ticks_are_kept_and_their_windows_repaired(spark, feed):
    fill(feed)
    feed.add(body("A", 100.0, 7, "10:00:20"), body("C", 3.0, 1, "10:04:00"))  # windows closed, one of them unknown
    feed.add(body("A", 2.0, 1, "10:12:40"))
    raw, late, made = (new_dir(spark, n) for n in ("r", "l", "v"))
    ticks = parse.raw_columns(parsed(spark, feed)).drop("date_partition")
    jobs.append_with_late(ticks, raw, late, new_dir(spark, "c"), every=None).awaitTermination()
    assert {r["ticker"] for r in tables.read_table(spark, late).collect()} == {"A", "C"}
    assert tables.read_table(spark, late).count() == 2
    run(windows.with_date(windows.vwap(parsed(spark, feed))), made, new_dir(spark, "c"))
    repaired = jobs.repair_windows(spark, raw, late, made)
    assert repaired is not None
    for _ in range(2):  # a repair may be repeated
        expected = windows.vwap(tables.read_table(spark, raw)).filter("window_end <= timestamp'2024-06-03 10:10:30'")
        assert bag(tables.read_table(spark, made).select(*expected.columns)) == bag(expected)
        jobs.repair_windows(spark, raw, late, made)


def test_late_ticks_after_a_restart(spark, feed):
    raw, late, checkpoint = (new_dir(spark, n) for n in ("r", "l", "c"))
    ticks = parse.raw_columns(parsed(spark, feed)).drop("date_partition")
    for at in ("10:00:00", "10:30:00", "10:01:00", "10:29:00"):
        feed.add(body("A", 1.0, 1, at))
        jobs.append_with_late(ticks, raw, late, checkpoint, every=None).awaitTermination()
    assert [str(r["event_time"]) for r in tables.read_table(spark, late).collect()] == ["2024-06-03 10:01:00"]
    assert jobs.repair_windows(spark, raw, late, new_dir(spark, "none")) is None


def test_outages_open_and_end(spark, feed):
    root, checkpoint = new_dir(spark, "o"), new_dir(spark, "c")

    def told():
        jobs.outage_stream(parsed(spark, feed), root, checkpoint, "5 minutes", every=None).awaitTermination()
        found = tables.stored_rows(spark, root)
        return [] if found is None else sorted(
            (r["ticker"], str(r["gap_start"])[11:], str(r["gap_end"])[11:], r["gap_seconds"])
            for r in jobs.outages(spark, root, "5 minutes").collect()
        )

    feed.add(body("A", 1.0, 1, "10:00:00"), body("B", 1.0, 1, "10:00:00"), body("A", 1.0, 1, "10:04:00"))
    feed.add(body("B", 1.0, 1, "10:08:00"))
    # The watermark is at 10:06, six minutes after B's last tick and two after A's.
    assert told() == [("B", "10:00:00", "", None)]
    feed.add(body("B", 1.0, 1, "10:12:00"))
    feed.add(body("B", 1.0, 1, "10:12:30"))
    assert ("A", "10:04:00", "", None) in told()
    feed.add(body("A", 1.0, 1, "10:20:00"))
    feed.add(body("A", 1.0, 1, "10:40:00"), body("B", 1.0, 1, "10:40:00"))
    feed.add(body("B", 1.0, 1, "10:41:00"))
    rows = told()
    assert ("A", "10:04:00", "10:20:00", 960) in rows and ("B", "10:00:00", "10:08:00", 480) in rows
    assert ("A", "10:20:00", "", None) in rows


def test_silent_tickers_as_windows_close(spark, feed):
    fill(feed)
    root = new_dir(spark, "s")
    found = jobs.silent_tickers(parsed(spark, feed), ["A", "B", "C", "C"], "5 minutes")
    run(windows.with_date(found), root, new_dir(spark, "c"))
    rows = [(str(r["window_start"])[11:16], r["ticker"]) for r in tables.read_table(spark, root).collect()]
    assert sorted(rows) == [("10:00", "C"), ("10:05", "B"), ("10:05", "C")]


def test_observed_rules_per_batch(spark, feed):
    fill(feed)
    told, root = jobs.ObservedBatches("rules"), new_dir(spark, "o")
    spark.streams.addListener(told)
    try:
        run(jobs.observe_rules(parsed(spark, feed), "rules"), new_dir(spark, "s"), new_dir(spark, "c"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        for _ in range(50):
            if len(told.batches) >= len(TICKS):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(told)
    rows = told.rows(spark)
    assert rows.filter("rule = 'price_missing'").agg(F.sum("rows_checked")).first()[0] == len(TICKS)
    told.flush(spark, root)
    assert told.batches == [] and tables.read_table(spark, root).count() == 6 * len(TICKS)
    told.flush(spark, root)


def test_alerts_from_stored_windows(spark, feed):
    fill(feed)
    stored, root = new_dir(spark, "v"), new_dir(spark, "s")
    ticks = parse.parse_events(feed.batch(spark))
    tables.upsert(windows.with_date(windows.vwap(ticks, "5 minutes")), stored)
    query = jobs.stored_alerts(parsed(spark, feed), stored, root, new_dir(spark, "c"), "5 minutes", every=None)
    query.awaitTermination()
    expected = analytics.vwap_deviation(ticks, windows.vwap(ticks, "5 minutes"), "5 minutes")
    assert bag(tables.read_table(spark, root).select(*expected.columns)) == bag(expected) and expected.count() > 0
    assert not any(r["state_rows"] for r in jobs.progress_rows(query).collect())


def test_deliveries_as_a_table(spark, feed):
    fill(feed)
    log, root = jobs.Deliveries(), new_dir(spark, "d")
    log.flush(spark, root)
    spark.streams.addListener(log)
    try:
        run(parsed(spark, feed), new_dir(spark, "s"), new_dir(spark, "c"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    kept = list(log.batches)
    assert log.ended and log.ended[0][1] is None
    log.flush(spark, root)
    assert log.batches == []
    log.batches = list(kept)  # a batch that ran again
    log.flush(spark, root)
    stored = tables.read_table(spark, root)
    assert stored.count() == len({r[:4:2] for r in kept})
    assert stored.agg(F.sum("input_rows")).first()[0] == feed.batch(spark).count()
    assert stored.filter("end_offset IS NULL").isEmpty()
