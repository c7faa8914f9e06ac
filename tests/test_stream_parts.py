"""The stream of ten parts that queries make of the events."""

import datetime as dt
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tickengine.plans import registry
from tickengine.session import new_dir
from tickengine.sources.ticks import list_files
from tickengine.streaming import jobs
from tickengine.streaming.sinks import each_batch

START = dt.datetime(2024, 1, 1)


def events_of(spark, seconds):
    """A folder with events at these seconds, in four tasks."""
    sf = new_dir(spark, "sf")
    rows = [(i, START + dt.timedelta(seconds=s), i, "view", 1.5, '{"k": 2}') for i, s in enumerate(seconds)]
    made = spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    )
    made.repartition(4).write.parquet(f"{sf}/events.parquet")
    return sf


def batches_of(spark, sf, monkeypatch, rows_per_file):
    """Files of the parts, and the ids of each batch."""
    folders, seen = [], []
    monkeypatch.setattr(registry, "ROWS_PER_FILE", rows_per_file)
    monkeypatch.setattr(registry, "new_dir", lambda *a: folders.append(new_dir(*a)) or folders[-1])
    ticks = registry.ten_files(spark, sf)
    write = lambda batch, _: seen.append(sorted(r[0] for r in batch.select("event_id").collect()))
    each_batch(ticks, write, new_dir(spark, "checkpoint"), every=None).awaitTermination()
    return list_files(spark, folders[0], pattern="*.parquet").count(), seen


def test_large_parts_are_several_files_and_one_batch_each(spark, monkeypatch):
    sf = events_of(spark, range(400))
    files, seen = batches_of(spark, sf, monkeypatch, 10)
    assert files == 40
    few, plain = batches_of(spark, sf, monkeypatch, 1000)
    assert few == 10 and seen == plain
    assert len(seen) == 10 and seen[-1][0] == 0  # the first tick comes last
    assert sorted(sum(seen, [])) == list(range(400))


def test_parts_of_few_rows_keep_batches_apart(spark, monkeypatch):
    """Nearly all events at one time: most parts have no rows, but their files."""
    sf = events_of(spark, [0, 1, *[60] * 200])
    files, seen = batches_of(spark, sf, monkeypatch, 5)
    few, plain = batches_of(spark, sf, monkeypatch, 1000)
    assert files == 50 and few == 10
    assert seen == plain and sorted(sum(seen, [])) == list(range(202))


@pytest.mark.parametrize(
    "name, log, wanted",
    [
        ("stream_deliveries", jobs.Deliveries, {("ticks", 10, 40)}),
        ("stream_late_rows", jobs.LateRows, {("late", 1)}),
        ("stream_quality", jobs.ObservedBatches, {40}),
    ],
)
def test_reports_that_come_late_are_waited_for(spark, monkeypatch, name, log, wanted):
    """The last reports take seconds, and a wait of a number of tries would be over at once."""
    hear = log.onQueryProgress

    def slow(self, event):
        if event.progress.batchId >= 8:
            time.sleep(2)
        hear(self, event)

    monkeypatch.setattr(log, "onQueryProgress", slow)
    monkeypatch.setattr(registry, "time", SimpleNamespace(sleep=lambda _: None), raising=False)
    found = registry.QUERIES[name](spark, events_of(spark, range(0, 400_000, 10_000)))
    if name == "stream_quality":
        found = found.select("rows_checked").distinct()
        assert {r[0] for r in found.collect()} == wanted
    else:
        columns = ["name", *sorted(set(found.columns) - {"name"})]
        assert {tuple(r) for r in found.select(columns).collect()} == wanted


def test_a_missing_end_fails(spark):
    ticks = registry.ten_files(spark, events_of(spark, range(40)))
    made = each_batch(ticks, lambda *_: None, new_dir(spark, "checkpoint"), every=None)
    made.awaitTermination()
    with pytest.raises(TimeoutError):
        jobs.Ends().wait(made, silence=0.1)
