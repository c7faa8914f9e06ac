"""Streams whose tables have no row, and hence no file."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from tickengine.plans import registry
from tickengine.session import new_dir
from tickengine.sources import tables

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def sf(spark):
    """A minute of ticks of one price: no outage, no closed hour, no alert."""
    path = new_dir(spark, "sf")
    rows = [(i, START + dt.timedelta(seconds=i), i, "view", 1.5, '{"k": 2}') for i in range(60)]
    spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ).write.parquet(f"{path}/events.parquet")
    return path


@pytest.mark.parametrize("name", ["stream_outages", "stream_alerts_stored", "stream_vwap_chained"])
def test_streams_without_rows(spark, sf, name):
    found = registry.QUERIES[name](spark, sf)
    some = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert found.collect() == [] and found.schema.simpleString() == some.schema.simpleString()


def test_reading_a_table_without_files(spark):
    root = new_dir(spark, "none")
    with pytest.raises(AnalysisException):
        tables.read_table(spark, root)
    schema = "ticker string, date_partition date"
    for made in (False, True):  # no folder, and a folder without rows
        if made:
            tables.overwrite_dates(spark.createDataFrame([], schema), root)
        rows = tables.read_table(spark, root, first="2024-01-01", schema=schema)
        assert rows.columns == ["ticker", "date_partition"] and rows.isEmpty()
