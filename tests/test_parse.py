import datetime as dt
import json

import pytest
from pyspark.sql import Observation, functions as F

from sample_ticks import SAMPLE
from tickengine.operators import parse, quality
from tickengine.schemas import CONTRACT, REQUIRED, TICK_SCHEMA, struct_from_record
from tickengine.sources import messages

FIELDS = TICK_SCHEMA.fieldNames()


def bodies():
    return [json.dumps(dict(zip(FIELDS, row))) for row in SAMPLE]


@pytest.fixture
def parsed(messages_of):
    return parse.parse_events(messages_of(bodies()))


def test_columns_in_order(parsed):
    assert parsed.columns == [*FIELDS, "event_time", "ingest_time", "date_partition"]


def test_payload_only(messages_of):
    assert parse.parse_payload(messages_of(bodies())).schema == TICK_SCHEMA


def test_text_value_works_too(spark):
    text = spark.createDataFrame([(b,) for b in bodies()], "value string")
    assert parse.parse_events(text).count() == len(SAMPLE)


def test_row_count_tickers_and_prices(parsed):
    assert parsed.count() == len(SAMPLE)
    assert parsed.filter(F.col("ticker").isNull()).count() == 0
    assert parsed.filter(F.col("price") <= 0).count() == 0
    assert all(r["passed"] for r in quality.rules(parsed).collect())


def test_times(messages_of):
    body = '{"ticker":"A","price":1.0,"timestamp":"2024-06-01T10:00:00.123456"}'
    row = parse.parse_events(messages_of([body])).select(
        F.col("event_time").cast("string").alias("at"), "date_partition"
    ).first()
    assert row["at"] == "2024-06-01 10:00:00.123456"
    assert row["date_partition"] == dt.date(2024, 6, 1)


def test_bad_messages_do_not_fail(messages_of):
    bad = ["not json", '{"ticker":"B"', None, '{"ticker":"C","price":"x","volume":1.5,"timestamp":"bad"}']
    parsed = parse.parse_events(messages_of(bad), keep_raw=True)
    rows = parsed.collect()
    assert [r["ticker"] for r in rows] == [None, None, None, "C"]
    assert all(r["price"] is None and r["event_time"] is None for r in rows)
    assert [r["raw_value"] for r in rows] == bad


def test_unknown_key_is_ignored(messages_of):
    row = parse.parse_payload(messages_of(['{"ticker":"A","extra":{"a":1},"price":2}'])).first()
    assert (row["ticker"], row["price"]) == ("A", 2.0)


def test_split_is_complete_and_says_why(messages_of):
    good = bodies()
    bad = ["not json", '{"ticker":"C","price":1.0}', '{"price":1.0,"timestamp":"2024-06-01T10:00:00"}']
    parsed = parse.parse_events(messages_of(good + bad))
    valid, rejected = parse.split_valid(parsed)
    assert valid.count() == len(good)
    reasons = sorted(tuple(r["missing_fields"]) for r in rejected.collect())
    assert reasons == [("event_time",), ("ticker",), ("ticker", "price", "event_time")]


def test_counts_are_observed_on_the_way(messages_of):
    seen = Observation()
    parse.observe_validity(parse.parse_events(messages_of(bodies() + ["x"])), seen).collect()
    assert seen.get == {"rows_in": 5, "rows_quarantined": 1}


def test_message_roundtrip(messages_of, parsed):
    sent = messages.to_messages(parsed)
    assert [f.dataType.typeName() for f in sent.schema] == ["binary", "binary"]
    back = parse.parse_payload(sent)
    assert sorted(back.collect()) == sorted(parsed.select(*FIELDS).collect())
    keys = {bytes(r["key"]).decode() for r in sent.collect()}
    assert keys == {row[0] for row in SAMPLE}


def test_body_is_parsed_once(parsed):
    valid, rejected = parse.split_valid(parsed)
    for df in (parsed, valid, rejected, parsed.filter("price > 1").select("ticker")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1


def test_raw_columns_drop_the_time_text(parsed):
    assert "timestamp" not in parse.raw_columns(parsed).columns


def test_contract():
    assert CONTRACT.fieldNames() == FIELDS
    assert [f.dataType for f in CONTRACT] == [f.dataType for f in TICK_SCHEMA]
    assert REQUIRED == ["ticker", "price", "event_time"]
    with pytest.raises(ValueError):
        struct_from_record({"fields": [{"name": "x", "type": ["int", "string"]}]})
