"""Messages to typed ticks, and the split of good rows from bad ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tickengine.functions import times
from tickengine.schemas import RAW_SCHEMA, REQUIRED, TICK_SCHEMA


def parse_payload(
    messages: DataFrame,
    *,
    value: str = "value",
    schema: T.StructType = TICK_SCHEMA,
    keep_raw: bool = False,
) -> DataFrame:
    """Decode the message body (binary or text JSON) into the declared columns.

    Unreadable JSON gives a row of NULLs, a field of the wrong type gives one NULL,
    unknown keys are dropped. ``keep_raw`` keeps the text as ``raw_value``.

    The struct is unfolded by ``inline`` rather than by ``select("data.*")``: filters on
    its fields are not pushed through a generator, whereas below a projection each of
    them would parse the message again.
    """
    text = F.col(value).cast("string")
    fields = F.inline(F.array(F.from_json(text, schema)))
    if not keep_raw:
        return messages.select(fields)
    return messages.select(fields, text.alias("raw_value"))


def enrich(ticks: DataFrame) -> DataFrame:
    """Add event time, ingest time and the partition date to decoded messages."""
    return ticks.withColumns(
        {
            "event_time": times.parse_iso(F.col("timestamp")),
            "ingest_time": F.current_timestamp(),
        }
    ).withColumn("date_partition", F.to_date("event_time"))


def parse_events(
    messages: DataFrame,
    *,
    value: str = "value",
    schema: T.StructType = TICK_SCHEMA,
    keep_timestamp: bool = True,
    keep_raw: bool = False,
) -> DataFrame:
    """Messages to enriched ticks; ``keep_timestamp=False`` drops the time text."""
    parsed = enrich(parse_payload(messages, value=value, schema=schema, keep_raw=keep_raw))
    return parsed if keep_timestamp else parsed.drop("timestamp")


def raw_columns(ticks: DataFrame) -> DataFrame:
    """The columns of the raw table, plus any the table does not know yet."""
    known = RAW_SCHEMA.fieldNames()
    extra = [c for c in ticks.columns if c not in known and c != "timestamp"]
    return ticks.select(*known, *extra)


def missing_fields(required: list[str] = REQUIRED) -> Column:
    """Names of the required columns that are NULL, as an array."""
    absent = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    return F.array_compact(F.array(*absent))


def is_complete(required: list[str] = REQUIRED) -> Column:
    complete = F.lit(True)
    for column in required:
        complete = complete & F.col(column).isNotNull()
    return complete


def split_valid(
    ticks: DataFrame, required: list[str] = REQUIRED, *, max_ahead: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the contract, and the others with ``missing_fields``.

    With ``max_ahead`` a row whose event time lies further after its arrival breaks it
    too: one such row would move a stream's watermark and make all others late. It is
    told as ``event_time_ahead``.
    """
    good, told = is_complete(required), missing_fields(required)
    if max_ahead is not None:
        limit = F.col("ingest_time") + times.interval(max_ahead)
        ahead = F.coalesce(F.col("event_time") > limit, F.lit(False))
        good = good & ~ahead
        told = F.concat(told, F.when(ahead, F.array(F.lit("event_time_ahead"))).otherwise(F.array()))
    return ticks.filter(good), ticks.filter(~good).withColumn("missing_fields", told)


def observe_validity(
    ticks: DataFrame, observation: Observation | str, required: list[str] = REQUIRED
) -> DataFrame:
    """Count rows in and rows quarantined while they pass, without another scan.

    For reports only: adaptive execution drops the counts with a stage that turns out
    empty, e.g. when a filter above leaves no row.
    """
    return ticks.observe(
        observation,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~is_complete(required)).alias("rows_quarantined"),
    )
