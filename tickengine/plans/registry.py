"""Queries over the shipped tables, one per operator, and their SQL equivalents.

``events`` plays the tick table (see ``ticks_from_events``); ``lineitem`` and ``orders``
are larger or tie-ridden tick tables. Prices have two decimals, so VWAPs are summed in
whole cents and do not depend on the order of rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from tickengine.functions import times
from tickengine.operators import analytics, parse, quality, windows
from tickengine.plans import maintenance, replay
from tickengine.session import configure, new_dir
from tickengine.sources import messages, tables
from tickengine.sources.ticks import (
    list_files,
    read_path,
    ticks_from_events,
    ticks_from_lineitem,
)
from tickengine.streaming import jobs, sinks
from tickengine.streaming.source import read_tick_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DAY = "2024-01-10"  # a date all scales have ticks on

# The tick view of ``events`` in SQL.
TICKS = (
    "(SELECT event_type AS ticker, value AS price, CAST(props->>'$.k' AS BIGINT) AS volume, "
    "ts AS event_time, event_id FROM events)"
)


def query(oracle: str | None = None):
    """Register a query under its function name, with the SQL it has to equal."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_path(configure(spark), f"{sf}/{name}.parquet")


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    return ticks_from_events(table(spark, sf, "events"))


def dated_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return ticks(spark, sf).withColumn("date_partition", F.to_date("event_time"))


def streamed_ticks(spark: SparkSession, sf: str) -> DataFrame:
    # The bracket makes the path a pattern, which a stream needs to accept a file.
    path = f"{sf}/event[s].parquet"
    schema = table(spark, sf, "events").schema
    return ticks_from_events(read_tick_stream(spark, path, "parquet", schema))


def ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns as zone-less times, the type the shipped tables have."""
    zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def vwap_table(spark: SparkSession, sf: str, duration: str) -> DataFrame:
    """VWAP windows as a written table, the way the alert query meets them."""
    root = new_dir(spark, "vwap")
    tables.upsert(dated_vwap(ticks(spark, sf), duration), root)
    return tables.read_table(spark, root)


def dated_vwap(found: DataFrame, duration: str, decimals: int | None = 2) -> DataFrame:
    return windows.with_date(windows.vwap(found, duration, decimals=decimals))


# --- SQL building blocks -------------------------------------------------------------


def vwap_sql(width: str, suffix: str, source: str = TICKS, extra: str = "") -> str:
    return f"""
        SELECT time_bucket(INTERVAL '{width}', event_time) AS window_start,
               time_bucket(INTERVAL '{width}', event_time) + INTERVAL '{width}' AS window_end,
               ticker,
               CAST(SUM(CAST(ROUND(price * 100) AS BIGINT) * volume) AS DOUBLE)
                   / NULLIF(CAST(SUM(volume) AS DOUBLE) * 100.0, 0) AS vwap_{suffix},
               CAST(SUM(volume) AS BIGINT) AS total_volume_{suffix},
               COUNT(*) AS tick_count_{suffix}{extra}
        FROM {source} GROUP BY ALL"""


def movers_sql(where: str, limit: str) -> str:
    return f"""
        SELECT ticker, open_price, close_price,
               ROUND((close_price - open_price) / NULLIF(open_price, 0) * 100, 2) AS pct_change,
               total_volume
        FROM (SELECT ticker, arg_min(price, (event_time, event_id)) AS open_price,
                     arg_max(price, (event_time, event_id)) AS close_price,
                     CAST(SUM(volume) AS BIGINT) AS total_volume
              FROM {TICKS} {where} GROUP BY ticker)
        ORDER BY ABS(pct_change) DESC NULLS LAST, ticker {limit}"""


def deviation_sql(
    width: str, suffix: str, upper: str, having: str = "TRUE", source: str = TICKS
) -> str:
    return f"""
        SELECT r.ticker, r.event_time, r.price, v.vwap_{suffix},
               ROUND(ABS(r.price - v.vwap_{suffix}) / NULLIF(v.vwap_{suffix}, 0) * 100, 2)
                   AS deviation_pct
        FROM {source} r JOIN ({vwap_sql(width, suffix, source)}) v
          ON r.ticker = v.ticker AND r.event_time >= v.window_start
             AND r.event_time {upper} v.window_end
        WHERE ABS(r.price - v.vwap_{suffix}) / NULLIF(v.vwap_{suffix}, 0) > 0.01 AND {having}"""


LINEITEM_TICKS = (
    "(SELECT l_returnflag AS ticker, l_extendedprice AS price, "
    "CAST(l_quantity AS BIGINT) AS volume, l_shipdate AS event_time FROM lineitem)"
)
NEWEST = "(SELECT MAX(ts) FROM events)"
CLOSED = f"window_end <= {NEWEST} - INTERVAL '2 minutes'"


# --- windows ---------------------------------------------------------------------------


@query(vwap_sql("1 minute", "1m"))
def vwap_1m(spark, sf):
    return windows.vwap(ticks(spark, sf), "1 minute", decimals=2)


@query(vwap_sql("5 minutes", "5m"))
def vwap_5m(spark, sf):
    return windows.vwap(ticks(spark, sf), "5 minutes", decimals=2)


@query(vwap_sql("1 hour", "1h"))
def vwap_1h(spark, sf):
    return windows.vwap(ticks(spark, sf), "1 hour", decimals=2)


@query(
    f"""SELECT ticker, CAST(SUM(CAST(ROUND(price * 100) AS BIGINT) * volume) AS DOUBLE)
               / NULLIF(CAST(SUM(volume) AS DOUBLE) * 100.0, 0) AS vwap,
               CAST(SUM(volume) AS BIGINT) AS total_volume, COUNT(*) AS tick_count
        FROM {TICKS} GROUP BY ticker"""
)
def vwap_total(spark, sf):
    return windows.vwap(ticks(spark, sf), None, decimals=2)


@query(
    vwap_sql(
        "5 minutes", "5m", extra=", MAX(price) AS price_high_5m, MIN(price) AS price_low_5m"
    )
)
def window_high_low(spark, sf):
    return windows.vwap(ticks(spark, sf), "5 minutes", high_low=True, decimals=2)


@query(vwap_sql("1 day", "1d", LINEITEM_TICKS, ", MAX(price) AS price_high_1d, MIN(price) AS price_low_1d"))
def vwap_lineitem_1d(spark, sf):
    source = ticks_from_lineitem(table(spark, sf, "lineitem"))
    return windows.vwap(source, "1 day", high_low=True, decimals=2)


@query(
    vwap_sql("1 hour", "1h", f"(SELECT * REPLACE (ROUND(price) AS price) FROM {TICKS})").replace(
        "CAST(SUM(CAST(ROUND(price * 100) AS BIGINT) * volume) AS DOUBLE)", "SUM(price * volume)"
    ).replace("CAST(SUM(volume) AS DOUBLE) * 100.0", "SUM(volume)")
)
def vwap_double_sums(spark, sf):
    """The default: sums of doubles, exact here because the prices are whole numbers."""
    return windows.vwap(ticks(spark, sf).withColumn("price", F.round("price")), "1 hour")


# --- analytics -------------------------------------------------------------------------


@query(movers_sql(f"WHERE event_time >= {NEWEST} - INTERVAL '1 hour'", "LIMIT 10"))
def top_movers(spark, sf):
    found = ticks(spark, sf)
    return analytics.top_movers(found, times.newest(found), "1 hour", 10, tie="event_id")


@query(movers_sql(f"WHERE event_time >= {NEWEST} - INTERVAL '7 days'", "LIMIT 3"))
def top_movers_week(spark, sf):
    found = ticks(spark, sf)
    return analytics.top_movers(found, times.newest(found), "7 days", 3, tie="event_id")


@query(movers_sql(f"WHERE event_time >= {NEWEST} - INTERVAL '1 day'", ""))
def top_movers_unlimited(spark, sf):
    found = ticks(spark, sf)
    return analytics.top_movers(found, times.newest(found), "1 day", None, tie="event_id")


@query(
    """SELECT ticker, open_price, close_price,
              ROUND((close_price - open_price) / open_price * 100, 2) AS pct_change, total_volume
       FROM (SELECT o_orderpriority AS ticker,
                    arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS open_price,
                    arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS close_price,
                    COUNT(*) AS total_volume
             FROM orders GROUP BY o_orderpriority)"""
)
def top_movers_tied(spark, sf):
    """Whole-day times tie thousands of ticks; the order key decides."""
    found = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("ticker"),
        F.col("o_totalprice").alias("price"),
        F.lit(1).cast("long").alias("volume"),
        F.col("o_orderdate").alias("event_time"),
        "o_orderkey",
    )
    return analytics.top_movers(found, lookback=None, n=None, tie="o_orderkey")


PRICELESS = f"(SELECT * REPLACE (CASE WHEN volume >= 50 THEN price END AS price) FROM {TICKS})"


@query(movers_sql("", "").replace(TICKS, PRICELESS))
def top_movers_priceless(spark, sf):
    """Half of the ticks lack a price, first and last ones included."""
    found = ticks(spark, sf).withColumn("price", F.when(F.col("volume") >= 50, F.col("price")))
    return analytics.top_movers(found, lookback=None, n=None, tie="event_id")


@query(
    f"""SELECT ticker, arg_min(price, event_time) AS open_price,
               arg_max(price, event_time) AS close_price,
               CAST(SUM(volume) AS BIGINT) AS total_volume
        FROM {TICKS} WHERE event_time >= {NEWEST} - INTERVAL '1 day' GROUP BY ticker"""
)
def sql_text_movers(spark, sf):
    """The same question as SQL text over a registered view."""
    tables.register_views(spark, stock_ticks_raw=ticks(spark, sf))
    return spark.sql(
        """SELECT ticker, min_by(price, event_time) AS open_price,
                  max_by(price, event_time) AS close_price, SUM(volume) AS total_volume
           FROM stock_ticks_raw
           WHERE event_time >= (SELECT MAX(event_time) FROM stock_ticks_raw) - INTERVAL 1 DAY
           GROUP BY ticker"""
    )


def deviation(spark, sf, duration: str, **options) -> DataFrame:
    found = ticks(spark, sf)
    return analytics.vwap_deviation(found, dated_vwap(found, duration), duration, **options)


@query(deviation_sql("1 hour", "1h", "<"))
def vwap_deviation(spark, sf):
    return deviation(spark, sf, "1 hour")


@query(deviation_sql("1 minute", "1m", "<"))
def vwap_deviation_1m(spark, sf):
    return deviation(spark, sf, "1 minute", ordered=False)


@query(deviation_sql("1 hour", "1h", "<="))
def vwap_deviation_closed(spark, sf):
    return deviation(spark, sf, "1 hour", closed="both", ordered=False)


@query(deviation_sql("1 hour", "1h", "<"))
def vwap_deviation_hot(spark, sf):
    """The ticks of every window spread over eight parts."""
    return deviation(spark, sf, "1 hour", salts=8, ordered=False)


MINUTE_TICKS = f"(SELECT * REPLACE (date_trunc('minute', event_time) AS event_time) FROM {TICKS})"


@query(deviation_sql("1 minute", "1m", "<=", source=MINUTE_TICKS))
def vwap_deviation_boundary(spark, sf):
    """Every tick on a boundary: it meets the window it starts and the one that ends there."""
    whole = F.date_trunc("minute", "event_time").cast("timestamp_ntz")
    found = ticks(spark, sf).withColumn("event_time", whole)
    return analytics.vwap_deviation(
        found, dated_vwap(found, "1 minute"), "1 minute", closed="both", ordered=False
    )


@query(
    f"""SELECT l.ticker, l.window_start, COUNT(*) AS ticks_matched,
               CAST(SUM(l.volume) AS BIGINT) AS volume_matched,
               MIN(v.total_volume_1d) AS total_volume_1d
        FROM (SELECT *, time_bucket(INTERVAL '1 day', event_time) AS window_start
              FROM {LINEITEM_TICKS}) l
        JOIN ({vwap_sql('1 day', '1d', LINEITEM_TICKS)}) v USING (ticker, window_start)
        GROUP BY ALL"""
)
def window_join_lineitem(spark, sf):
    """The tick-to-window join on a larger table, checked by its totals."""
    source = ticks_from_lineitem(table(spark, sf, "lineitem"))
    made = windows.vwap(source, "1 day", decimals=2)
    return (
        analytics.ticks_with_vwap(source, made, "1 day", carry=("total_volume_1d",))
        .groupBy("ticker", "window_start")
        .agg(
            F.count(F.lit(1)).alias("ticks_matched"),
            F.sum("volume").alias("volume_matched"),
            F.min("total_volume_1d").alias("total_volume_1d"),
        )
    )


@query(
    f"SELECT ticker, price, volume, event_time, event_id FROM {TICKS} "
    "WHERE event_time <= TIMESTAMP '2024-01-15 12:00:00'"
)
def ticks_as_of(spark, sf):
    found = ticks(spark, sf).select("ticker", "price", "volume", "event_time", "event_id")
    return analytics.ticks_as_of(found, "2024-01-15 12:00:00", time="event_time")


@query(
    f"SELECT ticker, price, volume, event_time, event_id FROM {TICKS} "
    "WHERE event_time >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL '2 days' "
    "AND event_time <= TIMESTAMP '2024-01-20 00:00:00'"
)
def recent_ticks(spark, sf):
    found = ticks(spark, sf).select("ticker", "price", "volume", "event_time", "event_id")
    return analytics.recent(found, "2024-01-20 00:00:00", "2 days", until_as_of=True)


# --- parsing and messages -----------------------------------------------------------------

PARSED = "ticker, price, volume, event_time, CAST(event_time AS DATE) AS date_partition"


@query(f"SELECT {PARSED} FROM {TICKS}")
def parse_roundtrip(spark, sf):
    parsed = parse.parse_events(messages.to_messages(ticks(spark, sf)))
    return ntz(parsed.select("ticker", "price", "volume", "event_time", "date_partition"))


@query("SELECT event_type AS ticker, COUNT(*) AS messages, CAST(0 AS BIGINT) AS before_an_earlier FROM events GROUP BY ALL")
def publish_in_order(spark, sf):
    """Messages of each ticker as a sink got them, from ticks in any order: all in one file, by time."""
    folder = new_dir(spark, "bus")
    messages.publish(ticks(spark, sf).repartition(16, "event_id"), "parquet", ordered=True, path=folder)
    sent = spark.read.parquet(folder).select(
        F.decode("key", "UTF-8").alias("ticker"),
        F.get_json_object(F.decode("value", "UTF-8"), "$.timestamp").alias("time"),
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"),
    )
    # A ticker in several files would be sent by several tasks at once.
    place = F.struct("file", "place")
    before = F.lag(F.struct("file", "time")).over(Window.partitionBy("ticker").orderBy(place))
    wrong = (before["file"] != F.col("file")) | (before["time"] > F.col("time"))
    return sent.withColumn("wrong", wrong).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if("wrong").alias("before_an_earlier")
    )


def mixed_messages(spark, sf) -> DataFrame:
    """Ticks as messages, except that ``error`` events send their props as they are."""
    events = table(spark, sf, "events")
    good = messages.to_messages(ticks_from_events(events.filter("event_type <> 'error'")))
    bad = events.filter("event_type = 'error'").select(
        F.encode("event_type", "UTF-8").alias("key"), F.encode("props", "UTF-8").alias("value")
    )
    return good.unionByName(bad)


@query(f"SELECT {PARSED} FROM {TICKS} WHERE ticker <> 'error'")
def split_valid(spark, sf):
    valid, _ = parse.split_valid(parse.parse_events(mixed_messages(spark, sf)))
    return ntz(valid.select("ticker", "price", "volume", "event_time", "date_partition"))


@query(
    """SELECT props AS raw_value, 'ticker,price,event_time' AS missing_fields
       FROM events WHERE event_type = 'error'"""
)
def split_quarantined(spark, sf):
    parsed = parse.parse_events(mixed_messages(spark, sf), keep_raw=True)
    _, rejected = parse.split_valid(parsed)
    return rejected.select(
        "raw_value", F.concat_ws(",", "missing_fields").alias("missing_fields")
    )


@query(
    f"""SELECT ticker, price, event_id_text AS exchange, 'event_time_ahead' AS missing_fields
        FROM (SELECT *, CAST(event_id AS VARCHAR) AS event_id_text FROM {TICKS}) WHERE ticker = 'view'"""
)
def split_ahead(spark, sf):
    """Ticks that claim a time far after their arrival are put aside."""
    found = ticks(spark, sf).withColumns(
        {
            "exchange": F.col("event_id").cast("string"),
            "event_time": F.when(F.col("ticker") == "view", F.expr("event_time + INTERVAL 7000 YEARS"))
            .otherwise(F.col("event_time")),
        }
    )
    parsed = parse.parse_events(messages.to_messages(found))
    _, rejected = parse.split_valid(parsed, max_ahead="1 day")
    return rejected.select(
        "ticker", "price", "exchange", F.concat_ws(",", "missing_fields").alias("missing_fields")
    )


# --- data quality ------------------------------------------------------------------------


@query(
    """SELECT MAX(ts) AS newest,
              datesub('minute', MAX(ts), TIMESTAMP '2024-02-01 00:00:00') AS age_minutes,
              datesub('minute', MAX(ts), TIMESTAMP '2024-02-01 00:00:00') > 10 AS is_stale
       FROM events"""
)
def freshness(spark, sf):
    return quality.freshness(ticks(spark, sf), "2024-02-01 00:00:00", time="event_time")


@query(
    f"""SELECT ticker FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'),
                                   ('refund')) AS expected(ticker)
        WHERE ticker NOT IN (SELECT ticker FROM {TICKS}
                             WHERE event_time >= {NEWEST} - INTERVAL '5 minutes')"""
)
def coverage(spark, sf):
    found = ticks(spark, sf)
    expected = ["click", "error", "purchase", "signup", "view", "refund"]
    return quality.coverage(found, expected, times.newest(found), "5 minutes")


@query(
    f"""SELECT ticker, gap_start, event_time AS gap_end,
               datesub('second', gap_start, event_time) AS gap_seconds
        FROM (SELECT ticker, event_time,
                     LAG(event_time) OVER (PARTITION BY ticker ORDER BY event_time) AS gap_start
              FROM {TICKS})
        WHERE event_time - gap_start > INTERVAL '10 minutes'"""
)
def gaps(spark, sf):
    return quality.gaps(ticks(spark, sf), "10 minutes")


@query(
    "".join(
        f"{'' if i == 0 else ' UNION ALL '}SELECT '{rule}' AS rule, COUNT(*) AS rows_checked, "
        f"COUNT(*) FILTER (WHERE {bad}) AS rows_failed, "
        f"COUNT(*) FILTER (WHERE {bad}) = 0 AS passed FROM {TICKS}"
        for i, (rule, bad) in enumerate(
            {
                "ticker_missing": "ticker IS NULL",
                "price_missing": "price IS NULL",
                "event_time_missing": "event_time IS NULL",
                "price_not_a_number": "isnan(price)",
                "price_not_positive": "price <= 0",
                "volume_negative": "volume < 0",
                "volume_zero": "volume = 0",
            }.items()
        )
    )
)
def dq_rules(spark, sf):
    checks = {**quality.tick_rules(), "volume_zero": F.col("volume") == 0}
    return quality.rules(ticks(spark, sf), checks)


@query(
    f"""SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start, ticker,
               COUNT(*) AS tick_count, COUNT(*) / 3.0 AS rate, COUNT(*) < 3 AS is_low
        FROM {TICKS} GROUP BY ALL"""
)
def tick_rate(spark, sf):
    return quality.tick_rate(ticks(spark, sf), "1 hour", 3, silent=False)


@query(
    f"""WITH counted AS (
            SELECT time_bucket(INTERVAL '10 minutes', event_time) AS window_start, ticker,
                   COUNT(*) AS n FROM {TICKS} GROUP BY ALL),
        slots AS (
            SELECT ticker, UNNEST(generate_series(MIN(window_start), MAX(window_start),
                   INTERVAL '10 minutes')) AS window_start FROM counted GROUP BY ticker)
        SELECT window_start, ticker, COALESCE(n, 0) AS tick_count, COALESCE(n, 0) / 2.0 AS rate,
               COALESCE(n, 0) < 2 AS is_low
        FROM slots LEFT JOIN counted USING (ticker, window_start)"""
)
def tick_rate_silent(spark, sf):
    """Intervals without a tick have a row too."""
    return quality.tick_rate(ticks(spark, sf), "10 minutes", 2)


@query(
    f"""SELECT ticker, gap_start, gap_end, datesub('second', gap_start, gap_end) AS gap_seconds
        FROM (SELECT ticker, event_time AS gap_start,
                     LEAD(event_time, 1, TIMESTAMP '2024-02-01 00:00:00')
                         OVER (PARTITION BY ticker ORDER BY event_time) AS gap_end
              FROM {TICKS})
        WHERE gap_end - gap_start > INTERVAL '10 minutes'
        UNION ALL SELECT 'refund', NULL, TIMESTAMP '2024-02-01 00:00:00', NULL"""
)
def gaps_as_of(spark, sf):
    """Outages that still go on, and a ticker that never came."""
    expected = ["click", "refund"]
    return quality.gaps(ticks(spark, sf), "10 minutes", as_of="2024-02-01 00:00:00", expected=expected)


# --- tables, sinks and maintenance ----------------------------------------------------------

TICK_ROWS = f"SELECT ticker, price, volume, event_time, event_id FROM {TICKS}"
ROW_COLUMNS = ["ticker", "price", "volume", "event_time", "event_id"]
MIDDLE = "2024-01-10 12:00:00"


def written_ticks(spark, sf) -> str:
    """Ticks as a table of two batches, the first of which is written twice."""
    root = new_dir(spark, "ticks")
    found = dated_ticks(spark, sf)
    early = found.filter(F.col("event_time") < F.lit(MIDDLE).cast("timestamp_ntz"))
    late = found.filter(F.col("event_time") >= F.lit(MIDDLE).cast("timestamp_ntz"))
    for batch_id, batch in ((0, early), (1, late), (0, early)):
        tables.write_batch(batch, root, batch_id)
    return root


@query(TICK_ROWS)
def append_batches(spark, sf):
    return tables.read_table(spark, written_ticks(spark, sf)).select(*ROW_COLUMNS)


@query(vwap_sql("1 hour", "1h"))
def upsert_vwap(spark, sf):
    """Windows of the ticks known by noon of a day, overwritten by those of all ticks."""
    root = new_dir(spark, "vwap")
    found = ticks(spark, sf)
    known = found.filter(F.col("event_time") < F.lit(MIDDLE).cast("timestamp_ntz"))
    for batch in (known, found):
        tables.upsert(dated_vwap(batch, "1 hour"), root)
    return tables.read_table(spark, root).drop("date_partition")


EVER = dt.date(2100, 1, 1)


@query(TICK_ROWS)
def compaction(spark, sf):
    """All dates, each from several batches."""
    root = written_ticks(spark, sf)
    maintenance.compact(spark, root, before=EVER, min_files=1)
    return tables.read_table(spark, root).select(*ROW_COLUMNS)


@query(vwap_sql("1 hour", "1h"))
def compaction_upserted(spark, sf):
    """A keyed table after a compaction of all dates."""
    root = new_dir(spark, "vwap")
    found = ticks(spark, sf)
    known = found.filter(F.col("event_time") < F.lit(MIDDLE).cast("timestamp_ntz"))
    for batch in (known, found):
        tables.upsert(dated_vwap(batch, "1 hour"), root)
    maintenance.compact(spark, root, before=EVER, min_files=1)
    return tables.read_table(spark, root).drop("date_partition")


def clustered_ticks(spark, sf, columns: list[str]) -> str:
    """All dates clustered, each into a handful of files at any size of the table."""
    root = written_ticks(spark, sf)
    size, days = maintenance.table_files(spark, root).agg(F.sum("length"), F.count_distinct("date_partition")).first()
    maintenance.zorder(spark, root, columns=columns, before=EVER, target_bytes=max(1, size // (5 * days)))
    return root


@query(TICK_ROWS)
def zorder_rows(spark, sf):
    root = clustered_ticks(spark, sf, ["ticker", "event_time"])
    return tables.read_table(spark, root).select(*ROW_COLUMNS)


@query(
    """SELECT CAST(ts AS DATE) AS date_partition, COUNT(*) AS rows_found, TRUE AS skips_files
       FROM events WHERE event_type = 'click' GROUP BY ALL"""
)
def zorder_files(spark, sf):
    """A ticker's rows lie in some of a date's files only."""
    found = tables.read_table(spark, clustered_ticks(spark, sf, ["ticker"])).select(
        "date_partition", "ticker", F.col("_metadata.file_path").alias("file")
    )
    is_click = F.col("ticker") == "click"
    return found.groupBy("date_partition").agg(
        F.count_if(is_click).alias("rows_found"),
        (F.count_distinct(F.when(is_click, F.col("file"))) < F.count_distinct("file")).alias("skips_files"),
    )


@query(
    f"""SELECT CAST(event_time AS DATE) AS date_partition, COUNT(*) AS "rows",
               COUNT(price) AS price_count, MIN(price) AS price_min, MAX(price) AS price_max,
               COUNT(volume) AS volume_count, MIN(volume) AS volume_min, MAX(volume) AS volume_max
        FROM {TICKS} GROUP BY ALL"""
)
def file_statistics(spark, sf):
    """Counts and bounds of each date, from the footers of its files."""
    root = clustered_ticks(spark, sf, ["ticker"])
    return maintenance.statistics(spark, root, ["price", "volume"])


@query(
    f"""SELECT CAST(CASE WHEN ts < TIMESTAMP '{MIDDLE}' THEN 0 ELSE 1 END AS VARCHAR) AS batch_id,
               COUNT(*) AS "rows", MIN(CAST(ts AS DATE)) AS first_date, MAX(CAST(ts AS DATE)) AS last_date
        FROM events GROUP BY ALL"""
)
def table_loads(spark, sf):
    """What each batch added, told after all dates were written anew; one was written twice."""
    root = written_ticks(spark, sf)
    maintenance.compact(spark, root, before=EVER, min_files=1)
    return maintenance.loads(spark, root)


@query("SELECT DISTINCT CAST(ts AS DATE) AS date_partition FROM events WHERE ts < DATE '2024-01-14'")
def dates_expired(spark, sf):
    """Dates that ended more than seven days before a moment."""
    found = maintenance.expired_dates(spark, written_ticks(spark, sf), as_of="2024-01-21 12:00:00")
    return found.filter("files > 0 AND bytes > 0").select("date_partition")


@query("SELECT CAST(ts AS DATE) AS date_partition, COUNT(*) AS \"rows\" FROM events GROUP BY ALL")
def file_rows(spark, sf):
    """Rows of the files that the listing has, by the date in their path."""
    root = written_ticks(spark, sf)
    listed = maintenance.table_files(spark, root).filter("length > 0")
    name = F.regexp_extract("path", "[^/]+$", 0).alias("name")
    # A task names its files alike in all dates.
    own = "date_partition", F.col("_metadata.file_name").alias("name")
    rows = tables.read_table(spark, root).groupBy(*own).count()
    return listed.select("date_partition", name).join(rows, ["date_partition", "name"]).groupBy("date_partition").agg(
        F.sum("count").alias("rows")
    )


@query(
    """SELECT CAST(ts AS DATE) AS date_partition, operation, COUNT(*) * MAX(times) AS rows_written
       FROM events, (VALUES ('COMPACT', 1), ('ZORDER BY (ticker)', 2)) AS ops(operation, times)
       GROUP BY ALL"""
)
def table_history(spark, sf):
    """What was done to every date: a compaction, and a clustering after all ticks came once more."""
    root, log = written_ticks(spark, sf), new_dir(spark, "operations")
    maintenance.compact(spark, root, before=EVER, min_files=1, log=log)
    tables.write_batch(dated_ticks(spark, sf), root)
    maintenance.zorder(spark, root, before=EVER, log=log)
    told = maintenance.operations(spark, log)
    return told.select(F.col("date_rewritten").alias("date_partition"), "operation", "rows_written")


def with_catalog(spark, sf, made: Callable[[str, str], DataFrame]) -> DataFrame:
    """What ``made`` gives of the written ticks' root and their name in the catalog.

    The catalog entry goes again, so the answer is written first; the files stay.
    """
    root, name, out = written_ticks(spark, sf), f"stock_ticks_{uuid.uuid4().hex}", new_dir(spark, "answer")
    spark.catalog.createTable(name, path=root, source="parquet")
    try:
        tables.find_dates(spark, name)
        made(root, name).write.parquet(out)
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(out)


@query(
    f"""SELECT DISTINCT CAST(ts AS DATE) AS date_partition,
               CAST(CASE WHEN ts < TIMESTAMP '{MIDDLE}' THEN 0 ELSE 1 END AS BIGINT) AS batch_id
        FROM events"""
)
def vacuum_candidates(spark, sf):
    """What a compaction of all dates leaves behind: the files of the batches it replaced."""

    def made(root: str, name: str) -> DataFrame:
        maintenance.compact_beside(spark, root, name, before=EVER, min_files=1)
        removable = maintenance.replaced_files(spark, root, name, as_of="2100-01-01 00:00:00")
        own = removable.join(maintenance.file_batches(spark, root), "file")
        return own.select("date_partition", F.col("batch_id").cast("long").alias("batch_id")).distinct()

    return with_catalog(spark, sf, made)


@query(
    f"""SELECT CAST(ts AS DATE) AS date_partition, ts < TIMESTAMP '{MIDDLE}' AS early,
               CAST(ts AS DATE) <> DATE '{DAY}' AS is_live, TRUE AS has_bytes
        FROM events GROUP BY ALL"""
)
def file_listing(spark, sf):
    """Files of the batches of a compacted date are no longer live, those of other dates are."""

    def made(root: str, name: str) -> DataFrame:
        maintenance.compact_beside(spark, root, name, DAY)
        listed = maintenance.listed_files(spark, root, name).filter("NOT rewritten")
        own = listed.join(maintenance.file_batches(spark, root), "file")
        return own.groupBy("date_partition", (F.col("batch_id") == "0").alias("early"), "is_live").agg(
            (F.sum("length") > 0).alias("has_bytes")
        )

    return with_catalog(spark, sf, made)


@query(
    f"SELECT ticker, price, volume, event_time, event_id, "
    f"CASE WHEN event_time >= TIMESTAMP '{MIDDLE}' THEN 'USD' END AS currency FROM {TICKS}"
)
def schema_evolution(spark, sf):
    """A column that only later batches have outlives compaction and clustering."""
    root = new_dir(spark, "ticks")
    found = dated_ticks(spark, sf)
    middle = F.lit(MIDDLE).cast("timestamp_ntz")
    tables.write_batch(found.filter(F.col("event_time") < middle), root)
    tables.write_batch(found.filter(F.col("event_time") >= middle).withColumn("currency", F.lit("USD")), root)
    maintenance.compact(spark, root, before=EVER, min_files=1)
    maintenance.zorder(spark, root, before=EVER)
    return tables.read_table(spark, root).select(*ROW_COLUMNS, "currency")


@query(
    f"""SELECT *, CASE WHEN window_start >= TIMESTAMP '{MIDDLE}' THEN 'replay' END AS made_by
        FROM ({vwap_sql('1 hour', '1h')})"""
)
def schema_evolution_keyed(spark, sf):
    """The same for a keyed table: all windows, then those from noon of a day on again."""
    root = new_dir(spark, "vwap")
    made = dated_vwap(ticks(spark, sf), "1 hour")
    tables.upsert(made, root)
    later = made.filter(F.col("window_start") >= F.lit(MIDDLE).cast("timestamp_ntz"))
    tables.upsert(later.withColumn("made_by", F.lit("replay")), root)
    maintenance.compact(spark, root, before=EVER, min_files=1)
    return tables.read_table(spark, root).drop("date_partition")


@query(
    """SELECT 'bad' AS "table", CAST(0 AS BIGINT) AS dates_rewritten, TRUE AS failed
       UNION ALL SELECT 'good', COUNT(DISTINCT CAST(ts AS DATE)), FALSE FROM events"""
)
def run_all_isolated(spark, sf):
    """A table with a broken file does not keep the next one from being maintained."""
    good, bad = written_ticks(spark, sf), new_dir(spark, "bad")
    broken = table(spark, sf, "events").select(F.col("props").alias("value")).coalesce(1)
    broken.write.text(f"{bad}/date_partition={DAY}")
    both = {"bad": bad, "good": good}
    done = maintenance.run_all(spark, both, before=EVER, min_files=1, raise_on_error=False)
    return done.select("table", "dates_rewritten", F.col("error").isNotNull().alias("failed"))


@query(
    f"SELECT ticker, price, volume, event_time, event_id FROM {TICKS} "
    "WHERE event_time >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL '2 days' "
    "AND event_time <= TIMESTAMP '2024-01-20 00:00:00'"
)
def recent_dated(spark, sf):
    """From a dated table: only the partitions in question are read."""
    found = tables.read_table(spark, written_ticks(spark, sf))
    return analytics.recent(found, "2024-01-20 00:00:00", "2 days", until_as_of=True).select(*ROW_COLUMNS)


@query(
    f"SELECT ticker, price, volume, event_time, event_id, ticker AS _ticker, "
    f"CAST(event_time AS DATE) AS _date FROM {TICKS}"
)
def jsonl_dump(spark, sf):
    path = new_dir(spark, "jsonl")
    found = ticks(spark, sf).select(*ROW_COLUMNS)
    tables.dump_jsonl(found, path, time="event_time")
    body = "ticker string, price double, volume long, event_time timestamp_ntz, event_id long"
    return spark.read.schema(f"{body}, _date date, _ticker string").json(path)


@query(
    f"SELECT ticker, price, volume, event_time, CAST(event_time AS DATE) AS date_partition FROM {TICKS}"
)
def catalog_table(spark, sf):
    """The raw table through its DDL; the definition goes again, the files stay."""
    location = new_dir(spark, "raw")
    name = "stock_ticks_" + location.rsplit("-", 1)[1]
    tables.create_raw(spark, name, location)
    tables.insert_into(dated_ticks(spark, sf), name, overwrite_dates=True)
    spark.sql(f"DROP TABLE {name}")
    stored = read_path(spark, location)
    return ntz(stored.select("ticker", "price", "volume", "event_time", "date_partition"))


@query(
    """SELECT "table", col_name, comment FROM (VALUES
           ('raw', 'ticker', 'Stock ticker symbol'), ('raw', 'price', 'Last traded price'),
           ('raw', 'volume', 'Volume at this tick'), ('raw', 'market_cap', 'Market capitalisation'),
           ('raw', 'event_time', 'Event time from producer'),
           ('raw', 'ingest_time', 'Ingestion time into Delta Lake'),
           ('raw', 'exchange', 'Exchange (NASDAQ / NYSE)'), ('raw', 'date_partition', 'Partition column'),
           ('vwap', 'window_start', '1-min window start'), ('vwap', 'window_end', '1-min window end'),
           ('vwap', 'vwap_1m', 'Volume-Weighted Average Price')) AS told("table", col_name, comment)
       WHERE EXISTS (FROM events)"""
)
def table_comments(spark, sf):
    """The comments of both tables' DDL, as DESCRIBE tells them of tables that hold the ticks."""
    tag, found = uuid.uuid4().hex, dated_ticks(spark, sf)
    made = {"raw": f"stock_ticks_raw_{tag}", "vwap": f"stock_vwap_1m_{tag}"}
    tables.create_raw(spark, made["raw"], new_dir(spark, "raw"))
    tables.create_vwap(spark, made["vwap"], new_dir(spark, "vwap"))
    tables.insert_into(found, made["raw"])
    tables.insert_into(dated_vwap(found, "1 minute"), made["vwap"])
    told = []
    for kind, name in made.items():
        assert not spark.table(name).isEmpty()
        rows = spark.sql(f"DESCRIBE TABLE {name}").collect()
        told += {(kind, r["col_name"], r["comment"]) for r in rows if r["comment"] not in (None, "", "comment")}
        spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(sorted(told), "table string, col_name string, comment string")


@query(
    f"SELECT * FROM ({vwap_sql('5 minutes', '5m')}) "
    "WHERE CAST(window_start AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-12'"
)
def replay_vwap(spark, sf):
    root = written_ticks(spark, sf)
    again = replay.replay_vwap(
        spark, root, "2024-01-08", "2024-01-12", "5 minutes", decimals=2
    )
    return again.drop("date_partition")


# --- streams -----------------------------------------------------------------------------


def drained(query_) -> None:
    query_.awaitTermination()


def reported(spark, log: StreamingQueryListener, start: Callable[[], StreamingQuery]) -> None:
    """Run a query to its end, and wait until ``log`` has heard all its reports.

    Reports come after the query has ended, the later the busier the machine, behind those of earlier queries;
    the end is told last, to listeners in the order they were added.
    """
    ends = jobs.Ends()
    for listener in (log, ends):
        spark.streams.addListener(listener)
    try:
        made = start()
        drained(made)
        ends.wait(made)
    finally:
        for listener in (log, ends):
            spark.streams.removeListener(listener)


def streamed(spark, root: str, made: DataFrame) -> DataFrame:
    """What a stream of the rows ``made`` wrote, no rows where it had none."""
    return ntz(tables.read_table(spark, root, schema=made.schema).drop("date_partition"))


@query(f"SELECT * FROM ({vwap_sql('1 minute', '1m')}) WHERE {CLOSED}")
def stream_vwap(spark, sf):
    """Append mode: the windows the watermark has closed."""
    root, checkpoint = new_dir(spark, "stream"), new_dir(spark, "checkpoint")
    made = windows.with_date(windows.vwap(streamed_ticks(spark, sf), "1 minute", decimals=2))
    drained(sinks.append_stream(made, root, checkpoint, every=None))
    return streamed(spark, root, made)


@query(vwap_sql("1 hour", "1h"))
def stream_upsert(spark, sf):
    """Update mode with keyed merge: all windows, open ones included."""
    root, checkpoint = new_dir(spark, "stream"), new_dir(spark, "checkpoint")
    made = windows.with_date(windows.vwap(streamed_ticks(spark, sf), "1 hour", decimals=2))
    drained(sinks.upsert_stream(made, root, checkpoint, every=None))
    return streamed(spark, root, made)


@query(deviation_sql("1 hour", "1h", "<", CLOSED))
def stream_alerts(spark, sf):
    """Alerts on live ticks, as the window of each closes."""
    root, checkpoint = new_dir(spark, "stream"), new_dir(spark, "checkpoint")
    found = streamed_ticks(spark, sf)
    alerts = jobs.deviation_alerts(found, "1 hour", decimals=2)
    dated = alerts.withColumn("date_partition", F.to_date("event_time"))
    drained(sinks.append_stream(dated, root, checkpoint, every=None))
    return streamed(spark, root, dated)


ROWS_PER_FILE = 100_000


def ten_files(spark, sf) -> DataFrame:
    """Ticks as a stream of ten parts in the order of time, one a batch.

    The very first tick comes with the last part, long after its window closed. Parts of many rows
    are several files, so that a batch is written and read by as many tasks; all parts have as many.
    """
    folder = new_dir(spark, "events")
    events = table(spark, sf, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    rows, first, edges = events.select(
        F.count(F.lit(1)), F.min(micros), F.percentile_approx(micros, [i / 10 for i in range(1, 10)])
    ).first()
    files = max(1, -(-rows // (10 * ROWS_PER_FILE)))
    for number, (low, high) in enumerate(zip([first, *edges], [*edges, 1 << 62]), 1):
        part = events.filter((micros > low) & (micros <= high))
        if high == 1 << 62:
            part = part.unionByName(events.filter(micros == first))
        part = part.repartition(files) if files > 1 else part.coalesce(1)
        part.write.mode("append").parquet(folder)
        # Tasks without rows write no file: files of no rows keep the batches apart.
        for _ in range(number * files - list_files(spark, folder, pattern="*.parquet").count() if files > 1 else 0):
            events.limit(0).write.mode("append").parquet(folder)
    return ticks_from_events(
        read_tick_stream(spark, folder, "parquet", events.schema, maxFilesPerTrigger=str(files))
    )


ON_TIME = f"(SELECT * FROM {TICKS} WHERE event_time > (SELECT MIN(ts) FROM events))"


@query(f"SELECT * FROM ({vwap_sql('1 day', '1d', ON_TIME)}) WHERE {CLOSED}")
def stream_vwap_batches(spark, sf):
    """Days that reach over batches; the late tick is left out."""
    root, checkpoint = new_dir(spark, "stream"), new_dir(spark, "checkpoint")
    made = dated_vwap(ten_files(spark, sf), "1 day")
    drained(sinks.append_stream(made, root, checkpoint, every=None))
    return streamed(spark, root, made)


@query(vwap_sql("1 day", "1d", ON_TIME))
def stream_upsert_batches(spark, sf):
    """The same in update mode: days are written again as they grow."""
    root, checkpoint = new_dir(spark, "stream"), new_dir(spark, "checkpoint")
    made = dated_vwap(ten_files(spark, sf), "1 day")
    drained(sinks.upsert_stream(made, root, checkpoint, every=None))
    return streamed(spark, root, made)


@query(deviation_sql("1 day", "1d", "<", CLOSED, ON_TIME))
def stream_alerts_batches(spark, sf):
    """Ticks wait over several batches until their day closes."""
    root, checkpoint = new_dir(spark, "stream"), new_dir(spark, "checkpoint")
    alerts = jobs.deviation_alerts(ten_files(spark, sf), "1 day", decimals=2)
    dated = alerts.withColumn("date_partition", F.to_date("event_time"))
    drained(sinks.append_stream(dated, root, checkpoint, every=None))
    return streamed(spark, root, dated)


@query(
    "SELECT 'late' AS name, COUNT(*) AS late_rows FROM events WHERE ts = (SELECT MIN(ts) FROM events)"
)
def stream_late_rows(spark, sf):
    """Rows dropped as late, counted over all batches."""
    log, made = jobs.LateRows(), dated_vwap(ten_files(spark, sf), "1 day")
    out = new_dir(spark, "stream"), new_dir(spark, "checkpoint")
    reported(spark, log, lambda: sinks.append_stream(made, *out, every=None, name="late"))
    counts = spark.createDataFrame(list(log.dropped.items()), "name string, late_rows long")
    return counts.filter("name = 'late'")


def halves(spark, sf) -> list[DataFrame]:
    """The events before and from noon of a day on, as two folders of files."""
    events = table(spark, sf, "events")
    early = F.col("ts") < F.lit(MIDDLE).cast("timestamp_ntz")
    made = []
    for part in (events.filter(early), events.filter(~early)):
        folder = new_dir(spark, "events")
        part.write.parquet(folder)
        made.append(ticks_from_events(read_tick_stream(spark, folder, "parquet", events.schema)))
    return made


@query(TICK_ROWS)
def stream_restart(spark, sf):
    """Two checkpoints one after the other, a compaction between them."""
    root = new_dir(spark, "stream")
    for part in halves(spark, sf):
        dated = part.withColumn("date_partition", F.to_date("event_time"))
        drained(sinks.append_stream(dated, root, new_dir(spark, "checkpoint"), every=None))
        maintenance.compact(spark, root, before=EVER, min_files=1)
    return ntz(tables.read_table(spark, root).select(*ROW_COLUMNS))


@query(vwap_sql("1 hour", "1h"))
def replay_beside_stream(spark, sf):
    """A replay of closed days and a compaction between two batches of a stream."""
    raw, root, checkpoint = new_dir(spark, "raw"), new_dir(spark, "vwap"), new_dir(spark, "checkpoint")
    tables.write_batch(dated_ticks(spark, sf).withColumn("event_time", F.col("event_time").cast("timestamp")), raw)
    folder = new_dir(spark, "events")
    events = table(spark, sf, "events")
    early = F.col("ts") < F.lit(MIDDLE).cast("timestamp_ntz")
    for number, part in enumerate((events.filter(early), events.filter(~early))):
        part.write.mode("append").parquet(folder)
        source = ticks_from_events(read_tick_stream(spark, folder, "parquet", events.schema))
        drained(sinks.upsert_stream(dated_vwap(source, "1 hour"), root, checkpoint, every=None))
        if number == 0:
            replay.replay_into(spark, raw, root, "2024-01-01", "2024-01-09", "1 hour", decimals=2)
            maintenance.compact(spark, root, before=EVER, min_files=1)
    return ntz(tables.read_table(spark, root).drop("date_partition"))


# The exact sum of the products as whole multiples of 2^-59, rounded to a double once.
EXACT_SQL = f"""
    SELECT window_start, ticker, CAST(CASE WHEN odd THEN head + 1 ELSE head END AS DOUBLE)
               * pow(2.0, shift - 59) / volume AS vwap_1h, volume AS total_volume_1h
    FROM (SELECT *, CAST(units // unit AS BIGINT) AS head,
                 units % unit <> 0 AND (units // unit) % 2 = 0 AS odd
          FROM (SELECT *, CAST(pow(2::HUGEINT, shift) AS HUGEINT) AS unit
                FROM (SELECT *, CASE WHEN units < pow(2.0, 62) THEN 0 WHEN units < pow(2.0, 70) THEN 8
                                     WHEN units < pow(2.0, 78) THEN 16 WHEN units < pow(2.0, 86) THEN 24
                                     ELSE 32 END AS shift
                      FROM (SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start, ticker,
                                   SUM(CAST(price * volume * pow(2.0, 59) AS HUGEINT)) AS units,
                                   CAST(SUM(volume) AS BIGINT) AS volume
                            FROM {TICKS} GROUP BY ALL))))
    WHERE volume > 0"""


@query(EXACT_SQL)
def vwap_exact(spark, sf):
    """Sums of doubles as they are, with decimals, the same bits in any order of rows."""
    made = windows.vwap(ticks(spark, sf).repartition(7, "event_id"), "1 hour", exact=True)
    found = made.select("window_start", "ticker", "vwap_1h", "total_volume_1h")
    return found.filter("total_volume_1h > 0")


def in_batches(query_) -> int:
    """The rows that a query read, once it has ended."""
    query_.awaitTermination()
    return sum(report["numInputRows"] for report in query_.recentProgress)


def chain_part(length: str, suffix: str) -> str:
    return f"""SELECT '{suffix}' AS length, window_start, window_end, ticker, vwap_{suffix} AS vwap,
                      total_volume_{suffix} AS total_volume, tick_count_{suffix} AS tick_count,
                      (SELECT COUNT(*) FROM events) AS source_rows
               FROM ({vwap_sql(length, suffix, ON_TIME)})
               WHERE date_trunc('day', window_start) + INTERVAL '1 day' <= {NEWEST} - INTERVAL '2 minutes'"""


@query(f"{chain_part('1 hour', '1h')} UNION ALL {chain_part('1 day', '1d')}")
def stream_vwap_chained(spark, sf):
    """Hours and the days that hold them, from one query that reads each source row once."""
    root, lengths = new_dir(spark, "stream"), ("1 hour", "1 day")
    chained = windows.chained_vwap(ten_files(spark, sf), lengths, decimals=2)
    read = in_batches(
        jobs.chain_stream(chained, root, new_dir(spark, "checkpoint"), lengths, decimals=2, every=None)
    )
    parts = [
        streamed(spark, f"{root}/vwap_{suffix}", windows.chain_rows(chained, lengths, length, decimals=2)).select(
            F.lit(suffix).alias("length"), "window_start", "window_end", "ticker",
            F.col(f"vwap_{suffix}").alias("vwap"), F.col(f"total_volume_{suffix}").alias("total_volume"),
            F.col(f"tick_count_{suffix}").alias("tick_count"), F.lit(read).cast("long").alias("source_rows"),
        )
        for length, suffix in zip(lengths, ("1h", "1d"))
    ]
    return parts[0].unionByName(parts[1])


@query(f"SELECT * FROM ({vwap_sql('1 day', '1d')}) WHERE {CLOSED}")
def stream_late_repair(spark, sf):
    """Closed days with the late tick: its day is computed again from the raw ticks."""
    raw, late, made = (new_dir(spark, name) for name in ("raw", "late", "vwap"))
    source = ten_files(spark, sf)
    drained(jobs.append_with_late(source, raw, late, new_dir(spark, "checkpoint"), every=None))
    days = dated_vwap(source, "1 day")
    drained(sinks.append_stream(days, made, new_dir(spark, "checkpoint"), every=None))
    jobs.repair_windows(spark, raw, late, made, "1 day", decimals=2)
    return streamed(spark, made, days)


@query("SELECT 'ticks' AS name, CAST(10 AS BIGINT) AS batches, COUNT(*) AS input_rows FROM events")
def stream_deliveries(spark, sf):
    """What was delivered, batch by batch, as the running query tells."""
    log, dated = jobs.Deliveries(), ten_files(spark, sf).withColumn("date_partition", F.to_date("event_time"))
    out = new_dir(spark, "stream"), new_dir(spark, "checkpoint")
    reported(spark, log, lambda: sinks.append_stream(dated, *out, every=None, name="ticks"))
    own = log.rows(spark).filter("name = 'ticks' AND input_rows > 0")
    return own.groupBy("name").agg(
        F.count_distinct("batch_id").alias("batches"), F.sum("input_rows").alias("input_rows")
    )


OUTAGE = "INTERVAL '2 hours'"


@query(
    f"""WITH timed AS (
            SELECT ticker, event_time, event_time > lag(event_time) OVER w + {OUTAGE} AS starts
            FROM {ON_TIME} WINDOW w AS (PARTITION BY ticker ORDER BY event_time)
        ), sessions AS (
            SELECT ticker, MIN(event_time) AS first, MAX(event_time) AS last,
                   MAX(event_time) + {OUTAGE} <= {NEWEST} - INTERVAL '2 minutes' AS closed
            FROM (SELECT *, SUM(CASE WHEN starts THEN 1 ELSE 0 END)
                              OVER (PARTITION BY ticker ORDER BY event_time) AS n FROM timed)
            GROUP BY ticker, n
        ), ended AS (
            SELECT ticker, last AS gap_start, closed,
                   CASE WHEN lead(closed) OVER v THEN lead(first) OVER v END AS gap_end
            FROM sessions WINDOW v AS (PARTITION BY ticker ORDER BY first)
        )
        SELECT ticker, gap_start, gap_end, CAST(date_sub('second', gap_start, gap_end) AS BIGINT) AS gap_seconds
        FROM ended WHERE closed"""
)
def stream_outages(spark, sf):
    """Outages of over two hours: ended ones, and those that still go on behind the watermark."""
    root = new_dir(spark, "outages")
    drained(jobs.outage_stream(ten_files(spark, sf), root, new_dir(spark, "checkpoint"), "2 hours", every=None))
    return ntz(jobs.outages(spark, root, "2 hours"))


@query(
    f"""SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, expected.ticker
        FROM (SELECT DISTINCT time_bucket(INTERVAL '1 hour', event_time) AS window_start FROM {ON_TIME}),
             (SELECT DISTINCT ticker FROM {TICKS} UNION ALL SELECT 'refund') AS expected
        WHERE window_start + INTERVAL '1 hour' <= {NEWEST} - INTERVAL '2 minutes'
          AND NOT EXISTS (SELECT 1 FROM {ON_TIME} AS seen WHERE seen.ticker = expected.ticker
                          AND time_bucket(INTERVAL '1 hour', seen.event_time) = window_start)"""
)
def stream_silent_tickers(spark, sf):
    """Expected tickers without a tick per closed hour; one of them never comes."""
    root, expected = new_dir(spark, "silent"), ["click", "error", "purchase", "signup", "view", "refund"]
    found = jobs.silent_tickers(ten_files(spark, sf), expected, "1 hour")
    dated = windows.with_date(found)
    drained(sinks.append_stream(dated, root, new_dir(spark, "checkpoint"), every=None))
    return streamed(spark, root, dated)


@query(
    f"""SELECT rule, COUNT(*) AS rows_checked, CAST(SUM(broken) AS BIGINT) AS rows_failed, MAX(event_time) AS newest
        FROM (SELECT event_time, UNNEST(['ticker_missing', 'price_missing', 'event_time_missing',
                                         'price_not_a_number', 'price_not_positive', 'volume_negative',
                                         'price_high']) AS rule,
                     UNNEST([ticker IS NULL, price IS NULL, event_time IS NULL, isnan(price), price <= 0,
                             volume < 0, price > 100]::INT[]) AS broken
              FROM {TICKS})
        GROUP BY rule"""
)
def stream_quality(spark, sf):
    """Rules and newest time counted by the running stream, a row per batch and rule, summed."""
    told, root = jobs.ObservedBatches("rules"), new_dir(spark, "observed")
    checks = quality.tick_rules() | {"price_high": F.col("price") > 100}
    watched = jobs.observe_rules(ten_files(spark, sf), "rules", checks)
    dated = watched.withColumn("date_partition", F.to_date("event_time"))
    out = new_dir(spark, "stream"), new_dir(spark, "checkpoint")
    reported(spark, told, lambda: sinks.append_stream(dated, *out, every=None))
    told.flush(spark, root)
    sums = tables.read_table(spark, root).groupBy("rule").agg(
        F.sum("rows_checked").alias("rows_checked"), F.sum("rows_failed").alias("rows_failed"), F.max("newest").alias("newest")
    )
    return ntz(sums)


@query(deviation_sql("1 day", "1d", "<"))
def stream_alerts_stored(spark, sf):
    """Alerts by a look into the stored windows of each batch's dates."""
    stored, root = new_dir(spark, "vwap"), new_dir(spark, "alerts")
    zoned = ticks(spark, sf).withColumn("event_time", F.col("event_time").cast("timestamp"))
    days = dated_vwap(zoned, "1 day")
    tables.upsert(days, stored)
    alerts = analytics.vwap_deviation(zoned, days, "1 day")
    drained(jobs.stored_alerts(ten_files(spark, sf), stored, root, new_dir(spark, "checkpoint"), "1 day", every=None))
    return streamed(spark, root, alerts)


@query(vwap_sql("1 hour", "1h", f"(SELECT * FROM {TICKS} WHERE event_time < TIMESTAMP '{MIDDLE}')"))
def vwap_known_at(spark, sf):
    """The VWAP table as it was known at a moment, from a table that keeps both versions of a window."""
    root, found = new_dir(spark, "versions"), ticks(spark, sf)
    known = found.filter(F.col("event_time") < F.lit(MIDDLE).cast("timestamp_ntz"))
    for batch, at in ((known, MIDDLE), (found, "2024-02-01 00:00:00")):
        made = dated_vwap(batch, "1 hour").withColumn("known_at", F.lit(at).cast("timestamp"))
        tables.write_batch(made, root)
    return tables.versions_as_of(tables.read_table(spark, root), "2024-01-20 00:00:00").drop("date_partition")


def message_text() -> str:
    """A message of whole numbers, with a key that the schema does not know; in SQL of both."""
    return (
        "'{\"ticker\":\"' || event_type || '\",\"bid\":' || CAST(event_id AS STRING) || "
        "',\"price\":1,\"timestamp\":\"' || CAST(CAST(ts AS DATE) AS STRING) || 'T00:00:00\"}'"
    )


@query(
    f"""SELECT CASE WHEN event_type = 'error' THEN props ELSE {message_text()} END AS "value",
               CASE WHEN event_type <> 'error' THEN event_type END AS _ticker FROM events"""
)
def backfill(spark, sf):
    """Messages as they were sent: unknown keys stay, unreadable messages too."""
    folder, out = new_dir(spark, "messages"), new_dir(spark, "dump")
    events = table(spark, sf, "events")
    text = f"CASE WHEN event_type = 'error' THEN props ELSE {message_text()} END"
    events.select(F.expr(text).alias("value")).write.text(folder)
    jobs.await_all([jobs.backfill(spark, folder, out, new_dir(spark, "checkpoint"))])
    return spark.read.schema("value string, _date date, _ticker string").text(out).select("value", "_ticker")


def run_tick_job(spark, sf) -> str:
    """The whole tick job over messages in files; returns the folder of its tables."""
    folder, out = new_dir(spark, "messages"), new_dir(spark, "job")
    body = mixed_messages(spark, sf).select(F.col("value").cast("string").alias("value"))
    body.write.text(folder)
    incoming = read_tick_stream(spark, folder)
    jobs.await_all(
        jobs.run_streams(
            incoming, f"{out}/tables", f"{out}/checkpoints", durations=("5 minutes",), every=None,
            decimals=2,
        )
    )
    return f"{out}/tables"


@query(f"SELECT {PARSED} FROM {TICKS} WHERE ticker <> 'error'")
def stream_job_raw(spark, sf):
    raw = tables.read_table(spark, f"{run_tick_job(spark, sf)}/raw")
    return ntz(raw.select("ticker", "price", "volume", "event_time", "date_partition"))


@query(
    "SELECT * FROM (" + vwap_sql("5 minutes", "5m", f"(SELECT * FROM {TICKS} WHERE ticker <> 'error')")
    + ") WHERE window_end <= (SELECT MAX(ts) FROM events WHERE event_type <> 'error') - INTERVAL '2 minutes'"
)
def stream_job_vwap(spark, sf):
    made = tables.read_table(spark, f"{run_tick_job(spark, sf)}/vwap_5m")
    return ntz(made.drop("date_partition"))


@query(
    """SELECT props AS raw_value, 'ticker,price,event_time' AS missing_fields
       FROM events WHERE event_type = 'error'"""
)
def stream_job_quarantine(spark, sf):
    rejected = tables.read_table(spark, f"{run_tick_job(spark, sf)}/quarantine")
    return rejected.select(
        "raw_value", F.concat_ws(",", "missing_fields").alias("missing_fields")
    )


GOOD = f"(SELECT * FROM {TICKS} WHERE ticker <> 'error')"


def streamed_catalog(spark, sf, sql: str) -> DataFrame:
    """The answer to SQL text over the tables that a run of the tick job wrote, by name.

    The catalog entries go again, so the answer is written first.
    """
    lake, tag, out = run_tick_job(spark, sf), uuid.uuid4().hex, new_dir(spark, "answer")
    raw, made = f"stock_ticks_raw_{tag}", f"stock_vwap_5m_{tag}"
    tables.create_raw(spark, raw, f"{lake}/raw")
    tables.create_vwap(spark, made, f"{lake}/vwap_5m", suffix="5m")
    for name in (raw, made):
        tables.find_dates(spark, name)
    try:
        spark.sql(sql.format(raw=raw, vwap=made)).write.parquet(out)
    finally:
        for name in (raw, made):
            spark.sql(f"DROP TABLE {name}")
    return ntz(spark.read.parquet(out))


@query(
    f"""SELECT ticker, open_price, close_price,
               ROUND((close_price - open_price) / NULLIF(open_price, 0) * 100, 2) AS pct_change, total_volume
        FROM (SELECT ticker, arg_min(price, event_time) AS open_price, arg_max(price, event_time) AS close_price,
                     CAST(SUM(volume) AS BIGINT) AS total_volume
              FROM {GOOD} WHERE event_time >= (SELECT MAX(event_time) FROM {GOOD}) - INTERVAL '1 day'
              GROUP BY ticker)
        ORDER BY ABS(pct_change) DESC, ticker LIMIT 3"""
)
def sql_top_movers(spark, sf):
    return streamed_catalog(
        spark,
        sf,
        """SELECT ticker, open_price, close_price,
                  ROUND((close_price - open_price) / NULLIF(open_price, 0) * 100, 2) AS pct_change, total_volume
           FROM (SELECT ticker, min_by(price, event_time) AS open_price,
                        max_by(price, event_time) AS close_price, SUM(volume) AS total_volume
                 FROM {raw}
                 WHERE event_time >= (SELECT MAX(event_time) FROM {raw}) - INTERVAL 1 DAY
                 GROUP BY ticker)
           ORDER BY ABS(pct_change) DESC, ticker LIMIT 3""",
    )


@query(
    deviation_sql("5 minutes", "5m", "<", f"window_end <= (SELECT MAX(event_time) FROM {GOOD}) - INTERVAL '2 minutes'", GOOD)
)
def sql_vwap_deviation(spark, sf):
    """The window's start is computed per tick, so the join is on equal keys."""
    return streamed_catalog(
        spark,
        sf,
        """SELECT r.ticker, r.event_time, r.price, v.vwap_5m,
                  ROUND(ABS(r.price - v.vwap_5m) / NULLIF(v.vwap_5m, 0) * 100, 2) AS deviation_pct
           FROM (SELECT *, window(event_time, '5 minutes').start AS window_start FROM {raw}) r
           JOIN {vwap} v ON r.ticker = v.ticker AND r.window_start = v.window_start
           WHERE ABS(r.price - v.vwap_5m) / NULLIF(v.vwap_5m, 0) > 0.01
           ORDER BY deviation_pct DESC""",
    )
