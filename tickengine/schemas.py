"""Declared schemas: payload, contract and tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, order and types of the tick message.
TICK_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("market_cap", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("exchange", T.StringType()),
    ]
)

# The tickers the feed is expected to carry.
EXPECTED_TICKERS = ["AAPL", "MSFT", "GOOGL", "AMZN", "META", "TSLA", "NVDA", "JPM"]

# The message contract as an Avro record.
TICK_RECORD = {
    "type": "record",
    "name": "StockTick",
    "fields": [
        {"name": "ticker", "type": "string"},
        {"name": "price", "type": "double"},
        {"name": "volume", "type": ["null", "long"], "default": None},
        {"name": "market_cap", "type": ["null", "double"], "default": None},
        {"name": "timestamp", "type": "string"},
        {"name": "exchange", "type": ["null", "string"], "default": None},
    ],
}

_AVRO_TYPES = {
    "string": T.StringType(),
    "bytes": T.BinaryType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}


def struct_from_record(record: dict) -> T.StructType:
    """Spark schema of a flat Avro record; a union with ``null`` becomes nullable."""
    fields = []
    for field in record["fields"]:
        branches = field["type"] if isinstance(field["type"], list) else [field["type"]]
        named = [b for b in branches if b != "null"]
        if len(named) != 1 or named[0] not in _AVRO_TYPES:
            raise ValueError(f"unsupported type of field {field['name']}: {field['type']}")
        fields.append(
            T.StructField(field["name"], _AVRO_TYPES[named[0]], len(named) < len(branches))
        )
    return T.StructType(fields)


CONTRACT = struct_from_record(TICK_RECORD)

# Contract fields that may not be NULL, under the names they have after parsing.
REQUIRED = [
    "event_time" if f.name == "timestamp" else f.name for f in CONTRACT if not f.nullable
]

# Columns of the raw table.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("market_cap", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("ingest_time", T.TimestampType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("date_partition", T.DateType()),
    ]
)


def vwap_schema(suffix: str = "1m") -> T.StructType:
    """Columns of a VWAP table for one window length."""
    return T.StructType(
        [
            T.StructField("window_start", T.TimestampType()),
            T.StructField("window_end", T.TimestampType()),
            T.StructField("ticker", T.StringType()),
            T.StructField(f"vwap_{suffix}", T.DoubleType()),
            T.StructField(f"total_volume_{suffix}", T.LongType()),
            T.StructField(f"tick_count_{suffix}", T.LongType()),
            T.StructField("date_partition", T.DateType()),
        ]
    )


# Column comments of the raw table.
RAW_COMMENTS = {
    "ticker": "Stock ticker symbol",
    "price": "Last traded price",
    "volume": "Volume at this tick",
    "market_cap": "Market capitalisation",
    "event_time": "Event time from producer",
    "ingest_time": "Ingestion time into Delta Lake",
    "exchange": "Exchange (NASDAQ / NYSE)",
    "date_partition": "Partition column",
}

# Column comments of the VWAP table of one-minute windows.
VWAP_COMMENTS = {
    "window_start": "1-min window start",
    "window_end": "1-min window end",
    "vwap_1m": "Volume-Weighted Average Price",
}
_LENGTHS = {"s": "sec", "m": "min", "h": "hour", "d": "day", "w": "week"}


def vwap_comments(suffix: str = "1m") -> dict[str, str]:
    """The comments for another window length."""
    length = f"{suffix[:-1]}-{_LENGTHS[suffix[-1]]}"
    return {
        name.replace("1m", suffix): told.replace("1-min", length) for name, told in VWAP_COMMENTS.items()
    }
