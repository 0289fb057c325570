"""Table and message contracts.

Wire messages use camelCase text fields; tables use snake_case. Every table
contract is a StructType so scans never infer a schema.
"""

from __future__ import annotations

import json

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PRICE = DecimalType(20, 8)
PERCENT = DecimalType(10, 4)
VOLUME = DecimalType(30, 8)
SYMBOL_MAX_LENGTH = 20

# The wire field names, the table column each one becomes, and the
# table column's type. They are the message contract and must not change.
TICKER_FIELDS = [
    ("symbol", "symbol", StringType()),
    ("priceChange", "price_change", PRICE),
    ("priceChangePercent", "price_change_pct", PERCENT),
    ("weightedAvgPrice", "weighted_avg_price", PRICE),
    ("prevClosePrice", "prev_close_price", PRICE),
    ("lastPrice", "last_price", PRICE),
    ("lastQty", "last_qty", PRICE),
    ("bidPrice", "bid_price", PRICE),
    ("askPrice", "ask_price", PRICE),
    ("openPrice", "open_price", PRICE),
    ("highPrice", "high_price", PRICE),
    ("lowPrice", "low_price", PRICE),
    ("volume", "volume", VOLUME),
    ("quoteVolume", "quote_volume", VOLUME),
    ("openTime", "open_time", TimestampType()),
    ("closeTime", "close_time", TimestampType()),
    ("count", "trade_count", LongType()),
]
REQUIRED_WIRE_FIELDS = ["symbol", "lastPrice", "volume"]

WIRE_COLUMNS = [wire for wire, _, _ in TICKER_FIELDS]
TABLE_COLUMNS = [table for _, table, _ in TICKER_FIELDS]
DECIMAL_COLUMNS = {c: t for _, c, t in TICKER_FIELDS if isinstance(t, DecimalType)}
CRITICAL_DECIMALS = ["last_price", "volume"]


def _is_text(table_type) -> bool:
    return not isinstance(table_type, (LongType, TimestampType))


def _struct(*columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns])


TICKER_SCHEMA = StructType(
    [StructField(wire, StringType() if _is_text(kind) else LongType()) for wire, _, kind in TICKER_FIELDS]
)

SNAPSHOT_SCHEMA = _struct(
    ("fetched_at", StringType()),
    ("count", LongType()),
    ("tickers", ArrayType(TICKER_SCHEMA)),
)

# A topic record, as the Kafka source delivers it.
RAW_SCHEMA = _struct(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
)

BRONZE_SCHEMA = StructType(
    [StructField("id", LongType())]
    + [StructField(table, StringType() if _is_text(kind) else LongType()) for _, table, kind in TICKER_FIELDS]
    + [StructField("ingested_at", TimestampType())]
)

SILVER_SCHEMA = StructType(
    [StructField("id", LongType())]
    + [StructField(table, kind) for _, table, kind in TICKER_FIELDS]
    + [StructField("bronze_ingested_at", TimestampType()), StructField("transformed_at", TimestampType())]
)

ERROR_LOG_SCHEMA = _struct(
    ("source", StringType()),
    ("error_type", StringType()),
    ("error_message", StringType()),
    ("raw_payload", StringType()),
    ("kafka_topic", StringType()),
    ("kafka_partition", IntegerType()),
    ("kafka_offset", LongType()),
    ("occurred_at", TimestampType()),
)

LATEST_SCHEMA = _struct(
    ("symbol", StringType()),
    ("last_price", PRICE),
    ("open_price", PRICE),
    ("high_price", PRICE),
    ("low_price", PRICE),
    ("price_change", PRICE),
    ("price_change_pct", PERCENT),
    ("volume", VOLUME),
    ("quote_volume", VOLUME),
    ("trade_count", LongType()),
    ("updated_at", TimestampType()),
)

MOVERS_SCHEMA = _struct(
    ("rank", IntegerType()),
    ("symbol", StringType()),
    ("last_price", PRICE),
    ("price_change_pct", PERCENT),
    ("volume", VOLUME),
    ("updated_at", TimestampType()),
)

LEADERS_SCHEMA = _struct(
    ("rank", IntegerType()),
    ("symbol", StringType()),
    ("last_price", PRICE),
    ("quote_volume", VOLUME),
    ("price_change_pct", PERCENT),
    ("trade_count", LongType()),
    ("updated_at", TimestampType()),
)

HOURLY_SCHEMA = _struct(
    ("symbol", StringType()),
    ("hour", TimestampType()),
    ("open_price", PRICE),
    ("high_price", PRICE),
    ("low_price", PRICE),
    ("close_price", PRICE),
    ("total_volume", VOLUME),
    ("total_quote_volume", VOLUME),
    ("avg_price_change_pct", PERCENT),
    ("record_count", IntegerType()),
    ("created_at", TimestampType()),
)

# What an hour or window of a symbol adds up to, so that parts of it can be merged. The sums
# have the type that Spark gives the sum of a whole group, so a mean of merged parts is the same.
_PRICE_SUM, _PERCENT_SUM, _VOLUME_SUM = DecimalType(30, 8), DecimalType(20, 4), DecimalType(38, 8)

HOUR_STATE_SCHEMA = _struct(
    ("symbol", StringType()),
    ("hour", TimestampType()),
    ("open_price", PRICE),
    ("high_price", PRICE),
    ("low_price", PRICE),
    ("close_price", PRICE),
    ("volume_sum", _VOLUME_SUM),
    ("quote_volume_sum", _VOLUME_SUM),
    ("pct_sum", _PERCENT_SUM),
    ("pct_count", LongType()),
    ("record_count", LongType()),
)

WINDOW_STATE_SCHEMA = _struct(
    ("symbol", StringType()),
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("price_sum", _PRICE_SUM),
    ("price_count", LongType()),
    ("max_price", PRICE),
    ("min_price", PRICE),
    ("volume_sum", _VOLUME_SUM),
    ("pct_sum", _PERCENT_SUM),
    ("pct_count", LongType()),
    ("record_count", LongType()),
)

WINDOW_SCHEMA = _struct(
    ("symbol", StringType()),
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("avg_price", PRICE),
    ("max_price", PRICE),
    ("min_price", PRICE),
    ("total_volume", VOLUME),
    ("avg_price_change_pct", PERCENT),
    ("record_count", LongType()),
    ("computed_at", TimestampType()),
)

HEALTH_SCHEMA = _struct(
    ("checked_at", TimestampType()),
    ("bronze_count", LongType()),
    ("silver_count", LongType()),
    ("gold_count", LongType()),
    ("error_count", LongType()),
    ("dlq_count", LongType()),
)

ALERTS_SCHEMA = _struct(
    ("checked_at", TimestampType()),
    ("error_type", StringType()),
    ("cnt", LongType()),
)

TALLIES_SCHEMA = _struct(
    ("total", LongType()),
    ("rejected", LongType()),
    ("sent", LongType()),
    ("repeated", LongType()),
    ("stored_at", TimestampType()),
)

REPORTS_SCHEMA = _struct(
    ("checked_at", TimestampType()),
    ("report", StringType()),
    ("metric", StringType()),
    ("value", LongType()),
)


def avro_contract(name: str = "Ticker", namespace: str = "tickloom") -> str:
    """The ticker message as an Avro schema: required text, or nullable with a null default."""
    fields = []
    for field in TICKER_SCHEMA:
        kind = "long" if isinstance(field.dataType, LongType) else "string"
        if field.name in REQUIRED_WIRE_FIELDS:
            fields.append({"name": field.name, "type": kind})
        else:
            fields.append({"name": field.name, "type": ["null", kind], "default": None})
    return json.dumps({"type": "record", "name": name, "namespace": namespace, "fields": fields})
