"""Ticker feeds derived from generic event and order-line tables.

Each adapter maps a whole table, row by row, to Bronze ticks with planted
defects (missing symbols, blank and unparsable numbers), so every downstream
operator can be checked against an independent SQL engine on the same files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import BRONZE_SCHEMA, CRITICAL_DECIMALS, DECIMAL_COLUMNS, PERCENT, PRICE, TICKER_FIELDS

DAY_MS = 86_400_000
FEED_TOPIC = "ticker"
FEED_PARTITIONS = 8


def _price(c: Column) -> Column:
    return c.cast(PRICE).cast("string")


def _hits(key: Column, modulus: int, remainder: int) -> Column:
    return key % modulus == remainder


# Optional numbers are bad on rows of their own: the column's place among them tells which. Even places hold
# text that is no number, odd ones a number too large for any column. A bad volume only comes with a bad price.
BAD_EVERY, JUNK, TOO_LARGE = 211, "junk", "9" * 30
OPTIONAL_NUMBERS = [c for c in DECIMAL_COLUMNS if c not in CRITICAL_DECIMALS]


def _with_bad_numbers(columns: dict[str, Column], key: Column) -> dict[str, Column]:
    bad = {
        c: F.when(_hits(key, BAD_EVERY, 17 * (place + 1)), TOO_LARGE if place % 2 else JUNK).otherwise(columns[c])
        for place, c in enumerate(OPTIONAL_NUMBERS)
    }
    volume = F.when(_hits(key, 89, 5) & _hits(key, 2, 0), JUNK).otherwise(columns["volume"])
    return {**columns, **bad, "volume": volume}


def _utc(ts: Column) -> Column:
    """A zone-less timestamp read as UTC, whatever the session zone is."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")


def _bronze(d: DataFrame, key: Column, symbol: Column, value: Column, moment: Column) -> DataFrame:
    price = _price(value)
    close_time = F.unix_millis(moment)
    columns = {
        "id": key + 1,
        "symbol": F.when(~_hits(key, 101, 7), symbol),
        "price_change": _price(value - 100),
        "price_change_pct": F.when(_hits(key, 83, 3), "").otherwise((value - 100).cast(PERCENT).cast("string")),
        "last_price": F.when(_hits(key, 97, 5), "").when(_hits(key, 89, 5), "n/a").otherwise(price),
        "open_price": _price(value * 0.95),
        "high_price": _price(value * 1.05),
        "low_price": _price(value * 0.9),
        "volume": F.when(_hits(key, 107, 9), "").otherwise(_price(value * 10)),
        "quote_volume": _price(value * value),
        "open_time": close_time - DAY_MS,
        "close_time": close_time,
        "trade_count": key % 1000,
        "ingested_at": moment,
    }
    whole = _with_bad_numbers({f.name: columns.get(f.name, price) for f in BRONZE_SCHEMA}, key)
    return d.select(*[whole[f.name].alias(f.name) for f in BRONZE_SCHEMA])


def events_to_bronze(events: DataFrame) -> DataFrame:
    """One tick per event, on 50 symbols."""
    symbol = F.concat(F.lit("SYM"), (F.col("user_id") % 50).cast("string"))
    return _bronze(events, F.col("event_id"), symbol, F.col("value"), _utc(F.col("ts")))


def events_to_earlier_bronze(events: DataFrame) -> DataFrame:
    """A second feed from the same events: other prices, and symbols that overlap only in part."""
    symbol = F.concat(F.lit("SYM"), (F.col("user_id") % 50 + 25).cast("string"))
    value = F.col("value") + F.col("event_id") % 7 - 3 + 5
    return _bronze(events, F.col("event_id"), symbol, value, _utc(F.col("ts")))


def lineitem_to_bronze(lineitem: DataFrame) -> DataFrame:
    """One tick per order line. The key columns repeat, so ids are not unique here."""
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    symbol = F.concat(F.lit("SYM"), (F.col("l_suppkey") % 3559).cast("string"))
    return _bronze(lineitem, key, symbol, F.col("l_extendedprice") / 100, _utc(F.col("l_shipdate")))


def bronze_to_raw(bronze: DataFrame, broken: Column | None = None) -> DataFrame:
    """Bronze ticks as topic records with a JSON value; rows marked ``broken`` get a truncated value."""
    wire = F.struct(*[F.col(table).alias(name) for name, table, _ in TICKER_FIELDS])
    value = F.to_json(wire, {"ignoreNullFields": "false"})
    if broken is not None:
        value = F.when(broken, F.substring(value, 1, 20)).otherwise(value)
    position = F.col("id") - 1
    return bronze.select(
        F.col("symbol").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(FEED_TOPIC).alias("topic"),
        (position % FEED_PARTITIONS).cast("int").alias("partition"),
        F.floor(position / FEED_PARTITIONS).cast("long").alias("offset"),
        F.col("ingested_at").alias("timestamp"),
    )
