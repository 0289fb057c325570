"""Silver rows to business tables: latest per symbol, boards, hourly and 5-minute summaries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from tickloom.functions.casts import floor_hour, instant
from tickloom.schemas import (
    HOUR_STATE_SCHEMA,
    HOURLY_SCHEMA,
    LATEST_SCHEMA,
    LEADERS_SCHEMA,
    MOVERS_SCHEMA,
    PERCENT,
    PRICE,
    VOLUME,
    WINDOW_SCHEMA,
    WINDOW_STATE_SCHEMA,
)

BOARD_SIZE = 20


def latest_prices(silver: DataFrame) -> DataFrame:
    """The newest row per symbol by load time, then by id.

    ``max_by`` keeps one row per symbol in each input task before the shuffle,
    so a symbol holding a third of all rows costs no more than any other.
    """
    measures = [f.name for f in LATEST_SCHEMA if f.name not in ("symbol", "updated_at")]
    row = F.struct(*measures, F.col("transformed_at").alias("updated_at"))
    newest = F.max_by(row, F.struct("transformed_at", "id"))
    return silver.groupBy("symbol").agg(newest.alias("row")).select("symbol", "row.*")


def refresh_latest(latest: DataFrame, new_silver: DataFrame) -> DataFrame:
    """``latest`` brought up to date with newly loaded rows, without rescanning Silver.

    Equal to recomputing from all of Silver, because Silver only grows: times are
    compared, so rows that arrive out of order cannot push a symbol back. At the same
    time the new row wins, as ids grow with every load.
    """
    columns = LATEST_SCHEMA.names
    tagged = latest.select(*columns, F.lit(0).alias("fresh")).unionByName(
        latest_prices(new_silver).select(*columns, F.lit(1).alias("fresh"))
    )
    row = F.struct(*[c for c in columns if c != "symbol"])
    newest = F.max_by(row, F.struct("updated_at", "fresh"))
    return tagged.groupBy("symbol").agg(newest.alias("row")).select("symbol", "row.*")


def _board(latest: DataFrame, key: Column, order: Column, schema, as_of, n: int) -> DataFrame:
    # The limit sits below the ranking window: each task keeps its best n rows, and
    # only those n reach the single-partition window.
    ordering = [order, F.col("symbol").asc()]
    best = latest.filter(key.isNotNull()).orderBy(*ordering).limit(n)
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(*ordering)))
    return ranked.withColumn("updated_at", instant(as_of)).select(*schema.names)


def top_gainers(latest: DataFrame, as_of, n: int = BOARD_SIZE) -> DataFrame:
    key = F.col("price_change_pct")
    return _board(latest, key, key.desc(), MOVERS_SCHEMA, as_of, n)


def top_losers(latest: DataFrame, as_of, n: int = BOARD_SIZE) -> DataFrame:
    key = F.col("price_change_pct")
    return _board(latest, key, key.asc(), MOVERS_SCHEMA, as_of, n)


def volume_leaders(latest: DataFrame, as_of, n: int = BOARD_SIZE) -> DataFrame:
    key = F.col("quote_volume")
    return _board(latest, key, key.desc(), LEADERS_SCHEMA, as_of, n)


def average(name: str, kind: DecimalType) -> Column:
    """The mean rounded half up once, to the column's own scale.

    Spark's ``avg`` keeps four more digits, so rounding its result again can tip a mean
    of many rows that only lies close to a half.
    """
    return (F.sum(name) / F.nullif(F.count(name), F.lit(0))).cast(kind)


def summarize_hours(silver: DataFrame, created_at) -> DataFrame:
    """Per symbol and load hour. Open is the lowest open and close the highest last price."""
    return (
        silver.groupBy("symbol", F.date_trunc("hour", "transformed_at").alias("hour"))
        .agg(
            F.min("open_price").alias("open_price"),
            F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"),
            F.max("last_price").alias("close_price"),
            F.sum("volume").cast(VOLUME).alias("total_volume"),
            F.sum("quote_volume").cast(VOLUME).alias("total_quote_volume"),
            average("price_change_pct", PERCENT).alias("avg_price_change_pct"),
            F.count(F.lit(1)).cast("int").alias("record_count"),
        )
        .withColumn("created_at", instant(created_at))
        .select(*HOURLY_SCHEMA.names)
    )


def hourly_summary(silver: DataFrame, as_of, hours: int = 2) -> DataFrame:
    """The last complete hours before ``as_of``, as a literal range that reaches the scan."""
    end = floor_hour(as_of)
    start = end - timedelta(hours=hours)
    loaded = F.col("transformed_at")
    return summarize_hours(silver.filter((loaded >= instant(start)) & (loaded < instant(end))), as_of)


def _shaped(d: DataFrame, schema: StructType, *more: str) -> DataFrame:
    return d.select(*more, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _mean(total: str, n: str, kind: DecimalType) -> Column:
    return (F.col(total) / F.nullif(n, F.lit(0))).cast(kind)


def hour_states(silver: DataFrame, *apart: str) -> DataFrame:
    """What any part of Silver adds to each symbol and load hour; rows that differ in ``apart`` give states of their own."""
    grouped = silver.groupBy(*apart, "symbol", F.date_trunc("hour", "transformed_at").alias("hour"))
    states = grouped.agg(
        F.min("open_price").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max("last_price").alias("close_price"),
        F.sum("volume").alias("volume_sum"),
        F.sum("quote_volume").alias("quote_volume_sum"),
        F.sum("price_change_pct").alias("pct_sum"),
        F.count("price_change_pct").alias("pct_count"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return _shaped(states, HOUR_STATE_SCHEMA, *apart)


# Per column of a state how parts of it merge; every other column adds up.
HOUR_MERGE = {"open_price": F.min, "high_price": F.max, "low_price": F.min, "close_price": F.max}
WINDOW_MERGE = {"max_price": F.max, "min_price": F.min}


def _merged(states: DataFrame, schema: StructType, keys: list[str], rules: dict) -> DataFrame:
    values = [rules.get(c, F.sum)(c).alias(c) for c in schema.names if c not in keys]
    return _shaped(states.groupBy(*keys).agg(*values), schema)


def merge_hours(states: DataFrame) -> DataFrame:
    """Parts of hours as one state per symbol and hour."""
    return _merged(states, HOUR_STATE_SCHEMA, ["symbol", "hour"], HOUR_MERGE)


def finish_hours(states: DataFrame, created_at) -> DataFrame:
    """Merged states as hourly rows, equal to those ``summarize_hours`` makes of all rows at once."""
    return states.select(
        "symbol",
        "hour",
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        F.col("volume_sum").cast(VOLUME).alias("total_volume"),
        F.col("quote_volume_sum").cast(VOLUME).alias("total_quote_volume"),
        _mean("pct_sum", "pct_count", PERCENT).alias("avg_price_change_pct"),
        F.col("record_count").cast("int").alias("record_count"),
        instant(created_at).alias("created_at"),
    )


def window_states(timed: DataFrame, *apart: str) -> DataFrame:
    """What any ticks add to the windows they lie in (``window_start``, ``window_end``); ``apart`` as for hours."""
    states = timed.groupBy(*apart, "symbol", "window_start", "window_end").agg(
        F.sum("last_price").alias("price_sum"),
        F.count("last_price").alias("price_count"),
        F.max("high_price").alias("max_price"),
        F.min("low_price").alias("min_price"),
        F.sum("volume").alias("volume_sum"),
        F.sum("price_change_pct").alias("pct_sum"),
        F.count("price_change_pct").alias("pct_count"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return _shaped(states, WINDOW_STATE_SCHEMA, *apart)


def merge_windows(states: DataFrame) -> DataFrame:
    return _merged(states, WINDOW_STATE_SCHEMA, ["symbol", "window_start", "window_end"], WINDOW_MERGE)


def finish_windows(states: DataFrame, computed_at) -> DataFrame:
    """Merged states as window rows, equal to those ``window_summary`` makes of all ticks at once."""
    return states.select(
        "symbol",
        "window_start",
        "window_end",
        _mean("price_sum", "price_count", PRICE).alias("avg_price"),
        "max_price",
        "min_price",
        F.col("volume_sum").cast(VOLUME).alias("total_volume"),
        _mean("pct_sum", "pct_count", PERCENT).alias("avg_price_change_pct"),
        "record_count",
        instant(computed_at).alias("computed_at"),
    )


def in_windows(silver: DataFrame, time_col: str = "close_time", window: str = "5 minutes") -> DataFrame:
    """Ticks with ``event_time`` and the tumbling window it lies in; a tick without that time counts when it was loaded."""
    timed = silver.withColumn("event_time", F.coalesce(time_col, "transformed_at"))
    placed = timed.withColumn("_window", F.window("event_time", window))
    return placed.withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}).drop("_window")


def window_summary(
    silver: DataFrame,
    time_col: str = "close_time",
    window: str = "5 minutes",
    watermark: str = "10 minutes",
    computed_at: Column | None = None,
) -> DataFrame:
    """Tumbling windows per symbol, for batch and for streams (where the watermark closes them).

    A row without that time counts at the time it was loaded, so every row is in a window.
    """
    timed = silver.withColumn("_event_time", F.coalesce(time_col, "transformed_at"))
    return (
        timed.withWatermark("_event_time", watermark)
        .groupBy(F.window("_event_time", window).alias("window"), "symbol")
        .agg(
            average("last_price", PRICE).alias("avg_price"),
            F.max("high_price").alias("max_price"),
            F.min("low_price").alias("min_price"),
            F.sum("volume").cast(VOLUME).alias("total_volume"),
            average("price_change_pct", PERCENT).alias("avg_price_change_pct"),
            F.count(F.lit(1)).alias("record_count"),
        )
        .withColumns(
            {
                "window_start": F.col("window.start"),
                "window_end": F.col("window.end"),
                "computed_at": F.current_timestamp() if computed_at is None else computed_at,
            }
        )
        .select(*WINDOW_SCHEMA.names)
    )
