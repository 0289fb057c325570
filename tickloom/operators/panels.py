"""Dashboard and ad-hoc reads over the layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.casts import as_utc, instant

TOP_SYMBOLS = 10

# Colour steps of the three boards, as (lower bound, colour) from low to high.
GAINER_BANDS = [(None, "yellow"), (2, "green")]
LOSER_BANDS = [(None, "red"), (-2, "yellow")]
LEADER_BANDS = [(None, "red"), (0, "yellow"), (2, "green")]

# Display names of the leaders table.
LEADER_LABELS = {
    "rank": "#",
    "symbol": "Symbol",
    "last_price": "Price",
    "quote_volume": "Quote Volume",
    "price_change_pct": "Change %",
    "trade_count": "Trades",
    "updated_at": "Updated",
}
MOVER_LABELS = {"symbol": "symbol", "price_change_pct": "Change %"}


def _last_hours(d: DataFrame, ts_col: str, as_of, hours: int) -> DataFrame:
    return d.filter(F.col(ts_col) >= instant(as_utc(as_of) - timedelta(hours=hours)))


def rows_per_minute(d: DataFrame, ts_col: str, as_of, hours: int = 24, label: str = "rows") -> DataFrame:
    return (
        _last_hours(d, ts_col, as_of, hours)
        .groupBy(F.date_trunc("minute", ts_col).alias("time"))
        .agg(F.count(F.lit(1)).alias(label))
        .orderBy("time")
    )


def layer_counts(bronze: DataFrame, silver: DataFrame, latest: DataFrame) -> DataFrame:
    layers = [("bronze", bronze), ("silver", silver), ("gold", latest)]
    counts = [d.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("layer"), "count") for name, d in layers]
    return reduce(DataFrame.unionByName, counts)


def last_refresh(latest: DataFrame) -> DataFrame:
    return latest.agg(F.max("updated_at").alias("value"))


def hourly_top10(hourly: DataFrame, leaders: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Recent hourly volume of the ten leading symbols.

    The rank filter leaves at most ten rows of a unique-rank board, so that side is safe to broadcast.
    """
    top = leaders.filter(F.col("rank") <= TOP_SYMBOLS).select("symbol")
    return (
        _last_hours(hourly, "hour", as_of, hours)
        .join(F.broadcast(top), "symbol", "left_semi")
        .select(F.col("hour").alias("time"), "symbol", F.col("total_volume").alias("Volume"))
        .orderBy("time", "symbol")
    )


def change_band(pct: Column, steps: Sequence[tuple[float | None, str]]) -> Column:
    """The colour of the highest step at or below the value; the first step is open below."""
    (_, base), *rest = steps
    band = F.lit(base)
    for bound, colour in rest:
        band = F.when(pct >= bound, colour).otherwise(band)
    return F.when(pct.isNotNull(), band)


def board_panel(board: DataFrame, labels: dict[str, str], bands, n: int | None = None) -> DataFrame:
    """A stored board by rank under its display names, with a colour band."""
    rows = board.orderBy("rank")
    rows = rows if n is None else rows.limit(n)
    columns = [F.col(c).alias(label) for c, label in labels.items()]
    return rows.select(*columns, change_band(F.col("price_change_pct"), bands).alias("band"))


def gainers_panel(gainers: DataFrame) -> DataFrame:
    return board_panel(gainers, MOVER_LABELS, GAINER_BANDS)


def losers_panel(losers: DataFrame) -> DataFrame:
    return board_panel(losers, MOVER_LABELS, LOSER_BANDS)


def leaders_panel(leaders: DataFrame) -> DataFrame:
    return board_panel(leaders, LEADER_LABELS, LEADER_BANDS)


def top10(board: DataFrame, measure: str, n: int = TOP_SYMBOLS) -> DataFrame:
    """The first rows of a stored board: symbol, the ranked measure and the price."""
    return board.orderBy("rank").limit(n).select("symbol", measure, "last_price")


def window_latest(windows: DataFrame, n: int = 10) -> DataFrame:
    """The most recently computed window rows."""
    return windows.orderBy(F.col("computed_at").desc(), F.col("window_start").desc(), "symbol").limit(n)
