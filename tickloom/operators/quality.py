"""Data-quality metrics, gates and health snapshots."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.casts import as_utc, instant

RECENT_MINUTES = 10
ERROR_LIMIT = 100


def recent(d: DataFrame, ts_col: str, as_of, minutes: int = RECENT_MINUTES) -> DataFrame:
    """Rows from the last minutes, as a bare-column literal predicate that reaches the scan."""
    return d.filter(F.col(ts_col) >= instant(as_utc(as_of) - timedelta(minutes=minutes)))


def _count(d: DataFrame, name: str) -> DataFrame:
    return d.agg(F.count(F.lit(1)).alias(name))


def recent_bronze(bronze: DataFrame, as_of, minutes: int = RECENT_MINUTES) -> DataFrame:
    return _count(recent(bronze, "ingested_at", as_of, minutes), "new_rows")


def silver_quality(silver: DataFrame, as_of, minutes: int = RECENT_MINUTES) -> DataFrame:
    """Recent rows and their nulls in the critical columns, in one pass."""
    return recent(silver, "transformed_at", as_of, minutes).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("last_price").isNull()).alias("null_prices"),
        F.count_if(F.col("symbol").isNull()).alias("null_symbols"),
        F.count_if(F.col("volume").isNull()).alias("null_volumes"),
    )


def _beside(frames: list[DataFrame]) -> DataFrame:
    """One-row frames side by side."""
    return reduce(lambda left, right: left.crossJoin(right), frames)


def gold_counts(latest: DataFrame, gainers: DataFrame, losers: DataFrame, leaders: DataFrame) -> DataFrame:
    return _beside(
        [_count(latest, "latest"), _count(gainers, "gainers"), _count(losers, "losers"), _count(leaders, "volume")]
    )


def errors_by_type(log: DataFrame, as_of=None, minutes: int = RECENT_MINUTES) -> DataFrame:
    """Errors per type, most frequent first; all time when no clock is given."""
    rows = log if as_of is None else recent(log, "occurred_at", as_of, minutes)
    return (
        rows.groupBy("error_type").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col("cnt").desc(), F.col("error_type"))
    )


def recent_error_total(log: DataFrame, as_of, minutes: int = RECENT_MINUTES) -> DataFrame:
    return _count(recent(log, "occurred_at", as_of, minutes), "total")


def health_snapshot(bronze: DataFrame, silver: DataFrame, latest: DataFrame, log: DataFrame, as_of) -> DataFrame:
    """One row of table counts; the error log is read once for both of its counts."""
    errors = log.agg(
        F.count(F.lit(1)).alias("error_count"),
        F.count_if(F.col("source") == "dlq_consumer").alias("dlq_count"),
    )
    counts = [_count(bronze, "bronze_count"), _count(silver, "silver_count"), _count(latest, "gold_count"), errors]
    return _beside(counts).select(
        instant(as_of).alias("checked_at"), "bronze_count", "silver_count", "gold_count", "error_count", "dlq_count"
    )


def _gate(metric: DataFrame, gate: str, value: str, threshold: int, at_most: bool = False) -> DataFrame:
    v = F.col(value)
    return metric.select(
        F.lit(gate).alias("gate"),
        v.alias("value"),
        F.lit(threshold).cast("long").alias("threshold"),
        (v <= threshold if at_most else v >= threshold).alias("passed"),
    )


def bronze_gate(bronze: DataFrame, as_of) -> DataFrame:
    """At least one row in the last ten minutes."""
    return _gate(recent_bronze(bronze, as_of), "bronze_fresh", "new_rows", 1)


def silver_gate(silver: DataFrame, as_of) -> DataFrame:
    """Recent rows exist and none lacks its symbol; null prices and volumes are only reported."""
    rules = [("silver_rows", "total", 1, False), ("silver_null_symbols", "null_symbols", 0, True)]
    verdicts = [
        F.struct(
            F.lit(gate).alias("gate"),
            F.col(value).alias("value"),
            F.lit(threshold).cast("long").alias("threshold"),
            (F.col(value) <= threshold if at_most else F.col(value) >= threshold).alias("passed"),
        )
        for gate, value, threshold, at_most in rules
    ]
    return silver_quality(silver, as_of).select(F.inline(F.array(*verdicts)))


def gold_gate(latest: DataFrame) -> DataFrame:
    return _gate(_count(latest, "rows"), "gold_filled", "rows", 1)


def error_gate(log: DataFrame, as_of, limit: int = ERROR_LIMIT) -> DataFrame:
    return _gate(recent_error_total(log, as_of), "recent_errors", "total", limit, at_most=True)


def quality_gates(bronze: DataFrame, silver: DataFrame, latest: DataFrame, log: DataFrame, as_of) -> DataFrame:
    """``gate, value, threshold, passed`` for every gate."""
    gates = [bronze_gate(bronze, as_of), silver_gate(silver, as_of), gold_gate(latest), error_gate(log, as_of)]
    return reduce(DataFrame.unionByName, gates)
