"""Bronze text rows to typed Silver rows, behind an id watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickloom.functions.casts import blank_to_null, epoch_ms, instant, is_blank, to_decimal
from tickloom.functions.validation import MISSING_TEXT, first_match, missing, too_long, uncastable
from tickloom.operators.bronze import VALIDATION_ERROR, error_rows
from tickloom.schemas import CRITICAL_DECIMALS, DECIMAL_COLUMNS, SYMBOL_MAX_LENGTH, TABLE_COLUMNS

CAST_ERROR = "cast_error"


def incremental(bronze: DataFrame, low: int) -> DataFrame:
    """Rows above the watermark. The literal reaches the Parquet reader."""
    return bronze.filter(F.col("id") > F.lit(low))


def incremental_from(bronze: DataFrame, watermark: DataFrame) -> DataFrame:
    """Rows above the largest id of a watermark table, as one scalar subquery."""
    low = watermark.agg(F.coalesce(F.max("id"), F.lit(0)).alias("low")).scalar()
    return bronze.filter(F.col("id") > low)


def next_watermark(bronze: DataFrame) -> DataFrame:
    """The largest id, 0 for an empty table."""
    return bronze.agg(F.coalesce(F.max("id"), F.lit(0).cast("long")).alias("id"))


def _typed(name: str) -> Column:
    if name in DECIMAL_COLUMNS:
        return to_decimal(F.col(name), DECIMAL_COLUMNS[name])
    if name in ("open_time", "close_time"):
        return epoch_ms(F.col(name))
    return F.col(name)


def _loadable() -> Column:
    condition = F.col("symbol").isNotNull() & (F.length("symbol") <= SYMBOL_MAX_LENGTH)
    for c in CRITICAL_DECIMALS:
        # The plain null test repeats what the cast implies so that it can reach the scan.
        condition = condition & F.col(c).isNotNull() & _typed(c).isNotNull()
    return condition


def _refused() -> Column:
    return ~F.coalesce(_loadable(), F.lit(False))


def to_silver(bronze: DataFrame, transformed_at) -> DataFrame:
    """Typed rows. Bad text in an optional number becomes NULL; in a critical one it drops the row
    (see ``silver_rejects``)."""
    columns = [F.col("id"), *[_typed(c).alias(c) for c in TABLE_COLUMNS]]
    return bronze.filter(_loadable()).select(
        *columns,
        F.col("ingested_at").alias("bronze_ingested_at"),
        instant(transformed_at).alias("transformed_at"),
    )


def count_refused(bronze: DataFrame, observation: Observation) -> DataFrame:
    """``bronze`` unchanged; running it also counts the rows ``to_silver`` would drop, as ``refused``."""
    return bronze.observe(observation, F.count_if(_refused()).alias("refused"))


def silver_rejects(bronze: DataFrame, occurred_at) -> DataFrame:
    """The exact complement of ``to_silver`` as error-log rows."""
    absent = (F.col("symbol").isNull(), F.lit(MISSING_TEXT.format("symbol")))
    gaps = [absent, *[missing(c) for c in CRITICAL_DECIMALS]]
    misfits = [too_long("symbol", SYMBOL_MAX_LENGTH)]
    misfits += [uncastable(c, DECIMAL_COLUMNS[c]) for c in CRITICAL_DECIMALS]
    payload = F.to_json(F.struct("id", *TABLE_COLUMNS), {"ignoreNullFields": "false"})
    is_gap = F.col("symbol").isNull()
    for c in CRITICAL_DECIMALS:
        is_gap = is_gap | is_blank(F.col(c))
    return error_rows(
        bronze.filter(_refused()),
        source=F.lit("transformer"),
        error_type=F.when(is_gap, VALIDATION_ERROR).otherwise(CAST_ERROR),
        error_message=first_match([*gaps, *misfits]),
        raw_payload=payload,
        occurred_at=instant(occurred_at),
    )


def cast_failures(bronze: DataFrame) -> DataFrame:
    """Per numeric column, how many non-blank values did not fit. One pass, one row per column."""
    bad = [
        F.count_if(blank_to_null(F.col(c)).isNotNull() & to_decimal(F.col(c), kind).isNull()).alias(c)
        for c, kind in DECIMAL_COLUMNS.items()
    ]
    counts = bronze.agg(*bad)
    return counts.unpivot([], list(DECIMAL_COLUMNS), "column_name", "failures")


