"""First-match reject expressions shared by the ingest and Silver checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from tickloom.functions.casts import is_blank, to_decimal

Rule = tuple[Column, Column]

# Message texts that readers of the error log match on.
MISSING_TEXT = "Missing required field: '{}'"
TOO_LARGE_TEXT = "Number out of range for {}: '"
NON_NUMERIC_TEXT = "Non-numeric price/volume: could not convert string to float: '"


def first_match(rules: list[Rule]) -> Column:
    """The value of the first rule whose condition holds, else NULL."""
    (condition, value), *rest = rules
    return reduce(lambda chain, rule: chain.when(*rule), rest, F.when(condition, value))


def missing(name: str) -> Rule:
    return is_blank(F.col(name)), F.lit(MISSING_TEXT.format(name))


def non_numeric(name: str, kind: DataType) -> Rule:
    """A present value that does not fit the target decimal."""
    c = F.col(name)
    number = c.try_cast("double").isNotNull() & ~F.upper(F.trim(c)).rlike("NAN|INF")
    text = F.when(number, F.lit(TOO_LARGE_TEXT.format(name))).otherwise(F.lit(NON_NUMERIC_TEXT))
    return to_decimal(c, kind).isNull(), F.concat(text, c, F.lit("'"))


def uncastable(name: str, kind: DecimalType) -> Rule:
    c = F.col(name)
    label = f"DECIMAL({kind.precision},{kind.scale})"
    return to_decimal(c, kind).isNull(), F.concat(F.lit(f"Cannot cast {name} to {label}: '"), c, F.lit("'"))


def too_long(name: str, limit: int) -> Rule:
    return F.length(name) > limit, F.concat(F.lit(f"{name} is longer than {limit} characters: '"), F.col(name), F.lit("'"))
