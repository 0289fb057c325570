"""Scalar column expressions; all stay inside whole-stage codegen."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def is_blank(c: Column) -> Column:
    """True for NULL and for the empty string (whitespace is not blank)."""
    return F.coalesce(c, F.lit("")) == F.lit("")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def to_decimal(c: Column, kind: DataType) -> Column:
    """Text to decimal, rounding half up; NULL when blank, unparsable or too large."""
    return blank_to_null(c).try_cast(kind)


def epoch_ms(c: Column) -> Column:
    return F.timestamp_millis(c)


def instant(value: datetime | str | Column) -> Column:
    """A timestamp column from a clock argument; naive values and text are read as UTC."""
    if isinstance(value, Column):
        return value
    return F.timestamp_micros(F.lit(to_micros(value)))


def to_micros(value: datetime | str) -> int:
    moment = as_utc(value)
    delta = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def from_micros(micros: int) -> datetime:
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def as_utc(value: datetime | str) -> datetime:
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def floor_hour(value: datetime | str) -> datetime:
    return as_utc(value).replace(minute=0, second=0, microsecond=0)


def utc_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def base64_text(c: Column) -> Column:
    """Base64 on one line; Spark may break it every 76 characters, which JSON strings cannot hold."""
    return F.translate(F.base64(c), "\r\n", "")


def computed_once(d: DataFrame, name: str, c: Column, where: Column | None = None) -> DataFrame:
    """Adds a costly column so that it is evaluated once per row.

    A filter on a plain projected column is pushed below the projection and takes a
    copy of the expression along for each use; a parse would run many times per row.
    A generator over a one-element array is not pushed through, and adds no row. Rows that
    ``where`` doesn't hold for get none: a filter before a parse makes the planner copy its input.
    """
    if where is not None:
        return d.select("*", F.explode(F.when(where, F.array(c))).alias(name))
    return d.select("*", F.explode_outer(F.array(c)).alias(name))


def guarded(text: Column, guard: str) -> Column:
    """A JSON value as the first of two members of an object, the second being the guard.

    What stands behind the value, or closes it early and opens something else, shifts or hides the
    guard; so one parse tells whether the text is one whole value. A guard is not to be foreseen.
    """
    return F.concat(F.lit(f'{{"{guard}":{{"value":'), text, F.lit(f',"{guard}":{{}}}}}}'))


def guard_word() -> str:
    return uuid4().hex
