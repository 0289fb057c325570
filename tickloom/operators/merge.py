"""Keyed merges as pure functions from the stored and the incoming rows."""

from __future__ import annotations

from functools import reduce
from operator import and_
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOURLY_KEYS = ["symbol", "hour"]
# Per-column merge rules of the hourly table; every other column is replaced.
HOURLY_RULES = {"open_price": "keep", "high_price": "greatest", "low_price": "least", "created_at": "keep"}
LATEST_KEYS = ["symbol"]

_OLD, _NEW = "_stored", "_incoming"


def _merged(name: str, rule: str) -> Column:
    old, new = F.col(f"{_OLD}.{name}"), F.col(f"{_NEW}.{name}")
    if rule == "greatest":
        return F.greatest(old, new)
    if rule == "least":
        return F.least(old, new)
    first, second, present = (old, new, _OLD) if rule == "keep" else (new, old, _NEW)
    # Presence of the row decides, not of the value: a stored or incoming NULL counts.
    return F.when(F.col(f"{present}.present"), first).otherwise(second)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], rules: Mapping[str, str] | None = None
) -> DataFrame:
    """``target`` after inserting or merging ``source``; both hold each key at most once.

    A rule is ``replace`` (the default), ``keep``, ``greatest`` or ``least``; the last two skip NULLs.
    """
    rules = dict(rules or {})
    unknown = set(rules.values()) - {"replace", "keep", "greatest", "least"}
    if unknown:
        raise ValueError(f"Unknown merge rules: {sorted(unknown)}")
    values = [c for c in target.columns if c not in keys]

    def side(d: DataFrame, name: str) -> DataFrame:
        return d.select(*keys, F.struct(F.lit(True).alias("present"), *values).alias(name))

    joined = side(target, _OLD).join(side(source, _NEW), list(keys), "full_outer")
    columns = [F.col(c) if c in keys else _merged(c, rules.get(c, "replace")).alias(c) for c in target.columns]
    return joined.select(*columns)


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows, one per key, whose key the target does not hold yet. A null key equals a null key.

    Pass only the part of a large target that can hold the keys (its matching
    partitions): both sides are shuffled on the key.
    """
    held = target.select(*[F.col(k).alias(f"_held_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys])
    return source.dropDuplicates(list(keys)).join(held, same, "left_anti")
