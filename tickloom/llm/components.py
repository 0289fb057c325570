"""Connected components of links, by alternating large-star and small-star steps in Spark.

A node's neighbours are never gathered: a step needs the least neighbour (a partial aggregation)
and a join on the node, which skew-join handling may split. Every step is written to the shared
folder, so that lineage stays short and lost executors cost one step. Links that are few enough for
one partition are gathered in one, so that a step is one small task instead of several shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tickloom.llm.common import discard, stored

#: Links that one partition holds: some 10 MB.
PART_ROWS = 1 << 17

Shape = Callable[[DataFrame], DataFrame]


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m is the least of u and its v."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return pairs.join(least, "u")


def _noted(pairs: DataFrame) -> tuple[DataFrame, tuple[int, object], Shape]:
    """The pairs as a table, its number of rows and the sum of their hashes, and how to partition so many."""
    seen = Observation()
    told = pairs.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s"))
    table, found = stored(told, "links"), seen.get
    n = found.get("n") or 0
    return table, (n, found.get("s")), (lambda d: d.coalesce(1)) if n <= PART_ROWS else (lambda d: d)


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """node, component (its least node), for every node of links (a, b); loops and repeats don't matter.

    rows: the number of links where it is known, so that few are gathered before the first step.
    """
    spark = links.sparkSession
    ordered = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if rows is not None and rows <= PART_ROWS:
        ordered = ordered.repartition(1)
    (now, told, shape), before = _noted(ordered.distinct()), None
    while told != before:
        pairs = shape(now)
        both = shape(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        met = _least(large)
        small = shape(met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(met.select("u", F.col("m").alias("v")))).distinct()
        before = told
        after, told, shape = _noted(small)
        discard(spark, now)
        now = after
    now = shape(now)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
