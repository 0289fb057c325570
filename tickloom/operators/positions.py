"""Topic positions as intervals: which are stored already, and which of a batch are new.

A position is (topic, partition, offset); an interval holds the offsets from first to last, both
included. A record that lacks any part of its position is always new and in no interval.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["topic", "partition"]
POSITION = [*KEYS, "offset"]
#: Offsets are dealt in runs of 2 to this power, so that one partition of a topic is many groups.
RUN_BITS, PIECE_BITS = 16, 10


def _placed(d: DataFrame) -> DataFrame:
    return d.where(reduce(and_, [F.col(c).isNotNull() for c in POSITION]))


def intervals(records: DataFrame) -> DataFrame:
    """``topic, partition, first, last`` of the positions of records; gaps stay gaps.

    Offsets are counted within runs first, so a partition's whole history is never sorted in one
    task; what then meets per partition is a row per run or gap.
    """
    run = F.shiftright("offset", RUN_BITS)
    once = _placed(records).select(*POSITION).distinct().withColumn("run", run)
    place = F.row_number().over(Window.partitionBy(*KEYS, "run").orderBy("offset"))
    islands = once.withColumn("island", F.col("offset") - place).groupBy(*KEYS, "run", "island")
    return joined(islands.agg(F.min("offset").alias("first"), F.max("offset").alias("last")))


def joined(spans: DataFrame) -> DataFrame:
    """Intervals that touch or overlap, as one."""
    order = Window.partitionBy(*KEYS).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(F.coalesce(F.col("first") <= reach + 1, F.lit(False)), 0).otherwise(1)
    island = F.sum("opened").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = spans.withColumn("opened", opened).withColumn("island", island)
    merged = numbered.groupBy(*KEYS, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.select(*KEYS, "first", "last")


def overlapping(one: DataFrame, other: DataFrame) -> DataFrame:
    """The parts of the intervals of ``one`` that lie in a range of ``other``, which has few per partition."""
    ranges = other.groupBy(*KEYS).agg(F.min("first").alias("low"), F.max("last").alias("high"))
    met = one.join(ranges, KEYS).where((F.col("first") <= F.col("high")) & (F.col("last") >= F.col("low")))
    return met.select(*KEYS, F.greatest("first", "low").alias("first"), F.least("last", "high").alias("last"))


def unseen(batch: DataFrame, stored: DataFrame, mine: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` whose position lies in no interval of ``stored``.

    Intervals are cut to the batch's range and into short pieces, and rows meet the pieces of
    their own stretch of offsets only: a join on equal keys with a handful of intervals each, and no
    key with more rows than a stretch has offsets. ``mine``: the batch's intervals, if known.
    """
    near = overlapping(stored, intervals(batch) if mine is None else mine)
    stretches = F.sequence(F.shiftright("first", PIECE_BITS), F.shiftright("last", PIECE_BITS))
    pieces = near.select(*[F.col(c).alias(f"_{c}") for c in (*KEYS, "first", "last")], F.explode(stretches).alias("_piece"))
    same = [F.col(c) == F.col(f"_{c}") for c in KEYS] + [F.shiftright("offset", PIECE_BITS) == F.col("_piece")]
    inside = F.col("offset").between(F.col("_first"), F.col("_last"))
    return batch.join(pieces, reduce(and_, same) & inside, "left_anti")


def once_each(batch: DataFrame) -> DataFrame:
    """One row for each position; rows without a whole position all stay."""
    whole = reduce(and_, [F.col(c).isNotNull() for c in POSITION])
    own = F.when(~whole, F.monotonically_increasing_id())
    return batch.withColumn("_own", own).dropDuplicates([*POSITION, "_own"]).drop("_own")
