"""Increasing record ids for topic records, without a sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.sources.tables import BLOCK_BITS



def assign_ids(batch: DataFrame, block: int, name: str = "id") -> DataFrame:
    """Adds an id that is unique, grows from block to block, and keeps offset order.

    The batch's topic partitions are laid end to end: a record's place is its offset
    from the partition's first, after all partitions before it. Only one row per topic
    partition is ever gathered, and a repeated batch gets the same ids.
    """
    keys = ["topic", "partition"]
    spans = batch.groupBy(*keys).agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    width = F.col("last") - F.col("first") + 1
    starts = spans.select(*keys, (F.coalesce(F.sum(width).over(before), F.lit(0)) - F.col("first")).alias("shift"))
    place = F.col("offset") + F.col("shift")
    fits = place < F.lit(1 << BLOCK_BITS)
    record_id = F.when(fits, F.lit(block << BLOCK_BITS) + place + 1).otherwise(
        F.raise_error(F.lit("A batch spans more offsets than one id block holds"))
    )
    return batch.join(starts, keys).withColumn(name, record_id).drop("shift")
