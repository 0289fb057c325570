"""A bounded map of keys that keeps most rows without a partner out of a join's shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Bits of a map: 16 per key, within these bounds (16 MB at most).
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
#: Bits that make one row of the aggregation: 4 KB.
PART = 1 << 15


def bits_of(keys: DataFrame, on: list[str]) -> np.ndarray:
    """Bits set for the hashes of the columns `on`, gathered part by part."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * keys.count()).bit_length()))
    out = np.zeros(size // 8, dtype=np.uint8)
    places = keys.select(F.pmod(F.xxhash64(*on), F.lit(size)).alias("place"))
    parts = places.groupBy((F.col("place") / PART).cast("int").alias("part")).agg(F.expr(f"bitmap_construct_agg(place % {PART})").alias("bits"))
    for row in parts.toLocalIterator():
        out[row["part"] * PART // 8 : (row["part"] + 1) * PART // 8] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out


def maybe_in(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows of df whose columns `on` may be among those of keys, and few others: a join that follows decides."""
    bits = bits_of(keys, on)
    shared, size = df.sparkSession.sparkContext.broadcast(bits), len(bits) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            place = batch.column(0).to_numpy()
            yield batch.filter(pa.array((known[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1))

    numbered = StructType([StructField(str(i), f.dataType) for i, f in enumerate([StructField("place", LongType()), *df.schema.fields])])
    placed = df.select(F.pmod(F.xxhash64(*on), F.lit(size)), *df.columns).toDF(*numbered.names)
    return placed.mapInArrow(run, numbered).drop("0").toDF(*df.columns)
