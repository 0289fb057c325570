"""The ledger of a source: which topic positions its target already holds.

A stream's checkpoint knows what that stream has read. The ledger belongs to the target, so a
new checkpoint, a second stream or a replay of a dump finds there what is stored and passes on the
rest. It has a row per interval of offsets, not per record, and alternates between two slots like
the store's other small tables.

A batch is noted after its rows are stored. A repeat of a batch that broke off in between writes the
same rows into the same partitions again, as its number has not changed; a repeat of a noted one
finds nothing new and leaves them. Only if a writer breaks off in between and is given up for
a new checkpoint are that batch's rows stored twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tickloom.operators import positions
from tickloom.sources.tables import SLOTS, Marker, Store

LEDGER_SCHEMA = StructType(
    [
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("first", LongType()),
        StructField("last", LongType()),
    ]
)


def _count_placed(batch: DataFrame) -> int:
    whole = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    return batch.agg(F.count_if(whole).alias("n")).first().n


@dataclass
class Fresh:
    """The rows of a batch that are not stored yet, and the batch's own intervals."""

    rows: DataFrame
    spans: DataFrame
    repeated: int


class Ledger:
    """Stored offset intervals of one source. Use it inside ``store.exclusive`` of the same target."""

    def __init__(self, store: Store, source: str):
        self.store = store
        self.source = source
        self._marker = f"ledger_{source}"

    def _path(self, seq: int) -> str:
        return f"{self.store.root}/state/ledger/{self.source}/slot={seq % SLOTS}"

    def stored(self) -> DataFrame:
        """``topic, partition, first, last`` of what is stored."""
        seq = self.store.marker(self._marker).seq
        if seq == 0:
            return self.store.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.store.spark.read.schema(LEDGER_SCHEMA).parquet(self._path(seq))

    def fresh(self, batch: DataFrame) -> Fresh:
        """What of a batch is new. Batches behind everything stored pass through unchanged."""
        # Few rows: one per gap or run of offsets.
        spans = positions.intervals(batch).persist()
        known = self.stored()
        placed = _count_placed(batch)
        distinct = spans.agg(F.coalesce(F.sum(F.col("last") - F.col("first") + 1), F.lit(0)).alias("n")).first().n
        rows, repeated = batch, placed - distinct
        if repeated:
            rows = positions.once_each(rows)
        if not positions.overlapping(known, spans).isEmpty():
            rows = positions.unseen(rows, known, spans)
            repeated = placed - _count_placed(rows)
        return Fresh(rows, spans, repeated)

    def note(self, fresh: Fresh) -> None:
        """Adds a stored batch's intervals."""
        seq = self.store.marker(self._marker).seq + 1
        both = positions.joined(self.stored().unionByName(fresh.spans.select(*LEDGER_SCHEMA.names)))
        both.coalesce(1).write.mode("overwrite").parquet(self._path(seq))
        self.store.mark(self._marker, Marker(seq=seq))
