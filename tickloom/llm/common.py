"""Tables, the shared work folder and Arrow helpers that the corpus operators have in common."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from contextlib import suppress
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Parts in which a bitmap comes to the driver: a job each, whatever the number of shuffle partitions.
BITMAP_PARTS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in a single process one of our own where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tickloom-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tickloom-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: later steps don't compute them a second time."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *stored_frames: DataFrame) -> None:
    """Deletes work tables that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for frame in stored_frames:
        folders = {f.rsplit("/", 1)[0] for f in frame.inputFiles()}
        for folder in folders:
            if "/tickloom-llm/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def release() -> None:
    """Gives this process's freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError, TypeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """df.mapInArrow whose tasks give back what they freed: workers outlive their tasks, and idle ones count beside those that work."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        release()

    return df.mapInArrow(run, schema)


def bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """Bits set at the places (a column place, from 0 to bits - 1), as bytes, made in the tasks: 32,768 of them are a row of 4 KB."""
    out = np.zeros(bits // 8, dtype=np.uint8)
    made = places.groupBy((F.col("place") / 32768).cast("int").alias("part")).agg(F.expr("bitmap_construct_agg(place % 32768)").alias("bits"))
    for row in made.repartition(BITMAP_PARTS).toLocalIterator():
        out[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out


def with_columns(df: DataFrame, make: Callable[[pa.Array], list[pa.Array]], fields: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """df (without the columns of drop) and the columns `fields` that make gives for slices of the column text, a null as an empty text."""
    names = [c for c in df.columns if c not in drop]
    taken = df.select(*names, F.col("text").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = len(names)
        for batch in slices(batches, last, 1 << 21):
            new = make(texts(batch.column(last)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], *new], [str(i) for i in range(last + len(new))])

    schema = StructType([*df.select(*names).schema.fields, *StructType.fromDDL(fields).fields])
    numbered = StructType([StructField(str(i), f.dataType) for i, f in enumerate(schema.fields)])
    found = map_arrow(taken.toDF(*map(str, range(len(names) + 1))), run, numbered)
    return found.toDF(*schema.names)


def texts(column: pa.Array) -> pa.Array:
    """A string column with nulls as empty texts."""
    return pc.fill_null(column.cast(pa.string()), "")


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that one holds about `most` bytes of the text column, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if batch.num_rows > start:
            yield batch.slice(start)
