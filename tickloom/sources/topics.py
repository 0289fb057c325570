"""Topic, landing-folder and database connectors.

The topic functions need the Kafka package on the session's class path, the
Avro ones the Avro package, and the database ones the driver of the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.bronze import snapshot_header
from tickloom.schemas import RAW_SCHEMA
from tickloom.sources.decode import decode_landing, decode_snapshots, explode_snapshot, landed

# Client time-outs of the live ticker subscription.
SESSION_TIMEOUT_MS = 30_000
REQUEST_TIMEOUT_MS = 40_000


def topic_options(servers: str, topic: str, starting: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **extra}


def _subscribe(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def read_topic(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    """A topic from its first record on; the stream's checkpoint keeps the position."""
    extra = {} if max_offsets is None else {"maxOffsetsPerTrigger": str(max_offsets)}
    return _subscribe(spark, topic_options(servers, topic, "earliest", **extra))


def read_live_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """A topic from now on, going on past records the broker has dropped."""
    extra = {
        "failOnDataLoss": "false",
        "kafka.session.timeout.ms": str(SESSION_TIMEOUT_MS),
        "kafka.request.timeout.ms": str(REQUEST_TIMEOUT_MS),
    }
    return _subscribe(spark, topic_options(servers, topic, "latest", **extra))


def read_topic_dump(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Topic records from a folder of Parquet files, as a stream."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_landing_lines(spark: SparkSession, path: str, streaming: bool = True) -> DataFrame:
    """Lines of a landing folder with the file they lie in and the byte their part of it starts at."""
    reader = spark.readStream if streaming else spark.read
    return _placed(reader.text(path))


def _placed(read: DataFrame) -> DataFrame:
    file = F.col("_metadata")
    return read.select("value", file.getField("file_path").alias("path"), file.getField("file_block_start").alias("position"))


def read_landing(spark: SparkSession, path: str, streaming: bool = True) -> DataFrame:
    """Tickers from a folder of JSON lines, as a stream or as a table; ``landing_rejects`` has the lines that are none."""
    return landed(decode_landing(read_landing_lines(spark, path, streaming)))


def read_snapshot_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole snapshot files as text; one is as large as a snapshot of all symbols, a few megabytes."""
    return _placed(spark.read.text(path, wholetext=True))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Tickers from a folder of whole-document snapshot files; ``snapshot_rejects`` has the files that are none."""
    return explode_snapshot(decode_snapshots(read_snapshot_files(spark, path)).filter("decode_ok"))


def write_snapshot(tickers: DataFrame, path: str, as_of) -> None:
    """A snapshot as one JSON line per ticker, and a one-row header once the tickers are complete."""
    tickers.write.mode("overwrite").json(f"{path}/tickers")
    stored = tickers.sparkSession.read.schema(tickers.schema).json(f"{path}/tickers")
    snapshot_header(stored, as_of).write.mode("overwrite").json(f"{path}/header")


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Keyed messages of a batch to a topic."""
    messages.write.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic}).save()


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    return spark.read.jdbc(url, table, properties=properties)


def write_jdbc(d: DataFrame, url: str, table: str, properties: dict[str, str]) -> bool:
    """Appends a micro-batch to a database table; an empty one opens no connection.

    The emptiness test reads at most one row, and errors are left to fail the batch.
    """
    rows = d.persist()
    try:
        if rows.isEmpty():
            return False
        rows.write.jdbc(url, table, mode="append", properties=properties)
        return True
    finally:
        rows.unpersist()
