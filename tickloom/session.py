"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Table and board times are UTC.
    "spark.sql.session.timeZone": "UTC",
    # Join and partition sizes are settled at run time, and skewed join partitions are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The wide text-to-decimal projections outgrow what the JVM compiles to machine code
    # when fused into one method; beyond this size Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Window state lives outside the JVM heap, and its changes are logged, not copied.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
