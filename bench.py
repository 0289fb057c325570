"""Times the queries and one full incremental cycle; prints one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the local cores, and
BENCH_COPIES how often the order lines are repeated for the cycle's Bronze rows. On a
cluster BENCH_STORE names an empty folder that all executors share.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tickloom.functions.casts import instant
from tickloom.plans import cycle
from tickloom.plans.queries import QUERIES
from tickloom.session import configure
from tickloom.sources import adapters
from tickloom.sources.tables import Store

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
LOADED = datetime(2024, 1, 30, 22, 30, tzinfo=timezone.utc)
MOMENT = datetime(2024, 1, 30, 23, 5, tzinfo=timezone.utc)


def session() -> SparkSession:
    spark = (
        configure(SparkSession.builder.master(f"local[{CPUS}]"))
        .appName("tickloom-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def drain(d) -> None:
    d.write.format("noop").mode("overwrite").save()


def bench_cycle(spark: SparkSession) -> dict[str, float]:
    """Order lines as one Bronze batch, loaded and summarised; then a pass with nothing new."""
    store = Store(spark, os.environ.get("BENCH_STORE") or tempfile.mkdtemp(prefix="bench-"))
    ticks = adapters.lineitem_to_bronze(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"))
    rows = ticks.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    rows = rows.withColumn("id", F.col("id") * COPIES + F.col("copy")).drop("copy")
    # One file would be one task; spread it as topic partitions would be.
    rows = rows.withColumn("ingested_at", instant(LOADED)).repartition(int(CPUS) * 2)
    return {
        "cycle_ingest": timed(lambda: cycle.append_bronze(store, rows)),
        "cycle_silver": timed(lambda: cycle.load_silver(store, LOADED)),
        "cycle_gold": timed(lambda: cycle.refresh_gold(store, MOMENT)),
        "cycle_idle": timed(lambda: cycle.run_cycle(store, MOMENT)),
    }


def main() -> None:
    spark = session()
    if os.environ.get("BENCH_ONLY") == "cycle":
        print(json.dumps(bench_cycle(spark)))
        return
    drain(QUERIES["top_gainers"](spark, SF_DIR))
    times = {name: timed(lambda run=run: drain(run(spark, SF_DIR))) for name, run in QUERIES.items()}
    times.update(bench_cycle(spark))
    total = round(sum(times.values()), 3)
    line = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR)}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
