import os
import re
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm.common import bitmap, with_columns


def test_a_bitmap_takes_few_jobs_whatever_the_shuffle_partitions(spark, noted_jobs):
    places = [7 * i * i % (1 << 21) for i in range(5000)] + [0, (1 << 21) - 1, 0]
    with noted_jobs() as stages:
        found = bitmap(spark.createDataFrame([(p,) for p in places], "place long"), 1 << 21)
        assert 1 <= len(stages()) < 12
    assert set(np.flatnonzero(np.unpackbits(found, bitorder="little"))) == set(places)
    assert not bitmap(spark.createDataFrame([], "place long"), 1 << 20).any()


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="the memory of a worker is read from /proc")
def test_workers_give_memory_back_between_tasks(spark):
    def held(batches):
        for batch in batches:
            time.sleep(0.2)  # so that all idle workers get a task
            told = Path("/proc/self/smaps_rollup").read_text()
            mb = sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", told))) / 1024
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()] * batch.num_rows), pa.array([mb] * batch.num_rows)], ["pid", "mb"])

    def wasteful(column):
        parts = [np.ones(1 << 13) for _ in range(3000)]  # 64 KB each
        np.kept = parts[-1]  # what stays keeps the C library from freeing those before it
        return [pa.array([len(parts)] * len(column))]

    def largest():
        return spark.range(0, 24, 1, 12).mapInArrow(held, "pid long, mb double").agg(F.max("mb")).first()[0]

    docs = spark.range(0, 4, 1, 1).select("id", F.lit("a text").alias("text"))
    before = largest()
    assert [r.n for r in with_columns(docs, wasteful, "n long").collect()] == [3000] * 4
    assert largest() < before + 60
