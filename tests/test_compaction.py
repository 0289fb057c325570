"""Compacted days read the same before, during and after, and after breaks and repeats."""

import shutil
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.test_cycle import batches, rows
from tickloom.functions.casts import instant
from tickloom.plans import compaction, cycle
from tickloom.sources import files
from tickloom.sources.tables import LAYERS, Store, create_layers, refresh_layers

START = datetime(2024, 1, 30, 21, 10, tzinfo=timezone.utc)
NAMES = ["bronze.ticker_raw", "silver.ticker", "gold.hourly_states"]
DAY = date(2024, 1, 30)


@pytest.fixture(scope="module")
def filled(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("layers")
    store = Store(spark, str(folder))
    for n, batch in enumerate(batches(spark, sf_dir, 4)):
        moment = START + timedelta(minutes=60 * n)  # the last one is on the next day
        cycle.append_bronze(store, batch.withColumn("ingested_at", instant(moment)))
        cycle.run_cycle(store, moment)
    return folder


@pytest.fixture
def store(spark, filled, tmp_path):
    shutil.copytree(filled, tmp_path / "layers")
    return Store(spark, str(tmp_path / "layers"))


def contents(store):
    return {n: rows(store.whole(n).select(*store.whole(n).columns)) for n in NAMES}


def data_files(spark, path):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").count()


def test_closed_days_become_few_files_with_the_same_rows(store, spark):
    before = contents(store)
    gone = compaction.compact(store, START + timedelta(minutes=190))
    assert gone["bronze.ticker_raw"] == 3 and gone["silver.ticker"] == 3
    assert contents(store) == before
    assert files.names(spark, store.path("bronze.ticker_raw")) == ["day=2024-01-31"]
    assert data_files(spark, store.compact_path("silver.ticker", "2024-01-30", 1) + "/*.parquet") == 1
    assert not files.exists(spark, f"{store.root}/state/away")
    assert compaction.compact(store, START + timedelta(minutes=190)) == {}
    # Cycles go on over it, and a store of another session reads the same.
    cycle.run_cycle(store, START + timedelta(minutes=195))
    assert contents(Store(spark, store.root)) == before
    assert store.read("silver.ticker", [DAY]).count() == sum("2024-01-30" in r[-2] for r in before["silver.ticker"])


def test_blocks_of_compacted_days_are_pruned(store, spark):
    compaction.compact(store, START + timedelta(days=2))
    found = cycle._bronze_between(store, store.block_end(1), store.block_end(2))
    assert {r.id >> 36 for r in found.select("id").collect()} == {2}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(block,2)" in plan and "LessThanOrEqual(block,2)" in plan


@pytest.mark.parametrize("step", ["create", "move", "delete"])
def test_a_compaction_that_breaks_off_does_no_harm(store, monkeypatch, step):
    before, real, calls = contents(store), getattr(files, step), []

    def lost(spark, path, *more):
        if {"create": "/compacted/", "move": "", "delete": "/away"}[step] not in path:
            return real(spark, path, *more)
        calls.append(path)
        if len(calls) == (2 if step == "move" else 1):
            raise OSError("lost")
        return real(spark, path, *more)

    with monkeypatch.context() as patch:
        patch.setattr(files, step, lost)
        with pytest.raises(OSError):
            with store.exclusive("ingest"):
                compaction.compact_day(store, "bronze.ticker_raw", DAY)
    assert contents(store) == before
    compaction.compact(store, START + timedelta(days=2))
    assert contents(store) == before


def test_repeated_write_into_a_compacted_day_counts(store, spark, sf_dir):
    before = contents(store)
    compaction.compact(store, START + timedelta(days=2))
    first = batches(spark, sf_dir, 4)[0].withColumn("ingested_at", instant(START))
    cycle.append_bronze(store, first, 1)
    assert contents(store) == before
    cycle.append_bronze(store, first.limit(5), 1)
    changed = store.whole("bronze.ticker_raw")
    assert changed.filter("block = 1").count() == 5 and changed.filter("block = 2").count() > 5
    compaction.compact_day(store, "bronze.ticker_raw", DAY)
    assert store.whole("bronze.ticker_raw").filter("block = 1").count() == 5
    assert list(store.compacted("bronze.ticker_raw").values()).count(2) == 1


def test_large_days_become_several_files_in_order(store, spark):
    compaction.compact_day(store, "silver.ticker", DAY, file_rows=200)
    path = store.compact_path("silver.ticker", "2024-01-30", 1)
    spans = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min("load").alias("low"), F.max("load").alias("high"), F.min("id"), F.max("id")).orderBy("low", "min(id)").collect()
    assert len(spans) >= 3 and all(a.high <= b.low for a, b in zip(spans, spans[1:]))


def test_catalog_shows_compacted_days(store, spark):
    create_layers(store)
    counts = lambda: {n: rows(spark.table(n).select(*store.whole(n).columns)) for n in NAMES}
    try:
        before = counts()
        assert before == contents(store)
        compaction.compact(store, START + timedelta(days=2))
        refresh_layers(store)
        assert counts() == before
        cycle.append_bronze(store, store.read("bronze.ticker_raw").limit(0), 1)
        compaction.compact_day(store, "silver.ticker", DAY)
        refresh_layers(store)
        assert counts() == before
    finally:
        for layer in LAYERS:
            spark.sql(f"DROP DATABASE {layer} CASCADE")
