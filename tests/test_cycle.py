"""Incremental runs: agreement with a full recompute, repeats and broken-off steps."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tickloom.functions.casts import instant
from tickloom.operators import gold, silver
from tickloom.plans import cycle
from tickloom.sources import adapters
from tickloom.sources.tables import Marker, Store, create_layers, refresh_layers

START = datetime(2024, 1, 30, 21, 10, tzinfo=timezone.utc)


def rows(d):
    return sorted(tuple(str(v) for v in r) for r in d.collect())


def batches(spark, sf_dir, count=3):
    ticks = adapters.events_to_bronze(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return [ticks.filter((F.col("id") - 1) % count == n) for n in range(count)]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "layers"))


@pytest.fixture(scope="module")
def filled(spark, sf_dir, tmp_path_factory):
    """Three cycles over thirds of the events; tests on it may only add what changes nothing."""
    store = Store(spark, str(tmp_path_factory.mktemp("layers")))
    fill(store, sf_dir)
    return store


def fill(store, sf_dir, minutes=30):
    for n, batch in enumerate(batches(store.spark, sf_dir)):
        moment = START + timedelta(minutes=minutes * n)
        cycle.append_bronze(store, batch.withColumn("ingested_at", instant(moment)))
        cycle.run_cycle(store, moment)


def test_cycles_equal_full_run(filled):
    store = filled
    bronze = store.read("bronze.ticker_raw")
    stored = store.read("silver.ticker")
    assert bronze.count() == 1000
    assert stored.count() == 958
    timeless = [c for c in stored.columns if c != "transformed_at"]
    full = silver.to_silver(bronze, "2024-01-01")
    assert rows(stored.select(timeless)) == rows(full.select(timeless))
    assert rows(store.read("gold.latest_prices")) == rows(gold.latest_prices(stored))
    rejects = store.read("bronze.error_log")
    assert rejects.count() == bronze.count() - stored.count()
    last = START + timedelta(minutes=60)
    for name, board in [("top_gainers", gold.top_gainers), ("top_losers", gold.top_losers), ("volume_leaders", gold.volume_leaders)]:
        assert rows(store.read(f"gold.{name}")) == rows(board(gold.latest_prices(stored), last))
    hours = {r.hour for r in store.read("gold.hourly_summary").collect()}
    assert hours == {datetime(2024, 1, 30, 21)}


def test_idle_cycle_changes_nothing(filled):
    store = filled
    names = ["silver.ticker", "bronze.error_log", "gold.latest_prices", "gold.hourly_summary", "gold.top_gainers"]
    before = [rows(store.read(n)) for n in names]
    cycle.run_cycle(store, START + timedelta(minutes=60))
    assert [rows(store.read(n)) for n in names] == before


def test_empty_bronze_is_a_no_op(store):
    cycle.run_cycle(store, START)
    assert store.marker("loaded") == Marker()
    assert store.read("gold.latest_prices").count() == 0


def test_broken_off_load_is_repeated_as_planned(store, sf_dir, monkeypatch):
    first, second, _ = batches(store.spark, sf_dir)
    cycle.append_bronze(store, first)
    with monkeypatch.context() as patch:
        patch.setattr(cycle, "write_errors", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            cycle.run_cycle(store, START)
    assert store.marker("loaded").seq == 0
    cycle.append_bronze(store, second)
    later = START + timedelta(hours=1)
    cycle.run_cycle(store, later)
    stored = store.read("silver.ticker")
    assert stored.count() == stored.select("id").distinct().count()
    assert rows(stored.select("id")) == rows(silver.to_silver(store.read("bronze.ticker_raw"), later).select("id"))
    assert {r.transformed_at for r in stored.select("transformed_at").distinct().collect()} == {
        START.replace(tzinfo=None),
        later.replace(tzinfo=None),
    }


def test_broken_off_hourly_overwrite_is_applied_from_staging(filled, monkeypatch):
    store = filled
    real = Store.replace_partitions

    def lose_target(self, d, name, **partitions):
        if name == "gold.hourly_summary":
            real(self, d.limit(1), name, **partitions)
            raise OSError("lost")
        real(self, d, name, **partitions)

    with monkeypatch.context() as patch:
        patch.setattr(Store, "replace_partitions", lose_target)
        with pytest.raises(OSError):
            cycle.run_cycle(store, START + timedelta(minutes=121))  # closes the hour of the third load
    assert store.read("gold.hourly_summary").count() == 1
    cycle.run_cycle(store, START + timedelta(minutes=122))
    assert_hours_equal_full_run(store)


def assert_hours_equal_full_run(store, before="2100-01-01"):
    facts = [c for c in store.read("gold.hourly_summary").columns if c != "created_at"]
    full = gold.summarize_hours(store.read("silver.ticker").filter(F.col("transformed_at") < instant(before)), START)
    assert rows(store.read("gold.hourly_summary").select(facts)) == rows(full.select(facts))


def test_hours_without_a_refresh_are_all_summarised(store, sf_dir):
    """Loads over five hours, a refresh at their end."""
    parts = batches(store.spark, sf_dir, 10)
    for n, batch in enumerate(parts):
        moment = START + timedelta(minutes=30 * n)
        cycle.append_bronze(store, batch)
        cycle.load_silver(store, moment)
    end = START + timedelta(minutes=30 * 9)  # 01:40, so the hour of the last loads is still open
    cycle.refresh_gold(store, end)
    hours = {r.hour for r in store.read("gold.hourly_summary").collect()}
    assert len(hours) == 4 and max(hours).hour == 0
    assert_hours_equal_full_run(store, "2024-01-31 01:00:00")
    cycle.refresh_gold(store, end + timedelta(hours=3))
    assert_hours_equal_full_run(store)
    assert store.read("gold.hourly_summary").count() == store.read("gold.hourly_summary").select("symbol", "hour").distinct().count()


def test_a_load_stored_after_its_hour_was_closed_is_merged(store, sf_dir, monkeypatch):
    first, second, third = batches(store.spark, sf_dir)
    cycle.append_bronze(store, first)
    cycle.run_cycle(store, START)
    cycle.append_bronze(store, second)
    with monkeypatch.context() as patch:
        patch.setattr(cycle, "write_errors", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            cycle.load_silver(store, START + timedelta(minutes=10))
    cycle.refresh_gold(store, START + timedelta(hours=2))  # the planned load keeps its hour open
    assert store.read("gold.hourly_summary").count() == 0
    cycle.run_cycle(store, START + timedelta(hours=2, minutes=1))
    assert_hours_equal_full_run(store)
    # A load of another writer, whose clock lies in the closed hour.
    load = Marker(seq=store.next_number("silver"), high=store.marker("loaded").high, as_of=START + timedelta(minutes=20))
    cycle.write_silver(store, silver.to_silver(third, load.as_of), load)
    store.mark("loaded", Marker(seq=load.seq, high=load.high, as_of=START + timedelta(hours=2, minutes=1)))
    cycle.refresh_gold(store, START + timedelta(hours=2, minutes=2))
    facts = ["symbol", "hour", "close_price", "total_volume", "avg_price_change_pct", "record_count"]
    full = gold.summarize_hours(store.read("silver.ticker"), START).select(facts)
    assert rows(store.read("gold.hourly_summary").select(facts)) == rows(full)


def test_hours_can_be_made_anew(filled):
    before = rows(gold.merge_hours(filled.scan("gold.hourly_states")))
    cycle.rebuild_hours(filled)
    assert rows(gold.merge_hours(filled.scan("gold.hourly_states"))) == before


def reads_of(monkeypatch):
    """The tables that the code under test scans."""
    scanned, real = [], Store.scan

    def scan(self, name, below=""):
        scanned.append(name)
        return real(self, name, below)

    monkeypatch.setattr(Store, "scan", scan)
    return scanned


def test_idle_cycle_reads_no_silver(filled, monkeypatch):
    scanned = reads_of(monkeypatch)
    cycle.run_cycle(filled, START + timedelta(minutes=123))
    assert scanned == ["gold.latest_prices"]


def test_health_comes_from_the_manifest(store, sf_dir, spark, monkeypatch):
    for n, batch in enumerate(batches(spark, sf_dir)):
        moment = START + timedelta(minutes=30 * n)
        block = cycle.append_bronze(store, batch.withColumn("ingested_at", instant(moment)))
        if n == 1:  # once more, and a load that breaks off
            cycle.append_bronze(store, batch.withColumn("ingested_at", instant(moment)), block)
            with monkeypatch.context() as patch:
                patch.setattr(cycle, "write_errors", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    cycle.load_silver(store, moment)
        cycle.run_cycle(store, moment)
    letters = spark.createDataFrame([("dlq_consumer", instant_of(0)), ("dlq_consumer", instant_of(1))], "source string, at timestamp")
    from tickloom.operators.bronze import error_rows

    cycle.write_errors(store, error_rows(letters, source=F.col("source"), occurred_at=F.col("at")), 1, "dlq")

    def health():
        with monkeypatch.context() as patch:
            scanned = reads_of(patch)
            cycle.record_health(store, START)
        return store.read("gold.pipeline_health"), scanned

    tables = [store.read(n) for n in ("bronze.ticker_raw", "silver.ticker", "gold.latest_prices", "bronze.error_log")]
    from tickloom.operators import quality

    expected = rows(quality.health_snapshot(*tables, START))
    stored, scanned = health()
    assert rows(stored) == expected and scanned == ["gold.latest_prices"]
    assert expected[0][1] == "1000" and expected[0][5] == "2"
    # A store from before the manifest counts once.
    from tickloom.sources import files

    files.delete(spark, f"{store.root}/state/counts")
    stored, _ = health()
    assert rows(stored) == expected * 2


def instant_of(minute):
    return (START + timedelta(minutes=minute)).replace(tzinfo=None)


def test_old_notes_are_summed_up_once(store, monkeypatch):
    from tickloom.sources import files, tables

    monkeypatch.setattr(tables, "CLAIMS", 10)
    assert store.noted_rows("x") is None
    for n in range(1, 36):
        store.note_rows("x", n, n)
    total = sum(range(1, 36))
    assert store.noted_rows("x") == total
    assert sorted(n for n in files.names(store.spark, f"{store.root}/state/counts/x") if "=" in n) == ["0=45", "1=145"]
    assert store.noted_rows("x") == total
    store.note_rows("x", 12, 0)  # a repeat, long after
    assert store.noted_rows("x") == total - 12 and store.noted_rows("x") == total - 12


def test_gate_reports_equal_the_figures(store, spark, sf_dir, monkeypatch):
    from tickloom.operators import quality

    monkeypatch.setattr(cycle, "check_layers", lambda session: None)
    cycle.append_bronze(store, batches(spark, sf_dir)[0].withColumn("ingested_at", instant(START)))
    for _ in range(2):
        cycle.run_gated(store, START)
    stored = {(r.report, r.metric): r.value for r in store.read("gold.gate_reports").collect()}
    assert store.read("gold.gate_reports").count() == len(stored) == 8
    boards = [store.read(f"gold.{n}") for n in ("latest_prices", "top_gainers", "top_losers", "volume_leaders")]
    for report, figures in (("silver_quality", quality.silver_quality(store.read("silver.ticker"), START)), ("gold_counts", quality.gold_counts(*boards))):
        assert {m: v for (r, m), v in stored.items() if r == report} == figures.first().asDict()


def test_repeated_ingest_batch_replaces_itself(store, sf_dir):
    first = batches(store.spark, sf_dir)[0]
    block = cycle.append_bronze(store, first)
    cycle.append_bronze(store, first, block)
    assert store.read("bronze.ticker_raw").count() == first.count()


def test_clock_must_not_go_back(filled):
    with pytest.raises(ValueError, match="clock went back"):
        cycle.load_silver(filled, START)


def test_id_outside_block_fails(store, sf_dir):
    first = batches(store.spark, sf_dir)[0]
    with pytest.raises(Exception, match="does not fit its block"):
        cycle.append_bronze(store, first.withColumn("id", F.lit(None).cast("long")))


def test_gated_run_and_catalog(store, sf_dir, spark):
    with pytest.raises(RuntimeError, match="Missing layers"):
        cycle.run_gated(store, START)
    create_layers(store)
    with pytest.raises(cycle.GateFailed, match="bronze_fresh"):
        cycle.run_gated(store, START)
    first = batches(spark, sf_dir)[0]
    cycle.append_bronze(store, first.withColumn("ingested_at", instant(START)))
    cycle.run_gated(store, START)
    refresh_layers(store)
    counts = spark.sql(
        "SELECT (SELECT count(*) FROM bronze.ticker_raw) b, (SELECT count(*) FROM silver.ticker) s, "
        "(SELECT count(*) FROM gold.latest_prices) g, (SELECT count(*) FROM bronze.error_log) e"
    ).first()
    health = spark.table("gold.pipeline_health").first()
    assert (health.bronze_count, health.silver_count, health.gold_count, health.error_count) == tuple(counts)
    assert health.bronze_count == first.count() and health.dlq_count == 0
    assert spark.sql("SELECT rank FROM gold.top_gainers ORDER BY rank").first().rank == 1


def test_gate_stops_on_many_errors(store, spark, sf_dir):
    create_layers(store)
    ticks = adapters.events_to_bronze(spark.read.parquet(f"{sf_dir}/events.parquet"))
    broken = ticks.withColumn("last_price", F.when(F.col("id") <= 101, "bad").otherwise(F.lit("1")))
    broken = broken.withColumns({"volume": F.lit("1"), "symbol": F.lit("A"), "ingested_at": instant(START)})
    cycle.append_bronze(store, broken)
    with pytest.raises(cycle.GateFailed, match="recent_errors: 101"):
        cycle.run_gated(store, START)
    assert store.read("gold.pipeline_health").count() == 1


def test_store_needs_utc(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="Asia/Tokyo"):
            Store(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_alerts_hold_every_type(store, spark):
    from pyspark.sql import functions as F

    from tickloom.plans import cycle
    from tickloom.schemas import ERROR_LOG_SCHEMA

    moment = "2024-01-30 23:05:00"
    errors = spark.range(60).select(
        *[
            (F.concat(F.lit("type-"), F.col("id") % 30) if f.name == "error_type" else F.lit(moment).cast("timestamp") if f.name == "occurred_at" else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in ERROR_LOG_SCHEMA
        ]
    )
    for _ in range(2):
        cycle.record_alerts(store, errors, moment)
    alerts = store.read("gold.error_alerts")
    assert alerts.count() == 30 and alerts.agg(F.sum("cnt")).first()[0] == 60


def test_two_cycles_at_once_load_each_row_once(store, sf_dir):
    from concurrent.futures import ThreadPoolExecutor

    first, second, _ = batches(store.spark, sf_dir)
    cycle.append_bronze(store, first)
    cycle.append_bronze(store, second)
    with ThreadPoolExecutor(2) as pool:
        for run in [pool.submit(cycle.run_cycle, Store(store.spark, store.root), START) for _ in range(2)]:
            run.result()
    stored = store.read("silver.ticker")
    assert stored.count() == stored.select("id").distinct().count()
    assert rows(stored.select("id")) == rows(silver.to_silver(store.read("bronze.ticker_raw"), START).select("id"))
    assert rows(store.read("gold.latest_prices")) == rows(gold.latest_prices(stored))
