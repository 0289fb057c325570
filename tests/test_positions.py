"""Intervals of topic positions against plain sets, and what a ledger, claimed numbers and turns keep apart."""

import random
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tickloom.operators import positions
from tickloom.sources import files
from tickloom.sources import tables
from tickloom.sources.ledger import Ledger
from tickloom.sources.tables import Store

RECORD = "topic string, partition int, offset long, body string"
SPAN = "topic string, partition int, first long, last long"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "layers"))


def records(spark, places):
    return spark.createDataFrame([(*p, f"{p}") for p in places], RECORD)


def islands(places):
    out, last = [], None
    for place in sorted({p for p in places if None not in p}):
        if last and place[:2] == last[:2] and place[2] == last[2] + 1:
            out[-1][3] = place[2]
        else:
            out.append([*place, place[2]])
        last = place
    return sorted(map(tuple, out))


def random_places(seed, n=600):
    rng = random.Random(seed)
    far = [0, 1000, 65_500, 65_536, 3_000_000_000]
    return [(rng.choice("ab"), rng.randrange(3), rng.choice(far) + rng.randrange(120)) for _ in range(n)]


def test_intervals_and_unseen_agree_with_sets(spark):
    stored, batch = random_places(1), random_places(2)
    odd = [(None, 0, 5), ("a", None, 5), ("a", 0, None), ("a", 0, None)]
    spans = positions.intervals(records(spark, stored + odd))
    assert sorted(map(tuple, spans.collect())) == islands(stored)
    left = positions.unseen(records(spark, batch + odd), spans)
    assert sorted(map(str, ((r.topic, r.partition, r.offset) for r in left.collect()))) == sorted(map(str, [p for p in batch if p not in set(stored)] + odd))
    once = positions.once_each(records(spark, batch + odd))
    assert sorted(map(str, ((r.topic, r.partition, r.offset) for r in once.collect()))) == sorted(map(str, [*set(batch), *odd]))


def test_touching_intervals_join_and_others_stay(spark):
    spans = [("a", 0, 0, 4), ("a", 0, 5, 9), ("a", 0, 11, 20), ("a", 0, 12, 13), ("a", 0, 20, 21), ("a", 1, 22, 30), ("b", 0, 0, 4)]
    got = positions.joined(spark.createDataFrame(spans, SPAN))
    assert sorted(map(tuple, got.collect())) == [("a", 0, 0, 9), ("a", 0, 11, 21), ("a", 1, 22, 30), ("b", 0, 0, 4)]
    assert positions.joined(spark.createDataFrame([], SPAN)).count() == 0


def test_no_key_of_the_interval_join_is_a_whole_partition(spark):
    batch = spark.range(10_000).select(F.lit("a").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    plan = positions.unseen(batch, positions.intervals(batch))._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftright" in plan and "Join LeftAnti" in plan and "Cartesian" not in plan


def test_ledger_has_a_row_per_interval_and_knows_repeats(store, spark):
    ledger = Ledger(store, "dlq")
    first = records(spark, [("a", 0, n) for n in range(1000) if n != 500])
    fresh = ledger.fresh(first)
    assert fresh.repeated == 0 and fresh.rows.count() == 999
    ledger.note(fresh)
    assert sorted(map(tuple, ledger.stored().collect())) == [("a", 0, 0, 499), ("a", 0, 501, 999)]
    again = ledger.fresh(records(spark, [("a", 0, n) for n in range(490, 1010)] + [("a", 0, 1009), (None, 0, 1)]))
    assert sorted(str(r.offset) for r in again.rows.collect()) == sorted(["500", "1", *map(str, range(1000, 1010))])
    assert again.repeated == 490 + 20
    ledger.note(again)
    assert [tuple(r) for r in ledger.stored().collect()] == [("a", 0, 0, 1009)]
    assert Ledger(store, "ingest").stored().count() == 0


def test_eight_threads_draw_two_hundred_numbers(store):
    with ThreadPoolExecutor(8) as pool:
        drawn = list(pool.map(lambda _: store.next_number("ingest"), range(200)))
    assert sorted(drawn) == list(range(1, 201))
    assert Store(store.spark, store.root).next_number("ingest") == 201 and store.next_number("silver") == 1


def test_numbers_go_on_where_markers_of_an_older_store_ended(store):
    store.mark("ingested", tables.Marker(seq=1998, high=5))
    assert [store.next_number("ingest") for _ in range(4)] == [1999, 2000, 2001, 2002]


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "a b" / "claim%20")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: files.create(spark, path, str(n)), range(40)))
    assert sum(won) == 1 and (tmp_path / "a b" / "claim%20").read_text() == str(won.index(True))


def test_turns_exclude_each_other_and_pass_on(store, monkeypatch):
    inside, most = [], []

    def work(n):
        with store.exclusive("silver"):
            inside.append(n)
            most.append(len(inside))
            time.sleep(0.05)
            inside.remove(n)

    with ThreadPoolExecutor(5) as pool:
        list(pool.map(work, range(10)))
    assert max(most) == 1 and len(most) == 10
    with pytest.raises(OSError), store.exclusive("silver"):
        raise OSError("lost")
    with store.exclusive("silver", wait_seconds=5), store.exclusive("gold", wait_seconds=5):
        with pytest.raises(TimeoutError), store.exclusive("silver", wait_seconds=0.3):
            pass


def test_the_turn_of_a_lost_driver_runs_out_and_that_of_a_living_one_does_not(store, monkeypatch):
    monkeypatch.setattr(tables, "LEASE_SECONDS", 1.0)
    files.create(store.spark, f"{store.root}/state/turns/silver/7")  # taken, and never given back
    with store.exclusive("silver", wait_seconds=20):
        assert "8" in files.names(store.spark, f"{store.root}/state/turns/silver")
        with pytest.raises(TimeoutError), store.exclusive("silver", wait_seconds=2.5):
            pass
    assert threading.active_count() < 50
