"""Streams over dumped topic records, run to the end of the data and restarted."""

import json
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tickloom.operators import gold, silver
from tickloom.operators.identity import assign_ids
from tickloom.schemas import RAW_SCHEMA, TICKER_SCHEMA
from tickloom.sources.ledger import Ledger
from tickloom.sources.tables import Store
from tickloom.sources.topics import read_landing, read_topic_dump
from tickloom.streaming import streams

NOW = datetime(2024, 1, 2, 12, 0, tzinfo=timezone.utc)
MIDNIGHT = datetime(2024, 1, 1, tzinfo=timezone.utc)
ONCE = {"availableNow": True}


def tick(minute, symbol="BTC", price="10", **more):
    close = int((MIDNIGHT + timedelta(minutes=minute)).timestamp() * 1000)
    fields = {"symbol": symbol, "lastPrice": price, "highPrice": price, "lowPrice": price, "volume": "2", "closeTime": close}
    return json.dumps({**fields, "priceChangePercent": "1.5", **more})


def dump(spark, path, values, first_offset=0, topic="ticker", partition=0):
    records = [
        (None, v if isinstance(v, bytes) else v.encode(), topic, partition, first_offset + n, MIDNIGHT)
        for n, v in enumerate(values)
    ]
    spark.createDataFrame(records, RAW_SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        topic = str(tmp_path / "topic")
        checkpoint = str(tmp_path / "checkpoints")
        store = Store(spark, str(tmp_path / "layers"))

    return Place


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def run_windows(spark, place, **options):
    raw = read_topic_dump(spark, place.topic)
    return finish(streams.start_windows(raw, place.store, trigger=ONCE, checkpoint=place.checkpoint, **options))


def starts(d):
    return sorted(r.window_start.strftime("%H:%M") for r in d.select("window_start").collect())


def test_windows_close_once_and_drop_late_rows(spark, place):
    dump(spark, place.topic, [tick(m) for m in range(0, 50, 5)])
    run_windows(spark, place)
    closed = place.store.read("gold.window_aggregations")
    assert starts(closed) == ["00:00", "00:05", "00:10", "00:15", "00:20", "00:25", "00:30"]

    batch = gold.window_summary(silver.to_silver(bronze_of(spark, place), NOW), computed_at=F.lit(None))
    facts = ["symbol", "window_start", "avg_price", "max_price", "min_price", "total_volume", "avg_price_change_pct", "record_count"]
    expected = {tuple(r) for r in batch.select(facts).collect()}
    assert {tuple(r) for r in closed.select(facts).collect()} <= expected

    dump(spark, place.topic, [tick(5), tick(120)], first_offset=10)
    run_windows(spark, place)
    assert starts(place.store.read("gold.window_aggregations"))[7:] == ["00:35", "00:40", "00:45"]
    run_windows(spark, place)
    assert place.store.read("gold.window_aggregations").count() == 10


def bronze_of(spark, place):
    from tickloom.operators import bronze as ingest

    checked = streams.checked_records(spark.read.schema(RAW_SCHEMA).parquet(place.topic))
    return ingest.to_bronze(ingest.valid(checked), NOW)


def test_processing_time_closes_no_window_at_once(spark, place):
    dump(spark, place.topic, [tick(m) for m in range(0, 50, 5)])
    run_windows(spark, place, time_col="transformed_at")
    assert place.store.read("gold.window_aggregations").count() == 0


def ingest_values():
    return [
        tick(0),
        tick(1, price="bad"),
        tick(2, symbol=""),
        b"\x00\x00\x00\x00\x01\x06BTC",
        tick(3, symbol="ETH"),
        tick(4, volume="0"),
    ]


def test_ingest_splits_and_restarts(spark, place):
    letters = []
    dump(spark, place.topic, ingest_values())

    def run():
        raw = read_topic_dump(spark, place.topic)
        return finish(
            streams.start_ingest(
                raw,
                place.store,
                trigger=ONCE,
                checkpoint=place.checkpoint,
                clock=lambda: NOW,
                dead_letters=lambda d, batch_id: letters.extend(json.loads(bytes(r.value)) for r in d.collect()),
            )
        )

    query = run()
    tallies = query.lastProgress["observedMetrics"][streams.TALLIES]
    assert (tallies["total"], tallies["rejected"], tallies["sent"]) == (6, 3, 3)
    bronze = place.store.read("bronze.ticker_raw")
    errors = place.store.read("bronze.error_log")
    assert bronze.count() == 3 and errors.count() == 3
    assert {(r.error_type, r.kafka_offset) for r in errors.collect()} == {
        ("validation_error", 1),
        ("validation_error", 2),
        ("decode_error", 3),
    }
    assert sorted(letter["offset"] for letter in letters) == [1, 2, 3]
    first_ids = {r.id for r in bronze.collect()}
    dump(spark, place.topic, [tick(9)], first_offset=6)
    run()
    ids = sorted(r.id for r in place.store.read("bronze.ticker_raw").collect())
    assert len(ids) == 4 and ids[-1] > max(first_ids)
    run()
    assert place.store.read("bronze.ticker_raw").count() == 4


def test_repeated_batch_replaces_itself(spark, place, monkeypatch):
    dump(spark, place.topic, ingest_values())

    def run(now):
        raw = read_topic_dump(spark, place.topic)
        return streams.start_ingest(raw, place.store, trigger=ONCE, checkpoint=place.checkpoint, clock=lambda: now)

    with monkeypatch.context() as patch:
        patch.setattr(streams, "write_bronze", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            run(NOW).awaitTermination(120)
    assert place.store.read("bronze.error_log").count() == 3
    finish(run(NOW + timedelta(days=1)))
    errors = place.store.read("bronze.error_log")
    assert errors.count() == 3
    assert {r.occurred_at for r in errors.collect()} == {NOW.replace(tzinfo=None)}
    assert place.store.read("bronze.ticker_raw").count() == 3


def test_silver_stream_feeds_gold(spark, place):
    from tickloom.plans import cycle

    dump(spark, place.topic, [*ingest_values(), tick(6, symbol="X" * 21), tick(7, price="12"), tick(8, highPrice="junk")])

    def run():
        raw = read_topic_dump(spark, place.topic)
        finish(streams.start_silver(raw, place.store, trigger=ONCE, checkpoint=place.checkpoint, clock=lambda: NOW))

    run()
    stored = place.store.read("silver.ticker")
    assert stored.count() == 5
    assert stored.filter("bronze_ingested_at IS NULL").count() == 5
    assert stored.filter("high_price IS NULL").count() == 1
    types = sorted(r.error_type for r in place.store.read("bronze.error_log").collect())
    assert types == ["cast_error", "decode_error", "validation_error", "validation_error"]
    cycle.refresh_gold(place.store, NOW)
    latest = {r.symbol: r for r in place.store.read("gold.latest_prices").collect()}
    assert set(latest) == {"BTC", "ETH"}
    assert latest["BTC"].high_price is None  # the newest offset wins
    dump(spark, place.topic, [tick(10, symbol="ADA")], first_offset=9)
    run()
    cycle.refresh_gold(place.store, NOW)
    assert place.store.read("gold.latest_prices").count() == 3


def test_dead_letters_are_logged(spark, place):
    letters = [
        json.dumps({"error_type": "validation_error", "error_message": "m", "original_topic": "t", "payload": {"a": 1}}),
        "not json",
        json.dumps({"error_message": None}),
        "[1]",
    ]
    dump(spark, place.topic, letters, topic="ticker-dlq", partition=3)
    raw = read_topic_dump(spark, place.topic)
    finish(streams.start_dlq(raw, place.store, trigger=ONCE, checkpoint=place.checkpoint, clock=lambda: NOW))
    logged = sorted(place.store.read("bronze.error_log").collect(), key=lambda r: r.kafka_offset)
    assert [r.error_type for r in logged] == ["validation_error", "dlq_parse_error", "unknown", "dlq_parse_error"]
    assert (logged[0].kafka_topic, logged[0].kafka_partition, logged[0].raw_payload) == ("t", 3, '{"a":1}')
    assert (logged[2].error_message, logged[2].raw_payload) == ("unknown", "null")


def test_landing_to_messages(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    spark.createDataFrame([("BTC", "1"), (None, None)], "symbol string, lastPrice string").write.json(landing)
    tickers = read_landing(spark, landing)
    assert tickers.schema == TICKER_SCHEMA
    finish(
        streams.start_publish(
            tickers, lambda d, n: d.write.mode("append").parquet(out), trigger=ONCE, checkpoint=str(tmp_path / "c")
        )
    )
    sent = {bytes(r.key).decode(): json.loads(bytes(r.value)) for r in spark.read.parquet(out).collect()}
    assert set(sent) == {"BTC", ""}
    assert (sent[""]["lastPrice"], sent[""]["volume"], sent["BTC"]["lastPrice"]) == ("0", "0", "1")


def test_ids_grow_with_blocks_and_offsets(spark):
    records = [(t, p, o) for t in ("a", "b") for p in (0, 1) for o in (5, 6, 9)]
    batch = spark.createDataFrame(records, "topic string, partition int, offset long")
    ids = {(r.topic, r.partition, r.offset): r.id for r in assign_ids(batch, 3).collect()}
    assert len(set(ids.values())) == len(records)
    assert all(i >> 36 == 3 for i in ids.values())
    assert [ids[k] for k in records] == sorted(ids.values())
    assert min(i for r in [assign_ids(batch, 4)] for i in [r.agg(F.min("id")).first()[0]]) > max(ids.values())
    assert {(r.topic, r.partition, r.offset): r.id for r in assign_ids(batch, 3).collect()} == ids


def test_checkpoint_comes_from_the_session(spark):
    assert streams.checkpoint_for(spark, "x") == f"{spark.conf.get('spark.checkpoint.dir')}/streams/x"
    assert streams.checkpoint_for(spark, "x", "/base/") == "/base/streams/x"


def test_a_new_checkpoint_adds_what_is_new_and_loses_nothing(spark, place, tmp_path):
    """Streams under a second, fresh checkpoint on the same day: all earlier rows stay, stored positions stay single."""
    other = str(tmp_path / "other")
    values = [tick(m) for m in range(0, 60, 5)] + [tick(3, price="bad")]
    dump(spark, place.topic, values)
    options = {"trigger": ONCE, "clock": lambda: NOW}

    def run(checkpoint):
        raw = read_topic_dump(spark, place.topic)
        finish(streams.start_ingest(raw, place.store, checkpoint=checkpoint, **options))
        finish(streams.start_silver(raw, place.store, checkpoint=checkpoint, **options))
        finish(streams.start_dlq(raw, place.store, checkpoint=checkpoint, **options))
        finish(streams.start_windows(raw, place.store, checkpoint=checkpoint, trigger=ONCE))

    def counts():
        return {n: place.store.read(n).count() for n in ("bronze.ticker_raw", "silver.ticker", "bronze.error_log")}

    run(place.checkpoint)
    first, windows = counts(), place.store.read("gold.window_aggregations").count()
    assert first["bronze.ticker_raw"] == 12 and first["silver.ticker"] == 12
    dump(spark, place.topic, values, first_offset=len(values))
    for _ in range(2):
        run(other)
        assert counts() == {n: 2 * v for n, v in first.items()}
        # A window query's state is its checkpoint's: the second one closes its windows once more.
        assert place.store.read("gold.window_aggregations").count() == 2 * windows
    ids = [r.id for r in place.store.read("bronze.ticker_raw").select("id").collect()]
    assert len(set(ids)) == 24


def test_numbers_of_writers(place):
    store = place.store
    assert [store.number_for("ingest", "a", 0), store.number_for("ingest", "a", 0), store.number_for("ingest", "b", 0)] == [1, 1, 2]
    assert store.next_number("ingest") == 3 and store.number_for("ingest", "a", 1) == 4
    with pytest.raises(ValueError):
        store.number_for("ingest", "a", 0)


def test_rows_without_close_time_are_in_a_window(spark, place):
    dump(spark, place.topic, [tick(0), tick(1, closeTime=None)])
    typed = silver.to_silver(bronze_of(spark, place), NOW)
    windows = gold.window_summary(typed, computed_at=F.lit(None)).select("window_start", "record_count").collect()
    assert sorted((r.window_start.hour, r.record_count) for r in windows) == [(0, 1), (12, 1)]


@pytest.mark.parametrize("tail", ['{"symbol":"B"}', " trailing", ",", "]", '],["', "}", ',"x":1}'])
def test_bytes_behind_a_value_are_refused(spark, place, tail):
    dump(spark, place.topic, [tick(0), tick(0) + tail])
    records = streams.checked_records(spark.read.schema(RAW_SCHEMA).parquet(place.topic))
    assert sorted(r.error_type or "" for r in records.select("error_type").collect()) == ["", "decode_error"]


def run_ingest(spark, place, checkpoint):
    raw = read_topic_dump(spark, place.topic, max_files=1)
    return finish(streams.start_ingest(raw, place.store, trigger=ONCE, checkpoint=f"{place.checkpoint}/{checkpoint}", clock=lambda: NOW))


def test_replays_under_a_new_checkpoint_store_nothing_again(spark, place):
    dump(spark, place.topic, ingest_values())
    dump(spark, place.topic, [tick(9), tick(10, price="bad")], first_offset=8)  # 6 and 7 are missing
    run_ingest(spark, place, "a")
    run_ingest(spark, place, "b")
    bronze, errors = place.store.read("bronze.ticker_raw"), place.store.read("bronze.error_log")
    assert bronze.count() == 4 and bronze.select("id").distinct().count() == 4 and errors.count() == 4
    dump(spark, place.topic, [tick(11), tick(12), tick(13)], first_offset=6)  # the gap, and 8 once more
    run_ingest(spark, place, "c")
    assert place.store.read("bronze.ticker_raw").count() == 6
    ledger = Ledger(place.store, "ingest").stored()
    assert [tuple(r) for r in ledger.collect()] == [("ticker", 0, 0, 9)]


def test_replayed_dead_letters_are_logged_once(spark, place):
    letters = [json.dumps({"error_type": "validation_error", "payload": n}) for n in range(5)]
    for first in (0, 5):
        dump(spark, place.topic, letters, topic="ticker-dlq", first_offset=first)
    for checkpoint in ("a", "b"):
        raw = read_topic_dump(spark, place.topic, max_files=1)
        finish(streams.start_dlq(raw, place.store, trigger=ONCE, checkpoint=f"{place.checkpoint}/{checkpoint}", clock=lambda: NOW))
    assert sorted(r.kafka_offset for r in place.store.read("bronze.error_log").collect()) == list(range(10))


def test_replayed_silver_rows_are_stored_once(spark, place):
    dump(spark, place.topic, [*ingest_values(), tick(7, symbol="X" * 21)])
    for checkpoint in ("a", "b"):
        raw = read_topic_dump(spark, place.topic)
        finish(streams.start_silver(raw, place.store, trigger=ONCE, checkpoint=f"{place.checkpoint}/{checkpoint}", clock=lambda: NOW))
    assert place.store.read("silver.ticker").count() == 3 and place.store.read("bronze.error_log").count() == 4


def test_batch_that_broke_off_before_its_note_is_stored_once(spark, place, monkeypatch):
    dump(spark, place.topic, ingest_values())
    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "note", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            run_ingest(spark, place, "a")
    assert place.store.read("bronze.ticker_raw").count() == 3
    run_ingest(spark, place, "a")
    run_ingest(spark, place, "b")
    assert place.store.read("bronze.ticker_raw").count() == 3 and place.store.read("bronze.error_log").count() == 3


def test_two_ingest_streams_at_once_store_each_position_once(spark, place):
    for n in range(4):
        dump(spark, place.topic, [tick(m) for m in range(5)], first_offset=5 * n)

    def start(checkpoint):
        raw = read_topic_dump(spark, place.topic, max_files=1)
        return streams.start_ingest(raw, place.store, trigger=ONCE, checkpoint=f"{place.checkpoint}/{checkpoint}", clock=lambda: NOW)

    # Stream names are unique in a session, so the second gets another session on the same store.
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    second = streams.start_ingest(
        read_topic_dump(other, place.topic, max_files=1), Store(other, place.store.root), trigger=ONCE, checkpoint=f"{place.checkpoint}/b", clock=lambda: NOW
    )
    first = start("a")
    finish(first)
    finish(second)
    ids = [r.id for r in place.store.read("bronze.ticker_raw").collect()]
    assert len(ids) == 20 and len(set(ids)) == 20


def run_tracked(spark, place, checkpoint="t", files=None):
    raw = read_topic_dump(spark, place.topic, max_files=files)
    options = {"trigger": ONCE, "checkpoint": f"{place.checkpoint}/{checkpoint}", "clock": lambda: NOW}
    return finish(streams.start_tracked_windows(raw, place.store, **options))


def tracked(place):
    """Closed windows, ticks in open ones, logged late ticks."""
    late = place.store.read("bronze.error_log").filter("error_type = 'late_tick'")
    return starts(place.store.read("gold.window_aggregations")), sum(r.record_count for r in streams.open_windows(place.store).collect()), sorted(r.kafka_offset for r in late.collect())


def test_every_tick_is_in_a_window_or_in_the_log(spark, place):
    dump(spark, place.topic, [tick(m) for m in range(0, 50, 5)])
    run_tracked(spark, place)
    # The same windows as the query with its own watermark closes.
    assert tracked(place) == (["00:00", "00:05", "00:10", "00:15", "00:20", "00:25", "00:30"], 3, [])
    dump(spark, place.topic, [tick(5), tick(36, price="12"), tick(34), tick(120), tick(33, symbol="ETH")], first_offset=10)
    run_tracked(spark, place)
    closed, still, late = tracked(place)
    assert closed[7:] == ["00:35", "00:40", "00:45"] and still == 1 and late == [10, 12, 14]
    counted = place.store.read("gold.window_aggregations").agg(F.sum("record_count")).first()[0]
    assert counted + still + len(late) == 15
    logged = place.store.read("bronze.error_log").filter("kafka_offset = 14").first()
    assert (logged.source, logged.kafka_topic, logged.kafka_partition) == ("window", "ticker", 0) and json.loads(logged.raw_payload)["symbol"] == "ETH"
    window = place.store.read("gold.window_aggregations").filter(F.minute("window_start") == 35).first()
    assert (window.record_count, float(window.avg_price), float(window.max_price)) == (2, 11.0, 12.0)
    run_tracked(spark, place)
    run_tracked(spark, place, "another")
    assert tracked(place) == (closed, still, late)


def test_tracked_windows_equal_one_pass_over_all_ticks(spark, place):
    """Six batches in order of time: nothing is late, and closed and open states together are the batch result."""
    for n in range(6):
        dump(spark, place.topic, [tick(10 * n + m, symbol=s, price=str(m + 1)) for m in range(10) for s in ("A", "B")], first_offset=20 * n)
    run_tracked(spark, place, files=1)
    facts = ["symbol", "window_start", "avg_price", "max_price", "min_price", "total_volume", "avg_price_change_pct", "record_count"]
    both = place.store.read("gold.window_aggregations").select(facts).unionByName(gold.finish_windows(streams.open_windows(place.store), NOW).select(facts))
    whole = gold.window_summary(silver.to_silver(bronze_of(spark, place), NOW), computed_at=F.lit(None)).select(facts)
    assert sorted(map(str, both.collect())) == sorted(map(str, whole.collect()))


def test_tracked_batch_that_broke_off_is_counted_once(spark, place, monkeypatch):
    dump(spark, place.topic, [tick(m) for m in range(0, 50, 5)])
    for broken in ((Store, "mark"), (Ledger, "note")):
        with monkeypatch.context() as patch:
            real = getattr(*broken)

            def lost(self, *args, real=real, what=broken[1]):
                if what == "note" or args[0] == "window_state":
                    raise OSError("lost")
                return real(self, *args)

            patch.setattr(*broken, lost)
            with pytest.raises(Exception, match="lost"):
                run_tracked(spark, place)
    run_tracked(spark, place)
    assert tracked(place) == (["00:00", "00:05", "00:10", "00:15", "00:20", "00:25", "00:30"], 3, [])


def test_tallies_of_all_batches_add_up(spark, place):
    dump(spark, place.topic, ingest_values())
    dump(spark, place.topic, [tick(9), tick(10, price="bad")], first_offset=6)
    for checkpoint in ("a", "a", "b"):
        run_ingest(spark, place, checkpoint)
    stored = place.store.read("gold.ingest_tallies").agg(F.sum("total"), F.sum("rejected"), F.sum("sent")).first()
    from tickloom.operators import bronze as ingest

    expected = ingest.ingest_tallies(streams.checked_records(spark.read.schema(RAW_SCHEMA).parquet(place.topic))).first()
    assert tuple(stored) == tuple(expected) and place.store.read("gold.ingest_tallies").count() == 2
    dump(spark, place.topic, [tick(9), tick(11)], first_offset=7)
    run_ingest(spark, place, "c")
    last = place.store.read("gold.ingest_tallies").orderBy(F.desc("repeated")).first()
    assert (last.total, last.sent) == (1, 1) and last.repeated >= 1


def test_run_until_any_stops_returns_when_one_does(spark, place):
    dump(spark, place.topic, ingest_values())
    raw = read_topic_dump(spark, place.topic)
    spark.streams.resetTerminated()
    waiting = streams.start_silver(raw, place.store, trigger={"processingTime": "1 hour"}, checkpoint=place.checkpoint)
    try:
        deadline = time.monotonic() + 60
        while waiting.lastProgress is None and time.monotonic() < deadline:
            time.sleep(0.2)
        ending = streams.start_ingest(raw, place.store, trigger=ONCE, checkpoint=place.checkpoint)
        streams.run_until_any_stops(spark)
        assert not ending.isActive and waiting.isActive
    finally:
        waiting.stop()
        spark.streams.resetTerminated()


def test_broken_landing_lines_are_logged_and_never_sent(spark, place, tmp_path):
    from pathlib import Path

    from tickloom.sources.topics import read_landing_lines

    landing, sent = tmp_path / "landing", []
    landing.mkdir()
    lines = [tick(0), tick(1)[:25], "", "  ", tick(2) + tick(3), '["x"]', '{"symbol":"A","count":"many"}', "null", '{"lastPrice":"1"}', tick(4, symbol="ETH")]
    (landing / "one.json").write_text("\n".join(lines) + "\n")
    (landing / "two.json").write_text(tick(5, symbol="ADA"))

    def run():
        finish(
            streams.start_landing(
                read_landing_lines(spark, str(landing)),
                place.store,
                lambda d, n: sent.extend(bytes(r.key).decode() for r in d.collect()),
                trigger=ONCE,
                checkpoint=place.checkpoint,
                clock=lambda: NOW,
            )
        )

    run()
    refused = place.store.read("bronze.error_log").collect()
    assert sorted(sent) == ["", "ADA", "BTC", "ETH"]  # "" is the default of a ticker without symbol, not of a broken line
    assert {r.error_type for r in refused} == {"landing_parse_error"} and len(refused) + len(sent) == 9
    assert all(Path(r.error_message.split(": ")[1].split(" from byte ")[0].removeprefix("file:")).name == "one.json" for r in refused)
    run()
    assert len(sent) == 4 and place.store.read("bronze.error_log").count() == 5


def test_cut_off_snapshot_files_are_rejects(spark, tmp_path):
    from tickloom.sources.decode import decode_snapshots, snapshot_rejects
    from tickloom.sources.topics import read_snapshot_files, read_snapshots

    whole = json.dumps({"fetched_at": "t", "count": 2, "tickers": [json.loads(tick(0)), json.loads(tick(1))]}, indent=1)
    for name, text in {"a": whole, "b": whole[:150], "c": whole + "]", "d": "[]", "e": '{"fetched_at":"t","count":0}', "f": '{"tickers":[]}', "g": ""}.items():
        (tmp_path / f"{name}.json").write_text(text)
    assert read_snapshots(spark, str(tmp_path)).count() == 2
    rejects = snapshot_rejects(decode_snapshots(read_snapshot_files(spark, str(tmp_path))), NOW).collect()
    names = sorted(r.error_message.split(".json")[0][-1] for r in rejects)
    assert names[:4] == ["b", "c", "d", "e"] and set(names) <= set("bcdeg")


@pytest.mark.parametrize("value", ['{"symbol":"A","count":1.5}', '{"symbol":"A","openTime":"x"}', '{"symbol":["A"]', "5", '"text"', "null", "", "{} {}", '{"symbol":"A"}}', '{"a":1},"value":{}'])
def test_values_that_are_no_ticker_are_refused_in_one_parse(spark, place, value):
    dump(spark, place.topic, [value])
    records = streams.checked_records(spark.read.schema(RAW_SCHEMA).parquet(place.topic))
    assert [r.error_type for r in records.collect()] == ["decode_error"]
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "json_array_length" not in plan
