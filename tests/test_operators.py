"""Hand-written rows for the rules a table comparison does not reach."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tickloom.functions.casts import blank_to_null, epoch_ms, instant, to_decimal, utc_text
from tickloom.operators import bronze as ingest
from tickloom.operators import gold, merge, panels, quality, silver
from tickloom.schemas import (
    BRONZE_SCHEMA,
    ERROR_LOG_SCHEMA,
    HOURLY_SCHEMA,
    LATEST_SCHEMA,
    PERCENT,
    PRICE,
    RAW_SCHEMA,
    SILVER_SCHEMA,
    TICKER_SCHEMA,
)
from tickloom.sources import adapters, decode

NOON = datetime(2024, 1, 1, 12, 0)


def frame(spark, schema, *rows):
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def bronze(spark, *rows):
    base = {"symbol": "A", "last_price": "1", "volume": "1", "ingested_at": NOON}
    return frame(spark, BRONZE_SCHEMA, *[{**base, "id": n + 1, **r} for n, r in enumerate(rows)])


def typed(spark, *rows):
    base = {"symbol": "A", "last_price": Decimal(1), "volume": Decimal(1), "transformed_at": NOON}
    return frame(spark, SILVER_SCHEMA, *[{**base, **r} for r in rows])


def raw(spark, *values):
    records = [{"value": v if v is None or isinstance(v, bytes) else v.encode(), "topic": "t", "partition": 0, "offset": n, "timestamp": NOON} for n, v in enumerate(values)]
    return frame(spark, RAW_SCHEMA, *records)


def reasons(spark, *values):
    checked = ingest.with_reject_reason(decode.decode_json(raw(spark, *values)))
    return [(r.error_type, r.error_message) for r in checked.orderBy("offset").collect()]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1.123456785", "1.12345679"),
        ("-1.123456785", "-1.12345679"),
        ("9999999999999", None),
        ("NaN", None),
        ("inf", None),
        ("1_000", None),
        (" 1 ", "1.00000000"),
        ("1e5", "100000.00000000"),
        ("", None),
        (None, None),
        ("abc", None),
    ],
)
def test_text_to_decimal(spark, text, expected):
    value = spark.createDataFrame([(text,)], "x string").select(to_decimal(F.col("x"), PRICE)).first()[0]
    assert value == (None if expected is None else Decimal(expected))


def test_times(spark):
    row = spark.range(1).select(
        epoch_ms(F.lit(1704067207179)).alias("ms"),
        utc_text(instant("2024-01-30 23:00:00")).alias("text"),
        instant(datetime(2024, 1, 1, 1, 2, 3, 4)).alias("clock"),
        blank_to_null(F.lit(" ")).alias("space"),
    ).first()
    assert row.ms == datetime(2024, 1, 1, 0, 0, 7, 179000)
    assert (row.text, row.clock, row.space) == ("2024-01-30T23:00:00Z", datetime(2024, 1, 1, 1, 2, 3, 4), " ")


def test_reject_order_and_messages(spark):
    good = '{"symbol":"A","lastPrice":"1","volume":"2"}'
    assert reasons(
        spark,
        good,
        '{"symbol":null,"lastPrice":"","volume":"1"}',
        '{"symbol":"A","lastPrice":"","volume":""}',
        '{"symbol":"A","lastPrice":"0","volume":"0"}',
        '{"symbol":"A","lastPrice":"abc","volume":"x"}',
        '{"symbol":"A","lastPrice":"1","volume":"x"}',
        '{"symbol":"A","lastPrice":1.50,"volume":2}',
        "{}",
        '{"symbol":"A"',
        "plain text",
        '{"symbol":"A","lastPrice":"1","volume":"2","count":"many"}',
        None,
        b"\x00\x00\x00\x00\x07\x06ABC",
    ) == [
        (None, None),
        ("validation_error", "Missing required field: 'symbol'"),
        ("validation_error", "Missing required field: 'lastPrice'"),
        (None, None),
        ("validation_error", "Non-numeric price/volume: could not convert string to float: 'abc'"),
        ("validation_error", "Non-numeric price/volume: could not convert string to float: 'x'"),
        (None, None),
        ("validation_error", "Missing required field: 'symbol'"),
        *[("decode_error", "Value could not be decoded")] * 5,
    ]


def test_json_number_becomes_text(spark):
    row = decode.decode_json(raw(spark, '{"symbol":"A","lastPrice":1.50}')).first()
    assert (row.lastPrice, row.decode_ok) == ("1.5", True)


def test_parse_runs_once_per_row(spark):
    """Filters on decoded fields must not carry copies of the parse along."""
    checked = ingest.with_reject_reason(decode.decode_json(raw(spark, "{}")))
    plan = ingest.valid(checked)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_defaults_only_for_absent_required_fields(spark):
    d = frame(spark, TICKER_SCHEMA, {"lastPrice": ""})
    row = ingest.normalize_ticker(d).first()
    assert (row.symbol, row.lastPrice, row.volume, row.bidPrice) == ("", "", "0", None)


def test_registry_frame_is_split_off(spark):
    rows = decode.unframe(raw(spark, b"\x00\x00\x00\x01\x02body", b"{}", b"\x01\x00\x00\x00\x01x", None)).orderBy("offset").collect()
    assert [(r.schema_id, r.body and bytes(r.body)) for r in rows] == [(258, b"body"), (None, None), (None, None), (None, None)]


def test_frame_round_trip(spark):
    d = raw(spark, b"body").withColumn("value", ingest.framed(F.col("value"), 70_000))
    row = decode.unframe(d).first()
    assert (row.schema_id, bytes(row.body)) == (70_000, b"body")


def test_values_of_another_schema_have_no_body(spark):
    d = raw(spark, b"a", b"b", b"c").withColumn("value", F.when(F.col("offset") == 2, F.col("value")).otherwise(ingest.framed(F.col("value"), 7)))
    d = d.withColumn("value", F.when(F.col("offset") == 1, ingest.framed(F.lit(b"b"), 8)).otherwise(F.col("value")))
    found = decode.unframe(d, 7).orderBy("offset").collect()
    assert [(r.schema_id, r.body and bytes(r.body)) for r in found] == [(7, b"a"), (8, None), (None, None)]


def test_avro_failures_have_their_own_type(spark):
    d = decode.decode_json(raw(spark, "?"))
    log = ingest.to_error_log(ingest.rejected(ingest.with_reject_reason(d, "avro")), "consumer", NOON)
    assert log.first().error_type == "avro_deserialization_error"
    letter = json.loads(bytes(ingest.to_dlq_payload(log).first().value))
    assert (letter["error_type"], letter["payload"], letter["offset"]) == ("avro_deserialization_error", "Pw==", 0)


def test_mean_is_rounded_once(spark):
    """2,000,001 values whose mean lies just below a half of the last digit."""
    low = spark.range(1_000_001).select(F.lit("0.0000").cast("decimal(10,4)").alias("x"))
    high = spark.range(1_000_000).select(F.lit("0.0001").cast("decimal(10,4)").alias("x"))
    assert low.unionAll(high).agg(gold.average("x", PERCENT)).first()[0] == Decimal("0.0000")
    assert low.limit(0).agg(gold.average("x", PERCENT)).first()[0] is None


def test_snapshot_documents(spark, tmp_path):
    from tickloom.sources.topics import read_snapshots, write_snapshot

    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "one.json").write_text(
        '{\n "fetched_at": "2024-01-01T00:00:00Z",\n "count": 2,\n "tickers": [{"symbol": "A"}, {"symbol": "B", "count": 3}]\n}'
    )
    tickers = read_snapshots(spark, str(tmp_path / "docs"))
    assert [(r.symbol, r["count"]) for r in tickers.orderBy("symbol").collect()] == [("A", None), ("B", 3)]
    out = str(tmp_path / "out")
    write_snapshot(tickers.drop("fetched_at"), out, "2024-01-01 00:00:00")
    header = spark.read.json(f"{out}/header").first()
    assert (header.fetched_at, header["count"]) == ("2024-01-01T00:00:00Z", 2)
    assert spark.read.json(f"{out}/tickers").count() == 2


def test_silver_and_rejects_are_complements(spark):
    d = bronze(
        spark,
        {"high_price": ""},
        {"high_price": "abc"},
        {"last_price": "abc"},
        {"last_price": "9999999999999"},
        {"volume": ""},
        {"symbol": None, "last_price": "abc"},
        {"symbol": "S" * 21},
        {"symbol": "S" * 20},
    )
    good = {r.id: r for r in silver.to_silver(d, NOON).collect()}
    assert set(good) == {1, 2, 8}
    assert good[1].high_price is None and good[2].high_price is None
    bad = [(r.error_type, r.error_message) for r in silver.silver_rejects(d, NOON).orderBy(F.get_json_object("raw_payload", "$.id")).collect()]
    assert bad == [
        ("cast_error", "Cannot cast last_price to DECIMAL(20,8): 'abc'"),
        ("cast_error", "Cannot cast last_price to DECIMAL(20,8): '9999999999999'"),
        ("validation_error", "Missing required field: 'volume'"),
        ("validation_error", "Missing required field: 'symbol'"),
        ("cast_error", f"symbol is longer than 20 characters: '{'S' * 21}'"),
    ]
    failures = {r.column_name: r.failures for r in silver.cast_failures(d).collect()}
    assert failures["high_price"] == 1 and failures["last_price"] == 3 and failures["volume"] == 0


def test_watermark(spark):
    assert silver.next_watermark(bronze(spark)).first().id == 0
    d = bronze(spark, {}, {}, {})
    assert silver.next_watermark(d).first().id == 3
    assert [r.id for r in silver.incremental(d, 2).collect()] == [3]
    assert [r.id for r in silver.incremental_from(d, d.filter("id < 2").select("id")).collect()] == [2, 3]
    assert silver.incremental_from(d, d.filter("id < 0").select("id")).count() == 3


def test_latest_breaks_ties_by_id_and_keeps_nulls(spark):
    d = typed(
        spark,
        {"id": 6, "last_price": Decimal(6)},
        {"id": 5, "last_price": Decimal(5), "open_price": Decimal(1)},
        {"id": 9, "last_price": Decimal(9), "transformed_at": datetime(2024, 1, 1, 11)},
    )
    row = gold.latest_prices(d).first()
    assert (row.last_price, row.open_price) == (6, None)


def test_refresh_equals_recompute_and_ignores_older_rows(spark):
    early = typed(spark, {"id": 1, "last_price": Decimal(1)}, {"id": 2, "symbol": "B"})
    late = typed(
        spark,
        {"id": 3, "last_price": Decimal(3), "transformed_at": datetime(2024, 1, 1, 10)},
        {"id": 4, "symbol": "B", "last_price": Decimal(4)},
        {"id": 5, "symbol": "C"},
    )
    refreshed = gold.refresh_latest(gold.latest_prices(early), late)
    full = gold.latest_prices(early.unionByName(late))
    assert sorted(refreshed.collect()) == sorted(full.collect())
    assert {r.symbol: r.last_price for r in refreshed.collect()} == {"A": 1, "B": 4, "C": 1}


def latest(spark, *rows):
    return frame(spark, LATEST_SCHEMA, *rows)


def test_boards(spark):
    d = latest(spark, *[{"symbol": f"S{n:02}", "price_change_pct": Decimal(n // 2), "quote_volume": Decimal(n)} for n in range(30)], {"symbol": "N"})
    gainers = gold.top_gainers(d, NOON).orderBy("rank").collect()
    assert len(gainers) == 20
    assert [(r.rank, r.symbol) for r in gainers[:3]] == [(1, "S28"), (2, "S29"), (3, "S26")]
    losers = gold.top_losers(d, NOON).orderBy("rank").collect()
    assert [(r.rank, r.symbol) for r in losers[:2]] == [(1, "S00"), (2, "S01")]
    assert gold.volume_leaders(d, NOON).orderBy("rank").first().symbol == "S29"
    assert gold.top_gainers(latest(spark, {"symbol": "A", "price_change_pct": Decimal(1)}), NOON).count() == 1


def test_board_limit_sits_below_the_ranking(spark):
    plan = gold.top_gainers(latest(spark, {"symbol": "A"}), NOON)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window [") < plan.index("TakeOrderedAndProject")


def test_hourly_bounds(spark):
    times = [datetime(2024, 1, 1, 12, 0), datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 9, 59, 59), datetime(2024, 1, 1, 11, 59, 59)]
    d = typed(spark, *[{"id": n, "transformed_at": t} for n, t in enumerate(times)])
    hours = gold.hourly_summary(d, datetime(2024, 1, 1, 12, 30)).collect()
    assert sorted((r.hour.hour, r.record_count) for r in hours) == [(10, 1), (11, 1)]
    assert gold.hourly_summary(d, datetime(2024, 1, 1, 12, 0)).count() == 2


def hour(symbol, **more):
    return {"symbol": symbol, "hour": NOON, "created_at": NOON, **more}


def test_hourly_upsert_rules(spark):
    old = frame(
        spark,
        HOURLY_SCHEMA,
        hour("A", high_price=Decimal(1)),
        hour("B", high_price=Decimal(3), open_price=Decimal(7), close_price=Decimal(1), record_count=1),
        hour("D", open_price=None, close_price=Decimal(5)),
    )
    new = frame(
        spark,
        HOURLY_SCHEMA,
        hour("B", high_price=Decimal(2), low_price=Decimal(4), open_price=Decimal(1), record_count=2),
        hour("C", close_price=Decimal(9)),
        hour("D", open_price=Decimal(2), close_price=None),
    )
    merged = {r.symbol: r for r in merge.upsert(old, new, merge.HOURLY_KEYS, merge.HOURLY_RULES).collect()}
    assert set(merged) == {"A", "B", "C", "D"}
    assert merged["A"].high_price == 1
    b = merged["B"]
    assert (b.high_price, b.low_price, b.open_price, b.close_price, b.record_count) == (3, 4, 7, None, 2)
    assert (merged["C"].high_price, merged["C"].close_price) == (None, 9)
    assert (merged["D"].open_price, merged["D"].close_price) == (None, None)


def test_upsert_refuses_unknown_rules(spark):
    d = frame(spark, HOURLY_SCHEMA)
    with pytest.raises(ValueError, match="median"):
        merge.upsert(d, d, merge.HOURLY_KEYS, {"open_price": "median"})


def test_insert_absent(spark):
    schema = "k int, v string"
    target = spark.createDataFrame([(1, "old")], schema)
    source = spark.createDataFrame([(1, "new"), (2, "x"), (2, "x")], schema)
    assert merge.insert_absent(target, source, ["k"]).collect() == [Row(k=2, v="x")]


def errors(spark, count, when=NOON):
    one = frame(spark, ERROR_LOG_SCHEMA, {"source": "consumer", "error_type": "t", "occurred_at": when})
    return one.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(count)))).drop("n")


def gates(spark, log, silver_rows=None, latest_rows=None):
    rows = quality.quality_gates(
        bronze(spark, {}),
        silver_rows if silver_rows is not None else typed(spark, {}),
        latest_rows if latest_rows is not None else latest(spark, {"symbol": "A"}),
        log,
        NOON,
    )
    return {r.gate: r.passed for r in rows.collect()}


def test_gates(spark):
    assert all(gates(spark, errors(spark, 100)).values())
    assert gates(spark, errors(spark, 101))["recent_errors"] is False
    assert gates(spark, errors(spark, 101, datetime(2024, 1, 1, 11, 49, 59)))["recent_errors"] is True
    bad = gates(spark, errors(spark, 1), typed(spark, {"symbol": None}), latest(spark))
    assert (bad["silver_null_symbols"], bad["silver_rows"], bad["gold_filled"]) == (False, True, False)
    none = gates(spark, errors(spark, 1), typed(spark, {"transformed_at": datetime(2024, 1, 1, 11, 0)}))
    assert none["silver_rows"] is False


def test_bands_at_their_bounds(spark):
    d = spark.createDataFrame([(Decimal(v),) for v in ("-2.0001", "-2", "-0.0001", "0", "1.9999", "2")] + [(None,)], "p decimal(10,4)")
    bands = d.select(*[panels.change_band(F.col("p"), b) for b in (panels.GAINER_BANDS, panels.LOSER_BANDS, panels.LEADER_BANDS)])
    assert [tuple(r) for r in bands.collect()] == [
        ("yellow", "red", "red"),
        ("yellow", "yellow", "red"),
        ("yellow", "yellow", "red"),
        ("yellow", "yellow", "yellow"),
        ("yellow", "yellow", "yellow"),
        ("green", "yellow", "green"),
        (None, None, None),
    ]


def test_publish_keeps_or_explains_every_row(spark):
    d = frame(spark, TICKER_SCHEMA, {"symbol": "A", "lastPrice": "", "volume": "1"}, {"symbol": "B", "lastPrice": "1"})
    sent, refused = ingest.publish_payload(d).collect(), ingest.publish_rejects(d, NOON).collect()
    assert [bytes(r.key) for r in sent] == [b"A"]
    assert [(r.source, r.error_type, r.error_message) for r in refused] == [("producer", "encode_error", "Null in required field: 'volume'")]


def test_scans_get_literal_ranges_and_few_columns(spark, sf_dir, tmp_path, capsys):
    from tickloom.plans.queries import Feed

    path = str(tmp_path / "silver")
    Feed(spark, sf_dir).silver.write.parquet(path)
    stored = spark.read.schema(SILVER_SCHEMA).parquet(path)

    def scan(d):
        capsys.readouterr()
        d.explain("formatted")
        lines = capsys.readouterr().out.splitlines()
        return "\n".join(line for line in lines if line.startswith(("PushedFilters", "ReadSchema")))

    hourly = scan(gold.hourly_summary(stored, "2024-01-30 23:00:00"))
    assert "GreaterThanOrEqual(transformed_at" in hourly and "LessThan(transformed_at" in hourly
    assert "bid_price" not in hourly
    assert "GreaterThan(id,5)" in scan(silver.incremental(stored, 5))
    counted = scan(quality.recent_bronze(stored.withColumnRenamed("bronze_ingested_at", "ingested_at"), NOON))
    assert "last_price" not in counted


def test_every_number_fails_to_fit_somewhere_in_the_given_events(spark, sf_dir):
    ticks = adapters.events_to_bronze(spark.read.parquet(f"{sf_dir}/events.parquet"))
    failures = {r.column_name: r.failures for r in silver.cast_failures(ticks).collect()}
    assert len(failures) == 13 and min(failures.values()) > 0
