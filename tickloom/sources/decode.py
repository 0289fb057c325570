"""Decoders from topic records and snapshot documents to wire tickers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from tickloom.functions.casts import base64_text, computed_once, guard_word, guarded, instant
from tickloom.operators.bronze import LANDING_ERROR, SNAPSHOT_ERROR, error_rows
from tickloom.schemas import SNAPSHOT_SCHEMA, TICKER_SCHEMA, WIRE_COLUMNS, avro_contract

# Fixed values of the registry framing: one zero byte, then a 4-byte schema id.
FRAME_BYTES = 5
CORRUPT = "_unparsed"
RECORD_COLUMNS = ["kafka_timestamp", "topic", "partition", "offset", "raw_value"]


def _record(parsed: DataFrame, ok: Column) -> DataFrame:
    return parsed.select(
        F.col("timestamp").alias("kafka_timestamp"),
        "topic",
        "partition",
        "offset",
        F.col("value").alias("raw_value"),
        "data",
        ok.alias("decode_ok"),
    ).select(*RECORD_COLUMNS, "data.*", "decode_ok")


def parse_strictly(d: DataFrame, text: Column, schema: StructType, where: Column | None = None) -> DataFrame:
    """Adds ``data`` (a struct) and ``decode_ok``: whether the text is one JSON object of these types and nothing else.

    One parse per row; only rows of ``where``, if given. ``data`` is NULL where the text is refused.
    """
    guard = guard_word()
    checked = StructType([StructField(guard, MapType(StringType(), schema)), StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = computed_once(d, "_parsed", F.from_json(guarded(text, guard), checked, options), where)
    members, value = F.col(f"_parsed.`{guard}`"), F.col(f"_parsed.`{guard}`").getItem("value")
    whole = (F.size(members) == 2) & F.map_contains_key(members, guard) & F.col(f"_parsed.{CORRUPT}").isNull()
    ok = F.coalesce(whole & value.isNotNull(), F.lit(False))
    return parsed.withColumns({"decode_ok": ok, "data": F.when(ok, value)}).drop("_parsed")


def decode_json(raw: DataFrame, schema: StructType = TICKER_SCHEMA) -> DataFrame:
    """JSON values to wire columns; ``decode_ok`` is false for null, malformed or mistyped values, and for
    values with anything behind them."""
    parsed = parse_strictly(raw, F.col("value").cast("string"), schema)
    return _record(parsed, F.col("decode_ok"))


def unframe(raw: DataFrame, schema_id: int | None = None) -> DataFrame:
    """Split the registry frame off binary values: adds ``schema_id`` and ``body``.

    Both are NULL if the value isn't framed; with ``schema_id`` the body of another schema's value is NULL too,
    as its bytes mean something else.
    """
    framed = (F.length("value") > FRAME_BYTES) & (F.hex(F.substring("value", 1, 1)) == "00")
    found = F.when(framed, F.conv(F.hex(F.substring("value", 2, 4)), 16, 10).cast("int"))
    body = F.when(framed, F.expr(f"substring(value, {FRAME_BYTES + 1})"))
    own = body if schema_id is None else F.when(F.col("schema_id") == schema_id, body)
    return raw.withColumn("schema_id", found).withColumn("body", own)


def decode_avro(raw: DataFrame, schema_json: str | None = None, schema_id: int | None = None) -> DataFrame:
    """Framed Avro values to wire columns; ``schema_id`` is the registry's id of the schema, all others are refused.

    Needs the spark-avro package on the session's class path.
    """
    from pyspark.sql.avro.functions import from_avro

    staged = unframe(raw, schema_id)
    parsed = from_avro(F.col("body"), schema_json or avro_contract(), {"mode": "PERMISSIVE"})
    # A permissive failure comes back as a null record or one without its required fields.
    ok = F.col("data").isNotNull() & F.col("data.symbol").isNotNull()
    return _record(computed_once(staged, "data", parsed), ok)


DECODERS = {"json": decode_json, "avro": decode_avro}


def decode(raw: DataFrame, fmt: str = "json") -> DataFrame:
    return DECODERS[fmt](raw)


def decode_landing(lines: DataFrame) -> DataFrame:
    """Landed lines (``value``, and where they lie: ``path``, ``position``) with their ticker and ``decode_ok``.

    Empty lines are no lines.
    """
    parsed = parse_strictly(lines, F.col("value"), TICKER_SCHEMA, F.trim("value") != "")
    return parsed.select("path", "position", "value", "decode_ok", "data.*")


def landed(decoded: DataFrame) -> DataFrame:
    """The tickers of decoded lines."""
    return decoded.filter("decode_ok").select(*WIRE_COLUMNS)


def landing_rejects(decoded: DataFrame, occurred_at) -> DataFrame:
    """Lines that are no ticker as error-log rows."""
    return _file_rejects(decoded, LANDING_ERROR, "Line is not a ticker object", occurred_at)


def _file_rejects(decoded: DataFrame, error_type: str, message: str, occurred_at) -> DataFrame:
    where = F.concat(F.lit(f"{message}: "), F.col("path"), F.lit(" from byte "), F.col("position").cast("string"))
    return error_rows(
        decoded.filter(~F.col("decode_ok")),
        source=F.lit("producer"),
        error_type=F.lit(error_type),
        error_message=where,
        raw_payload=base64_text(F.col("value").cast("binary")),
        occurred_at=instant(occurred_at),
    )


def decode_snapshots(documents: DataFrame) -> DataFrame:
    """Snapshot documents (``value``, ``path``, ``position``) with ``decode_ok``: one whole document that holds a list of tickers."""
    parsed = parse_strictly(documents, F.col("value").cast("string"), SNAPSHOT_SCHEMA)
    whole = F.col("decode_ok") & F.col("data.tickers").isNotNull()
    return parsed.withColumn("decode_ok", whole).select("path", "position", "value", "decode_ok", "data.*")


def snapshot_rejects(decoded: DataFrame, occurred_at) -> DataFrame:
    """Documents that are no snapshot as error-log rows."""
    return _file_rejects(decoded, SNAPSHOT_ERROR, "File is not a snapshot document", occurred_at)


def parse_snapshot(documents: DataFrame, text: str = "value") -> DataFrame:
    """Snapshot documents held as JSON text to ``fetched_at, count, tickers``; see ``decode_snapshots`` for refused ones."""
    parsed = F.from_json(F.col(text).cast("string"), SNAPSHOT_SCHEMA)
    return computed_once(documents, "doc", parsed).select("doc.*")


def explode_snapshot(doc: DataFrame) -> DataFrame:
    """One row per ticker of each snapshot document."""
    return doc.select("fetched_at", F.explode("tickers").alias("ticker")).select(
        "fetched_at", *[F.col(f"ticker.{c}").alias(c) for c in WIRE_COLUMNS]
    )
