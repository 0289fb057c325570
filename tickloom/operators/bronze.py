"""Wire tickers to Bronze rows, error-log rows and outgoing messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.casts import base64_text, computed_once, guard_word, guarded, instant, utc_text
from tickloom.functions.validation import first_match, missing, non_numeric
from tickloom.schemas import (
    DECIMAL_COLUMNS,
    ERROR_LOG_SCHEMA,
    REQUIRED_WIRE_FIELDS,
    TICKER_FIELDS,
    WIRE_COLUMNS,
    avro_contract,
)

DECODE_ERROR = "decode_error"
AVRO_DECODE_ERROR = "avro_deserialization_error"
DECODE_ERRORS = {"json": DECODE_ERROR, "avro": AVRO_DECODE_ERROR}
VALIDATION_ERROR = "validation_error"
ENCODE_ERROR = "encode_error"
DLQ_PARSE_ERROR = "dlq_parse_error"
LATE_TICK = "late_tick"
LANDING_ERROR = "landing_parse_error"
SNAPSHOT_ERROR = "snapshot_parse_error"

# What a required field becomes when the feed leaves it out.
WIRE_DEFAULTS = {"symbol": "", "lastPrice": "0", "volume": "0"}
UNKNOWN = "unknown"


def normalize_ticker(d: DataFrame) -> DataFrame:
    """The 17 wire columns with defaults for absent required fields (absent and null look alike here)."""
    return d.select(
        *[
            F.coalesce(F.col(c), F.lit(WIRE_DEFAULTS[c])).alias(c) if c in WIRE_DEFAULTS else F.col(c)
            for c in WIRE_COLUMNS
        ]
    )


def wire_json() -> Column:
    """The wire columns as one JSON object, nulls kept."""
    return F.to_json(F.struct(*WIRE_COLUMNS), {"ignoreNullFields": "false"})


def with_reject_reason(d: DataFrame, fmt: str = "json") -> DataFrame:
    """Adds ``error_type`` and ``error_message`` (both NULL for a valid record).

    Rules are tried in order: decoding, then symbol, lastPrice and volume being
    present, then lastPrice and volume being numbers that fit their column.
    """
    undecoded = ~F.col("decode_ok")
    rules = [missing(c) for c in REQUIRED_WIRE_FIELDS]
    rules += [non_numeric("lastPrice", DECIMAL_COLUMNS["last_price"]), non_numeric("volume", DECIMAL_COLUMNS["volume"])]
    message = first_match([(undecoded, F.lit("Value could not be decoded")), *rules])
    return d.withColumn("error_message", message).withColumn(
        "error_type",
        F.when(undecoded, DECODE_ERRORS[fmt]).when(F.col("error_message").isNotNull(), VALIDATION_ERROR),
    )


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("error_type").isNull())


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("error_type").isNotNull())


def to_bronze(d: DataFrame, ingested_at, record_id: Column | None = None) -> DataFrame:
    """Valid wire rows as Bronze rows."""
    columns = [F.col(wire).alias(table) for wire, table, _ in TICKER_FIELDS]
    key = F.lit(None).cast("long") if record_id is None else record_id
    return d.select(key.alias("id"), *columns, instant(ingested_at).alias("ingested_at"))


def error_rows(d: DataFrame, **columns: Column) -> DataFrame:
    """Rows in the error-log layout; columns left out are NULL."""
    return d.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ERROR_LOG_SCHEMA]
    )


def to_error_log(d: DataFrame, source: str, occurred_at) -> DataFrame:
    """Rejected records as error-log rows, each with its own topic position.

    The payload is base64 of the bytes for undecodable values, else the record as JSON.
    """
    payload = F.when(F.col("decode_ok"), wire_json()).otherwise(base64_text(F.col("raw_value")))
    return error_rows(
        d,
        source=F.lit(source),
        error_type=F.col("error_type"),
        error_message=F.col("error_message"),
        raw_payload=payload,
        kafka_topic=F.col("topic"),
        kafka_partition=F.col("partition"),
        kafka_offset=F.col("offset"),
        occurred_at=instant(occurred_at),
    )


def to_dlq_payload(rejects: DataFrame) -> DataFrame:
    """Error-log rows as dead-letter messages: JSON with the original payload nested."""
    head = F.to_json(
        F.struct(
            "error_type",
            "error_message",
            F.col("kafka_topic").alias("original_topic"),
            F.col("kafka_offset").alias("offset"),
        )
    )
    quoted = F.concat(F.lit('"'), F.col("raw_payload"), F.lit('"'))
    payload = F.when(F.col("error_type").isin(*DECODE_ERRORS.values()), quoted).otherwise(F.col("raw_payload"))
    value = F.concat(
        F.expr("left({0}, length({0}) - 1)".format("head")),
        F.lit(',"payload":'),
        F.coalesce(payload, F.lit("null")),
        F.lit("}"),
    )
    key = F.concat_ws("-", "kafka_topic", "kafka_partition", "kafka_offset")
    return rejects.withColumn("head", head).select(key.cast("binary").alias("key"), value.cast("binary").alias("value"))


def dlq_to_error_log(messages: DataFrame, occurred_at) -> DataFrame:
    """Dead-letter topic records as error-log rows.

    Topic is the one the record first failed on; partition and offset are the
    dead-letter message's own. A value that is not a JSON object is kept as
    ``dlq_parse_error`` instead of being lost.
    """
    content, guard = F.col("value").cast("string"), guard_word()
    opens_object = F.ltrim(content, F.lit(" \t\r\n")).startswith("{")
    parsed = computed_once(messages, "body", F.try_parse_json(guarded(content, guard)))

    def part(path: str, kind: str) -> Column:
        return F.try_variant_get("body", f"$.{guard}.{path}", kind)

    def text(name: str) -> Column:
        return part(f"value.{name}", "string")

    members = F.try_variant_get("body", f"$.{guard}", "map<string, variant>")
    whole = part("value", "variant").isNotNull() & part(guard, "variant").isNotNull() & (F.size(members) == 2)
    parsed = parsed.withColumn("readable", F.coalesce(whole & opens_object, F.lit(False)))

    readable = F.col("readable")
    payload = F.to_json(part("value.payload", "variant"))
    return error_rows(
        parsed,
        source=F.lit("dlq_consumer"),
        error_type=F.when(readable, F.coalesce(text("error_type"), F.lit(UNKNOWN))).otherwise(DLQ_PARSE_ERROR),
        error_message=F.when(readable, F.coalesce(text("error_message"), F.lit(UNKNOWN))).otherwise(
            "Dead-letter value is not a JSON object"
        ),
        raw_payload=F.when(readable, F.coalesce(payload, F.lit("null"))).otherwise(base64_text(F.col("value"))),
        kafka_topic=F.when(readable, text("original_topic")),
        kafka_partition=F.col("partition"),
        kafka_offset=F.col("offset"),
        occurred_at=instant(occurred_at),
    )


def late_rows(timed: DataFrame, occurred_at) -> DataFrame:
    """Ticks whose window had closed (``id`` holds their topic position) as error-log rows."""
    ticks = [c for c in timed.columns if c not in ("id", "event_time", "window_start", "window_end")]
    return error_rows(
        timed,
        source=F.lit("window"),
        error_type=F.lit(LATE_TICK),
        error_message=F.concat(F.lit("Window was closed already: "), utc_text(F.col("window_start"))),
        raw_payload=F.to_json(F.struct(*ticks), {"ignoreNullFields": "false"}),
        kafka_topic=F.col("id.topic"),
        kafka_partition=F.col("id.partition"),
        kafka_offset=F.col("id.offset"),
        occurred_at=instant(occurred_at),
    )


def _encodable() -> Column:
    condition = F.lit(True)
    for c in REQUIRED_WIRE_FIELDS:
        condition = condition & F.col(c).isNotNull()
    return condition


def publish_payload(d: DataFrame) -> DataFrame:
    """Wire tickers as keyed JSON messages; rows lacking a required field are left to ``publish_rejects``."""
    return _keyed(d, wire_json().cast("binary"))


def publish_avro_payload(d: DataFrame, schema_id: int) -> DataFrame:
    """Wire tickers as keyed, framed Avro messages. Needs the spark-avro package on the session's class path."""
    from pyspark.sql.avro.functions import to_avro

    return _keyed(d, framed(to_avro(F.struct(*WIRE_COLUMNS), avro_contract()), schema_id))


def framed(body: Column, schema_id: int) -> Column:
    """A message body behind the registry frame: a zero byte and the schema id."""
    return F.concat(F.unhex(F.lit(f"00{schema_id:08x}")), body)


def _keyed(d: DataFrame, value: Column) -> DataFrame:
    return d.filter(_encodable()).select(F.col("symbol").cast("binary").alias("key"), value.alias("value"))


def publish_tallies(d: DataFrame) -> DataFrame:
    """Tickers sent and refused."""
    return d.agg(F.count_if(_encodable()).alias("sent"), F.count_if(~_encodable()).alias("errors"))


def publish_rejects(d: DataFrame, occurred_at) -> DataFrame:
    """Tickers the message contract refuses, as error-log rows."""
    absent = first_match([(F.col(c).isNull(), F.lit(f"Null in required field: '{c}'")) for c in REQUIRED_WIRE_FIELDS])
    return error_rows(
        d.filter(~_encodable()),
        source=F.lit("producer"),
        error_type=F.lit(ENCODE_ERROR),
        error_message=absent,
        raw_payload=wire_json(),
        occurred_at=instant(occurred_at),
    )


def snapshot_header(d: DataFrame, as_of) -> DataFrame:
    """One row describing a snapshot: when it was taken and how many tickers it holds."""
    return d.agg(F.count(F.lit(1)).alias("count")).select(utc_text(instant(as_of)).alias("fetched_at"), "count")


def ingest_tallies(checked: DataFrame) -> DataFrame:
    """Records seen, rejected and passed on."""
    bad = F.col("error_type").isNotNull()
    return checked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(bad).alias("rejected"),
        F.count_if(~bad).alias("sent"),
    )


