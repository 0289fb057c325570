"""Every operator as a query over the given tables.

A query builds its plan lazily from whole tables. Timestamps leave as zone-less
UTC values, so the session's zone cannot change a result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tickloom.functions.casts import instant
from tickloom.operators import bronze as ingest
from tickloom.operators import gold, merge, panels, positions, quality
from tickloom.operators import silver as typed
from tickloom.schemas import TICKER_FIELDS, WIRE_COLUMNS
from tickloom.sources import adapters, decode

AS_OF = "2024-01-30 23:00:00"
EARLIER_LOAD = "2024-01-29 23:00:00"
FIRST_LOAD_END = "2024-01-16 00:00:00"
DLQ_TOPIC = "ticker-dlq"


class Feed:
    """The layers as lazy frames derived from one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def bronze(self) -> DataFrame:
        return adapters.events_to_bronze(self.table("events"))

    @cached_property
    def raw(self) -> DataFrame:
        """Topic records, some with a cut-off value."""
        return adapters.bronze_to_raw(self.bronze, broken=(F.col("id") - 1) % 113 == 11)

    @cached_property
    def wire(self) -> DataFrame:
        return decode.decode_json(self.raw)

    @cached_property
    def checked(self) -> DataFrame:
        return ingest.with_reject_reason(self.wire)

    @cached_property
    def consumer_rejects(self) -> DataFrame:
        return ingest.to_error_log(ingest.rejected(self.checked), "consumer", F.col("kafka_timestamp"))

    @cached_property
    def dlq_messages(self) -> DataFrame:
        """Dead-letter records: every reject, and free text that is no JSON at all."""
        rejects = self.consumer_rejects
        payload = ingest.to_dlq_payload(rejects.select("*", F.col("occurred_at").alias("timestamp")))
        letters = payload.select(
            "value",
            F.lit(DLQ_TOPIC).alias("topic"),
            F.element_at(F.split(F.col("key").cast("string"), "-"), -2).cast("int").alias("partition"),
            F.element_at(F.split(F.col("key").cast("string"), "-"), -1).cast("long").alias("offset"),
        )
        noise = self.table("conversations").select(
            F.col("text").cast("binary").alias("value"),
            F.lit(DLQ_TOPIC).alias("topic"),
            F.col("turn").cast("int").alias("partition"),
            F.col("conv_id").alias("offset"),
        )
        return letters.unionByName(noise)

    @cached_property
    def dlq_rows(self) -> DataFrame:
        return ingest.dlq_to_error_log(self.dlq_messages, AS_OF)

    @cached_property
    def stored_letters(self) -> DataFrame:
        """Intervals of the dead letters' positions that are stored already: runs of a hundred, and every third in between."""
        part = (F.floor(F.col("offset") / 100) % 2 == 0) | (F.col("offset") % 3 == 0)
        return positions.intervals(self.dlq_messages.filter(part))

    @cached_property
    def silver(self) -> DataFrame:
        return typed.to_silver(self.bronze, F.col("ingested_at"))

    @cached_property
    def silver_rejects(self) -> DataFrame:
        return typed.silver_rejects(self.bronze, F.col("ingested_at"))

    @cached_property
    def earlier_silver(self) -> DataFrame:
        return typed.to_silver(adapters.events_to_earlier_bronze(self.table("events")), F.col("ingested_at"))

    @cached_property
    def error_log(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.consumer_rejects, self.silver_rejects, self.dlq_rows])

    @cached_property
    def latest(self) -> DataFrame:
        return gold.latest_prices(self.silver)

    @cached_property
    def gainers(self) -> DataFrame:
        return gold.top_gainers(self.latest, AS_OF)

    @cached_property
    def losers(self) -> DataFrame:
        return gold.top_losers(self.latest, AS_OF)

    @cached_property
    def leaders(self) -> DataFrame:
        return gold.volume_leaders(self.latest, AS_OF)

    @cached_property
    def hourly(self) -> DataFrame:
        return gold.summarize_hours(self.silver, AS_OF)

    @cached_property
    def windows(self) -> DataFrame:
        return gold.window_summary(self.silver, computed_at=instant(AS_OF))

    @cached_property
    def snapshots(self) -> DataFrame:
        """One snapshot document per event, holding its tick and a flat copy at the weighted price."""
        tick = [F.col(table).alias(wire) for wire, table, _ in TICKER_FIELDS]
        flat = [
            (F.col("weighted_avg_price") if wire == "lastPrice" else F.col(table)).alias(wire)
            for wire, table, _ in TICKER_FIELDS
        ]
        tickers = F.array(F.struct(*tick), F.struct(*flat))
        fetched = F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
        doc = F.struct(fetched.alias("fetched_at"), F.lit(2).alias("count"), tickers.alias("tickers"))
        return self.bronze.select(F.to_json(doc).alias("value"))


    @cached_property
    def landing(self) -> DataFrame:
        """The topic's values as landed lines, in a file per partition."""
        path = F.concat(F.lit("landing/"), F.col("partition").cast("string"))
        lines = self.raw.select(F.col("value").cast("string").alias("value"), path.alias("path"), F.col("offset").alias("position"))
        return decode.decode_landing(lines)

    @cached_property
    def snapshot_files(self) -> DataFrame:
        """The snapshots as files, some cut off, some with bytes behind the document."""
        numbered = self.snapshots.withColumn("n", F.length("value") % 29)
        value = F.when(F.col("n") == 3, F.substring("value", 1, 60)).when(F.col("n") == 5, F.concat("value", F.lit("]"))).otherwise(F.col("value"))
        files = numbered.select(value.alias("value"), F.concat(F.lit("snapshots/"), F.col("n").cast("string")).alias("path"), F.lit(0).cast("long").alias("position"))
        return decode.decode_snapshots(files)


def _text_messages(d: DataFrame) -> DataFrame:
    return d.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def _bands(feed: Feed) -> DataFrame:
    pct = F.col("price_change_pct")
    return feed.latest.select(
        "symbol",
        pct,
        panels.change_band(pct, panels.GAINER_BANDS).alias("gainer_band"),
        panels.change_band(pct, panels.LOSER_BANDS).alias("loser_band"),
        panels.change_band(pct, panels.LEADER_BANDS).alias("leader_band"),
    )


def _bronze_valid(feed: Feed) -> DataFrame:
    record_id = F.col("offset") * adapters.FEED_PARTITIONS + F.col("partition") + 1
    return ingest.to_bronze(ingest.valid(feed.checked), F.col("kafka_timestamp"), record_id)


def _decoded(feed: Feed) -> DataFrame:
    return feed.wire.select("kafka_timestamp", "topic", "partition", "offset", *WIRE_COLUMNS, "decode_ok")


def _incremental(feed: Feed) -> DataFrame:
    loaded = feed.bronze.filter(F.col("ingested_at") < instant(FIRST_LOAD_END))
    new = typed.incremental_from(feed.bronze, typed.next_watermark(loaded))
    return typed.to_silver(new, F.col("ingested_at"))


def _hourly_upsert(feed: Feed) -> DataFrame:
    stored = gold.summarize_hours(feed.earlier_silver, EARLIER_LOAD)
    return merge.upsert(stored, feed.hourly, merge.HOURLY_KEYS, merge.HOURLY_RULES)


def _hours_in_parts(feed: Feed) -> DataFrame:
    """Hours from the states of seven loads."""
    states = gold.hour_states(feed.silver.withColumn("load", F.col("id") % 7), "load")
    return gold.finish_hours(gold.merge_hours(states), AS_OF)


def _windows_in_parts(feed: Feed) -> DataFrame:
    states = gold.window_states(gold.in_windows(feed.silver).withColumn("batch", F.col("id") % 5), "batch")
    return gold.finish_windows(gold.merge_windows(states), AS_OF)


def _snapshot_feed(feed: Feed) -> DataFrame:
    return decode.explode_snapshot(decode.parse_snapshot(feed.snapshots))


def _replayed(feed: Feed) -> DataFrame:
    """The dead letters once more, less those at stored positions."""
    letters = positions.once_each(feed.dlq_messages.select(*positions.POSITION))
    return positions.unseen(letters, feed.stored_letters)


def _stored_letters(feed: Feed) -> DataFrame:
    """Dead-letter rows not stored yet, when the rejects and a third of the letters already are.

    A letter is known by its source, topic, partition and offset: the same numbers in
    another topic, or from another source, are another record.
    """
    keys = ["source", "kafka_topic", "kafka_partition", "kafka_offset"]
    stored = feed.consumer_rejects.unionByName(feed.dlq_rows.filter(F.col("kafka_offset") % 3 == 0))
    return merge.insert_absent(stored, feed.dlq_rows, keys).select("error_type", *keys)


_QUERIES: dict[str, Callable[[Feed], DataFrame]] = {
    # decoding and ingest
    "decode_json": _decoded,
    "decode_rejects": lambda f: f.consumer_rejects.filter(F.col("error_type") == ingest.DECODE_ERROR),
    "snapshot_explode": _snapshot_feed,
    "snapshot_rejects": lambda f: decode.snapshot_rejects(f.snapshot_files, AS_OF),
    "landing_rejects": lambda f: decode.landing_rejects(f.landing, AS_OF),
    "landing_tickers": lambda f: decode.landed(f.landing),
    "snapshot_header": lambda f: ingest.snapshot_header(f.raw, AS_OF),
    "normalize_ticker": lambda f: ingest.normalize_ticker(f.wire),
    "publish_payload": lambda f: _text_messages(ingest.publish_payload(f.wire)),
    "publish_rejects": lambda f: ingest.publish_rejects(f.wire, AS_OF),
    "publish_tallies": lambda f: ingest.publish_tallies(f.wire),
    "bronze_valid": _bronze_valid,
    "bronze_rejects": lambda f: f.consumer_rejects.filter(F.col("error_type") == ingest.VALIDATION_ERROR),
    "ingest_tallies": lambda f: ingest.ingest_tallies(f.checked),
    "dlq_payload": lambda f: _text_messages(ingest.to_dlq_payload(f.consumer_rejects)),
    "dlq_to_error_log": lambda f: f.dlq_rows,
    "dlq_insert_absent": _stored_letters,
    "dlq_intervals": lambda f: f.stored_letters,
    "dlq_replayed": _replayed,
    # Silver
    "silver_typed": lambda f: f.silver,
    "silver_rejects": lambda f: f.silver_rejects,
    "silver_incremental": _incremental,
    "next_watermark": lambda f: typed.next_watermark(f.bronze),
    "cast_failures": lambda f: typed.cast_failures(f.bronze),
    # Gold
    "latest_prices": lambda f: f.latest,
    "latest_upsert": lambda f: merge.upsert(gold.latest_prices(f.earlier_silver), f.latest, merge.LATEST_KEYS),
    "latest_refresh": lambda f: gold.refresh_latest(gold.latest_prices(f.earlier_silver), f.silver),
    "top_gainers": lambda f: f.gainers,
    "top_losers": lambda f: f.losers,
    "volume_leaders": lambda f: f.leaders,
    "hourly_summary": lambda f: gold.hourly_summary(f.silver, AS_OF),
    "hourly_history": lambda f: f.hourly,
    "hourly_upsert": _hourly_upsert,
    "hourly_merged": _hours_in_parts,
    "window_5m": lambda f: f.windows,
    "window_5m_merged": _windows_in_parts,
    # quality
    "recent_bronze": lambda f: quality.recent_bronze(f.bronze, AS_OF),
    "silver_quality": lambda f: quality.silver_quality(f.silver, AS_OF),
    "gold_counts": lambda f: quality.gold_counts(f.latest, f.gainers, f.losers, f.leaders),
    "errors_by_type": lambda f: quality.errors_by_type(f.error_log),
    "recent_errors_by_type": lambda f: quality.errors_by_type(f.error_log, AS_OF),
    "health_snapshot": lambda f: quality.health_snapshot(f.bronze, f.silver, f.latest, f.error_log, AS_OF),
    "quality_gates": lambda f: quality.quality_gates(f.bronze, f.silver, f.latest, f.error_log, AS_OF),
    # dashboard and ad-hoc reads
    "layer_counts": lambda f: panels.layer_counts(f.bronze, f.silver, f.latest),
    "last_refresh": lambda f: panels.last_refresh(f.latest),
    "bronze_per_minute": lambda f: panels.rows_per_minute(f.bronze, "ingested_at", AS_OF, label="Bronze"),
    "silver_per_minute": lambda f: panels.rows_per_minute(f.silver, "transformed_at", AS_OF, label="Silver"),
    "gainers_panel": lambda f: panels.gainers_panel(f.gainers),
    "losers_panel": lambda f: panels.losers_panel(f.losers),
    "leaders_panel": lambda f: panels.leaders_panel(f.leaders),
    "gainers_top10": lambda f: panels.top10(f.gainers, "price_change_pct"),
    "leaders_top10": lambda f: panels.top10(f.leaders, "quote_volume"),
    "hourly_top10": lambda f: panels.hourly_top10(f.hourly, f.leaders, AS_OF),
    "window_5m_latest10": lambda f: panels.window_latest(f.windows),
    "change_bands": _bands,
}


def zoneless(d: DataFrame) -> DataFrame:
    return d.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f"`{f.name}`")
            for f in d.schema
        ]
    )


def _entry(build: Callable[[Feed], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return zoneless(build(Feed(spark, sf_dir)))

    return run


QUERIES = {name: _entry(build) for name, build in _QUERIES.items()}

