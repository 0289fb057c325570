"""Structured Streaming queries over topic records.

Each query stores its batches through ``foreachBatch``. A batch repeated after a
failure gets the same clock and ids, and replaces exactly what its first try wrote. A
position that the target's ledger holds, from this stream or any other, is not stored again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.casts import from_micros, instant
from tickloom.operators import bronze as ingest
from tickloom.operators import gold, silver
from tickloom.operators.identity import assign_ids
from tickloom.plans.cycle import write_bronze, write_errors, write_silver
from tickloom.schemas import WINDOW_STATE_SCHEMA
from tickloom.sources.decode import decode, decode_landing, landed, landing_rejects
from tickloom.sources.files import exists
from tickloom.sources.ledger import Ledger
from tickloom.sources.tables import SLOTS, Marker, Store, day_of

# Fixed value: how often a stream takes its next micro-batch.
TRIGGER = {"processingTime": "30 seconds"}
TALLIES = "ingest_tallies"

Clock = Callable[[], datetime]
Sink = Callable[[DataFrame, int], None]


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def checkpoint_for(spark: SparkSession, name: str, base: str | None = None) -> str:
    """A stream's checkpoint folder: below ``base``, else below the cluster's shared checkpoint folder."""
    root = base or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("Set spark.checkpoint.dir to a shared folder, or pass a checkpoint folder")
    return f"{root.rstrip('/')}/streams/{name}"


def writer_of(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    """The name of a stream's writer, kept with its checkpoint: a new checkpoint is a new writer."""
    path = f"{checkpoint_for(spark, name, checkpoint)}/writer"
    if not exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(uuid4().hex,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).first().value


def _start(d: DataFrame, name: str, sink: Sink, trigger: dict | None, checkpoint: str | None) -> StreamingQuery:
    return (
        d.writeStream.queryName(name)
        .outputMode("append")
        .trigger(**(trigger or TRIGGER))
        .option("checkpointLocation", checkpoint_for(d.sparkSession, name, checkpoint))
        .foreachBatch(sink)
        .start()
    )


@contextmanager
def _new_rows(store: Store, source: str, batch: DataFrame) -> Iterator[tuple[DataFrame | None, int]]:
    """The rows of a batch that the source's ledger doesn't hold (None if there are none), and how many others there were.

    That part of the store is held meanwhile, and the ledger notes the batch if all went well.
    """
    held = batch.persist()
    try:
        if held.isEmpty():
            yield None, 0
            return
        with store.exclusive(source):
            ledger = Ledger(store, source)
            fresh = ledger.fresh(held)
            try:
                yield (None if fresh.repeated and fresh.rows.isEmpty() else fresh.rows), fresh.repeated
                ledger.note(fresh)
            finally:
                fresh.spans.unpersist()
    finally:
        held.unpersist()


def _store_tallies(store: Store, checked: DataFrame, repeated: int, moment: datetime, block: int) -> None:
    """What became of a batch's new records; a repeat of the batch replaces its row."""
    tallies = ingest.ingest_tallies(checked).withColumns({"repeated": F.lit(repeated).cast("long"), "stored_at": instant(moment)})
    store.replace_partitions(tallies, "gold.ingest_tallies", day=day_of(F.col("stored_at")), block=F.lit(block).cast("long"))


def checked_records(raw: DataFrame, fmt: str = "json") -> DataFrame:
    return ingest.with_reject_reason(decode(raw, fmt), fmt)


def start_ingest(
    raw: DataFrame,
    store: Store,
    fmt: str = "json",
    trigger: dict | None = None,
    checkpoint: str | None = None,
    clock: Clock = utc_now,
    dead_letters: Sink | None = None,
) -> StreamingQuery:
    """Topic records to Bronze rows and error-log rows, and optionally to dead-letter messages.

    Counts of seen, rejected and stored records come with the query's progress under
    ``ingest_tallies``; those of new records are stored for each batch in ``gold.ingest_tallies``.
    """
    writer, bad = writer_of(store.spark, "ingest", checkpoint), F.col("error_type").isNotNull()
    counted = checked_records(raw, fmt).observe(
        TALLIES,
        F.count(F.lit(1)).alias("total"),
        F.count_if(bad).alias("rejected"),
        F.count_if(~bad).alias("sent"),
    )

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        with _new_rows(store, "ingest", batch) as (checked, repeated):
            if checked is None:
                return
            block = store.number_for("ingest", writer, batch_id)
            moment = store.batch_clock("ingest", block, clock())
            errors = ingest.to_error_log(ingest.rejected(checked), "consumer", moment)
            write_errors(store, errors, block, "ingest")
            if dead_letters is not None:
                dead_letters(ingest.to_dlq_payload(errors), batch_id)
            numbered = assign_ids(ingest.valid(checked), block)
            write_bronze(store, ingest.to_bronze(numbered, moment, F.col("id")), block)
            _store_tallies(store, checked, repeated, moment, block)

    return _start(counted, "ingest", store_batch, trigger, checkpoint)


def start_silver(
    raw: DataFrame,
    store: Store,
    fmt: str = "json",
    trigger: dict | None = None,
    checkpoint: str | None = None,
    clock: Clock = utc_now,
) -> StreamingQuery:
    """Topic records straight to Silver rows; everything refused goes to the error log."""
    writer = writer_of(store.spark, "silver", checkpoint)

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        with _new_rows(store, "silver", batch) as (checked, _):
            if checked is None:
                return
            load = store.number_for("silver", writer, batch_id)
            moment = store.batch_clock("silver", load, clock())
            numbered = assign_ids(ingest.valid(checked), load)
            ticks = ingest.to_bronze(numbered, F.lit(None).cast("timestamp"), F.col("id"))
            step = Marker(seq=load, high=store.block_end(load), as_of=moment)
            write_silver(store, silver.to_silver(ticks, moment), step)
            refused = ingest.to_error_log(ingest.rejected(checked), "transformer", moment)
            write_errors(store, refused.unionByName(silver.silver_rejects(ticks, moment)), load, "silver")
            store.mark("loaded", step)

    return _start(checked_records(raw, fmt), "silver", store_batch, trigger, checkpoint)


def typed_stream(raw: DataFrame, fmt: str = "json") -> DataFrame:
    """Topic records as a stream of Silver rows, stamped with the processing time."""
    ticks = ingest.to_bronze(ingest.valid(checked_records(raw, fmt)), F.lit(None).cast("timestamp"))
    return silver.to_silver(ticks, F.current_timestamp())


def store_windows(store: Store, writer: str) -> Sink:
    def write(batch: DataFrame, batch_id: int) -> None:
        store.replace_partitions(
            batch,
            "gold.window_aggregations",
            day=day_of(F.col("window_start")),
            batch=F.lit(store.number_for("windows", writer, batch_id)).cast("long"),
        )

    return write


def start_windows(
    raw: DataFrame,
    store: Store,
    fmt: str = "json",
    time_col: str = "close_time",
    window: str = "5 minutes",
    watermark: str = "10 minutes",
    trigger: dict | None = None,
    checkpoint: str | None = None,
    sink: Sink | None = None,
) -> StreamingQuery:
    """Topic records to closed window rows; a row older than the watermark is dropped.

    ``time_col`` is the tick's own time by default; ``transformed_at`` selects processing time.
    """
    windows = gold.window_summary(typed_stream(raw, fmt), time_col, window, watermark)
    sink = sink or store_windows(store, writer_of(store.spark, "windows", checkpoint))
    return _start(windows, "windows", sink, trigger, checkpoint)


def start_tracked_windows(
    raw: DataFrame,
    store: Store,
    fmt: str = "json",
    time_col: str = "close_time",
    window: str = "5 minutes",
    watermark: timedelta = timedelta(minutes=10),
    trigger: dict | None = None,
    checkpoint: str | None = None,
    clock: Clock = utc_now,
) -> StreamingQuery:
    """Topic records to closed window rows as ``start_windows`` gives them, and late rows to the error log.

    The state of open windows is a small table of the store instead of the query's own: a row
    per symbol and window that is open. The watermark is the latest time of all batches before, less
    the delay. A tick whose window has closed by then is logged as ``late_tick`` with its topic position,
    so every tick is in a closed window, in an open one, or in the log. State and watermark belong to the
    store, and a replay under a new checkpoint counts nothing twice.
    """
    writer = writer_of(store.spark, "tracked_windows", checkpoint)

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        with _new_rows(store, "windows", batch) as (checked, _):
            if checked is None:
                return
            number = store.number_for("windows", writer, batch_id)
            moment = store.batch_clock("tracked_windows", number, clock())
            done = store.marker("window_state")
            if done.seq == number:  # Only the ledger's note is missing.
                return
            place = F.struct("topic", "partition", "offset")
            ticks = silver.to_silver(ingest.to_bronze(ingest.valid(checked), F.lit(None).cast("timestamp"), place), moment)
            _track_windows(store, gold.in_windows(ticks, time_col, window), done, number, moment, watermark)

    return _start(checked_records(raw, fmt), "tracked_windows", store_batch, trigger, checkpoint)


def _track_windows(store: Store, timed: DataFrame, done: Marker, number: int, moment: datetime, watermark: timedelta) -> None:
    late = F.lit(False) if done.as_of is None else F.col("window_end") <= instant(done.as_of - watermark)
    write_errors(store, ingest.late_rows(timed.filter(late), moment), number, "windows")
    latest = timed.agg(F.unix_micros(F.max("event_time")).alias("micros")).first().micros
    reached = max(t for t in (done.as_of, None if latest is None else from_micros(latest), from_micros(0)) if t is not None)
    closes = F.col("window_end") <= instant(reached - watermark)
    # The state of the step before stays in the other slot, for a repeat of this one.
    states = gold.window_states(timed.filter(~late)).unionByName(_open_windows(store, done))
    merged = gold.merge_windows(states).persist()
    try:
        closed = gold.finish_windows(merged.filter(closes), moment)
        store.replace_partitions(closed, "gold.window_aggregations", day=day_of(F.col("window_start")), batch=F.lit(number).cast("long"))
        seq = done.low + 1
        merged.filter(~closes).write.mode("overwrite").parquet(_open_path(store, seq))
        store.mark("window_state", Marker(seq=number, low=seq, as_of=reached))
    finally:
        merged.unpersist()


def _open_path(store: Store, seq: int) -> str:
    return f"{store.root}/state/open_windows/slot={seq % SLOTS}"


def _open_windows(store: Store, done: Marker) -> DataFrame:
    if done.seq == 0:
        return store.spark.createDataFrame([], WINDOW_STATE_SCHEMA)
    return store.spark.read.schema(WINDOW_STATE_SCHEMA).parquet(_open_path(store, done.low))


def open_windows(store: Store) -> DataFrame:
    """The states of windows that no watermark has closed yet."""
    return _open_windows(store, store.marker("window_state"))


def start_dlq(
    messages: DataFrame,
    store: Store,
    trigger: dict | None = None,
    checkpoint: str | None = None,
    clock: Clock = utc_now,
) -> StreamingQuery:
    """Dead-letter records to error-log rows, each topic position once, whichever stream brings it."""
    writer = writer_of(store.spark, "dlq", checkpoint)

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        with _new_rows(store, "dlq", batch) as (letters, _):
            if letters is None:
                return
            number = store.number_for("dlq", writer, batch_id)
            moment = store.batch_clock("dlq", number, clock())
            write_errors(store, ingest.dlq_to_error_log(letters, moment), number, "dlq")

    return _start(messages, "dlq", store_batch, trigger, checkpoint)


def start_publish(
    tickers: DataFrame, sink: Sink, trigger: dict | None = None, checkpoint: str | None = None
) -> StreamingQuery:
    """Landed tickers to keyed messages with defaults filled in."""
    return _start(ingest.publish_payload(ingest.normalize_ticker(tickers)), "publish", sink, trigger, checkpoint)


def start_landing(
    lines: DataFrame,
    store: Store,
    sink: Sink,
    trigger: dict | None = None,
    checkpoint: str | None = None,
    clock: Clock = utc_now,
) -> StreamingQuery:
    """Landed lines to keyed messages; lines that are no ticker, and tickers that can't be sent, to the error log."""
    writer = writer_of(store.spark, "landing", checkpoint)

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        decoded = batch.persist()
        try:
            if decoded.isEmpty():
                return
            with store.exclusive("landing"):
                number = store.number_for("landing", writer, batch_id)
                moment = store.batch_clock("landing", number, clock())
            tickers = ingest.normalize_ticker(landed(decoded))
            refused = landing_rejects(decoded, moment).unionByName(ingest.publish_rejects(tickers, moment))
            write_errors(store, refused, number, "landing")
            sink(ingest.publish_payload(tickers), batch_id)
        finally:
            decoded.unpersist()

    return _start(decode_landing(lines), "landing", store_batch, trigger, checkpoint)


def run_until_any_stops(spark: SparkSession) -> None:
    """Blocks until one of the session's streams ends or fails."""
    spark.streams.awaitAnyTermination()
