"""The incremental pass from Bronze to Silver to Gold, and the gated run around it."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tickloom.functions.casts import as_utc, floor_hour, instant
from tickloom.operators import gold, merge, quality, silver
from tickloom.schemas import HOURLY_SCHEMA
from tickloom.sources.files import exists
from tickloom.sources.tables import BLOCK_BITS, Marker, Store, check_layers, day_of, days_between

log = logging.getLogger(__name__)


class GateFailed(RuntimeError):
    pass


BRONZE_ROWS, SILVER_ROWS = "bronze.ticker_raw", "silver.ticker"
# The error log is numbered by whoever writes it.
ERROR_ROWS = {kind: f"bronze.error_log.{kind}" for kind in ("ingest", "silver", "dlq", "windows", "landing")}


def write_bronze(store: Store, rows: DataFrame, block: int) -> None:
    parts = {"day": day_of(F.col("ingested_at")), "block": F.lit(block).cast("long")}
    store.note_rows(BRONZE_ROWS, block, store.counted(rows, "bronze.ticker_raw", **parts))
    store.mark("ingested", Marker(seq=block, high=store.block_end(block)))


def append_bronze(store: Store, rows: DataFrame, block: int | None = None) -> int:
    """Stores a batch of Bronze rows as the next block of ids and marks it complete.

    The rows' own ids become their places in the block, so they need only be unique
    within the batch. To repeat a batch that broke off, pass the same block again.
    """
    with store.exclusive("ingest"):
        block = store.next_number("ingest") if block is None else block
        write_bronze(store, _numbered(rows, block), block)
    return block


def _numbered(rows: DataFrame, block: int) -> DataFrame:
    place = F.col("id")
    fits = place.isNotNull() & (place >= 0) & (place < F.lit(1 << BLOCK_BITS))
    shifted = F.when(fits, F.lit(block << BLOCK_BITS) + place).otherwise(
        F.raise_error(F.lit("A Bronze id is missing or does not fit its block"))
    )
    return rows.withColumn("id", shifted)


def _bronze_between(store: Store, low: int, high: int) -> DataFrame:
    """Stored rows with ``low < id <= high``; other blocks are pruned by their folder name."""
    block = F.col("block")
    rows = store.whole("bronze.ticker_raw").filter(block.between((low + 1) >> BLOCK_BITS, high >> BLOCK_BITS))
    return silver.incremental(rows, low).filter(F.col("id") <= high)


def _write_load(store: Store, load: Marker) -> None:
    rows = _bronze_between(store, load.low, load.high)
    refused = Observation()
    write_silver(store, silver.to_silver(silver.count_refused(rows, refused), load.as_of), load)
    # Ingest has checked the rows already, so most loads refuse none and need no second scan.
    if refused.get.get("refused", 0):
        write_errors(store, silver.silver_rejects(rows, load.as_of), load.seq, "silver")
    store.mark("loaded", load)


def write_silver(store: Store, rows: DataFrame, load: Marker) -> None:
    """A load's Silver rows, all of its one clock, and what they add to their hour."""
    number = F.lit(load.seq).cast("long")
    stored = store.counted(rows, "silver.ticker", day=day_of(F.col("transformed_at")), load=number)
    store.note_rows(SILVER_ROWS, load.seq, stored)
    written = store.scan("silver.ticker", f"/day={as_utc(load.as_of).date()}/load={load.seq}") if stored else store.empty("silver.ticker")
    states = gold.hour_states(written)
    store.replace_partitions(states, "gold.hourly_states", day=day_of(F.col("hour")), load=number)


def write_errors(store: Store, rows: DataFrame, batch: int, kind: str) -> None:
    parts = {"day": day_of(F.col("occurred_at")), "batch": F.lit(batch).cast("long")}
    store.note_rows(ERROR_ROWS[kind], batch, store.counted(rows, "bronze.error_log", **parts))


def load_silver(store: Store, as_of: datetime | str) -> Marker:
    """Loads the Bronze rows that came in since the last load.

    The range and clock of a load are recorded before it starts. A load that broke
    off is first repeated exactly as planned, and replaces what it left behind. Two
    cycles on one store take turns, so each row is loaded by one of them.
    """
    with store.exclusive("silver"):
        return _load_silver(store, as_utc(as_of))


def _load_silver(store: Store, moment: datetime) -> Marker:
    done, planned = store.marker("loaded"), store.marker("planned")
    if planned.seq > done.seq:
        _write_load(store, planned)
        done = planned
    if done.as_of is not None and moment < done.as_of:
        raise ValueError(f"The clock went back: {moment} is before the last load at {done.as_of}")
    complete = store.marker("ingested").high
    if complete <= done.high:
        return done
    load = Marker(seq=store.next_number("silver"), low=done.high, high=complete, as_of=moment)
    store.mark("planned", load)
    _write_load(store, load)
    return load


def _new_silver(store: Store, before: Marker, loaded: Marker) -> DataFrame:
    """Rows of the loads the last refresh has not seen."""
    if loaded.seq <= before.high:
        return store.empty("silver.ticker")
    if before.as_of is None:
        rows = store.whole("silver.ticker")
    else:
        # The clock of loads never goes back, so newer loads lie on the same day or later ones.
        rows = store.read("silver.ticker", days_between(before.as_of, loaded.as_of))
    return rows.filter(F.col("load").between(before.high + 1, loaded.seq))


def _together(steps: list[Callable[[], None]]) -> None:
    """Runs independent jobs side by side, so small ones do not wait for each other."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for step in [pool.submit(s) for s in steps]:
            step.result()


def refresh_gold(store: Store, as_of: datetime | str) -> Marker:
    """Brings the Gold tables up to the last Silver load."""
    with store.exclusive("gold"):
        return _refresh_gold(store, as_utc(as_of))


def _refresh_gold(store: Store, moment: datetime) -> Marker:
    before, loaded = store.marker("gold"), store.marker("loaded")
    seq = before.seq + 1

    def refresh_boards(stored: DataFrame) -> list[Callable[[], None]]:
        boards = {
            "gold.top_gainers": gold.top_gainers(stored, moment),
            "gold.top_losers": gold.top_losers(stored, moment),
            "gold.volume_leaders": gold.volume_leaders(stored, moment),
        }
        return [partial(store.replace_slot, board, name, seq) for name, board in boards.items()]

    def refresh_latest() -> None:
        old = store.slot("gold.latest_prices", before.seq)
        if loaded.seq <= before.high:  # No new row: the same prices, and boards of this moment.
            _together([partial(store.replace_slot, old, "gold.latest_prices", seq), *refresh_boards(old)])
            return
        store.replace_slot(gold.refresh_latest(old, _new_silver(store, before, loaded)), "gold.latest_prices", seq)
        _together(refresh_boards(store.slot("gold.latest_prices", seq)))

    _together([refresh_latest, partial(refresh_hourly, store, moment, before, loaded)])
    refreshed = Marker(seq=seq, high=loaded.seq, as_of=loaded.as_of)
    store.mark("gold", refreshed)
    return refreshed


def refresh_hourly(store: Store, moment: datetime, before: Marker, loaded: Marker) -> None:
    """Summarises every hour that has ended since the last time, however long ago that is.

    Hours come from the states that each load left, never from Silver. The marker ``hours`` is
    the ledger: all hours before its clock are closed. A load that is stored after its hour
    was closed has that hour merged once more. Where no hour has ended and no load is new,
    nothing is read. The merged days are staged first: should the overwrite break off, the
    next refresh applies what is staged.
    """
    closed, staged = store.marker("hours"), store.marker("hours_staged")
    if staged.seq > closed.seq:
        closed = _apply_hours(store, staged)
    planned, end = store.marker("planned"), floor_hour(moment)
    if planned.seq > loaded.seq:  # A load that broke off belongs to the hour it was planned in.
        end = min(end, floor_hour(planned.as_of))
    bound = closed.as_of
    ended = bound is None or end > bound
    if loaded.seq == 0 or not ended and loaded.seq <= before.high:
        return
    if bound is None:
        states, due = store.whole("gold.hourly_states"), F.lit(True)
    else:
        days = days_between(min(bound, floor_hour(before.as_of or bound)), max(end, bound) - timedelta(microseconds=1))
        states, due = store.read("gold.hourly_states", days), (F.col("load") > before.high) | (F.col("hour") >= instant(bound))
    states = states.filter((F.col("load") <= loaded.seq) & (F.col("hour") < instant(max(end, bound or end))))
    hours = states.filter(due).select("hour").distinct()
    days = [r.day for r in hours.select(F.to_date("hour").alias("day")).distinct().collect()]
    if days:
        summary = gold.finish_hours(gold.merge_hours(states.join(hours, "hour", "left_semi")), moment)
        stored = store.read("gold.hourly_summary", days).select(*HOURLY_SCHEMA.names)
        merged = merge.upsert(stored, summary, merge.HOURLY_KEYS, merge.HOURLY_RULES)
        merged.write.mode("overwrite").parquet(f"{store.root}/state/hourly_staged_rows")
    if days or ended:
        step = Marker(seq=closed.seq + 1, low=len(days), high=loaded.seq, as_of=max(end, bound or end))
        store.mark("hours_staged", step)
        _apply_hours(store, step)


def rebuild_hours(store: Store) -> None:
    """Makes the hour states anew from Silver, as for a store that was filled before there were any."""
    states = gold.hour_states(store.whole("silver.ticker"), "load")
    store.replace_partitions(states, "gold.hourly_states", day=day_of(F.col("hour")))


def _apply_hours(store: Store, step: Marker) -> Marker:
    if step.low:
        staged = store.spark.read.schema(HOURLY_SCHEMA).parquet(f"{store.root}/state/hourly_staged_rows")
        store.replace_partitions(staged, "gold.hourly_summary", day=day_of(F.col("hour")))
    store.mark("hours", step)
    return step


def run_cycle(store: Store, as_of: datetime | str) -> Marker:
    """One incremental pass; running it again with nothing new changes no result."""
    load_silver(store, as_of)
    return refresh_gold(store, as_of)


def _enforce(gates: DataFrame) -> None:
    failed = [f"{g.gate}: {g.value} (limit {g.threshold})" for g in gates.collect() if not g.passed]
    if failed:
        raise GateFailed("; ".join(failed))


def record_alerts(store: Store, errors: DataFrame, as_of: datetime | str) -> None:
    """Stores the recent errors of every type, whose number is not bounded, and logs where they are."""
    moment = as_utc(as_of)
    counts = quality.errors_by_type(errors, moment).withColumn("checked_at", F.lit(moment))
    store.replace_partitions(counts, "gold.error_alerts", day=day_of(F.col("checked_at")), run=F.lit(int(moment.timestamp())).cast("long"))
    total = quality.recent_error_total(errors, moment).first().total
    if total:
        log.warning("%d recent errors; by type in gold.error_alerts, run %d", total, int(moment.timestamp()))


def recount(store: Store) -> None:
    """Makes the manifest anew from the tables, as for a store that was filled before there was one."""
    tables = [(BRONZE_ROWS, store.whole("bronze.ticker_raw"), "block"), (SILVER_ROWS, store.whole("silver.ticker"), "load")]
    log = store.scan("bronze.error_log")
    kinds = {"ingest": "consumer", "silver": "transformer", "dlq": "dlq_consumer", "windows": "window", "landing": "producer"}
    tables += [(ERROR_ROWS[kind], log.filter(F.col("source") == source), "batch") for kind, source in kinds.items()]
    for counter, rows, number in tables:
        for r in rows.groupBy(number).count().toLocalIterator():
            store.note_rows(counter, r[number], r["count"])


def record_health(store: Store, as_of: datetime | str) -> None:
    """Row counts of the layers from the manifest; of the data only the latest prices, a row per symbol, are counted."""
    if store.noted_rows(BRONZE_ROWS) is None and exists(store.spark, store.path("bronze.ticker_raw") + "/day=*"):
        recount(store)
    errors = {kind: store.noted_rows(counter) or 0 for kind, counter in ERROR_ROWS.items()}
    snapshot = store.read("gold.latest_prices").agg(F.count(F.lit(1)).alias("gold_count")).select(
        instant(as_of).alias("checked_at"),
        F.lit(store.noted_rows(BRONZE_ROWS) or 0).cast("long").alias("bronze_count"),
        F.lit(store.noted_rows(SILVER_ROWS) or 0).cast("long").alias("silver_count"),
        "gold_count",
        F.lit(sum(errors.values())).cast("long").alias("error_count"),
        F.lit(errors["dlq"]).cast("long").alias("dlq_count"),
    )
    store.append(snapshot, "gold.pipeline_health")


def record_report(store: Store, report: str, figures: DataFrame, as_of: datetime | str) -> None:
    """Stores the figures of a one-row frame, those included that no gate judges."""
    moment = as_utc(as_of)
    row = figures.select(*[F.col(c).cast("long").alias(c) for c in figures.columns])
    metrics = row.unpivot([], figures.columns, "metric", "value")
    metrics = metrics.withColumns({"report": F.lit(report), "checked_at": instant(moment)})
    store.replace_partitions(metrics, "gold.gate_reports", day=day_of(F.col("checked_at")), run=F.lit(int(moment.timestamp())).cast("long"))


def run_gated(store: Store, as_of: datetime | str) -> None:
    """The steps in order, each behind its gate; the first failed gate stops the run."""
    start = as_utc(as_of) - timedelta(minutes=quality.RECENT_MINUTES)
    check_layers(store.spark)
    _enforce(quality.bronze_gate(store.since("bronze.ticker_raw", start), as_of))
    load_silver(store, as_of)
    recent = store.since("silver.ticker", start)
    record_report(store, "silver_quality", quality.silver_quality(recent, as_of), as_of)
    _enforce(quality.silver_gate(recent, as_of))
    refresh_gold(store, as_of)
    boards = [store.read(f"gold.{name}") for name in ("latest_prices", "top_gainers", "top_losers", "volume_leaders")]
    record_report(store, "gold_counts", quality.gold_counts(*boards), as_of)
    _enforce(quality.gold_gate(boards[0]))
    record_health(store, as_of)
    errors = store.since("bronze.error_log", start)
    record_alerts(store, errors, as_of)
    _enforce(quality.error_gate(errors, as_of))
