"""Layer tables as Parquet folders below one root.

Three rules make every write safe to repeat after a lost executor or driver:

* appended rows carry the number of the batch that wrote them as a partition
  column, and a repeated batch replaces its own partitions;
* small tables that are replaced as a whole alternate between two slots, and
  readers use the slot that the last finished refresh names;
* progress is kept in markers, which alternate between two slots as well, so a
  half-written marker never hides the one before it.

Two more keep writers of one store apart, on however many drivers:

* a number of a block, load or batch is drawn by creating a file of that name, which only
  one of those that try it at once can do;
* what reads progress, writes and marks it does so while it holds its part of the store.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType, TimestampType

from tickloom import schemas
from tickloom.functions.casts import as_utc, instant
from tickloom.sources import files
from tickloom.sources.files import exists

LAYERS = ["bronze", "silver", "gold"]
# Record ids of one ingest batch share their upper bits: id >> 36 is the batch's block,
# which leaves room for 68 billion records in a batch and 134 million batches.
BLOCK_BITS = 36
SLOTS = 2
# Markers that also hold numbers of a kind, from before numbers were drawn.
NUMBERED = {"ingest": ("ingested",), "silver": ("loaded", "planned")}
# Claimed numbers that share a folder.
CLAIMS = 1000
# A holder of a store's part is taken for dead when it gave no sign for so long; it gives one four times in that time.
LEASE_SECONDS = 60.0
UTC_ZONES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


@dataclass(frozen=True)
class Table:
    schema: StructType
    partitions: tuple[tuple[str, object], ...] = ()

    @property
    def stored(self) -> StructType:
        known = set(self.schema.names)
        extra = [StructField(name, kind) for name, kind in self.partitions if name not in known]
        return StructType([*self.schema.fields, *extra])

    @property
    def partition_names(self) -> list[str]:
        return [name for name, _ in self.partitions]


_DAY = ("day", DateType())
_SLOT = ("slot", LongType())

TABLES = {
    "bronze.ticker_raw": Table(schemas.BRONZE_SCHEMA, (_DAY, ("block", LongType()))),
    "bronze.error_log": Table(
        schemas.ERROR_LOG_SCHEMA, (("source", schemas.ERROR_LOG_SCHEMA["source"].dataType), _DAY, ("batch", LongType()))
    ),
    "silver.ticker": Table(schemas.SILVER_SCHEMA, (_DAY, ("load", LongType()))),
    "gold.latest_prices": Table(schemas.LATEST_SCHEMA, (_SLOT,)),
    "gold.top_gainers": Table(schemas.MOVERS_SCHEMA, (_SLOT,)),
    "gold.top_losers": Table(schemas.MOVERS_SCHEMA, (_SLOT,)),
    "gold.volume_leaders": Table(schemas.LEADERS_SCHEMA, (_SLOT,)),
    "gold.hourly_summary": Table(schemas.HOURLY_SCHEMA, (_DAY,)),
    "gold.hourly_states": Table(schemas.HOUR_STATE_SCHEMA, (_DAY, ("load", LongType()))),
    "gold.window_aggregations": Table(schemas.WINDOW_SCHEMA, (_DAY, ("batch", LongType()))),
    "gold.pipeline_health": Table(schemas.HEALTH_SCHEMA),
    "gold.error_alerts": Table(schemas.ALERTS_SCHEMA, (_DAY, ("run", LongType()))),
    "gold.gate_reports": Table(schemas.REPORTS_SCHEMA, (("report", schemas.REPORTS_SCHEMA["report"].dataType), _DAY, ("run", LongType()))),
    "gold.ingest_tallies": Table(schemas.TALLIES_SCHEMA, (_DAY, ("block", LongType()))),
}

# Tables whose closed days may be compacted: by day and the number of the write, and no other partition.
PACKED = ["bronze.ticker_raw", "silver.ticker", "gold.hourly_states", "gold.window_aggregations"]

_MARKER = StructType(
    [
        StructField("seq", LongType()),
        StructField("low", LongType()),
        StructField("high", LongType()),
        StructField("as_of", TimestampType()),
    ]
)
_MARKER_STORED = StructType([*_MARKER.fields, StructField("slot", LongType())])


@dataclass(frozen=True)
class Marker:
    """A step of progress: its number, the range it covers and its clock."""

    seq: int = 0
    low: int = 0
    high: int = 0
    as_of: datetime | None = None


class Store:
    """The layer tables of one session and root folder."""

    def __init__(self, spark: SparkSession, root: str):
        zone = spark.conf.get("spark.sql.session.timeZone")
        if zone not in UTC_ZONES:
            raise ValueError(f"Day folders and hours are UTC: set spark.sql.session.timeZone to UTC, not {zone}")
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    # -- reads ---------------------------------------------------------------

    def scan(self, name: str, below: str = "") -> DataFrame:
        """A table with its partition columns; empty while nothing is stored."""
        if not exists(self.spark, self.path(name) + below):
            return self.empty(name)
        reader = self.spark.read.schema(TABLES[name].stored).option("basePath", self.path(name))
        return reader.parquet(self.path(name) + below)

    def whole(self, name: str, days: Iterable[date] | None = None) -> DataFrame:
        """A table's rows as written and of compacted days, with its partition columns; of ``days`` only, if given.

        A number that has a folder of its own counts from there, so a day reads the same
        before its compaction, during it and after it, and after a repeat of an old write.
        """
        listed = None if days is None else {d.isoformat() for d in days}
        below = "" if listed is None else f"/day={{{','.join(sorted(listed))}}}"
        rows = self.scan(name, below)
        packed = {d: v for d, v in self.compacted(name).items() if listed is None or d in listed}
        if not packed:
            return rows
        number = TABLES[name].partition_names[-1]
        stored = self.spark.read.schema(TABLES[name].stored).parquet(*[self.compact_path(name, d, v) for d, v in packed.items()])
        for day in packed:
            own = [int(n.split("=")[1]) for n in files.names(self.spark, f"{self.path(name)}/day={day}") if "=" in n]
            if own:
                stored = stored.filter((F.col("day") != F.lit(day).cast("date")) | ~F.col(number).isin(own))
        return rows.unionByName(stored)

    def compacted(self, name: str) -> dict[str, int]:
        """The days that are compacted, and the version of each that counts."""
        found: dict[str, int] = {}
        for entry in files.names(self.spark, f"{self.root}/state/compacted/{name}"):
            day, version = entry.split("=")
            found[day] = max(int(version), found.get(day, 0))
        return found

    def compact_path(self, name: str, day: str, version: int) -> str:
        return f"{self.root}/compact/{name.replace('.', '/')}/{day}/{version}"

    def read(self, name: str, days: Iterable[date] | None = None) -> DataFrame:
        """A table's rows. With ``days`` only those day folders are listed at all."""
        table = TABLES[name]
        if _SLOT in table.partitions:
            return self.slot(name, self.marker("gold").seq)
        if days is None:
            return self.whole(name).select(*table.schema.names)
        return self.whole(name, days).select(*table.stored.names)

    def since(self, name: str, moment: datetime) -> DataFrame:
        """Rows of a day-partitioned table from the day of ``moment`` on."""
        return self.whole(name).filter(F.col("day") >= F.lit(as_utc(moment).date())).select(*TABLES[name].schema.names)

    def empty(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], TABLES[name].stored)

    def slot(self, name: str, seq: int) -> DataFrame:
        """A replaced-as-a-whole table as refresh ``seq`` left it; empty before the first one."""
        if seq == 0:
            return self.spark.createDataFrame([], TABLES[name].schema)
        return self.scan(name, f"/slot={seq % SLOTS}").select(*TABLES[name].schema.names)

    # -- writes --------------------------------------------------------------

    def replace_partitions(self, d: DataFrame, name: str, **partitions: Column) -> None:
        """Writes rows into their partitions, replacing exactly the partitions they fall in."""
        table = TABLES[name]
        rows = d.withColumns(partitions).select(*table.stored.names)
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*table.partition_names)
            .parquet(self.path(name))
        )

    def counted(self, d: DataFrame, name: str, **partitions: Column) -> int:
        """``replace_partitions``, and the number of rows written, told by the write itself."""
        seen = Observation()
        self.replace_partitions(d.observe(seen, F.count(F.lit(1)).alias("rows")), name, **partitions)
        return seen.get.get("rows") or 0

    # -- the manifest: how many rows each numbered write stored -----------------

    def note_rows(self, counter: str, number: int, rows: int) -> None:
        """Notes the rows that the write of this number stored; a repeat of the write replaces its note.

        A note is an empty file whose name tells number and rows, in a folder of CLAIMS numbers.
        """
        base, folder = self._counter(counter), number // CLAIMS
        for name in files.names(self.spark, f"{base}/{folder}"):
            if name.startswith(f"{number}="):
                files.delete(self.spark, f"{base}/{folder}/{name}")
        for name in files.names(self.spark, base):
            if name.startswith(f"{folder}="):
                files.delete(self.spark, f"{base}/{name}")
        files.create(self.spark, f"{base}/{folder}/{number}={rows}")

    def _counter(self, counter: str) -> str:
        return f"{self.root}/state/counts/{counter}"

    def noted_rows(self, counter: str) -> int | None:
        """The rows of all noted writes; None if there is no note. Only names are listed, no file is read.

        A folder of numbers that are long past is summed up once, in a name beside it.
        """
        base = self._counter(counter)
        there = files.names(self.spark, base)
        if not there:
            return None
        summed = dict(map(int, name.split("=")) for name in there if "=" in name)
        folders = sorted(int(name) for name in there if "=" not in name)
        for folder in folders:
            if folder not in summed:
                notes = [n.split("=") for n in files.names(self.spark, f"{base}/{folder}")]
                summed[folder] = sum(int(rows) for _, rows in notes)
                if folder < folders[-1] - 1:
                    files.create(self.spark, f"{base}/{folder}={summed[folder]}")
        return sum(summed.values())

    def replace_slot(self, d: DataFrame, name: str, seq: int) -> None:
        d.select(*TABLES[name].schema.names).write.mode("overwrite").parquet(f"{self.path(name)}/slot={seq % SLOTS}")

    def append(self, d: DataFrame, name: str) -> None:
        d.select(*TABLES[name].schema.names).write.mode("append").parquet(self.path(name))

    # -- progress ------------------------------------------------------------

    def marker_path(self, name: str) -> str:
        return f"{self.root}/state/{name}"

    def _newest(self, name: str):
        if not exists(self.spark, self.marker_path(name)):
            return None
        rows = self.spark.read.schema(_MARKER_STORED).json(self.marker_path(name))
        columns = ["seq", "low", "high", F.unix_micros("as_of").alias("micros"), "slot"]
        return rows.filter(F.col("seq").isNotNull()).select(*columns).orderBy(F.col("seq").desc()).first()

    def marker(self, name: str) -> Marker:
        """The newest readable marker, or the zero marker."""
        newest = self._newest(name)
        if newest is None:
            return Marker()
        as_of = None if newest.micros is None else as_utc("1970-01-01") + timedelta(microseconds=newest.micros)
        return Marker(newest.seq, newest.low, newest.high, as_of)

    def mark(self, name: str, marker: Marker) -> None:
        """Records progress in the slot that does not hold the newest marker."""
        newest = self._newest(name)
        slot = 0 if newest is None else (newest.slot + 1) % SLOTS
        clock = F.lit(None).cast("timestamp") if marker.as_of is None else instant(marker.as_of)
        row = self.spark.range(1).select(
            F.lit(marker.seq).cast("long").alias("seq"),
            F.lit(marker.low).cast("long").alias("low"),
            F.lit(marker.high).cast("long").alias("high"),
            clock.alias("as_of"),
        )
        row.coalesce(1).write.mode("overwrite").json(f"{self.marker_path(name)}/slot={slot}")

    def next_number(self, kind: str) -> int:
        """A number (of a block, load or batch) that no writer of this kind has had."""
        claims = f"{self.root}/state/claims/{kind}"
        number = self._last_number(kind, claims) + 1
        while not files.create(self.spark, f"{claims}/{number // CLAIMS}/{number}"):
            number += 1
        return number

    def _last_number(self, kind: str, claims: str) -> int:
        """The highest number claimed, or known from before numbers were claimed; a glance, others may be claiming."""
        for folder in sorted(map(int, files.names(self.spark, claims)), reverse=True):
            claimed = [int(n) for n in files.names(self.spark, f"{claims}/{folder}") if n.isdigit()]
            if claimed:
                return max(claimed)
        return max(self.marker(f"{kind}_numbers").seq, *(self.marker(m).seq for m in NUMBERED.get(kind, ())), 0)

    @contextmanager
    def exclusive(self, part: str, wait_seconds: float = 3600.0) -> Iterator[None]:
        """Holds a part of the store (``ingest``, ``silver``, ``gold`` ...); others wait until it is given back.

        Turns are numbered files. A holder shows now and then that it is alive; if it has
        not for ``LEASE_SECONDS``, as when its driver was lost, the next turn may be taken.
        """
        turns = f"{self.root}/state/turns/{part}"
        deadline = time.monotonic() + wait_seconds
        turn = self._take_turn(turns)
        while turn is None:
            if time.monotonic() > deadline:
                raise TimeoutError(f"Another writer has held {part} of {self.root} for {wait_seconds:.0f} seconds")
            time.sleep(0.2)
            turn = self._take_turn(turns)
        given_back = threading.Event()

        def show() -> None:
            while not given_back.wait(LEASE_SECONDS / 4):
                files.touch(self.spark, f"{turns}/{turn}")

        sign = threading.Thread(target=show, daemon=True)
        sign.start()
        try:
            for old in files.names(self.spark, turns):
                if int(old.removesuffix(".done")) < turn - 1:
                    files.delete(self.spark, f"{turns}/{old}")
            yield
        finally:
            given_back.set()
            sign.join()
            files.create(self.spark, f"{turns}/{turn}.done")

    def _take_turn(self, turns: str) -> int | None:
        there = files.names(self.spark, turns)
        taken = [int(n) for n in there if n.isdigit()]
        last = max(taken, default=0)
        if last and f"{last}.done" not in there:
            silent = files.age(self.spark, f"{turns}/{last}")
            if silent is None or silent < LEASE_SECONDS:
                return None
        return last + 1 if files.create(self.spark, f"{turns}/{last + 1}") else None

    def number_for(self, kind: str, writer: str, batch_id: int) -> int:
        """The number of a stream's batch: the one its first try got, else the next one.

        A stream repeats only its last batch. Batch numbers of another writer, such as the
        same stream under a new checkpoint, say nothing about this one's.
        """
        own = self.marker(f"{kind}_writer_{writer}")
        if own.seq == batch_id + 1:
            return own.low
        if own.seq > batch_id + 1:
            raise ValueError(f"Batch {batch_id} of {kind} writer {writer} comes after its batch {own.seq - 1}")
        number = self.next_number(kind)
        self.mark(f"{kind}_writer_{writer}", Marker(seq=batch_id + 1, low=number))
        return number

    def block_end(self, block: int) -> int:
        """The largest id a block can hold."""
        return ((block + 1) << BLOCK_BITS) - 1

    def batch_clock(self, name: str, seq: int, now: datetime) -> datetime:
        """One clock per batch: a repeated batch gets the time its first try recorded."""
        planned = self.marker(f"{name}_clock")
        if planned.seq == seq:
            return planned.as_of
        self.mark(f"{name}_clock", Marker(seq=seq, as_of=as_utc(now)))
        return as_utc(now)


def day_of(c: Column) -> Column:
    return c.cast("date")


def days_between(start: datetime, end: datetime) -> list[date]:
    first, last = as_utc(start).date(), as_utc(end).date()
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


# -- catalog -----------------------------------------------------------------


def _registered(name: str, table: Table) -> str:
    """The catalog's name of a table's own folder; where that isn't the whole table, its name is a view's."""
    if _SLOT in table.partitions:
        return f"{name}_slots"
    return f"{name}_written" if name in PACKED else name


def _columns(fields: Iterable[StructField]) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)


def create_layers(store: Store) -> None:
    """Registers the layers as databases, their tables, and views of the slotted and the compacted tables."""
    spark = store.spark
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for name, table in TABLES.items():
        parted = f"PARTITIONED BY ({', '.join(table.partition_names)})" if table.partitions else ""
        target = _registered(name, table)
        if spark.catalog.tableExists(target):
            continue
        # An empty append makes the folder, which a partition scan of the catalog needs.
        store.empty(name).write.mode("append").partitionBy(*table.partition_names).parquet(store.path(name))
        spark.sql(f"CREATE TABLE {target} ({_columns(table.stored)}) USING parquet {parted} LOCATION '{store.path(name)}'")
        if _SLOT in table.partitions:
            _create_slot_view(store, name, table)
        if name in PACKED:
            _create_whole_view(store, name, table)
    refresh_layers(store)


def _create_slot_view(store: Store, name: str, table: Table) -> None:
    spark, location = store.spark, store.marker_path("gold")
    if not spark.catalog.tableExists("gold.refreshes"):
        spark.createDataFrame([], _MARKER_STORED).write.mode("append").partitionBy("slot").json(location)
        spark.sql(f"CREATE TABLE gold.refreshes ({_columns(_MARKER_STORED)}) USING json PARTITIONED BY (slot) LOCATION '{location}'")
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(table.schema.names)} FROM {name}_slots "
        f"WHERE slot = (SELECT max(seq) % {SLOTS} FROM gold.refreshes)"
    )


def _create_whole_view(store: Store, name: str, table: Table) -> None:
    """Rows as written, and of compacted days those whose number has no folder of its own; see ``Store.whole``."""
    spark, columns, number = store.spark, ", ".join(table.stored.names), table.partition_names[-1]
    spark.sql(f"CREATE TABLE {name}_packed ({_columns(table.stored)}) USING parquet PARTITIONED BY (day) LOCATION '{store.root}/compact/catalog/{name}'")
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {name}_written UNION ALL "
        f"SELECT {columns} FROM {name}_packed p LEFT ANTI JOIN (SELECT DISTINCT day AS d, {number} AS n FROM {name}_written) w "
        f"ON p.day = w.d AND p.{number} = w.n"
    )


def refresh_layers(store: Store) -> None:
    """Registers what was written or compacted since the last call, so that the tables show it."""
    spark = store.spark
    parted = {_registered(n, t): bool(t.partitions) for n, t in TABLES.items()}
    for name, has_partitions in {**parted, "gold.refreshes": True}.items():
        if has_partitions:
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.sql(f"REFRESH TABLE {name}")
    for name in PACKED:
        for day, version in store.compacted(name).items():
            spark.sql(f"ALTER TABLE {name}_packed DROP IF EXISTS PARTITION (day = '{day}')")
            spark.sql(f"ALTER TABLE {name}_packed ADD PARTITION (day = '{day}') LOCATION '{store.compact_path(name, day, version)}'")
        spark.sql(f"REFRESH TABLE {name}_packed")


def check_layers(spark: SparkSession) -> None:
    """Fails unless the catalog holds every layer."""
    missing = [layer for layer in LAYERS if not spark.catalog.databaseExists(layer)]
    if missing:
        raise RuntimeError(f"Missing layers: {missing}, expected: {LAYERS}")
