"""Closed days rewritten into few files.

A stream with a batch every 30 seconds leaves 2,880 folders a day and table. Compaction writes a
day's rows, in order of their number and id, to a few files beside the table, makes them count by
creating one small file, and only then takes the day's own folders away, each in one move.
Readers (``Store.whole``) use a number's own folder where there is one and the compacted rows
where not, so they see every row once at any moment, and a compaction that breaks off does no harm:
what it wrote either counts or is written anew by the next one.
"""

from __future__ import annotations

from datetime import date, datetime
from uuid import uuid4

from tickloom.functions.casts import as_utc
from tickloom.sources import files
from tickloom.sources.tables import TABLES, Store

# The part of the store that writers of a table hold.
PARTS = {"bronze.ticker_raw": "ingest", "silver.ticker": "silver", "gold.hourly_states": "silver", "gold.window_aggregations": "windows"}
#: Rows of a compacted file at most, about; ticks are some 100 bytes each when packed.
FILE_ROWS = 2_000_000
#: Folders of a day from which it is worth a compaction.
LEAST_FOLDERS = 2


def closed_days(store: Store, name: str, as_of: datetime | str) -> list[date]:
    """Days before that of the clock that still have folders of their own."""
    today = as_utc(as_of).date()
    days = [date.fromisoformat(n.removeprefix("day=")) for n in files.names(store.spark, store.path(name)) if n.startswith("day=")]
    return sorted(d for d in days if d < today)


def compact_day(store: Store, name: str, day: date, file_rows: int = FILE_ROWS) -> int:
    """Compacts one day of a table; the number of folders that went. Call it while no writer of the table is at work."""
    spark, own = store.spark, f"{store.path(name)}/day={day}"
    folders = [n for n in files.names(spark, own) if "=" in n]
    version = store.compacted(name).get(day.isoformat(), 0) + 1
    target = store.compact_path(name, day.isoformat(), version)
    rows, number = store.whole(name, [day]), TABLES[name].partition_names[-1]
    order = [number, *[c for c in ("id", "window_start", "symbol") if c in rows.columns]]
    n_files = max(1, -(-rows.count() // file_rows))
    rows.repartitionByRange(n_files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(target)
    files.create(spark, f"{store.root}/state/compacted/{name}/{day}={version}")
    _drop_folders(store, own, folders)
    if version > 1:
        files.delete(spark, f"{store.root}/state/compacted/{name}/{day}={version - 1}")
        files.delete(spark, store.compact_path(name, day.isoformat(), version - 1))
    return len(folders)


def _drop_folders(store: Store, own: str, folders: list[str]) -> None:
    """Takes folders out of the table in one move each, then deletes them; what others left behind half-way goes too."""
    spark, away = store.spark, f"{store.root}/state/away"
    for folder in folders:
        target = f"{away}/{uuid4().hex}/{folder}"
        files.make_folder(spark, target.rsplit("/", 1)[0])
        files.move(spark, f"{own}/{folder}", target)
    files.delete(spark, away)
    if not [n for n in files.names(spark, own) if "=" in n]:
        files.delete(spark, own)


def compact(store: Store, as_of: datetime | str, file_rows: int = FILE_ROWS) -> dict[str, int]:
    """Compacts all closed days of the tables that streams and cycles append to; folders gone, by table."""
    gone: dict[str, int] = {}
    for name, part in PARTS.items():
        for day in closed_days(store, name, as_of):
            with store.exclusive(part):
                if len(files.names(store.spark, f"{store.path(name)}/day={day}")) >= LEAST_FOLDERS:
                    gone[name] = gone.get(name, 0) + compact_day(store, name, day, file_rows)
    return gone
