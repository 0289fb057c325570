"""Small files of the store's state: listing, reading, and creating a file that only one of many may create.

Data never passes through here; tables are read and written by Spark. All paths reach whatever
file system Spark reaches. Creating without overwriting is atomic on HDFS and its like, and on local
folders; a store that has no such operation must be given another place for its claims.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder has this path, which may hold wildcards."""
    system, place = _system(spark, pattern)
    found = system.globStatus(place)
    return found is not None and len(found) > 0


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    system, place = _system(spark, folder)
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def create(spark: SparkSession, path: str, text: str = "") -> bool:
    """Creates a file with this text unless it is there already; of many that try at once one succeeds."""
    system, place = _system(spark, path)
    full = system.makeQualified(place).toUri()
    if full.getScheme() == "file":
        # The local file system's own call looks first and creates then.
        local = full.getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            handle = os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644)
        except FileExistsError:
            return False
        with os.fdopen(handle, "w") as out:
            out.write(text)
        return True
    try:
        out = system.create(place, False)
    except Exception:
        if system.exists(place):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def age(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file was written or touched; None if it isn't there."""
    system, place = _system(spark, path)
    if not system.exists(place):
        return None
    return time.time() - system.getFileStatus(place).getModificationTime() / 1000


def touch(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.setTimes(place, int(time.time() * 1000), -1)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.delete(place, True)


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.mkdirs(place)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder; the target must not be there."""
    system, place = _system(spark, source)
    _, to = _system(spark, target)
    if not system.rename(place, to):
        raise OSError(f"{source} could not be moved to {target}")
