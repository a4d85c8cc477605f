"""Tables that change: versions behind an atomic pointer, and parts that a broken run goes on with.

A version is a folder of Parquet files that nobody writes to again. It counts once a small file named by its number holds that folder's name: the file is
created only if there is none, so of two writers of one number one fails, and a writer that dies before has changed nothing. A pointer that was
created but not written counts as none. Any Hadoop file system with an exclusive create will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

POINTERS = "_versions"


class StaleVersion(RuntimeError):
    """Somebody else has published since this version was read."""


def _files(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Numbers of all pointers, and the folders they name ("" while unwritten)."""
    path, files = _files(spark, folder)
    where = path(folder, POINTERS)
    if not files.exists(where):
        return []
    out = []
    for f in files.listStatus(where):
        name = f.getPath().getName()
        if not name.isdigit():
            continue
        stream = files.open(f.getPath())
        try:
            out.append((int(name), bytes(stream.readNBytes(64)).decode()))
        finally:
            stream.close()
    return sorted(out)


def current_version(spark: SparkSession, folder: str) -> int:
    """The newest published number; 0 if none is."""
    return max((n for n, data in _pointers(spark, folder) if len(data) == 32), default=0)


def read_version(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame | None:
    """A version's rows, by default the newest's; None if there is none."""
    found = {n: data for n, data in _pointers(spark, folder) if len(data) == 32}
    data = found.get(max(found, default=0) if version is None else version)
    return spark.read.parquet(f"{folder}/{data}") if data else None


def publish(df: DataFrame, folder: str, after: int | None = None) -> int:
    """Writes ``df`` as the next version and returns its number. ``after``: the version that ``df`` was made from (by default the newest
    now); if a newer one has appeared, :class:`StaleVersion` is raised and nothing changes. ``df`` may read the folder itself."""
    spark = df.sparkSession
    base = current_version(spark, folder) if after is None else after
    data = uuid.uuid4().hex
    df.write.parquet(f"{folder}/{data}")
    path, files = _files(spark, folder)
    known = _pointers(spark, folder)
    if any(n > base and len(d) == 32 for n, d in known):
        files.delete(path(folder, data), True)
        raise StaleVersion(f"{folder}: version {base} is no longer the newest")
    # numbers of pointers that were never written stay unused
    number = max([base, *(n for n, _ in known)]) + 1
    try:
        out = files.create(path(path(folder, POINTERS), f"{number:012d}"), False)
    except Exception as error:  # Py4J wraps the file system's "already exists"
        files.delete(path(folder, data), True)
        raise StaleVersion(f"{folder}: version {number} was taken meanwhile") from error
    try:
        out.write(bytearray(data.encode()))
    finally:
        out.close()
    return number


def read_parts(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.parquet(folder)
    except AnalysisException:  # nothing there yet
        return None


def fetch_missing(wanted: DataFrame, folder: str, keys: list[str], fetch: Callable[[DataFrame], DataFrame], force: bool = False) -> DataFrame | None:
    """All parts of ``wanted`` (one row a combination of ``keys``, dates and groups say): those that ``folder`` has are kept, the others are fetched.

    A part is a partition folder, which is replaced whole: a run that dies leaves whole parts only, and the next goes on with the rest.
    A part without rows leaves nothing and is asked for again. ``force``: fetch all anew.
    """
    spark = wanted.sparkSession
    done = None if force else read_parts(spark, folder)
    asked = wanted.select(*keys).distinct()
    if done is not None:
        same = [done[k].cast(wanted.schema[k].dataType).alias(k) for k in keys]
        asked = asked.join(done.select(*same).distinct(), keys, "left_anti")
    fetch(asked).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(folder)
    return read_parts(spark, folder)
