"""Tables that cut lineage, kept in the folder that all executors share, and free column names."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_held = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary one of our own only in local mode, where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isEmpty():
            if not jsc.isLocal():
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="matchloom-"))
        root = jsc.getCheckpointDir().get()
    return root.rstrip("/")


@contextmanager
def scope() -> Iterator[None]:
    """Tables that are materialised inside go at its end, but for those marked ``outer``."""
    scopes = _held.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for table in scopes.pop():
            discard(table)


def claim(spark: SparkSession, suffix: str = "") -> str:
    """A new path in the shared folder; what is written there goes when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/matchloom-{uuid.uuid4().hex}{suffix}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def materialise(df: DataFrame, outer: bool = False) -> DataFrame:
    """Writes ``df`` once as Parquet in the shared folder and reads it back.

    A later stage that loses an executor rereads the files instead of recomputing. The files go when the
    innermost :func:`scope` ends (``outer``: the one around it), else when the driver's JVM ends, or earlier
    through :func:`discard`.
    """
    spark = df.sparkSession
    path = claim(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._matchloom_path = path
    scopes = _held.__dict__.get("scopes", [])
    level = len(scopes) - 1 - outer
    if level >= 0:
        scopes[level].append(out)
    return out


def discard(df: DataFrame) -> None:
    """Deletes a materialised table that no later plan reads."""
    path = getattr(df, "_matchloom_path", None)
    if path:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column of ``taken`` has it (letter case doesn't count)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name
