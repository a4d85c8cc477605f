"""Tables between the steps of an operator, in the folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; without one a local session gets its own, a cluster is refused."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="matchloom-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet and read again: what is read several times isn't computed several times, and the files go when the driver's JVM ends."""
    sc = df.sparkSession.sparkContext
    at = f"{checkpoint_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    where = sc._jvm.org.apache.hadoop.fs.Path(at)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(where)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
