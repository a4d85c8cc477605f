"""Sends this package to the executors' Python workers, once for each Spark application."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Executors may start in any folder, so the package travels as a zip from the driver."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    target = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(top)))
    spark.sparkContext.addPyFile(target)
    _sent.add(app)
