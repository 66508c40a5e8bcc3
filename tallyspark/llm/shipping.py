"""Makes this package importable in Spark's Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tallyspark

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package's sources to the executors, once per application.

    Spark serves the archive from the driver; nothing is needed where the package is installed on
    every machine, but it does no harm there.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.abspath(tallyspark.__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="tallyspark-ship-"), "tallyspark.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark
