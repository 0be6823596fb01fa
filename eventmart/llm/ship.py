"""Makes the package importable in Python workers that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package's source to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="eventmart-"), "eventmart_src.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(top)))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark
