"""The package itself, for Python workers that do not have it installed."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of a session, once; Spark serves the archive to them."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix=f"{PACKAGE.name}-")
        context.addPyFile(shutil.make_archive(f"{folder}/{PACKAGE.name}", "zip", PACKAGE.parent, PACKAGE.name))
        _shipped.add(context.applicationId)
