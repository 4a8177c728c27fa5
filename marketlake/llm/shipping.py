"""Sends the package to the executors, whose Python workers import it."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this application's executors the package, once, through Spark's own file server."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    folder = Path(tempfile.mkdtemp(prefix=f"{package.name}-"))
    shutil.copytree(package, folder / "src" / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(folder / package.name), "zip", folder / "src"))
    _SHIPPED.add(context.applicationId)
