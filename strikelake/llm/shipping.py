"""Bringing this package to the executors, which need not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from functools import wraps
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the application's Python files, once; Spark serves them to its executors."""
    context = spark.sparkContext
    if context.applicationId in _shipped or not ROOT.is_dir():
        return
    path = f"{tempfile.mkdtemp(prefix='spark-')}/{ROOT.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(ROOT.rglob("*.py")):
            z.write(source, source.relative_to(ROOT.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def shipped(run):
    """A query or stage (first argument: the session) that ships the package first."""
    @wraps(run)
    def with_package(spark, *args):
        ship(spark)
        return run(spark, *args)

    return with_package
