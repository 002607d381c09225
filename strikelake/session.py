"""Session settings the plans are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM does not compile methods above 8,000 bytes of bytecode (HotSpot's huge-method limit), and wide
# pricing projections can exceed that as one whole-stage method and then run interpreted. With this limit
# such a stage falls back to operator-at-a-time code, whose expressions are split into small methods.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# A shuffle into more than 200 partitions holds what its task has read, and 128 MB of alike rows are millions of them.
# Only where the session names no size of its own.
READ_SIZE = ("spark.sql.files.maxPartitionBytes", "32m")


def tuned(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS and READ_SIZE to a running session (all are runtime settings)."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if spark.conf.get(READ_SIZE[0], None) is None:
        spark.conf.set(*READ_SIZE)
    return spark
