"""Where intermediate tables go.

A stored table has a known size, so a join with it is a broadcast only below Spark's own limit
(spark.sql.autoBroadcastJoinThreshold) and a shuffled, skew-splittable join beyond: that is the size check behind
every small table here, and no broadcast is forced.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a local session without one gets a temporary."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    # "local-cluster[...]" is a cluster; "local" and "local[...]" are one process with one disk
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def as_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives lost executors, and lets later readers prune columns.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(*work: Callable[[], DataFrame]) -> list[DataFrame]:
    """Results of calls that store tables and do not need each other: their jobs share the cluster."""
    with ThreadPoolExecutor(len(work)) as pool:
        return [f.result() for f in [pool.submit(w) for w in work]]
