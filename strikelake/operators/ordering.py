"""Order that a table carries itself: the position of every row, without one task that holds them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from strikelake.sources.storage import as_table

_SPOT = "__spot"
# monotonically_increasing_id has the partition above this bit and the place in it below.
_PLACE_BITS = 33


def positioned(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """``df`` with the 1-based position of every row in ``order`` (ascending, nulls first).

    Rows are range-partitioned and sorted once; a partition's rows number themselves, and only one count per partition is
    added up for the offsets. The partitioned rows are stored, so that a lost task is not sampled and cut anew
    between the two. Rows that are equal in ``order`` come in any order: name enough columns.
    """
    placed = as_table(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        _SPOT, F.monotonically_increasing_id()), "positions")
    part = F.shiftright(_SPOT, _PLACE_BITS)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: as many as tasks, never as many as rows
    offsets = F.broadcast(counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")))
    place = F.col(_SPOT).bitwiseAND((1 << _PLACE_BITS) - 1)
    return placed.withColumn("__part", part).join(offsets, "__part").select(
        *df.columns, (F.col("__offset") + place + 1).alias(out))
