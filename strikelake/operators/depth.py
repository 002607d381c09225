"""Equi-depth cells: a key's timeline cut where its rows are, for work that only needs them in order.

Hours are counted once, in a narrow pass with partial sums. Keys of at most ``max_rows`` rows are one cell. A larger
key's hours are joined to cells of at most twice ``max_rows`` rows; an hour that alone holds more is cut at quantiles of
its times to the microsecond, from a mergeable sketch (KLL) of that hour's rows. A burst is therefore as many cells as
any other stretch with as many rows; only rows of one and the same microsecond cannot be parted.

The table of cells has one row per hour of the large keys. It is stored, so that its size decides how it is joined and
all readers see the same cuts. Frames that shift by a week need aligned cells and use cells.py.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from strikelake.functions.timeline import epoch_micros, epoch_seconds
from strikelake.operators.cells import CELL, MAX_ROWS_PER_CELL
from strikelake.sources.storage import as_table

#: Size parameter of the sketch of a busy hour: its rank error is below 0.1 %.
SKETCH_K = 4096
#: Quantiles that are read from it: an hour of one key becomes at most so many cells.
GRID = 1024
_HOUR, _START, _CUTS = "__hour", "__start", "__cuts"
HOUR_MICROS = 3_600_000_000


def _hour(ts: str) -> str:
    return f"floor({epoch_seconds(ts)} / 3600)"


def depth_cells(streams: Sequence[tuple[DataFrame, str]], by: str, max_rows: int = MAX_ROWS_PER_CELL) -> DataFrame:
    """``by``, hour, start and cuts (microseconds) of the hours of the keys with more than ``max_rows`` rows.

    streams: (frame, its time column) of everything that is to be placed. Null keys and times are left out.
    """
    narrow = [s.filter(f"{by} IS NOT NULL AND {ts} IS NOT NULL").selectExpr(by, f"{_hour(ts)} AS {_HOUR}") for s, ts in streams]
    hourly = reduce(DataFrame.unionByName, narrow).groupBy(by, _HOUR).agg(F.count(F.lit(1)).alias("__n"))
    earlier = f"(PARTITION BY {by} ORDER BY {_HOUR} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    counted = hourly.selectExpr(
        "*", f"sum(__n) OVER (PARTITION BY {by}) AS __total", f"coalesce(sum(__n) OVER {earlier}, 0) AS __before",
        f"count_if(__n > {max_rows}) OVER {earlier} AS __busy").filter(f"__total > {max_rows}")
    hours = as_table(counted.selectExpr(
        by, _HOUR, "__n",
        f"CASE WHEN __n > {max_rows} THEN {_HOUR} ELSE min(CASE WHEN __n <= {max_rows} THEN {_HOUR} END) OVER "
        f"(PARTITION BY {by}, __busy, floor(__before / {max_rows})) END * {HOUR_MICROS} AS {_START}"), "depth-hours")
    busy = hours.filter(F.col("__n") > max_rows)
    if busy.isEmpty():
        return hours.select(by, _HOUR, _START, F.array().cast("array<bigint>").alias(_CUTS))
    times = [s.selectExpr(by, f"{_hour(ts)} AS {_HOUR}", f"{epoch_micros(ts)} AS __t") for s, ts in streams]
    sketches = reduce(DataFrame.unionByName, times).join(busy.select(by, _HOUR), [by, _HOUR]).groupBy(by, _HOUR).agg(
        F.kll_sketch_agg_bigint("__t", F.lit(SKETCH_K)).alias("__sketch"))
    grid = F.kll_sketch_get_quantile_bigint("__sketch", F.array(*[F.lit(i / GRID) for i in range(1, GRID)]))
    parts = f"least(cast(ceil(__n / {max_rows}) AS int), {GRID})"
    cuts = busy.join(sketches, [by, _HOUR]).select(by, _HOUR, "__n", grid.alias("__grid")).selectExpr(
        by, _HOUR, f"array_sort(array_distinct(transform(sequence(1, {parts} - 1), "
        f"i -> __grid[cast(floor(i * {GRID} / {parts}) AS int) - 1]))) AS {_CUTS}")
    return as_table(hours.join(cuts, [by, _HOUR], "left").select(
        by, _HOUR, _START, F.coalesce(_CUTS, F.array().cast("array<bigint>")).alias(_CUTS)), "depth-cells")


def in_depth_cells(df: DataFrame, by: str, at: str, cells: DataFrame) -> DataFrame:
    """Add the cell (the microsecond at which it starts) of the time column ``at``; NULL for the one cell of a small key."""
    timed = df.selectExpr("*", f"{_hour(at)} AS {_HOUR}").join(cells, [by, _HOUR], "left")
    inside = f"array_max(filter({_CUTS}, c -> c <= {epoch_micros(at)}))"
    return timed.selectExpr(
        *df.columns, f"CASE WHEN size({_CUTS}) > 0 THEN coalesce({inside}, {_START}) ELSE {_START} END AS {CELL}")


def all_cells(cells: DataFrame, by: str) -> DataFrame:
    """(``by``, cell) of every cell of the large keys: about one row per ``max_rows`` rows."""
    return cells.select(by, F.explode(F.concat(F.array(_START), _CUTS)).alias(CELL)).distinct()
