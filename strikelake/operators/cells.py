"""Time cells: how ordered work (as-of joins, lags, trailing frames) is spread over tasks.

A window over ``(key, ordered by time)`` puts a whole key into one task. Here every key's timeline is
cut into cells and the window runs per ``(key, cell)``; whatever a cell needs from other cells travels
to it as a few extra rows (see asof.py, market.py, flow.py). Results do not depend on the cell width,
only the spread of the work does.

Cold keys use one-week cells. A key with more than ``max_rows`` rows gets the widest cell of CELL_WIDTHS
that keeps its densest hour's rate below ``max_rows`` per cell, so a key holding a third of all rows
becomes many tasks. The table of hot keys has at most ``rows / max_rows`` rows; it is stored, and broadcast
only while its size is below Spark's own limit.

A burst shorter than an hour counts with its hour's average, and no cell is narrower than a minute. Rows
without a key match nothing and must not enter a window (asof.py sends them round it).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from strikelake.functions.timeline import WEEK_SECONDS, epoch_seconds
from strikelake.sources.storage import as_table

# Every width divides seven days, so shifting a row by a week moves it by a whole number of cells.
# Those below a day divide a day, and neighbours differ by a factor of 7 at most, so cells stay near ``max_rows``; below an
# hour by 3 at most, as every cell of an instrument is handed 22 prints from before it, however few its own are.
CELL_WIDTHS = [WEEK_SECONDS, 86_400, 21_600, 3_600, 1_800, 600, 300, 120, 60]
#: A task sorts whole cells with about two helper rows to each row, twice: some 3 KB of memory per row of gold.
MAX_ROWS_PER_CELL = 100_000
#: Rows of the tape per task, on average, when cells are dealt over tasks.
ROWS_PER_TASK = 50_000

CELL, ROW = "__cell", "__row"
_WIDTH = "__width"


def cell_widths(streams: Sequence[DataFrame], by: str, ts: str = "timestamp",
                max_rows: int = MAX_ROWS_PER_CELL) -> DataFrame:
    """Hot keys of the given streams and their cell width: ``by``, ``__width`` (at most rows/max_rows rows)."""
    narrow = [s.selectExpr(by, f"floor({epoch_seconds(ts)} / 3600) AS __hour") for s in streams]
    hourly = reduce(DataFrame.unionByName, narrow).groupBy(by, "__hour").agg(F.count(F.lit(1)).alias("__n"))
    per_key = hourly.groupBy(by).agg(F.sum("__n").alias("__total"), F.max("__n").alias("__peak"))
    width = F.lit(CELL_WIDTHS[-1])
    for candidate in reversed(CELL_WIDTHS[:-1]):
        fits = F.col("__peak") * candidate <= F.lit(max_rows).cast("bigint") * 3600
        width = F.when(fits, candidate).otherwise(width)
    return per_key.filter(F.col("__total") > max_rows).select(by, width.cast("bigint").alias(_WIDTH))


def measure_cells(streams: Sequence[DataFrame], by: str, ts: str = "timestamp",
                  max_rows: int = MAX_ROWS_PER_CELL) -> DataFrame:
    """:func:`cell_widths` as a stored table: one narrow pass with partial sums, whatever the size.

    Being stored, its true size decides how it is joined later.
    """
    return as_table(cell_widths(streams, by, ts, max_rows), "cell_widths")


def task_count(tape: DataFrame) -> int:
    """Number of tasks over which the cells of ``tape`` are dealt; it follows the rows.

    Left to itself, Spark merges shuffled partitions up to a size in compressed bytes, and fewer, larger ones the more
    alike the rows are; sorted, they take many times that.
    """
    return max(tape.sparkSession.sparkContext.defaultParallelism, math.ceil(tape.count() / ROWS_PER_TASK))


def _located(df: DataFrame, by: str, widths: DataFrame | None) -> tuple[DataFrame, str]:
    """``df`` with each key's cell width at hand, and the SQL text of that width."""
    if widths is None:
        return df, f"{WEEK_SECONDS}L"
    return df.join(widths, by, "left"), f"coalesce({_WIDTH}, {WEEK_SECONDS}L)"


def _start(at: str, width: str) -> str:
    return f"floor({epoch_seconds(at)} / {width}) * {width}"


def in_cells(df: DataFrame, by: str, at: str, widths: DataFrame | None) -> DataFrame:
    """Add the ``__cell`` (its first second) of the time column ``at`` to every row.

    Keys not listed in ``widths`` are cold and get one-week cells.
    """
    located, width = _located(df, by, widths)
    return located.selectExpr(*df.columns, f"{_start(at, width)} AS {CELL}")


def trailing_week(ledger: DataFrame, by: str, sums: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Sums over the cells that lie fully inside the seven days before each cell: ``by``, cell, keep, outputs.

    ledger has one row per (``by``, cell); sums maps its columns to output names, NULL where no such cell is. It is
    stored first, as it is read three times. In two levels, so that a cell does not read the thousands before it: earlier cells of its day, the six
    whole days before, and of the day before those the later cells, all running sums or one row per day.
    The windows run per (``by``, day).
    """
    ledger = as_table(ledger, "ledger")
    day = f"floor({CELL} / 86400)"
    own = ledger.selectExpr(by, CELL, f"{day} AS __day", "1 AS __lane", *keep, *sums)
    aged = ledger.selectExpr(
        by, f"{CELL} + {WEEK_SECONDS} AS {CELL}", f"{day} + 7 AS __day", "0 AS __lane", *sums)
    whole = (
        ledger.selectExpr(by, f"explode(sequence({day} + 1, {day} + 6)) AS __day", *sums)
        .groupBy(by, "__day").agg(*[F.sum(c).alias(c) for c in sums])
        .selectExpr(by, f"CAST(NULL AS BIGINT) AS {CELL}", "__day", "2 AS __lane", *sums)
    )
    lanes = own.unionByName(aged, allowMissingColumns=True).unionByName(whole, allowMissingColumns=True)
    rows = "ROWS BETWEEN UNBOUNDED PRECEDING AND"
    parts = []
    for c, out in sums.items():
        per_day = f"PARTITION BY {by}, __day"
        before = (f"sum(CASE WHEN __lane <> 0 THEN {c} END) OVER "
                  f"({per_day} ORDER BY {CELL} ASC NULLS FIRST, __lane {rows} 1 PRECEDING)")
        after = (f"sum(CASE WHEN __lane = 0 THEN {c} END) OVER "
                 f"({per_day} ORDER BY {CELL} DESC NULLS LAST, __lane DESC {rows} 1 PRECEDING)")
        parts.append(f"CASE WHEN {before} IS NULL THEN {after} ELSE {before} + coalesce({after}, 0) END AS {out}")
    return lanes.selectExpr(by, CELL, "__lane", *keep, *parts).filter("__lane = 1").drop("__lane")


def packed(df: DataFrame, by: str) -> str:
    """SQL text of a struct holding every column but the key.

    Carried through windows and unions as one field: helper rows then hold one NULL instead of dozens, and
    operators copy one field. Every field should be used afterwards, or the optimizer unpacks the struct.
    """
    return f"struct({', '.join(c for c in df.columns if c != by)}) AS {ROW}"


def unpacked(df: DataFrame, by: str) -> list[str]:
    """Select list restoring the columns of ``df`` from its packed form, in order."""
    return [c if c == by else f"{ROW}.{c}" for c in df.columns]
