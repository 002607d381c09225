"""As-of joins: nearest row at or before (``backward``) / at or after (``forward``) each left row.

Both sides are laid on one timeline per key and read with a single ordered window: one shuffle, no
inequality join, at most one match per left row. Ties on the right side's timestamp are settled by
``tie`` (highest wins backward, lowest wins forward). Timelines of large keys are cut into equi-depth
cells (depth.py); the nearest row outside a cell travels to it as one narrow row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from strikelake.operators.cells import CELL, MAX_ROWS_PER_CELL, ROW, packed, unpacked
from strikelake.operators.depth import all_cells, depth_cells, in_depth_cells

_AT, _SIDE, _HIT = "__at", "__side", "__hit"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_at: str,
    right_at: str,
    take: dict[str, str],
    tie: Sequence[str] = (),
    direction: str = "backward",
    tolerance_seconds: int | None = None,
    max_rows_per_cell: int = MAX_ROWS_PER_CELL,
    tasks: int | None = None,
) -> DataFrame:
    """LEFT as-of join; every left row is kept once.

    take: right column -> output column. With a tolerance, a match further away than that (exclusive of the
    bound itself) gives NULL. Left rows without a key or a time match nothing and go round the window. The cells are
    dealt over ``tasks`` (default: as Spark merges them, by compressed size).
    """
    backward = direction == "backward"
    if not backward and direction != "forward":
        raise ValueError(f"direction must be 'backward' or 'forward', not {direction!r}")
    ties = [f"__tie{i}" for i in range(len(tie))]
    fields = ", ".join([f"'at', {right_at}", *[f"'{o}', {c}" for c, o in take.items()]])
    narrow = right.filter(f"{by} IS NOT NULL AND {right_at} IS NOT NULL").selectExpr(
        by, f"{right_at} AS {_AT}", f"0 AS {_SIDE}", *[f"{c} AS {t}" for c, t in zip(tie, ties)],
        f"named_struct({fields}) AS {_HIT}",
    )
    cells = depth_cells([(left.select(by, left_at), left_at), (narrow.select(by, _AT), _AT)], by, max_rows_per_cell)
    keyed = f"{by} IS NOT NULL AND {left_at} IS NOT NULL"
    keyless = left.filter(f"NOT ({keyed})").select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(o)
                                                         for c, o in take.items()])
    lefts = in_depth_cells(
        left.filter(keyed).selectExpr(by, f"{left_at} AS {_AT}", f"1 AS {_SIDE}", packed(left, by)), by, _AT, cells)
    placed = in_depth_cells(narrow, by, _AT, cells)
    rights = placed.unionByName(_carries(placed, cells, by, ties, backward), allowMissingColumns=True)

    # A right row precedes a left row of the same instant in reading order, so equal times match.
    way = "ASC" if backward else "DESC"
    order = ", ".join([f"{_AT} {way} NULLS FIRST", _SIDE, *[f"{t} {way}" for t in ties]])
    lanes = lefts.unionByName(rights, allowMissingColumns=True)
    if tasks is not None:
        lanes = lanes.repartition(tasks, by, CELL)  # the one exchange: the window clusters on these two columns
    matched = lanes.selectExpr(
        by, ROW, _AT, _SIDE,
        f"last({_HIT}) IGNORE NULLS OVER (PARTITION BY {by}, {CELL} ORDER BY {order} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {_HIT}",
    ).filter(f"{_SIDE} = 1")
    near = "TRUE"
    if tolerance_seconds is not None:
        test = f">= {_AT} -" if backward else f"<= {_AT} +"
        near = f"{_HIT}.at {test} INTERVAL {tolerance_seconds} SECONDS"
    found = matched.selectExpr(
        *unpacked(left, by), *[f"CASE WHEN {near} THEN {_HIT}.{o} END AS {o}" for o in take.values()])
    return found.unionByName(keyless)


def _from_outside(edges: DataFrame, cells: DataFrame, by: str, backward: bool) -> DataFrame:
    """Per cell of a large key the edge nearest to it from outside; there are about rows / max_rows of these cells."""
    order = F.col(CELL).asc() if backward else F.col(CELL).desc()
    outside = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    every = all_cells(cells, by).join(edges, [by, CELL], "left")
    return every.select(by, CELL, F.last("__edge", ignorenulls=True).over(outside).alias(_HIT)).filter(f"{_HIT} IS NOT NULL")


def _carries(placed: DataFrame, cells: DataFrame, by: str, ties: list[str], backward: bool) -> DataFrame:
    """One row per cell of a large key: the right row nearest to the cell from outside it."""
    rank = F.struct(F.col(_AT), *[F.col(t) for t in ties])
    edge = F.max_by(_HIT, rank) if backward else F.min_by(_HIT, rank)
    edges = placed.filter(f"{CELL} IS NOT NULL").groupBy(by, CELL).agg(edge.alias("__edge"))
    return _from_outside(edges, cells, by, backward).selectExpr(
        by, CELL, f"CAST(NULL AS TIMESTAMP_NTZ) AS {_AT}", f"0 AS {_SIDE}", _HIT)


def previous_row(rows: DataFrame, by: str, order: Sequence[str], take: dict[str, str],
                 max_rows_per_cell: int = MAX_ROWS_PER_CELL) -> DataFrame:
    """LAG(1) per key in ``order`` (first entry is the timestamp), spread over equi-depth cells.

    take: column -> name for its value on the previous row.
    """
    fields = ", ".join(f"'{o}', {c}" for c, o in take.items())
    sequence = ", ".join(order)
    cells = depth_cells([(rows.select(by, order[0]), order[0])], by, max_rows_per_cell)
    placed = in_depth_cells(rows.selectExpr(
        by, *order, f"1 AS {_SIDE}", f"named_struct({fields}) AS {_HIT}", packed(rows, by),
    ), by, order[0], cells)
    edges = placed.filter(f"{CELL} IS NOT NULL").groupBy(by, CELL).agg(
        F.expr(f"max_by({_HIT}, struct({sequence}))").alias("__edge"))
    heads = _from_outside(edges, cells, by, backward=True).selectExpr(by, CELL, f"0 AS {_SIDE}", _HIT)
    return placed.unionByName(heads, allowMissingColumns=True).selectExpr(
        by, ROW, _SIDE,
        f"lag({_HIT}) OVER (PARTITION BY {by}, {CELL} ORDER BY {_SIDE}, {sequence}) AS __previous",
    ).filter(f"{_SIDE} = 1").selectExpr(
        *unpacked(rows, by), *[f"__previous.{o} AS {o}" for o in take.values()])
