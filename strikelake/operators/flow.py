"""Instrument-level trailing flow: 7-day volume and premium, Roll spread inputs.

Same layout as market.py: one shuffle of the full rows by (instrument, cell), with narrow helper rows.
``halo`` rows are the last 22 prints before the cell, which is all a 21-row frame of lagged price changes
can look back to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strikelake.functions.metrics import roll_spread
from strikelake.functions.timeline import DAY_SECONDS, WEEK_SECONDS
from strikelake.operators.cells import CELL, ROW, in_cells, packed, task_count, trailing_week, unpacked

# Fixed value: the covariance frame is the current print and the 20 before it.
FRAME_PRECEDING = 20
_HALO_ROWS = FRAME_PRECEDING + 2
# Groups of cells in the scan for the prints before a cell: 46,080 cells of a minute at most.
_SPANS = [32 * DAY_SECONDS]

_HEAD, _HALO, _OWN, _OLD = 0, 1, 2, 3
_NAME = "instrument_name"
_ORDER = ["timestamp", "trade_seq", "trade_id"]
_KEY = f"{_NAME}, {CELL}"


def _heads(placed: DataFrame) -> DataFrame:
    """Per (instrument, cell): count and premium of the cells lying fully inside the trailing week."""
    ledger = placed.groupBy(_NAME, CELL).agg(F.expr("count(1) AS n"), F.expr("sum(price * amount) AS pv"))
    summed = trailing_week(ledger, _NAME, {"n": "__n", "pv": "__pv"})
    return summed.selectExpr(_NAME, CELL, f"{_HEAD} AS __lane", "__n", "__pv").filter("__n IS NOT NULL")


def _newest(rows: DataFrame, unit: str) -> DataFrame:
    """The last prints of every (instrument, unit). The bound is applied before the shuffle as well (window group limit)."""
    order = ", ".join(c + " DESC" for c in _ORDER)
    return rows.selectExpr("*", f"row_number() OVER (PARTITION BY {_NAME}, {unit} ORDER BY {order}) AS k").filter(
        f"k <= {_HALO_ROWS}").drop("k")


def _before(newest: DataFrame, unit: str, spans: list[int]) -> DataFrame:
    """The last prints before each (instrument, unit), from the last prints of each unit: a prefix scan over a tree.

    The state of a stretch of time is its last 22 prints, and that of two stretches the last 22 of both. Units are grouped
    by the first of ``spans`` (seconds); what lies before a group comes from the scan over groups, as rows ahead
    of the group's own. So a window holds the units of one group, and the one at the root of the tree 22 prints per widest span.
    """
    lane, group = newest, _NAME
    if spans:
        parent = f"__span{spans[0]}"
        lane, group = newest.selectExpr("*", f"floor({unit} / {spans[0]}) * {spans[0]} AS {parent}"), f"{_NAME}, {parent}"
        carried = _before(_newest(lane.drop(unit), parent), parent, spans[1:])
        lane = lane.unionByName(carried, allowMissingColumns=True)
    timeline = f"PARTITION BY {group} ORDER BY {', '.join(_ORDER)}"
    print_row = f"struct({', '.join(_ORDER)}, price)"
    return (
        lane.selectExpr(
            _NAME, unit, f"lag({unit}) OVER ({timeline}) AS before",
            f"collect_list({print_row}) OVER ({timeline} ROWS BETWEEN {_HALO_ROWS} PRECEDING AND 1 PRECEDING) AS prior")
        .filter(f"{unit} IS NOT NULL AND NOT (before <=> {unit})")
        .selectExpr(_NAME, unit, "inline(prior)")
    )


def _halos(placed: DataFrame) -> DataFrame:
    """Per (instrument, cell): the last prints of the instrument before the cell."""
    newest = _newest(placed.select(_NAME, CELL, *_ORDER, "price"), CELL)
    return _before(newest, CELL, _SPANS).selectExpr(
        _NAME, CELL, f"{_HALO} AS __lane", "timestamp AS __at", "trade_seq AS __seq", "trade_id AS __id", "price AS __price")


def flow_heads(tape: DataFrame, widths: DataFrame | None = None) -> DataFrame:
    """What each (instrument, cell) needs from other cells but its last prints; a stored ledger lies beneath it."""
    return _heads(in_cells(tape.select(_NAME, "timestamp", "price", "amount"), _NAME, "timestamp", widths))


def trade_flow(rows: DataFrame, widths: DataFrame | None = None, tape: DataFrame | None = None,
               heads: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Add trade_volume_7day, actual_premium_collected and bid_ask_spread_estimate (Roll 1984).

    ``tape`` holds the same prints as ``rows`` (default) in a form cheaper to read again; ``heads`` is flow_heads of it,
    where that was worked out before. The cells are dealt over ``tasks`` (default: as many as its rows ask for).
    """
    tape = (rows if tape is None else tape).select(_NAME, *_ORDER, "price", "amount")
    tasks = tasks or task_count(tape)
    heads = flow_heads(tape, widths) if heads is None else heads
    placed = in_cells(tape, _NAME, "timestamp", widths)
    old = in_cells(
        tape.selectExpr(_NAME, f"{_OLD} AS __lane", f"timestamp + INTERVAL {WEEK_SECONDS} SECONDS AS __at",
                        "1L AS __n", "price * amount AS __pv"),
        _NAME, "__at", widths)
    own = in_cells(rows.selectExpr(
        _NAME, f"{_OWN} AS __lane", "timestamp AS __at", "trade_seq AS __seq", "trade_id AS __id",
        "price AS __price", "1L AS __n", "price * amount AS __pv", packed(rows, _NAME),
    ), _NAME, "__at", widths)
    lanes = own
    for extra in (old, heads, _halos(placed)):
        lanes = lanes.unionByName(extra, allowMissingColumns=True)
    # One exchange: every window below clusters on these two columns or more.
    lanes = lanes.selectExpr("*", f"__lane = {_OLD} AS __past").repartition(tasks, _NAME, CELL)

    path = f"PARTITION BY {_KEY}, __past ORDER BY __at ASC NULLS FIRST, __seq, __id"
    frame = f"({path} ROWS BETWEEN {FRAME_PRECEDING} PRECEDING AND CURRENT ROW)"
    peers = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    up = f"(PARTITION BY {_KEY}, __past ORDER BY __at ASC NULLS FIRST {peers})"
    down = f"(PARTITION BY {_KEY} ORDER BY __at DESC NULLS LAST {peers})"
    changes = lanes.selectExpr(
        "*", f"lag(__price, 1) OVER ({path}) AS __l1", f"lag(__price, 2) OVER ({path}) AS __l2",
    ).selectExpr("*", "__price - __l1 AS __dp", "__l1 - __l2 AS __dq")
    # Helper rows of the halo carry no volume, so they leave the running sums alone.
    entering = changes.selectExpr(
        ROW, "__lane", "__at", "__past", "__n", "__pv", _NAME, CELL,
        f"covar_pop(__dp, __dq) OVER {frame} AS __cov", f"count(__dp) OVER {frame} AS __obs",
        f"sum(__n) OVER {up} AS __up_n", f"sum(__pv) OVER {up} AS __up_pv",
    )
    summed = entering.selectExpr(
        _NAME, ROW, "__lane", "__cov", "__obs",
        f"coalesce(__up_n, 0) + coalesce(sum(CASE WHEN __past THEN __n END) OVER {down}, 0) AS __volume",
        f"coalesce(__up_pv, 0e0) + coalesce(sum(CASE WHEN __past THEN __pv END) OVER {down}, 0e0) AS __premium",
    )
    return summed.filter(f"__lane = {_OWN}").select(
        *unpacked(rows, _NAME), F.col("__volume").alias("trade_volume_7day"), F.col("__premium").alias("actual_premium_collected"),
        roll_spread(F.col("__cov"), F.col("__obs")).alias("bid_ask_spread_estimate"),
    )
