"""Currency-level market state: log return, 7-day realized vol, vol-index as-of, 7-day-ahead price.

All four need a currency's prints in time order. One shuffle of the full rows by (currency, cell) serves
them together; narrow helper rows share the cell:

* ``old``  - the print of exactly seven days earlier, for the part of the 7-day frame that starts inside
             a cell;
* ``next`` - the print of seven days later, for the forward price;
* ``vol``  - vol-index readings;
* ``head`` - one row per cell with everything carried from other cells (last price before the cell, sums
             over the cells fully inside the frame, ...), from a ledger with one row per (currency, cell).

The trailing frame is therefore own rows up to now + whole cells + old rows still inside, each a running
sum: linear work, and sums are only ever added, never subtracted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from strikelake.functions.timeline import WEEK_SECONDS
from strikelake.operators.cells import CELL, ROW, in_cells, packed, task_count, trailing_week, unpacked

# Fixed value: hourly observations per year, the annualization of realized_vol_7day.
ANNUALIZATION = math.sqrt(365 * 24)

_HEAD, _VOL, _OLD, _OWN, _NEXT = 0, 1, 2, 3, 4
_RANK = "timestamp, trade_seq, trade_id"
_KEY = f"currency, {CELL}"


def sample_stddev(n: Column, total: Column, squares: Column) -> Column:
    """STDDEV_SAMP from count, sum and sum of squares; NULL below two observations."""
    spread = F.try_divide(squares - F.try_divide(total * total, n), n - 1)
    return F.when(n >= 2, F.sqrt(F.greatest(spread, F.lit(0.0))))


def _log_ratio(price: str, previous: str) -> str:
    return f"CASE WHEN {price} > 0 AND {previous} > 0 THEN ln(try_divide({price}, {previous})) END"


def _ledger(tape: DataFrame, vol_index: DataFrame, widths: DataFrame | None, tasks: int) -> DataFrame:
    """One row per (currency, cell) that has prints, with what the cell needs from other cells."""
    previous = f"lag(futures_price) OVER (PARTITION BY {_KEY} ORDER BY {_RANK})"
    cells = (
        in_cells(tape, "currency", "timestamp", widths).repartition(tasks, "currency", CELL)
        .selectExpr("*", f"{previous} AS previous")
        .selectExpr("*", f"{_log_ratio('futures_price', 'previous')} AS r")
        .groupBy("currency", CELL)
        .agg(
            F.expr("count(r) AS n"), F.expr("sum(r) AS s"), F.expr("sum(r * r) AS q"),
            F.expr(f"min_by(futures_price, struct({_RANK})) AS first_price"),
            F.expr(f"max_by(futures_price, struct({_RANK})) AS last_price"),
        )
    )
    readings = (
        in_cells(vol_index.select("currency", "timestamp", "volatility_value"), "currency", "timestamp", widths)
        .groupBy("currency", CELL).agg(F.expr("max_by(volatility_value, timestamp) AS last_vol"))
    )
    by_cell = f"PARTITION BY currency ORDER BY {CELL}"
    before = f"({by_cell} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    week_before = f"({by_cell} RANGE BETWEEN UNBOUNDED PRECEDING AND {WEEK_SECONDS + 1} PRECEDING)"
    week_after = f"({by_cell} DESC RANGE BETWEEN UNBOUNDED PRECEDING AND {WEEK_SECONDS + 1} PRECEDING)"
    # The first return of a cell reaches back to the previous one.
    carried = (
        cells.join(readings, ["currency", CELL], "full_outer")
        .selectExpr("*", f"last(last_price) IGNORE NULLS OVER {before} AS head_price")
        .selectExpr("*", f"{_log_ratio('first_price', 'head_price')} AS edge")
        .selectExpr(
            "currency", CELL, "head_price", "first_price",
            "coalesce(n, 0) + CASE WHEN edge IS NULL THEN 0 ELSE 1 END AS n",
            "coalesce(s, 0e0) + coalesce(edge, 0e0) AS s",
            "coalesce(q, 0e0) + coalesce(edge * edge, 0e0) AS q",
            f"last(last_vol) IGNORE NULLS OVER {before} AS head_vol",
            f"last(last_price) IGNORE NULLS OVER {week_before} AS head_old",
            f"last(first_price) IGNORE NULLS OVER {week_after} AS head_next",
        )
    )
    summed = trailing_week(
        carried, "currency", {"n": "head_n", "s": "head_s", "q": "head_q"},
        keep=["head_price", "first_price", "head_vol", "head_old", "head_next"])
    return summed.filter("first_price IS NOT NULL").drop("first_price")


def _case(**by_lane: str) -> str:
    codes = {"head": _HEAD, "vol": _VOL, "old": _OLD, "own": _OWN, "next": _NEXT}
    return "CASE __lane " + " ".join(f"WHEN {codes[n]} THEN {v}" for n, v in by_lane.items()) + " END"


def market_heads(tape: DataFrame, vol_index: DataFrame, widths: DataFrame | None = None,
                 tasks: int | None = None) -> DataFrame:
    """What each (currency, cell) needs from other cells; a stored ledger lies beneath it."""
    tasks = tasks or task_count(tape)
    prints = tape.select("currency", "timestamp", "trade_seq", "trade_id", "futures_price")
    return _ledger(prints, vol_index, widths, tasks).selectExpr("*", f"{_HEAD} AS __lane")


def market_state(rows: DataFrame, vol_index: DataFrame, widths: DataFrame | None = None,
                 tape: DataFrame | None = None, heads: DataFrame | None = None,
                 tasks: int | None = None) -> DataFrame:
    """Add log_return, realized_vol_7day, exchange_realized_vol and forward_futures_price.

    ``rows`` must have currency, timestamp, trade_seq, trade_id and a non-null futures_price. Order within
    a currency is (timestamp, trade_seq, trade_id); the 7-day frame is inclusive and counts peers.
    ``tape`` holds the same prints as ``rows`` (default) in a form cheaper to read again; ``heads`` is market_heads of
    it, where that was worked out before. The cells are dealt over ``tasks`` (default: as many as its rows ask for).
    """
    tape = (rows if tape is None else tape).select("currency", "timestamp", "trade_seq", "trade_id", "futures_price")
    tasks = tasks or task_count(tape)
    week = f"INTERVAL {WEEK_SECONDS} SECONDS"
    echoes = in_cells(
        tape.selectExpr(
            "currency", "trade_seq AS __seq", "trade_id AS __id", "futures_price AS __price",
            f"inline(array(struct({_OLD} AS __lane, timestamp + {week} AS __at), "
            f"struct({_NEXT} AS __lane, timestamp - {week} AS __at)))",
        ), "currency", "__at", widths)
    readings = in_cells(
        vol_index.selectExpr("currency", f"{_VOL} AS __lane", "timestamp AS __at", "volatility_value AS __vol"),
        "currency", "__at", widths)
    heads = market_heads(tape, vol_index, widths, tasks) if heads is None else heads
    own = in_cells(rows.selectExpr(
        "currency", f"{_OWN} AS __lane", "timestamp AS __at", "trade_seq AS __seq", "trade_id AS __id",
        "futures_price AS __price", packed(rows, "currency"),
    ), "currency", "__at", widths)
    lanes = own
    for extra in (echoes, readings, heads):
        lanes = lanes.unionByName(extra, allowMissingColumns=True)
    # One exchange: every window below clusters on these two columns.
    lanes = lanes.repartition(tasks, "currency", CELL)

    up = f"PARTITION BY {_KEY} ORDER BY __at ASC NULLS FIRST, __lane, __seq, __id"
    down = f"PARTITION BY {_KEY} ORDER BY __at DESC NULLS FIRST, __lane DESC, __seq DESC, __id DESC"
    earlier = f"({up} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    so_far = f"({up} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    later = f"({down} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    peers = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    up_peers = f"(PARTITION BY {_KEY} ORDER BY __at ASC NULLS FIRST {peers})"
    down_peers = f"(PARTITION BY {_KEY} ORDER BY __at DESC NULLS FIRST {peers})"
    one = "CASE WHEN __r IS NULL THEN 0 ELSE 1 END"

    stepped = lanes.selectExpr(
        "*",
        f"last({_case(head='head_price', own='__price')}) IGNORE NULLS OVER {earlier} AS __p",
        f"last({_case(head='head_old', old='__price')}) IGNORE NULLS OVER {earlier} AS __o",
        f"last({_case(head='head_vol', vol='__vol')}) IGNORE NULLS OVER {so_far} AS __v",
    ).selectExpr("*", f"{_case(own=_log_ratio('__price', '__p'), old=_log_ratio('__price', '__o'))} AS __r")
    kept = [ROW, "__lane", "__at", "__seq", "__id", "__price", "__r", "__v", "currency", CELL]
    entering = stepped.selectExpr(
        *kept, "head_next",
        f"sum({_case(head='head_n', own=one)}) OVER {up_peers} AS __up_n",
        f"sum({_case(head='head_s', own='__r')}) OVER {up_peers} AS __up_s",
        f"sum({_case(head='head_q', own='__r * __r')}) OVER {up_peers} AS __up_q",
    )
    summed = entering.selectExpr(
        *kept, "__up_n", "__up_s", "__up_q",
        f"last({_case(head='head_next', next='__price')}) IGNORE NULLS OVER {later} AS __f",
    ).selectExpr(
        "currency", ROW, "__lane", "__r", "__v", "__f",
        f"coalesce(__up_n, 0) + coalesce(sum({_case(old=one)}) OVER {down_peers}, 0) AS __n",
        f"coalesce(__up_s, 0e0) + coalesce(sum({_case(old='__r')}) OVER {down_peers}, 0e0) AS __s",
        f"coalesce(__up_q, 0e0) + coalesce(sum({_case(old='__r * __r')}) OVER {down_peers}, 0e0) AS __q",
    )
    vol = sample_stddev(F.col("__n"), F.col("__s"), F.col("__q")) * ANNUALIZATION
    return summed.filter(f"__lane = {_OWN}").select(
        *unpacked(rows, "currency"), F.col("__r").alias("log_return"), vol.alias("realized_vol_7day"),
        F.col("__v").alias("exchange_realized_vol"), F.col("__f").alias("forward_futures_price"),
    )
