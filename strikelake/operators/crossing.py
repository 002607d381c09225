"""First crossing: per interval of a key, the first row inside it whose level is at or below the interval's trigger.

An inequality join on the key would pair an interval with every row after its start. Instead the timeline of a key is
cut into cells, of which only the lowest level is needed to tell whether a row in them can cross:

1. the rows are reduced to one lowest level per (key, day), an interval enters the days from its start to its end, and of
   those that reach the trigger its first day, the first whole one, and (without one) its last are kept: three at most;
2. days that hold many rows of a key are searched the same way by narrower cells;
3. rows are read in the cells kept only, joined by (key, cell).

Both joins are equality joins on (key, cell); a key that holds a third of all rows is many cells, and what an interval
costs depends on its length in days, not on the rows of its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from strikelake.functions.timeline import DAY_SECONDS, epoch_seconds
from strikelake.operators.cells import CELL_WIDTHS
from strikelake.sources.storage import as_table

_DAY, _CELL, _WIDTH, _LOW = "__day", "__cell", "__width", "__low"


def _start(ts: str, width: str) -> str:
    return f"floor({epoch_seconds(ts)} / {width}) * {width}"


def _entered(legs: DataFrame, ledger: DataFrame, by: str, leg_key: Sequence[str], inside: Sequence[str] = ()) -> DataFrame:
    """(leg_key, inside, cells) of the cells in which an interval can have its first crossing.

    legs have opens, closes and trigger and, in ``from`` and ``to``, the first and last cell to look at, ``step`` seconds
    apart; ledger has the lowest level of each (by, cell). A cell in which an interval opens or closes is only
    partly inside it, so finding the trigger there settles nothing: it is kept beside the first whole one.
    """
    edges = legs.withColumns({
        "__first": F.expr("floor(" + epoch_seconds("opens") + " / __step) * __step"),
        "__last": F.expr("floor(" + epoch_seconds("closes") + " / __step) * __step"),
        _CELL: F.explode(F.sequence("__from", "__to", "__step"))})
    met = edges.join(ledger, [by, *inside, _CELL]).filter(F.col(_LOW) <= F.col("trigger"))
    cell = F.col(_CELL)
    whole = F.min(F.when((cell > F.col("__first")) & (cell < F.col("__last")), cell))
    opening = F.max(F.when(cell == F.col("__first"), cell))
    closing = F.max(F.when((cell == F.col("__last")) & (cell > F.col("__first")), cell))
    kept = met.groupBy(*leg_key, *inside).agg(whole.alias("w"), opening.alias("o"), closing.alias("c"))
    return kept.select(*leg_key, *inside, F.explode(
        F.array_compact(F.array("o", F.coalesce("w", "c")))).alias(_CELL))


def _lowest(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min("level").alias(_LOW), F.count(F.lit(1)).alias("__n"))


def _inside_days(legs, near, first_days, busy, by: str, leg_key: Sequence[str], at: str) -> tuple[DataFrame, DataFrame]:
    """(legs with the cells to read, rows with their cell), where the days of ``busy`` are searched by narrower cells."""
    wanted = as_table(legs.join(first_days, list(leg_key)).join(busy, [by, _DAY], "left"), "crossing-wanted")
    in_days = near.withColumn(_DAY, F.expr(_start(at, f"{DAY_SECONDS}L")))
    crowded = wanted.filter(F.col(_WIDTH).isNotNull())
    narrow = _lowest(
        in_days.join(busy.join(crowded.select(by, _DAY).distinct(), [by, _DAY], "left_semi"), [by, _DAY])
        .withColumn(_CELL, F.expr(_start(at, _WIDTH))), by, _DAY, _CELL)
    inner = crowded.withColumn("__step", F.col(_WIDTH)).withColumns({
        "__from": F.greatest(F.col(_DAY), F.expr(_start("opens", "__step"))),
        "__to": F.least(F.col(_DAY) + DAY_SECONDS - F.col("__step"), F.expr(_start("closes", "__step")))})
    cells = _entered(inner.filter("__from <= __to").drop(_WIDTH), narrow.drop("__n"), by, leg_key, inside=[_DAY])
    cells = wanted.join(cells, [*leg_key, _DAY]).select(*legs.columns, _CELL).unionByName(
        wanted.filter(F.col(_WIDTH).isNull()).select(*legs.columns, F.col(_DAY).alias(_CELL)))
    placed = in_days.join(busy, [by, _DAY], "left").withColumn(
        _CELL, F.expr(_start(at, f"coalesce({_WIDTH}, {DAY_SECONDS}L)")))
    return cells, placed


def first_crossing(legs: DataFrame, rows: DataFrame, by: str, leg_key: Sequence[str], order: Sequence[str],
                   take: dict[str, str], max_rows: int) -> DataFrame:
    """leg_key and, for each interval that has a crossing, columns of its first one (``take``: column -> name).

    legs: leg_key (unique), ``by``, opens, closes (both exclusive) and trigger; a stored table, read several times. rows:
    ``by``, order (its first is the timestamp), level and what is taken. Nulls in any of them never cross. ``max_rows``
    is what a cell may hold before a day is cut more narrowly.
    """
    at = order[0]
    asked = legs.groupBy(by).agg(F.min("opens").alias("__open"), F.max("closes").alias("__close"))
    near = rows.join(asked, by).filter(F.col(at).between(F.col("__open"), F.col("__close"))).drop("__open", "__close")
    days = as_table(_lowest(near.withColumn(_CELL, F.expr(_start(at, f"{DAY_SECONDS}L"))), by, _CELL), "crossing-days")
    spans = legs.filter("opens < closes").withColumn("__step", F.lit(DAY_SECONDS).cast("bigint")).withColumns({
        "__from": F.expr(_start("opens", "__step")), "__to": F.expr(_start("closes", "__step"))})
    first_days = _entered(spans, days.drop("__n"), by, leg_key).withColumnRenamed(_CELL, _DAY)

    # days above max_rows: the widest cell that would hold max_rows if they were spread evenly
    width = F.lit(CELL_WIDTHS[-1])
    for candidate in reversed([w for w in CELL_WIDTHS if w < DAY_SECONDS]):
        width = F.when(F.col("__n") * candidate <= F.lit(max_rows).cast("bigint") * DAY_SECONDS, candidate).otherwise(width)
    busy = days.filter(F.col("__n") > max_rows).select(
        by, F.col(_CELL).alias(_DAY), width.cast("bigint").alias(_WIDTH))
    if busy.isEmpty():
        cells = legs.join(first_days, list(leg_key)).select(*legs.columns, F.col(_DAY).alias(_CELL))
        placed = rows.withColumn(_CELL, F.expr(_start(at, f"{DAY_SECONDS}L")))
    else:
        cells, placed = _inside_days(legs, near, first_days, busy, by, leg_key, at)
    own = [*order, "level", *[c for c in take if c not in order]]
    found = placed.select(by, _CELL, *[F.col(c).alias(f"__r_{c}") for c in own]).join(cells, [by, _CELL]).filter(
        (F.col(f"__r_{at}") > F.col("opens")) & (F.col(f"__r_{at}") < F.col("closes"))
        & (F.col("__r_level") <= F.col("trigger")))
    row = F.struct(*[F.col(f"__r_{c}").alias(out) for c, out in take.items()])
    firsts = found.groupBy(*leg_key).agg(F.min_by(row, F.struct(*[f"__r_{c}" for c in order])).alias("__first"))
    return firsts.select(*leg_key, *[f"__first.{out}" for out in take.values()])
