"""Trailing and forward-looking columns after a merge: only the days that late prints can have changed are recomputed.

Days are the unit. A late print of a key changes the rows of the following week (its own figures are in their frames); as
the print after it gets another predecessor, also those of the week after the next day with prints; and it may be the first
print a week on for rows between the previous print's and its own time less a week. Those days are *dirty*. To work
them out again, the rows of a week on either side are needed, and the nearest days with prints beyond (their
*context*). Both sets come from a ledger of the days on which a key has prints, joined by (key, day): the tape is
read on context days only (store it partitioned by day, and other folders are not opened), and what is left of the earlier
result is taken as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from strikelake.sources.storage import as_table

DAY = "__day"
_DAYS = 7


@dataclass(frozen=True)
class Reach:
    """What a result looks at: ``linked`` to the previous print of each row in its week, ``ahead`` to the print a week on."""

    linked: bool = True
    ahead: bool = True


@dataclass(frozen=True)
class Refreshed:
    """dirty: (key, day) recomputed; changed: their rows, new figures; whole: the complete result."""

    dirty: DataFrame
    changed: DataFrame
    whole: DataFrame


def _on_day(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(DAY, F.to_date(ts))


def day_ledger(tape: DataFrame, by: str, ts: str = "timestamp") -> DataFrame:
    """(key, day, before, after) of the days with prints, and the neighbouring days that have some."""
    days = _on_day(tape.select(by, ts).filter(F.col(by).isNotNull()), ts).select(by, DAY).distinct()
    line = Window.partitionBy(by).orderBy(DAY)  # days of a calendar, not prints
    return days.select(by, DAY, F.lag(DAY).over(line).alias("before"), F.lead(DAY).over(line).alias("after"))


def _span(first, last):
    return F.explode(F.sequence(first, last))


def dirty_days(ledger: DataFrame, batch_days: DataFrame, by: str, reach: Reach) -> DataFrame:
    """(key, day) of the days with prints whose figures prints of ``batch_days`` can change."""
    late = ledger.join(batch_days, [by, DAY])
    last = F.coalesce("after", DAY) if reach.linked else F.col(DAY)
    days = late.select(by, _span(F.col(DAY), F.date_add(last, _DAYS)).alias(DAY))
    if reach.ahead:
        start = F.date_sub("before", _DAYS)
        days = days.unionByName(late.filter(F.col("before").isNotNull()).select(
            by, _span(start, F.date_sub(DAY, _DAYS)).alias(DAY)))
    return ledger.select(by, DAY).join(days.distinct(), [by, DAY], "left_semi")


def context_days(ledger: DataFrame, dirty: DataFrame, by: str, reach: Reach) -> DataFrame:
    """(key, day) of the days whose rows are needed to recompute the dirty ones."""
    last = F.date_add(DAY, _DAYS) if reach.ahead else F.col(DAY)
    near = dirty.select(by, _span(F.date_sub(DAY, _DAYS), last).alias(DAY))
    wanted = near
    if reach.linked:  # the last day with prints before the week: it lies ahead of each day of its gap
        gaps = ledger.filter(F.col("after").isNotNull()).select(
            by, F.col(DAY).alias("held"), _span(F.date_add(DAY, 1), F.col("after")).alias(DAY))
        wanted = wanted.unionByName(dirty.select(by, F.date_sub(DAY, _DAYS).alias(DAY)).join(gaps, [by, DAY]).select(
            by, F.col("held").alias(DAY)))
    if reach.ahead:
        gaps = ledger.filter(F.col("before").isNotNull()).select(
            by, F.col(DAY).alias("held"), _span(F.col("before"), F.date_sub(DAY, 1)).alias(DAY))
        wanted = wanted.unionByName(dirty.select(by, F.date_add(DAY, _DAYS).alias(DAY)).join(gaps, [by, DAY]).select(
            by, F.col("held").alias(DAY)))
    return ledger.select(by, DAY).join(wanted.distinct(), [by, DAY], "left_semi")


def refreshed(result: DataFrame, tape: DataFrame, batch: DataFrame, by: str,
              compute: Callable[[DataFrame], DataFrame], reach: Reach, ts: str = "timestamp") -> Refreshed:
    """``result`` as ``compute(tape)`` would give it, where it was computed before ``batch`` became part of ``tape``.

    ``compute`` gives one row per row of the tape it is handed, with ``by`` and ``ts`` among its columns. Keys without late
    prints are not touched. An empty batch changes nothing; rows without a key are never dirty.
    """
    late = as_table(_on_day(batch.select(by, ts).filter(F.col(by).isNotNull()), ts).select(by, DAY).distinct(), "late-days")
    ledger = as_table(day_ledger(tape.join(late.select(by).distinct(), by, "left_semi"), by, ts), "day-ledger")
    dirty = as_table(dirty_days(ledger, late, by, reach), "dirty-days")
    context = as_table(context_days(ledger, dirty, by, reach), "context-days")
    rows = _on_day(tape, ts).join(context, [by, DAY], "left_semi").select(*tape.columns)
    again = _on_day(compute(as_table(rows, "context-rows")).select(*result.columns), ts)
    changed = as_table(again.join(dirty, [by, DAY], "left_semi").select(*result.columns), "changed-rows")
    rest = _on_day(result, ts).join(dirty, [by, DAY], "left_anti").select(*result.columns)
    return Refreshed(dirty, changed, rest.unionByName(changed))
