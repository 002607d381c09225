"""Named queries over the derived tape, each with the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from strikelake.plans import gold as gold_plan
from strikelake.plans import silver as silver_plan
from strikelake.queries import tape
from strikelake.session import tuned

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


QUERIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is a full DuckDB statement with the same columns."""

    def wrap(fn: Query) -> Query:
        QUERIES[name] = Entry(fn, sql)
        return fn

    return wrap


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round the named columns, so that summation order does not show."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze option tape as a table."""
    return tape.stored(spark, sf_dir, "option_trades", lambda: tape.spread(tape.option_trades(spark, sf_dir)))


def futures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze futures tape as a table."""
    return tape.stored(spark, sf_dir, "futures_trades", lambda: tape.spread(tape.futures_trades(spark, sf_dir)))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver layer as a table, with its currency. From here on the session has the settings the plans are meant for."""
    spark = tuned(spark)
    return tape.stored(spark, sf_dir, "silver", lambda: gold_plan.with_currency(
        silver_plan.silver(options(spark, sf_dir), futures(spark, sf_dir))))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold layer as a table."""
    return tape.stored(spark, sf_dir, "gold", lambda: gold_plan.gold(
        silver(spark, sf_dir), tape.settlements(spark, sf_dir), tape.vol_index(spark, sf_dir)))
