"""Silver: forward price by as-of join, Greeks, validity flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strikelake.functions import pricing
from strikelake.functions.instruments import future_key
from strikelake.functions.metrics import MIN_YEARS_VALID, iv_decimal
from strikelake.operators.asof import asof_join
from strikelake.operators.cells import MAX_ROWS_PER_CELL, task_count
from strikelake.schemas import SILVER_COLUMNS, TRADE_COLUMNS

# Fixed value: a futures print older than this is no forward price (the bound itself still is).
MAX_FORWARD_AGE_SECONDS = 3_600


def with_forward_price(options: DataFrame, futures: DataFrame | None,
                       max_rows_per_cell: int = MAX_ROWS_PER_CELL) -> DataFrame:
    """Latest print of the matching dated future, at most an hour old; every option print is kept."""
    trades = options.select(*TRADE_COLUMNS)
    if futures is None:
        return trades.withColumn("futures_price", F.lit(None).cast("double"))
    keyed = trades.withColumn("__future", future_key(F.col("instrument_name")))
    prints = futures.select(F.col("instrument_name").alias("__future"), "timestamp", "trade_seq", "price")
    return asof_join(
        keyed, prints, by="__future", left_at="timestamp", right_at="timestamp",
        take={"price": "futures_price"}, tie=["trade_seq"],
        tolerance_seconds=MAX_FORWARD_AGE_SECONDS, max_rows_per_cell=max_rows_per_cell,
        tasks=task_count(trades.select("timestamp").unionByName(prints.select("timestamp"))),
    ).drop("__future")


def with_greeks(trades: DataFrame, forward: str = "futures_price") -> DataFrame:
    """Add delta, gamma, vega, theta (NULL without IV > 0 and a forward) and is_valid."""
    f, k = F.col(forward), F.col("strike")
    t, side, iv = F.col("time_to_expiry_years"), F.col("option_type"), F.col("implied_volatility")
    vol = iv_decimal(iv)
    ready = (iv > 0) & f.isNotNull()
    staged, normals = pricing.with_normals(trades, d1=pricing.d1(f, k, t, vol))
    n1 = normals["d1"]
    greeks = {
        "delta": pricing.delta_from(n1, f, k, t, side),
        "gamma": pricing.gamma_from(n1, f, t, vol),
        "vega": pricing.vega_from(n1, f, t),
        "theta": pricing.theta_from(n1, f, k, t, vol, side),
    }
    priced = staged.withColumns({name: F.when(ready, value) for name, value in greeks.items()})
    finite = F.lit(True)
    for name in greeks:
        finite = finite & pricing.is_finite(F.col(name))
    # NULL IV leaves the flag NULL (or FALSE without a forward): consumers test for TRUE.
    valid = f.isNotNull() & (iv > 0) & (t > MIN_YEARS_VALID) & F.when(iv > 0, finite)
    return pricing.without_normals(priced.withColumn("is_valid", valid), "d1")


def silver(options: DataFrame, futures: DataFrame | None, max_rows_per_cell: int = MAX_ROWS_PER_CELL) -> DataFrame:
    """The 21 silver columns, one row per option print."""
    return with_greeks(with_forward_price(options, futures, max_rows_per_cell)).select(*SILVER_COLUMNS)


def spot_greeks(trades: DataFrame) -> DataFrame:
    """Per-file variant: the index price is the forward; options with an IV and time left only get Greeks."""
    options = trades.filter(F.col("option_type").isNotNull()).select(*TRADE_COLUMNS)
    live = F.col("implied_volatility").isNotNull() & (F.col("time_to_expiry_years") > 0)
    names = ["delta", "gamma", "vega", "theta"]
    return with_greeks(options, forward="index_price").select(
        *TRADE_COLUMNS, *[F.when(live, F.col(n)).alias(n) for n in names])
