"""Gold: entry-time market state, execution quality and forward-looking outcomes (39 columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strikelake import schemas
from strikelake.functions import metrics, pricing
from strikelake.functions.instruments import currency_of
from strikelake.operators.cells import MAX_ROWS_PER_CELL, measure_cells, task_count
from strikelake.operators.flow import flow_heads, trade_flow
from strikelake.operators.ivhist import with_iv_percentile
from strikelake.operators.market import market_heads, market_state
from strikelake.operators.quality import has_forward
from strikelake.sources.storage import side_by_side


def with_currency(df: DataFrame) -> DataFrame:
    if "currency" in df.columns:
        return df
    return df.withColumn("currency", currency_of(F.col("instrument_name")))


def with_settlement(rows: DataFrame, settlements: DataFrame, out: str = "outcome_settlement_price") -> DataFrame:
    """Delivery price of the expiry's calendar date, NULL when unknown.

    A currency settles against the index ``<currency>_usd``, in lower case. The settlement side is one row per
    index and calendar day after the aggregate; its size decides how it is joined.
    """
    index = F.concat(F.lower("currency"), F.lit("_usd"))
    daily = settlements.groupBy(
        F.col("index_name").alias("__index"), F.col("date").cast("date").alias("__day")
    ).agg(F.max("delivery_price").alias(out))
    keyed = rows.withColumns({"__index": index, "__day": F.to_date("expiration_timestamp")})
    return keyed.join(daily, ["__index", "__day"], "left").drop("__index", "__day")


def with_execution_quality(rows: DataFrame) -> DataFrame:
    """Add price_vs_mark_deviation, expected_premium and premium_collection_ratio."""
    f, k, t = F.col("futures_price"), F.col("strike"), F.col("time_to_expiry_years")
    side, vol = F.col("option_type"), metrics.iv_decimal(F.col("implied_volatility"))
    price, amount = F.col("price"), F.col("amount")
    first = rows.withColumn("__x", pricing.d1(f, k, t, vol))
    staged, n = pricing.with_normals(first, d1=F.col("__x"), d2=pricing.d2(F.col("__x"), t, vol))
    fraction = F.try_divide(pricing.price_from(n["d1"], n["d2"], f, k, t, vol, side), f)
    expected = F.when(f.isNotNull() & vol.isNotNull() & (t > 0) & amount.isNotNull(), fraction * amount)
    scored = staged.withColumn("expected_premium", expected).withColumns({
        "price_vs_mark_deviation": metrics.price_vs_mark_deviation(price, F.col("mark_price")),
        "premium_collection_ratio": metrics.premium_collection_ratio(price, amount, F.col("expected_premium")),
    })
    return pricing.without_normals(scored, "d1", "d2").drop("__x")


def with_outcomes(rows: DataFrame) -> DataFrame:
    """Outcome columns from forward_futures_price and outcome_settlement_price."""
    assigned = metrics.assignment_inferred(
        F.col("outcome_settlement_price"), F.col("strike"), F.col("option_type"))
    return rows.withColumns({
        "days_to_expiry": metrics.days_to_expiry(F.col("expiration_timestamp"), F.col("timestamp")),
        "outcome_forward_return_7day": metrics.forward_return(
            F.col("futures_price"), F.col("forward_futures_price")),
        "outcome_assignment_inferred": assigned,
    }).withColumn("outcome_days_to_assignment", metrics.days_to_assignment(
        F.col("outcome_assignment_inferred"), F.col("days_to_expiry")))


def gold(silver: DataFrame, settlements: DataFrame | None = None, vol_index: DataFrame | None = None,
         max_rows_per_cell: int = MAX_ROWS_PER_CELL, strict_past: bool = False) -> DataFrame:
    """The 39 gold columns plus the currency, one row per silver row with a forward price.

    ``silver`` is read several times in narrow projections, so pass a stored table. Without settlements or
    a vol index the columns derived from them are NULL.
    """
    spark = silver.sparkSession
    if settlements is None:
        settlements = spark.createDataFrame([], schemas.SETTLEMENTS)
    if vol_index is None:
        vol_index = spark.createDataFrame([], schemas.VOL_INDEX)
    rows = has_forward(with_currency(silver))
    by_currency, by_instrument = side_by_side(
        lambda: measure_cells([rows], "currency", max_rows=max_rows_per_cell),
        lambda: measure_cells([rows], "instrument_name", max_rows=max_rows_per_cell))
    tasks = task_count(rows)
    of_currency, of_instrument = side_by_side(
        lambda: market_heads(rows, vol_index, by_currency, tasks), lambda: flow_heads(rows, by_instrument))
    # log_return is not a gold column; dropped here so that every field carried below is used, which keeps
    # the optimizer from unpacking the carried struct into single columns.
    state = market_state(rows, vol_index, by_currency, tape=rows, heads=of_currency, tasks=tasks).drop("log_return")
    ranked = with_iv_percentile(state, history=rows, strict_past=strict_past)
    flowed = trade_flow(ranked, by_instrument, tape=rows, heads=of_instrument, tasks=tasks)
    scored = with_outcomes(with_settlement(with_execution_quality(flowed), settlements))
    iv = F.col("implied_volatility")
    return scored.withColumns({
        "strike_delta": metrics.strike_delta(F.col("delta")),
        "vol_regime": metrics.vol_regime(F.col("iv_percentile_90day")),
        "iv_minus_rv_gap": metrics.iv_minus_rv_gap(iv, F.col("realized_vol_7day")),
    }).select(*schemas.GOLD_COLUMNS, "currency")
