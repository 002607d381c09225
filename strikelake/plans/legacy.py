"""The 35-column enriched table: index-price Greeks, moneyness at settlement, yield, IV rank, stress EV."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strikelake.functions import metrics, pricing
from strikelake.operators.ivhist import with_iv_rank
from strikelake.plans.gold import with_currency, with_settlement
from strikelake.schemas import TRADE_COLUMNS

GREEK_COLUMNS = ["delta", "gamma", "vega", "theta", "theoretical_price"]
ADDED_COLUMNS = GREEK_COLUMNS + [
    "delivery_price", "moneyness", "intrinsic_value", "moneyness_percentage", "annualized_premium_yield",
    "iv_rank_52w", "iv_52w_high", "iv_52w_low", "iv_52w_mean", "iv_52w_stddev",
    "expected_value_btc", "win_probability", "max_loss_btc", "max_gain_btc", "sharpe_ratio",
]


def with_index_greeks(trades: DataFrame) -> DataFrame:
    """Greeks and theoretical price (fraction) with the index price as forward, where IV > 0."""
    f, k, t = F.col("index_price"), F.col("strike"), F.col("time_to_expiry_years")
    side, iv = F.col("option_type"), F.col("implied_volatility")
    vol = metrics.iv_decimal(iv)
    first = trades.withColumn("__x", pricing.d1(f, k, t, vol))
    staged, n = pricing.with_normals(first, d1=F.col("__x"), d2=pricing.d2(F.col("__x"), t, vol))
    n1, n2 = n["d1"], n["d2"]
    values = {
        "delta": pricing.delta_from(n1, f, k, t, side),
        "gamma": pricing.gamma_from(n1, f, t, vol),
        "vega": pricing.vega_from(n1, f, t),
        "theta": pricing.theta_from(n1, f, k, t, vol, side),
        "theoretical_price": F.try_divide(pricing.price_from(n1, n2, f, k, t, vol, side), f),
    }
    priced = staged.withColumns({name: F.when(iv > 0, v) for name, v in values.items()})
    return pricing.without_normals(priced, "d1", "d2").drop("__x")


def with_moneyness(rows: DataFrame, settlement: str = "delivery_price") -> DataFrame:
    k, s, side = F.col("strike"), F.col(settlement), F.col("option_type")
    return rows.withColumns({
        "moneyness": metrics.moneyness(k, s, side),
        "intrinsic_value": metrics.intrinsic_value(k, s, side),
        "moneyness_percentage": metrics.moneyness_percentage(k, s, side),
    })


def with_premium_yield(rows: DataFrame) -> DataFrame:
    days = F.col("time_to_expiry_years") * 365.25
    return rows.withColumn("annualized_premium_yield", metrics.annualized_premium_yield(
        F.col("price"), F.col("strike"), F.col("index_price"), days))


def legacy_enrich(trades: DataFrame, settlements: DataFrame) -> DataFrame:
    """All options of ``trades``; the IV history spans every instrument."""
    options = with_currency(trades.filter(F.col("option_type").isNotNull()).select(*TRADE_COLUMNS))
    settled = with_moneyness(with_settlement(with_index_greeks(options), settlements, out="delivery_price"))
    ranked = with_iv_rank(with_premium_yield(settled))
    return metrics.with_stress_ev(
        ranked, F.col("price"), F.col("strike"), F.col("index_price"), F.col("option_type")
    ).select(*TRADE_COLUMNS, *ADDED_COLUMNS)
