"""Trading metrics as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from strikelake.functions.pricing import intrinsic
from strikelake.functions.timeline import epoch_millis

# Thresholds of the derived labels.
MIN_YEARS_VALID = 0.0027
MIN_PERCENTILE_SAMPLE = 20
LOW_REGIME, MID_REGIME = 0.33, 0.67
IV_CAP, IV_BINS_PER_POINT = 999.5, 2
ROLL_MIN_OBSERVATIONS = 5
TICK_SIZE = 0.0001
ATM_THRESHOLD = 0.005

# Default stress scenarios (underlying move %, probability).
STRESS_SCENARIOS = [
    (-40.0, 0.005),
    (-30.0, 0.01),
    (-20.0, 0.05),
    (-10.0, 0.12),
    (-5.0, 0.17),
    (0.0, 0.29),
    (5.0, 0.17),
    (10.0, 0.12),
    (20.0, 0.05),
    (30.0, 0.01),
    (40.0, 0.005),
]


def iv_decimal(iv: Column) -> Column:
    return iv / 100.0


def days_to_expiry(expiry: Column, ts: Column) -> Column:
    """Calendar days, rounded half to even."""
    days = (epoch_millis(expiry) - epoch_millis(ts)).cast("double") / F.lit(86_400_000.0)
    return F.rint(days).cast("int")


def strike_delta(delta: Column) -> Column:
    size = F.abs(delta)
    return (
        F.when(size <= 0.05, "5-delta").when(size <= 0.10, "10-delta").when(size <= 0.25, "25-delta")
        .when(size <= 0.50, "50-delta").when(size.isNotNull(), "deep-itm")
    )


def iv_bin(iv: Column) -> Column:
    """Half-point IV bucket, rounded half to even; NULL for a missing IV."""
    clamped = F.least(F.greatest(iv, F.lit(0.0)), F.lit(IV_CAP))
    return F.when(iv.isNotNull(), F.rint(clamped * IV_BINS_PER_POINT).cast("int"))


def iv_percentile(iv: Column, below: Column, up_to: Column, total: Column) -> Column:
    """Mid-rank percentile in [0, 1]. ``below`` is NULL in the window's lowest bucket, which ranks 0."""
    rank = F.coalesce((below + up_to) / F.lit(2.0) / total, F.lit(0.0))
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), rank))
    return F.when(iv.isNotNull() & (total >= MIN_PERCENTILE_SAMPLE), clamped)


def vol_regime(percentile: Column) -> Column:
    return (
        F.when(percentile < LOW_REGIME, "low").when(percentile < MID_REGIME, "mid")
        .when(percentile.isNotNull(), "high")
    )


def iv_minus_rv_gap(iv: Column, realized: Column) -> Column:
    """IV in percent minus realized vol as a fraction: the published column, units mixed as published."""
    return iv - realized


def iv_minus_rv_gap_pct(iv: Column, realized: Column) -> Column:
    """The same gap with both sides in percent."""
    return iv - realized * 100.0


def roll_spread(covariance: Column, observations: Column) -> Column:
    negative = (observations >= ROLL_MIN_OBSERVATIONS) & (covariance < 0)
    return F.when(negative, 2.0 * F.sqrt(F.greatest(-covariance, F.lit(0.0))))


def price_vs_mark_deviation(price: Column, mark: Column) -> Column:
    return F.when(mark > 0, F.try_divide(price - mark, mark))


def premium_collection_ratio(price: Column, amount: Column, expected: Column) -> Column:
    per_contract = F.try_divide(expected, amount)
    return F.when((amount > 0) & (per_contract >= TICK_SIZE), F.try_divide(price * amount, expected))


def assignment_inferred(settlement: Column, strike: Column, side: Column) -> Column:
    crossed = F.when(side == "call", settlement > strike).when(side == "put", settlement < strike)
    return F.when(settlement.isNotNull(), F.coalesce(crossed, F.lit(False)))


def days_to_assignment(assigned: Column, days: Column) -> Column:
    return F.when(assigned, days)


def forward_return(entry: Column, later: Column) -> Column:
    return F.try_divide(later - entry, entry)


def moneyness(strike: Column, settlement: Column, side: Column, threshold: float = ATM_THRESHOLD) -> Column:
    near = F.try_divide(F.abs(settlement - strike), settlement) <= threshold
    itm = F.when(side == "call", settlement > strike).otherwise(settlement < strike)
    return F.when(strike.isNotNull() & settlement.isNotNull(),
                  F.when(near, "ATM").when(itm, "ITM").otherwise("OTM"))


def is_itm(strike: Column, settlement: Column, side: Column) -> Column:
    return moneyness(strike, settlement, side) == "ITM"


def intrinsic_value(strike: Column, underlying: Column, side: Column) -> Column:
    return intrinsic(underlying, strike, side)


def moneyness_percentage(strike: Column, underlying: Column, side: Column) -> Column:
    gap = F.when(side == "call", underlying - strike).otherwise(strike - underlying)
    return F.try_divide(gap, strike) * 100.0


def annualized_premium_yield(premium: Column, strike: Column, index_price: Column, days: Column) -> Column:
    usable = (premium > 0) & (strike > 0) & (index_price > 0) & (days > 0)
    collateral = F.try_divide(strike, index_price)
    return F.when(usable, F.try_divide(premium, collateral) * 100.0 * F.try_divide(F.lit(365.0), days))


def with_stress_ev(df: DataFrame, premium: Column, strike: Column, index_price: Column, side: Column,
                   scenarios: Sequence[tuple[float, float]] = STRESS_SCENARIOS) -> DataFrame:
    """Short-option statistics over price scenarios, as row arithmetic (no shuffle, no explode).

    Adds expected_value_btc, win_probability, max_loss_btc, max_gain_btc and sharpe_ratio; all NULL
    unless the premium is positive. Staged projections keep each scenario's result computed once.
    """
    pnls = []
    for move, _ in scenarios:
        future = index_price * F.lit(1.0 + move / 100.0)
        pnls.append(premium - F.try_divide(intrinsic(future, strike, side), future))
    probs = [F.lit(float(p)) for _, p in scenarios]
    at = [F.col("__pnl")[i] for i in range(len(pnls))]

    def weighted(values: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a + b, [v * p for v, p in zip(values, probs)])

    staged = (
        df.withColumn("__pnl", F.when(premium > 0, F.array(*pnls)))
        .withColumn("__mean", weighted(at))
        .withColumn("__var", weighted([(x - F.col("__mean")) * (x - F.col("__mean")) for x in at]))
    )
    wins = reduce(lambda a, b: a + b, [F.when(x > 0, p).otherwise(0.0) for x, p in zip(at, probs)])
    known = F.col("__pnl").isNotNull()
    return staged.withColumns({
        "expected_value_btc": F.col("__mean"),
        "win_probability": F.when(known, wins * 100.0),
        "max_loss_btc": F.array_min("__pnl"),
        "max_gain_btc": F.array_max("__pnl"),
        "sharpe_ratio": F.when(F.col("__var") > 0, F.try_divide(F.col("__mean"), F.sqrt("__var"))),
    }).drop("__pnl", "__mean", "__var")


def iv_rank(iv: Column, low: Column, high: Column) -> Column:
    """Position of ``iv`` in [low, high] on 0..100; 50 when the range is flat, NULL without history."""
    scaled = F.try_divide(iv - low, high - low) * 100.0
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(100.0), scaled))
    return F.when(iv.isNotNull() & (high > low), clamped).when(iv.isNotNull() & high.isNotNull(), 50.0)
