"""Queries for the index-price metrics: moneyness, yield, IV rank, stress EV."""

from __future__ import annotations

from pyspark.sql import functions as F

from strikelake.functions import metrics
from strikelake.functions.metrics import STRESS_SCENARIOS
from strikelake.operators.ivhist import with_iv_rank
from strikelake.plans import legacy
from strikelake.plans.gold import with_currency, with_settlement
from strikelake.queries import tape
from strikelake.queries.oracle_sql import d1_sql, greeks_sql, price_fraction_sql
from strikelake.queries.registry import options, query, rounded
from strikelake.queries.tape import TAPE_SQL

_SCENARIOS = ", ".join(f"({m}e0, {p}e0)" for m, p in STRESS_SCENARIOS)

_ENRICHED = f"""{TAPE_SQL},
settled AS (
  SELECT o.*, s.delivery_price, {d1_sql('index_price')} AS d1
  FROM bronze o LEFT JOIN settlements s ON s.index_name = concat(lower(o.currency), '_usd')
    AND CAST(s.date AS DATE) = CAST(o.expiration_timestamp AS DATE)
),
index_greeks AS (
  SELECT *, {greeks_sql('index_price', 'implied_volatility > 0')},
    CASE WHEN implied_volatility > 0 THEN {price_fraction_sql('index_price')} END AS theoretical_price
  FROM settled
),
money AS (
  SELECT *,
    CASE WHEN delivery_price IS NULL THEN NULL
      WHEN abs(delivery_price - strike) / delivery_price <= 0.005e0 THEN 'ATM'
      WHEN (option_type = 'call' AND delivery_price > strike) OR (option_type = 'put' AND delivery_price < strike)
      THEN 'ITM' ELSE 'OTM' END AS moneyness,
    CASE WHEN delivery_price IS NOT NULL THEN greatest(0.0e0, CASE WHEN option_type = 'call'
      THEN delivery_price - strike ELSE strike - delivery_price END) END AS intrinsic_value,
    CASE WHEN option_type = 'call' THEN delivery_price - strike ELSE strike - delivery_price END / strike * 100.0e0
      AS moneyness_percentage,
    CASE WHEN price > 0 AND time_to_expiry_years > 0 THEN price / (strike / index_price) * 100.0e0
      * (365.0e0 / (time_to_expiry_years * 365.25e0)) END AS annualized_premium_yield
  FROM index_greeks
),
hours AS (
  SELECT DISTINCT currency, date_trunc('hour', timestamp) AS hour FROM bronze WHERE implied_volatility IS NOT NULL
),
ranked_hours AS (
  SELECT h.currency, h.hour, max(b.implied_volatility) AS iv_52w_high, min(b.implied_volatility) AS iv_52w_low,
    avg(b.implied_volatility) AS iv_52w_mean, stddev_pop(b.implied_volatility) AS iv_52w_stddev
  FROM hours h JOIN bronze b ON b.currency = h.currency AND date_trunc('hour', b.timestamp) < h.hour
    AND date_trunc('hour', b.timestamp) >= h.hour - INTERVAL 364 DAY AND b.implied_volatility IS NOT NULL
  GROUP BY 1, 2
),
ranked AS (
  SELECT m.*, r.iv_52w_high, r.iv_52w_low, r.iv_52w_mean, r.iv_52w_stddev,
    CASE WHEN r.iv_52w_high > r.iv_52w_low THEN greatest(0.0e0, least(100.0e0,
        (m.implied_volatility - r.iv_52w_low) / (r.iv_52w_high - r.iv_52w_low) * 100.0e0))
      WHEN r.iv_52w_high IS NOT NULL THEN 50.0e0 END AS iv_rank_52w
  FROM money m LEFT JOIN ranked_hours r
    ON r.currency = m.currency AND r.hour = date_trunc('hour', m.timestamp) AND m.implied_volatility IS NOT NULL AND m.implied_volatility <> 0
),
scenarios AS (SELECT * FROM (VALUES {_SCENARIOS}) s(move, prob)),
pnls AS (
  SELECT trade_id, prob, price - greatest(0.0e0, CASE WHEN option_type = 'call'
      THEN index_price * (1.0e0 + move / 100.0e0) - strike
      ELSE strike - index_price * (1.0e0 + move / 100.0e0) END) / (index_price * (1.0e0 + move / 100.0e0)) AS pnl
  FROM bronze, scenarios WHERE price > 0
),
means AS (SELECT trade_id, sum(pnl * prob) AS mean FROM pnls GROUP BY 1),
stress AS (
  SELECT p.trade_id, any_value(m.mean) AS expected_value_btc,
    coalesce(sum(prob) FILTER (WHERE pnl > 0), 0) * 100.0e0 AS win_probability,
    min(pnl) AS max_loss_btc, max(pnl) AS max_gain_btc,
    CASE WHEN sum((pnl - m.mean) * (pnl - m.mean) * prob) > 0
      THEN any_value(m.mean) / sqrt(sum((pnl - m.mean) * (pnl - m.mean) * prob)) END AS sharpe_ratio
  FROM pnls p JOIN means m USING (trade_id) GROUP BY 1
),
enriched AS (SELECT * FROM ranked LEFT JOIN stress USING (trade_id))"""

_DIGITS = {
    "delta": 6, "gamma": 10, "vega": 6, "theta": 6, "theoretical_price": 8, "intrinsic_value": 6,
    "moneyness_percentage": 8, "annualized_premium_yield": 6, "iv_rank_52w": 6, "iv_52w_mean": 6, "iv_52w_stddev": 6,
    "expected_value_btc": 9, "win_probability": 6, "max_loss_btc": 9, "max_gain_btc": 9, "sharpe_ratio": 6,
}


# Means of three-decimal IVs often end exactly halfway between two rounded values, where the last bit of
# the summation order would decide. Both sides add the same small offset before rounding.
_MEAN = "iv_52w_mean"
_OFFSET = 3.14159265e-8


def _select(*columns: str) -> str:
    shown = {c: f"{c} + {_OFFSET}" if c == _MEAN else c for c in columns}
    parts = [f"round({shown[c]}, {_DIGITS[c]}) AS {c}" if c in _DIGITS else c for c in columns]
    return f"WITH {_ENRICHED} SELECT {', '.join(parts)} FROM enriched"


def _pick(df, *columns: str):
    shown = df.select(*columns)
    if _MEAN in columns:
        shown = shown.withColumn(_MEAN, F.col(_MEAN) + F.lit(_OFFSET))
    return rounded(shown, **{c: _DIGITS[c] for c in columns if c in _DIGITS})


_MONEY = ["trade_id", "delivery_price", "moneyness", "intrinsic_value", "moneyness_percentage"]
_RANK = ["trade_id", "iv_rank_52w", "iv_52w_high", "iv_52w_low", "iv_52w_mean", "iv_52w_stddev"]
_STRESS = ["trade_id", "expected_value_btc", "win_probability", "max_loss_btc", "max_gain_btc", "sharpe_ratio"]
_FULL = ["trade_id", *legacy.ADDED_COLUMNS]


@query("moneyness", _select(*_MONEY))
def moneyness(spark, sf_dir):
    trades = with_currency(options(spark, sf_dir))
    settled = with_settlement(trades, tape.settlements(spark, sf_dir), out="delivery_price")
    return _pick(legacy.with_moneyness(settled), *_MONEY)


@query("premium_yield", _select("trade_id", "annualized_premium_yield"))
def premium_yield(spark, sf_dir):
    return _pick(legacy.with_premium_yield(options(spark, sf_dir)), "trade_id", "annualized_premium_yield")


@query("iv_rank_52w", _select(*_RANK))
def iv_rank(spark, sf_dir):
    return _pick(with_iv_rank(with_currency(options(spark, sf_dir))), *_RANK)


@query("stress_ev", _select(*_STRESS))
def stress_ev(spark, sf_dir):
    trades = options(spark, sf_dir)
    return _pick(metrics.with_stress_ev(
        trades, F.col("price"), F.col("strike"), F.col("index_price"), F.col("option_type")), *_STRESS)


@query("legacy_enriched", _select(*_FULL))
def legacy_enriched(spark, sf_dir):
    return _pick(legacy.legacy_enrich(options(spark, sf_dir), tape.settlements(spark, sf_dir)), *_FULL)
