"""Silver and gold as plain DuckDB SQL over the derived tape: written from the columns' definitions, to check the Spark plans."""

from __future__ import annotations

from strikelake.queries.tape import TAPE_SQL


def _cdf(x: str) -> str:
    k = f"(1.0e0 / (1.0e0 + 0.2316419e0 * abs({x})))"
    tail = (f"0.3989423e0 * exp(-(({x}) * ({x})) / 2.0e0) * {k} * (0.3193815e0 + {k} * (-0.3565638e0 + {k} * "
            f"(1.781478e0 + {k} * (-1.821256e0 + {k} * 1.330274e0))))")
    return f"(CASE WHEN ({x}) >= 0 THEN 1.0e0 - {tail} ELSE {tail} END)"


def _pdf(x: str) -> str:
    return f"(exp(-(({x}) * ({x})) / 2.0e0) / sqrt(2.0e0 * pi()))"


def d1_sql(f: str, k: str = "strike", t: str = "time_to_expiry_years", v: str = "implied_volatility / 100.0e0") -> str:
    return (f"CASE WHEN {t} > 0 AND {v} > 0 AND {f} IS NOT NULL THEN "
            f"(ln({f} / {k}) + ({v}) * ({v}) * {t} / 2.0e0) / (({v}) * sqrt({t})) END")


def greeks_sql(f: str, gate: str) -> str:
    t, v = "time_to_expiry_years", "(implied_volatility / 100.0e0)"
    return f"""
    CASE WHEN {gate} THEN CASE
      WHEN {t} <= 0 THEN CASE WHEN option_type = 'call' THEN CASE WHEN {f} > strike THEN 1.0e0 ELSE 0.0e0 END
        ELSE CASE WHEN {f} < strike THEN -1.0e0 ELSE 0.0e0 END END
      WHEN option_type = 'call' THEN {_cdf('d1')} ELSE -{_cdf('-d1')} END END AS delta,
    CASE WHEN {gate} THEN CASE WHEN {t} <= 0 THEN 0.0e0
      ELSE {_pdf('d1')} / ({f} * {v} * sqrt({t})) END END AS gamma,
    CASE WHEN {gate} THEN CASE WHEN {t} <= 0 THEN 0.0e0
      ELSE {f} * {_pdf('d1')} * sqrt({t}) / 100.0e0 END END AS vega,
    CASE WHEN {gate} THEN CASE WHEN {t} <= 0 THEN 0.0e0
      ELSE -({f} * {_pdf('d1')} * {v}) / (2.0e0 * sqrt({t}) * 365.0e0) END END AS theta"""


def price_fraction_sql(f: str) -> str:
    t, v = "time_to_expiry_years", "(implied_volatility / 100.0e0)"
    d2 = f"(d1 - {v} * sqrt({t}))"
    intrinsic = (f"greatest(CASE WHEN option_type = 'call' THEN {f} - strike ELSE strike - {f} END, 0.0e0) / {f}")
    return (f"CASE WHEN {t} <= 0 OR {v} = 0 THEN {intrinsic} "
            f"WHEN option_type = 'call' THEN ({f} * {_cdf('d1')} - strike * {_cdf(d2)}) / {f} "
            f"ELSE (strike * {_cdf('-' + d2)} - {f} * {_cdf('-d1')}) / {f} END")


_READY = "implied_volatility IS NOT NULL AND implied_volatility > 0 AND futures_price IS NOT NULL"

SILVER_SQL = f"""{TAPE_SQL},
last_prints AS (
  SELECT instrument_name AS future_name, timestamp AS futures_timestamp, price AS matched_price
  FROM (SELECT *, row_number() OVER (PARTITION BY instrument_name, timestamp ORDER BY trade_seq DESC) AS rn
        FROM futures) WHERE rn = 1
),
forwarded AS (
  SELECT o.*, CASE WHEN o.timestamp - f.futures_timestamp <= INTERVAL '1 hours' THEN f.matched_price END
    AS futures_price
  FROM bronze o ASOF LEFT JOIN last_prints f
    ON o.future_name = f.future_name AND o.timestamp >= f.futures_timestamp
),
silver_d1 AS (SELECT *, {d1_sql('futures_price')} AS d1 FROM forwarded),
silver_greeks AS (SELECT *, {greeks_sql('futures_price', _READY)} FROM silver_d1),
silver AS (
  SELECT *, (futures_price IS NOT NULL AND implied_volatility > 0 AND time_to_expiry_years > 0.0027e0
    AND NOT (isnan(delta) OR isinf(delta) OR isnan(gamma) OR isinf(gamma) OR isnan(vega) OR isinf(vega)
      OR isnan(theta) OR isinf(theta))) AS is_valid
  FROM silver_greeks
)"""

def _bin_sql(iv: str) -> str:
    return f"(2 * greatest(0.0e0, least(999.5e0, {iv})))::INT"


def _history_sql(name: str, last: str) -> str:
    """Ranks of the (currency, day, bin) that prints ask for, counted from the prints of 90 days up to ``last``."""
    return f"""
{name} AS (
  SELECT q.currency, q.day, q.iv_bin, count_if(h.iv_bin < q.iv_bin) AS below, count_if(h.iv_bin = q.iv_bin) AS same,
    count(h.iv_bin) AS everything, min(h.iv_bin) AS lowest
  FROM asked q LEFT JOIN points h
    ON h.currency = q.currency AND h.day BETWEEN q.day - 89 AND {last}
  GROUP BY q.currency, q.day, q.iv_bin
)"""


def percentile_sql(h: str) -> str:
    """Percentile from a row of the history: 0 in the lowest bin, NULL under 20 prints."""
    return (f"CASE WHEN {h}.everything >= 20 THEN CASE WHEN {h}.below = 0 AND {h}.lowest >= {h}.iv_bin THEN 0.0e0 "
            f"ELSE ({h}.below + 0.5e0 * {h}.same) / {h}.everything END END")


# Every gold column from its definition, print by print: neighbours are found by position, trailing figures by joining a
# print with the prints of its window, and the outcome by the position of the first print a week on.
GOLD_SQL = f"""{SILVER_SQL},
prints AS (
  SELECT *, CAST(timestamp AS DATE) AS day, timestamp - INTERVAL 168 HOUR AS week_start,
    row_number() OVER (PARTITION BY currency ORDER BY timestamp, trade_seq, trade_id) AS nth,
    row_number() OVER (PARTITION BY instrument_name ORDER BY timestamp, trade_seq, trade_id) AS own_nth
  FROM silver WHERE futures_price IS NOT NULL
),
log_steps AS (
  SELECT p.trade_id, p.currency, p.timestamp, ln(p.futures_price) - ln(q.futures_price) AS log_return
  FROM prints p JOIN prints q ON q.currency = p.currency AND q.nth = p.nth - 1
),
weekly_vol AS (
  SELECT p.trade_id, sqrt(8760.0e0) * stddev_samp(r.log_return) AS realized_vol_7day
  FROM prints p JOIN log_steps r ON r.currency = p.currency AND r.timestamp BETWEEN p.week_start AND p.timestamp
  GROUP BY p.trade_id
),
weekly_flow AS (
  SELECT p.trade_id, count(*) AS trade_volume_7day, sum(o.amount * o.price) AS actual_premium_collected
  FROM prints p JOIN prints o
    ON o.instrument_name = p.instrument_name AND o.timestamp BETWEEN p.week_start AND p.timestamp
  GROUP BY p.trade_id
),
index_level AS (
  SELECT p.trade_id, arg_max(v.volatility_value, v.timestamp) AS exchange_realized_vol
  FROM prints p JOIN vol_index v ON v.currency = p.currency AND v.timestamp <= p.timestamp GROUP BY p.trade_id
),
points AS (SELECT currency, day, {_bin_sql('implied_volatility')} AS iv_bin FROM prints WHERE implied_volatility IS NOT NULL),
asked AS (SELECT DISTINCT currency, day, iv_bin FROM points),{_history_sql('history', 'q.day')},{
    _history_sql('past_history', 'q.day - 1')},
moves AS (
  SELECT p.instrument_name, p.own_nth, p.price - a.price AS move, a.price - b.price AS move_before
  FROM prints p JOIN prints a ON a.instrument_name = p.instrument_name AND a.own_nth = p.own_nth - 1
    LEFT JOIN prints b ON b.instrument_name = p.instrument_name AND b.own_nth = p.own_nth - 2
),
roll AS (
  SELECT p.trade_id,
    CASE WHEN count(m.move) > 4 AND covar_pop(m.move, m.move_before) < 0
      THEN sqrt(-4.0e0 * covar_pop(m.move, m.move_before)) END AS bid_ask_spread_estimate
  FROM prints p JOIN moves m ON m.instrument_name = p.instrument_name AND m.own_nth BETWEEN p.own_nth - 20 AND p.own_nth
  GROUP BY p.trade_id
),
due AS (
  SELECT p.trade_id, min(l.nth) AS nth FROM prints p JOIN prints l
    ON l.currency = p.currency AND l.timestamp - INTERVAL 168 HOUR >= p.timestamp GROUP BY p.trade_id
),
gathered AS (
  SELECT p.*, r.log_return, w.realized_vol_7day, f.trade_volume_7day, f.actual_premium_collected,
    i.exchange_realized_vol, x.bid_ask_spread_estimate, l.futures_price AS forward_futures_price,
    {percentile_sql('h')} AS iv_percentile_90day, h.everything AS iv_percentile_sample_size,
    {percentile_sql('g')} AS strict_percentile,
    CASE WHEN p.implied_volatility IS NOT NULL AND g.everything > 0 THEN g.everything END AS strict_sample_size,
    (SELECT max(delivery_price) FROM settlements s WHERE s.index_name = lower(p.currency) || '_usd'
      AND s.date = strftime(p.expiration_timestamp, '%Y-%m-%d')) AS outcome_settlement_price
  FROM prints p LEFT JOIN log_steps r USING (trade_id) LEFT JOIN weekly_vol w USING (trade_id)
    LEFT JOIN weekly_flow f USING (trade_id) LEFT JOIN index_level i USING (trade_id) LEFT JOIN roll x USING (trade_id)
    LEFT JOIN due d USING (trade_id) LEFT JOIN prints l ON l.currency = p.currency AND l.nth = d.nth
    LEFT JOIN history h ON h.currency = p.currency AND h.day = p.day
      AND h.iv_bin = {_bin_sql('p.implied_volatility')} AND p.implied_volatility IS NOT NULL
    LEFT JOIN past_history g ON g.currency = p.currency AND g.day = p.day
      AND g.iv_bin = {_bin_sql('p.implied_volatility')} AND p.implied_volatility IS NOT NULL
),
priced AS (
  SELECT *, CASE WHEN implied_volatility IS NOT NULL AND time_to_expiry_years > 0
    THEN amount * ({price_fraction_sql('futures_price')}) END AS expected_premium
  FROM gathered
),
judged AS (
  SELECT *,
    price / nullif(greatest(mark_price, 0), 0) - 1 AS price_vs_mark_deviation,
    CASE WHEN amount > 0 AND expected_premium >= 0.0001e0 * amount THEN amount * price / expected_premium END
      AS premium_collection_ratio,
    round((epoch_us(expiration_timestamp) // 1000 - epoch_us(timestamp) // 1000) / 86400000.0e0)::INT AS days_to_expiry,
    forward_futures_price / futures_price - 1 AS outcome_forward_return_7day,
    implied_volatility - realized_vol_7day AS iv_minus_rv_gap,
    (CASE option_type WHEN 'call' THEN outcome_settlement_price - strike ELSE strike - outcome_settlement_price END) > 0
      AS outcome_assignment_inferred,
    (['5-delta', '10-delta', '25-delta', '50-delta', 'deep-itm'])[
      1 + len(list_filter([0.05e0, 0.10e0, 0.25e0, 0.50e0], lambda e: e < abs(delta)))] AS band
  FROM priced
),
gold AS (
  SELECT *, if(delta IS NULL, NULL, band) AS strike_delta,
    if(outcome_assignment_inferred, days_to_expiry, NULL) AS outcome_days_to_assignment,
    (['low', 'mid', 'high'])[1 + (iv_percentile_90day >= 0.33e0)::INT + (iv_percentile_90day >= 0.67e0)::INT] AS vol_regime
  FROM judged
)"""
