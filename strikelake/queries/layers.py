"""Queries for the bronze, silver and gold layers and the quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from strikelake.functions import metrics, pricing
from strikelake.functions.instruments import currency_of, parse_instrument
from strikelake.operators import quality
from strikelake.operators.asof import asof_join, previous_row
from strikelake.operators.cells import measure_cells
from strikelake.operators.incremental import DAY, Reach, refreshed
from strikelake.operators.ordering import positioned
from strikelake.operators.ivhist import daily_iv_hist, rolling_iv_hist, with_iv_percentile
from strikelake.operators.flow import trade_flow
from strikelake.operators.market import market_state
from strikelake.plans import gold as gold_plan
from strikelake.plans import silver as silver_plan
from strikelake.queries import tape
from strikelake.queries.oracle_sql import GOLD_SQL, SILVER_SQL, d1_sql, greeks_sql, price_fraction_sql
from strikelake.queries.registry import futures, gold, options, query, rounded, silver
from strikelake.queries.tape import TAPE_SQL
from strikelake.schemas import GOLD_COLUMNS
from strikelake.sources.bronze import dedupe_trades, merge_trades


# Rows per cell at which every key of the small tables counts as hot.
HOT_ROWS = 40


def _bronze(sql: str) -> str:
    return f"WITH {TAPE_SQL} {sql}"


def _silver(sql: str) -> str:
    return f"WITH {SILVER_SQL} {sql}"


def _gold(sql: str, extra: str = "") -> str:
    return f"WITH {GOLD_SQL}{extra and ','}{extra} {sql}"


# --- bronze ---

@query("bronze_options", _bronze("""SELECT trade_id, trade_seq, instrument_name, timestamp, price, amount, direction,
    tick_direction, index_price, mark_price, implied_volatility, strike, expiration_timestamp, option_type,
    round(time_to_expiry_years, 9) AS time_to_expiry_years FROM bronze"""))
def bronze_options(spark, sf_dir):
    return rounded(tape.option_trades(spark, sf_dir).drop("futures_price"), time_to_expiry_years=9)


@query("bronze_futures", _bronze("""SELECT trade_id, trade_seq, instrument_name, timestamp, price, amount,
    index_price, mark_price FROM futures"""))
def bronze_futures(spark, sf_dir):
    return tape.futures_trades(spark, sf_dir).drop("direction", "tick_direction")


@query("bronze_settlements", _bronze("""SELECT index_name, date, delivery_price,
    CAST(CAST(date AS DATE) AS TIMESTAMP) AS timestamp FROM settlements"""))
def bronze_settlements(spark, sf_dir):
    return tape.settlements(spark, sf_dir)


@query("bronze_vol_index", _bronze("SELECT currency, timestamp, volatility_value FROM vol_index"))
def bronze_vol_index(spark, sf_dir):
    return tape.vol_index(spark, sf_dir)


@query("parse_instrument", _bronze("""
  SELECT instrument_name, currency AS underlying, 'option' AS instrument_type, expiration_timestamp, strike,
    option_type, count(*) AS trades FROM bronze GROUP BY ALL
  UNION ALL
  SELECT instrument_name, split_part(instrument_name, '-', 1), 'future',
    strptime(split_part(instrument_name, '-', 2), '%-d%b%y') + INTERVAL 8 HOURS, NULL, NULL, count(*)
  FROM futures GROUP BY ALL"""))
def parsed(spark, sf_dir):
    names = tape.raw_option_trades(spark, sf_dir).select("instrument_name").unionByName(
        tape.raw_futures_trades(spark, sf_dir).select("instrument_name"))
    counted = names.groupBy("instrument_name").agg(F.count(F.lit(1)).alias("trades"))
    terms = counted.withColumn("t", parse_instrument(F.col("instrument_name")))
    return terms.select("instrument_name", "t.*", "trades")


@query("merge_trades", _bronze("""
  SELECT *, row_number() OVER (ORDER BY instrument_name, trade_seq) AS position FROM (
    SELECT instrument_name, trade_seq, trade_id, price, 'stored' AS origin FROM bronze WHERE direction = 'buy'
    UNION ALL
    SELECT instrument_name, trade_seq, trade_id, price, 'new' FROM bronze n WHERE NOT EXISTS (
      SELECT 1 FROM bronze s WHERE s.direction = 'buy' AND s.instrument_name = n.instrument_name
        AND s.trade_seq = n.trade_seq))"""))
def merged(spark, sf_dir):
    """Buys are stored already (the fixture's choice); a full re-fetch arrives. Rows carry their place on the tape."""
    columns = ["instrument_name", "trade_seq", "trade_id", "price"]
    trades = options(spark, sf_dir)
    stored = trades.filter("direction = 'buy'").select(*columns, F.lit("stored").alias("origin"))
    both = merge_trades(stored, trades.select(*columns, F.lit("new").alias("origin")))
    return positioned(both, ["instrument_name", "trade_seq"])


@query("dedupe_trades", _bronze("""
  SELECT instrument_name, trade_seq, trade_id, timestamp, price FROM bronze"""))
def deduped(spark, sf_dir):
    trades = options(spark, sf_dir).select(
        "instrument_name", "trade_seq", "trade_id", "timestamp", "price")
    later = trades.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(secs=F.lit(1)))
    return dedupe_trades(trades.unionByName(later))


# --- quality ---

@query("tape_stats", _bronze("""SELECT instrument_name, count(*) AS trade_count, min(timestamp) AS first_trade,
    max(timestamp) AS last_trade, min(trade_seq) AS min_seq, max(trade_seq) AS max_seq
  FROM bronze GROUP BY 1"""))
def stats(spark, sf_dir):
    return quality.tape_stats(options(spark, sf_dir))


@query("seq_gaps", _bronze("""
  SELECT instrument_name, trade_seq + 1 AS gap_start, following - 1 AS gap_end, following - trade_seq - 1 AS missing
  FROM (SELECT instrument_name, trade_seq,
          lead(trade_seq) OVER (PARTITION BY instrument_name ORDER BY trade_seq) AS following FROM bronze)
  WHERE following - trade_seq > 1"""))
def gaps(spark, sf_dir):
    return quality.seq_gaps(options(spark, sf_dir))


@query("missing_instruments", _bronze("""
  SELECT DISTINCT o.future_name AS instrument_name FROM bronze o
  WHERE o.future_name NOT IN (SELECT instrument_name FROM futures WHERE index_price > 48000)"""))
def missing(spark, sf_dir):
    wanted = quality.required_futures(options(spark, sf_dir)).toDF("instrument_name")
    return quality.missing_instruments(wanted, futures(spark, sf_dir).filter("index_price > 48000"))


@query("required_futures", _bronze("""SELECT future_name, row_number() OVER (ORDER BY future_name) AS position
  FROM (SELECT DISTINCT future_name FROM bronze)"""))
def futures_needed(spark, sf_dir):
    return positioned(quality.required_futures(options(spark, sf_dir)), ["future_name"])


@query("instrument_universe", _bronze("""
  SELECT DISTINCT instrument_name, expiration_timestamp FROM bronze
  WHERE expiration_timestamp <= TIMESTAMP '2024-02-02 08:00:00'
    AND expiration_timestamp >= TIMESTAMP '2024-01-20 00:00:00'"""))
def universe(spark, sf_dir):
    master = options(spark, sf_dir).select(
        "instrument_name", F.lit("option").alias("kind"), "expiration_timestamp").distinct()
    return quality.instrument_universe(
        master, "option", expired_at="2024-02-02 08:00:00", min_expiry="2024-01-20 00:00:00").drop("kind")


@query("settlement_range", _bronze("""SELECT index_name, date, delivery_price FROM settlements
  WHERE date >= '2024-01-10' AND date <= '2024-02-02'"""))
def settlement_range(spark, sf_dir):
    return quality.settlement_range(tape.settlements(spark, sf_dir), "2024-01-10", "2024-02-02").drop("timestamp")


# --- silver ---

@query("silver_asof_forward", _silver("SELECT trade_id, instrument_name, futures_price FROM silver"))
def silver_asof_forward(spark, sf_dir):
    return silver_plan.with_forward_price(
        options(spark, sf_dir), futures(spark, sf_dir)
    ).select("trade_id", "instrument_name", "futures_price")


@query("silver_asof_hot", _silver("SELECT trade_id, instrument_name, futures_price FROM silver"))
def silver_asof_hot(spark, sf_dir):
    """The same with every key hot."""
    return silver_plan.with_forward_price(
        options(spark, sf_dir), futures(spark, sf_dir), max_rows_per_cell=HOT_ROWS,
    ).select("trade_id", "instrument_name", "futures_price")


@query("silver_asof_keyless", _silver("""SELECT trade_id, instrument_name, futures_price FROM silver
  UNION ALL SELECT trade_id, currency || '-PERPETUAL', NULL FROM bronze WHERE direction = 'sell'"""))
def silver_asof_keyless(spark, sf_dir):
    """Perpetuals on the option tape have no dated future; they keep their rows and match nothing."""
    trades = options(spark, sf_dir)
    perpetual = F.concat(currency_of(F.col("instrument_name")), F.lit("-PERPETUAL"))
    extra = trades.filter("direction = 'sell'").withColumn("instrument_name", perpetual)
    return silver_plan.with_forward_price(trades.unionByName(extra), futures(spark, sf_dir)).select(
        "trade_id", "instrument_name", "futures_price")


@query("silver_greeks", _silver("""SELECT trade_id, futures_price, round(delta, 6) AS delta,
    round(gamma, 10) AS gamma, round(vega, 6) AS vega, round(theta, 6) AS theta, is_valid FROM silver"""))
def silver_greeks(spark, sf_dir):
    return rounded(silver(spark, sf_dir).select(
        "trade_id", "futures_price", "delta", "gamma", "vega", "theta", "is_valid"),
        delta=6, gamma=10, vega=6, theta=6)


@query("spot_greeks", f"""WITH {TAPE_SQL},
  spot_d1 AS (SELECT *, {d1_sql('index_price')} AS d1 FROM bronze),
  spot AS (SELECT *, {greeks_sql('index_price', 'implied_volatility > 0 AND time_to_expiry_years > 0')} FROM spot_d1)
  SELECT trade_id, round(delta, 6) AS delta, round(gamma, 10) AS gamma, round(vega, 6) AS vega,
    round(theta, 6) AS theta FROM spot""")
def spot_greeks(spark, sf_dir):
    return rounded(silver_plan.spot_greeks(options(spark, sf_dir)).select(
        "trade_id", "delta", "gamma", "vega", "theta"), delta=6, gamma=10, vega=6, theta=6)


@query("black76_price", f"""WITH {TAPE_SQL},
  spot_d1 AS (SELECT *, {d1_sql('index_price')} AS d1 FROM bronze)
  SELECT trade_id, CASE WHEN implied_volatility IS NOT NULL OR time_to_expiry_years <= 0
    THEN round({price_fraction_sql('index_price')}, 8) END AS price_fraction FROM spot_d1""")
def black76_price(spark, sf_dir):
    trades = options(spark, sf_dir)
    fraction = pricing.black76_price_fraction(
        F.col("index_price"), F.col("strike"), F.col("time_to_expiry_years"),
        metrics.iv_decimal(F.col("implied_volatility")), F.col("option_type"))
    return trades.select("trade_id", F.round(fraction, 8).alias("price_fraction"))


@query("silver_validity", _silver("""SELECT count(*) AS total_trades, count(*) FILTER (WHERE is_valid) AS valid_trades,
    round(count(*) FILTER (WHERE is_valid) * 100.0e0 / count(*), 6) AS valid_pct FROM silver"""))
def silver_validity(spark, sf_dir):
    return rounded(quality.validity_report(silver(spark, sf_dir)), valid_pct=6)


@query("quality_audit", _silver("""SELECT is_valid, count(*) AS trades, count(futures_price) AS has_futures,
    count(delta) AS has_greeks FROM silver GROUP BY 1"""))
def quality_audit(spark, sf_dir):
    return quality.quality_audit(silver(spark, sf_dir))


@query("silver_filter", _silver("""SELECT trade_id, instrument_name, round(delta, 6) AS delta FROM silver
  WHERE is_valid AND delta > 0.3e0"""))
def silver_filter(spark, sf_dir):
    rows = silver(spark, sf_dir).filter(F.col("is_valid") & (F.col("delta") > 0.3))
    return rounded(rows.select("trade_id", "instrument_name", "delta"), delta=6)


@query("risk_filter", _silver("""SELECT trade_id, instrument_name, round(delta, 6) AS delta,
    round(vega, 6) AS vega FROM silver
  WHERE currency = 'BTC' AND delta >= -0.5e0 AND delta <= 0.5e0 AND vega >= 1.0e0"""))
def risk_filter(spark, sf_dir):
    rows = quality.risk_filter(silver(spark, sf_dir), "BTC", {"delta": (-0.5, 0.5), "vega": (1.0, None)})
    return rounded(rows.select("trade_id", "instrument_name", "delta", "vega"), delta=6, vega=6)


# --- gold operators ---

def _forwarded(spark, sf_dir):
    return quality.has_forward(silver(spark, sf_dir))


@query("gold_log_return", _gold("SELECT trade_id, round(log_return, 9) AS log_return FROM gold"))
def gold_log_return(spark, sf_dir):
    rows = _forwarded(spark, sf_dir).select("currency", "timestamp", "trade_seq", "trade_id", "futures_price")
    steps = previous_row(rows, "currency", ["timestamp", "trade_seq", "trade_id"], {"futures_price": "before"})
    ratio = F.ln(F.try_divide("futures_price", "before"))
    return steps.select("trade_id", F.round(ratio, 9).alias("log_return"))


@query("gold_realized_vol", _gold("""SELECT trade_id, round(log_return, 9) AS log_return,
    round(realized_vol_7day, 6) AS realized_vol_7day FROM gold"""))
def gold_realized_vol(spark, sf_dir):
    rows = _forwarded(spark, sf_dir).select("currency", "timestamp", "trade_seq", "trade_id", "futures_price")
    state = market_state(rows, tape.vol_index(spark, sf_dir), measure_cells([rows], "currency"))
    return rounded(state.select("trade_id", "log_return", "realized_vol_7day"), log_return=9, realized_vol_7day=6)


@query("gold_vol_asof", _gold("SELECT trade_id, exchange_realized_vol FROM gold"))
def gold_vol_asof(spark, sf_dir):
    rows = _forwarded(spark, sf_dir).select("currency", "timestamp", "trade_id")
    return asof_join(
        rows, tape.vol_index(spark, sf_dir), "currency", "timestamp", "timestamp",
        {"volatility_value": "exchange_realized_vol"},
    ).select("trade_id", "exchange_realized_vol")


@query("gold_forward_price", _gold("SELECT trade_id, forward_futures_price FROM gold"))
def gold_forward_price(spark, sf_dir):
    rows = _forwarded(spark, sf_dir).select("currency", "timestamp", "trade_seq", "trade_id", "futures_price")
    ahead = rows.withColumn("due", F.col("timestamp") + F.make_dt_interval(days=F.lit(7)))
    return asof_join(
        ahead, rows, "currency", "due", "timestamp", {"futures_price": "forward_futures_price"},
        tie=["trade_seq", "trade_id"], direction="forward",
    ).select("trade_id", "forward_futures_price")


@query("gold_volume_premium", _gold("""SELECT trade_id, trade_volume_7day,
    round(actual_premium_collected, 6) AS actual_premium_collected FROM gold"""))
def gold_volume_premium(spark, sf_dir):
    rows = _flow_rows(spark, sf_dir)
    return rounded(trade_flow(rows, measure_cells([rows], "instrument_name")).select(
        "trade_id", "trade_volume_7day", "actual_premium_collected"), actual_premium_collected=6)


_LATE = "2024-01-10"
_LATE_SQL = f"""
late AS (SELECT * FROM prints WHERE currency = 'BTC' AND day = DATE '{_LATE}'),
calendar AS (
  SELECT key, day, lag(day) OVER (PARTITION BY key ORDER BY day) AS before, lead(day) OVER (PARTITION BY key ORDER BY day) AS after
  FROM (SELECT DISTINCT {{key}} AS key, day FROM prints))"""


@query("gold_state_refreshed", _gold(f"""SELECT g.trade_id, round(g.log_return, 9) AS log_return,
    round(g.realized_vol_7day, 6) AS realized_vol_7day, g.forward_futures_price,
    EXISTS (SELECT 1 FROM calendar c WHERE c.day = DATE '{_LATE}' AND c.key = 'BTC' AND c.key = p.currency
      AND (p.day BETWEEN c.day AND coalesce(c.after, c.day) + 7 OR p.day BETWEEN c.before - 7 AND c.day - 7)) AS recomputed
  FROM gold g JOIN prints p USING (trade_id)""", extra=_LATE_SQL.format(key="currency")))
def gold_state_refreshed(spark, sf_dir):
    """Market state before a day's BTC prints arrived, brought up to date by the days they can have changed."""
    rows = _forwarded(spark, sf_dir).select("currency", "timestamp", "trade_seq", "trade_id", "futures_price")
    late = (F.col("currency") == "BTC") & (F.to_date("timestamp") == _LATE)
    compute = lambda r: market_state(
        r, tape.vol_index(spark, sf_dir), measure_cells([r], "currency")).drop("exchange_realized_vol")
    return _with_recomputed(refreshed(compute(rows.filter(~late)), rows, rows.filter(late), "currency", compute, Reach()),
                            "currency", "trade_id", "log_return", "realized_vol_7day", "forward_futures_price")


@query("gold_flow_refreshed", _gold(f"""SELECT g.trade_id, g.trade_volume_7day,
    round(g.actual_premium_collected, 6) AS actual_premium_collected,
    EXISTS (SELECT 1 FROM late c WHERE c.instrument_name = p.instrument_name AND p.day BETWEEN c.day AND c.day + 7) AS recomputed
  FROM gold g JOIN prints p USING (trade_id)""", extra=_LATE_SQL.format(key="instrument_name")))
def gold_flow_refreshed(spark, sf_dir):
    """The same for the weekly volume and premium of instruments."""
    rows = _flow_rows(spark, sf_dir)
    late = rows["instrument_name"].startswith("BTC-") & (F.to_date("timestamp") == _LATE)
    compute = lambda r: trade_flow(r, measure_cells([r], "instrument_name")).drop("bid_ask_spread_estimate")
    return _with_recomputed(
        refreshed(compute(rows.filter(~late)), rows, rows.filter(late), "instrument_name", compute, Reach(linked=False, ahead=False)),
        "instrument_name", "trade_id", "trade_volume_7day", "actual_premium_collected")


def _with_recomputed(new, by, *columns):
    dirty = new.dirty.select(by, DAY, F.lit(True).alias("recomputed"))
    out = new.whole.withColumn(DAY, F.to_date("timestamp")).join(dirty, [by, DAY], "left").select(
        *columns, F.coalesce("recomputed", F.lit(False)).alias("recomputed"))
    digits = {"log_return": 9, "realized_vol_7day": 6, "actual_premium_collected": 6}
    return rounded(out, **{c: n for c, n in digits.items() if c in columns})


def _flow_rows(spark, sf_dir):
    return _forwarded(spark, sf_dir).select(
        "instrument_name", "timestamp", "trade_seq", "trade_id", "price", "amount")


@query("gold_roll_spread", _gold("""SELECT trade_id,
    round(bid_ask_spread_estimate, 9) AS bid_ask_spread_estimate FROM gold"""))
def gold_roll_spread(spark, sf_dir):
    rows = _flow_rows(spark, sf_dir)
    return rounded(trade_flow(rows, measure_cells([rows], "instrument_name")).select(
        "trade_id", "bid_ask_spread_estimate"), bid_ask_spread_estimate=9)


@query("daily_iv_hist", _gold("SELECT currency, day, iv_bin, count(*) AS bin_count FROM points GROUP BY ALL"))
def iv_daily(spark, sf_dir):
    return daily_iv_hist(_forwarded(spark, sf_dir))


@query("rolling_iv_hist", _gold("""SELECT currency, day, iv_bin,
    CASE WHEN iv_bin > lowest THEN below END AS cum_lt, below + same AS cum_le, everything AS window_total FROM history"""))
def iv_rolling(spark, sf_dir):
    daily = daily_iv_hist(_forwarded(spark, sf_dir))
    keys = ["currency", "day", "iv_bin"]
    return rolling_iv_hist(daily).join(daily.select(*keys), keys, "left_semi")


@query("gold_iv_percentile", _gold("""SELECT trade_id, round(iv_percentile_90day, 9) AS iv_percentile_90day,
    iv_percentile_sample_size, vol_regime FROM gold"""))
def gold_iv_percentile(spark, sf_dir):
    rows = with_iv_percentile(_forwarded(spark, sf_dir).select(
        "currency", "timestamp", "trade_id", "implied_volatility"))
    return rounded(rows.select(
        "trade_id", "iv_percentile_90day", "iv_percentile_sample_size",
        metrics.vol_regime(F.col("iv_percentile_90day")).alias("vol_regime")), iv_percentile_90day=9)


@query("gold_iv_percentile_strict", _gold("""SELECT trade_id, round(strict_percentile, 9) AS iv_percentile_90day,
    strict_sample_size AS iv_percentile_sample_size FROM gold"""))
def gold_iv_percentile_strict(spark, sf_dir):
    """Ranks against earlier days only; bins that never traded before are ranked as well."""
    rows = with_iv_percentile(_forwarded(spark, sf_dir).select(
        "currency", "timestamp", "trade_id", "implied_volatility"), strict_past=True)
    return rounded(rows.select("trade_id", "iv_percentile_90day", "iv_percentile_sample_size"), iv_percentile_90day=9)


@query("gold_execution", _gold("""SELECT trade_id, round(price_vs_mark_deviation, 9) AS price_vs_mark_deviation,
    round(expected_premium, 8) AS expected_premium, round(premium_collection_ratio, 6) AS premium_collection_ratio
  FROM gold"""))
def gold_execution(spark, sf_dir):
    rows = gold_plan.with_execution_quality(_forwarded(spark, sf_dir))
    return rounded(rows.select(
        "trade_id", "price_vs_mark_deviation", "expected_premium", "premium_collection_ratio"),
        price_vs_mark_deviation=9, expected_premium=8, premium_collection_ratio=6)


_ROUNDED = {
    "time_to_expiry_years": 9, "delta": 6, "gamma": 10, "vega": 6, "theta": 6, "realized_vol_7day": 6,
    "iv_percentile_90day": 9, "iv_minus_rv_gap": 6, "bid_ask_spread_estimate": 9,
    "price_vs_mark_deviation": 9, "expected_premium": 8, "actual_premium_collected": 6,
    "premium_collection_ratio": 6, "outcome_forward_return_7day": 9,
}
_GOLD_SELECT = ", ".join(f"round({c}, {_ROUNDED[c]}) AS {c}" if c in _ROUNDED else c for c in GOLD_COLUMNS)


@query("gold_full", _gold(f"SELECT {_GOLD_SELECT} FROM gold"))
def gold_full(spark, sf_dir):
    built = gold_plan.gold(silver(spark, sf_dir), tape.settlements(spark, sf_dir), tape.vol_index(spark, sf_dir))
    return rounded(built.select(*GOLD_COLUMNS), **_ROUNDED)


@query("gold_full_hot", _gold(f"SELECT {_GOLD_SELECT} FROM gold"))
def gold_full_hot(spark, sf_dir):
    """The same with every key hot: cells of minutes to days instead of weeks."""
    built = gold_plan.gold(silver(spark, sf_dir), tape.settlements(spark, sf_dir), tape.vol_index(spark, sf_dir),
                           max_rows_per_cell=HOT_ROWS)
    return rounded(built.select(*GOLD_COLUMNS), **_ROUNDED)


@query("gold_outcomes", _gold("""SELECT trade_id, days_to_expiry, outcome_settlement_price,
    round(outcome_forward_return_7day, 9) AS outcome_forward_return_7day, outcome_assignment_inferred,
    outcome_days_to_assignment FROM gold"""))
def gold_outcomes(spark, sf_dir):
    return rounded(gold(spark, sf_dir).select(
        "trade_id", "days_to_expiry", "outcome_settlement_price", "outcome_forward_return_7day",
        "outcome_assignment_inferred", "outcome_days_to_assignment"), outcome_forward_return_7day=9)


@query("gold_labels", _gold("""SELECT trade_id, strike_delta, vol_regime, round(iv_minus_rv_gap, 6) AS iv_minus_rv_gap,
    round(implied_volatility - 100.0e0 * realized_vol_7day, 4) AS iv_minus_rv_gap_pct FROM gold"""))
def gold_labels(spark, sf_dir):
    gap = metrics.iv_minus_rv_gap_pct(F.col("implied_volatility"), F.col("realized_vol_7day"))
    return rounded(gold(spark, sf_dir).select(
        "trade_id", "strike_delta", "vol_regime", "iv_minus_rv_gap", gap.alias("iv_minus_rv_gap_pct")),
        iv_minus_rv_gap=6, iv_minus_rv_gap_pct=4)


@query("entry_filter", _gold("""SELECT trade_id, strike_delta, days_to_expiry, vol_regime FROM gold
  WHERE is_valid AND strike_delta = '25-delta' AND days_to_expiry BETWEEN 3 AND 30 AND vol_regime = 'high'
    AND iv_minus_rv_gap > 5 AND realized_vol_7day IS NOT NULL"""))
def entry_filter(spark, sf_dir):
    return quality.entry_filter(
        gold(spark, sf_dir), strike_delta="25-delta", dte=(3, 30), vol_regime="high", min_iv_rv_gap=5,
        require_realized_vol=True).select("trade_id", "strike_delta", "days_to_expiry", "vol_regime")


@query("outcome_cohort", _gold("""SELECT strike_delta, vol_regime,
    round(avg(CAST(outcome_assignment_inferred AS INT)), 6) AS assignment_rate,
    round(avg(outcome_forward_return_7day), 9) AS avg_forward_return
  FROM gold WHERE is_valid GROUP BY 1, 2"""))
def outcome_cohort(spark, sf_dir):
    return rounded(quality.outcome_cohort(quality.entry_filter(gold(spark, sf_dir))),
                   assignment_rate=6, avg_forward_return=9)

