"""Queries for ladder selection, returns and studies. Tables hold all currencies, so currency is a key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import functions as F

from strikelake.operators import ladders, studies
from strikelake.operators.ladders import DELTA_GRID, LADDERS
from strikelake.queries.oracle_sql import GOLD_SQL
from strikelake.queries.registry import gold, query, rounded

_ENTRY = "currency, period, expiration_timestamp"
_KEY = f"{_ENTRY}, config"
_ORDER = "timestamp, trade_seq, trade_id"


def ladder_sql(side: str = "put", period: str = "week", every: bool = False, method: str = "unit",
               capital: float = 1.0, configs: Mapping[str, Sequence[float]] = LADDERS) -> str:
    """CTEs valid, counts, chosen, firsts, legs, sized, returns on top of gold."""
    targets = ", ".join(f"('{n}', {t}e0, {len(ts)})" for n, ts in configs.items() for t in ts)
    chosen = (
        f"SELECT {_ENTRY}, min(days_to_expiry) AS days_to_expiry, sum(n) AS n FROM counts GROUP BY ALL" if every else
        f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY currency, period
          ORDER BY abs(days_to_expiry - 7), n DESC, expiration_timestamp, days_to_expiry) AS rn FROM counts)
        WHERE rn = 1""")
    gap = "entry_forward - strike" if side == "put" else "strike - entry_forward"
    lost = "strike - outcome_settlement_price" if side == "put" else "outcome_settlement_price - strike"
    share = f"({capital}e0 / legs)"
    amount = f"{share} / margin" if method == "unit" else f"{share} / strike"
    locked = "strike" if method == "cash" else "margin"
    return f"""{GOLD_SQL},
valid AS (
  SELECT *, CAST(date_trunc('{period}', timestamp) AS DATE) AS period FROM gold
  WHERE is_valid AND option_type = '{side}'
),
counts AS (
  SELECT {_ENTRY}, days_to_expiry, count(*) AS n FROM valid
  WHERE days_to_expiry BETWEEN 3 AND 10 GROUP BY ALL
),
chosen AS ({chosen}),
firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT v.* EXCLUDE (days_to_expiry), c.days_to_expiry,
      row_number() OVER (PARTITION BY v.currency, v.period, v.expiration_timestamp, v.instrument_name
        ORDER BY v.timestamp, v.trade_seq, v.trade_id) AS rn
    FROM valid v JOIN chosen c ON c.currency = v.currency AND c.period = v.period
      AND c.expiration_timestamp = v.expiration_timestamp)
  WHERE rn = 1
),
legs AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT f.*, t.config, t.target_delta, t.legs, row_number() OVER (
      PARTITION BY {_KEY}, target_delta ORDER BY abs(abs(delta) - target_delta), instrument_name) AS rn
    FROM firsts f CROSS JOIN (VALUES {targets}) t(config, target_delta, legs))
  WHERE rn = 1
),
margins AS (
  SELECT *, (greatest(0.15e0 - greatest(({gap}) / entry_forward, 0.0e0), 0.10e0) + mark_price) * entry_forward
    AS margin
  FROM (SELECT *, first_value(futures_price) OVER (PARTITION BY {_KEY} ORDER BY target_delta) AS entry_forward
        FROM legs)
),
sized AS (
  SELECT *, amount * {locked} AS capital_usd, mark_price * amount * entry_forward AS premium_usd,
    CASE WHEN outcome_assignment_inferred THEN CASE WHEN outcome_settlement_price IS NULL THEN strike
      ELSE greatest({lost}, 0.0e0) END * amount ELSE 0.0e0 END AS loss_usd
  FROM (SELECT * EXCLUDE (amount), {amount} AS amount FROM margins)
),
totals AS (
  SELECT {_KEY}, min(days_to_expiry) AS days_to_expiry, count(*) AS legs, sum(capital_usd) AS capital_usd,
    sum(premium_usd) AS premium_usd, sum(loss_usd) AS loss_usd,
    coalesce(bool_or(outcome_assignment_inferred), FALSE) AS any_assigned,
    count(*) FILTER (WHERE outcome_assignment_inferred IS NULL) AS unknown_legs,
    sum(strike * amount) AS notional, min(strike) AS strike_min, min(entry_forward) AS entry_forward,
    arg_max_null(vol_regime, target_delta) AS vol_regime,
    arg_max_null(iv_percentile_90day, target_delta) AS iv_percentile,
    arg_max_null(realized_vol_7day, target_delta) AS realized_vol_7day,
    arg_max_null(outcome_forward_return_7day, target_delta) AS forward_return,
    arg_max_null(implied_volatility, target_delta) AS near_iv,
    arg_min_null(implied_volatility, target_delta) AS deep_iv,
    arg_min_null(amount, target_delta) AS deep_amount,
    arg_min_null(premium_usd, target_delta) AS deep_premium_usd
  FROM sized GROUP BY {_KEY}
),
returns AS (
  SELECT *, premium_usd / capital_usd AS premium_pct, premium_usd - loss_usd AS pnl_usd,
    (premium_usd - loss_usd) / capital_usd AS pnl_pct, loss_usd > capital_usd AS margin_breach,
    notional - premium_usd AS max_loss_usd, (deep_iv - near_iv) / near_iv AS skew_proxy,
    CASE WHEN realized_vol_7day > 0 THEN premium_usd / capital_usd / realized_vol_7day END AS realized_sharpe
  FROM totals
)"""


def _sql(body: str, **options) -> str:
    return f"WITH {ladder_sql(**options)} {body}"


def _chosen(g, side="put", period="week", every=False):
    counts = ladders.period_expiry_counts(g, side, period=period)
    return ladders.every_expiry(counts) if every else ladders.choose_expiry(counts)


def _sized(g, side="put", period="week", every=False, method="unit", capital=1.0, configs=LADDERS):
    legs = ladders.select_ladder(g, _chosen(g, side, period, every), configs, side, period)
    return ladders.size_legs(legs, side, method, capital)


def _returns(g, **options):
    return ladders.ladder_returns(_sized(g, **options))


# --- selection ---

@query("period_expiry_counts", _sql("SELECT * FROM counts"))
def period_expiry_counts(spark, sf_dir):
    return ladders.period_expiry_counts(gold(spark, sf_dir))


@query("choose_expiry", _sql("SELECT currency, period, expiration_timestamp, days_to_expiry, n FROM chosen"))
def choose_expiry(spark, sf_dir):
    return _chosen(gold(spark, sf_dir))


@query("choose_expiry_daily", _sql(
    "SELECT currency, period, expiration_timestamp, days_to_expiry, n FROM chosen", period="day"))
def choose_expiry_daily(spark, sf_dir):
    return _chosen(gold(spark, sf_dir), period="day")


_LIQUIDITY = f"""liquidity AS (
  SELECT {_ENTRY}, CAST(sum(trade_volume_7day) AS DOUBLE) AS liquidity
  FROM valid JOIN (SELECT {_ENTRY} FROM chosen) USING ({_ENTRY}) GROUP BY ALL
)"""
_GATED = f"""{_LIQUIDITY},
gated AS (
  SELECT l.*, l.liquidity > t.threshold AS admitted FROM liquidity l JOIN (
    SELECT currency, max(liquidity) FILTER (WHERE rn = floor(cnt * 0.5e0) + 1) AS threshold
    FROM (SELECT *, count(*) OVER (PARTITION BY currency) AS cnt, row_number() OVER (
            PARTITION BY currency ORDER BY liquidity, period, expiration_timestamp) AS rn FROM liquidity)
    GROUP BY 1) t USING (currency)
)"""


@query("expiry_liquidity", f"WITH {ladder_sql(period='day')}, {_LIQUIDITY} SELECT * FROM liquidity")
def expiry_liquidity(spark, sf_dir):
    g = gold(spark, sf_dir)
    return ladders.expiry_liquidity(g, _chosen(g, period="day"), period="day")


@query("liquidity_gate", f"WITH {ladder_sql(period='day')}, {_GATED} SELECT * FROM gated")
def liquidity_gate(spark, sf_dir):
    g = gold(spark, sf_dir)
    return ladders.liquidity_gate(ladders.expiry_liquidity(g, _chosen(g, period="day"), period="day"), 0.5)


@query("entry_outcomes", f"""WITH {ladder_sql(period='day')}, {_GATED},
  entered AS (SELECT DISTINCT {_ENTRY}, TRUE AS has_legs FROM legs)
  SELECT currency, CASE WHEN NOT coalesce(admitted, FALSE) THEN 'liquidity' WHEN has_legs IS NULL THEN 'legs'
    ELSE 'entered' END AS status, count(*) AS entries
  FROM chosen LEFT JOIN (SELECT {_ENTRY}, admitted FROM gated) USING ({_ENTRY})
    LEFT JOIN entered USING ({_ENTRY}) GROUP BY 1, 2""")
def entry_outcomes(spark, sf_dir):
    g = gold(spark, sf_dir)
    chosen = _chosen(g, period="day")
    gated = ladders.liquidity_gate(ladders.expiry_liquidity(g, chosen, period="day"), 0.5)
    return ladders.entry_outcomes(chosen, gated, ladders.select_ladder(g, chosen, period="day"))


_LEG_COLUMNS = ["currency", "period", "expiration_timestamp", "config", "target_delta", "instrument_name", "strike",
                "mark_price", "delta", "futures_price"]
_LEG_SQL = "SELECT " + ", ".join("round(delta, 6) AS delta" if c == "delta" else c for c in _LEG_COLUMNS) + " FROM legs"


def _legs(g, side="put", period="week", every=False, configs=LADDERS):
    chosen = _chosen(g, side, period, every)
    return rounded(ladders.select_ladder(g, chosen, configs, side, period).select(*_LEG_COLUMNS), delta=6)


@query("select_ladder", _sql(_LEG_SQL))
def select_ladder(spark, sf_dir):
    return _legs(gold(spark, sf_dir))


@query("select_ladder_multi_expiry", _sql(_LEG_SQL, every=True))
def select_ladder_multi_expiry(spark, sf_dir):
    return _legs(gold(spark, sf_dir), every=True)


# --- sizing and returns ---

_SIZE_COLUMNS = ["currency", "period", "expiration_timestamp", "config", "target_delta", "instrument_name"]
_SIZE_DIGITS = {"amount": 10, "capital_usd": 6, "premium_usd": 6, "loss_usd": 6}
_SIZE_SQL = "SELECT " + ", ".join(_SIZE_COLUMNS) + ", " + ", ".join(
    f"round({c}, {n}) AS {c}" for c, n in _SIZE_DIGITS.items()) + " FROM sized"


def _size_query(name: str, method: str, capital: float):
    @query(name, _sql(_SIZE_SQL, method=method, capital=capital, period="day"))
    def run(spark, sf_dir):
        sized = _sized(gold(spark, sf_dir), method=method, capital=capital, period="day")
        return rounded(sized.select(*_SIZE_COLUMNS, *_SIZE_DIGITS), **_SIZE_DIGITS)

    return run


cash_secured_size = _size_query("cash_secured_size", "cash", 100000.0)
fixed_notional_margin = _size_query("fixed_notional_margin", "notional", 100000.0)
unit_capital_size = _size_query("unit_capital_size", "unit", 100000.0)

_RETURN_COLUMNS = ["currency", "period", "expiration_timestamp", "config", "days_to_expiry", "legs", "any_assigned",
                   "unknown_legs", "margin_breach", "strike_min"]
_RETURN_DIGITS = {"capital_usd": 9, "premium_usd": 9, "loss_usd": 9, "premium_pct": 9, "pnl_usd": 9, "pnl_pct": 9,
                  "max_loss_usd": 9, "skew_proxy": 9, "realized_sharpe": 9}
_RETURN_SQL = "SELECT " + ", ".join(_RETURN_COLUMNS) + ", " + ", ".join(
    f"round({c}, {n}) AS {c}" for c, n in _RETURN_DIGITS.items()) + " FROM returns"


def _return_query(name: str, **options):
    @query(name, _sql(_RETURN_SQL, **options))
    def run(spark, sf_dir):
        returns = _returns(gold(spark, sf_dir), **options)
        return rounded(returns.select(*_RETURN_COLUMNS, *_RETURN_DIGITS), **_RETURN_DIGITS)

    return run


ladder_returns = _return_query("ladder_returns")
call_ladder = _return_query("call_ladder", side="call")
daily_ladder = _return_query("daily_ladder", period="day")
multi_expiry = _return_query("multi_expiry", every=True)
delta_grid = _return_query("delta_grid", period="day", configs=DELTA_GRID)


@query("ladder_summary", _sql("""SELECT currency, config, count(*) AS ladders,
    count(*) FILTER (WHERE premium_pct > 0.0038e0) AS hits,
    round(count(*) FILTER (WHERE premium_pct > 0.0038e0) / CAST(count(*) AS DOUBLE), 9) AS hit_rate,
    count(*) FILTER (WHERE any_assigned) AS assigned,
    round(count(*) FILTER (WHERE any_assigned) / CAST(count(*) AS DOUBLE), 9) AS assignment_rate,
    round(sum(premium_usd), 9) AS total_premium, round(sum(loss_usd), 9) AS total_loss,
    round(sum(pnl_usd), 9) AS total_pnl, round(sum(loss_usd) / sum(premium_usd), 9) AS loss_share,
    CAST(sum(unknown_legs) AS BIGINT) AS unknown_legs,
    count(*) FILTER (WHERE margin_breach) AS margin_breaches
  FROM returns GROUP BY 1, 2""", period="day"))
def ladder_summary(spark, sf_dir):
    return rounded(ladders.ladder_summary(_returns(gold(spark, sf_dir), period="day")),
                   hit_rate=9, assignment_rate=9, total_premium=9, total_loss=9, total_pnl=9, loss_share=9)


_CLOSED = f"""closes AS (
  SELECT {_KEY}, target_delta, closed_at, fill FROM (
    SELECT s.currency, s.period, s.expiration_timestamp, s.config, s.target_delta, g.timestamp AS closed_at,
      g.price AS fill, row_number() OVER (
        PARTITION BY s.currency, s.period, s.expiration_timestamp, s.config, s.target_delta
        ORDER BY g.timestamp, g.trade_seq, g.trade_id) AS rn
    FROM sized s JOIN gold g ON g.instrument_name = s.instrument_name AND g.is_valid
      AND g.timestamp > s.timestamp AND g.timestamp < s.expiration_timestamp
      AND g.mark_price <= s.mark_price * 0.25e0)
  WHERE rn = 1
),
closed AS (
  SELECT s.*, c.closed_at, c.fill * s.amount * s.entry_forward AS buyback_usd,
    s.premium_usd - coalesce(c.fill * s.amount * s.entry_forward, s.loss_usd) AS leg_pnl_usd
  FROM sized s LEFT JOIN closes c USING ({_KEY}, target_delta)
)"""


@query("early_close_legs", f"""WITH {ladder_sql(period='day')}, {_CLOSED}
  SELECT {_KEY}, target_delta, instrument_name, closed_at, round(buyback_usd, 9) AS buyback_usd,
    round(leg_pnl_usd, 9) AS leg_pnl_usd FROM closed""")
def early_close_legs(spark, sf_dir):
    g = gold(spark, sf_dir)
    closed = ladders.early_close(_sized(g, period="day"), g)
    return rounded(closed.select(*ladders.KEY, "target_delta", "instrument_name", "closed_at", "buyback_usd",
                                 "leg_pnl_usd"), buyback_usd=9, leg_pnl_usd=9)


def _early(name: str, period: str):
    @query(name, f"""WITH {ladder_sql(period=period)}, {_CLOSED}
      SELECT {_KEY}, round(sum(capital_usd), 9) AS capital_usd, round(sum(premium_usd), 9) AS premium_usd,
        round(sum(leg_pnl_usd), 9) AS pnl_usd, count(closed_at) AS closed_legs, max(closed_at) AS last_close,
        round(sum(leg_pnl_usd) / sum(capital_usd), 9) AS pnl_pct
      FROM closed GROUP BY ALL""")
    def run(spark, sf_dir):
        g = gold(spark, sf_dir)
        out = ladders.early_close_returns(ladders.early_close(_sized(g, period=period), g))
        return rounded(out, capital_usd=9, premium_usd=9, pnl_usd=9, pnl_pct=9)

    return run


early_close = _early("early_close", "week")
early_close_daily = _early("early_close_daily", "day")


# --- studies (daily ladders) ---

_RV30 = """periods AS (SELECT DISTINCT currency, period FROM returns),
rv30 AS (
  SELECT currency, period, stddev_samp(r) * sqrt(365 * 24) AS realized_vol_30day FROM (
    SELECT p.currency, p.period, ln(v.futures_price / lag(v.futures_price) OVER (
      PARTITION BY p.currency, p.period ORDER BY v.timestamp, v.trade_seq, v.trade_id)) AS r
    FROM periods p JOIN valid v ON v.currency = p.currency AND v.timestamp <= CAST(p.period AS TIMESTAMP)
      AND v.timestamp >= CAST(p.period AS TIMESTAMP) - INTERVAL 30 DAYS)
  GROUP BY 1, 2
),
structured AS (
  SELECT r.*, v.realized_vol_30day,
    CASE WHEN r.realized_vol_7day / v.realized_vol_30day > 1.1e0 THEN 'Expansion'
      WHEN r.realized_vol_7day / v.realized_vol_30day < 0.9e0 THEN 'Contraction'
      WHEN r.realized_vol_7day / v.realized_vol_30day IS NOT NULL THEN 'Neutral' END AS vol_structure
  FROM returns r LEFT JOIN rv30 v USING (currency, period)
)"""


def _structured(g):
    returns = _returns(g, period="day")
    trailing = studies.trailing_vol_at(g, returns)
    return studies.with_vol_structure(returns, trailing)


@query("rv_trailing_30d", f"""WITH {ladder_sql(period='day')}, {_RV30}
  SELECT currency, period, config, round(realized_vol_7day, 6) AS realized_vol_7day,
    round(realized_vol_30day, 6) AS realized_vol_30day, vol_structure FROM structured""")
def rv_trailing_30d(spark, sf_dir):
    return rounded(_structured(gold(spark, sf_dir)).select(
        "currency", "period", "config", "realized_vol_7day", "realized_vol_30day", "vol_structure"),
        realized_vol_7day=6, realized_vol_30day=6)


@query("regime_returns", f"""WITH {ladder_sql(period='day')}, {_RV30}
  SELECT currency, config, vol_structure, count(*) AS n,
    round(sum(pnl_usd) / sum(capital_usd), 9) AS return_on_capital,
    round(count(*) FILTER (WHERE premium_pct > 0.0038e0) / CAST(count(*) AS DOUBLE), 9) AS hit_rate,
    round(avg(premium_pct), 9) AS avg_premium_pct, count(*) FILTER (WHERE any_assigned) AS assignments
  FROM structured WHERE vol_structure IS NOT NULL GROUP BY 1, 2, 3""")
def regime_returns(spark, sf_dir):
    return rounded(studies.regime_returns(_structured(gold(spark, sf_dir))),
                   return_on_capital=9, hit_rate=9, avg_premium_pct=9)


@query("filter_study", f"""WITH {ladder_sql(period='day')}, {_RV30},
  kept AS (SELECT *, vol_structure IS DISTINCT FROM 'Contraction' AS keep FROM structured)
  SELECT currency, config, count(*) AS n, count(*) FILTER (WHERE keep) AS n_kept,
    round(sum(pnl_usd), 9) AS pnl, round(coalesce(sum(pnl_usd) FILTER (WHERE keep), 0), 9) AS pnl_kept,
    round(sum(pnl_usd) / sum(capital_usd), 9) AS return_all,
    round(sum(pnl_usd) FILTER (WHERE keep) / sum(capital_usd) FILTER (WHERE keep), 9) AS return_kept
  FROM kept GROUP BY 1, 2""")
def filter_study(spark, sf_dir):
    out = studies.filter_study(_structured(gold(spark, sf_dir)), F.col("vol_structure") == "Contraction")
    return rounded(out, pnl=9, pnl_kept=9, return_all=9, return_kept=9)


def _tertile_sql(value: str) -> str:
    return f"""labelled AS (
  SELECT *, CASE WHEN rk < floor(cnt / 3.0e0) THEN 'low' WHEN rk < floor(cnt * 2 / 3.0e0) THEN 'mid' ELSE 'high' END
    AS tertile
  FROM (SELECT *, row_number() OVER (PARTITION BY currency, config
          ORDER BY {value}, period, expiration_timestamp) - 1 AS rk,
          count(*) OVER (PARTITION BY currency, config) AS cnt
        FROM {{source}} WHERE {value} IS NOT NULL)
)"""


def _median(column: str) -> str:
    return f"list_sort(list({column}) FILTER (WHERE {column} IS NOT NULL))[" \
           f"CAST(floor(count({column}) / 2.0e0) AS BIGINT) + 1]"


_STATS_DIGITS = dict(value_low=9, value_high=9, assignment_rate=9, total_pnl=9, total_capital=9,
                     median_premium_pct=9, median_forward_return=9, median_max_loss=9)


def _tertiles(name: str, value: str):
    @query(name, f"""WITH {ladder_sql(period='day')}, {_tertile_sql(value).format(source='returns')}
      SELECT currency, config, tertile, count(*) AS n, round(min({value}), 9) AS value_low,
        round(max({value}), 9) AS value_high,
        round(count(*) FILTER (WHERE any_assigned) / CAST(count(*) AS DOUBLE), 9) AS assignment_rate,
        round(sum(pnl_usd), 9) AS total_pnl, round(sum(capital_usd), 9) AS total_capital,
        round({_median('premium_pct')}, 9) AS median_premium_pct,
        round({_median('forward_return')}, 9) AS median_forward_return,
        round({_median('max_loss_usd')}, 9) AS median_max_loss
      FROM labelled GROUP BY 1, 2, 3""")
    def run(spark, sf_dir):
        return rounded(studies.tertile_stats(_returns(gold(spark, sf_dir), period="day"), value), **_STATS_DIGITS)

    return run


tertile_stats = _tertiles("tertile_stats", "iv_percentile")
skew_tertiles = _tertiles("skew_tertiles", "skew_proxy")


@query("premium_corr", _sql("""SELECT currency, config, count(*) AS n,
    round(CASE WHEN isnan(corr(iv_percentile, premium_pct)) THEN NULL ELSE corr(iv_percentile, premium_pct) END, 8) AS r
  FROM returns WHERE iv_percentile IS NOT NULL GROUP BY 1, 2""", period="day"))
def premium_corr(spark, sf_dir):
    return rounded(studies.premium_corr(_returns(gold(spark, sf_dir), period="day")), r=8)


@query("kelly", _sql("""
  SELECT currency, config, n, wins, round(avg_win, 9) AS avg_win, round(avg_assigned, 9) AS avg_assigned,
    round(mean_return, 9) AS mean_return, round(variance, 9) AS variance, round(shortfall, 9) AS shortfall,
    round(avg_win / shortfall, 6) AS win_loss_ratio,
    round((wins / CAST(n AS DOUBLE) * (avg_win / shortfall) - (1 - wins / CAST(n AS DOUBLE)))
      / (avg_win / shortfall), 6) AS kelly_discrete,
    round(CASE WHEN variance > 0 THEN mean_return / variance END, 6) AS kelly_mean_variance
  FROM (SELECT *, CASE WHEN avg_assigned IS NOT NULL AND avg_win IS NOT NULL
          THEN greatest(avg_win - avg_assigned, 1e-6) END AS shortfall
        FROM (SELECT currency, config, count(*) AS n, count(*) FILTER (WHERE NOT any_assigned) AS wins,
                avg(pnl_pct) FILTER (WHERE NOT any_assigned) AS avg_win,
                avg(pnl_pct) FILTER (WHERE any_assigned) AS avg_assigned,
                avg(pnl_pct) AS mean_return, var_pop(pnl_pct) AS variance
              FROM returns GROUP BY 1, 2))""", period="day"))
def kelly(spark, sf_dir):
    return rounded(studies.kelly(_returns(gold(spark, sf_dir), period="day")),
                   avg_win=9, avg_assigned=9, mean_return=9, variance=9, shortfall=9, win_loss_ratio=6,
                   kelly_discrete=6, kelly_mean_variance=6)


@query("regime_kelly", _sql("""
  SELECT currency, config, vol_regime, count(*) AS n, round(avg(pnl_pct), 9) AS mean_return,
    round(var_pop(pnl_pct), 9) AS variance,
    round(CASE WHEN var_pop(pnl_pct) > 0 THEN avg(pnl_pct) / var_pop(pnl_pct) END, 6) AS kelly_mean_variance
  FROM returns WHERE vol_regime IS NOT NULL GROUP BY 1, 2, 3""", period="day"))
def regime_kelly(spark, sf_dir):
    return rounded(studies.regime_kelly(_returns(gold(spark, sf_dir), period="day")),
                   mean_return=9, variance=9, kelly_mean_variance=6)


_HEDGED = f"""hedges AS (
  SELECT {_ENTRY}, mark_price AS hedge_mark, strike AS hedge_strike, delta AS hedge_delta FROM (
    SELECT *, row_number() OVER (PARTITION BY {_ENTRY} ORDER BY abs(abs(delta) - 0.01e0), instrument_name) AS rn
    FROM firsts) WHERE rn = 1
),
hedged AS (
  SELECT r.*, h.hedge_strike, h.hedge_delta, h.hedge_mark * r.deep_amount * r.entry_forward AS hedge_cost_usd
  FROM returns r LEFT JOIN hedges h USING ({_ENTRY})
)"""


def _hedged(g):
    return ladders.with_tail_hedge(_returns(g, period="day"), ladders.first_prints(g, period="day"))


@query("tail_hedge", f"""WITH {ladder_sql(period='day')}, {_HEDGED}
  SELECT {_KEY}, hedge_strike, round(hedge_delta, 6) AS hedge_delta, round(hedge_cost_usd, 9) AS hedge_cost_usd
  FROM hedged""")
def tail_hedge(spark, sf_dir):
    return rounded(_hedged(gold(spark, sf_dir)).select(*ladders.KEY, "hedge_strike", "hedge_delta", "hedge_cost_usd"),
                   hedge_delta=6, hedge_cost_usd=9)


@query("skew_hedge", f"""WITH {ladder_sql(period='day')}, {_HEDGED},
  {_tertile_sql('skew_proxy').format(source='hedged')}
  SELECT currency, config, tertile, count(*) AS n, round(sum(premium_usd), 9) AS premium,
    round(sum(hedge_cost_usd), 9) AS hedge_cost, round(sum(hedge_cost_usd) / sum(premium_usd), 9) AS cost_share,
    round(coalesce(sum(loss_usd) FILTER (WHERE any_assigned AND hedge_cost_usd IS NOT NULL), 0), 9) AS hedge_benefit,
    count(*) FILTER (WHERE any_assigned) AS assignments, round(sum(pnl_usd), 9) AS pnl,
    round(sum(pnl_usd) - coalesce(sum(hedge_cost_usd), 0), 9) AS pnl_after_hedge
  FROM labelled GROUP BY 1, 2, 3""")
def skew_hedge(spark, sf_dir):
    return rounded(studies.hedge_study(_hedged(gold(spark, sf_dir))),
                   premium=9, hedge_cost=9, cost_share=9, hedge_benefit=9, pnl=9, pnl_after_hedge=9)
