"""Ladder arithmetic on hand-made gold rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import at
from strikelake.operators import ladders, studies

EXPIRY = at("2024-01-12 08:00:00")
GOLD = T.StructType([
    T.StructField("currency", T.StringType()), T.StructField("instrument_name", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()), T.StructField("trade_seq", T.LongType()),
    T.StructField("trade_id", T.StringType()), T.StructField("price", T.DoubleType()),
    T.StructField("option_type", T.StringType()), T.StructField("expiration_timestamp", T.TimestampNTZType()),
    T.StructField("strike", T.DoubleType()), T.StructField("mark_price", T.DoubleType()),
    T.StructField("delta", T.DoubleType()), T.StructField("futures_price", T.DoubleType()),
    T.StructField("implied_volatility", T.DoubleType()), T.StructField("vol_regime", T.StringType()),
    T.StructField("iv_percentile_90day", T.DoubleType()), T.StructField("realized_vol_7day", T.DoubleType()),
    T.StructField("outcome_settlement_price", T.DoubleType()),
    T.StructField("outcome_assignment_inferred", T.BooleanType()),
    T.StructField("outcome_forward_return_7day", T.DoubleType()), T.StructField("is_valid", T.BooleanType()),
    T.StructField("days_to_expiry", T.IntegerType()), T.StructField("trade_volume_7day", T.LongType()),
])
_seq = iter(range(10**6))


def row(strike, delta, ts, mark=0.01, price=None, settled=39000.0, assigned=None, side="put", **over):
    n = next(_seq)
    stamp = at(ts)
    out = dict(
        currency="BTC", instrument_name=f"BTC-12JAN24-{strike}-{side[0].upper()}", timestamp=stamp, trade_seq=n,
        trade_id=f"t{n}", price=mark if price is None else price, option_type=side, expiration_timestamp=EXPIRY,
        strike=float(strike), mark_price=mark, delta=delta, futures_price=42000.0, implied_volatility=50.0,
        vol_regime="mid", iv_percentile_90day=0.5, realized_vol_7day=0.6, outcome_settlement_price=settled,
        outcome_assignment_inferred=(settled < strike if assigned is None and settled is not None else assigned),
        outcome_forward_return_7day=0.01, is_valid=True, trade_volume_7day=2,
        days_to_expiry=round((EXPIRY - stamp) / dt.timedelta(days=1)))
    out.update(over)
    return tuple(out[f.name] for f in GOLD)


@pytest.fixture(scope="module")
def gold(spark):
    return spark.createDataFrame([
        row(36000, -0.02, "2024-01-02 10:00:00", mark=0.004),
        row(36000, -0.5, "2024-01-02 11:00:00", mark=0.9),          # later print of the same instrument: ignored
        row(38000, -0.06, "2024-01-02 12:00:00", mark=0.008, assigned=None),
        row(40000, -0.11, "2024-01-03 09:00:00", mark=0.02),         # settles at 39000: assigned
        row(36000, -0.01, "2024-01-01 05:00:00", mark=0.0005, is_valid=False),
        row(40000, -0.1, "2024-01-09 00:00:00", mark=0.004, price=0.006),   # next week, crossing for 40000
        row(40000, -0.1, "2024-01-10 00:00:00", mark=0.003, price=0.002),   # later crossing: too late
        row(38000, -0.1, "2024-01-12 09:00:00", mark=0.0001),        # after expiry
        row(36000, -0.02, "2024-01-02 09:00:00", mark=0.0009, side="call"),
    ], GOLD)


@pytest.fixture(scope="module")
def legs(gold):
    chosen = ladders.choose_expiry(ladders.period_expiry_counts(gold))
    return ladders.select_ladder(gold, chosen).filter(F.col("period") == "2024-01-01")


def test_selection(gold, legs):
    counts = ladders.period_expiry_counts(gold)
    assert counts.filter(F.col("period") == "2024-01-01").agg(F.sum("n")).first()[0] == 4
    picked = {r.target_delta: (r.strike, r.mark_price) for r in legs.collect()}
    assert picked == {0.02: (36000.0, 0.004), 0.05: (38000.0, 0.008), 0.10: (40000.0, 0.02)}


def test_one_print_may_serve_several_targets(gold):
    chosen = ladders.every_expiry(ladders.period_expiry_counts(gold, period="day"))
    day = ladders.select_ladder(gold, chosen, period="day").filter(F.col("period") == "2024-01-03").collect()
    assert [r.strike for r in day] == [40000.0] * 3


@pytest.mark.parametrize("method", ["unit", "cash", "notional"])
def test_sizing(legs, method):
    sized = {r.target_delta: r for r in ladders.size_legs(legs, method=method, capital=90000.0).collect()}
    for r in sized.values():
        otm = max((42000 - r.strike) / 42000, 0)
        margin = (max(0.15 - otm, 0.10) + r.mark_price) * 42000
        amount = 30000 / margin if method == "unit" else 30000 / r.strike
        assert r.amount == pytest.approx(amount)
        assert r.capital_usd == pytest.approx(amount * (r.strike if method == "cash" else margin))
        assert r.premium_usd == pytest.approx(r.mark_price * amount * 42000)
        assert r.loss_usd == pytest.approx(max(r.strike - 39000, 0) * amount)


def test_returns_are_linear_in_capital(legs):
    small, large = (ladders.ladder_returns(ladders.size_legs(legs, capital=c)).first() for c in (1.0, 5e4))
    assert large.pnl_pct == pytest.approx(small.pnl_pct) and large.pnl_usd == pytest.approx(5e4 * small.pnl_usd)
    assert small.any_assigned and small.unknown_legs == 0 and small.skew_proxy == 0
    assert small.realized_sharpe == pytest.approx(small.premium_pct / 0.6)


def test_settlement_loss_cases(spark):
    df = spark.createDataFrame([(40000.0, 39000.0, True, 2.0), (40000.0, None, True, 2.0), (40000.0, None, None, 2.0),
                                (38000.0, 39000.0, False, 2.0)],
                               "strike double, outcome_settlement_price double, outcome_assignment_inferred boolean, amount double")
    assert [r[0] for r in df.select(ladders.settlement_loss("put")).collect()] == [2000.0, 80000.0, 0.0, 0.0]
    assert df.select(ladders.settlement_loss("call")).first()[0] == 0.0


def test_early_close_uses_the_first_crossing_after_entry(gold, legs):
    sized = ladders.size_legs(legs)
    closed = {r.target_delta: r for r in ladders.early_close(sized, gold).collect()}
    near = closed[0.10]
    assert near.closed_at == at("2024-01-09 00:00:00")
    assert near.buyback_usd == pytest.approx(0.006 * near.amount * 42000)
    assert near.leg_pnl_usd == pytest.approx(near.premium_usd - near.buyback_usd)  # premium counted once
    # No print before entry or after expiry closes a leg.
    for target in (0.02, 0.05):
        assert closed[target].closed_at is None
        assert closed[target].leg_pnl_usd == pytest.approx(closed[target].premium_usd - closed[target].loss_usd)


def test_liquidity_gate(spark):
    df = spark.createDataFrame([("A", i, EXPIRY, float(v)) for i, v in enumerate([5, 1, 4, 2, 3])],
                               "currency string, period int, expiration_timestamp timestamp_ntz, liquidity double")
    half = ladders.liquidity_gate(df, 0.5)
    assert sorted(r.liquidity for r in half.filter("admitted").collect()) == [4.0, 5.0]
    assert ladders.liquidity_gate(df, 0.0).filter("admitted").count() == 5


def study_rows(spark, n=10, **constant):
    rows = [("A", "c", dt.date(2024, 1, 1) + dt.timedelta(i), EXPIRY, i / 10, 0.01 * (i + 1), 1.0, 0.02 * (i + 1), i == 9,
             0.001 * i, 100.0 + i) for i in range(n)]
    return spark.createDataFrame(rows, "currency string, config string, period date, expiration_timestamp timestamp_ntz, "
                                 "iv_percentile double, pnl_usd double, capital_usd double, premium_pct double, "
                                 "any_assigned boolean, forward_return double, max_loss_usd double").withColumn("pnl_pct", F.col("pnl_usd"))


def test_tertiles_and_upper_median(spark):
    got = {r.tertile: r for r in studies.tertile_stats(study_rows(spark)).collect()}
    assert {k: v.n for k, v in got.items()} == {"low": 3, "mid": 3, "high": 4}
    assert got["high"].median_premium_pct == pytest.approx(0.02 * 9) and got["low"].median_premium_pct == pytest.approx(0.04)
    assert got["high"].assignment_rate == 0.25 and got["mid"].value_low == 0.3


def test_kelly_and_correlation(spark):
    rows = study_rows(spark)
    k = studies.kelly(rows).first()
    win, assigned = sum(0.01 * (i + 1) for i in range(9)) / 9, 0.10
    shortfall = max(win - assigned, 1e-6)
    b = win / shortfall
    assert k.kelly_discrete == pytest.approx((0.9 * b - 0.1) / b)
    values = [0.01 * (i + 1) for i in range(10)]
    mean = sum(values) / 10
    assert k.kelly_mean_variance == pytest.approx(mean / (sum((v - mean) ** 2 for v in values) / 10))
    assert studies.premium_corr(rows).first().r == pytest.approx(1.0)
    assert studies.premium_corr(rows.withColumn("premium_pct", F.lit(1.0))).first().r is None


def test_vol_structure(spark):
    df = spark.createDataFrame([(1.2, 1.0), (0.8, 1.0), (1.0, 1.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(studies.vol_structure(F.col("a"), F.col("b"))).collect()] == [
        "Expansion", "Contraction", "Neutral", None, None]
