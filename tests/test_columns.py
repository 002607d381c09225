import math

import pytest
from pyspark.sql import functions as F

from frames import at
from strikelake.functions import metrics, pricing
from strikelake.functions.instruments import currency_of, future_key, parse_instrument, time_to_expiry_years
from strikelake.functions.timeline import epoch_millis, from_epoch_millis, period_of


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1)


def values(one, **columns):
    return one.select(*[c.alias(n) for n, c in columns.items()]).first()


def lits(*numbers):
    return [F.lit(float(n)) for n in numbers]


def call():
    return F.lit("call")


def put():
    return F.lit("put")


def test_names(spark):
    names = ["BTC-PERPETUAL", "BTC-5AUG16", "BTC-15JUL16", "BTC-8APR26-64500-P", "BTC-29MAR24-50000-C",
             "BTC-8XXX26-1-P", "BTC", "A-B-C", "ETH-31FEB24-1500.5-X", "BTC-8APR26-abc-C", "BTC-APR26-1-C"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.t for r in df.select("n", parse_instrument(F.col("n")).alias("t")).collect()}
    assert got["BTC-PERPETUAL"].instrument_type == "perpetual" and got["BTC-PERPETUAL"].expiration_timestamp is None
    assert got["BTC-5AUG16"].expiration_timestamp == at("2016-08-05 08:00:00")
    assert got["BTC-15JUL16"].instrument_type == "future" and got["BTC-15JUL16"].strike is None
    option = got["BTC-8APR26-64500-P"]
    assert (option.underlying, option.strike, option.option_type) == ("BTC", 64500.0, "put")
    assert got["BTC-29MAR24-50000-C"].option_type == "call"
    assert [got[n] for n in ("BTC-8XXX26-1-P", "BTC", "A-B-C", "BTC-APR26-1-C")] == [None] * 4
    # Day overflow rolls over, anything but C is a put, a bad strike is NULL.
    assert got["ETH-31FEB24-1500.5-X"].expiration_timestamp == at("2024-03-02 08:00:00")
    assert (got["ETH-31FEB24-1500.5-X"].strike, got["ETH-31FEB24-1500.5-X"].option_type) == (1500.5, "put")
    assert got["BTC-8APR26-abc-C"].strike is None


def test_future_key_and_currency(one):
    r = values(one, a=future_key(F.lit("BTC-8APR26-64500-P")), b=future_key(F.lit("BTC-8APR26")),
               c=currency_of(F.lit("USDC-8APR26-1-P")))
    assert (r.a, r.b, r.c) == ("BTC-8APR26", None, "USDC")


def test_calendar_ignores_the_session_zone(one):
    # 02:30 on 2024-03-10 does not exist in the session's zone.
    ts = F.lit("2024-03-10 02:30:00.123456").cast("timestamp_ntz")
    r = values(one, ms=epoch_millis(ts), back=from_epoch_millis(epoch_millis(ts)), week=period_of(ts, "week"),
               tte=time_to_expiry_years(F.lit("2024-03-10 08:30:00").cast("timestamp_ntz"), ts))
    assert r.ms == 1710037800123
    assert r.back == at("2024-03-10 02:30:00.123000")
    assert str(r.week) == "2024-03-04"
    assert r.tte == pytest.approx((6 * 3600 - 0.123) / (365.25 * 86400))


def test_time_to_expiry_floor_and_null(one):
    late, early = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-02 00:00:00", "2024-01-01 00:00:00"))
    r = values(one, past=time_to_expiry_years(early, late), none=time_to_expiry_years(F.lit(None).cast("timestamp_ntz"), late))
    assert (r.past, r.none) == (0.0, None)


def test_put_call_parity_and_monotonicity(one):
    f, k, t = lits(50000, 50000, 0.25)
    c = pricing.black76_price(f, k, t, F.lit(0.8), call())
    p = pricing.black76_price(f, F.lit(48000.0), t, F.lit(0.8), put())
    c2 = pricing.black76_price(f, F.lit(48000.0), t, F.lit(0.8), call())
    lower = pricing.black76_price(f, k, t, F.lit(0.4), call())
    r = values(one, c=c, p=p, c2=c2, lower=lower)
    assert r.c > 1000 and r.lower < r.c
    assert r.c2 - r.p == pytest.approx(2000, abs=0.01)


def test_price_matches_closed_form(one):
    def cdf(x):
        return 0.5 * (1 + math.erf(x / math.sqrt(2)))

    f, k, t, s = 52000.0, 50000.0, 0.1, 0.65
    d1 = (math.log(f / k) + s * s * t / 2) / (s * math.sqrt(t))
    d2 = d1 - s * math.sqrt(t)
    cols = lits(f, k, t, s)
    r = values(one, g=pricing.greeks_bundle(*cols, call())).g
    assert r.price == pytest.approx(f * cdf(d1) - k * cdf(d2), rel=1e-5)
    assert r.delta == pytest.approx(cdf(d1), abs=1e-6)
    pdf = math.exp(-d1 * d1 / 2) / math.sqrt(2 * math.pi)
    assert r.gamma == pytest.approx(pdf / (f * s * math.sqrt(t)))
    assert r.vega == pytest.approx(f * pdf * math.sqrt(t) / 100)
    assert r.theta == pytest.approx(-f * pdf * s / (2 * math.sqrt(t) * 365))


def test_rate_and_discount_forms(one):
    cols = lits(52000, 50000, 0.1, 0.65)
    zero = pricing.theta(*cols, call())
    r = values(one, zero=zero, with_rate=pricing.theta(*cols, call(), rate=0.05), puts=pricing.theta(*cols, put(), rate=0.05),
               disc=pricing.black76_price(*cols, call(), discount=0.5), full=pricing.black76_price(*cols, call()), put=pricing.black76_price(*cols, put()))
    # The carry is the rate on the option's own price, per day.
    assert r.with_rate - r.zero == pytest.approx(0.05 * r.full / 365)
    assert r.puts - r.zero == pytest.approx(0.05 * r.put / 365, rel=1e-6)
    assert r.disc == pytest.approx(r.full / 2)


@pytest.mark.parametrize("side,forward,expected", [
    ("call", 55000, 1.0), ("call", 50000, 0.0), ("put", 45000, -1.0), ("put", 50000, 0.0)])
def test_at_expiry(one, side, forward, expected):
    f, k, t, s = lits(forward, 50000, 0, 0.5)
    g = values(one, g=pricing.greeks_bundle(f, k, t, s, F.lit(side))).g
    assert (g.delta, g.gamma, g.vega, g.theta) == (expected, 0.0, 0.0, 0.0)
    assert g.price == max(0, (forward - 50000) * (1 if side == "call" else -1))


def test_price_fraction_facts(one):
    deep = pricing.black76_price_fraction(*lits(110000, 20000, 0.005, 0.65), call())
    dead = pricing.black76_price_fraction(*lits(66000, 60000, 0, 0.65), put())
    flat = pricing.black76_price_fraction(*lits(66000, 60000, 0.1, 0), call())
    r = values(one, deep=deep * 110000, dead=dead, flat=flat * 66000)
    assert r.deep >= 90000 - 1e-6 and r.dead == 0 and r.flat == pytest.approx(6000)


def test_unusable_inputs_give_null(one):
    r = values(one, a=pricing.delta(*lits(0, 50000, 0.1, 0.5), call()), b=pricing.gamma(*lits(50000, 50000, 0.1, 0)),
               c=pricing.vega(*lits(-1, 50000, 0.1, 0.5)))
    assert (r.a, r.b, r.c) == (None, None, None)


@pytest.mark.parametrize("strike,settled,side,threshold,expected", [
    (50000, 55000, "call", 0.005, "ITM"), (50000, 45000, "call", 0.005, "OTM"), (50000, 50100, "call", 0.005, "ATM"),
    (50000, 45000, "put", 0.005, "ITM"), (50000, 50500, "call", 0.01, "ATM"), (50000, 50500, "call", 0.001, "ITM")])
def test_moneyness(one, strike, settled, side, threshold, expected):
    k, s = lits(strike, settled)
    r = values(one, m=metrics.moneyness(k, s, F.lit(side), threshold), itm=metrics.is_itm(k, s, F.lit(side)))
    assert r.m == expected
    if threshold == 0.005:
        assert r.itm == (expected == "ITM")


def test_intrinsic_and_percentage(one):
    r = values(one, a=metrics.intrinsic_value(*lits(50000, 55000), call()), b=metrics.intrinsic_value(*lits(50000, 55000), put()),
               c=metrics.moneyness_percentage(*lits(50000, 55000), call()), d=metrics.moneyness_percentage(*lits(50000, 55000), put()))
    assert (r.a, r.b, r.c, r.d) == (5000.0, 0.0, 10.0, -10.0)


def test_premium_yield(one):
    r = values(one, a=metrics.annualized_premium_yield(*lits(0.002, 50000, 65000, 30)),
               b=metrics.annualized_premium_yield(*lits(0.002, 50000, 65000, 90)),
               **{f"n{i}": metrics.annualized_premium_yield(*lits(*[0 if j == i else 1 for j in range(4)])) for i in range(4)})
    assert r.a == pytest.approx(3.16, abs=0.01) and r.b == pytest.approx(1.05, abs=0.01)
    assert [r[f"n{i}"] for i in range(4)] == [None] * 4


def test_iv_rank(one):
    cases = [(70, 40, 100, 50.0), (85, 50, 90, 87.5), (55, 50, 90, 12.5), (20, 50, 90, 0.0), (95, 50, 90, 100.0), (60, 60, 60, 50.0)]
    r = values(one, none=metrics.iv_rank(F.lit(60.0), F.lit(None).cast("double"), F.lit(None).cast("double")),
               **{f"c{i}": metrics.iv_rank(*lits(*c[:3])) for i, c in enumerate(cases)})
    assert [r[f"c{i}"] for i in range(len(cases))] == [c[3] for c in cases] and r.none is None


def test_stress_ev(spark):
    assert sum(p for _, p in metrics.STRESS_SCENARIOS) == pytest.approx(1.0)
    df = spark.createDataFrame([(1, 0.002, 60000.0, 65000.0, "put"), (2, 0.001, 50000.0, 65000.0, "call"),
                                (3, 0.0, 50000.0, 65000.0, "call"), (4, 0.01, 1e9, 65000.0, "call")],
                               "i int, p double, k double, s double, o string")
    got = {r.i: r for r in metrics.with_stress_ev(df, F.col("p"), F.col("k"), F.col("s"), F.col("o")).collect()}
    assert got[1].max_loss_btc < -0.3 and got[1].max_gain_btc == pytest.approx(0.002)
    assert got[2].expected_value_btc < 0 and got[2].win_probability < 50
    assert got[3].expected_value_btc is None and got[3].win_probability is None
    assert got[4].sharpe_ratio is None or abs(got[4].sharpe_ratio) > 1e6  # no spread in outcomes
    assert got[4].win_probability == pytest.approx(100)
    pnl = [0.001 - max(0, 65000 * (1 + m / 100) - 50000) / (65000 * (1 + m / 100)) for m, _ in metrics.STRESS_SCENARIOS]
    mean = sum(x * p for x, (_, p) in zip(pnl, metrics.STRESS_SCENARIOS))
    assert got[2].expected_value_btc == pytest.approx(mean)


def test_labels(spark):
    df = spark.createDataFrame([(0.05,), (-0.1,), (0.25,), (-0.5,), (0.51,), (None,)], "d double")
    assert [r[0] for r in df.select(metrics.strike_delta(F.col("d"))).collect()] == [
        "5-delta", "10-delta", "25-delta", "50-delta", "deep-itm", None]
    df = spark.createDataFrame([(0.32,), (0.33,), (0.67,), (None,)], "p double")
    assert [r[0] for r in df.select(metrics.vol_regime(F.col("p"))).collect()] == ["low", "mid", "high", None]


def test_bins_and_days_round_half_even(spark):
    df = spark.createDataFrame([(1.25,), (1.75,), (-3.0,), (5000.0,), (None,)], "iv double")
    assert [r[0] for r in df.select(metrics.iv_bin(F.col("iv"))).collect()] == [2, 4, 0, 1999, None]
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    expiry = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-03 12:00:00", "2024-01-04 12:00:00")]
    r = spark.range(1).select(*[metrics.days_to_expiry(e, ts) for e in expiry]).first()
    assert tuple(r) == (2, 4)


def test_percentile_of_the_lowest_bin_is_zero(one):
    none = F.lit(None).cast("bigint")
    n = lambda v: F.lit(v).cast("bigint")
    r = values(one, low=metrics.iv_percentile(F.lit(50.0), none, n(5), n(40)), mid=metrics.iv_percentile(F.lit(50.0), n(10), n(20), n(40)),
               few=metrics.iv_percentile(F.lit(50.0), n(1), n(2), n(19)), unknown=metrics.iv_percentile(F.lit(None).cast("double"), n(1), n(2), n(40)))
    assert (r.low, r.mid, r.few, r.unknown) == (0.0, 0.375, None, None)


def test_execution_guards(one):
    r = values(one, a=metrics.price_vs_mark_deviation(*lits(1, 0)), b=metrics.roll_spread(F.lit(-0.25), F.lit(5)),
               c=metrics.roll_spread(F.lit(-0.25), F.lit(4)), d=metrics.roll_spread(F.lit(0.25), F.lit(9)),
               e=metrics.premium_collection_ratio(*lits(0.05, 2, 0.1)), f=metrics.premium_collection_ratio(*lits(0.05, 2, 0.0001)),
               g=metrics.assignment_inferred(F.lit(55000.0), F.lit(50000.0), call()), h=metrics.assignment_inferred(F.lit(50000.0), F.lit(50000.0), put()),
               i=metrics.assignment_inferred(F.lit(None).cast("double"), F.lit(50000.0), put()))
    assert (r.a, r.b, r.c, r.d) == (None, 1.0, None, None)
    assert r.e == pytest.approx(1.0) and r.f is None
    assert (r.g, r.h, r.i) == (True, False, None)
