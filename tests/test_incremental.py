"""A result brought up to date by days equals one computed anew, on sparse tapes with gaps of weeks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strikelake.operators.flow import trade_flow
from strikelake.operators.incremental import DAY, Reach, refreshed
from strikelake.operators.market import market_state

START = dt.datetime(2024, 1, 1)


def _tape(spark, seed, by, value, n=120, days=150):
    rng = random.Random(seed)
    busy = sorted(rng.sample(range(days), 14))  # few days have prints: gaps of weeks
    rows = []
    for i in range(n):
        key = rng.choice(["A", "A", "A", "B", "C"])
        day = rng.choice(busy) if key != "B" else rng.choice(busy[:4] + busy[-4:])
        rows.append((key, START + dt.timedelta(days=day, seconds=rng.choice([0, 1, 40_000, rng.randrange(86_400)])), i, f"t{i}",
                     100 + rng.randrange(1000) / 10, float(i % 3 + 1)))
    return spark.createDataFrame(
        rows, f"{by} string, timestamp timestamp_ntz, trade_seq bigint, trade_id string, {value} double, amount double").cache()


def _rows(df):
    names = sorted(df.columns)
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()), key=str)


@pytest.mark.parametrize("seed,late", [(1, "trade_seq % 41 = 0"), (2, "trade_seq = 17"), (3, "A"), (4, "trade_seq < 0")])
def test_market_state(spark, seed, late):
    tape = _tape(spark, seed, "currency", "futures_price").drop("amount")
    test = F.expr(late) if late != "A" else (F.col("currency") == "A") & (F.dayofyear("timestamp") > 60)
    index = spark.createDataFrame([], "currency string, timestamp timestamp_ntz, volatility_value double")
    compute = lambda r: market_state(r, index).drop("exchange_realized_vol")
    new = refreshed(compute(tape.filter(~test)), tape, tape.filter(test), "currency", compute, Reach())
    assert _rows(new.whole) == _rows(compute(tape))
    touched = {r["currency"] for r in tape.filter(test).collect()}
    assert {r["currency"] for r in new.dirty.collect()} <= touched
    if seed == 2:
        all_days = tape.select("currency", F.to_date("timestamp").alias(DAY)).distinct().count()
        assert 0 < new.dirty.count() < all_days, "other days keep their rows"
    if seed == 4:
        assert new.dirty.isEmpty() and new.changed.isEmpty()


@pytest.mark.parametrize("seed", [5, 6])
def test_trade_flow(spark, seed):
    tape = _tape(spark, seed, "instrument_name", "price")
    test = F.expr("trade_seq % 37 = 0")
    compute = lambda r: trade_flow(r).drop("bid_ask_spread_estimate")
    new = refreshed(compute(tape.filter(~test)), tape, tape.filter(test), "instrument_name", compute, Reach(False, False))
    assert _rows(new.whole) == _rows(compute(tape))
