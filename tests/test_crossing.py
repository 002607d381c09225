"""First crossings against brute force, and what their plan joins on."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strikelake.operators.crossing import first_crossing

START = dt.datetime(2024, 1, 1)
ORDER = ["timestamp", "trade_seq", "trade_id"]


def _tape(rng, n):
    rows = []
    for i in range(n):
        key = rng.choice(["hot"] * 6 + ["a", "b", None])
        # half of the prints within one minute, whole seconds and ties among them
        at = START + (dt.timedelta(days=3, seconds=rng.randint(0, 60)) if rng.random() < 0.5 else
                      dt.timedelta(seconds=rng.randint(0, 9 * 86_400), microseconds=rng.choice([0, 1, 999_999])))
        rows.append((key, at, i % 50, f"t{i}", rng.choice([None, 0.5, 1.0, 2.0, 3.0, 9.0]), float(i)))
    return rows


def _intervals(rng, n):
    out = []
    for i in range(n):
        opens = START + dt.timedelta(seconds=rng.randint(-86_400, 8 * 86_400))
        closes = opens + dt.timedelta(seconds=rng.choice([-5, 0, 30, 3_600, 86_400, 5 * 86_400]))
        out.append((i, rng.choice(["hot", "hot", "a", "b", "none", None]), opens, closes, rng.choice([None, 0.5, 1.0, 1.5])))
    midnight = START + dt.timedelta(days=3)
    return out + [(n, "hot", midnight, midnight + dt.timedelta(days=1), 0.5), (n + 1, "hot", midnight, midnight, 9.0)]


def _expected(legs, rows):
    out = []
    for leg, key, opens, closes, trigger in legs:
        hits = [(at, seq, tid, fill) for k, at, seq, tid, level, fill in rows
                if k is not None and k == key and level is not None and trigger is not None
                and opens < at < closes and level <= trigger]
        if hits:
            first = min(hits)
            out.append((leg, first[0], first[3]))
    return sorted(out)


@pytest.mark.parametrize("max_rows", [1, 5, 40, 1_000_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, max_rows, seed):
    rng = random.Random(seed)
    rows, legs = _tape(rng, 400), _intervals(rng, 60)
    tape = spark.createDataFrame(rows, "k string, timestamp timestamp_ntz, trade_seq long, trade_id string, level double, fill double")
    intervals = spark.createDataFrame(legs, "leg int, k string, opens timestamp_ntz, closes timestamp_ntz, trigger double")
    got = first_crossing(intervals, tape, "k", ["leg"], ORDER, {"timestamp": "at", "fill": "fill"}, max_rows)
    assert sorted(map(tuple, got.collect())) == _expected(legs, rows)


def test_nothing_to_search(spark):
    tape = spark.createDataFrame([], "k string, timestamp timestamp_ntz, trade_seq long, trade_id string, level double, fill double")
    legs = spark.createDataFrame([(1, "a", START, START + dt.timedelta(days=1), 1.0)],
                                 "leg int, k string, opens timestamp_ntz, closes timestamp_ntz, trigger double")
    assert first_crossing(legs, tape, "k", ["leg"], ORDER, {"fill": "fill"}, 10).count() == 0
    assert first_crossing(legs.limit(0), tape, "k", ["leg"], ORDER, {"fill": "fill"}, 10).count() == 0


def test_rows_are_joined_by_key_and_cell(spark):
    rng = random.Random(3)
    tape = spark.createDataFrame(_tape(rng, 50), "k string, timestamp timestamp_ntz, trade_seq long, trade_id string, level double, fill double")
    legs = spark.createDataFrame(_intervals(rng, 9), "leg int, k string, opens timestamp_ntz, closes timestamp_ntz, trigger double")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = first_crossing(legs, tape, "k", ["leg"], ORDER, {"fill": "fill"}, 10)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin [k" in plan and "__cell" in plan.split("SortMergeJoin [k", 1)[1].split("]", 1)[0]
    assert "NestedLoop" not in plan and "BroadcastHashJoin" not in plan and "CartesianProduct" not in plan
