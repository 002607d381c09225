"""Positions of rows against a plain sort."""

import random

import pytest

from strikelake.operators.ordering import positioned


@pytest.mark.parametrize("n,parts", [(0, 1), (1, 1), (700, 1), (700, 9)])
def test_positions_equal_a_sort(spark, n, parts):
    rng = random.Random(n)
    rows = [(rng.choice(["a", "b", "é", None]), rng.randint(0, 40), i) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, s int, i int").repartition(parts)
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "5")
        got = positioned(df, ["k", "s", "i"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    want = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(1, n + 1))


def test_rows_are_not_gathered(spark):
    df = spark.range(100).withColumnRenamed("id", "i")
    plan = positioned(df, ["i"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.replace("Exchange SinglePartition, ENSURE", "") and "Window" in plan


def test_ties_are_positions_too(spark):
    df = spark.createDataFrame([(1, i) for i in range(50)], "k int, i int").repartition(4)
    assert sorted(r["position"] for r in positioned(df, ["k"]).collect()) == list(range(1, 51))
