"""Every registered query against its SQL on whole tables, and the shape of the main plans."""

import os
import re

import pytest
from pyspark.sql import functions as F

import compare
from strikelake.operators.asof import asof_join
from strikelake.plans.gold import gold
from strikelake.plans.silver import silver
from strikelake.queries import ALL, registry, tape
from strikelake.session import tuned

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(f"{SF}/events.parquet"):
        pytest.skip("no test tables")
    return compare.connect(SF)


def test_every_query_has_sql():
    assert ALL and all(e.sql for e in ALL.values())


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_equals_sql(spark, con, name):
    got = compare.spark_rows(ALL[name].run(spark, SF))
    want = compare.duck_rows(con, ALL[name].sql)
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


@pytest.mark.parametrize("limit", [3000, 100])
def test_gold_does_not_depend_on_cell_widths(spark, con, limit):
    options, futures = registry.options(spark, SF), registry.futures(spark, SF)
    cold = silver(options, futures)
    hot = silver(options, futures, max_rows_per_cell=limit)
    assert hot.exceptAll(cold).isEmpty() and cold.count() == hot.count()
    base = registry.silver(spark, SF)
    other = gold(base, tape.settlements(spark, SF), tape.vol_index(spark, SF), max_rows_per_cell=limit)
    digits = {"realized_vol_7day": 9, "iv_minus_rv_gap": 9, "actual_premium_collected": 9}
    a, b = (registry.rounded(df, **digits) for df in (registry.gold(spark, SF), other))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["silver_asof_forward", "gold_full", "legacy_enriched", "early_close"])
def test_plans(spark, con, name):
    plan = _plan(ALL[name].run(spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas",
                 "FlatMapGroupsInPandas", "SinglePartition"):
        assert node not in plan, node


def test_asof_shuffles_the_tape_once(spark, con):
    plan = _plan(silver(registry.options(spark, SF), registry.futures(spark, SF)))
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(__future" in line]
    # the tape itself, and three exchanges of the list of cells and their edges
    assert len(wide) <= 4 and len(re.findall(r"(?<!Broadcast)Exchange ", plan)) == len(wide)
    assert "_extract_" not in plan, "carried rows stay packed"
    copied = [line for line in plan.splitlines() if "Generate " in line]
    assert all("__start" in line and "__row" not in line for line in copied), "cells are listed, no print is copied"


def test_scans_are_pruned(spark, con):
    rows = registry.silver(spark, SF).select("currency", "timestamp", "trade_id")
    index = tape.vol_index(spark, SF)
    plan = _plan(asof_join(rows, index, "currency", "timestamp", "timestamp", {"volatility_value": "v"}))
    reads = [r for r in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "trade_id" in r]
    assert reads and all(len(r.split(",")) <= 3 for r in reads)
    filtered = _plan(registry.gold(spark, SF).filter(F.col("is_valid") & (F.col("option_type") == "put")))
    assert "EqualTo(option_type,put)" in filtered


def test_queries_on_layers_limit_generated_methods(spark):
    """Methods that the JVM does not compile took half of the time of the widest gold stage."""
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    registry.silver(spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_tasks_read_little_unless_the_session_says_otherwise(spark):
    name = "spark.sql.files.maxPartitionBytes"
    spark.conf.unset(name)
    assert tuned(spark).conf.get(name) == "32m"
    spark.conf.set(name, "16m")
    assert tuned(spark).conf.get(name) == "16m"
    spark.conf.unset(name)
