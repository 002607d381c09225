"""Equi-depth cells: sizes, order and completeness, with a burst of one second in a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strikelake.operators.asof import asof_join, previous_row
from strikelake.operators.cells import CELL
from strikelake.operators.depth import all_cells, depth_cells, in_depth_cells

START = dt.datetime(2024, 1, 1)


def burst(spark, n=6000, seed=1):
    """Half of the rows of 'hot' within one second, the rest over ten days; 'cold' and null keys besides."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = ["hot", "hot", "hot", "hot", "cold", None][i % 6]
        micros = rng.randrange(1_000_000) if i % 2 else rng.randrange(10 * 86_400) * 1_000_000
        rows.append((key, START + dt.timedelta(days=4, seconds=7, microseconds=micros) if i % 2
                     else START + dt.timedelta(microseconds=micros), i, f"t{i}", float(i)))
    return spark.createDataFrame(rows, "k string, timestamp timestamp_ntz, trade_seq long, trade_id string, v double").cache()


@pytest.mark.parametrize("limit", [1500, 100, 30])
def test_cells_are_even_and_in_order(spark, limit):
    rows = burst(spark)
    cells = depth_cells([(rows, "timestamp")], "k", limit)
    placed = in_depth_cells(rows, "k", "timestamp", cells)
    assert placed.columns == [*rows.columns, CELL] and placed.count() == rows.count()
    assert placed.filter(f"k IS NULL AND {CELL} IS NOT NULL").isEmpty()
    sized = placed.filter("k = 'hot'").groupBy(CELL).agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).orderBy(CELL).collect()
    assert max(r["n"] for r in sized) <= 2 * limit and sum(r["n"] for r in sized) == 4000
    assert all(a["hi"] < b["lo"] for a, b in zip(sized, sized[1:])), "cells follow one another"
    burst_second = placed.filter("k = 'hot' AND timestamp >= '2024-01-05 00:00:07' AND timestamp < '2024-01-05 00:00:08'")
    inside = [r["n"] for r in burst_second.groupBy(CELL).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(inside) >= 2000 // (2 * limit)
    if limit < 1500:
        middle = sorted(inside)[1:-1]  # the ends share their cell with the rest of the hour
        assert max(middle) <= 2 * min(middle)
    listed = {r[CELL] for r in all_cells(cells, "k").filter("k = 'hot'").collect()}
    assert {r[CELL] for r in sized} <= listed
    cold = placed.filter("k = 'cold'").select(CELL).distinct().collect()
    assert [r[CELL] for r in cold] == [None] if limit >= 1000 else len(cold) > 1


def test_one_instant_is_one_cell(spark):
    rows = spark.createDataFrame([("a", START + dt.timedelta(hours=h), i) for h in range(3) for i in range(50)],
                                 "k string, timestamp timestamp_ntz, i int")
    placed = in_depth_cells(rows, "k", "timestamp", depth_cells([(rows, "timestamp")], "k", 10))
    assert sorted(r["count"] for r in placed.groupBy(CELL).count().collect()) == [50, 50, 50]


@pytest.mark.parametrize("limit", [10**9, 1500, 40])
def test_results_do_not_depend_on_cells(spark, limit):
    rows = burst(spark)
    order = ["timestamp", "trade_seq", "trade_id"]
    pdf = rows.filter("k IS NOT NULL").toPandas().sort_values(["k", *order])
    want = dict(zip(pdf["trade_id"], pdf.groupby("k")["trade_id"].shift()))
    got = previous_row(rows.filter("k IS NOT NULL"), "k", order, {"trade_id": "before"}, limit).collect()
    assert {r["trade_id"]: r["before"] for r in got} == {k: v if isinstance(v, str) else None for k, v in want.items()}
    right = rows.filter("trade_seq % 3 = 0").select("k", "timestamp", "trade_seq", "v")
    for direction in ("backward", "forward"):
        few = asof_join(rows, right, "k", "timestamp", "timestamp", {"v": "w"}, tie=["trade_seq"], direction=direction,
                        max_rows_per_cell=limit)
        one = asof_join(rows, right, "k", "timestamp", "timestamp", {"v": "w"}, tie=["trade_seq"], direction=direction)
        assert few.exceptAll(one).isEmpty() and few.count() == one.count() == rows.count()


def test_empty_streams(spark):
    none = burst(spark).limit(0)
    cells = depth_cells([(none, "timestamp")], "k", 5)
    assert cells.count() == 0 and in_depth_cells(none, "k", "timestamp", cells).count() == 0
