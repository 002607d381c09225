"""Merging into a stored tape: the same rows as a plain merge, and only the files that matter are read."""

import random

import pytest
from pyspark.sql import functions as F

from strikelake.sources.bronze import merge_trades
from strikelake.sources.tapestore import SEQ_BLOCK, TapeStore

SCHEMA = "instrument_name string, trade_seq long, trade_id string, price double"


def _rows(rng, n, names="abc", low=0, high=5_000):
    return [(rng.choice(names), rng.randint(low, high), f"t{rng.random()}", float(i)) for i in range(n)]


def _plain(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_equals_a_plain_merge(spark, tmp_path, seed):
    rng = random.Random(seed)
    old = spark.createDataFrame(_rows(rng, 400), SCHEMA)
    store = TapeStore(spark, str(tmp_path / "tape")).create(old)
    want = old
    for n, high in ((50, 5_000), (1, 5_000), (80, 3 * SEQ_BLOCK), (0, 1)):
        batch = spark.createDataFrame(_rows(rng, n, "abcd", 0, high) + old.limit(3 if n else 0).collect(), SCHEMA)
        expected = merge_trades(want, batch).exceptAll(want)
        want = spark.createDataFrame(merge_trades(want, batch).collect(), SCHEMA)
        added = store.merge(batch)
        assert _plain(added) == _plain(expected)
        assert _plain(store.read()) == _plain(want)
        assert store.merge(batch).isEmpty(), "a batch that comes again adds nothing"
    assert _plain(store.read()) == _plain(want)


def test_untouched_files_are_not_read(spark, tmp_path):
    rows = [("a", i, f"a{i}", 1.0) for i in range(0, 4000, 2)] + [("b", i, f"b{i}", 1.0) for i in range(0, 4000, 2)]
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = TapeStore(spark, str(tmp_path / "tape")).create(spark.createDataFrame(rows, SCHEMA).repartition(4))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    every = store._files()
    assert len(every) >= 6
    inside = spark.createDataFrame([("a", 10, "x", 0.0), ("a", 12, "y", 0.0)], SCHEMA)
    asked = store.files_asked(inside)
    assert len(asked) == 1 < len(every)
    read = store.stored_keys(inside).inputFiles()
    assert [f.split("/")[-1] for f in read] == [f.split("/")[-1] for f in asked]
    beyond = spark.createDataFrame([("a", 9_000, "x", 0.0), ("c", 1, "y", 0.0)], SCHEMA)
    assert store.files_asked(beyond) == []
    between = spark.createDataFrame([("a", 2 * i + 1, "x", 0.0) for i in range(200)], SCHEMA)
    assert len(store.files_asked(between)) <= 2, "inside the range, but not in the filter"
    plan = store.fresh(inside)._jdf.queryExecution().executedPlan().toString()
    assert "price" not in plan.split("left_anti")[-1].split("ReadSchema")[-1]


def test_files_without_an_index_are_read(spark, tmp_path):
    store = TapeStore(spark, str(tmp_path / "tape")).create(spark.createDataFrame([("a", 1, "t1", 1.0)], SCHEMA))
    late = spark.createDataFrame([("z", 7, "t7", 1.0)], SCHEMA)
    late.write.mode("append").parquet(store.data)  # cut short before its index rows
    assert store.merge(late).isEmpty() and store.read().count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.create(late)


def test_many_numbers_in_one_block(spark, tmp_path):
    rows = spark.range(30_000).select(F.lit("a").alias("instrument_name"), (F.col("id") * 3).alias("trade_seq"),
                                      F.col("id").cast("string").alias("trade_id"), F.lit(1.0).alias("price"))
    store = TapeStore(spark, str(tmp_path / "tape")).create(rows)
    again = store.merge(rows.withColumn("trade_seq", F.col("trade_seq") + 1).unionByName(rows))
    assert again.count() == 30_000 and store.read().count() == 60_000
