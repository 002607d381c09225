"""What writers report, against counts of what they stored."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strikelake.operators.quality import NoValidTradesError
from strikelake.sources import writers

SCHEMA = "instrument_name string, timestamp timestamp_ntz, is_valid boolean"


def _rows(n, valid=lambda i: i % 3 == 0):
    return [(["BTC-1JAN24-1-C", "ETH-1JAN24-1-P"][i % 2], dt.datetime(2024, 1, 1), valid(i)) for i in range(n)]


@pytest.mark.parametrize("write", [writers.write_silver, writers.write_gold])
def test_report_counts_what_is_stored(spark, tmp_path, write):
    rows = spark.createDataFrame(_rows(90), SCHEMA).repartition(4)
    report = write(rows, str(tmp_path / "t"), source=spark.range(100), currencies=["BTC", "ETH", "SOL"])
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert report.rows == stored.count() == 90 and report.rows_in == 100
    assert report.valid_rows == stored.filter("is_valid").count() == 30 and report.valid_pct == pytest.approx(100 / 3)
    assert report.by_currency == {"BTC": (45, 15), "ETH": (45, 15), "SOL": (0, 0)}
    assert report.require_valid() is report and report.rows_per_second > 0
    frame = writers.report_frame(spark, [report])
    assert frame.count() == 4 and frame.filter("currency = 'SOL'").first()["valid_pct"] == 0.0


def test_reports_without_rows_or_valid_rows(spark, tmp_path):
    empty = writers.write_silver(spark.createDataFrame([], SCHEMA), str(tmp_path / "a"))
    assert (empty.rows, empty.valid_rows, empty.valid_pct, empty.rows_in) == (0, 0, 0.0, None)
    empty.require_valid()
    some = spark.createDataFrame(_rows(10, lambda i: None if i % 2 else True), SCHEMA)
    report = writers.write_silver(some, str(tmp_path / "b"), currencies=["BTC", "ETH"])
    with pytest.raises(NoValidTradesError, match="ETH: 0 valid trades out of 5"):
        report.require_valid()
    with pytest.raises(NoValidTradesError, match="silver"):
        writers.write_silver(some.filter("is_valid IS NULL"), str(tmp_path / "c")).require_valid()


def test_a_table_is_read_once_for_its_report(spark, tmp_path):
    spark.range(1000).selectExpr("'BTC-1' AS instrument_name", "id % 2 = 0 AS is_valid").write.parquet(str(tmp_path / "in"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.read.parquet(str(tmp_path / "in"))
    report = writers.write_gold(rows.mapInArrow(count, rows.schema), str(tmp_path / "out"))
    assert report.rows == 1000 and report.valid_rows == 500 and seen.value == 1000
    assert spark.read.parquet(str(tmp_path / "out")).filter(F.col("is_valid")).count() == 500


@pytest.mark.parametrize("write", [writers.write_silver, writers.write_gold])
def test_a_large_read_is_written_by_several_tasks(spark, tmp_path, write):
    """What one task reads is dealt by size before the write sorts it by currency."""
    rows = spark.range(200_000).selectExpr(
        "CASE WHEN id % 5 = 0 THEN 'ETH' ELSE 'BTC' END AS currency", "id", "uuid() AS trade_id", "true AS is_valid").coalesce(1)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        report = write(rows, str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "currency=BTC").glob("*.parquet"))) > 1
    assert report.rows == report.valid_rows == spark.read.parquet(str(tmp_path / "t")).count() == 200_000
