"""Readers for the bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from strikelake import schemas
from strikelake.functions.instruments import currency_of


def _scan(spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def file_stem() -> Column:
    """Name of the file a row was read from, without its ending; a folder of part files that bears such a name counts
    as the file."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/=]+)\.parquet(?:/part-[^/]+)?$", 1)


def read_option_trades(spark: SparkSession, path: str | list[str], name_from_file: bool = True) -> DataFrame:
    """All per-instrument files below ``path``; the file name, not the column, names the instrument."""
    trades = _scan(spark, path, schemas.OPTION_TRADES)
    return trades.withColumn("instrument_name", file_stem()) if name_from_file else trades


def read_futures(spark: SparkSession, path: str | list[str], currency: str | None = None) -> DataFrame:
    return _scan(spark, path, schemas.FUTURES_TRADES, f"{currency}-*.parquet" if currency else None)


def read_settlements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Adds delivery_date, the DATE of the stored string."""
    return _scan(spark, path, schemas.SETTLEMENTS).withColumn("delivery_date", F.col("date").cast("date"))


def read_vol_index(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _scan(spark, path, schemas.VOL_INDEX)


def read_instruments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _scan(spark, path, schemas.INSTRUMENTS)


def _read_table(spark: SparkSession, path: str, currency: str | None) -> DataFrame:
    table = spark.read.parquet(path)
    if "currency" not in table.columns:
        table = table.withColumn("currency", currency_of(F.col("instrument_name")))
    return table if currency is None else table.filter(F.col("currency") == currency)


def read_silver(spark: SparkSession, path: str, currency: str | None = None) -> DataFrame:
    """Partitioned by currency: a currency filter prunes directories."""
    return _read_table(spark, path, currency)


def read_gold(spark: SparkSession, path: str, currency: str | None = None) -> DataFrame:
    return _read_table(spark, path, currency)


def optional_input(spark: SparkSession, path: str | None, reader, schema: T.StructType) -> DataFrame:
    """``reader(spark, path)``, or a typed empty frame when the path is None or does not exist.

    The plan is the same either way: left joins against the empty frame give NULL columns.
    """
    if path is not None:
        try:
            return reader(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)
