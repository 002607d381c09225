"""Incremental ingest: new-line JSON trade files as a stream, merged into a stored tape.

The tape itself is rebuilt in batch layers; this is the one incremental step, append without duplicates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from strikelake.functions.instruments import with_terms
from strikelake.sources.bronze import build_bronze_options, dedupe_trades, split_trade_json

DATE = "trade_date"
_KEYS = ["instrument_name", "trade_seq"]
_PART = "key_part"
KEYS_PER_BLOCK, INSTRUMENT_PARTS = 100_000, 64


def _key_part():
    """Folder of a key: its block of sequence numbers and a hash of its instrument, so that a batch reads the keys of its
    own instruments and not those of all that have the same numbers."""
    return F.concat_ws("-", F.floor(F.col("trade_seq") / KEYS_PER_BLOCK).cast("string"),
                       F.pmod(F.xxhash64("instrument_name"), F.lit(INSTRUMENT_PARTS)).cast("string"))


def stream_trades(spark: SparkSession, path: str, max_files_per_trigger: int = 1_000) -> tuple[DataFrame, DataFrame]:
    """(accepted API trades, rejected lines) as streaming frames over the JSON files arriving in ``path``."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
    return split_trade_json(lines)


def append_new_trades(target: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer: stored trades win over re-delivered ones, by (instrument_name, trade_seq).

    Beside the tape, ``<target>_keys`` holds the stored keys by block of sequence numbers and hash of the instrument, so
    that a correction with another date is found without reading the tape; only the parts and dates a batch has are read. The tape is
    written first: a batch replayed after a crash finds its rows under its own dates. Of trades that repeat inside a
    batch the earliest stays. Trades whose instrument has no known form go to ``<target>_rejected``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            known = with_terms(batch.select("instrument_name").distinct(), out="terms").filter(
                F.col("terms").isNotNull()).select("instrument_name")
            unknown = batch.join(known, "instrument_name", "left_anti")
            if not unknown.isEmpty():
                unknown.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(f"{target}_rejected")
            trades = dedupe_trades(build_bronze_options(batch.join(known, "instrument_name", "left_semi")))
            fresh = trades.withColumns({DATE: F.to_date("timestamp"), _PART: _key_part()})
            # as many values as the batch has dates and parts
            touched = fresh.agg(F.collect_set(DATE).alias("dates"), F.collect_set(_PART).alias("parts")).first()
            if not touched["dates"]:
                return
            for path, column, values in ((target, DATE, touched["dates"]), (f"{target}_keys", _PART, touched["parts"])):
                stored = _stored(spark, path)
                if stored is not None:
                    seen = stored.filter(F.col(column).isin(values)).select(*_KEYS)
                    fresh = fresh.join(seen, _KEYS, "left_anti")
            fresh = fresh.persist()
            try:
                fresh.drop(_PART).write.mode("append").option("compression", "zstd").partitionBy(DATE).parquet(target)
                fresh.select(*_KEYS, _PART).write.mode("append").partitionBy(_PART).parquet(f"{target}_keys")
            finally:
                fresh.unpersist()
        finally:
            batch.unpersist()

    return write


def _stored(spark: SparkSession, target: str) -> DataFrame | None:
    try:
        return spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
