"""Writers. Output is split by row count, so a dominant currency never becomes one file or one task.

Rows are dealt to the writing tasks by size first: a write by currency sorts its task's rows, and a task that reads Parquet
back can hold millions of rows that are alike in few bytes.

Silver and gold are counted while they are written: the figures are observed in the stage that writes, where a
partition counts once even if executors are lost, and no second scan is made.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from strikelake.functions.instruments import currency_of
from strikelake.operators.quality import NoValidTradesError
from strikelake.sources.bronze import in_sequence

MAX_RECORDS_PER_FILE = 20_000_000


@dataclass(frozen=True)
class WriteReport:
    """What a write stored: ``rows_in`` (rows of the layer it was made from, None if not asked for), ``rows``, valid
    ones among them, the same per currency asked for, and the seconds of the job."""

    layer: str
    path: str
    rows: int
    valid_rows: int
    seconds: float
    rows_in: int | None = None
    by_currency: dict[str, tuple[int, int]] = field(default_factory=dict)

    @property
    def valid_pct(self) -> float:
        return 100.0 * self.valid_rows / self.rows if self.rows else 0.0

    @property
    def rows_per_second(self) -> float:
        return self.rows / max(self.seconds, 1e-9)

    def require_valid(self) -> WriteReport:
        """The report itself, or NoValidTradesError if the table, or a currency asked for, has rows and none is valid."""
        for name, (rows, valid) in {self.layer: (self.rows, self.valid_rows), **self.by_currency}.items():
            if rows > 0 and valid == 0:
                raise NoValidTradesError(f"{name}: 0 valid trades out of {rows:,}")
        return self


def report_frame(spark: SparkSession, reports: Sequence[WriteReport]) -> DataFrame:
    """One row per report and currency asked for (currency NULL: the whole table); figures that vary by run left out."""
    rows = []
    for r in reports:
        rows.append((r.layer, None, r.rows_in, r.rows, r.valid_rows, r.valid_pct))
        rows += [(r.layer, name, None, n, valid, 100.0 * valid / n if n else 0.0)
                 for name, (n, valid) in r.by_currency.items()]
    return spark.createDataFrame(
        rows, "layer string, currency string, rows_in bigint, rows_out bigint, valid_rows bigint, valid_pct double")


def _by_currency(df: DataFrame) -> DataFrame:
    if "currency" in df.columns:
        return df
    return df.withColumn("currency", currency_of(F.col("instrument_name")))


def _observed_write(df: DataFrame, layer: str, path: str, write, source: DataFrame | None,
                    currencies: Sequence[str]) -> WriteReport:
    valid = F.col("is_valid") if "is_valid" in df.columns else F.lit(True)
    seen = Observation()
    figures = [F.count(F.lit(1)).alias("rows"), F.count_if(valid).alias("valid")]
    for i, name in enumerate(currencies):
        own = F.col("currency") == name
        figures += [F.count_if(own).alias(f"rows{i}"), F.count_if(own & valid).alias(f"valid{i}")]
    begun = time.monotonic()
    write(df.hint("rebalance").observe(seen, *figures))
    seconds = time.monotonic() - begun
    got = {name: int(value or 0) for name, value in seen.get.items()}
    return WriteReport(
        layer, path, got.get("rows", 0), got.get("valid", 0), seconds, None if source is None else source.count(),
        {name: (got.get(f"rows{i}", 0), got.get(f"valid{i}", 0)) for i, name in enumerate(currencies)})


def write_instrument_files(trades: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder ``<instrument>.parquet`` per instrument, its part files in order of trade_seq.

    Prints are dealt over tasks by range, so a hot instrument is written by several.
    """
    named = in_sequence(trades).withColumn("instrument", F.concat("instrument_name", F.lit(".parquet")))
    named.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("instrument").parquet(path)


def write_silver(df: DataFrame, path: str, mode: str = "overwrite", source: DataFrame | None = None,
                 currencies: Sequence[str] = ()) -> WriteReport:
    """Store silver by currency. ``source`` is the stored tape it was made from: its count, which Parquet has in its
    footers, is the report's rows_in. ``currencies`` are counted apart."""
    return _observed_write(_by_currency(df), "silver", path, lambda rows: (
        rows.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("currency").parquet(path)), source, currencies)


def write_gold(df: DataFrame, path: str, mode: str = "overwrite", source: DataFrame | None = None,
               currencies: Sequence[str] = ()) -> WriteReport:
    """Store gold by currency; the report is that of write_silver."""
    return _observed_write(_by_currency(df), "gold", path, lambda rows: (
        rows.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("currency").parquet(path)),
        source, currencies)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Bronze tables other than trades (settlements, vol index, instruments) and futures."""
    df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
