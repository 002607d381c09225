"""A stored tape that a batch can be merged into without reading all of it.

Files hold rows in (instrument_name, trade_seq) order, so each covers a narrow range of keys. Beside them an index has,
per file, instrument and block of ``SEQ_BLOCK`` sequence numbers, the lowest and highest number and a Bloom filter of the
numbers (one bitmap of 4 KB). A batch meets the index by an equality join on (instrument, block); only files whose range and
filter may hold one of its keys are read, and of those only the key columns. New rows are new files with index rows
of their own; files that the index lacks (a merge that was cut short) are read as well.

    <path>/data    the rows
    <path>/index   instrument_name, block, file, low, high, bits
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from strikelake.sources.bronze import in_sequence
from strikelake.sources.storage import as_table

SEQ_BLOCK = 1_000_000
FILTER_BITS = 32_768
#: Hashes of a number per filter: below 1 % of false matches up to 3,400 numbers of a block in a file, then more.
HASHES = 3
KEYS = ["instrument_name", "trade_seq"]
_INDEX = "instrument_name string, block bigint, file string, low bigint, high bigint, bits binary"


def _block(seq: str = "trade_seq"):
    return F.floor(F.col(seq) / SEQ_BLOCK)


def _spots(seq: str = "trade_seq"):
    """The bits of a number."""
    return F.array(*[F.pmod(F.xxhash64(F.col(seq), F.lit(i)), F.lit(FILTER_BITS)) for i in range(HASHES)])


def _is_set(bits, spot):
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(spot, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    power = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (spot.bitwiseAND(7) + 1).cast("int"))
    return byte.bitwiseAND(power) != 0


def _index_of(rows: DataFrame) -> DataFrame:
    """Index rows of the files that ``rows`` (a scan) reads; only keys are read."""
    keyed = rows.select(*KEYS, F.col("_metadata.file_path").alias("file"), F.explode(_spots()).alias("spot"))
    return keyed.groupBy("instrument_name", _block().alias("block"), "file").agg(
        F.min("trade_seq").alias("low"), F.max("trade_seq").alias("high"), F.bitmap_construct_agg("spot").alias("bits"))


def _name(file: str) -> str:
    """A file's address in one spelling: rows and listings write local ones with one slash or three."""
    return re.sub("^file:/+", "file:///", file)


@dataclass(frozen=True)
class TapeStore:
    """A tape in a folder."""

    spark: SparkSession
    path: str

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    def create(self, trades: DataFrame) -> TapeStore:
        """Store ``trades`` as a new tape."""
        in_sequence(trades).write.mode("errorifexists").parquet(self.data)
        _index_of(self.read()).write.mode("overwrite").parquet(f"{self.path}/index")
        return self

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.data)

    def index(self) -> DataFrame:
        try:
            return self.spark.read.schema(_INDEX).parquet(f"{self.path}/index")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _INDEX)

    def files_asked(self, batch: DataFrame) -> list[str]:
        """Files that may hold a key of ``batch``, in order; their number follows the batch, not the tape."""
        keys = batch.select(*KEYS, _block().alias("block")).distinct()
        near = keys.join(self.index(), ["instrument_name", "block"]).filter(
            F.col("trade_seq").between(F.col("low"), F.col("high")))
        may = F.lit(True)
        for spot in [F.element_at(_spots(), i + 1) for i in range(HASHES)]:
            may = may & _is_set("bits", spot)
        asked = {_name(r["file"]) for r in near.filter(may).select("file").distinct().collect()}
        known = {_name(r["file"]) for r in self.index().select("file").distinct().collect()}  # names of files, no rows
        return sorted(asked | (set(self._files()) - known))

    def _files(self) -> list[str]:
        """All data files."""
        return [_name(f) for f in self.read().inputFiles()]

    def stored_keys(self, batch: DataFrame) -> DataFrame:
        """Keys of the files that may hold one of ``batch``."""
        files = self.files_asked(batch)
        schema = self.read().schema
        if not files:
            return self.spark.createDataFrame([], schema).select(*KEYS)
        return self.spark.read.schema(schema).parquet(*files).select(*KEYS)

    def fresh(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` whose key is not stored yet; rows that repeat a key inside the batch all count."""
        return batch.join(self.stored_keys(batch), KEYS, "left_anti")

    def merge(self, batch: DataFrame) -> DataFrame:
        """Append the fresh rows of ``batch`` and give them back (stored). Merging a batch again adds nothing."""
        columns = self.read().columns
        fresh = as_table(self.fresh(batch.select(*columns)).select(*columns), "tape-fresh")
        if fresh.isEmpty():
            return fresh
        before = set(self._files())
        in_sequence(fresh).write.mode("append").parquet(self.data)
        added = [f for f in self._files() if f not in before]
        _index_of(self.spark.read.schema(fresh.schema).parquet(*added)).write.mode("append").parquet(f"{self.path}/index")
        return fresh
