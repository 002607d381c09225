"""Raw API records to typed bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from strikelake import schemas
from strikelake.functions.instruments import time_to_expiry_years, with_terms
from strikelake.functions.timeline import from_epoch_millis

# API field name to model name.
API_NAMES = {
    "trade_id": "id",
    "instrument_name": "instrumentName",
    "index_price": "indexPrice",
    "mark_price": "markPrice",
    "iv": "impliedVolatility",
}
_REQUIRED = [
    "trade_seq", "trade_id", "timestamp", "tick_direction", "price", "instrument_name", "index_price",
    "direction", "amount",
]


def rename_api_trade(raw: DataFrame) -> DataFrame:
    """API field names to the in-memory trade model's names."""
    return raw.select(
        *[F.col(c).alias(n) for c, n in API_NAMES.items()], "price", "amount", "direction", "timestamp"
    )


def ingest_trade_json(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Newline-delimited JSON trades, split into (accepted API trades, rejected lines).

    A line is rejected when it does not parse, lacks a required field, has a field of the wrong type or
    a direction other than buy/sell. ``mark_price`` and ``iv`` may be missing or null.
    """
    return split_trade_json(spark.read.text(path))


def split_trade_json(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As :func:`ingest_trade_json`, for a frame (batch or streaming) with the raw line in ``value``."""
    schema = T.StructType([*schemas.API_TRADE, T.StructField("_bad", T.StringType())])
    trade = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    parsed = lines.filter(F.length(F.trim("value")) > 0).select("value", trade.alias("t"))
    complete = F.lit(True)
    for field in _REQUIRED:
        complete = complete & F.col(f"t.{field}").isNotNull()
    accepted = F.coalesce(
        F.col("t._bad").isNull() & complete & F.col("t.direction").isin("buy", "sell"), F.lit(False)
    )
    good = parsed.filter(accepted).select(*[F.col(f"t.{f.name}").alias(f.name) for f in schemas.API_TRADE])
    return good, parsed.filter(~accepted).select("value")


def _common(raw: DataFrame) -> dict:
    ts = F.col("timestamp")
    if dict(raw.dtypes)["timestamp"] == "bigint":
        ts = from_epoch_millis(ts)
    return {
        "trade_id": F.col("trade_id"),
        "trade_seq": F.col("trade_seq").cast("bigint"),
        "instrument_name": F.col("instrument_name"),
        "timestamp": ts,
        "price": F.col("price").cast("double"),
        "amount": F.col("amount").cast("double"),
        "direction": F.col("direction"),
        "tick_direction": F.col("tick_direction").cast("int"),
        "index_price": F.col("index_price").cast("double"),
        "mark_price": F.col("mark_price").cast("double"),
    }


def build_bronze_options(raw: DataFrame) -> DataFrame:
    """API trades to option_trades: contract terms from the name; NULL terms for futures and perpetuals.

    A name that does not parse fails the job, as no contract terms exist for it.
    """
    typed = with_terms(raw.select(
        *[c.alias(n) for n, c in _common(raw).items()],
        F.col("iv").cast("double").alias("implied_volatility"),
    ), out="__terms").withColumn("__terms", F.coalesce("__terms", F.raise_error(
        F.concat(F.lit("invalid instrument: "), F.col("instrument_name")))))
    expiry = F.col("__terms.expiration_timestamp")
    return typed.withColumns({
        "futures_price": F.lit(None).cast("double"),
        "strike": F.col("__terms.strike"),
        "expiration_timestamp": expiry,
        "option_type": F.col("__terms.option_type"),
        "time_to_expiry_years": time_to_expiry_years(expiry, F.col("timestamp")),
    }).select(*[f.name for f in schemas.OPTION_TRADES])


def build_bronze_futures(raw: DataFrame) -> DataFrame:
    return raw.select(*[c.alias(n) for n, c in _common(raw).items()])


def build_settlements(raw: DataFrame, index_name: str | None = None) -> DataFrame:
    """(date, delivery_price) records to settlements, stamped with midnight UTC of the date."""
    index = F.lit(index_name) if index_name is not None else F.col("index_name")
    return raw.select(
        index.alias("index_name"), F.col("date"), F.col("delivery_price").cast("double").alias("delivery_price"),
        F.col("date").cast("date").cast("timestamp_ntz").alias("timestamp"),
    )


def build_vol_index(raw: DataFrame, currency: str | None = None) -> DataFrame:
    """Flatten API responses ``[[timestamp_ms, value], ...]`` held as JSON text in ``result``."""
    cur = F.lit(currency) if currency is not None else F.col("currency")
    pair = F.explode(F.from_json("result", "array<array<double>>"))
    return raw.select(cur.alias("currency"), pair.alias("p")).select(
        "currency", from_epoch_millis(F.col("p")[0].cast("bigint")).alias("timestamp"),
        F.col("p")[1].alias("volatility_value"),
    )


def build_instruments(raw: DataFrame) -> DataFrame:
    """Instrument master; fields the API leaves out are NULL."""
    optional = {
        "expiration_timestamp": "timestamp_ntz", "strike": "double", "option_type": "string",
        "is_active": "boolean", "settlement_period": "string",
    }
    types = dict(raw.dtypes)
    columns = [F.col(c).cast("string").alias(c) for c in ("instrument_name", "kind", "base_currency")]
    for name, to in optional.items():
        if name not in types:
            columns.append(F.lit(None).cast(to).alias(name))
        elif name == "expiration_timestamp" and types[name] == "bigint":
            columns.append(from_epoch_millis(F.col(name)).alias(name))
        else:
            columns.append(F.col(name).cast(to).alias(name))
    return raw.select(*columns)


def merge_trades(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing rows plus new rows whose (instrument_name, trade_seq) is not stored yet.

    Duplicates inside ``new`` are kept, as in the tape's own merge; use dedupe_trades to drop them. A frame has
    no order of its own: ``in_sequence`` is the order in which a tape is stored.
    """
    keys = ["instrument_name", "trade_seq"]
    fresh = new.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def in_sequence(trades: DataFrame) -> DataFrame:
    """Range-partitioned and sorted by instrument and trade_seq: files written from it hold ordered runs."""
    order = ["instrument_name", "trade_seq"]
    return trades.repartitionByRange(*order).sortWithinPartitions(*order)


def dedupe_trades(df: DataFrame) -> DataFrame:
    """One row per (instrument_name, trade_seq): the earliest by (timestamp, trade_id).

    One shuffle on the keys; the limit of one row per key is applied before it as well, so that a heavily
    copied key stays small.
    """
    first = Window.partitionBy("instrument_name", "trade_seq").orderBy("timestamp", "trade_id")
    return df.withColumn("__nth", F.row_number().over(first)).filter("__nth = 1").drop("__nth")
