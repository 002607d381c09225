"""Trade tape, settlements and vol index derived from the ``events`` table, in Spark and in SQL.

``error`` events are futures prints, all others option prints. Names, prices and IVs are arithmetic on
the event's own columns, so the tape grows with the table. The raw frames have the API's field names and
go through the same bronze builders as real data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strikelake import schemas
from strikelake.functions.timeline import epoch_millis
from strikelake.sources.bronze import build_bronze_futures, build_bronze_options, build_settlements, build_vol_index
from strikelake.sources.storage import as_table

# Expression text both engines understand.
_CURRENCY = "CASE WHEN user_id % 5 = 4 THEN 'ETH' ELSE 'BTC' END"
_CODE = ("CASE user_id % 4 WHEN 0 THEN '12JAN24' WHEN 1 THEN '26JAN24' WHEN 2 THEN '2FEB24' "
         "ELSE '29MAR24' END")
_FUTURE = f"concat({_CURRENCY}, '-', {_CODE})"
_STRIKE = "36000 + 1000 * (user_id % 9)"
_SIDE = "CASE WHEN floor(user_id / 4.0) % 2 = 0 THEN 'C' ELSE 'P' END"
_OPTION = f"concat({_FUTURE}, '-', cast({_STRIKE} AS string), '-', {_SIDE})"
_PRICE = "(value + 1.0e0) / 5000.0e0"
_INDEX = "40000.0e0 + value * 20.0e0"
_MARK = f"({_PRICE}) * (0.95e0 + 0.01e0 * (event_id % 11))"
_IV = ("CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 0.0e0 "
       "ELSE 30.0e0 + value / 5.0e0 END")

# Settlement of the two expiries after the tape ends.
_LATE = "('2024-02-02', 41000.0e0), ('2024-03-29', 39500.0e0)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _raw(df: DataFrame, name: str, price: str) -> DataFrame:
    return df.selectExpr(
        "concat('t', cast(event_id AS string)) AS trade_id", "event_id AS trade_seq", f"{name} AS instrument_name",
        "ts AS timestamp", f"{price} AS price", "cast(1 + event_id % 5 AS double) AS amount",
        "CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS direction",
        "cast(event_id % 4 AS int) AS tick_direction", f"{_INDEX} AS index_price",
        f"{_MARK} AS mark_price", f"{_IV} AS iv",
    )


def raw_option_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(events(spark, sf_dir).filter("event_type <> 'error'"), _OPTION, _PRICE)


def raw_futures_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(events(spark, sf_dir).filter("event_type = 'error'"), _FUTURE, _INDEX).drop("iv")


def option_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_bronze_options(raw_option_trades(spark, sf_dir))


def futures_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_bronze_futures(raw_futures_trades(spark, sf_dir))


def settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settlements as a stored bronze table."""
    return stored(spark, sf_dir, "settlements", lambda: _settlements(spark, sf_dir))


def _settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = (
        events(spark, sf_dir).selectExpr(
            f"concat(lower({_CURRENCY}), '_usd') AS index_name", "cast(cast(ts AS date) AS string) AS date",
            f"{_INDEX} AS level")
        .groupBy("index_name", "date").agg(F.round(F.avg("level"), 6).alias("delivery_price"))
    )
    late = daily.select("index_name").distinct().selectExpr(
        "index_name", f"inline(array{_as_structs(_LATE)})").toDF("index_name", "date", "delivery_price")
    return build_settlements(daily.unionByName(late))


def _as_structs(rows: str) -> str:
    return "(" + rows.replace("('", "struct('") + ")"


def vol_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings as the API returns them: per currency and day one JSON text of [epoch ms, value] pairs."""
    hourly = (
        events(spark, sf_dir).filter("event_type = 'view'")
        .groupBy(F.expr(_CURRENCY).alias("currency"), F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))
        .agg(F.round(F.avg("value"), 6).alias("value"))
    )
    millis = (F.unix_date("day") * 24 + F.col("hour")) * F.lit(3_600_000.0)
    return hourly.groupBy("currency", "day").agg(
        F.to_json(F.sort_array(F.collect_list(F.array(millis, F.col("value"))))).alias("result"))  # at most 24 pairs


def vol_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vol index as a stored bronze table."""
    return stored(spark, sf_dir, "vol_index", lambda: build_vol_index(vol_responses(spark, sf_dir)))


def trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prints as the API's JSON lines (column ``value``); some are planted broken, by trade number.

    Every 97th is cut short, every 101st lacks its price, every 103rd has an unknown direction.
    """
    raw = raw_option_trades(spark, sf_dir).unionByName(raw_futures_trades(spark, sf_dir), allowMissingColumns=True)
    n = F.col("trade_seq")
    fields = {f.name: F.col(f.name) for f in schemas.API_TRADE}
    fields |= {
        "timestamp": epoch_millis(F.col("timestamp")),
        "price": F.when(n % 101 != 0, F.col("price")),
        "direction": F.when(n % 103 == 0, "hold").otherwise(F.col("direction")),
    }
    line = F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()]))
    return raw.select(F.when(n % 97 == 0, F.substring(line, 1, 40)).otherwise(line).alias("value"))


def spread(df: DataFrame) -> DataFrame:
    """Spread the derived tape over all cores by print, whatever files it came from."""
    return df.repartition("trade_id")


_tables: dict[tuple, DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """``build()`` written once per application and input, as the silver and gold layers are."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        _tables[key] = as_table(build(), name)
    return _tables[key]


# The same tables for DuckDB.
TAPE_SQL = f"""
ev AS (SELECT * FROM events),
options AS (
  SELECT concat('t', CAST(event_id AS VARCHAR)) AS trade_id, event_id AS trade_seq,
    {_OPTION} AS instrument_name, {_FUTURE} AS future_name, {_CURRENCY} AS currency,
    ts AS timestamp, {_PRICE} AS price, CAST(1 + event_id % 5 AS DOUBLE) AS amount,
    CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS direction,
    CAST(event_id % 4 AS INTEGER) AS tick_direction, {_INDEX} AS index_price,
    {_MARK} AS mark_price, {_IV} AS implied_volatility,
    CAST({_STRIKE} AS DOUBLE) AS strike,
    CASE user_id % 4 WHEN 0 THEN TIMESTAMP '2024-01-12 08:00:00' WHEN 1 THEN TIMESTAMP '2024-01-26 08:00:00'
      WHEN 2 THEN TIMESTAMP '2024-02-02 08:00:00' ELSE TIMESTAMP '2024-03-29 08:00:00' END AS expiration_timestamp,
    CASE WHEN {_SIDE} = 'C' THEN 'call' ELSE 'put' END AS option_type
  FROM ev WHERE event_type <> 'error'
),
bronze AS (
  SELECT *, GREATEST(0.0e0, (epoch_us(expiration_timestamp) // 1000 - epoch_us(timestamp) // 1000)
    / (365.25e0 * 24 * 60 * 60 * 1000)) AS time_to_expiry_years
  FROM options
),
futures AS (
  SELECT concat('t', CAST(event_id AS VARCHAR)) AS trade_id, event_id AS trade_seq,
    {_FUTURE} AS instrument_name, ts AS timestamp, {_INDEX} AS price,
    CAST(1 + event_id % 5 AS DOUBLE) AS amount, {_INDEX} AS index_price, {_MARK} AS mark_price
  FROM ev WHERE event_type = 'error'
),
settlements AS (
  SELECT concat(lower({_CURRENCY}), '_usd') AS index_name, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
    round(avg({_INDEX}), 6) AS delivery_price
  FROM ev GROUP BY 1, 2
  UNION ALL
  SELECT i.index_name, l.date, l.delivery_price
  FROM (SELECT DISTINCT concat(lower({_CURRENCY}), '_usd') AS index_name FROM ev) i,
    (VALUES {_LATE}) AS l(date, delivery_price)
),
vol_index AS (
  SELECT {_CURRENCY} AS currency, date_trunc('hour', ts) AS timestamp, round(avg(value), 6) AS volatility_value
  FROM ev WHERE event_type = 'view' GROUP BY 1, 2
)"""
