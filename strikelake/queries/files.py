"""Queries that write tables and files and read them back, and the record builders."""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.sql import functions as F

from strikelake import schemas
from strikelake.functions import metrics, pricing
from strikelake.functions.instruments import currency_of, parse_instrument
from strikelake.operators import quality
from strikelake.plans import gold as gold_plan
from strikelake.plans import legacy
from strikelake.plans.gold import with_settlement
from strikelake.queries import tape
from strikelake.queries.oracle_sql import GOLD_SQL, SILVER_SQL, d1_sql, greeks_sql, price_fraction_sql
from strikelake.queries.registry import futures, gold, options, query, rounded, silver
from strikelake.queries.tape import TAPE_SQL
from strikelake.sources import bronze, readers, writers
from strikelake.sources.storage import shared_folder
from strikelake.sources.tapestore import TapeStore

_PRINTS = f"""WITH {TAPE_SQL},
prints AS (
  SELECT trade_id, trade_seq, instrument_name, timestamp, price, amount, direction FROM bronze
  UNION ALL SELECT f.trade_id, f.trade_seq, f.instrument_name, f.timestamp, f.price, f.amount,
    CASE WHEN f.trade_seq % 2 = 0 THEN 'buy' ELSE 'sell' END FROM futures f
),
accepted AS (SELECT * FROM prints WHERE trade_seq % 97 <> 0 AND trade_seq % 101 <> 0 AND trade_seq % 103 <> 0)"""


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@lru_cache(maxsize=64)
def _option_files(spark, sf_dir: str) -> str:
    """The option tape as per-instrument files, written once per session and input."""
    path = _folder(spark, "instruments")
    writers.write_instrument_files(options(spark, sf_dir), path)
    return path


@query("read_option_files", f"""WITH {TAPE_SQL} SELECT instrument_name, trade_id, trade_seq, timestamp, price,
  implied_volatility, strike, expiration_timestamp, option_type FROM bronze""")
def read_option_files(spark, sf_dir):
    return readers.read_option_trades(spark, _option_files(spark, sf_dir)).select(
        "instrument_name", "trade_id", "trade_seq", "timestamp", "price", "implied_volatility", "strike",
        "expiration_timestamp", "option_type")


@query("tape_inventory", f"""WITH {TAPE_SQL} SELECT count(DISTINCT instrument_name) AS file_count,
  count(*) AS trade_count, count(DISTINCT instrument_name) AS instrument_count FROM bronze""")
def inventory(spark, sf_dir):
    read = readers.read_option_trades(spark, _option_files(spark, sf_dir))
    return quality.tape_inventory(read, readers.file_stem(), F.col("instrument_name"))


@query("read_futures_files", f"""WITH {TAPE_SQL} SELECT instrument_name, trade_id, trade_seq, timestamp, price
  FROM futures""")
def read_futures_files(spark, sf_dir):
    path = _folder(spark, "futures")
    writers.write_table(bronze.in_sequence(futures(spark, sf_dir)), path)
    return readers.read_futures(spark, path).select("instrument_name", "trade_id", "trade_seq", "timestamp", "price")


@query("read_settlements", f"""WITH {TAPE_SQL} SELECT index_name, date, CAST(date AS DATE) AS delivery_date,
  delivery_price FROM settlements""")
def read_settlements(spark, sf_dir):
    path = _folder(spark, "settlements")
    writers.write_table(tape.settlements(spark, sf_dir), path)
    return readers.optional_input(spark, path, readers.read_settlements, None).select(
        "index_name", "date", "delivery_date", "delivery_price")


@query("settlement_coverage", f"""WITH {TAPE_SQL},
expiries AS (SELECT DISTINCT currency, CAST(expiration_timestamp AS DATE) AS day FROM bronze)
SELECT currency, lower(currency) || '_usd' AS index_name,
  lower(currency) || '_usd' IN (SELECT index_name FROM settlements) AS index_known, count(*) AS expiries,
  count(*) FILTER (WHERE EXISTS (SELECT 1 FROM settlements s WHERE s.index_name = lower(currency) || '_usd'
    AND CAST(s.date AS DATE) = day)) AS settled
FROM expiries GROUP BY currency""")
def settlement_coverage(spark, sf_dir):
    trades = options(spark, sf_dir).withColumn("currency", currency_of(F.col("instrument_name")))
    return quality.settlement_coverage(
        quality.require_settlement_index(trades, tape.settlements(spark, sf_dir)), tape.settlements(spark, sf_dir))


@query("gold_without_optional_inputs", f"""WITH {GOLD_SQL} SELECT trade_id, days_to_expiry, strike_delta,
  CAST(NULL AS DOUBLE) AS outcome_settlement_price, CAST(NULL AS BOOLEAN) AS outcome_assignment_inferred,
  CAST(NULL AS DOUBLE) AS exchange_realized_vol FROM gold""")
def gold_without_optional_inputs(spark, sf_dir):
    """Neither settlement nor vol-index files exist: the layer is built all the same, what they would give is unknown."""
    absent = _folder(spark, "absent")
    settlements = readers.optional_input(spark, absent, readers.read_settlements, schemas.SETTLEMENTS)
    index = readers.optional_input(spark, absent, readers.read_vol_index, schemas.VOL_INDEX)
    return gold_plan.gold(silver(spark, sf_dir), settlements, index).select(
        "trade_id", "days_to_expiry", "strike_delta", "outcome_settlement_price", "outcome_assignment_inferred",
        "exchange_realized_vol")


@query("read_vol_index", f"WITH {TAPE_SQL} SELECT currency, timestamp, volatility_value FROM vol_index")
def read_vol_index(spark, sf_dir):
    path = _folder(spark, "vol-index")
    writers.write_table(tape.vol_index(spark, sf_dir), path)
    return readers.read_vol_index(spark, path)


@query("read_silver_currency", f"""WITH {SILVER_SQL} SELECT currency, trade_id, futures_price, is_valid FROM silver
  WHERE currency = 'ETH'""")
def read_silver_currency(spark, sf_dir):
    path = _folder(spark, "silver")
    writers.write_silver(silver(spark, sf_dir), path)
    return readers.read_silver(spark, path, "ETH").select("currency", "trade_id", "futures_price", "is_valid")


@query("read_gold_currency", f"""WITH {GOLD_SQL} SELECT currency, trade_id, days_to_expiry, strike_delta, vol_regime
  FROM gold WHERE currency = 'BTC'""")
def read_gold_currency(spark, sf_dir):
    path = _folder(spark, "gold")
    writers.write_gold(gold(spark, sf_dir), path)
    return readers.read_gold(spark, path, "BTC").select(
        "currency", "trade_id", "days_to_expiry", "strike_delta", "vol_regime")


@query("write_report", f"""WITH {GOLD_SQL},
written AS (
  SELECT 'silver' AS layer, currency, is_valid FROM silver
  UNION ALL SELECT 'gold', currency, is_valid FROM gold),
counted AS (
  SELECT layer, currency, count(*) AS rows_out, count(*) FILTER (WHERE is_valid) AS valid_rows FROM written
  GROUP BY GROUPING SETS ((layer), (layer, currency)))
SELECT layer, currency, CASE WHEN currency IS NULL THEN CASE layer WHEN 'silver' THEN (SELECT count(*) FROM bronze)
    ELSE (SELECT count(*) FROM silver) END END AS rows_in, rows_out, valid_rows, 100.0e0 * valid_rows / rows_out AS valid_pct
FROM counted""")
def write_report(spark, sf_dir):
    """Rows read, written and valid, as observed while both layers are written."""
    tape_rows, silver_rows, both = options(spark, sf_dir), silver(spark, sf_dir), ["BTC", "ETH"]
    return writers.report_frame(spark, [
        writers.write_silver(silver_rows, _folder(spark, "silver"), source=tape_rows, currencies=both).require_valid(),
        writers.write_gold(gold(spark, sf_dir), _folder(spark, "gold"), source=silver_rows, currencies=both).require_valid(),
    ])


@query("fetch_list", f"""WITH {TAPE_SQL}
  SELECT DISTINCT future_name AS instrument_name, 'future' AS kind FROM bronze
  UNION ALL SELECT DISTINCT instrument_name, 'option' FROM bronze""")
def fetch_list(spark, sf_dir):
    """The work list of a fetch: all futures that the options need, and the options; what has prints already stays on it."""
    trades = options(spark, sf_dir)
    needed = quality.required_futures(trades).toDF("instrument_name").withColumn("kind", F.lit("future"))
    listed = trades.select("instrument_name", F.lit("option").alias("kind")).distinct()
    return quality.fetch_list(needed, listed)


@query("fetch_list_open", f"""WITH {TAPE_SQL},
listed AS (
  SELECT DISTINCT future_name AS instrument_name, 'future' AS kind FROM bronze
  UNION ALL SELECT DISTINCT instrument_name, 'option' FROM bronze)
SELECT l.instrument_name FROM listed l LEFT JOIN (
  SELECT DISTINCT instrument_name FROM futures WHERE timestamp < TIMESTAMP '2024-01-03 00:00:00'
  UNION SELECT DISTINCT instrument_name FROM bronze WHERE timestamp < TIMESTAMP '2024-01-03 00:00:00') p
  USING (instrument_name) WHERE p.instrument_name IS NULL""")
def fetch_list_open(spark, sf_dir):
    """What the work list has left when only the prints of the first two days are stored: the list less its tape."""
    trades, others = options(spark, sf_dir), futures(spark, sf_dir)
    stored = trades.select("instrument_name", "timestamp").unionByName(others.select("instrument_name", "timestamp"))
    return quality.missing_instruments(fetch_list(spark, sf_dir), stored.filter("timestamp < '2024-01-03'"))


@query("merge_stored_tape", f"""WITH {TAPE_SQL}
SELECT instrument_name, trade_seq, trade_id, timestamp, price, timestamp >= TIMESTAMP '2024-01-25 00:00:00' AS is_new
FROM bronze""")
def merge_stored_tape(spark, sf_dir):
    """Prints before a day are stored as files; a batch of all later ones and of the day before is merged in."""
    trades = options(spark, sf_dir).select("instrument_name", "trade_seq", "trade_id", "timestamp", "price")
    store = TapeStore(spark, _folder(spark, "tape")).create(trades.filter("timestamp < '2024-01-25'"))
    fresh = store.merge(trades.filter("timestamp >= '2024-01-24'"))
    return store.read().join(fresh.select("trade_id", F.lit(True).alias("is_new")), "trade_id", "left").withColumn(
        "is_new", F.coalesce("is_new", F.lit(False)))


@query("ingest_trade_json", f"""{_PRINTS}
  SELECT 'accepted' AS status, instrument_name, count(*) AS lines, round(sum(amount), 6) AS amount FROM accepted GROUP BY ALL
  UNION ALL SELECT 'rejected', NULL, count(*), NULL FROM prints WHERE trade_id NOT IN (SELECT trade_id FROM accepted)""")
def ingest_trade_json(spark, sf_dir):
    path = _folder(spark, "trade-lines")
    tape.trade_lines(spark, sf_dir).write.text(path)
    good, bad = bronze.ingest_trade_json(spark, path)
    counted = good.groupBy("instrument_name").agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("amount"), 6).alias("amount")).withColumn(
            "status", F.lit("accepted"))
    return counted.unionByName(bad.agg(F.count(F.lit(1)).alias("lines")).withColumn("status", F.lit("rejected")),
                               allowMissingColumns=True)


@query("rename_api_trade", f"""{_PRINTS} SELECT trade_id AS id, instrument_name AS "instrumentName", price, amount,
  direction, epoch_us(timestamp) // 1000 AS timestamp FROM accepted""")
def rename_api_trade(spark, sf_dir):
    good, _ = bronze.split_trade_json(tape.trade_lines(spark, sf_dir))
    return bronze.rename_api_trade(good).select("id", "instrumentName", "price", "amount", "direction", "timestamp")


@query("build_instruments", f"""WITH {TAPE_SQL}
  SELECT DISTINCT instrument_name, 'option' AS kind, currency AS base_currency, expiration_timestamp, strike, option_type,
    NULL::BOOLEAN AS is_active FROM bronze""")
def build_instruments(spark, sf_dir):
    listed = options(spark, sf_dir).select(
        "instrument_name", F.lit("option").alias("kind"), currency_of(F.col("instrument_name")).alias("base_currency"),
        "expiration_timestamp", "strike", "option_type").distinct()
    return bronze.build_instruments(listed).drop("settlement_period")


@query("options_only", f"WITH {TAPE_SQL} SELECT trade_id, instrument_name FROM bronze")
def options_only(spark, sf_dir):
    """Futures prints on the same tape have no option terms and go."""
    mixed = tape.raw_option_trades(spark, sf_dir).unionByName(
        tape.raw_futures_trades(spark, sf_dir), allowMissingColumns=True)
    return quality.options_only(bronze.build_bronze_options(mixed)).select("trade_id", "instrument_name")


@query("parse_odd_names", f"""WITH {TAPE_SQL}, names AS (
    SELECT DISTINCT instrument_name AS name, currency, future_name FROM bronze)
  SELECT currency || '-PERPETUAL' AS instrument_name, 'perpetual' AS instrument_type, currency AS underlying FROM names
  UNION SELECT name || '-X', NULL, NULL FROM names
  UNION SELECT future_name || '-x-C', 'option', currency FROM names
  UNION SELECT replace(future_name, '24', '2'), NULL, NULL FROM names""")
def parse_odd_names(spark, sf_dir):
    """Perpetuals, and names with a part too many, a strike that is no number (an option without one), or a date cut short."""
    name = F.col("instrument_name")
    future = F.regexp_extract(name, r"^[^-]+-[^-]+", 0)
    odd = F.array(F.concat(currency_of(name), F.lit("-PERPETUAL")), F.concat(name, F.lit("-X")),
                  F.concat(future, F.lit("-x-C")), F.regexp_replace(future, "24", "2"))
    names = options(spark, sf_dir).select(name).distinct().select(F.explode(odd).alias("instrument_name")).distinct()
    return names.withColumn("t", parse_instrument(F.col("instrument_name"))).select(
        "instrument_name", "t.instrument_type", "t.underlying")


@query("is_itm", f"""WITH {TAPE_SQL}
  SELECT o.trade_id, abs(s.delivery_price - o.strike) / s.delivery_price > 0.005e0 AND CASE o.option_type
      WHEN 'call' THEN s.delivery_price > o.strike ELSE s.delivery_price < o.strike END AS is_itm
  FROM bronze o LEFT JOIN settlements s ON s.index_name = lower(o.currency) || '_usd'
    AND s.date = strftime(o.expiration_timestamp, '%Y-%m-%d')""")
def is_itm(spark, sf_dir):
    trades = options(spark, sf_dir).select("trade_id", "strike", "option_type", "expiration_timestamp", currency_of(
        F.col("instrument_name")).alias("currency"))
    settled = with_settlement(trades, tape.settlements(spark, sf_dir), out="settled")
    return settled.select("trade_id", metrics.is_itm(F.col("strike"), F.col("settled"), F.col("option_type")).alias("is_itm"))


@query("risk_filter_moneyness", f"""WITH {SILVER_SQL}
  SELECT v.trade_id FROM silver v JOIN settlements s ON s.index_name = lower(v.currency) || '_usd'
    AND s.date = strftime(v.expiration_timestamp, '%Y-%m-%d')
  WHERE v.gamma <= 0.001e0 AND (abs(s.delivery_price - v.strike) / s.delivery_price <= 0.005e0 OR CASE v.option_type
      WHEN 'call' THEN s.delivery_price <= v.strike ELSE s.delivery_price >= v.strike END)""")
def risk_filter_moneyness(spark, sf_dir):
    settled = legacy.with_moneyness(with_settlement(
        silver(spark, sf_dir), tape.settlements(spark, sf_dir), out="delivery_price"))
    return quality.risk_filter(settled, bounds={"gamma": (None, 0.001)}, moneyness=["OTM", "ATM"]).select("trade_id")


_T, _V = "time_to_expiry_years", "(implied_volatility / 100.0e0)"


@query("greeks_bundle", f"""WITH {TAPE_SQL},
  staged AS (SELECT *, {d1_sql('index_price')} AS d1 FROM bronze),
  plain AS (SELECT *, {greeks_sql('index_price', 'TRUE')}, {price_fraction_sql('index_price')} * index_price AS value
            FROM staged)
  SELECT trade_id, round(df * delta, 6) AS delta, round(df * gamma, 10) AS gamma, round(df * vega, 5) AS vega,
    round(df * value, 4) AS price,
    round(df * (theta + CASE WHEN {_T} > 0 THEN 0.03e0 * value / 365.0e0 ELSE 0 END), 4) AS theta
  FROM (SELECT *, CASE WHEN {_T} > 0 THEN 0.98e0 ELSE 1.0e0 END AS df FROM plain)""")
def greeks_bundle(spark, sf_dir):
    """Discounted Greeks and price with a carry rate; prints without an IV have none, expired ones their intrinsic value."""
    trades = options(spark, sf_dir)
    bundle = pricing.greeks_bundle(
        F.col("index_price"), F.col("strike"), F.col(_T), metrics.iv_decimal(F.col("implied_volatility")),
        F.col("option_type"), discount=0.98, rate=0.03)
    return rounded(trades.withColumn("g", bundle).select("trade_id", "g.*"), delta=6, gamma=10, vega=5, theta=4, price=4)
