"""Storage schemas. Timestamps are UTC wall-clock instants kept as TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import types as T

OPTION_TRADES = T.StructType([
    T.StructField("trade_id", T.StringType()),
    T.StructField("trade_seq", T.LongType()),
    T.StructField("instrument_name", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("direction", T.StringType()),
    T.StructField("tick_direction", T.IntegerType()),
    T.StructField("index_price", T.DoubleType()),
    T.StructField("mark_price", T.DoubleType()),
    T.StructField("implied_volatility", T.DoubleType()),
    T.StructField("futures_price", T.DoubleType()),
    T.StructField("strike", T.DoubleType()),
    T.StructField("expiration_timestamp", T.TimestampNTZType()),
    T.StructField("option_type", T.StringType()),
    T.StructField("time_to_expiry_years", T.DoubleType()),
])

FUTURES_TRADES = T.StructType([
    T.StructField("trade_id", T.StringType()),
    T.StructField("trade_seq", T.LongType()),
    T.StructField("instrument_name", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("direction", T.StringType()),
    T.StructField("tick_direction", T.IntegerType()),
    T.StructField("index_price", T.DoubleType()),
    T.StructField("mark_price", T.DoubleType()),
])

SETTLEMENTS = T.StructType([
    T.StructField("index_name", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("delivery_price", T.DoubleType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

VOL_INDEX = T.StructType([
    T.StructField("currency", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("volatility_value", T.DoubleType()),
])

INSTRUMENTS = T.StructType([
    T.StructField("instrument_name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("base_currency", T.StringType()),
    T.StructField("expiration_timestamp", T.TimestampNTZType()),
    T.StructField("strike", T.DoubleType()),
    T.StructField("option_type", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("settlement_period", T.StringType()),
])

# One trade as the exchange API returns it (timestamp in epoch milliseconds).
API_TRADE = T.StructType([
    T.StructField("trade_seq", T.LongType()),
    T.StructField("trade_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("tick_direction", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("mark_price", T.DoubleType()),
    T.StructField("instrument_name", T.StringType()),
    T.StructField("index_price", T.DoubleType()),
    T.StructField("direction", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("iv", T.DoubleType()),
])

TRADE_COLUMNS = [
    "instrument_name", "trade_id", "trade_seq", "timestamp", "price", "amount", "direction",
    "tick_direction", "index_price", "mark_price", "implied_volatility", "strike",
    "expiration_timestamp", "option_type", "time_to_expiry_years",
]
SILVER_COLUMNS = TRADE_COLUMNS + ["futures_price", "delta", "gamma", "vega", "theta", "is_valid"]
ENTRY_COLUMNS = [
    "days_to_expiry", "strike_delta", "vol_regime", "realized_vol_7day", "exchange_realized_vol",
    "iv_percentile_90day", "iv_percentile_sample_size", "iv_minus_rv_gap",
]
EXECUTION_COLUMNS = [
    "trade_volume_7day", "bid_ask_spread_estimate", "price_vs_mark_deviation",
    "expected_premium", "actual_premium_collected", "premium_collection_ratio",
]
OUTCOME_COLUMNS = [
    "outcome_settlement_price", "outcome_forward_return_7day",
    "outcome_assignment_inferred", "outcome_days_to_assignment",
]
GOLD_COLUMNS = SILVER_COLUMNS + ENTRY_COLUMNS + EXECUTION_COLUMNS + OUTCOME_COLUMNS
