"""Small typed frames for the unit tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from strikelake import schemas

SILVER = T.StructType(
    [f for f in schemas.OPTION_TRADES if f.name in schemas.TRADE_COLUMNS]
    + [T.StructField(c, T.DoubleType()) for c in ("futures_price", "delta", "gamma", "vega", "theta")]
    + [T.StructField("is_valid", T.BooleanType())]
)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def frame(spark, schema: T.StructType, rows: list[dict]):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def option_row(trade_id: str, seq: int, ts: str, **over) -> dict:
    row = dict(
        trade_id=trade_id, trade_seq=seq, instrument_name="BTC-1JUL24-50000-C", timestamp=at(ts), price=0.05,
        amount=1.0, direction="buy", tick_direction=0, index_price=54000.0, mark_price=54100.0,
        implied_volatility=60.0, strike=50000.0, expiration_timestamp=at("2024-07-01 08:00:00"), option_type="call",
        time_to_expiry_years=0.08)
    row.update(over)
    return row


def future_row(trade_id: str, seq: int, ts: str, price: float, name: str = "BTC-1JUL24") -> dict:
    return dict(trade_id=trade_id, trade_seq=seq, instrument_name=name, timestamp=at(ts), price=price, amount=1.0,
                direction="buy", tick_direction=0, index_price=price)


def silver_row(name: str, trade_id: str, seq: int, ts: str, **over) -> dict:
    side = "call" if name.endswith("C") else "put"
    row = option_row(trade_id, seq, ts, instrument_name=name, option_type=side, strike=float(name.split("-")[2]),
                     expiration_timestamp=at("2024-01-01 08:00:00"), gamma=0.0, vega=0.0, theta=0.0, is_valid=True)
    row.update(over)
    return row
