"""Inventory, validity and filter operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strikelake.functions.instruments import future_key


class NoValidTradesError(ValueError):
    """Silver holds trades but none is valid: forward prices are missing or incomplete."""


class MissingInstrumentsError(ValueError):
    """Expected instruments have no tape; ``missing`` is the frame of all of them."""

    def __init__(self, message: str, missing: DataFrame):
        super().__init__(message)
        self.missing = missing


class MissingSettlementsError(ValueError):
    """A currency has no settlement index, so every outcome of it would be NULL."""


def validity_report(silver: DataFrame) -> DataFrame:
    """One row: total_trades, valid_trades, valid_pct."""
    counted = silver.agg(F.count(F.lit(1)).alias("total_trades"), F.count_if("is_valid").alias("valid_trades"))
    return counted.withColumn("valid_pct", F.coalesce(
        F.try_divide(F.col("valid_trades") * F.lit(100.0), F.col("total_trades")), F.lit(0.0)))


def require_valid(silver: DataFrame) -> DataFrame:
    """``silver`` itself, or NoValidTradesError when it has rows and none is valid."""
    report = validity_report(silver).first()
    if report["total_trades"] > 0 and report["valid_trades"] == 0:
        raise NoValidTradesError(f"0 valid trades out of {report['total_trades']:,}")
    return silver


def quality_audit(silver: DataFrame) -> DataFrame:
    return silver.groupBy("is_valid").agg(
        F.count(F.lit(1)).alias("trades"), F.count("futures_price").alias("has_futures"),
        F.count("delta").alias("has_greeks"),
    )


def outcome_cohort(gold: DataFrame) -> DataFrame:
    """Assignment rate and mean forward return by strike_delta and vol_regime."""
    return gold.groupBy("strike_delta", "vol_regime").agg(
        F.avg(F.col("outcome_assignment_inferred").cast("int")).alias("assignment_rate"),
        F.avg("outcome_forward_return_7day").alias("avg_forward_return"),
    )


def tape_inventory(tape: DataFrame, file: Column, instrument: Column) -> DataFrame:
    return tape.agg(
        F.count_distinct(file).alias("file_count"), F.count(F.lit(1)).alias("trade_count"),
        F.count_distinct(instrument).alias("instrument_count"),
    )


def tape_stats(tape: DataFrame) -> DataFrame:
    return tape.groupBy("instrument_name").agg(
        F.count(F.lit(1)).alias("trade_count"), F.min("timestamp").alias("first_trade"),
        F.max("timestamp").alias("last_trade"), F.min("trade_seq").alias("min_seq"),
        F.max("trade_seq").alias("max_seq"),
    )


# Sequence numbers per block of seq_gaps: the unit of parallelism inside one instrument.
SEQ_BLOCK = 1_000_000


def seq_gaps(tape: DataFrame) -> DataFrame:
    """Missing trade_seq ranges per instrument: gap_start, gap_end, missing.

    Runs per block of sequence numbers; one edge row per block links it to the block before.
    """
    seqs = tape.select("instrument_name", "trade_seq", F.floor(F.col("trade_seq") / SEQ_BLOCK).alias("block"))
    edges = seqs.groupBy("instrument_name", "block").agg(F.max("trade_seq").alias("top"))
    chain = Window.partitionBy("instrument_name").orderBy("block")
    heads = edges.select(
        "instrument_name", "block", F.lag("top").over(chain).alias("trade_seq")
    ).filter(F.col("trade_seq").isNotNull())
    inside = Window.partitionBy("instrument_name", "block").orderBy("trade_seq")
    following = F.lead("trade_seq").over(inside)
    return (
        seqs.unionByName(heads).withColumn("following", following)
        .filter(F.col("following") - F.col("trade_seq") > 1)
        .select("instrument_name", (F.col("trade_seq") + 1).alias("gap_start"),
                (F.col("following") - 1).alias("gap_end"),
                (F.col("following") - F.col("trade_seq") - 1).alias("missing"))
    )


def missing_instruments(expected: DataFrame, tape: DataFrame) -> DataFrame:
    """Expected instruments without a single trade."""
    return expected.select("instrument_name").distinct().join(
        tape.select("instrument_name"), "instrument_name", "left_anti")


def require_complete(expected: DataFrame, tape: DataFrame, shown: int = 20) -> None:
    """MissingInstrumentsError if any is missing: its text names the first few, its frame lists all."""
    absent = missing_instruments(expected, tape)
    sample = [r["instrument_name"] for r in absent.orderBy("instrument_name").limit(shown).collect()]
    if sample:
        raise MissingInstrumentsError(f"{absent.count()} instruments without trades, first: {', '.join(sample)}", absent)


def settlement_coverage(options: DataFrame, settlements: DataFrame) -> DataFrame:
    """Per currency: its settlement index, whether the index is known at all, expiries on the tape and settled ones."""
    index = F.concat(F.lower("currency"), F.lit("_usd"))
    expiries = options.select("currency", F.to_date("expiration_timestamp").alias("day")).filter(
        F.col("day").isNotNull()).distinct().withColumn("index_name", index)
    daily = settlements.select("index_name", F.col("date").cast("date").alias("day")).distinct()
    known = daily.select("index_name").distinct().withColumn("index_known", F.lit(True))
    found = expiries.join(daily.withColumn("hit", F.lit(1)), ["index_name", "day"], "left").groupBy(
        "currency", "index_name").agg(F.count(F.lit(1)).alias("expiries"), F.count("hit").alias("settled"))
    return found.join(known, "index_name", "left").select(
        "currency", "index_name", F.coalesce("index_known", F.lit(False)).alias("index_known"), "expiries", "settled")


def require_settlement_index(options: DataFrame, settlements: DataFrame) -> DataFrame:
    """``options`` itself, or MissingSettlementsError naming the currencies that have no index at all."""
    unknown = settlement_coverage(options, settlements).filter("NOT index_known").select("currency").orderBy("currency")
    names = [r["currency"] for r in unknown.collect()]  # currencies, a handful
    if names:
        raise MissingSettlementsError(f"no settlement index for {', '.join(names)}: outcomes would be unknown")
    return options


def required_futures(options: DataFrame) -> DataFrame:
    """Dated futures the option names settle against, distinct and sorted."""
    return (
        options.select(future_key(F.col("instrument_name")).alias("future_name"))
        .filter(F.col("future_name").isNotNull()).distinct().orderBy("future_name")
    )


def fetch_list(futures: DataFrame, options: DataFrame) -> DataFrame:
    """Futures and options in one list of instruments."""
    return futures.unionByName(options)


def instrument_universe(instruments: DataFrame, kind: str | None = None, expired_at: str | None = None,
                        min_expiry: str | None = None, max_expiry: str | None = None) -> DataFrame:
    """Instruments of a kind whose expiry is at or before ``expired_at`` and inside the given bounds."""
    out = instruments if kind is None else instruments.filter(F.col("kind") == kind)
    expiry = F.col("expiration_timestamp")
    for bound, test in ((expired_at, expiry.__le__), (min_expiry, expiry.__ge__), (max_expiry, expiry.__le__)):
        if bound is not None:
            out = out.filter(test(F.lit(bound).cast("timestamp_ntz")))
    return out


def options_only(trades: DataFrame) -> DataFrame:
    return trades.filter(F.col("option_type").isNotNull())


def has_forward(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("futures_price").isNotNull())


def settlement_range(settlements: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive date bounds, each optional."""
    date = F.col("date")
    out = settlements if start is None else settlements.filter(date >= start)
    return out if end is None else out.filter(date <= end)


def _reject_outcomes(columns: Sequence[str]) -> None:
    leaked = [c for c in columns if c.startswith("outcome_")]
    if leaked:
        raise ValueError(f"forward-looking columns cannot filter entries: {', '.join(leaked)}")


def entry_filter(gold: DataFrame, strike_delta: str | None = None, dte: tuple[int, int] | None = None,
                 vol_regime: str | None = None, min_iv_rv_gap: float | None = None,
                 require_realized_vol: bool = False, equals: dict[str, object] | None = None) -> DataFrame:
    """Valid trades meeting entry-time conditions; refuses outcome_* columns."""
    _reject_outcomes(list(equals or {}))
    out = gold.filter("is_valid")
    if strike_delta is not None:
        out = out.filter(F.col("strike_delta") == strike_delta)
    if dte is not None:
        out = out.filter(F.col("days_to_expiry").between(*dte))
    if vol_regime is not None:
        out = out.filter(F.col("vol_regime") == vol_regime)
    if min_iv_rv_gap is not None:
        out = out.filter(F.col("iv_minus_rv_gap") > min_iv_rv_gap)
    if require_realized_vol:
        out = out.filter(F.col("realized_vol_7day").isNotNull())
    for name, value in (equals or {}).items():
        out = out.filter(F.col(name) == F.lit(value))
    return out


def risk_filter(df: DataFrame, underlying: str | None = None,
                bounds: dict[str, tuple[float | None, float | None]] | None = None,
                moneyness: Sequence[str] | None = None) -> DataFrame:
    """Keep rows inside inclusive (min, max) bounds on delta, gamma, vega, theta; None leaves a side open."""
    _reject_outcomes(list(bounds or {}))
    out = df if underlying is None else df.filter(F.col("currency") == underlying)
    for name, (low, high) in (bounds or {}).items():
        if low is not None:
            out = out.filter(F.col(name) >= low)
        if high is not None:
            out = out.filter(F.col(name) <= high)
    return out if moneyness is None else out.filter(F.col("moneyness").isin(*moneyness))

