"""Option-ladder selection, sizing, settlement and early close, for all periods and configurations at once.

A ladder is one (currency, period, expiry, config); a config is a list of absolute target deltas. Choices
("first print", "nearest delta", "best expiry") are min_by aggregates, so each task reduces its part of
the tape before anything is shuffled; as such an aggregate sorts its input, the tape is first cut to the
chosen expiries. What is left is bounded by the calendar and the configurations: at most one row per
currency, period, expiry in the DTE band, config and target. Those tables are stored before they meet the
tape, so their true size decides whether they are broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strikelake.functions.timeline import period_of
from strikelake.operators.cells import MAX_ROWS_PER_CELL
from strikelake.operators.crossing import first_crossing
from strikelake.sources.storage import as_table

# Ladder parameters.
TARGET_DTE = 7
DTE_BAND = (3, 10)
LADDERS = {"2/5/10": [0.02, 0.05, 0.10]}
DELTA_GRID = {"2/5/10": [0.02, 0.05, 0.10], "1/5/10": [0.01, 0.05, 0.10]}
HIT_THRESHOLD = 0.0038
MARGIN_BASE, MARGIN_FLOOR = 0.15, 0.10
PROFIT_TARGET = 0.25
HEDGE_DELTA = 0.01

ENTRY = ["currency", "period", "expiration_timestamp"]
KEY = [*ENTRY, "config"]
_ORDER = ["timestamp", "trade_seq", "trade_id"]
_LEG_COLUMNS = [
    "instrument_name", "timestamp", "strike", "mark_price", "delta", "futures_price", "implied_volatility",
    "vol_regime", "iv_percentile_90day", "realized_vol_7day", "outcome_settlement_price",
    "outcome_assignment_inferred", "outcome_forward_return_7day",
]


def _prints(gold: DataFrame, side: str, period: str) -> DataFrame:
    return gold.filter(F.col("is_valid") & (F.col("option_type") == side)).withColumn(
        "period", period_of(F.col("timestamp"), period))


def period_expiry_counts(gold: DataFrame, side: str = "put", dte: tuple[int, int] = DTE_BAND,
                         period: str = "week") -> DataFrame:
    """Valid prints per (currency, period, expiry, days_to_expiry) inside the DTE band."""
    return (
        _prints(gold, side, period).filter(F.col("days_to_expiry").between(*dte))
        .groupBy(*ENTRY, "days_to_expiry").agg(F.count(F.lit(1)).alias("n"))
    )


def choose_expiry(counts: DataFrame, target_dte: int = TARGET_DTE) -> DataFrame:
    """One expiry per (currency, period): nearest to the target DTE, then busiest, then earliest."""
    rank = F.struct(F.abs(F.col("days_to_expiry") - target_dte), -F.col("n"), "expiration_timestamp",
                    "days_to_expiry")
    pick = F.struct("expiration_timestamp", "days_to_expiry", "n")
    best = counts.groupBy("currency", "period").agg(F.min_by(pick, rank).alias("b"))
    return best.select("currency", "period", "b.expiration_timestamp", "b.days_to_expiry", "b.n")


def every_expiry(counts: DataFrame) -> DataFrame:
    """All qualifying expiries per (currency, period), with the lowest DTE seen."""
    return counts.groupBy(*ENTRY).agg(F.min("days_to_expiry").alias("days_to_expiry"), F.sum("n").alias("n"))


def expiry_liquidity(gold: DataFrame, chosen: DataFrame, side: str = "put", period: str = "week") -> DataFrame:
    """Summed trade_volume_7day of the chosen expiry's prints; the tape is aggregated before the join."""
    volume = _prints(gold, side, period).groupBy(*ENTRY).agg(
        F.sum("trade_volume_7day").cast("double").alias("liquidity"))
    return volume.join(chosen.select(*ENTRY), ENTRY)


def liquidity_gate(liquidity: DataFrame, percentile: float = 0.0) -> DataFrame:
    """Add ``admitted``: strictly above the value at floor(n * percentile); percentile <= 0 admits all."""
    if percentile <= 0:
        return liquidity.withColumn("admitted", F.lit(True))
    every = Window.partitionBy("currency")
    ranked = liquidity.withColumns({
        "__rank": F.row_number().over(every.orderBy("liquidity", "period", "expiration_timestamp")),
        "__cut": F.floor(F.count(F.lit(1)).over(every) * F.lit(percentile)) + 1,
    })
    threshold = F.max(F.when(F.col("__rank") == F.col("__cut"), F.col("liquidity"))).over(every)
    above = F.col("liquidity") > F.coalesce(threshold, F.lit(0.0))
    return ranked.withColumn("admitted", above).drop("__rank", "__cut")


def first_prints(gold: DataFrame, side: str = "put", period: str = "week",
                 entries: DataFrame | None = None) -> DataFrame:
    """First valid print of every instrument in every period.

    With ``entries`` (currency, period, expiry and days_to_expiry) only prints of those expiries are read on.
    """
    prints, keys = _prints(gold, side, period), list(ENTRY)
    if entries is not None:
        prints = prints.drop("days_to_expiry").join(entries.select(*ENTRY, "days_to_expiry"), ENTRY)
        keys.append("days_to_expiry")
    row = F.struct(*_LEG_COLUMNS)
    firsts = prints.groupBy(*keys, F.col("instrument_name").alias("__name")).agg(
        F.min_by(row, F.struct(*_ORDER)).alias("leg"))
    return firsts.select(*keys, *[f"leg.{c}" for c in _LEG_COLUMNS])


def nearest_legs(prints: DataFrame, configs: Mapping[str, Sequence[float]] = LADDERS) -> DataFrame:
    """Per config and target the print with |delta| nearest the target; one print may serve several."""
    wanted = F.explode(F.array(*[
        F.struct(F.lit(name).alias("config"), F.lit(float(t)).alias("target_delta"),
                 F.lit(len(targets)).alias("legs"))
        for name, targets in configs.items() for t in targets
    ]))
    aimed = prints.withColumn("w", wanted).select(*prints.columns, "w.*")
    distance = F.struct(F.abs(F.abs(F.col("delta")) - F.col("target_delta")), "instrument_name")
    legs = aimed.groupBy(*KEY, "target_delta", "legs", *_carried(prints)).agg(
        F.min_by(F.struct(*_LEG_COLUMNS), distance).alias("leg"))
    return legs.select(*KEY, "target_delta", "legs", *_carried(prints), *[f"leg.{c}" for c in _LEG_COLUMNS])


def _carried(prints: DataFrame) -> list[str]:
    return [c for c in ("days_to_expiry",) if c in prints.columns]


def select_ladder(gold: DataFrame, chosen: DataFrame, configs: Mapping[str, Sequence[float]] = LADDERS,
                  side: str = "put", period: str = "week") -> DataFrame:
    """Legs of every complete ladder on the chosen (currency, period, expiry) rows."""
    entries = as_table(chosen.select(*ENTRY, "days_to_expiry"), "entries")
    legs = nearest_legs(first_prints(gold, side, period, entries), configs)
    found = F.count(F.lit(1)).over(Window.partitionBy(*KEY))
    return legs.withColumn("__found", found).filter(F.col("__found") == F.col("legs")).drop("__found")


def margin_per_contract(forward: Column, strike: Column, mark: Column, side: str) -> Column:
    """Initial margin of one short contract in USD."""
    gap = forward - strike if side == "put" else strike - forward
    otm = F.greatest(F.try_divide(gap, forward), F.lit(0.0))
    return (F.greatest(F.lit(MARGIN_BASE) - otm, F.lit(MARGIN_FLOOR)) + mark) * forward


def size_legs(legs: DataFrame, side: str = "put", method: str = "unit", capital: float = 1.0) -> DataFrame:
    """Add entry_forward, amount, capital_usd, premium_usd and settlement loss per leg.

    method: ``cash`` secures the strike in full, ``notional`` keeps those amounts but locks margin only,
    ``unit`` spreads the capital evenly as margin. Results are linear in ``capital``.
    """
    ladder = Window.partitionBy(*KEY)
    staged = legs.withColumn("entry_forward", F.min_by("futures_price", "target_delta").over(ladder))
    strike, forward = F.col("strike"), F.col("entry_forward")
    margin = margin_per_contract(forward, strike, F.col("mark_price"), side)
    share = F.lit(float(capital)) / F.col("legs")
    sizes = {
        "cash": (share / strike, strike),
        "notional": (share / strike, margin),
        "unit": (share / margin, margin),
    }
    if method not in sizes:
        raise ValueError(f"method must be one of {sorted(sizes)}, not {method!r}")
    amount, unit_capital = sizes[method]
    sized = staged.withColumn("amount", amount)
    return sized.withColumns({
        "capital_usd": unit_capital * F.col("amount"),
        "premium_usd": F.col("mark_price") * F.col("amount") * forward,
        "loss_usd": settlement_loss(side),
    })


def settlement_loss(side: str) -> Column:
    """Loss of an assigned leg; full strike without a settlement price; none when assignment is unknown."""
    strike, settled = F.col("strike"), F.col("outcome_settlement_price")
    gap = strike - settled if side == "put" else settled - strike
    per_contract = F.when(settled.isNull(), strike).otherwise(F.greatest(gap, F.lit(0.0)))
    return F.when(F.col("outcome_assignment_inferred"), per_contract * F.col("amount")).otherwise(0.0)


def ladder_returns(sized: DataFrame) -> DataFrame:
    """One row per ladder: premium, loss, return on capital, and entry features of its outer legs.

    ``near_*`` belongs to the highest target, ``deep_*`` to the lowest.
    """
    near = lambda c: F.max_by(c, "target_delta")
    deep = lambda c: F.min_by(c, "target_delta")
    assigned = F.col("outcome_assignment_inferred")
    totals = sized.groupBy(*KEY).agg(
        F.min("days_to_expiry").alias("days_to_expiry"),
        F.count(F.lit(1)).alias("legs"),
        F.sum("capital_usd").alias("capital_usd"),
        F.sum("premium_usd").alias("premium_usd"),
        F.sum("loss_usd").alias("loss_usd"),
        F.coalesce(F.bool_or(assigned), F.lit(False)).alias("any_assigned"),
        F.count_if(assigned.isNull()).alias("unknown_legs"),
        F.sum(F.col("strike") * F.col("amount")).alias("__notional"),
        F.min("strike").alias("strike_min"),
        F.min("entry_forward").alias("entry_forward"),
        near("vol_regime").alias("vol_regime"),
        near("iv_percentile_90day").alias("iv_percentile"),
        near("realized_vol_7day").alias("realized_vol_7day"),
        near("outcome_forward_return_7day").alias("forward_return"),
        near("implied_volatility").alias("near_iv"),
        deep("implied_volatility").alias("deep_iv"),
        deep("amount").alias("deep_amount"),
        deep("premium_usd").alias("deep_premium_usd"),
    )
    pnl = F.col("premium_usd") - F.col("loss_usd")
    return totals.withColumns({
        "premium_pct": F.try_divide("premium_usd", "capital_usd"),
        "pnl_usd": pnl,
        "pnl_pct": F.try_divide(pnl, F.col("capital_usd")),
        "margin_breach": F.col("loss_usd") > F.col("capital_usd"),
        "max_loss_usd": F.col("__notional") - F.col("premium_usd"),
        "skew_proxy": F.try_divide(F.col("deep_iv") - F.col("near_iv"), F.col("near_iv")),
        "realized_sharpe": F.when(F.col("realized_vol_7day") > 0, F.try_divide(
            F.try_divide("premium_usd", "capital_usd"), F.col("realized_vol_7day"))),
    }).drop("__notional")


def early_close(sized: DataFrame, gold: DataFrame, target: float = PROFIT_TARGET,
                max_rows_per_cell: int = MAX_ROWS_PER_CELL) -> DataFrame:
    """Add closed_at, buyback_usd and leg_pnl_usd: buy back at the first print after entry and before
    expiry whose mark is at most ``target`` of the entry mark, at that print's traded price (crossing.py).
    """
    leg_key = [*KEY, "target_delta"]
    sized = as_table(sized, "legs")
    legs = sized.select(
        *leg_key, "instrument_name", F.col("timestamp").alias("opens"), F.col("expiration_timestamp").alias("closes"),
        (F.col("mark_price") * F.lit(target)).alias("trigger"))
    prints = gold.filter("is_valid").select("instrument_name", *_ORDER, F.col("mark_price").alias("level"), "price")
    firsts = first_crossing(legs, prints, by="instrument_name", leg_key=leg_key, order=_ORDER,
                            take={"timestamp": "closed_at", "price": "__fill"}, max_rows=max_rows_per_cell)
    closed = sized.join(firsts, leg_key, "left")
    buyback = F.col("__fill") * F.col("amount") * F.col("entry_forward")
    return closed.withColumn("buyback_usd", buyback).drop("__fill").withColumn(
        "leg_pnl_usd", F.col("premium_usd") - F.coalesce("buyback_usd", "loss_usd"))


def early_close_returns(closed: DataFrame) -> DataFrame:
    totals = closed.groupBy(*KEY).agg(
        F.sum("capital_usd").alias("capital_usd"), F.sum("premium_usd").alias("premium_usd"),
        F.sum("leg_pnl_usd").alias("pnl_usd"), F.count("closed_at").alias("closed_legs"),
        F.max("closed_at").alias("last_close"),
    )
    return totals.withColumn("pnl_pct", F.try_divide("pnl_usd", "capital_usd"))


def with_tail_hedge(returns: DataFrame, prints: DataFrame, target: float = HEDGE_DELTA) -> DataFrame:
    """Add hedge_strike, hedge_delta and hedge_cost_usd: the period's print nearest ``target``, bought in
    the deepest leg's amount."""
    returns = as_table(returns, "ladders")
    hedge = nearest_legs(prints.join(returns.select(*ENTRY).distinct(), ENTRY), {"hedge": [target]})
    hedge = hedge.select(
        *ENTRY, F.col("mark_price").alias("__mark"), F.col("strike").alias("hedge_strike"),
        F.col("delta").alias("hedge_delta"))
    cost = F.col("__mark") * F.col("deep_amount") * F.col("entry_forward")
    return returns.join(hedge, ENTRY, "left").withColumn("hedge_cost_usd", cost).drop("__mark")


def ladder_summary(returns: DataFrame, by: Sequence[str] = ("currency", "config")) -> DataFrame:
    """Hit rate, assignments, premium and loss totals over ladders."""
    hits = F.count_if(F.col("premium_pct") > HIT_THRESHOLD)
    assigned = F.count_if("any_assigned")
    n = F.count(F.lit(1))
    return returns.groupBy(*by).agg(
        n.alias("ladders"), hits.alias("hits"), (hits / n).alias("hit_rate"),
        assigned.alias("assigned"), (assigned / n).alias("assignment_rate"),
        F.sum("premium_usd").alias("total_premium"), F.sum("loss_usd").alias("total_loss"),
        F.sum("pnl_usd").alias("total_pnl"),
        F.try_divide(F.sum("loss_usd"), F.sum("premium_usd")).alias("loss_share"),
        F.sum("unknown_legs").alias("unknown_legs"), F.count_if("margin_breach").alias("margin_breaches"),
    )


def entry_outcomes(chosen: DataFrame, gated: DataFrame, legs: DataFrame) -> DataFrame:
    """Candidate entries by status: entered, liquidity, or legs (no complete ladder)."""
    entered = legs.select(*ENTRY).distinct().withColumn("__legs", F.lit(True))
    status = (
        F.when(~F.coalesce(F.col("admitted"), F.lit(False)), "liquidity")
        .when(F.col("__legs").isNull(), "legs").otherwise("entered")
    )
    return (
        chosen.select(*ENTRY).join(gated.select(*ENTRY, "admitted"), ENTRY, "left").join(entered, ENTRY, "left")
        .groupBy("currency", status.alias("status")).agg(F.count(F.lit(1)).alias("entries"))
    )
