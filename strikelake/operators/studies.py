"""Studies over ladder rows: volatility structure, regimes, tertiles, correlation, Kelly, hedging.

Ladder rows are bounded by the calendar (see ladders.py), so windows over (currency, config) are small;
only trailing_vol_at reads the tape, and it does so by cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strikelake.operators.asof import previous_row
from strikelake.operators.cells import MAX_ROWS_PER_CELL
from strikelake.operators.ladders import HIT_THRESHOLD
from strikelake.operators.market import ANNUALIZATION, sample_stddev

GROUP = ["currency", "config"]


def trailing_vol_at(gold: DataFrame, entries: DataFrame, side: str = "put", days: int = 30,
                    max_rows_per_cell: int = MAX_ROWS_PER_CELL) -> DataFrame:
    """Annualized stddev of log returns inside [period - days, period] for each (currency, period).

    Only valid prints of one side count, and the first return's previous print must lie in the window.
    Returns are reduced to sums per (first period day they reach, day of the previous print), and only
    those sums are sent to the periods they feed.
    """
    tape = gold.filter(F.col("is_valid") & (F.col("option_type") == side)).select(
        "currency", "timestamp", "trade_seq", "trade_id", "futures_price")
    steps = previous_row(tape, "currency", ["timestamp", "trade_seq", "trade_id"],
                         {"futures_price": "before_price", "timestamp": "before"}, max_rows_per_cell)
    usable = (F.col("futures_price") > 0) & (F.col("before_price") > 0)
    day = F.to_date("timestamp")
    at_midnight = F.col("timestamp") == day.cast("timestamp_ntz")
    r = F.ln(F.try_divide("futures_price", "before_price"))
    sums = (
        steps.filter(usable)
        .select("currency", F.when(at_midnight, day).otherwise(F.date_add(day, 1)).alias("first"),
                F.date_add(F.to_date("before"), days).alias("last"), r.alias("r"))
        .groupBy("currency", "first", "last")
        .agg(F.count("r").alias("n"), F.sum("r").alias("s"), F.sum(F.col("r") * F.col("r")).alias("q"))
    )
    fed = sums.filter(F.col("first") <= F.col("last")).withColumn(
        "period", F.explode(F.sequence("first", "last")))
    wanted = entries.select("currency", "period").distinct()
    vol = sample_stddev(F.sum("n"), F.sum("s"), F.sum("q")) * ANNUALIZATION
    return fed.join(wanted, ["currency", "period"]).groupBy("currency", "period").agg(
        vol.alias("realized_vol_30day"))


def vol_structure(short: Column, long: Column) -> Column:
    """Expansion above 1.1 times the long-run vol, Contraction below 0.9, else Neutral; NULL when unknown."""
    ratio = F.try_divide(short, long)
    return F.when(ratio > 1.1, "Expansion").when(ratio < 0.9, "Contraction").when(ratio.isNotNull(), "Neutral")


def with_vol_structure(returns: DataFrame, trailing: DataFrame) -> DataFrame:
    return returns.join(trailing, ["currency", "period"], "left").withColumn(
        "vol_structure", vol_structure(F.col("realized_vol_7day"), F.col("realized_vol_30day")))


def regime_returns(returns: DataFrame, regime: str = "vol_structure") -> DataFrame:
    n = F.count(F.lit(1))
    return returns.filter(F.col(regime).isNotNull()).groupBy(*GROUP, regime).agg(
        n.alias("n"), F.try_divide(F.sum("pnl_usd"), F.sum("capital_usd")).alias("return_on_capital"),
        (F.count_if(F.col("premium_pct") > HIT_THRESHOLD) / n).alias("hit_rate"),
        F.avg("premium_pct").alias("avg_premium_pct"), F.count_if("any_assigned").alias("assignments"),
    )


def with_tertile(returns: DataFrame, value: str) -> DataFrame:
    """Add tertile low/mid/high: cuts at floor(n/3) and floor(2n/3) of the rows with a value."""
    group = Window.partitionBy(*GROUP)
    order = group.orderBy(value, "period", "expiration_timestamp")
    known = returns.filter(F.col(value).isNotNull())
    rank, n = F.row_number().over(order) - 1, F.count(F.lit(1)).over(group)
    return known.withColumns({"__rank": rank, "__n": n}).withColumn(
        "tertile",
        F.when(F.col("__rank") < F.floor(F.col("__n") / 3), "low")
        .when(F.col("__rank") < F.floor(F.col("__n") * 2 / 3), "mid").otherwise("high"),
    ).drop("__rank", "__n")


def _upper_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Element floor(n/2) of the sorted non-null values, per group."""
    group = Window.partitionBy(*keys)
    ranked = df.filter(F.col(value).isNotNull()).withColumns({
        "__rank": F.row_number().over(group.orderBy(value)) - 1,
        "__mid": F.floor(F.count(F.lit(1)).over(group) / 2),
    })
    return ranked.filter(F.col("__rank") == F.col("__mid")).select(*keys, F.col(value).alias(out))


def tertile_stats(returns: DataFrame, value: str = "iv_percentile") -> DataFrame:
    """Per tertile: size, value range, upper medians, assignment rate, totals."""
    keys = [*GROUP, "tertile"]
    labelled = with_tertile(returns, value)
    totals = labelled.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("value_low"), F.max(value).alias("value_high"),
        (F.count_if("any_assigned") / F.count(F.lit(1))).alias("assignment_rate"),
        F.sum("pnl_usd").alias("total_pnl"), F.sum("capital_usd").alias("total_capital"),
    )
    for column, out in (("premium_pct", "median_premium_pct"), ("forward_return", "median_forward_return"),
                        ("max_loss_usd", "median_max_loss")):
        totals = totals.join(_upper_median(labelled, keys, column, out), keys, "left")
    return totals


def premium_corr(returns: DataFrame) -> DataFrame:
    """Pearson correlation of IV percentile and premium share; NULL without variance."""
    known = returns.filter(F.col("iv_percentile").isNotNull())
    # Not F.corr: it divides by zero under ANSI mode when a side is constant.
    spread = F.sqrt(F.var_pop("iv_percentile") * F.var_pop("premium_pct"))
    r = F.try_divide(F.covar_pop("iv_percentile", "premium_pct"), spread)
    return known.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), r.alias("r"))


def kelly(returns: DataFrame) -> DataFrame:
    """Discrete Kelly by assignment and mean-variance Kelly of ladder returns."""
    won = ~F.col("any_assigned")
    base = returns.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(won).alias("wins"),
        F.avg(F.when(won, F.col("pnl_pct"))).alias("avg_win"),
        F.avg(F.when(~won, F.col("pnl_pct"))).alias("avg_assigned"),
        F.avg("pnl_pct").alias("mean_return"), F.var_pop("pnl_pct").alias("variance"),
    )
    shortfall = F.when(F.col("avg_assigned").isNotNull() & F.col("avg_win").isNotNull(),
                       F.greatest(F.col("avg_win") - F.col("avg_assigned"), F.lit(1e-6)))
    p = F.col("wins") / F.col("n")
    b = F.col("win_loss_ratio")
    return base.withColumn("shortfall", shortfall).withColumn(
        "win_loss_ratio", F.try_divide("avg_win", "shortfall")
    ).withColumns({
        "kelly_discrete": F.try_divide(p * b - (F.lit(1.0) - p), b),
        "kelly_mean_variance": F.when(F.col("variance") > 0, F.try_divide("mean_return", "variance")),
    })


def regime_kelly(returns: DataFrame, regime: str = "vol_regime") -> DataFrame:
    stats = returns.filter(F.col(regime).isNotNull()).groupBy(*GROUP, regime).agg(
        F.count(F.lit(1)).alias("n"), F.avg("pnl_pct").alias("mean_return"),
        F.var_pop("pnl_pct").alias("variance"))
    return stats.withColumn("kelly_mean_variance", F.when(
        F.col("variance") > 0, F.try_divide("mean_return", "variance")))


def hedge_study(hedged: DataFrame, value: str = "skew_proxy") -> DataFrame:
    """Per skew tertile: hedge cost, its share of premium, and the assigned ladders' loss it would cover."""
    return with_tertile(hedged, value).groupBy(*GROUP, "tertile").agg(
        F.count(F.lit(1)).alias("n"), F.sum("premium_usd").alias("premium"),
        F.sum("hedge_cost_usd").alias("hedge_cost"),
        F.try_divide(F.sum("hedge_cost_usd"), F.sum("premium_usd")).alias("cost_share"),
        F.sum(F.when(F.col("any_assigned") & F.col("hedge_cost_usd").isNotNull(), F.col("loss_usd"))
              .otherwise(0.0)).alias("hedge_benefit"),
        F.count_if("any_assigned").alias("assignments"),
        F.sum("pnl_usd").alias("pnl"),
        (F.sum("pnl_usd") - F.coalesce(F.sum("hedge_cost_usd"), F.lit(0.0))).alias("pnl_after_hedge"),
    )


def filter_study(returns: DataFrame, dropped: Column) -> DataFrame:
    """Totals of all ladders against those left after dropping rows where ``dropped`` is TRUE."""
    kept = ~F.coalesce(dropped, F.lit(False))
    return returns.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(kept).alias("n_kept"),
        F.sum("pnl_usd").alias("pnl"), F.sum(F.when(kept, F.col("pnl_usd")).otherwise(0.0)).alias("pnl_kept"),
        F.try_divide(F.sum("pnl_usd"), F.sum("capital_usd")).alias("return_all"),
        F.try_divide(F.sum(F.when(kept, F.col("pnl_usd"))),
                     F.sum(F.when(kept, F.col("capital_usd")))).alias("return_kept"),
    )
