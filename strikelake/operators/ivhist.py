"""Implied-vol history: 90-day bucketed percentile and 52-week range statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strikelake.functions.metrics import iv_bin, iv_percentile, iv_rank
from strikelake.functions.timeline import epoch_seconds

# Window lengths.
PERCENTILE_DAYS = 90
RANK_HOURS = 52 * 7 * 24
# Centre for the squared sums: keeps the population variance stable for IVs around this level.
_CENTRE = 50.0
_HOUR = f"floor({epoch_seconds('timestamp')} / 3600)"


def daily_iv_hist(rows: DataFrame) -> DataFrame:
    """Count of prints by (currency, day, half-point IV bin)."""
    return (
        rows.filter(F.col("implied_volatility").isNotNull())
        .groupBy("currency", F.to_date("timestamp").alias("day"), iv_bin(F.col("implied_volatility")).alias("iv_bin"))
        .agg(F.count(F.lit(1)).alias("bin_count"))
    )


def rolling_iv_hist(daily: DataFrame, days: int = PERCENTILE_DAYS, strict_past: bool = False) -> DataFrame:
    """cum_lt, cum_le and window_total per (currency, day, bin) over the trailing days.

    A day's count of a bin enters the window once and leaves it once, so two rows per bin and day are shuffled and
    summed along the days of a bin; the level between two changes is then laid out day by day, and accumulated over
    at most 2,000 bins per (currency, day). Counts are whole numbers, so taking them off again is exact.
    cum_lt is NULL when nothing lies below the bin.
    ``strict_past`` leaves the day itself out (the default includes it); the day's own bins are then listed
    with a count of zero, so that a bin that never traded before has a rank as well.
    """
    first = 1 if strict_past else 0
    n = F.col("bin_count")
    change = F.explode(F.array(F.struct(F.date_add("day", first).alias("day"), n.alias("change")),
                               F.struct(F.date_add("day", days).alias("day"), (-n).alias("change"))))
    changes = daily.select("currency", "iv_bin", change.alias("c")).groupBy(
        "currency", "iv_bin", F.col("c.day").alias("day")).agg(F.sum("c.change").alias("change"))
    along = Window.partitionBy("currency", "iv_bin").orderBy("day")
    levels = changes.select(
        "currency", "iv_bin", "day", F.lead("day").over(along).alias("until"),
        F.sum("change").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("n")).filter("n > 0")
    rolled = levels.select("currency", F.explode(F.sequence("day", F.date_sub("until", 1))).alias("day"), "iv_bin", "n")
    if strict_past:
        own = daily.select("currency", "day", "iv_bin", F.lit(0).cast("bigint").alias("n"))
        rolled = rolled.unionByName(own).groupBy("currency", "day", "iv_bin").agg(F.sum("n").alias("n"))
    bins = Window.partitionBy("currency", "day").orderBy("iv_bin")
    return rolled.select(
        "currency", "day", "iv_bin",
        F.nullif(F.sum("n").over(bins.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("cum_lt"),
        F.sum("n").over(bins.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("cum_le"),
        F.nullif(F.sum("n").over(Window.partitionBy("currency", "day")), F.lit(0)).alias("window_total"),
    )


def with_iv_percentile(rows: DataFrame, history: DataFrame | None = None, strict_past: bool = False) -> DataFrame:
    """Add iv_percentile_90day and iv_percentile_sample_size.

    The lookup table has at most 2,000 bins per currency-day; no broadcast is forced, so the runtime
    size decides between a broadcast and a skew-splittable shuffle join.
    """
    daily = daily_iv_hist(rows if history is None else history)
    # Only bins that traded that day can be asked for.
    lookup = rolling_iv_hist(daily, strict_past=strict_past).join(
        daily.select("currency", "day", "iv_bin"), ["currency", "day", "iv_bin"], "left_semi")
    keyed = rows.withColumns({"day": F.to_date("timestamp"), "iv_bin": iv_bin(F.col("implied_volatility"))})
    pct = iv_percentile(F.col("implied_volatility"), F.col("cum_lt"), F.col("cum_le"), F.col("window_total"))
    return keyed.join(lookup, ["currency", "day", "iv_bin"], "left").select(
        *rows.columns, pct.alias("iv_percentile_90day"), F.col("window_total").alias("iv_percentile_sample_size")
    )


def hourly_iv_moments(rows: DataFrame) -> DataFrame:
    """Per currency and hour: count, sums, low and high of all IVs; 8,766 rows a year and currency at most."""
    iv = F.col("implied_volatility")
    off = iv - _CENTRE
    return (
        rows.filter(iv.isNotNull())
        .groupBy("currency", F.expr(f"{_HOUR} AS hour"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(off).alias("s"), F.sum(off * off).alias("q"),
             F.min(iv).alias("low"), F.max(iv).alias("high"))
    )


def _combined(window, **names: str) -> list[Column]:
    """Moments of a window: sums of n, s and q, low and high, under the given names."""
    how = {"n": F.sum, "s": F.sum, "q": F.sum, "low": F.min, "high": F.max}
    return [how[c](c).over(window).alias(out) for c, out in names.items()]


def iv_stats_52w(rows: DataFrame) -> DataFrame:
    """Range statistics of the 52 weeks before each hour (that hour excluded), one row per currency and hour.

    In two levels, so that no hour reads thousands of others: the earlier hours of its day, the 363 whole days before,
    and of the day before those the hours from the same time on. Each part is a running figure or one per day.
    """
    hours = hourly_iv_moments(rows).withColumn("day", F.floor(F.col("hour") / 24))
    moments = ["n", "s", "q", "low", "high"]
    own = hours.select("currency", "day", "hour", *moments, F.lit(1).alias("lane"))
    aged = own.select("currency", (F.col("day") + RANK_HOURS // 24).alias("day"),
                      (F.col("hour") + RANK_HOURS).alias("hour"), *moments, F.lit(0).alias("lane"))
    daily = hours.groupBy("currency", "day").agg(*[F.sum(c).alias(c) for c in moments[:3]],
                                                 F.min("low").alias("low"), F.max("high").alias("high"))
    past_days = Window.partitionBy("currency").orderBy("day").rangeBetween(1 - RANK_HOURS // 24, -1)
    whole = daily.select(
        "currency", "day", *_combined(past_days, n="dn", s="ds", q="dq", low="dlow", high="dhigh"))
    today = Window.partitionBy("currency", "day", "lane").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    ended = Window.partitionBy("currency", "day").orderBy(F.desc("hour")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    of_aged = lambda c: F.when(F.col("lane") == 0, F.col(c))
    parts = own.unionByName(aged).select(
        "*", *_combined(today, n="tn", s="ts", q="tq", low="tlow", high="thigh"),
        *[F.sum(of_aged(c)).over(ended).alias("e" + c) for c in moments[:3]],
        F.min(of_aged("low")).over(ended).alias("elow"), F.max(of_aged("high")).over(ended).alias("ehigh"),
    ).filter("lane = 1").join(whole, ["currency", "day"], "left")
    total = lambda c: sum((F.coalesce(x + c, F.lit(0)) for x in ("t", "e")), F.coalesce("d" + c, F.lit(0)))
    summed = parts.select(
        "currency", "hour", total("n").alias("n"), total("s").alias("s"), total("q").alias("q"),
        F.least("tlow", "elow", "dlow").alias("iv_52w_low"), F.greatest("thigh", "ehigh", "dhigh").alias("iv_52w_high"))
    mean = F.when(F.col("n") > 0, F.try_divide("s", "n"))
    variance = F.try_divide("q", "n") - mean * mean
    return summed.select(
        "currency", "hour", "iv_52w_low", "iv_52w_high",
        (mean + _CENTRE).alias("iv_52w_mean"),
        F.when(F.col("n") > 0, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("iv_52w_stddev"),
    )


def with_iv_rank(rows: DataFrame) -> DataFrame:
    """Add iv_rank_52w, iv_52w_high/low/mean/stddev from the IVs of all instruments of the currency.

    NULL when IV is NULL or 0. ``rows`` needs a currency. The table of hours is joined as its size allows.
    """
    iv = F.col("implied_volatility")
    used = iv.isNotNull() & (iv != 0)
    keyed = rows.withColumn("__hour", F.when(used, F.expr(_HOUR)))
    stats = iv_stats_52w(rows).withColumnRenamed("hour", "__hour")
    joined = keyed.join(stats, ["currency", "__hour"], "left")
    return joined.select(
        *rows.columns,
        iv_rank(iv, F.col("iv_52w_low"), F.col("iv_52w_high")).alias("iv_rank_52w"),
        "iv_52w_high", "iv_52w_low", "iv_52w_mean", "iv_52w_stddev",
    )

