"""Instrument-name parsing: ``CUR-PERPETUAL``, ``CUR-dMMMyy``, ``CUR-dMMMyy-STRIKE-C|P``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strikelake.functions.timeline import epoch_millis

# Month codes used in instrument names.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
# Fixed value: contracts expire at 08:00 UTC.
EXPIRY_HOUR = 8
# Fixed value: a year is 365.25 days for time_to_expiry_years.
YEAR_MILLIS = 365.25 * 24 * 60 * 60 * 1000
# Fixed value: option name to its dated future.
FUTURE_KEY_PATTERN = "^([A-Z]+-[0-9]{1,2}[A-Z]{3}[0-9]{2})-"

_DATE_PATTERN = r"^\d{1,2}[A-Z]{3}\d{2}$"
_NUMBER_PATTERN = r"^([0-9]+(?:\.[0-9]+)?)"


def currency_of(name: Column) -> Column:
    return F.split_part(name, F.lit("-"), F.lit(1))


def future_key(name: Column) -> Column:
    """Dated future an option settles against; NULL when the name is not an option."""
    return F.nullif(F.regexp_extract(name, FUTURE_KEY_PATTERN, 1), F.lit(""))


def expiry_instant(code: Column) -> Column:
    """``8APR26`` to 2026-04-08 08:00; NULL when malformed. Day overflow rolls into the next month."""
    width = F.length(code)
    month = F.instr(F.lit("".join(MONTHS)), F.substring(code, width - 4, F.lit(3)))
    months = F.right(code, F.lit(2)).try_cast("int") * 12 + F.floor((month - 1) / 3).cast("int")
    first = F.add_months(F.lit("2000-01-01").cast("date"), months)
    day = F.date_add(first, F.left(code, width - 5).try_cast("int") - 1)
    wellformed = code.rlike(_DATE_PATTERN) & (month % 3 == 1)
    return F.when(wellformed, day.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(EXPIRY_HOUR)))


def _terms(parts: Column, expiry: Column) -> Column:
    count = F.size(parts)
    is_option = count == 4
    kind = (
        F.when((count == 2) & (F.get(parts, F.lit(1)) == "PERPETUAL"), F.lit("perpetual"))
        .when((count == 2) & expiry.isNotNull(), F.lit("future"))
        .when(is_option & expiry.isNotNull(), F.lit("option"))
    )
    strike = F.regexp_extract(F.get(parts, F.lit(2)), _NUMBER_PATTERN, 1).try_cast("double")
    side = F.when(F.get(parts, F.lit(3)) == "C", "call").otherwise("put")
    return F.when(
        kind.isNotNull(),
        F.struct(
            F.get(parts, F.lit(0)).alias("underlying"),
            kind.alias("instrument_type"),
            expiry.alias("expiration_timestamp"),
            F.when(is_option, strike).alias("strike"),
            F.when(is_option, side).alias("option_type"),
        ),
    )


def parse_instrument(name: Column) -> Column:
    """Struct(underlying, instrument_type, expiration_timestamp, strike, option_type); NULL when malformed.

    Strike and option type are set for options only.
    """
    parts = F.split(name, "-")
    return _terms(parts, expiry_instant(F.get(parts, F.lit(1))))


def with_terms(df: DataFrame, name: str = "instrument_name", out: str = "terms") -> DataFrame:
    """:func:`parse_instrument` as a column, with the split and the date parsed once per row."""
    return (
        df.withColumn("__parts", F.split(F.col(name), "-"))
        .withColumn("__expiry", expiry_instant(F.get("__parts", F.lit(1))))
        .withColumn(out, _terms(F.col("__parts"), F.col("__expiry")))
        .drop("__parts", "__expiry")
    )


def time_to_expiry_years(expiry: Column, ts: Column) -> Column:
    """Years to expiry, floored at 0; NULL without an expiry."""
    years = (epoch_millis(expiry) - epoch_millis(ts)).cast("double") / F.lit(YEAR_MILLIS)
    return F.when(expiry.isNotNull() & ts.isNotNull(), F.greatest(F.lit(0.0), years))
