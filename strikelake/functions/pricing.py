"""Black-76 prices and Greeks as Column expressions (JVM-side, no UDF).

``vol`` is a decimal (0.65), prices of the ``*_fraction`` kind are fractions of the forward.
Inputs that would divide by zero or take the log of a non-positive number give NULL, so the
expressions are safe under ANSI mode however Spark shares subexpressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# Abramowitz-Stegun normal CDF approximation, truncated as used by the tape's producer.
CDF_SCALE = 0.2316419
CDF_DENSITY = 0.3989423
CDF_TERMS = [0.3193815, -0.3565638, 1.781478, -1.821256, 1.330274]

DAYS_PER_YEAR = 365.0


class Normal:
    """Normal distribution values at one point: ``up`` is N(x), ``down`` is N(-x), ``density`` is N'(x)."""

    def __init__(self, x: Column, tail: Column, density: Column):
        self.x, self.tail, self.density = x, tail, density

    @classmethod
    def at(cls, x: Column) -> Normal:
        return cls(x, _tail(x, _falloff(x)), norm_pdf(x))

    def up(self) -> Column:
        return F.when(self.x >= 0, F.lit(1.0) - self.tail).otherwise(self.tail)

    def down(self) -> Column:
        return F.when(self.x <= 0, F.lit(1.0) - self.tail).otherwise(self.tail)


def _falloff(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.lit(CDF_SCALE) * F.abs(x))


def _tail(x: Column, k: Column) -> Column:
    """N(-|x|)."""
    series = F.lit(0.0)
    for term in reversed(CDF_TERMS):
        series = k * (F.lit(term) + series)
    return F.lit(CDF_DENSITY) * F.exp(-(x * x) / 2.0) * series


def _tail_text(x: str, k: str) -> str:
    """:func:`_tail` of two named columns as SQL text: one parsed string instead of thirty gateway calls."""
    series = "0D"
    for term in reversed(CDF_TERMS):
        series = f"{k} * ({term}D + {series})"
    return f"{CDF_DENSITY}D * exp(-({x} * {x}) / 2D) * ({series})"


def with_normals(df: DataFrame, **points: Column) -> tuple[DataFrame, dict[str, Normal]]:
    """Stage :class:`Normal` values at the named points as columns, so each is evaluated once per row.

    Returns the frame with helper columns (names start with ``__``) and the values by name; drop the
    helpers with :func:`without_normals`.
    """
    names = [f"__{n}" for n in points]
    staged = (
        df.withColumns(dict(zip(names, points.values())))
        .selectExpr("*", *[f"1D / (1D + {CDF_SCALE}D * abs({x})) AS {x}_k" for x in names])
        .selectExpr(
            "*", *[f"{_tail_text(x, x + '_k')} AS {x}_tail" for x in names],
            *[f"exp(-({x} * {x}) / 2D) / {math.sqrt(2.0 * math.pi)}D AS {x}_pdf" for x in names])
    )
    return staged, {n: Normal(F.col(x), F.col(f"{x}_tail"), F.col(f"{x}_pdf")) for n, x in zip(points, names)}


def without_normals(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*[f"__{n}{part}" for n in names for part in ("", "_k", "_tail", "_pdf")])


def norm_cdf(x: Column) -> Column:
    return Normal.at(x).up()


def norm_pdf(x: Column) -> Column:
    return F.exp(-(x * x) / 2.0) / F.lit(math.sqrt(2.0 * math.pi))


def d1(forward: Column, strike: Column, years: Column, vol: Column) -> Column:
    usable = (forward > 0) & (strike > 0) & (years > 0) & (vol > 0)
    drift = F.ln(F.try_divide(forward, strike)) + vol * vol * years / 2.0
    return F.when(usable, F.try_divide(drift, vol * _root(years)))


def d2(d1_value: Column, years: Column, vol: Column) -> Column:
    return d1_value - vol * _root(years)


def _root(years: Column) -> Column:
    return F.sqrt(F.greatest(years, F.lit(0.0)))


def _column(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def _is_call(side: Column) -> Column:
    return side == "call"


def delta_from(n1: Normal, forward: Column, strike: Column, years: Column, side: Column,
               discount: Column | float = 1.0) -> Column:
    df = _column(discount)
    at_expiry = F.when(
        _is_call(side), F.when(forward > strike, 1.0).otherwise(0.0)
    ).otherwise(F.when(forward < strike, -1.0).otherwise(0.0))
    live = F.when(_is_call(side), n1.up()).otherwise(-n1.down())
    return F.when(years <= 0, at_expiry).otherwise(df * live)


def gamma_from(n1: Normal, forward: Column, years: Column, vol: Column, discount: Column | float = 1.0) -> Column:
    scale = forward * vol * _root(years)
    return F.when(years <= 0, 0.0).otherwise(F.try_divide(_column(discount) * n1.density, scale))


def vega_from(n1: Normal, forward: Column, years: Column, discount: Column | float = 1.0) -> Column:
    """Per one percentage point of volatility."""
    return F.when(years <= 0, 0.0).otherwise(
        _column(discount) * forward * n1.density * _root(years) / 100.0)


def theta_from(n1: Normal, forward: Column, strike: Column, years: Column, vol: Column, side: Column,
               discount: Column | float = 1.0, rate: float = 0.0) -> Column:
    """Per calendar day."""
    df = _column(discount)
    per_year = F.try_divide(-(df * forward * n1.density * vol), 2.0 * _root(years))
    if rate != 0.0:
        n2 = Normal.at(d2(n1.x, years, vol))
        carry_call = F.lit(rate) * df * (forward * n1.up() - strike * n2.up())
        carry_put = F.lit(rate) * df * (strike * n2.down() - forward * n1.down())
        per_year = per_year + F.when(_is_call(side), carry_call).otherwise(carry_put)
    return F.when(years <= 0, 0.0).otherwise(per_year / DAYS_PER_YEAR)


def intrinsic(forward: Column, strike: Column, side: Column) -> Column:
    gap = F.when(_is_call(side), forward - strike).otherwise(strike - forward)
    return F.when(gap.isNotNull(), F.greatest(gap, F.lit(0.0)))


def price_from(n1: Normal, n2: Normal, forward: Column, strike: Column, years: Column, vol: Column, side: Column,
               discount: Column | float = 1.0) -> Column:
    """USD price per contract; intrinsic value at or past expiry, and at zero volatility."""
    df = _column(discount)
    call = forward * n1.up() - strike * n2.up()
    put = strike * n2.down() - forward * n1.down()
    return (
        F.when(years <= 0, intrinsic(forward, strike, side))
        .when(vol == 0, df * intrinsic(forward, strike, side))
        .otherwise(df * F.when(_is_call(side), call).otherwise(put))
    )


def _normals(forward, strike, years, vol) -> tuple[Normal, Normal]:
    x = d1(forward, strike, years, vol)
    return Normal.at(x), Normal.at(d2(x, years, vol))


def delta(forward, strike, years, vol, side, discount=1.0):
    return delta_from(_normals(forward, strike, years, vol)[0], forward, strike, years, side, discount)


def gamma(forward, strike, years, vol, discount=1.0):
    return gamma_from(_normals(forward, strike, years, vol)[0], forward, years, vol, discount)


def vega(forward, strike, years, vol, discount=1.0):
    return vega_from(_normals(forward, strike, years, vol)[0], forward, years, discount)


def theta(forward, strike, years, vol, side, discount=1.0, rate=0.0):
    return theta_from(_normals(forward, strike, years, vol)[0], forward, strike, years, vol, side, discount, rate)


def black76_price(forward, strike, years, vol, side, discount=1.0):
    n1, n2 = _normals(forward, strike, years, vol)
    return price_from(n1, n2, forward, strike, years, vol, side, discount)


def black76_price_fraction(forward, strike, years, vol, side):
    return F.try_divide(black76_price(forward, strike, years, vol, side), forward)


def greeks_bundle(forward, strike, years, vol, side, discount=1.0, rate=0.0) -> Column:
    """Struct of price, delta, gamma, vega and theta."""
    n1, n2 = _normals(forward, strike, years, vol)
    return F.struct(
        price_from(n1, n2, forward, strike, years, vol, side, discount).alias("price"),
        delta_from(n1, forward, strike, years, side, discount).alias("delta"),
        gamma_from(n1, forward, years, vol, discount).alias("gamma"),
        vega_from(n1, forward, years, discount).alias("vega"),
        theta_from(n1, forward, strike, years, vol, side, discount, rate).alias("theta"),
    )


def is_finite(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False))
