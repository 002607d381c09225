"""Calendar helpers on TIMESTAMP_NTZ that never pass through the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_SECONDS = 86_400
WEEK_SECONDS = 7 * DAY_SECONDS


def epoch_seconds(ts: str) -> str:
    """SQL text for the whole seconds of column ``ts`` since 1970-01-01 (floor), a BIGINT.

    Text rather than Column calls: it is used in every cell expression, and one parsed string builds a
    plan faster than a dozen gateway calls.
    """
    return (f"(unix_date(to_date({ts})) * {DAY_SECONDS}L + hour({ts}) * 3600 + minute({ts}) * 60"
            f" + second({ts}))")


def epoch_micros(ts: str) -> str:
    """SQL text for the microseconds of column ``ts`` since 1970-01-01, a BIGINT."""
    return f"({epoch_seconds(ts)} * 1000000L + cast(extract(SECOND FROM {ts}) * 1000000 AS bigint) % 1000000)"


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970-01-01 (floor), as BIGINT."""
    minutes = F.unix_date(F.to_date(ts)).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minutes * 60_000 + F.floor(F.extract(F.lit("SECOND"), ts) * 1000)


def from_epoch_millis(ms: Column) -> Column:
    """TIMESTAMP_NTZ from epoch milliseconds."""
    seconds = (ms.cast("decimal(20,0)") / 1000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def week_of(ts: Column) -> Column:
    """Monday of the ISO week, as DATE."""
    return F.trunc(F.to_date(ts), "week")


def period_of(ts: Column, period: str) -> Column:
    """Entry period as DATE: ``week`` (Monday) or ``day``."""
    if period == "week":
        return week_of(ts)
    if period == "day":
        return day_of(ts)
    raise ValueError(f"period must be 'week' or 'day', not {period!r}")


def shifted(ts: Column, seconds: int) -> Column:
    return ts + F.make_dt_interval(secs=F.lit(seconds))
