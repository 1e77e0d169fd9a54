"""Date and time helpers for zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds with fraction from ``earlier`` to ``later``."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(1_000_000.0)


def year_month(ts: Column) -> Column:
    """``'24-03'`` for March 2024."""
    return F.date_format(ts, "yy-MM")


def as_ntz(text: str) -> Column:
    """Literal zone-less timestamp."""
    return F.lit(text).cast("timestamp_ntz")


def before(as_of: Column, seconds: float) -> Column:
    """``as_of`` moved back; the clock is always a parameter."""
    return F.timestamp_add("MICROSECOND", F.lit(-int(seconds * 1_000_000)), as_of)


def half_open(ts: Column, start: Column, stop: Column) -> Column:
    """``start <= ts < stop``."""
    return (ts >= start) & (ts < stop)


def bucket_start(ts: Column, seconds: int) -> Column:
    """Start of the fixed-width time bucket (counted from 1970) that holds ``ts``."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    index = F.floor(F.timestamp_diff("SECOND", epoch, ts) / F.lit(seconds)).cast("bigint")
    return F.timestamp_add("SECOND", index * F.lit(seconds), epoch)
