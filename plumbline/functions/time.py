"""Epochs, inclusive ranges and the buckets that leaderboards cap posts in."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def micros(when: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone (read as UTC)."""
    return F.unix_micros((F.col(when) if isinstance(when, str) else when).cast("timestamp"))


def at(epoch: int) -> Column:
    """The instant of epoch seconds, without zone, as the tables have it."""
    return F.timestamp_seconds(F.lit(epoch)).cast("timestamp_ntz")


def within(when: str, start: int | None, end: int | None) -> Column:
    """start <= when <= end in epoch seconds; a bound that is None is open. Pushed down to the scan."""
    out = F.lit(True)
    if start is not None:
        out = out & (F.col(when) >= at(start))
    if end is not None:
        out = out & (F.col(when) <= at(end))
    return out


def cap_bucket(when: str, period: str, anchor: datetime | None) -> Column:
    """A number for the day, week or month (30 days from an anchor) of ``when``; 0 for any other period.

    With an anchor, buckets have a fixed width and start there. Without one they are calendar days, weeks that
    start on Sunday, or calendar months.
    """
    width = {"day": 1, "week": 7, "month": 30}.get(period)
    if width is None:
        return F.lit(0).cast("long")
    if anchor is not None:
        zero = int((anchor - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
        return F.floor((micros(when) - F.lit(zero)) / F.lit(float(width * DAY_US)))
    day = F.unix_date(F.col(when).cast("date")).cast("long")
    if period == "day":
        return day
    if period == "week":
        return F.floor((day + 4) / 7.0)  # 1970-01-01 was a Thursday, the fourth day after a Sunday
    return F.year(when).cast("long") * 12 + F.month(when)
