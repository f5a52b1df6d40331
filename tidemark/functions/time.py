"""Time: localising, boundary counts, truncation, windows.

Every function names its zone.  The session time zone must be UTC (see tidemark.session).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F


def localize(naive: Column, tz: str) -> Column:
    """The instant of a naive local time.  An hour that occurs twice means its second occurrence; one that does not
    occur is moved forward by the gap."""
    first = F.to_utc_timestamp(naive.cast("timestamp"), tz)
    later = first + F.expr("interval 1 hour")
    return F.when(F.from_utc_timestamp(later, tz) == naive.cast("timestamp"), later).otherwise(first)


def local(instant: Column, tz: str) -> Column:
    """The naive local time of an instant."""
    return F.from_utc_timestamp(instant, tz).cast("timestamp_ntz")


def naive_utc(instant: Column) -> Column:
    return instant.cast("timestamp_ntz")


def hours_crossed(start: Column, end: Column) -> Column:
    """Hour boundaries between two instants (10:59 to 11:01 is one), negative if end is before start."""
    hour = lambda c: F.floor(F.unix_seconds(c) / 3600)
    return (hour(end) - hour(start)).cast("bigint")


def days_crossed(start: Column, end: Column, tz: str) -> Column:
    """Midnights in a zone between two instants."""
    return F.datediff(F.to_date(local(end, tz)), F.to_date(local(start, tz))).cast("bigint")


def trunc_naive(unit: str, naive: Column) -> Column:
    return F.date_trunc(unit, naive).cast("timestamp_ntz")


def month_of(instant: Column, tz: str) -> Column:
    """The first of the local month, as a naive timestamp."""
    return trunc_naive("month", local(instant, tz))


def hour_of(instant: Column) -> Column:
    """The hour of an instant, as naive UTC: unlike local hours, no two of these coincide."""
    return trunc_naive("hour", naive_utc(instant))


def anchor_column(naive: Column, hour: int = 3) -> Column:
    """The last time that the clock showed the hour, at or before a naive time."""
    shift = F.expr(f"interval {hour} hours")
    return (F.date_trunc("day", naive - shift).cast("timestamp_ntz") + shift).cast("timestamp_ntz")


def anchor(moment: dt.datetime, hour: int = 3) -> dt.datetime:
    shift = dt.timedelta(hours=hour)
    return dt.datetime.combine((moment - shift).date(), dt.time()) + shift


def month_windows(start: dt.datetime, end: dt.datetime) -> Iterator[tuple[str, dt.datetime, dt.datetime]]:
    """(label, start, end) for each calendar month from start to end (exclusive), clipped to both."""
    first = start.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    while first < end:
        following = (first + dt.timedelta(days=32)).replace(day=1)
        yield f"{first:%Y-%m}", max(first, start), min(following, end)
        first = following
