"""Date and time column expressions.

The session time zone is UTC; zone-local days (Europe/Amsterdam) are applied
explicitly with ``from_utc_timestamp`` / ``to_utc_timestamp``.  "Now" is
always an argument, never ``current_timestamp()``, so results are repeatable.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schemas import DAY_END_SUFFIX, DAY_START_SUFFIX, PARTITION_TZ


def as_col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def ts_lit(value: str | dt.datetime) -> Column:
    """A timestamp literal (UTC session)."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(value))


def day_range(start, end) -> Column:
    """Inclusive day sequence; empty (null → explode yields nothing) if start > end.

    Spark's ``sequence`` counts *down* when start > end, so guard it.
    """
    s, e = as_col(start), as_col(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("interval 1 day")))


def local_date(ts, tz: str = PARTITION_TZ) -> Column:
    return F.to_date(F.from_utc_timestamp(as_col(ts), tz))


def last_closed_day(now, tz: str = PARTITION_TZ) -> Column:
    """Last fully finished zone-local day before ``now`` (end offset 0)."""
    return F.date_sub(local_date(now, tz), 1)


def day_bounds(date_col) -> tuple[Column, Column]:
    """Request bounds as labels without offset: ``dT00:00:00`` / ``dT23:59:59``."""
    d = as_col(date_col).cast("string")
    return F.concat(d, F.lit(DAY_START_SUFFIX)), F.concat(d, F.lit(DAY_END_SUFFIX))


def epoch_split(ts) -> tuple[Column, Column]:
    """Exact (seconds, nanos) of a timestamp, from integer microseconds."""
    us = F.unix_micros(as_col(ts))
    seconds = F.floor(us / F.lit(1_000_000)).cast("long")
    nanos = ((us - seconds * F.lit(1_000_000)) * F.lit(1000)).cast("int")
    return seconds, nanos


def daily_cron_tick(now, hour: int, tz: str = PARTITION_TZ) -> Column:
    """Most recent ``0 <hour> * * *`` tick at or before ``now`` (zone-local), as UTC."""
    local_now = F.from_utc_timestamp(as_col(now), tz)
    today_tick = F.timestamp_seconds(
        F.unix_seconds(F.date_trunc("day", local_now)) + F.lit(hour * 3600))
    tick_local = F.when(today_tick <= local_now, today_tick).otherwise(
        today_tick - F.expr("interval 1 day"))
    return F.to_utc_timestamp(tick_local, tz)


def monthly_cron_tick(now, tz: str = PARTITION_TZ) -> Column:
    """Most recent ``0 0 1 * *`` tick at or before ``now`` (zone-local), as UTC."""
    local_now = F.from_utc_timestamp(as_col(now), tz)
    return F.to_utc_timestamp(F.date_trunc("month", local_now), tz)
