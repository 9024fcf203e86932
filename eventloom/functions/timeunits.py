"""Local clocks, date units and time scopes.

Scopes become literal bounds on the stored UTC column, so they reach the scan as
pushed filters; only displayed columns are converted to the local zone.
"""

from __future__ import annotations

import datetime as dt
import math
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UTC = dt.timezone.utc


def local(ts: Column | str, tz: str) -> Column:
    """The wall clock of `tz` for a UTC timestamp column."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c if tz == "UTC" else F.from_utc_timestamp(c, tz)


def local_date(ts: Column | str, tz: str = "UTC") -> Column:
    return F.to_date(local(ts, tz))


def msec_date(msec: Column | str, tz: str = "UTC") -> Column:
    return local_date(F.timestamp_millis(F.col(msec) if isinstance(msec, str) else msec), tz)


def date_units(df: DataFrame, tz: str = "UTC", ts: str = "event_timestamp") -> DataFrame:
    """Adds month, week (Monday), day and hour labels in the zone."""
    at = local(ts, tz)
    return (
        df.withColumn("month", F.date_format(at, "yyyy-MM"))
        .withColumn("week", F.date_format(F.date_trunc("week", at), "yyyy-MM-dd"))
        .withColumn("day", F.date_format(at, "yyyy-MM-dd"))
        .withColumn("hour", F.date_format(at, "yyyy-MM-dd HH:00"))
    )


def to_utc(wall: dt.datetime, tz: str) -> dt.datetime:
    """The UTC instant of a wall clock reading in `tz`."""
    return wall.replace(tzinfo=ZoneInfo(tz)).astimezone(UTC)


def instant(at: dt.datetime) -> Column:
    """A literal timestamp; folded, so it is pushed into scans."""
    micros = round((at - dt.datetime(1970, 1, 1, tzinfo=UTC)) / dt.timedelta(microseconds=1))
    return F.timestamp_micros(F.lit(micros))


def day_bounds(start: dt.date, end: dt.date, tz: str) -> tuple[dt.datetime, dt.datetime]:
    """UTC instants of the first moment of `start` and the first moment after `end`."""
    lo = to_utc(dt.datetime.combine(start, dt.time()), tz)
    hi = to_utc(dt.datetime.combine(end + dt.timedelta(days=1), dt.time()), tz)
    return lo, hi


def day_range(df: DataFrame, start: dt.date, end: dt.date, tz: str = "UTC",
              ts: str = "event_timestamp") -> DataFrame:
    """Rows of the local days start..end, upper bound excluded."""
    lo, hi = day_bounds(start, end, tz)
    return df.where((F.col(ts) >= instant(lo)) & (F.col(ts) < instant(hi)))


def floor_to_unit(wall: dt.datetime, unit: str) -> dt.datetime:
    day = wall.replace(hour=0, minute=0, second=0, microsecond=0)
    if unit == "WK":
        return day - dt.timedelta(days=day.weekday())
    if unit == "MM":
        return day.replace(day=1)
    if unit == "YY":
        return day.replace(month=1, day=1)
    return day


def back(wall: dt.datetime, n: int, unit: str) -> dt.datetime:
    """`n` units before; month arithmetic keeps the day where it exists."""
    if unit in ("MM", "YY"):
        months = wall.year * 12 + wall.month - 1 - (n if unit == "MM" else 12 * n)
        year, month = divmod(months, 12)
        last = (dt.date(year + (month == 11), (month + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
        return wall.replace(year=year, month=month + 1, day=min(wall.day, last))
    return wall - dt.timedelta(days=n * (7 if unit == "WK" else 1))


def relative_start(now: dt.datetime, tz: str, last_n: int, unit: str) -> dt.datetime:
    """UTC instant at which a "last N units" scope starts; the current unit is the last one."""
    wall = now.astimezone(ZoneInfo(tz)).replace(tzinfo=None)
    return to_utc(floor_to_unit(back(wall, last_n - 1, unit), unit), tz)


def whole_periods(start: dt.date, end: dt.date, unit: str) -> tuple[dt.date, dt.date]:
    """The range widened to whole weeks or months, so that a period is never counted in part."""
    first = floor_to_unit(dt.datetime.combine(start, dt.time()), unit)
    last = floor_to_unit(dt.datetime.combine(end, dt.time()), unit)
    following = last + dt.timedelta(days=7) if unit == "WK" else (last + dt.timedelta(days=32)).replace(day=1)
    return first.date(), (following - dt.timedelta(days=1)).date()


def scope_bounds(scope, tz: str) -> tuple[dt.datetime, dt.datetime]:
    """UTC bounds, both inclusive, of a fixed or relative scope (see explore.model.Scope)."""
    if scope.kind == "FIXED":
        lo, hi = day_bounds(scope.start, scope.end, tz)
    else:
        lo, hi = relative_start(scope.now, tz, scope.last_n, scope.unit), scope.now.astimezone(UTC)
    if scope.look_back_seconds:
        if scope.kind == "FIXED":
            lo -= dt.timedelta(seconds=scope.look_back_seconds)
        else:
            lo -= dt.timedelta(days=math.ceil(scope.look_back_seconds / 86400))
    return lo, hi


def in_scope(scope, tz: str, ts: str = "event_timestamp") -> Column:
    lo, hi = scope_bounds(scope, tz)
    return (F.col(ts) >= instant(lo)) & (F.col(ts) <= instant(hi))


def scope_dates(scope, tz: str) -> list[dt.date]:
    """The local dates a scope covers, in order."""
    if scope.kind == "FIXED":
        first, last = scope.start, scope.end
    else:
        last = scope.now.astimezone(ZoneInfo(tz)).date()
        first = relative_start(scope.now, tz, scope.last_n, scope.unit).astimezone(ZoneInfo(tz)).date()
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
