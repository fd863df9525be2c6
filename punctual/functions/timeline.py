"""Service days, clock texts past midnight and instants of a local clock.

A clock time of the timetable may pass 24 hours. There are two readings: on the
wall clock (the day's midnight plus the time, read on the local clock), and
anchored to a trip (its first departure on the wall clock, then elapsed
seconds). They differ only where a trip meets a clock change. Skipped wall-clock
times resolve an hour later; of the two readings of a repeated hour the later
one is taken, as SQL engines with the ICU rules do.
"""

from __future__ import annotations

import re
from datetime import UTC, date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Australia/Sydney"
LABEL = "yyyy-MM-dd'T'HHmmss'Z'"
#: A service day's reports are filed from this long before local midnight to this long after the next.
BEFORE, AFTER = timedelta(hours=1), timedelta(hours=7)


def clock_seconds(text: Column) -> Column:
    """Seconds of ``HH:MM:SS``; hours may exceed 24."""
    part = lambda i, n: F.split_part(text, F.lit(":"), F.lit(i)).cast("int") * n
    return part(1, 3600) + part(2, 60) + part(3, 1)


def seconds(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n)


def wall_instant(day: Column, at: Column, zone: str = ZONE) -> Column:
    """The instant at which the local clock shows ``at`` seconds after the day's midnight.

    Spark reads a repeated hour as the earlier of the two; where the clock shows
    the same an hour on, that is the later one.
    """
    wall = day.cast("timestamp") + seconds(at)
    first = F.to_utc_timestamp(wall, zone)
    again = first + F.expr("interval 1 hour")
    return F.when(F.from_utc_timestamp(again, zone) == wall, again).otherwise(first)


def trip_instant(day: Column, first: Column, at: Column, zone: str = ZONE) -> Column:
    """The instant ``at - first`` elapsed seconds after the trip's first departure."""
    return wall_instant(day, first, zone) + seconds(at - first)


def service_hour(at: Column) -> Column:
    return F.floor(at / 3600).cast("int")


def local_date(instant: Column, zone: str = ZONE) -> Column:
    return F.from_utc_timestamp(instant, zone).cast("date")


def label_instant(label: Column) -> Column:
    """The instant of a snapshot's label."""
    return F.to_timestamp(label, LABEL)


def elapsed(later: Column, earlier: Column) -> Column:
    """Seconds between instants, as double."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / 1e6


def rounded(x: Column) -> Column:
    """Nearest integer, halves to even."""
    return F.bround(x, 0).cast("int")


def compact_day(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def parse_clock(text: str) -> int:
    if not re.fullmatch(r"\d+:[0-5]\d:[0-5]\d", text):
        raise ValueError(f"not a clock time: {text!r}")
    h, m, s = map(int, text.split(":"))
    return h * 3600 + m * 60 + s


def scheduled_instant(day: date, text: str, zone: str = ZONE) -> datetime:
    """Wall-clock reading on the driver, as ``wall_instant`` in a column, but for a repeated hour: here it is the earlier one."""
    wall = datetime(day.year, day.month, day.day) + timedelta(seconds=parse_clock(text))
    return wall.replace(tzinfo=ZoneInfo(zone)).astimezone(UTC)


def service_date(instant: datetime, zone: str = ZONE) -> date:
    return instant.astimezone(ZoneInfo(zone)).date()


def midnight(day: date, zone: str = ZONE) -> datetime:
    return datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(zone)).astimezone(UTC)


def merge_window(day: date, zone: str = ZONE) -> tuple[datetime, datetime]:
    """The instants between which a service day's reports arrive, the second excluded."""
    return midnight(day, zone) - BEFORE, midnight(day + timedelta(days=1), zone) + AFTER


def hours_between(start: datetime, end: datetime) -> list[datetime]:
    """Whole UTC hours that meet [start, end)."""
    at = start.replace(minute=0, second=0, microsecond=0)
    out = []
    while at < end:
        out.append(at)
        at += timedelta(hours=1)
    return out


def expected_hours(day: date, zone: str = ZONE) -> list[datetime]:
    """The UTC hours whose partials a service day folds."""
    return hours_between(*merge_window(day, zone))


def hours_in_day(day: date, zone: str = ZONE) -> int:
    """23, 24 or 25."""
    return int((midnight(day + timedelta(days=1), zone) - midnight(day, zone)).total_seconds() // 3600)


def day_hours(day: date, zone: str = ZONE) -> list[datetime]:
    """The UTC hours of a local day."""
    return hours_between(midnight(day, zone), midnight(day + timedelta(days=1), zone))


def partition_bounds(day: date, zone: str = ZONE) -> tuple[str, str]:
    """First and last ``dt`` to read, a day of slack on either side."""
    start, end = merge_window(day, zone)
    return (start.date() - timedelta(days=1)).isoformat(), (end.date() + timedelta(days=1)).isoformat()


def day_range(first: date, last: date) -> list[date]:
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def last_complete_day(now: datetime, zone: str = ZONE) -> date:
    """The latest service day whose window has closed."""
    day = service_date(now, zone) - timedelta(days=1)
    return day if merge_window(day, zone)[1] <= now else day - timedelta(days=1)


def hours_to_compact(days: list[date], zone: str = ZONE) -> list[datetime]:
    """The union of the days' hours, in order."""
    return sorted({h for d in days for h in expected_hours(d, zone)})


def snapshot_label(instant: datetime) -> str:
    return instant.astimezone(UTC).strftime("%Y-%m-%dT%H%M%SZ")
