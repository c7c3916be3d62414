"""Time expressions on TIMESTAMP_NTZ columns.

All arithmetic uses day-time intervals, so results do not depend on the session
time zone and stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourgrid import params

FEED_TIME_FORMAT = "MM/dd/yyyy HH:mm:ss"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hours(n: int | Column) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.make_dt_interval(F.lit(0), n)


def days(n: int | Column) -> Column:
    return F.make_dt_interval(n if isinstance(n, Column) else F.lit(n))


def minutes(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def parse_feed_time(c: str | Column, fmt: str = FEED_TIME_FORMAT, strict: bool = True) -> Column:
    """Text to timestamp. ``strict`` raises on bad text, otherwise gives null."""
    if strict:
        return F.to_timestamp_ntz(_col(c), F.lit(fmt))
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def floor_minutes(c: str | Column, step: int) -> Column:
    """Floor to a step that divides an hour (60 gives the hour)."""
    c = _col(c)
    return c - F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(c) % F.lit(step), F.date_part(F.lit("SECOND"), c)
    )


def ceil_minutes(c: str | Column, step: int) -> Column:
    """Ceiling to a step; a stamp already on the step stays."""
    c = _col(c)
    low = floor_minutes(c, step)
    return F.when(low == c, c).otherwise(low + minutes(step))


def hour_ending(c: str | Column) -> Column:
    return ceil_minutes(c, 60)


def fixed_offset(c: str | Column, offset_hours: int = params.FIXED_OFFSET_HOURS) -> Column:
    """UTC to the fixed-offset panel time; no daylight saving."""
    return _col(c) + hours(offset_hours)


def hours_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole hours from ``earlier`` to ``later``."""
    gap = _col(later) - _col(earlier)
    return (F.date_part(F.lit("DAY"), gap) * 24 + F.date_part(F.lit("HOUR"), gap)).cast("int")


def local_to_utc(c: str | Column, zone: str = params.LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _col(c))


def utc_to_local(c: str | Column, zone: str = params.LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(c))


def local_time_exists_once(c: str | Column, zone: str = params.LOCAL_ZONE) -> Column:
    """False for local times skipped or repeated by a daylight-saving change.

    For zones whose clock moves by one hour: an hour later on the clock is then no
    hour (skipped) or two hours (repeated) later in UTC.
    """
    c = _col(c)
    return local_to_utc(c + hours(1), zone) - local_to_utc(c, zone) == hours(1)


def forecast_start(date: str | Column, hour: str | Column) -> Column:
    """First forecast stamp for a chosen date and hour label: date + (hour + 1) h."""
    return _col(date).cast("timestamp_ntz") + hours(_col(hour).cast("int") + 1)


def month_of(c: str | Column) -> Column:
    return F.month(_col(c))


def day_of_week(c: str | Column) -> Column:
    """Monday = 0."""
    return F.weekday(_col(c))


def hour_of_day(c: str | Column) -> Column:
    return F.hour(_col(c))


def relative_position(time: str | Column, origin: str | Column) -> Column:
    """Signed hour index of ``time`` against the forecast origin."""
    return hours_between(time, origin)
