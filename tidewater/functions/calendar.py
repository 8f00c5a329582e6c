"""Calendar expressions (C9): month lengths, 365-day day-of-year, pentads,
report timestamps, month arithmetic, and steps to other days and months.  Integer arithmetic only, so the same
rules are easy to state in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: days before the first of each month in a 365-day year.
DAYS_BEFORE_MONTH = [0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_leap(yr) -> Column:
    yr = _c(yr)
    return ((yr % 4 == 0) & (yr % 100 != 0)) | (yr % 400 == 0)


def month_length(yr, mo) -> Column:
    """Days in month ``mo`` of year ``yr`` (NULL for an invalid month)."""
    yr, mo = _c(yr), _c(mo)
    return (
        F.when(mo.isin(4, 6, 9, 11), F.lit(30))
        .when(mo == 2, F.when(is_leap(yr), F.lit(29)).otherwise(F.lit(28)))
        .when(mo.between(1, 12), F.lit(31))
    )


def doy365(mo, dy) -> Column:
    """Day in a 365-day year; 29 February counts as 1 March (= 60)."""
    mo, dy = _c(mo), _c(dy)
    before = F.try_element_at(F.array(*[F.lit(v) for v in DAYS_BEFORE_MONTH]), mo.cast("int"))
    return (before + dy).cast("int")


def pentad(mo, dy) -> Column:
    """Pentad 1..73 of a month/day (365-day year)."""
    return (F.floor((doy365(mo, dy) - 1) / 5) + 1).cast("int")


def day_in_year(yr, mo, dy) -> Column:
    """Real day of year 1..366 (leap years counted)."""
    d = doy365(mo, dy)
    return F.when(is_leap(yr) & (_c(mo) > 2), d + 1).otherwise(d).cast("int")


def valid_day(yr, mo, dy) -> Column:
    mo, dy = _c(mo), _c(dy)
    return mo.between(1, 12) & dy.isNotNull() & (dy >= 1) & (dy <= month_length(yr, mo))


def valid_day_2004(mo, dy) -> Column:
    """Month/day valid in the leap year 2004 (grid lookups use this)."""
    return valid_day(F.lit(2004), mo, dy)


def report_timestamp(yr, mo, dy, hr) -> Column:
    """Timestamp (no time zone) of a report: the hour is truncated and the
    minute is ``floor(60 * fraction)``; NULL when any part is missing or the
    date is invalid."""
    yr, mo, dy, hr = _c(yr), _c(mo), _c(dy), _c(hr)
    hour = F.floor(hr)
    minute = F.floor((hr - hour) * 60)
    ok = yr.isNotNull() & hr.isNotNull() & valid_day(yr, mo, dy) & (hr >= 0) & (hr < 24)
    return F.when(
        ok,
        F.make_timestamp_ntz(yr, mo, dy, hour.cast("int"), minute.cast("int"), F.lit(0)),
    )


def hours_since_epoch(ts) -> Column:
    """Hours (double) since 1970-01-01 of a TIMESTAMP_NTZ column."""
    # timestampdiff on TIMESTAMP_NTZ does not depend on the session time zone
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, _c(ts)) / 3600.0


def month_key(yr, mo) -> Column:
    """yr*12 + (mo-1): a month counter that makes month arithmetic integer."""
    return _c(yr) * 12 + (_c(mo) - 1)


def season(mo) -> Column:
    mo = _c(mo)
    return (
        F.when(mo.isin(12, 1, 2), F.lit("DJF"))
        .when(mo.isin(3, 4, 5), F.lit("MAM"))
        .when(mo.isin(6, 7, 8), F.lit("JJA"))
        .when(mo.isin(9, 10, 11), F.lit("SON"))
    )


def previous_day(yr, mo, dy) -> Column:
    """Struct (yr, mo, dy) of the day before; its fields are NULL for a day that does not exist."""
    before = F.date_sub(_date(yr, mo, dy), 1)
    return F.struct(F.year(before).alias("yr"), F.month(before).alias("mo"), F.day(before).alias("dy"))


def month_step(yr, mo, n: int) -> Column:
    """Struct (yr, mo) of the month ``n`` months on (-1: last month, 1: next month)."""
    return month_of_key(month_key(yr, mo) + n)


def month_of_key(key) -> Column:
    """Struct (yr, mo) of a ``month_key``."""
    key = _c(key)
    return F.struct(F.floor(key / 12).cast("int").alias("yr"), (F.pmod(key, F.lit(12)) + 1).cast("int").alias("mo"))


def months_through(yr1, mo1, yr2, mo2) -> Column:
    """Array of (yr, mo) from one month to another, both included; empty if the second is earlier."""
    first, last = month_key(yr1, mo1), month_key(yr2, mo2)
    return F.when(first <= last, F.transform(F.sequence(first, last), month_of_key)) \
        .when(first > last, F.array().cast("array<struct<yr:int,mo:int>>"))


def julian_day(yr, mo, dy) -> Column:
    """Astronomical day number (1970-01-01 is 2440588); NULL for a day that does not exist."""
    return F.date_diff(_date(yr, mo, dy), F.lit("1970-01-01").cast("date")) + 2440588


def hours_between(yr1, mo1, dy1, hr1, yr2, mo2, dy2, hr2) -> Column:
    """Hours from the first time to the second, negative if it is earlier;
    NULL for a day that does not exist or an hour outside 0 <= h < 24."""
    ok = reduce(lambda a, b: a & b, [(_c(h) >= 0) & (_c(h) < 24) for h in (hr1, hr2)])
    return F.when(ok, (julian_day(yr2, mo2, dy2) - julian_day(yr1, mo1, dy1)) * 24.0 + (_c(hr2) - _c(hr1)))


def _date(yr, mo, dy) -> Column:
    return F.when(valid_day(yr, mo, dy), F.make_date(_c(yr), _c(mo), _c(dy)))
