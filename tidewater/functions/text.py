"""Text forms of report values for the sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.calendar import valid_day

# FIXED VALUES: what stands for a missing value and for a date that does not exist
MISSING = "\\N"
NO_DATE = "0000-00-00"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_text(yr, mo, dy) -> Column:
    """ISO date, or 0000-00-00 for a day that is missing or does not exist."""
    yr, mo, dy = _c(yr), _c(mo), _c(dy)
    day = F.when(valid_day(yr, mo, dy), F.make_date(yr, mo, dy))  # NULL as well without a year
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(NO_DATE))


def value_text(c) -> Column:
    """The value as text, or the missing mark."""
    return F.coalesce(_c(c).cast("string"), F.lit(MISSING))


def scaled_integer(c, scale: int, missing: int) -> Column:
    """``value * scale`` rounded half to even, ``missing`` for NULL."""
    return F.coalesce(F.bround(_c(c) * scale, 0).cast("long"), F.lit(missing).cast("long"))
