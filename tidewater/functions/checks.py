"""Per-value QC check expressions.

Each returns an INT column that is 1 for fail and 0 for pass, following the
documented rule that a missing input fails (the freeze check is the exception:
missing passes).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.calendar import month_length


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag(cond: Column) -> Column:
    """1 where ``cond`` is true, else 0 (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def value_check(v) -> Column:
    return flag(_c(v).isNull())


def no_normal_check(clim) -> Column:
    return flag(_c(clim).isNull())


def hard_limit(v, limits) -> Column:
    v = _c(v)
    lo, hi = limits
    return flag(v.isNull() | ~v.between(lo, hi))


def climatology_check(v, clim, limit) -> Column:
    v, clim = _c(v), _c(clim)
    return flag(v.isNull() | clim.isNull() | (F.abs(v - clim) > limit))


def climatology_plus_stdev_check(v, clim, sd, sd_limits, limit) -> Column:
    """Standardised anomaly with the standard deviation clamped to limits."""
    v, clim, sd = _c(v), _c(clim), _c(sd)
    lo, hi = sd_limits
    sdc = F.least(F.greatest(sd, F.lit(lo)), F.lit(hi))
    return flag(v.isNull() | clim.isNull() | sd.isNull() | (F.abs(v - clim) / sdc > limit))


def climatology_plus_stdev_with_lowbar(v, clim, sd, limit, lowbar) -> Column:
    v, clim, sd = _c(v), _c(clim), _c(sd)
    z = F.try_divide(F.abs(v - clim), sd)
    return flag(v.isNull() | clim.isNull() | sd.isNull() | ((z > limit) & (F.abs(v - clim) > lowbar)))


def supersat_check(dpt, at) -> Column:
    dpt, at = _c(dpt), _c(at)
    return flag(dpt.isNull() | at.isNull() | (dpt > at))


def sst_freeze_check(sst, uncertainty: float = 0.0, freezing_point: float = -1.8,
                     n_sigma: float = 2.0) -> Column:
    sst = _c(sst)
    return flag(sst.isNotNull() & (sst < freezing_point - n_sigma * uncertainty))


def wind_consistency(w, d, variable_limit) -> Column:
    w, d = _c(w), _c(d)
    return flag(
        w.isNull() | d.isNull() | ((d == 361) & (w != 0)) | ((d == 362) & (w > variable_limit))
    )


def position_check(lat, lon) -> Column:
    lat, lon = _c(lat), _c(lon)
    return flag(lat.isNull() | lon.isNull() | (lat < -90) | (lat > 90) | (lon < -180) | (lon > 360))


def time_check(hr) -> Column:
    hr = _c(hr)
    return flag(hr.isNull() | (hr >= 24) | (hr < 0))


def date_check(yr, mo, dy, first_year: int = 1850, last_year: int = 2024) -> Column:
    yr, mo, dy = _c(yr), _c(mo), _c(dy)
    ml = month_length(yr, mo)
    bad = (
        yr.isNull() | mo.isNull() | (yr > last_year) | (yr < first_year)
        | (mo < 1) | (mo > 12) | dy.isNull() | (dy < 1) | ml.isNull() | (dy > ml)
    )
    return flag(bad)
