"""Grid-cell index expressions and their inverses.

Python ``int()`` truncates toward zero; Spark's ``cast('int')`` of a double does
the same, so the truncation quirks of the MDS indexing are kept exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _trunc(x: Column) -> Column:
    return x.cast("int")


def lon180(lon) -> Column:
    """Longitude in (-180, 180]: values above 180 lose 360."""
    lon = _c(lon)
    return F.when(lon > 180, lon - 360.0).otherwise(lon)


def mds_yindex(lat, res: float = 1.0) -> Column:
    """MDS row: borderline latitudes go north in the north, south in the
    south, 0 goes south; +-90 nudged 0.001 inwards."""
    lat = _c(lat)
    local = F.when(lat == -90, lat + 0.001).when(lat == 90, lat - 0.001).otherwise(lat)
    n = int(round(90 / res))
    return F.when(lat > 0, F.lit(n - 1) - _trunc(local / res)).otherwise(F.lit(n) - _trunc(local / res))


def mds_xindex(lon, res: float = 1.0) -> Column:
    """MDS column of a longitude in -180..180 (call ``lon180`` first)."""
    lon = _c(lon)
    local = F.when(lon == -180, lon + 0.001).when(lon == 180, lon - 0.001).otherwise(lon)
    n = int(round(180 / res))
    return F.when(local > 0, _trunc(local / res) + n).otherwise(_trunc(local / res) + (n - 1))


def reg_yindex(lat, res: float = 1.0) -> Column:
    """Regular row: trunc((90 - lat)/res) clamped to the grid."""
    lat = _c(lat)
    ny = int(round(180 / res))
    y = _trunc((F.lit(90.0) - lat) / res) if res != 1 else _trunc(F.lit(90.0) - lat)
    return F.least(F.greatest(y, F.lit(0)), F.lit(ny - 1))


def reg_xindex(lon, res: float = 1.0) -> Column:
    """Regular column: wrap to -180..180, trunc((lon+180)/res) mod 360/res."""
    lon = _c(lon)
    nx = int(round(360 / res))
    w = F.when(lon >= 180.0, lon - 360.0).otherwise(lon)
    w = F.when(w < -180.0, w + 360.0).otherwise(w)
    x = _trunc((w + 180.0) / res) if res != 1 else _trunc(w + 180.0)
    return F.pmod(x, F.lit(nx))


def yindex_to_lat(y, res: float = 1.0) -> Column:
    return F.lit(90.0) - _c(y) * res - res / 2.0


def xindex_to_lon(x, res: float = 1.0) -> Column:
    return _c(x) * res - 180.0 + res / 2.0


def time_index(n: int, mo, dy) -> Column:
    """Time index of a grid with ``n`` steps: 1 -> 0, 73 -> pentad-1, 365 -> doy-1."""
    from tidewater.functions.calendar import doy365, pentad

    if n == 1:
        return F.lit(0)
    if n == 73:
        return pentad(mo, dy) - 1
    if n == 365:
        return doy365(mo, dy) - 1
    raise ValueError(f"unsupported time steps {n}")
