"""SQL-text restatements of the expression library, for the DuckDB oracles.

Each function returns an SQL expression string over the given column
expressions.  They are written independently of the Column builders so the
oracle checks the Spark code rather than mirroring it.  DuckDB notes: CAST
to INT rounds, so truncation is ``CAST(trunc(x) AS INT)``; ``round_even``
is Python's half-even rounding.
"""

from __future__ import annotations

import math


def ml(yr: str, mo: str) -> str:
    leap = f"(({yr}) % 4 = 0 AND ({yr}) % 100 <> 0 OR ({yr}) % 400 = 0)"
    return (f"(CASE WHEN ({mo}) IN (4,6,9,11) THEN 30 WHEN ({mo}) = 2 THEN "
            f"(CASE WHEN {leap} THEN 29 ELSE 28 END) WHEN ({mo}) BETWEEN 1 AND 12 THEN 31 END)")


def is_leap(yr: str) -> str:
    return f"(({yr}) % 4 = 0 AND ({yr}) % 100 <> 0 OR ({yr}) % 400 = 0)"


def doy365(mo: str, dy: str) -> str:
    return (f"((CASE ({mo}) WHEN 1 THEN 0 WHEN 2 THEN 31 WHEN 3 THEN 59 WHEN 4 THEN 90 "
            f"WHEN 5 THEN 120 WHEN 6 THEN 151 WHEN 7 THEN 181 WHEN 8 THEN 212 WHEN 9 THEN 243 "
            f"WHEN 10 THEN 273 WHEN 11 THEN 304 WHEN 12 THEN 334 END) + ({dy}))")


def pentad(mo: str, dy: str) -> str:
    return f"(CAST(floor(({doy365(mo, dy)} - 1) / 5) AS INT) + 1)"


def valid_day(yr: str, mo: str, dy: str) -> str:
    return (f"(({mo}) BETWEEN 1 AND 12 AND ({dy}) IS NOT NULL AND ({dy}) >= 1 "
            f"AND ({dy}) <= {ml(yr, mo)})")


def itrunc(x: str) -> str:
    return f"CAST(trunc({x}) AS INT)"


def pmod(a: str, n: int) -> str:
    return f"((({a}) % {n} + {n}) % {n})"


def lon180(lon: str) -> str:
    return f"(CASE WHEN ({lon}) > 180 THEN ({lon}) - 360 ELSE ({lon}) END)"


def mds_y(lat: str) -> str:
    loc = f"(CASE WHEN ({lat}) = -90 THEN ({lat}) + 0.001 WHEN ({lat}) = 90 THEN ({lat}) - 0.001 ELSE ({lat}) END)"
    return f"(CASE WHEN ({lat}) > 0 THEN 89 - {itrunc(loc)} ELSE 90 - {itrunc(loc)} END)"


def mds_x(lon: str) -> str:
    lo = lon180(lon)
    loc = f"(CASE WHEN {lo} = -180 THEN {lo} + 0.001 WHEN {lo} = 180 THEN {lo} - 0.001 ELSE {lo} END)"
    return f"(CASE WHEN {loc} > 0 THEN {itrunc(loc)} + 180 ELSE {itrunc(loc)} + 179 END)"


def reg_y(lat: str) -> str:
    return f"least(greatest({itrunc(f'90.0 - ({lat})')}, 0), 179)"


def reg_x(lon: str) -> str:
    w = f"(CASE WHEN ({lon}) >= 180.0 THEN ({lon}) - 360.0 ELSE ({lon}) END)"
    w = f"(CASE WHEN {w} < -180.0 THEN {w} + 360.0 ELSE {w} END)"
    return pmod(itrunc(f"{w} + 180.0"), 360)


def f(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 1 ELSE 0 END)"


def hard(v: str, lo: float, hi: float) -> str:
    return f(f"({v}) IS NULL OR NOT (({v}) BETWEEN {lo} AND {hi})")


# --- solar elevation --------------------------------------------------------
RAD = math.pi / 180.0
TWO_PI = 2 * math.pi


def sun_elevation_ctes(src: str, yr: str, mo: str, dy: str, hr: str, lat: str, lon: str,
                       hours_ago: float = 1.0, prefix: str = "sun") -> tuple[str, str]:
    """CTE chain computing ``elev`` on every row of ``src``; returns (ctes, final_name)."""
    doy = (f"({doy365(mo, dy)} + CASE WHEN {is_leap(yr)} AND ({mo}) > 2 THEN 1 ELSE 0 END)")
    lo = lon180(lon)
    c1 = f"""{prefix}1 AS (
  SELECT *, floor({hr}) - {hours_ago} AS _h2r, ({hr} - floor({hr})) * 60.0 AS _min2, {doy} AS _doy,
         CASE WHEN ({lat}) = 0 THEN 0.0001 ELSE ({lat}) END AS _lat2,
         CASE WHEN {lo} = 0 THEN 0.0001 ELSE {lo} END AS _lon2
  FROM {src})"""
    c2 = f"""{prefix}2 AS (
  SELECT *, CASE WHEN _h2r < 0 THEN _h2r + 24.0 ELSE _h2r END AS _h2,
         CASE WHEN _h2r < 0 THEN _doy - 1 ELSE _doy END AS _d2r
  FROM {prefix}1)"""
    c3 = f"""{prefix}3 AS (
  SELECT *, CASE WHEN _d2r <= 0 THEN {yr} - 1 ELSE {yr} END AS _y2,
         CASE WHEN _d2r <= 0 THEN (CASE WHEN {is_leap(f'{yr} - 1')} THEN 366 ELSE 365 END) ELSE _d2r END AS _d2
  FROM {prefix}2)"""
    c4 = f"""{prefix}4 AS (
  SELECT *, _y2 - 1980 AS _dely, floor((_y2 - 1980) / 4.0) AS _leap, _h2 + _min2 / 60.0 AS _tih
  FROM {prefix}3)"""
    c5 = f"""{prefix}5 AS (
  SELECT *, _dely * 365 + _leap + _d2 - 1.0 + _tih / 24.0
            - CASE WHEN _dely = _leap * 4 THEN 1.0 ELSE 0.0 END
            - CASE WHEN _dely < 0 AND _dely <> _leap * 4 THEN 1.0 ELSE 0.0 END AS _time
  FROM {prefix}4)"""
    c6 = f"""{prefix}6 AS (
  SELECT *, (360.0 * _time / 365.25) * {RAD!r} AS _theta FROM {prefix}5)"""
    c7 = f"""{prefix}7 AS (
  SELECT *, -0.031271 - 4.5396e-7 * _time + _theta AS _ma, 0.409140 - 6.2149e-9 * _time AS _obl
  FROM {prefix}6)"""
    c8 = f"""{prefix}8 AS (
  SELECT *, 4.900968 + 3.6747e-7 * _time + (0.033434 - 2.3e-9 * _time) * sin(_ma)
            + 0.000349 * sin(2.0 * _ma) + _theta AS _los
  FROM {prefix}7)"""
    c9 = f"""{prefix}9 AS (
  SELECT *, atan2(sin(_los) * cos(_obl), cos(_los)) AS _ra0, asin(sin(_los) * sin(_obl)) AS _dec,
         1.759335 + {TWO_PI!r} * (_time / 365.25 - _dely) + 3.694e-7 * _time AS _st0
  FROM {prefix}8)"""
    c10 = f"""{prefix}10 AS (
  SELECT *, CASE WHEN _ra0 < 0.0 THEN _ra0 + {TWO_PI!r} ELSE _ra0 END AS _ra,
         CASE WHEN _st0 >= {TWO_PI!r} THEN _st0 - {TWO_PI!r} ELSE _st0 END AS _st
  FROM {prefix}9)"""
    c11 = f"""{prefix}11 AS (
  SELECT *, _st + (_tih * 15.0 + _lon2) * {RAD!r} AS _lst0 FROM {prefix}10)"""
    c12 = f"""{prefix}12 AS (
  SELECT *, (CASE WHEN _lst0 >= {TWO_PI!r} THEN _lst0 - {TWO_PI!r} ELSE _lst0 END) - _ra AS _ha0
  FROM {prefix}11)"""
    c13 = f"""{prefix}13 AS (
  SELECT *, CASE WHEN _ha0 < 0 THEN _ha0 + {TWO_PI!r} ELSE _ha0 END AS _ha FROM {prefix}12)"""
    c14 = f"""{prefix}14 AS (
  SELECT *, asin(least(greatest(sin(_lat2 * {RAD!r}) * sin(_dec)
            + cos(_lat2 * {RAD!r}) * cos(_dec) * cos(_ha), -1.0), 1.0)) / {RAD!r} AS elev
  FROM {prefix}13)"""
    ctes = ",\n".join([c1, c2, c3, c4, c5, c6, c7, c8, c9, c10, c11, c12, c13, c14])
    return ctes, f"{prefix}14"


# --- humidity ---------------------------------------------------------------
def _sat(td: str, p: str, ice: bool) -> str:
    if ice:
        return f"(6.1115 * (1 + 3e-4 + 4.18e-6 * ({p})) * exp(((23.036 - ({td}) / 333.7) * ({td})) / (279.82 + ({td}))))"
    return f"(6.1121 * (1 + 7e-4 + 3.46e-6 * ({p})) * exp(((18.729 - ({td}) / 227.3) * ({td})) / (257.87 + ({td}))))"


def _wbt(t: str, td: str, p: str, e: str) -> str:
    a = f"(0.000066 * ({p}))"
    b = f"((409.8 * {e}) / pow(({td}) + 237.3, 2))"
    return f"(({a} * ({t}) + {b} * ({td})) / ({a} + {b}))"


def vap_raw(td: str, t: str, p: str) -> str:
    ew = _sat(td, p, False)
    return f"(CASE WHEN {_wbt(t, td, p, ew)} <= 0.0 THEN {_sat(td, p, True)} ELSE {ew} END)"


def r1(x: str) -> str:
    return f"(round_even(({x}) * 10.0, 0) / 10.0)"


def rh(td: str, t: str, p: str) -> str:
    return r1(f"{vap_raw(td, t, p)} / {vap_raw(t, t, p)} * 100.0")


def sh(td: str, t: str, p: str) -> str:
    e = vap_raw(td, t, p)
    return r1(f"1000.0 * ((0.622 * {e}) / (({p}) - (1 - 0.622) * {e}))")


def vap(td: str, t: str, p: str) -> str:
    return r1(vap_raw(td, t, p))


def wb(td: str, t: str, p: str) -> str:
    return r1(_wbt(t, td, p, vap_raw(td, t, p)))


def dpd(td: str, t: str) -> str:
    return r1(f"({t}) - ({td})")


# --- spherical geometry (degrees in, km / degrees out) -----------------------
R_KM = 6371.0088


def ang_dist(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    p1, l1, p2, l2 = (f"(({v}) * {RAD!r})" for v in (lat1, lon1, lat2, lon2))
    dl = f"abs({l1} - {l2})"
    b1 = f"(cos({p2}) * sin({dl}))"
    b2 = f"(cos({p1}) * sin({p2}) - sin({p1}) * cos({p2}) * cos({dl}))"
    return f"atan2(sqrt({b1} * {b1} + {b2} * {b2}), sin({p1}) * sin({p2}) + cos({p1}) * cos({p2}) * cos({dl}))"


def dist(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"({ang_dist(lat1, lon1, lat2, lon2)} * {R_KM!r})"


def fmod(a: str, b: float) -> str:
    return f"fmod({a}, {b!r})"


def course(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    d = ang_dist(lat1, lon1, lat2, lon2)
    p1, l1, p2, l2 = (f"(({v}) * {RAD!r})" for v in (lat1, lon1, lat2, lon2))
    ratio = f"((sin({p2}) - sin({p1}) * cos({d})) / (sin({d}) * cos({p1})))"
    fb = fmod(f"atan2(sin({l1} - {l2}) * cos({p2}), cos({p1}) * sin({p2}) - sin({p1}) * cos({p2}) * cos({l1} - {l2}))", TWO_PI)
    tc = (f"(CASE WHEN cos({p1}) < 0.0000001 THEN (CASE WHEN {p1} > 0 THEN {math.pi!r} ELSE {TWO_PI!r} END) "
          f"WHEN sin({l2} - {l1}) > 0 THEN (CASE WHEN {ratio} BETWEEN -1.0 AND 1.0 THEN acos({ratio}) ELSE {fb} END) "
          f"ELSE (CASE WHEN {ratio} BETWEEN -1.0 AND 1.0 THEN {TWO_PI!r} - acos({ratio}) ELSE {fb} END) END)")
    return f"(CASE WHEN {d} <> 0 THEN {tc} / {RAD!r} ELSE 0.0 END)"


def dest(lat1: str, lon1: str, crs: str, dkm: str) -> tuple[str, str]:
    p1, l1 = f"(({lat1}) * {RAD!r})", f"(({lon1}) * {RAD!r})"
    tc, dr = f"(({crs}) * {RAD!r})", f"(({dkm}) / {R_KM!r})"
    lat = f"asin(sin({p1}) * cos({dr}) + cos({p1}) * sin({dr}) * cos({tc}))"
    dlon = f"atan2(sin({tc}) * sin({dr}) * cos({p1}), cos({dr}) - sin({p1}) * sin({lat}))"
    lon = f"({fmod(f'{l1} + {dlon} + {math.pi!r}', TWO_PI)} - {math.pi!r})"
    return f"({lat} / {RAD!r})", f"({lon} / {RAD!r})"


def interm(lat1: str, lon1: str, lat2: str, lon2: str, f_: str) -> tuple[str, str]:
    d = ang_dist(lat1, lon1, lat2, lon2)
    p1, l1, p2, l2 = (f"(({v}) * {RAD!r})" for v in (lat1, lon1, lat2, lon2))
    a = f"(sin((1 - ({f_})) * {d}) / sin({d}))"
    b = f"(sin(({f_}) * {d}) / sin({d}))"
    x = f"({a} * cos({p1}) * cos({l1}) + {b} * cos({p2}) * cos({l2}))"
    y = f"({a} * cos({p1}) * sin({l1}) + {b} * cos({p2}) * sin({l2}))"
    z = f"({a} * sin({p1}) + {b} * sin({p2}))"
    lat = f"(CASE WHEN {d} <> 0 THEN atan2({z}, sqrt({x} * {x} + {y} * {y})) / {RAD!r} ELSE ({lat1}) END)"
    lon = f"(CASE WHEN {d} <> 0 THEN atan2({y}, {x}) / {RAD!r} ELSE ({lon1}) END)"
    return lat, lon


def jul_day(yr: str, mo: str, dy: str) -> str:
    a = f"floor((14 - ({mo})) / 12)"
    y = f"(({yr}) + 4800 - {a})"
    m = f"(({mo}) + 12 * {a} - 3)"
    return (f"(({dy}) + floor((153 * {m} + 2) / 5) + 365 * {y} + floor({y} / 4) - floor({y} / 100) "
            f"+ floor({y} / 400) - 32045)")
