"""Registered queries: summaries
and per-report expression jobs (C6, C7, C9, C10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import calendar as CAL
from tidewater.functions import grid as G
from tidewater.functions import humidity as H
from tidewater.operators import summaries as SU
from tidewater.plans import adapters as A
from tidewater.plans import sqlx as X
from tidewater.plans.catalog import register

_ST = A.duck(A.STATION_REPORTS_SQL)
_KEYS = ", ".join(SU.STATION_KEYS)
_NOTNULL = " AND ".join(f"{k} IS NOT NULL" for k in SU.STATION_KEYS)
_VCOUNTS = ", ".join(f'count("{v}") AS {v}_count' for v, _ in SU.VARIABLE_CODES)
_OBS = " || ".join(
    f"CASE WHEN 100 * ({v}_count / obs_count) > 20.0 THEN '{c},' ELSE '' END" for v, c in SU.VARIABLE_CODES)
_STATION_MONTH_SQL = f"""
sm0 AS (SELECT period, {_KEYS}, min(report_timestamp) AS start_date, max(report_timestamp) AS end_date,
          min(longitude) AS bbox_min_lon, max(longitude) AS bbox_max_lon, min(latitude) AS bbox_min_lat,
          max(latitude) AS bbox_max_lat, count(longitude) AS obs_count, {_VCOUNTS}
        FROM st WHERE {_NOTNULL} GROUP BY period, {_KEYS}),
sm AS (SELECT *, regexp_replace({_OBS}, ',$', '') AS observed_variables FROM sm0)"""


def _stations(spark, sf):
    return A.view(spark, sf, A.STATION_REPORTS_SQL)


@register("station_month", f"WITH st AS ({_ST}), {_STATION_MONTH_SQL} SELECT * FROM sm")
def q_station_month(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly station summary (extent, bbox, counts, observed variables)."""
    return SU.station_month(_stations(spark, sf), by=["period"])


@register("station_year", f"""WITH st AS ({_ST}), {_STATION_MONTH_SQL},
y AS (SELECT primary_station_id, station_record_number, min(start_date) AS start_date, max(end_date) AS end_date,
        min(bbox_min_lon) AS bbox_min_lon, max(bbox_max_lon) AS bbox_max_lon, min(bbox_min_lat) AS bbox_min_lat,
        max(bbox_max_lat) AS bbox_max_lat,
        list_sort(list_distinct(flatten(list(string_split(observed_variables, ','))))) AS codes,
        first(station_name ORDER BY start_date, station_name) AS station_name,
        list_sort(list_distinct(list(station_name))) AS names,
        count(DISTINCT platform_type) AS npt
      FROM sm GROUP BY 1, 2)
SELECT primary_station_id, station_record_number, start_date, end_date, bbox_min_lon, bbox_max_lon,
  bbox_min_lat, bbox_max_lat, array_to_string(list_filter(codes, lambda c: c <> ''), ',') AS observed_variables,
  station_name, array_to_string(list_filter(names, lambda n: n <> station_name), ',') AS alternative_name,
  npt = 1 AS unique_platform_type
FROM y""")
def q_station_year(spark: SparkSession, sf: str) -> DataFrame:
    """Station records rolled up from the monthly summaries."""
    return SU.station_year(SU.station_month(_stations(spark, sf), by=["period"]))


@register("source_month", f"""WITH {A.cte('reports')}, t AS ({A.duck(A.SOURCE_TEMPLATE_SQL)}),
s AS (SELECT lpad(CAST(sid AS VARCHAR), 3, '0') || '-' || lpad(CAST(dck AS VARCHAR), 3, '0') AS source_key,
        min(lon) AS bbox_min_lon, max(lon) AS bbox_max_lon, min(lat) AS bbox_min_lat, max(lat) AS bbox_max_lat
      FROM reports GROUP BY 1)
SELECT s.*, t.product_name, t.description, 'ICOADS-3-0-0T-' || s.source_key AS source_id,
       'IC30' AS product_id, 'ICOADS' AS product_code
FROM s LEFT JOIN t ON s.source_key = t.source_key""")
def q_source_month(spark: SparkSession, sf: str) -> DataFrame:
    """A14 + J17: per-source bounding boxes joined to the source template."""
    return SU.source_month(A.reports(spark, sf), A.view(spark, sf, A.SOURCE_TEMPLATE_SQL))


@register("deck_summary", f"""WITH {A.cte('reports')},
d AS (SELECT id AS callsign, CAST(pt AS VARCHAR) AS platform, CAST(dck AS VARCHAR) AS deck, yr AS year,
        CAST(floor(({X.lon180('lon').replace('> 180', '>= 180')} + 180) / 5) + 72 * floor((lat + 90) / 5) AS BIGINT) AS cell,
        {X.lon180('lon').replace('> 180', '>= 180')} AS lon_n, lat FROM reports)
SELECT CASE WHEN grouping(callsign) = 0 THEN 'callsign' WHEN grouping(platform) = 0 THEN 'platform'
            WHEN grouping(deck) = 0 THEN 'deck' WHEN grouping(cell) = 0 THEN 'year_cell'
            WHEN grouping(year) = 0 THEN 'year' ELSE 'all' END AS dimension,
       coalesce(callsign, platform, deck, CAST(year AS VARCHAR)) AS key, cell, count(*) AS n,
       min(lon_n) AS min_lon, max(lon_n) AS max_lon, min(lat) AS min_lat, max(lat) AS max_lat
FROM d GROUP BY GROUPING SETS ((callsign), (platform), (deck), (year), (year, cell), ())""")
def q_deck_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by call sign, platform, deck, year and 5-degree cell."""
    return SU.deck_summary(A.reports(spark, sf))


_CMP = ["sst", "at", "dpt", "slp", "w", "d", "hr"]


@register("completeness", f"""WITH {A.cte('reports')}
SELECT uid, ({' + '.join(f'CASE WHEN "{c}" IS NOT NULL THEN 1 ELSE 0 END' for c in _CMP)}) / {float(len(_CMP))}
       AS completeness FROM reports""")
def q_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """Share of present fields per report."""
    return SU.completeness(A.reports(spark, sf), _CMP).select("uid", "completeness")


@register("drifter_inventory", f"""WITH {A.cte('reports')}
SELECT DISTINCT id, yr, mo FROM reports WHERE pt = 7""")
def q_drifter_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct drifter IDs per month."""
    return SU.drifter_inventory(A.reports(spark, sf))


@register("mean_missing", f"""WITH {A.cte('reports')}
SELECT dck, round(avg(sst), 6) AS sst_mean FROM reports GROUP BY dck""")
def q_mean_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Missing-aware mean of SST per deck."""
    out = SU.mean_missing(A.reports(spark, sf), "sst", ["dck"])
    return out.select("dck", F.round("sst_mean", 6).alias("sst_mean"))


@register("map_cdm_codes", f"""WITH st AS ({_ST}), m AS ({A.duck(A.CODE_MAP_SQL)})
SELECT st.primary_station_id, st.report_timestamp,
       CASE WHEN coalesce(m.value, st.platform_sub_type) = '' THEN NULL
            ELSE coalesce(m.value, st.platform_sub_type) END AS platform_sub_type
FROM st LEFT JOIN m ON st.platform_sub_type = m.code""")
def q_map_cdm_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Coded column mapped through a code table (unknown codes pass)."""
    out = SU.map_codes(_stations(spark, sf), "platform_sub_type", A.view(spark, sf, A.CODE_MAP_SQL))
    return out.select("primary_station_id", "report_timestamp", "platform_sub_type")


@register("join_station_metadata", f"""WITH st AS ({_ST}), {_STATION_MONTH_SQL},
m AS ({A.duck(A.STATION_META_SQL)})
SELECT sm.period, sm.primary_station_id, sm.station_record_number, sm.station_name, sm.platform_sub_type,
       sm.obs_count, m.station_name AS meta_name
FROM sm LEFT JOIN (SELECT 'V' || substr(primary_station_id, 2) AS k, station_name FROM m) m
  ON sm.primary_station_id || '-' || sm.station_record_number = m.k || '-1'""")
def q_join_station_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly station records left-joined to ship metadata on
    'callsign-record number'."""
    sm = SU.station_month(_stations(spark, sf), by=["period"])
    meta = A.view(spark, sf, A.STATION_META_SQL).select(
        F.concat(F.lit("V"), F.substr("primary_station_id", F.lit(2)), F.lit("-1")).alias("_key"),
        F.col("station_name").alias("meta_name"))
    j = sm.join(meta, SU.key_col("primary_station_id", "station_record_number") == F.col("_key"), "left")
    return j.select("period", "primary_station_id", "station_record_number", "station_name",
                    "platform_sub_type", "obs_count", "meta_name")


@register("join_raw_counts", f"""WITH h AS ({A.duck(A.HEADER_SQL)}), {A.cte('reports')}
SELECT h.report_id, h.primary_station_id, r.dck, r.pt
FROM h LEFT JOIN reports r ON h.report_id = 'ICOADS-30-' || r.uid""")
def q_join_raw_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Station header rows left-joined to the raw reports on UID."""
    h = A.view(spark, sf, A.HEADER_SQL).select("report_id", "primary_station_id")
    r = A.reports(spark, sf).select(F.concat(F.lit("ICOADS-30-"), F.col("uid")).alias("report_id"), "dck", "pt")
    return h.join(r, "report_id", "left")


# --- per-report expression jobs -------------------------------------------------------
@register("humidity", f"""WITH {A.cte('reports')}
SELECT uid, {X.vap('dpt', '"at"', 'slp')} AS vap, {X.sh('dpt', '"at"', 'slp')} AS shu,
       {X.rh('dpt', '"at"', 'slp')} AS crh, {X.wb('dpt', '"at"', 'slp')} AS cwb, {X.dpd('dpt', '"at"')} AS dpd
FROM reports""")
def q_humidity(spark: SparkSession, sf: str) -> DataFrame:
    """Vapour pressure, specific and relative humidity, wet bulb and dew
    point depression from AT, DPT and the reported SLP."""
    r = A.reports(spark, sf)
    return r.select("uid", H.vap("dpt", "at", "slp").alias("vap"), H.sh("dpt", "at", "slp").alias("shu"),
                    H.rh("dpt", "at", "slp").alias("crh"), H.wb("dpt", "at", "slp").alias("cwb"),
                    H.dpd("dpt", "at").alias("dpd"))


@register("calendar_cells", f"""WITH {A.cte('reports')}
SELECT uid,
  CASE WHEN {X.valid_day('yr', 'mo', 'dy')} THEN {X.pentad('mo', 'dy')} END AS pentad,
  CASE WHEN {X.valid_day('yr', 'mo', 'dy')} THEN {X.doy365('mo', 'dy')} END AS doy365,
  {X.ml('yr', 'mo')} AS month_length,
  {X.mds_y('lat')} AS mds_y, {X.mds_x('lon')} AS mds_x, {X.reg_y('lat')} AS reg_y, {X.reg_x('lon')} AS reg_x,
  CAST(trunc((90.0 - lat) / 0.25) AS INT) AS q_y
FROM reports""")
def q_calendar_cells(spark: SparkSession, sf: str) -> DataFrame:
    """C9 + C10: pentad, 365-day day of year, month length and grid indices."""
    r = A.reports(spark, sf)
    ok = CAL.valid_day("yr", "mo", "dy")
    return r.select("uid", F.when(ok, CAL.pentad("mo", "dy")).alias("pentad"),
                    F.when(ok, CAL.doy365("mo", "dy")).alias("doy365"),
                    CAL.month_length("yr", "mo").alias("month_length"),
                    G.mds_yindex("lat").alias("mds_y"), G.mds_xindex(G.lon180("lon")).alias("mds_x"),
                    G.reg_yindex("lat").alias("reg_y"), G.reg_xindex("lon").alias("reg_x"),
                    ((F.lit(90.0) - F.col("lat")) / 0.25).cast("int").alias("q_y"))


@register("robust_stats", f"""WITH {A.cte('reports')},
r AS (SELECT id, sst, row_number() OVER (PARTITION BY id ORDER BY sst, uid) - 1 AS r,
             count(*) OVER (PARTITION BY id) AS n FROM reports WHERE sst IS NOT NULL),
b AS (SELECT *, CAST(floor(n / 10) AS BIGINT) AS k1, CASE WHEN n >= 4 THEN CAST(floor(n / 4) AS BIGINT) ELSE 0 END AS lo
      FROM r),
c AS (SELECT id, max(n) AS n, avg(CASE WHEN r >= k1 AND r < n - k1 THEN sst END) AS tm,
             stddev_pop(CASE WHEN r >= k1 AND r < n - k1 THEN sst END) AS ts,
             sum(CASE WHEN r >= lo AND r <= n - 1 - lo THEN sst END) AS s,
             max(CASE WHEN r = lo THEN sst END) AS vl, max(CASE WHEN r = n - 1 - lo THEN sst END) AS vh, max(lo) AS lw
      FROM b GROUP BY id)
SELECT id, n, round(tm, 6) AS trimmed_mean, round(ts, 6) AS trimmed_std,
       round((s + (vl + vh) * lw) / n, 6) AS winsorised_mean FROM c""")
def q_robust_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A10: trimmed mean/std (trim 10) and winsorised mean of SST per platform."""
    out = SU.robust_stats(A.reports(spark, sf), "sst", "id", trim=10)
    return out.select("id", "n", *[F.round(c, 6).alias(c) for c in ("trimmed_mean", "trimmed_std", "winsorised_mean")])


_YEAR_SQL = f"""st AS ({_ST}), {_STATION_MONTH_SQL},
y AS (SELECT substr(period, 1, 4) AS year, primary_station_id, station_record_number, min(start_date) AS start_date,
        max(end_date) AS end_date, min(bbox_min_lon) AS bbox_min_lon, max(bbox_max_lon) AS bbox_max_lon,
        min(bbox_min_lat) AS bbox_min_lat, max(bbox_max_lat) AS bbox_max_lat,
        list_sort(list_distinct(flatten(list(string_split(observed_variables, ','))))) AS codes,
        first(station_name ORDER BY start_date, station_name) AS station_name,
        list_sort(list_distinct(list(station_name))) AS names, count(DISTINCT platform_type) AS npt
      FROM sm GROUP BY 1, 2, 3),
yy AS (SELECT year, primary_station_id, station_record_number, start_date, end_date, bbox_min_lon, bbox_max_lon,
         bbox_min_lat, bbox_max_lat, array_to_string(list_filter(codes, lambda c: c <> ''), ',') AS observed_variables,
         station_name, array_to_string(list_filter(names, lambda n: n <> station_name), ',') AS alternative_name,
         npt = 1 AS unique_platform_type FROM y)"""


@register("station_all", f"""WITH {_YEAR_SQL},
a AS (SELECT primary_station_id, station_record_number, min(start_date) AS start_date, max(end_date) AS end_date,
        min(bbox_min_lon) AS bbox_min_lon, max(bbox_max_lon) AS bbox_max_lon, min(bbox_min_lat) AS bbox_min_lat,
        max(bbox_max_lat) AS bbox_max_lat,
        list_sort(list_distinct(flatten(list(list_transform(list_filter(string_split(observed_variables, ','),
          lambda c: c <> ''), lambda c: CAST(c AS INTEGER)))))) AS codes,
        first(station_name ORDER BY start_date, station_name) AS station_name,
        list_distinct(list(station_name)) AS names,
        flatten(list(list_filter(string_split(coalesce(alternative_name, ''), ','), lambda x: x <> '' AND x <> 'NULL')))
          AS alts,
        min(CAST(unique_platform_type AS INTEGER)) AS uq
      FROM yy GROUP BY 1, 2)
SELECT primary_station_id, station_record_number, start_date, end_date, bbox_min_lon, bbox_max_lon, bbox_min_lat,
  bbox_max_lat, '{{' || array_to_string(codes, ',') || '}}' AS observed_variables, station_name,
  '{{' || array_to_string(list_sort(list_distinct(list_filter(list_concat(names, alts), lambda n: n <> station_name))), ',')
  || '}}' AS alternative_name, uq = 1 AS consistent
FROM a""")
def q_station_all(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly -> yearly -> all-years station records."""
    monthly = SU.station_month(_stations(spark, sf), by=["period"]).withColumn("year", F.substring("period", 1, 4))
    yearly = SU.station_year(monthly, by=["year"])
    return SU.station_all(yearly)


def _corners_sql(lat: str, lo: str, max90: bool) -> tuple[str, str, str, str]:
    def xl(e):  # xindex -> cell-centre longitude
        return f"({X.reg_x(e)} - 180 + 0.5)"

    def yl(e):
        return f"(90 - {X.reg_y(e)} - 0.5)"
    x2 = f"(CASE WHEN {xl(f'{lo} + 0.5')} < {lo} THEN {xl(f'{lo} + 0.5')} + 360.0 ELSE {xl(f'{lo} + 0.5')} END)"
    x1 = f"(CASE WHEN {xl(f'{lo} - 0.5')} > {lo} THEN {xl(f'{lo} - 0.5')} - 360.0 ELSE {xl(f'{lo} - 0.5')} END)"
    y2 = f"(CASE WHEN {lat} + 0.5 <= 90 THEN {yl(f'{lat} + 0.5')} ELSE {89.5 if max90 else 90.5} END)"
    y1 = f"(CASE WHEN {lat} - 0.5 >= -90 THEN {yl(f'{lat} - 0.5')} ELSE {-89.5 if max90 else -90.5} END)"
    return x1, x2, y1, y2


def _interp_sql() -> str:
    t = (f"CASE WHEN {X.valid_day('2004', 'mo', 'dy')} AND lat IS NOT NULL AND lon IS NOT NULL "
         f"THEN {X.pentad('mo', 'dy')} - 1 END")
    x1, x2, y1, y2 = _corners_sql("lat", "lo", True)
    probes = [("p1", "lat + 0.001", "lo + 0.001", "lat + 0.001 < 90"), ("p2", "lat + 0.001", "lo - 0.001", "lat + 0.001 < 90"),
              ("p3", "lat - 0.001", "lo + 0.001", "lat - 0.001 > -90"), ("p4", "lat - 0.001", "lo - 0.001", "lat - 0.001 > -90"),
              ("q11", "y1", "x1", "true"), ("q22", "y2", "x2", "true"), ("q12", "y2", "x1", "true"), ("q21", "y1", "x2", "true")]
    pr = " UNION ALL ".join(f"SELECT uid, t, '{n}' AS name, {X.reg_y(py)} AS y, {X.reg_x(px)} AS x FROM c WHERE {cond}"
                            for n, py, px, cond in probes)
    piv = ", ".join(f"max(CASE WHEN name = '{n}' THEN v END) AS {n}" for n, *_ in probes)
    m2 = lambda a, b: f"(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN ({a} + {b}) / 2.0 ELSE coalesce({a}, {b}) END)"
    bx1, bx2, by1, by2 = _corners_sql("lat", "lo", False)
    return f"""WITH {A.cte('reports')}, {A.cte('clim')},
b AS (SELECT uid, mo, dy, lat, {X.lon180('lon')} AS lo, {t} AS t FROM reports),
c AS (SELECT *, {x1} AS x1, {x2} AS x2, {y1} AS y1, {y2} AS y2 FROM b),
pr AS ({pr}),
v AS (SELECT pr.uid, pr.name, clim.sst AS v FROM pr LEFT JOIN clim ON clim.t = pr.t AND clim.y = pr.y AND clim.x = pr.x),
pv AS (SELECT uid, {piv} FROM v GROUP BY uid),
f AS (SELECT uid, (p1 IS NOT NULL OR p2 IS NOT NULL OR p3 IS NOT NULL OR p4 IS NOT NULL) AS anyp,
        coalesce(q11, {m2('q12', 'q21')}, q22) AS f11, coalesce(q22, {m2('q12', 'q21')}, q11) AS f22,
        coalesce(q12, {m2('q11', 'q22')}, q21) AS f12, coalesce(q21, {m2('q11', 'q22')}, q12) AS f21 FROM pv),
g AS (SELECT b.uid, b.lat, b.lo, f.*, {bx1} AS bx1, {bx2} AS bx2, {by1} AS by1, {by2} AS by2
      FROM b LEFT JOIN f ON b.uid = f.uid)
SELECT uid, round(CASE WHEN anyp THEN (f11 * (bx2 - lo) * (by2 - lat) + f21 * (lo - bx1) * (by2 - lat)
       + f12 * (bx2 - lo) * (lat - by1) + f22 * (lo - bx1) * (lat - by1)) / ((bx2 - bx1) * (by2 - by1)) END, 6)
       AS sst_interp FROM g"""


@register("clim_interpolated", _interp_sql())
def q_clim_interpolated(spark: SparkSession, sf: str) -> DataFrame:
    """SST climatology bilinearly interpolated to each report."""
    from tidewater.operators.grid_lookup import bilinear_lookup, corner_stencil
    r = A.reports(spark, sf).select("uid", "lat", "lon", "mo", "dy")
    stencil = A.stored(spark, "sst-stencil", lambda: corner_stencil(A.climatology(spark), "sst"))
    out = bilinear_lookup(r, A.climatology(spark), "sst", "sst_interp", stencil=stencil)
    return out.select("uid", F.round("sst_interp", 6).alias("sst_interp"))
