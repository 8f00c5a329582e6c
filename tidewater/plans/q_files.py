"""Registered queries that go through files (sinks and scans: S1, S5, S7, S8,
S10, K1, K3, K6, K9, K10, K11) and small operators (J3 second file, J7, C5
azimuth, C7, C12 names, C18, O2).

A file query writes its whole input with a sink of the library into the
shared checkpoint folder, reads it back with the library's scan and returns
what was read; the oracle states the source rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import anomaly as AN
from tidewater.functions import solar
from tidewater.operators import cdm as CDM
from tidewater.operators import metadata as MD
from tidewater.plans import adapters as A
from tidewater.plans import sqlx as X
from tidewater.plans.catalog import register
from tidewater.plans.q_meta import _ED, editions
from tidewater.session import ensure_checkpoint_dir
from tidewater.sources import fixed_width as FW
from tidewater.sources import sinks as K
from tidewater.sources import tables as T


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{name}-{uuid.uuid4().hex[:12]}"


_CDM_COLS = ["report_id", "primary_station_id", "platform_type", "report_timestamp", "latitude", "longitude", "history"]


@register("cdm_files", f"""WITH h AS ({A.duck(A.HEADER_SQL)})
SELECT {', '.join(f"nullif({c}, '') AS {c}" for c in _CDM_COLS)} FROM h""")
def q_cdm_files(spark: SparkSession, sf: str) -> DataFrame:
    """K1 + S7: CDM header written as pipe text by source, read back."""
    out = _folder(spark, "cdm")
    K.write_cdm(A.view(spark, sf, A.HEADER_SQL), _CDM_COLS, out, partition_by=["sid_dck"])
    back = T.read_cdm(spark, f"{out}/*", _CDM_COLS)
    return back.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in _CDM_COLS])


_REPORT = {"YR": "yr", "MO": "mo", "DY": "dy", "HR": "hr", "LAT": "lat", "LON": "lon", "DS": "ds", "VS": "vs",
           "ID": "id", "AT": '"at"', "SST": "sst", "DPT": "dpt", "DCK": "dck", "SLP": "slp", "SID": "sid", "PT": "pt",
           "UID": "uid", "W": "w", "D": "d", "IRF": "irf", "bad_data": "bad_data"}
_READ = ["UID", "YR", "MO", "DY", "HR", "LAT", "LON", "SST", "PT", "IRF", "bad_data"]


@register("report_files", f"""WITH {A.cte('reports')}
SELECT {', '.join(f"{_REPORT[c]} AS {c}" for c in _READ)}, trim(coalesce(id, '')) AS ID FROM reports""")
def q_report_files(spark: SparkSession, sf: str) -> DataFrame:
    """K3 + S5: working reports written by month, read back."""
    r = A.reports(spark, sf)
    cols = [F.col(src.strip('"')).alias(name) for name, src in _REPORT.items()]
    out = _folder(spark, "months")
    month = [F.col("yr").alias("f_yr"), F.col("mo").alias("f_mo")]
    rows = r.select(*cols, F.lit("x").alias("outfile"), *month)
    rows = rows.withColumnsRenamed({"f_yr": "part_yr", "f_mo": "part_mo"})
    K.write_by_month(rows, out, by=("part_yr", "part_mo"))
    back = T.read_reports(spark, f"{out}/*/*")
    return back.select(*_READ, F.trim(F.coalesce("ID", F.lit(""))).alias("ID"))


@register("tagged_line_files", f"WITH l AS ({A.duck(A.LINES_SQL)}) SELECT rtrim(value) AS line, count(*) AS n FROM l GROUP BY 1")
def q_tagged_line_files(spark: SparkSession, sf: str) -> DataFrame:
    """K10 + S1: raw lines written by 'SID-DCK' tag and read from the files."""
    out = _folder(spark, "tags")
    FW.partition_lines(A.view_once(spark, sf, A.LINES_SQL), out, compression="gzip")
    d = FW.read_fixed_width(spark, f"{out}/*")
    # lines hardly repeat: counting them before the shuffle would only fill memory and spill
    return d.select(F.rtrim("value").alias("line")).repartition("line").groupBy("line").agg(F.count("*").alias("n"))


_FLAGS = ["clim", "noval"]
_FLAG_SQL = A.qc_file_sql("SST", _FLAGS, 5)


@register("flag_files", f"SELECT uid, {', '.join(f'coalesce({c}, 9) AS {c}' for c in _FLAGS)} FROM ({A.duck(_FLAG_SQL)})")
def q_flag_files(spark: SparkSession, sf: str) -> DataFrame:
    """K6 + S10: a QC flag block written as CSV, read back; never-set flags are 9."""
    d = A.view(spark, sf, _FLAG_SQL).withColumnsRenamed({c: f"sst_{c}" for c in _FLAGS})
    out = _folder(spark, "flags")
    K.write_flags(K.flag_block(d, "SST", _FLAGS, month_match=None), out)
    return T.read_qc_flags(spark, out, _FLAGS)


@register("correction_files", f"""SELECT report_id, value, "isChange", 'id' AS element FROM ({A.duck(A.CORRECTIONS_SQL)})""")
def q_correction_files(spark: SparkSession, sf: str) -> DataFrame:
    """Gzipped pipe correction files (more columns than the first three), read back."""
    out = _folder(spark, "corrections")
    rows = A.view(spark, sf, A.CORRECTIONS_SQL).select("report_id", "value", "isChange", F.lit('say "x').alias("note"))
    rows.write.csv(out, sep="|", compression="gzip", quote="", emptyValue="")
    return T.read_corrections(spark, out, "id")


@register("metadata_files", f"WITH e AS ({_ED}) SELECT rcnty, count(*) AS n, count(DISTINCT call) AS calls, min(valid_from) AS first_from FROM e GROUP BY 1")
def q_metadata_files(spark: SparkSession, sf: str) -> DataFrame:
    """Ship metadata written by country; rows, call signs and first date read back."""
    out = _folder(spark, "metadata")
    e = editions(spark, sf).select("line", "call", "name", "rcnty", F.col("valid_from").cast("string").alias("valid_from"))
    K.write_metadata(e, out)
    back = spark.read.csv(out, sep="|", header=True)
    return back.groupBy("rcnty").agg(F.count("*").alias("n"), F.countDistinct("call").alias("calls"),
                                     F.min("valid_from").cast("date").alias("first_from"))


_D1 = dict(fmod=4, a=1, b=2, sel=2)
_D2 = dict(fmod=3, a=3, b=1, sel=4)


@register("override_duplicates", f"""WITH a AS ({A.duck(A.DUPS_SQL, **_D1)}), b AS ({A.duck(A.DUPS_SQL, **_D2)})
SELECT a.uid, CASE WHEN b.uid IS NULL THEN a.flag ELSE b.flag END AS flag,
  CASE WHEN b.uid IS NULL THEN a.duplicates WHEN a.duplicates IS NULL OR b.duplicates IS NULL THEN NULL
       ELSE a.duplicates || b.duplicates END AS duplicates
FROM a LEFT JOIN b ON a.uid = b.uid""")
def q_override_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """The second duplicate file overrides the first."""
    return CDM.override_duplicates(A.view(spark, sf, A.DUPS_SQL, **_D1), A.view(spark, sf, A.DUPS_SQL, **_D2))


_WINDOW = (1980, 2010)


@register("metadata_window", f"""WITH h AS ({A.duck(A.HEADER_SQL)}), m AS ({A.duck(A.STATION_META_SQL)}),
x AS (SELECT *, 1973 + dck % 52 BETWEEN {_WINDOW[0]} AND {_WINDOW[1]} AND dck <> 780 AS ok FROM h)
SELECT x.report_id, CASE WHEN ok THEN coalesce(m.platform_sub_type, x.platform_type) ELSE x.platform_type END AS platform_type,
  CASE WHEN ok AND m.primary_station_id IS NOT NULL THEN x.history || ';metadata merged' ELSE x.history END AS history
FROM x LEFT JOIN m ON x.primary_station_id = m.primary_station_id""")
def q_metadata_window(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata merged only for sources and years that have it."""
    h = A.view(spark, sf, A.HEADER_SQL)
    m = A.view(spark, sf, A.STATION_META_SQL).withColumnRenamed("platform_sub_type", "platform_type")
    ok = (F.lit(1973) + F.col("dck") % 52).between(*_WINDOW) & (F.col("dck") != 780)
    out = CDM.update_where_available(h, m, "primary_station_id", ["platform_type"], ok, "metadata merged")
    return out.select("report_id", "platform_type", "history")


_RULES = """
SELECT CAST(CASE WHEN n_nationkey < 8 THEN 992 WHEN n_nationkey < 16 THEN 926 ELSE 720 END AS INT) AS dck,
       CAST(CASE WHEN n_nationkey % 8 = 7 THEN NULL ELSE n_nationkey % 8 END AS INT) AS pt,
       CAST(CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE 5 END AS INT) AS new_pt
FROM $nation
"""


@register("platform_correction", f"""WITH {A.cte('reports')}, r AS ({A.duck(_RULES)})
SELECT uid, CASE WHEN r.dck IS NOT NULL THEN r.new_pt ELSE reports.pt END AS pt
FROM reports LEFT JOIN r ON reports.dck = r.dck AND reports.pt IS NOT DISTINCT FROM r.pt""")
def q_platform_correction(spark: SparkSession, sf: str) -> DataFrame:
    """Platform types corrected by deck and type."""
    return CDM.correct_platform_type(A.reports(spark, sf), A.view(spark, sf, _RULES)).select("uid", "pt")


@register("numeric_order", f"WITH h AS ({A.duck(A.HEADER_SQL)}) SELECT report_id, latitude, longitude FROM h")
def q_numeric_order(spark: SparkSession, sf: str) -> DataFrame:
    """O2: text rows in numeric order (the order itself is checked in tests)."""
    h = A.view(spark, sf, A.HEADER_SQL).select("report_id", "latitude", "longitude")
    return CDM.numeric_order(h, ["latitude", "longitude"])


@register("regular_names", f"""WITH e AS ({_ED}),
n AS (SELECT line, regexp_replace(name || ' A  B C.D', '\\s+', ' ', 'g') AS x FROM e)
SELECT line, regexp_replace(regexp_replace(x, '( )([A-Z])( )', '\\1\\2.\\3', 'g'), '([A-Z])(\\.)([A-Z])', '\\1\\2 \\3', 'g') AS name FROM n""")
def q_regular_names(spark: SparkSession, sf: str) -> DataFrame:
    """Clean-up of ship names before linkage."""
    e = editions(spark, sf)
    return e.select("line", MD.regular_name(F.concat("name", F.lit(" A  B C.D"))).alias("name"))


@register("anomalies", f"""WITH {A.cte('reports')}, {A.cte('clim')},
r AS (SELECT uid, sst, {X.pentad('mo', 'dy')} - 1 AS t, {X.reg_y('lat')} AS y, {X.reg_x('lon')} AS x FROM reports
      WHERE {X.valid_day('2004', 'mo', 'dy')})
SELECT r.uid, r.sst - c.sst AS sst_anom, CASE WHEN c.sst_sd > 0 THEN (r.sst - c.sst) / c.sst_sd END AS sst_norm_anom
FROM r JOIN clim c ON c.t = r.t AND c.y = r.y AND c.x = r.x""")
def q_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Anomalies and anomalies in standard deviations."""
    from tidewater.functions.calendar import pentad, valid_day
    from tidewater.functions.grid import reg_xindex, reg_yindex

    r = A.reports(spark, sf).where(valid_day(F.lit(2004), F.col("mo"), F.col("dy"))).select(
        "uid", F.col("sst").alias("v"), (pentad("mo", "dy") - 1).alias("t"), reg_yindex("lat").alias("y"), reg_xindex("lon").alias("x"))
    c = A.climatology(spark).select("t", "y", "x", "sst", "sst_sd")
    return r.join(c, ["t", "y", "x"]).select("uid", AN.anomaly("v", "sst").alias("sst_anom"),
                                             AN.normalised_anomaly("v", "sst", "sst_sd").alias("sst_norm_anom"))


def _sun_sql() -> str:
    """Sun position by right ascension, declination and hour angle."""
    return f"""WITH {A.cte('reports')},
r AS (SELECT uid, lat, lon, hr, yr - 1980 AS dyr, CAST(make_date(yr, mo, dy) - make_date(yr, 1, 1) AS BIGINT) + 1 AS doy FROM reports
      WHERE hr IS NOT NULL AND {X.valid_day('yr', 'mo', 'dy')}),
t AS (SELECT *, dyr * 365 + floor((dyr - 1) / 4.0) - CASE WHEN dyr < 0 AND dyr % 4 <> 0 THEN 1 ELSE 0 END
         + doy - 1 + hr / 24.0 AS t FROM r),
a AS (SELECT *, 2 * pi() * t / 365.25 AS th FROM t),
b AS (SELECT *, 0.409140 - 6.2149e-9 * t AS ob, 4.900968 + 3.6747e-7 * t + (0.033434 - 2.3e-9 * t) * sin(-0.031271 - 4.5396e-7 * t + th)
         + 0.000349 * sin(2 * (-0.031271 - 4.5396e-7 * t + th)) + th AS lo,
         1.759335 + 2 * pi() * (t / 365.25 - dyr) + 3.694e-7 * t + (hr * 15 + lon) * pi() / 180 AS st FROM a),
c AS (SELECT *, asin(sin(lo) * sin(ob)) AS de, st - atan2(sin(lo) * cos(ob), cos(lo)) AS ha, lat * pi() / 180 AS ph FROM b)
SELECT uid, round(degrees(asin(sin(ph) * sin(de) + cos(ph) * cos(de) * cos(ha))), 3) + 0.0 AS elevation,
  round(sin(atan2(-cos(de) * sin(ha), cos(ph) * sin(de) - sin(ph) * cos(de) * cos(ha))), 3) + 0.0 AS east
FROM c"""


@register("sun_position", _sun_sql())
def q_sun_position(spark: SparkSession, sf: str) -> DataFrame:
    """Solar elevation and the sine of its azimuth at the report time."""
    from tidewater.functions.calendar import day_in_year, valid_day

    r = A.reports(spark, sf).where(valid_day(F.col("yr"), F.col("mo"), F.col("dy")) & F.col("hr").isNotNull())
    d = solar.with_sun_position(r, F.col("yr"), F.dayofyear(F.make_date("yr", "mo", "dy")), F.col("hr"), F.lit(0), "lat", "lon", azimuth="az")
    return d.select("uid", (F.round("sun_elev", 3) + 0.0).alias("elevation"),
                    (F.round(F.sin(F.radians("az")), 3) + 0.0).alias("east"))
