"""Registered queries: calendar steps and text forms (C9, C19), variable
blocks (K7), flag and platform filters (P5, P13), edition scans (S11) and
grid orientation (S17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import calendar as C
from tidewater.functions import text as TX
from tidewater.functions.grid import reg_xindex, reg_yindex
from tidewater.operators import grid_lookup as G
from tidewater.operators import select as S
from tidewater.plans import adapters as A
from tidewater.plans import sqlx as X
from tidewater.plans.catalog import register
from tidewater.plans.q_files import _folder
from tidewater.plans.q_meta import _ED, editions
from tidewater.sources import editions as E
from tidewater.sources import sinks as K


@register("calendar_steps", f"""WITH {A.cte('reports')},
d AS (SELECT *, CASE WHEN {X.valid_day('yr', 'mo', 'dy')} THEN make_date(yr, mo, dy) END AS day FROM reports),
m AS (SELECT *, make_date(yr, mo, 1) AS m1 FROM d)
SELECT uid, year(day - 1) AS y_yr, month(day - 1) AS y_mo, day(day - 1) AS y_dy,
  year(m1 - 1) AS last_yr, month(m1 - 1) AS last_mo,
  year(m1 + INTERVAL 1 MONTH) AS next_yr, month(m1 + INTERVAL 1 MONTH) AS next_mo,
  CAST(julian(day) AS BIGINT) AS julian,
  round(date_diff('day', day, CAST(m1 + INTERVAL 1 MONTH AS DATE)) * 24.0 - hr, 6) AS to_next_month,
  date_diff('month', m1, make_date(2024, 12, 1)) + 1 AS n_months,
  round(hr - date_diff('day', make_date(2000, 1, 1), day) * -24.0 - 12, 6) AS since_2000
FROM m""")
def q_calendar_steps(spark: SparkSession, sf: str) -> DataFrame:
    """The day before, last and next month, the day number, the months to
    the end of 2024, and hours to and from other times, of every report."""
    r = A.reports(spark, sf)
    day = ("yr", "mo", "dy")
    before, last, nxt = C.previous_day(*day), C.month_step("yr", "mo", -1), C.month_step("yr", "mo", 1)
    one, noon = F.lit(1), F.lit(12.0)
    return r.select(
        "uid", *[before[c].alias(f"y_{c}") for c in day], *[last[c].alias(f"last_{c}") for c in day[:2]],
        *[nxt[c].alias(f"next_{c}") for c in day[:2]], C.julian_day(*day).cast("long").alias("julian"),
        F.round(C.hours_between(*day, "hr", nxt["yr"], nxt["mo"], one, F.lit(0.0)), 6).alias("to_next_month"),
        F.size(C.months_through("yr", "mo", F.lit(2024), F.lit(12))).cast("long").alias("n_months"),
        F.round(C.hours_between(F.lit(2000), one, one, noon, *day, "hr"), 6).alias("since_2000"))


@register("report_text", f"""WITH {A.cte('reports')}
SELECT uid, CASE WHEN {X.valid_day('yr', 'mo', 'dy')} THEN strftime(make_date(yr, mo, dy), '%Y-%m-%d') ELSE '0000-00-00' END AS day,
  coalesce(CAST(pt AS VARCHAR), '\\N') AS pt, coalesce(CAST(round_even(sst * 100, 0) AS BIGINT), -9999) AS sst,
  coalesce(CAST(round_even(slp * 5, 0) AS BIGINT), -99) AS slp FROM reports""")
def q_report_text(spark: SparkSession, sf: str) -> DataFrame:
    """Date strings, missing marks and scaled integers."""
    return A.reports(spark, sf).select(
        "uid", TX.date_text("yr", "mo", "dy").alias("day"), TX.value_text("pt").alias("pt"),
        TX.scaled_integer("sst", 100, -9999).alias("sst"), TX.scaled_integer("slp", 5, -99).alias("slp"))


_BLOCK = ["at", "sst", "slp"]


@register("variable_files", f"""WITH {A.cte('reports')}, {A.cte('clim')},
r AS (SELECT *, CASE WHEN {X.valid_day('2004', 'mo', 'dy')} THEN {X.pentad('mo', 'dy')} END AS pentad,
             {X.reg_y('lat')} AS y, {X.reg_x('lon')} AS x FROM reports)
SELECT uid AS UID, CASE WHEN trim(id) <> '' THEN trim(id) END AS ID,
  CASE WHEN {X.valid_day('yr', 'mo', 'dy')} THEN strftime(make_date(yr, mo, dy), '%Y-%m-%d') ELSE '0000-00-00' END AS DATE,
  pentad AS PENTAD, hr AS HR, lat AS LAT, lon AS LON, r.at AS AT, r.sst AS SST, r.sst - c.sst AS SST_ANOM, r.slp AS SLP
FROM r LEFT JOIN clim c ON c.t = r.pentad - 1 AND c.y = r.y AND c.x = r.x""")
def q_variable_files(spark: SparkSession, sf: str) -> DataFrame:
    """K7 + C7: variable blocks with the anomaly of SST written by month, read
    back; a report without a normal stays, its anomaly is the missing mark."""
    r = A.reports(spark, sf).withColumn("t", F.when(C.valid_day_2004("mo", "dy"), C.pentad("mo", "dy") - 1))
    r = r.withColumns({"y": reg_yindex("lat"), "x": reg_xindex("lon")})
    cells = r.select("t", "y", "x").distinct()  # the field is first cut to the cells that reports lie in
    norm = A.climatology(spark).select("t", "y", "x", F.col("sst").alias("sst_norm")).join(cells, ["t", "y", "x"], "left_semi")
    block = K.variable_block(r.join(norm, ["t", "y", "x"], "left"), _BLOCK)
    out = _folder(spark, "variables")
    K.write_variable_block(block, out)
    return K.read_variable_block(spark, out, block.drop("f_yr", "f_mo").schema).drop("f_yr", "f_mo")


_FLAGS = ["bad", "late", "noval"]
_PASS = [("bad", 0), ("noval", 0)]


@register("flag_split", f"""SELECT uid, coalesce(bad = 0, false) AND coalesce(noval = 0, false) AS passed
FROM ({A.duck(A.qc_file_sql('SST', _FLAGS, 3))})""")
def q_flag_split(spark: SparkSession, sf: str) -> DataFrame:
    """P5: reports split by a conjunction of flag conditions; an unset flag fails."""
    good, bad = S.flag_split(A.view(spark, sf, A.qc_file_sql("SST", _FLAGS, 3)), _PASS)
    return good.select("uid", F.lit(True).alias("passed")).unionByName(bad.select("uid", F.lit(False).alias("passed")))


@register("station_platforms", f"""WITH {A.cte('reports')}
SELECT uid, pt FROM reports WHERE pt IS NULL OR pt IN (0, 1, 2, 3, 4, 5, 7, 33)""")
def q_station_platforms(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of the platform types that stations may have."""
    r = A.reports(spark, sf).select("uid", "pt", F.col("pt").cast("string").alias("kind"))
    return S.keep_platforms(r, col="kind").select("uid", "pt")


# columns of a written edition: text, whole number and height, each with odd forms
_EDITION = [("line", "object", 12), ("name", "object", 30), ("vsslM", "int", 12), ("platH", "float", 10)]
_RAW = """SELECT CAST(line AS STRING) AS line, CASE WHEN line % 9 = 0 THEN '-' ELSE lower(name) || 'é' END AS name,
  CASE line % 6 WHEN 0 THEN 'OT' WHEN 1 THEN CAST(vsslM AS STRING) || '.00' WHEN 2 THEN 'NA' WHEN 3 THEN '-' || CAST(vsslM AS STRING)
                WHEN 4 THEN 'x' ELSE CAST(vsslM AS STRING) || '.0' END AS vsslM,
  CASE line % 5 WHEN 0 THEN CAST(line % 40 AS STRING) || ',5' WHEN 1 THEN CAST(line % 40 AS STRING) || ' M' WHEN 2 THEN 'NA'
                WHEN 3 THEN CAST(line % 9 AS STRING) || '..25' ELSE CAST(line % 9 AS STRING) || '/75m' END AS platH"""


def _edition_sql() -> str:
    whole = "replace(replace(replace(trim(vsslM), '-', ''), '.00', ''), '.0', '')"
    height = "trim(platH)"
    for a, b in (("-", ""), (",", "."), ("..", "."), (" M", ""), ("m", ""), ("/", ".")):
        height = f"replace({height}, '{a}', '{b}')"
    raw = _RAW.replace("AS STRING", "AS VARCHAR")
    return f"""WITH w AS ({raw} FROM ({_ED})),
e AS (SELECT line, CASE WHEN name = '-' THEN 'NULL' ELSE upper(trim(name)) END AS name,
  CASE WHEN vsslM = 'OT' THEN 0 WHEN {whole} IN ('', 'NA') THEN -999999 ELSE TRY_CAST({whole} AS INTEGER) END AS vsslM,
  CASE WHEN {height} IN ('', 'NA') THEN -999999.0 ELSE TRY_CAST({height} AS DOUBLE) END AS platH FROM w)
SELECT f.form, e.* FROM e, (VALUES ('delimited'), ('fixed')) f(form)"""


@register("edition_files", _edition_sql())
def q_edition_files(spark: SparkSession, sf: str) -> DataFrame:
    """An edition written as ISO-8859-1 text, delimited and in fixed
    widths, read back through the converters."""
    raw = spark.sql(f"{_RAW} FROM {{e}}", e=editions(spark, sf))
    spaces = dict(encoding="ISO-8859-1", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    parts = []
    for form in ("delimited", "fixed"):
        out = _folder(spark, f"edition-{form}")
        if form == "fixed":
            line = F.concat(*[F.rpad(F.col(n), w, " ") for n, _k, w in _EDITION])
            raw.select(line.alias("value")).write.csv(out, sep="\u0001", quote="", **spaces)
        else:
            raw.write.csv(out, sep=";", quote="", **spaces)
        parts.append(E.read_edition(spark, out, _EDITION, form).withColumn("form", F.lit(form)))
    return parts[0].unionByName(parts[1])


_FIELD = f"""SELECT mo - 1 AS t, {X.reg_y('lat')} AS y, {X.reg_x('lon')} AS x, max(sst) AS value FROM reports GROUP BY ALL"""


@register("grid_tables", f"""WITH {A.cte('reports')}, f AS ({_FIELD})
SELECT 'level' AS form, * FROM f WHERE value IS NOT NULL AND t < 10
UNION ALL SELECT 'swapped', * FROM f WHERE value IS NOT NULL AND t < 12""")
def q_grid_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The highest SST of every month and cell, stored in two other
    orientations (south-first with levels; swapped and from 0E) and re-indexed."""
    r = A.reports(spark, sf).select((F.col("mo") - 1).alias("t"), reg_yindex("lat").alias("y"), reg_xindex("lon").alias("x"), "sst")
    field = r.groupBy("t", "y", "x").agg(F.max("sst").alias("value"))
    levels = field.select("t", (179 - F.col("y")).alias("y"), "x", "value", F.explode(F.array(F.lit(0), F.lit(1))).alias("depth"))
    swapped = field.select("t", F.pmod(F.col("x") + 180, F.lit(360)).alias("y"), F.col("y").alias("x"), "value")
    return G.as_grid_table(levels, 10, 1.0, flip_lat=True, level="depth").withColumn("form", F.lit("level")).unionByName(
        G.as_grid_table(swapped, 12, 1.0, roll_lon=True, transpose=True).withColumn("form", F.lit("swapped")))
