"""Registered queries: selection/validation (P, S16, K4) and CDM update joins
(J1-J7, A16, K2, S9, O3, O5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import cdm as CDM
from tidewater.operators import mapping as MAP
from tidewater.operators import select as SEL
from tidewater.operators.util import sized_broadcast
from tidewater.plans import adapters as A
from tidewater.plans.catalog import register

SHIP_PTS = [0, 1, 2, 3, 4, 5, 7]
DECKS = [732, 926, 780, 992, 701, 720]
RULES = {"pt": SHIP_PTS, "dck": DECKS}


def _reports(spark, sf):
    return A.reports(spark, sf)


# --- P1 / K4 ----------------------------------------------------------------
@register("select_values", f"""
WITH {A.cte('reports')}
SELECT uid,
  CASE WHEN NOT coalesce(pt IN ({', '.join(map(str, SHIP_PTS))}), false) THEN 'pt'
       WHEN NOT coalesce(dck IN ({', '.join(map(str, DECKS))}), false) THEN 'dck' END AS reject_reason
FROM reports""")
def q_select_values(spark: SparkSession, sf: str) -> DataFrame:
    """First failing value-list rule per report (NULL = kept)."""
    return SEL.select_values(_reports(spark, sf), RULES).select("uid", "reject_reason")


@register("value_list_counts", f"""
WITH {A.cte('reports')},
t AS (SELECT pt, dck,
  CASE WHEN NOT coalesce(pt IN ({', '.join(map(str, SHIP_PTS))}), false) THEN 'pt'
       WHEN NOT coalesce(dck IN ({', '.join(map(str, DECKS))}), false) THEN 'dck' END AS r FROM reports),
l AS (SELECT 'pt' AS rule, CAST(pt AS VARCHAR) AS value, r FROM t
      UNION ALL SELECT 'dck' AS rule, CAST(dck AS VARCHAR) AS value, r FROM t)
SELECT rule, value, sum(CASE WHEN r = rule THEN 1 ELSE 0 END) AS n_rejected,
       sum(CASE WHEN r IS NULL THEN 1 ELSE 0 END) AS n_kept
FROM l GROUP BY rule, value""")
def q_value_list_counts(spark: SparkSession, sf: str) -> DataFrame:
    """P1 audit: per rule and value, rows rejected by that rule and kept."""
    return SEL.value_list_counts(_reports(spark, sf), RULES)


# --- P2 ----------------------------------------------------------------------
def _masks():
    return {
        "lat": F.col("lat").between(-90, 90),
        "sst": F.col("sst").isNotNull(),
        "hour": F.col("hr") < 24,
    }


@register("mask_failure_counts", f"""
WITH {A.cte('reports')}
SELECT * FROM (
  SELECT 'lat' AS mask, sum(CASE WHEN coalesce(lat BETWEEN -90 AND 90, true) THEN 0 ELSE 1 END) AS n_failed,
         count(*) AS n_total FROM reports
  UNION ALL
  SELECT 'sst', sum(CASE WHEN sst IS NOT NULL THEN 0 ELSE 1 END), count(*) FROM reports
  UNION ALL
  SELECT 'hour', sum(CASE WHEN coalesce(hr < 24, true) THEN 0 ELSE 1 END), count(*) FROM reports)""")
def q_mask_failure_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Validity masks (NULL mask = true) and per-mask failure counts."""
    masked = SEL.apply_masks(_reports(spark, sf), _masks())
    return SEL.mask_failure_counts(masked, list(_masks()))


@register("valid_invalid_split", f"""
WITH {A.cte('reports')}
SELECT coalesce(lat BETWEEN -90 AND 90, true) AND sst IS NOT NULL AND coalesce(hr < 24, true) AS valid,
       count(*) AS n FROM reports GROUP BY 1""")
def q_valid_invalid_split(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of the valid and invalid outputs."""
    masked = SEL.apply_masks(_reports(spark, sf), _masks())
    return masked.groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


@register("numeric_histogram", f"""
WITH {A.cte('reports')},
b AS (SELECT min(sst) AS lo, max(sst) AS hi FROM reports)
SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((sst - lo) / ((hi - lo) / 10)), 9) END AS INT) AS bin,
       count(*) AS n, min(lo) AS lo, max(hi) AS hi
FROM reports, b WHERE sst IS NOT NULL GROUP BY 1""")
def q_numeric_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """10-bin histogram of a numeric column (last edge closed)."""
    return SEL.numeric_histogram(_reports(spark, sf), "sst", 10)


# --- P3 / P4 -----------------------------------------------------------------
def _header(spark, sf):
    return A.view(spark, sf, A.HEADER_SQL)


_CALL = "|".join(SEL.CALLSIGN_PATTERNS)


@register("valid_header", f"""
WITH h AS ({A.duck(A.HEADER_SQL)}),
p AS (SELECT deck, string_agg(pattern, '|') AS rx FROM ({A.duck(A.DECK_PATTERNS_SQL)}) GROUP BY deck),
j AS (SELECT h.*, coalesce(p.rx, '.*?') AS rx FROM h LEFT JOIN p ON h.dck = p.deck)
SELECT report_id,
  TRY_CAST(report_timestamp AS TIMESTAMP) IS NOT NULL AS mask_report_timestamp,
  coalesce(contains(history, 'Corrected primary_station_id'), false) OR
  CASE WHEN primary_station_id_scheme IN ('5') AND platform_type IN ('2', '33')
       THEN (primary_station_id IS NULL OR regexp_matches(primary_station_id, '^(?:{_CALL})'))
       ELSE (primary_station_id IS NULL OR regexp_matches(primary_station_id, '^(?:' || rx || '|^$)')) END
  AS mask_primary_station_id
FROM j""")
def q_valid_header(spark: SparkSession, sf: str) -> DataFrame:
    """P3 + P4: timestamp and station-ID validity masks of the header."""
    h = _header(spark, sf)
    pats = A.view(spark, sf, A.DECK_PATTERNS_SQL)
    v = SEL.valid_station_id(h, pats, deck="dck")
    return v.select("report_id", SEL.valid_timestamp("report_timestamp").alias("mask_report_timestamp"),
                    "mask_primary_station_id")


# --- J3 + P7 + P6 -------------------------------------------------------------
@register("preselect", f"""
WITH {A.cte('reports')},
d AS ({A.duck(A.DUPS_SQL, fmod=5, a=1, b=2, sel=1)}),
i AS ({A.duck(A.IDFILE_SQL)}),
p AS (SELECT uid, TRY_STRPTIME(new_date, '%Y-%m-%d %H:%M') AS ts, TRY_CAST(new_lat AS DOUBLE) AS nlat,
             TRY_CAST(new_lon AS DOUBLE) AS nlon FROM ({A.duck(A.DATEPOS_SQL)})),
j AS (
  SELECT r.uid, CASE WHEN i.uid IS NOT NULL THEN i.new_id ELSE r.id END AS id,
    CASE WHEN p.uid IS NOT NULL THEN year(p.ts) ELSE r.yr END AS yr,
    CASE WHEN p.uid IS NOT NULL THEN month(p.ts) ELSE r.mo END AS mo,
    CASE WHEN p.uid IS NOT NULL THEN day(p.ts) ELSE r.dy END AS dy,
    CASE WHEN p.uid IS NOT NULL THEN hour(p.ts) + minute(p.ts) / 60.0 ELSE r.hr END AS hr,
    CASE WHEN p.uid IS NOT NULL THEN p.nlat ELSE r.lat END AS lat,
    CASE WHEN p.uid IS NOT NULL THEN p.nlon ELSE r.lon END AS lon,
    r.pt, r.irf, r.bad_data, d.flag AS dup_flag
  FROM reports r LEFT JOIN d ON r.uid = d.uid LEFT JOIN i ON r.uid = i.uid LEFT JOIN p ON r.uid = p.uid),
o AS (SELECT * REPLACE (CASE WHEN pt = 7 AND irf = 1 THEN 0 WHEN pt = 7 THEN 3
                             WHEN dup_flag IS NULL THEN 4 ELSE dup_flag END AS dup_flag) FROM j)
SELECT uid, id, yr, mo, dy, hr, lat, lon, dup_flag FROM o
WHERE NOT coalesce(bad_data, false) AND (pt IS NULL OR pt IN (0, 1, 2, 3, 4, 5, 7)) AND dup_flag IN (0, 1, 4)""")
def q_preselect(spark: SparkSession, sf: str) -> DataFrame:
    """J3 + P7 + P6: duplicate flags, ID and date/position corrections, the
    drifter duplicate override, then the QC pre-selection."""
    r = _reports(spark, sf)
    dup = A.view(spark, sf, A.DUPS_SQL, fmod=5, a=1, b=2, sel=1)
    ids = A.view(spark, sf, A.IDFILE_SQL)
    dp = A.view(spark, sf, A.DATEPOS_SQL)
    out = CDM.apply_preprocess_corrections(r, dup, ids, dp)
    out = SEL.preselect(SEL.override_duplicate_flag(out))
    return out.select("uid", "id", "yr", "mo", "dy", "hr", "lat", "lon", "dup_flag")


# --- S16 -----------------------------------------------------------------------
EXCL_SQL = """
SELECT 'V' || CAST(s_suppkey AS STRING) AS id FROM $supplier
UNION ALL SELECT '' AS id FROM $region WHERE r_regionkey = 0
"""


@register("exclude_ids", f"""
WITH {A.cte('reports')},
x AS (SELECT DISTINCT rpad(id, 9, ' ') AS xid FROM ({A.duck(EXCL_SQL)}) WHERE trim(id) <> '')
SELECT uid, id FROM reports r WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.xid = r.id)""")
def q_exclude_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Drop reports whose (9-padded) ID is on the exclusion list."""
    lst = A.view(spark, sf, EXCL_SQL)
    return SEL.exclude_ids(_reports(spark, sf), lst).select("uid", "id")


# --- J1 ------------------------------------------------------------------------
@register("apply_corrections", f"""
WITH h AS ({A.duck(A.HEADER_SQL)}), c AS ({A.duck(A.CORRECTIONS_SQL)})
SELECT h.report_id,
  CASE WHEN coalesce(c.isChange = '1', false) THEN c.value ELSE h.primary_station_id END AS primary_station_id,
  CASE WHEN coalesce(c.isChange = '1', false) THEN coalesce(h.history, '') || ';ID corrected'
       ELSE h.history END AS history
FROM h LEFT JOIN c ON h.report_id = c.report_id""")
def q_apply_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """Corrected primary_station_id where isChange = '1', history appended."""
    h = _header(spark, sf)
    c = A.view(spark, sf, A.CORRECTIONS_SQL)
    out, _ = CDM.apply_corrections(h, c, "primary_station_id", history_msg="ID corrected")
    return out.select("report_id", "primary_station_id", "history")


@register("correction_counts", f"""
WITH h AS ({A.duck(A.HEADER_SQL)}), c AS ({A.duck(A.CORRECTIONS_SQL)})
SELECT sum(CASE WHEN coalesce(c.isChange = '1', false) THEN 1 ELSE 0 END) AS n_corrected,
       count(*) AS n_total, 'primary_station_id' AS element
FROM h LEFT JOIN c ON h.report_id = c.report_id""")
def q_correction_counts(spark: SparkSession, sf: str) -> DataFrame:
    """J1 quicklook: number of corrections applied."""
    _, counts = CDM.apply_corrections(_header(spark, sf), A.view(spark, sf, A.CORRECTIONS_SQL),
                                      "primary_station_id")
    return counts


# --- J2 ------------------------------------------------------------------------
@register("merge_duplicates", f"""
WITH a AS ({A.duck(A.DUPS_SQL, fmod=4, a=1, b=2, sel=2)}),
b AS ({A.duck(A.DUPS_SQL, fmod=3, a=3, b=1, sel=3)}),
j AS (SELECT a.uid, a.flag AS f1, b.flag AS f2,
        regexp_replace(coalesce(a.duplicates, ''), '^\\{{|\\}}$', '', 'g') AS d1,
        regexp_replace(coalesce(b.duplicates, ''), '^\\{{|\\}}$', '', 'g') AS d2
      FROM a LEFT JOIN b ON a.uid = b.uid)
SELECT uid, CAST(greatest(f1, f2) AS INT) AS flag,
  '{{' || array_to_string(list_filter(list_concat(string_split(d1, ','), string_split(d2, ',')), lambda x: x <> ''), ',')
  || '}}' AS duplicates
FROM j""")
def q_merge_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Merge two duplicate files (max flag, concatenated member lists)."""
    a = A.view(spark, sf, A.DUPS_SQL, fmod=4, a=1, b=2, sel=2)
    b = A.view(spark, sf, A.DUPS_SQL, fmod=3, a=3, b=1, sel=3)
    return CDM.merge_duplicates(a, b)


# --- J4 / J5 -------------------------------------------------------------------
@register("propagate_mask", f"""
WITH h AS ({A.duck(A.HEADER_SQL)}),
o AS ({A.duck(A.OBS_SQL, modulus=13, skip=0)}),
v AS (SELECT report_id FROM h WHERE TRY_CAST(report_timestamp AS TIMESTAMP) IS NOT NULL)
SELECT o.report_id, o.observation_value FROM o WHERE o.report_id IN (SELECT report_id FROM v)""")
def q_propagate_mask(spark: SparkSession, sf: str) -> DataFrame:
    """Observations of reports that passed header validation (semi join)."""
    h = _header(spark, sf)
    valid = h.where(SEL.valid_timestamp("report_timestamp"))
    obs = A.view(spark, sf, A.OBS_SQL, modulus=13, skip=0)
    return CDM.propagate_mask(obs, valid).select("report_id", "observation_value")


@register("carry_station_id", f"""
WITH h AS ({A.duck(A.HEADER_SQL)}), o AS ({A.duck(A.OBS_SQL, modulus=13, skip=0)})
SELECT o.report_id, o.observation_value, h.primary_station_id
FROM o LEFT JOIN h ON o.report_id = h.report_id""")
def q_carry_station_id(spark: SparkSession, sf: str) -> DataFrame:
    """Station id carried from the header to an observation table."""
    obs = A.view(spark, sf, A.OBS_SQL, modulus=13, skip=0)
    out = CDM.carry_station_id(obs, _header(spark, sf))
    return out.select("report_id", "observation_value", "primary_station_id")


# --- J6 ------------------------------------------------------------------------
@register("update_from_metadata", f"""
WITH h AS ({A.duck(A.HEADER_SQL)}), m AS ({A.duck(A.STATION_META_SQL)}),
h2 AS (SELECT *, CAST(NULL AS VARCHAR) AS station_name, CAST(NULL AS VARCHAR) AS platform_sub_type FROM h)
SELECT h2.report_id, coalesce(m.station_name, h2.station_name) AS station_name,
       coalesce(m.platform_sub_type, h2.platform_sub_type) AS platform_sub_type,
       CASE WHEN m.primary_station_id IS NOT NULL THEN coalesce(h2.history, '') || ';metadata merged'
            ELSE h2.history END AS history
FROM h2 LEFT JOIN m ON h2.primary_station_id = m.primary_station_id""")
def q_update_from_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Non-null metadata values overwrite header fields by station id."""
    h = _header(spark, sf).withColumns({"station_name": F.lit(None).cast("string"),
                                        "platform_sub_type": F.lit(None).cast("string")})
    m = A.view(spark, sf, A.STATION_META_SQL)
    out = CDM.update_from(h, m, "primary_station_id", ["station_name", "platform_sub_type"],
                          history_msg="metadata merged")
    return out.select("report_id", "station_name", "platform_sub_type", "history")


@register("unmatched_ids", f"""
WITH h AS ({A.duck(A.HEADER_SQL)}), m AS ({A.duck(A.STATION_META_SQL)})
SELECT primary_station_id, count(*) AS count FROM h
WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.primary_station_id = h.primary_station_id)
  AND primary_station_id IS NOT NULL
GROUP BY primary_station_id
UNION ALL
SELECT NULL, count(*) FROM h WHERE primary_station_id IS NULL HAVING count(*) > 0""")
def q_unmatched_ids(spark: SparkSession, sf: str) -> DataFrame:
    """J6 audit: station ids absent from the metadata with their counts."""
    return CDM.unmatched_counts(_header(spark, sf), A.view(spark, sf, A.STATION_META_SQL),
                                "primary_station_id")


# --- K2 ------------------------------------------------------------------------
@register("period_leaks", f"""
WITH h AS ({A.duck(A.HEADER_SQL)}),
p AS (SELECT coalesce(strftime(date_trunc('month', TRY_CAST(report_timestamp AS TIMESTAMP)), '%Y-%m'), '2024-01')
             AS period FROM h)
SELECT period, period <> '2024-01' AS leak, count(*) AS n FROM p GROUP BY 1, 2""")
def q_period_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """K2: month of each (corrected) timestamp vs the source month 2024-01."""
    t = CDM.assign_period(_header(spark, sf), "report_timestamp", 2024, 1)
    return t.groupBy("period", "leak").agg(F.count(F.lit(1)).alias("n"))


# --- A16 -----------------------------------------------------------------------
@register("duplicate_status_counts", f"""
WITH h AS ({A.duck(A.HEADER_SQL)})
SELECT duplicate_status, count(*) AS n FROM h GROUP BY 1""")
def q_duplicate_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Value counts of the duplicate status."""
    return CDM.value_counts(_header(spark, sf), "duplicate_status")


# --- S9 ------------------------------------------------------------------------
@register("reshape_datepos", f"""
WITH p AS ({A.duck(A.DATEPOS_SQL)})
SELECT uid, 'date' AS element, new_date AS value, date_flag AS flag FROM p
UNION ALL SELECT uid, 'lat', new_lat, lat_flag FROM p
UNION ALL SELECT uid, 'lon', new_lon, lon_flag FROM p""")
def q_reshape_datepos(spark: SparkSession, sf: str) -> DataFrame:
    """7-column date/position corrections reshaped to (uid, element, value, flag)."""
    return CDM.reshape_datepos(A.view(spark, sf, A.DATEPOS_SQL))


# --- O3 / O5 -------------------------------------------------------------------
@register("concat_tables", f"""
WITH a AS ({A.duck(A.OBS_SQL, modulus=13, skip=0)}), b AS ({A.duck(A.OBS_SQL, modulus=7, skip=3)})
SELECT report_id, observation_value, CAST(NULL AS VARCHAR) AS source FROM a
UNION ALL SELECT report_id, NULL, 'b' FROM b""")
def q_concat_tables(spark: SparkSession, sf: str) -> DataFrame:
    """O3: union by name of tables with differing columns."""
    a = A.view(spark, sf, A.OBS_SQL, modulus=13, skip=0).select("report_id", "observation_value")
    b = A.view(spark, sf, A.OBS_SQL, modulus=7, skip=3).select("report_id", F.lit("b").alias("source"))
    return CDM.concat_tables([a, b])


@register("id_difference", f"""
WITH a AS ({A.duck(A.OBS_SQL, modulus=13, skip=0)}), b AS ({A.duck(A.OBS_SQL, modulus=7, skip=3)})
SELECT report_id FROM a EXCEPT SELECT report_id FROM b""")
def q_id_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Set difference of report ids (anti join)."""
    a = A.view(spark, sf, A.OBS_SQL, modulus=13, skip=0).select("report_id")
    b = A.view(spark, sf, A.OBS_SQL, modulus=7, skip=3).select("report_id")
    return a.join(b, "report_id", "left_anti").distinct()


# --- P11 -------------------------------------------------------------------------
TABLES = ["header", "observations-at", "observations-sst", "observations-slp", "observations-wbt"]


@register("select_release", f"""WITH {A.cte('reports')},
inv AS (SELECT DISTINCT CAST(sid AS VARCHAR) || '-' || CAST(dck AS VARCHAR) AS sid_dck, yr AS year FROM reports),
t AS (SELECT inv.*, unnest(['{"', '".join(TABLES)}']) AS "table" FROM inv),
cfg AS ({A.duck(A.RELEASE_CONFIG_SQL)}),
g AS (SELECT year_init AS g0, year_end AS g1, params_exclude AS gx FROM cfg WHERE sid_dck IS NULL),
p AS (SELECT sid_dck AS sd, year_init AS p0, year_end AS p1, exclude AS pex, params_exclude AS px
      FROM cfg WHERE sid_dck IS NOT NULL)
SELECT t.sid_dck, t.year, t."table",
  NOT (NOT (t.year BETWEEN greatest(coalesce(p0, g0), g0) AND least(coalesce(p1, g1), g1))
       OR coalesce(pex, false)
       OR list_contains(list_concat(coalesce(px, []), coalesce(gx, [])), t."table")) AS included
FROM t CROSS JOIN g LEFT JOIN p ON t.sid_dck = p.sd""")
def q_select_release(spark: SparkSession, sf: str) -> DataFrame:
    """Release inventory (source, year, table) marked included or
    excluded by the per-source and global periods and exclusions."""
    r = _reports(spark, sf)
    inv = r.select(F.concat_ws("-", F.col("sid").cast("string"), F.col("dck").cast("string")).alias("sid_dck"),
                   F.col("yr").alias("year")).distinct()
    inv = inv.withColumn("table", F.explode(F.array(*[F.lit(t) for t in TABLES])))
    out = SEL.select_release(inv, A.view(spark, sf, A.RELEASE_CONFIG_SQL))
    return out.select("sid_dck", "year", "table", "included")


# --- C16 ---------------------------------------------------------------------------
#: code tables of the example mapping: platform types and quality defaults
MAP_CODES = {"platform": {"5": "2", "6": "5", "7": "5", "13": "33"}}
#: value, variable number and transform of the observation tables
MAP_OBSERVED = {"at": ("at", "85", "kelvin:2"), "sst": ("sst", "95", "kelvin:2"), "dpt": ("dpt", "36", "kelvin:2"),
                "wbt": ("wbt", "41", "kelvin:2"), "wd": ("d", "106", "decimal:0"), "ws": ("w", "107", "decimal:1"),
                "slp": ("slp", "58", "pascal:0")}
MAP_RULES = [
    MAP.Rule("header", "report_id", ("uid",), "prefix:ICOADS-30-", required=True),
    MAP.Rule("header", "primary_station_id", ("id",), "trim"),
    MAP.Rule("header", "platform_type", ("pt",), "code:platform", default="0"),
    MAP.Rule("header", "latitude", ("lat",), "decimal:2"),
    MAP.Rule("header", "longitude", ("lon",), "decimal:2"),
    MAP.Rule("header", "source_id", ("sid", "dck"), "join:-"),
    MAP.Rule("header", "report_quality", (), "constant:2"),
]
for _t, (_source, _number, _transform) in MAP_OBSERVED.items():
    MAP_RULES += [
        MAP.Rule(f"observations-{_t}", "report_id", ("uid",), "prefix:ICOADS-30-", required=True),
        MAP.Rule(f"observations-{_t}", "observation_value", (_source,), _transform, required=True),
        MAP.Rule(f"observations-{_t}", "observed_variable", (), f"constant:{_number}"),
        MAP.Rule(f"observations-{_t}", "latitude", ("lat",), "decimal:2"),
        MAP.Rule(f"observations-{_t}", "longitude", ("lon",), "decimal:2"),
        MAP.Rule(f"observations-{_t}", "quality_flag", (), "constant:2"),
    ]


_MAP_WBT = "CASE WHEN at >= dpt THEN (at + dpt) / 2 END"


def _cdm_mapping_sql() -> str:
    place = "CAST(CAST(round(lat, 2) AS DECIMAL(20,2)) AS VARCHAR) AS latitude, CAST(CAST(round(lon, 2) AS DECIMAL(20,2)) AS VARCHAR) AS longitude"
    said = {"at": ("at", 85), "sst": ("sst", 95), "dpt": ("dpt", 36), "wbt": ("wbt", 41)}
    value = {t: (f"CAST(round(r.{c} + 273.15, 2) AS DECIMAL(20,2))", n) for t, (c, n) in said.items()}
    value |= {"wd": ("CAST(round(d, 0) AS DECIMAL(20,0))", 106), "ws": ("CAST(round(w, 1) AS DECIMAL(20,1))", 107),
              "slp": ("CAST(round(slp * 100.0, 0) AS DECIMAL(20,0))", 58)}
    header = f"""SELECT 'header' AS cdm_table, 'ICOADS-30-' || uid AS report_id, nullif(trim(id), '') AS primary_station_id,
  CASE pt WHEN 5 THEN '2' WHEN 6 THEN '5' WHEN 7 THEN '5' WHEN 13 THEN '33' ELSE '0' END AS platform_type, {place},
  CAST(sid AS VARCHAR) || '-' || CAST(dck AS VARCHAR) AS source_id, '2' AS report_quality,
  CAST(NULL AS VARCHAR) AS observation_value, CAST(NULL AS VARCHAR) AS observed_variable, CAST(NULL AS VARCHAR) AS quality_flag
FROM r WHERE uid IS NOT NULL"""
    parts = [f"""SELECT 'observations-{t}', 'ICOADS-30-' || uid, NULL, NULL, {place}, NULL, NULL, CAST({e} AS VARCHAR), '{n}', '2'
FROM r WHERE uid IS NOT NULL AND {e} IS NOT NULL""" for t, (e, n) in value.items()]
    body = " UNION ALL ".join([header, *parts])
    return f"WITH {A.cte('reports')}, r AS (SELECT *, CASE WHEN p.at >= p.dpt THEN (p.at + p.dpt) / 2 END AS wbt FROM reports p) {body}"


@register("cdm_mapping", _cdm_mapping_sql())
def q_cdm_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Header and seven observation tables of all reports by a rule
    table, put under one another with the name of their table."""
    r = _reports(spark, sf).withColumn("wbt", F.expr(_MAP_WBT))
    out = None
    for name, rows in MAP.map_to_cdm(r, MAP_RULES, MAP_CODES).items():
        rows = rows.select(F.lit(name).alias("cdm_table"), "*")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
