"""Registered queries: QC flags into CDM quality fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import cdm as CDM
from tidewater.plans import adapters as A
from tidewater.plans.catalog import register

COVER = {"SST": 11, "AT": 12, "SLP": 17, "DPT": 19, "POS": 23, "W": 29}
PARAMS = list(CDM.QC_COLUMNS)


def _qc_sql(p: str) -> str:
    return A.qc_file_sql(p, CDM.QC_COLUMNS[p], COVER[p])


def _frames(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {p: A.view(spark, sf, _qc_sql(p)) for p in PARAMS}


def _param_sql(p: str) -> str:
    cols = CDM.QC_COLUMNS[p]
    bad = "'2'" if p == "POS" else "'1'"
    present = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    total = " + ".join(cols)
    g = f"CASE WHEN {present} THEN (CASE WHEN {total} = 0 THEN '0' ELSE {bad} END) END"
    if p != "POS":
        g = f"CASE WHEN coalesce(noval = 1, false) THEN NULL ELSE {g} END"
    return f"SELECT uid, {g} AS flag FROM ({A.duck(_qc_sql(p))})"


def _merged_sql() -> str:
    parts = ",\n".join(f"q_{p} AS ({_param_sql(p)})" for p in PARAMS)
    uids = " UNION ".join(f"SELECT uid FROM q_{p}" for p in PARAMS)
    sel = ", ".join(f'q_{p}.flag AS "{p}"' for p in PARAMS)
    joins = " ".join(f"LEFT JOIN q_{p} ON q_{p}.uid = u.uid" for p in PARAMS)
    meas = [p for p in PARAMS if p != "POS"]
    applied = " + ".join(f'CASE WHEN "{p}" IS NOT NULL THEN 1 ELSE 0 END' for p in meas)
    total = " + ".join(f'coalesce(CAST("{p}" AS INT), 0)' for p in meas)
    return f"""{parts},
u AS ({uids}),
w AS (SELECT 'ICOADS-30-' || u.uid AS report_id, {sel} FROM u {joins}),
rq AS (SELECT *, CASE WHEN coalesce(POS = '2', false) THEN '1'
                      WHEN ({total}) < ({applied}) THEN '0'
                      WHEN ({total}) >= ({applied}) AND ({applied}) > 0 THEN '1' ELSE '2' END AS report_quality
       FROM w)"""


@register("read_qc_flags", f"""SELECT count(*) AS n, sum(bud) AS bud, sum(noval) AS noval,
  count(bud) AS bud_present FROM ({A.duck(_qc_sql('SST'))})""")
def q_read_qc_flags(spark: SparkSession, sf: str) -> DataFrame:
    """A parameter's QC flag file with only the used columns."""
    f = _frames(spark, sf)["SST"].select("uid", *CDM.QC_COLUMNS["SST"])
    return f.agg(F.count(F.lit(1)).alias("n"), F.sum("bud").alias("bud"), F.sum("noval").alias("noval"),
                 F.count("bud").alias("bud_present"))


@register("merge_qc_flags", f"WITH {_merged_sql()}\nSELECT * FROM rq")
def q_merge_qc_flags(spark: SparkSession, sf: str) -> DataFrame:
    """J8 + A18: one flag per parameter ('0' pass, '1'/'2' fail, NULL
    missing) and the report quality, per report present in any QC file."""
    return CDM.merge_qc_flags(_frames(spark, sf))


@register("apply_qc_to_header", f"""WITH {_merged_sql()}, h AS ({A.duck(A.HEADER_SQL)})
SELECT h.report_id, coalesce(rq.POS, '3') AS location_quality, coalesce(rq.report_quality, '2') AS report_quality,
       '2' AS report_time_quality
FROM h LEFT JOIN rq ON h.report_id = rq.report_id""")
def q_apply_qc_to_header(spark: SparkSession, sf: str) -> DataFrame:
    """J8 targets: header location/report/time quality from the merged flags
    (not assessed -> 3 / 2 / 2)."""
    flags = CDM.merge_qc_flags(_frames(spark, sf))
    h = CDM.apply_qc_to_header(A.view(spark, sf, A.HEADER_SQL), flags)
    return h.select("report_id", "location_quality", "report_quality", "report_time_quality")


@register("apply_qc_to_observations", f"""WITH {_merged_sql()}, o AS ({A.duck(A.OBS_SQL, modulus=13, skip=0)})
SELECT o.report_id, coalesce(rq.SST, '2') AS quality_flag FROM o LEFT JOIN rq ON o.report_id = rq.report_id""")
def q_apply_qc_to_observations(spark: SparkSession, sf: str) -> DataFrame:
    """J8 targets: observations-sst quality_flag from the SST flag (missing -> 2)."""
    flags = CDM.merge_qc_flags(_frames(spark, sf))
    o = CDM.apply_qc_to_observations(A.view(spark, sf, A.OBS_SQL, modulus=13, skip=0), flags, "SST")
    return o.select("report_id", "quality_flag")


_TRK = ["drf_agr", "drf_spd", "drf_tail1", "drf_tail2", "drf_bias", "drf_noise", "drf_short"]


@register("merge_tracking_flags", f"""WITH h AS ({A.duck(A.HEADER_SQL)}), t0 AS ({A.duck(A.TRACKING_SQL)}),
t AS (SELECT 'ICOADS-30-' || uid AS rid, {' + '.join(f'CASE WHEN {c} = 9 THEN 0 ELSE {c} END' for c in _TRK)} AS trk
      FROM t0)
SELECT h.report_id,
  CASE WHEN t.trk IS NULL THEN '3' WHEN t.trk = 0 THEN '0' ELSE '1' END AS location_quality,
  CASE WHEN t.trk > 0 THEN '1' ELSE h.report_quality END AS report_quality
FROM h LEFT JOIN t ON h.report_id = t.rid""")
def q_merge_tracking_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Drifter tracking flags summed into header location/report quality
    (flag 9 = never set counts as untested)."""
    out = CDM.merge_tracking_flags(A.view(spark, sf, A.HEADER_SQL), A.view(spark, sf, A.TRACKING_SQL))
    return out.select("report_id", "location_quality", "report_quality")
