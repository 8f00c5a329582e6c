"""Registered queries: one Spark job and (where SQL can say it) one DuckDB
oracle per operator of the survey inventory.

Every Spark job reads the driver tables through :mod:`adapters` and runs the
library's operator over the whole input; every oracle is an independent SQL
statement of the same semantics over the same adapter views.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import base_qc as BQ
from tidewater.plans import adapters as A
from tidewater.plans import sqlx as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tune_session(spark: SparkSession) -> None:
    """Runtime SQL settings the library's plans rely on.

    Constraint propagation re-derives predicates through every projection of
    the long window/expression pipelines here and dominated planning time
    (seconds per query); the filters it would infer are written explicitly.
    """
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    # static size estimates of compressed files understate in-memory size:
    # broadcast only by explicit, size-checked hints or by AQE from the
    # measured shuffle size of a stage
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    from tidewater.session import ship_package

    ship_package(spark)


def register(name: str, oracle: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune_session(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared oracle fragments
# ---------------------------------------------------------------------------
def _qc_oracle_ctes() -> str:
    """CTE chain ending in ``qc`` = reports + normals + humidity + elev."""
    pent = f"(CASE WHEN {X.valid_day('2004', 'mo', 'dy')} AND lat IS NOT NULL AND lon IS NOT NULL THEN {X.pentad('mo', 'dy')} - 1 END)"
    crh0 = X.rh("dpt", '"at"', "slp_norm")
    sun, sun_last = X.sun_elevation_ctes("r3", "yr", "mo", "dy", "hr", "lat", "lon", 1.0)
    return f"""
{A.cte('reports')},
{A.cte('clim')},
r0 AS (SELECT * REPLACE (CASE WHEN dck = 701 AND yr < 1860 AND hr IS NULL THEN 0.0 ELSE hr END AS hr),
              "at" AS at2 FROM reports),
r1 AS (SELECT *, {pent} AS kt, {X.mds_y('lat')} AS my, {X.mds_x('lon')} AS mx,
              {X.reg_y('lat')} AS ry, {X.reg_x('lon')} AS rx FROM r0),
r2 AS (SELECT r1.*, c1.sst AS sst_norm, c1."at" AS at_norm, c2.dpt AS dpt_norm, c2.dpt_sd AS dpt_sd,
              c2."at" AS at2_norm, c2.at_sd AS at2_sd, c2.slp AS slp_norm, c2.slp_sd AS slp_sd
       FROM r1 LEFT JOIN clim c1 ON c1.t = r1.kt AND c1.y = r1.my AND c1.x = r1.mx
               LEFT JOIN clim c2 ON c2.t = r1.kt AND c2.y = r1.ry AND c2.x = r1.rx),
r2h AS (SELECT *, {crh0} AS crh0 FROM r2),
r3 AS (SELECT *, (slp_norm IS NOT NULL AND crh0 IS NOT NULL AND crh0 BETWEEN 0.0 AND 150.0) AS hum_ok FROM r2h),
{sun},
qc AS (SELECT *, CASE WHEN hum_ok THEN {X.sh('dpt', '"at"', 'slp_norm')} END AS shu,
              CASE WHEN hum_ok THEN crh0 END AS crh FROM {sun_last})"""


def _blk_sql() -> str:
    lo = X.lon180("lon")
    years = []
    for year, regs in BQ.DECK732_YEARS.items():
        boxes = " OR ".join(
            f"({lo} BETWEEN {BQ.DECK732_REGIONS[r][0]} AND {BQ.DECK732_REGIONS[r][2]} AND "
            f"lat BETWEEN {BQ.DECK732_REGIONS[r][1]} AND {BQ.DECK732_REGIONS[r][3]})" for r in regs)
        years.append(f"(yr = {year} AND ({boxes}))")
    ids = ", ".join(f"'{i}'" for i in BQ.BLOCKED_IDS_2005)
    return X.f(
        f"(lat = 0.0 AND {lo} = 0.0) OR coalesce(pt = 13, false) OR coalesce(id = 'SUPERIGORINA', false) "
        f"OR (dck = 732 AND ({' OR '.join(years)})) OR dck = 874 "
        f"OR (((yr = 2005 AND mo IN (11, 12)) OR (yr = 2006 AND mo = 1)) AND coalesce(id IN ({ids}), false))")


def _base_flags_sql() -> str:
    pos = X.f("lat IS NULL OR lon IS NULL OR lat < -90 OR lat > 90 OR lon < -180 OR lon > 360")
    date = X.f(f"yr IS NULL OR mo IS NULL OR yr > 2024 OR yr < 1850 OR mo < 1 OR mo > 12 OR dy IS NULL "
               f"OR dy < 1 OR {X.ml('yr', 'mo')} IS NULL OR dy > {X.ml('yr', 'mo')}")
    time = X.f("hr IS NULL OR hr >= 24 OR hr < 0")
    mat = X.f("coalesce(pt = 5 AND dck = 780, false)")
    sd = lambda c: f"least(greatest({c}, 1.0), 4.0)"
    return f"""
  {X.f('pt IN (6, 7)')} AS pos_isbuoy,
  {X.f('pt = 7')} AS pos_isdrifter,
  {X.f('pt IN (0,1,2,3,4,5,10,11,12,17)')} AS pos_isship,
  {X.f('dck = 780')} AS pos_is780,
  {pos} AS pos_pos, {date} AS pos_date, {time} AS pos_time,
  {_blk_sql()} AS pos_blklst,
  CASE WHEN {pos} = 0 AND {date} = 0 AND {time} = 0 THEN {X.f('elev > 0')} ELSE 1 END AS pos_day,
  {X.f('pt IS NULL OR NOT pt IN (0,1,2,3,4,5,6,8,9,10,15)')} AS dpt_hum_blacklist,
  {mat} AS at_mat_blacklist,
  {X.f('dck IN (708, 780)')} AS w_wind_blacklist,
  {X.f('sst IS NULL')} AS sst_noval,
  {X.f('sst IS NOT NULL AND sst < -1.8')} AS sst_freez,
  {X.f('sst IS NULL OR sst_norm IS NULL OR abs(sst - sst_norm) > 8.0')} AS sst_clim,
  {X.f('sst_norm IS NULL')} AS sst_nonorm,
  {X.hard('sst', -5.0, 45.0)} AS sst_hardlimit,
  {X.f('"at" IS NULL')} AS at_noval,
  {X.f('"at" IS NULL OR at_norm IS NULL OR abs("at" - at_norm) > 10.0')} AS at_clim,
  {X.f('at_norm IS NULL')} AS at_nonorm,
  {X.hard('"at"', -80.0, 65.0)} AS at_hardlimit,
  {X.f(f'dpt IS NULL OR dpt_norm IS NULL OR dpt_sd IS NULL OR abs(dpt - dpt_norm) / {sd("dpt_sd")} > 5.5')} AS dpt_clim,
  {X.f('dpt IS NULL')} AS dpt_noval,
  {X.f('dpt_norm IS NULL')} AS dpt_nonorm,
  {X.f('dpt IS NULL OR at2 IS NULL OR dpt > at2')} AS dpt_ssat,
  {X.f('slp IS NULL')} AS slp_noval,
  {X.f('slp IS NULL OR slp_norm IS NULL OR slp_sd IS NULL OR (abs(slp - slp_norm) / slp_sd > 3.0 AND abs(slp - slp_norm) > 10.0)')} AS slp_clim,
  {X.f('slp_norm IS NULL')} AS slp_nonorm,
  {X.f('w IS NULL')} AS w_noval,
  {X.hard('w', 0.0, 50.0)} AS w_hardlimit,
  {X.f('w IS NULL OR d IS NULL OR (d = 361 AND w <> 0) OR (d = 362 AND w > 4.0)')} AS w_consistency,
  {X.f(f"{X.hard('"at"', -80.0, 65.0)} = 1 OR {X.hard('dpt', -80.0, 65.0)} = 1 OR {X.hard('shu', 0.0, 500.0)} = 1 OR {X.hard('crh', 0.0, 150.0)} = 1")} AS dpt_hardlimit,
  {X.f(f'at2 IS NULL OR at2_norm IS NULL OR at2_sd IS NULL OR abs(at2 - at2_norm) / {sd("at2_sd")} > 5.5')} AS at2_clim,
  {X.f('at2 IS NULL')} AS at2_noval,
  {X.f('at2_norm IS NULL')} AS at2_nonorm,
  {X.hard('"at"', -80.0, 65.0)} AS at2_hardlimit"""


def qc_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BQ.qc_reports(A.reports(spark, sf_dir), A.climatology(spark))


# ---------------------------------------------------------------------------
# Base QC per report
# ---------------------------------------------------------------------------
def _stepwise(ctes: str) -> str:
    """The same statement with its long steps evaluated once each: the humidity
    and sun chains are not expanded again by whatever reads the result."""
    for step in ("r2", "r2h", "r3", "qc"):
        ctes = ctes.replace(f"\n{step} AS (SELECT", f"\n{step} AS MATERIALIZED (SELECT")
    return ctes


@register("base_qc", f"WITH {_stepwise(_qc_oracle_ctes())},\nflags AS MATERIALIZED (SELECT uid, {_base_flags_sql()} FROM qc)\n"
                     "SELECT * FROM flags")
def q_base_qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-report base QC flags (36 columns) after the climatology joins."""
    return qc_frame(spark, sf_dir).select("uid", *BQ.BASE_FLAGS)


_COUNT_UNPIVOT = " UNION ALL ".join(
    f"SELECT '{f}' AS flag, {f} AS value FROM flags" for f in BQ.BASE_FLAGS)


@register("qc_flag_counts",
          f"WITH {_qc_oracle_ctes()},\nflags AS (SELECT {_base_flags_sql()} FROM qc),\n"
          f"long AS ({_COUNT_UNPIVOT})\n"
          f"SELECT flag, value, count(*) AS n FROM long GROUP BY flag, value")
def q_qc_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 quicklook: number of reports per (flag, value) of the base QC."""
    return BQ.flag_counts(qc_frame(spark, sf_dir))

