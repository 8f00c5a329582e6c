"""Registered queries: super-observations and buddy checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from tidewater.operators import base_qc as BQ
from tidewater.operators import buddy as BU
from tidewater.operators import track as TR
from tidewater.plans import adapters as A
from tidewater.plans import sqlx as X
from tidewater.plans.catalog import _base_flags_sql, _qc_oracle_ctes, qc_frame, register
from tidewater.plans.q_track import _track_sql, voyage_input
from tidewater.params import DEFAULT_PARAMETERS

MDS = DEFAULT_PARAMETERS["mds_buddy_check"]
BAYES = DEFAULT_PARAMETERS["bayesian_buddy_check"]

SST_CANDIDATE = ["pos_is780", "pos_date", "pos_time", "pos_pos", "pos_blklst", "trk",
                 "sst_noval", "sst_freez", "sst_clim", "sst_nonorm"]


def sst_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Base-QC'd reports + track flag + SST anomaly, exploded to month runs,
    with MDS cells.  Track check input: reports passing date/time/pos/blklst."""
    q = BQ.qc_reports(A.reports(spark, sf), A.climatology(spark),
                      extra_mds={"sst_sd": "sst_sd", "bud1": "bud1", "bud2": "bud2", "bud3": "bud3"})
    # the track check needs only report fields and the four position flags,
    # so it reads the reports directly instead of the climatology-joined frame
    trk = TR.track_check(voyage_input(spark, sf).select("uid", "id", "yr", "mo", "dy", "hr", "lat", "lon", "ds",
                                                          "vs", "pt", "dck", "ts")).select("uid", "trk")
    q = q.join(trk, "uid", "left").withColumn("sst_anom", F.col("sst") - F.col("sst_norm"))
    return BU.cell_columns(BU.with_target_months(q))


def _candidate(cols):
    c = F.lit(True)
    for name in cols:
        c = c & (F.col(name) == 0)
    return c


# --- oracle fragments -------------------------------------------------------------
def _sst_oracle_ctes() -> str:
    cand = " AND ".join(f"coalesce({c} = 0, false)" for c in SST_CANDIDATE)
    return f"""{_qc_oracle_ctes()},
fl AS (SELECT uid, yr, mo, dy, lat, lon, sst, sst_norm, {_base_flags_sql()} FROM qc),
tk AS ({_track_sql()}),
c0 AS (SELECT fl.*, tk.trk, sst - sst_norm AS sst_anom, {X.mds_x('lon')} AS x, {X.mds_y('lat')} AS y,
              {X.pentad('mo', 'dy')} - 1 AS p, yr * 12 + mo - 1 AS own FROM fl LEFT JOIN tk ON fl.uid = tk.uid),
c1 AS (SELECT c0.*, ({cand}) AS cand FROM c0),
ex AS (SELECT c1.*, own + o.d AS run_ym FROM c1, (VALUES (-1), (0), (1)) AS o(d)),
so AS (SELECT run_ym, x, y, p, avg(sst_anom) AS cell_mean, count(*) AS cell_n
       FROM ex WHERE cand AND sst_anom IS NOT NULL GROUP BY 1, 2, 3, 4)"""


def _nb_sql(src: str, sizes: list[list[int]]) -> str:
    """Neighbour pairs of the occupied cells in ``src`` (SQL restatement)."""
    fx = [f"CAST(trunc({float(s[0])!r} / cos((89.5 - y) * {BU.RADCON!r})) AS INT)" for s in sizes]
    fmax = f"greatest({', '.join(fx)})" if len(fx) > 1 else fx[0]
    ym, pm = max(s[1] for s in sizes), max(s[2] for s in sizes)
    ins = ", ".join(
        f"(abs(dx) <= fx{j} AND abs(dy) <= {s[1]} AND abs(dp) <= {s[2]} AND NOT (dx = 0 AND dy = 0 AND dp = 0)) AS in{j}"
        for j, s in enumerate(sizes))
    fxs = ", ".join(f"{f} AS fx{j}" for j, f in enumerate(fx))
    return f"""n0 AS (SELECT run_ym, x, y, p, {fxs}, {fmax} AS fmax FROM {src}),
n1 AS (SELECT *, unnest(range(-fmax, fmax + 1)) AS dx FROM n0),
n2 AS (SELECT *, unnest(range(-{ym}, {ym + 1})) AS dy FROM n1),
n3 AS (SELECT *, unnest(range(-{pm}, {pm + 1})) AS dp FROM n2),
n4 AS (SELECT *, {ins} FROM n3),
nb AS (SELECT n4.*, s.cell_mean AS nb_mean, s.cell_n AS nb_n FROM n4 JOIN {src} s
       ON s.run_ym = n4.run_ym AND s.x = {X.pmod('n4.x + dx', 360)} AND s.y = {X.pmod('n4.y + dy', 180)}
          AND s.p = {X.pmod('n4.p + dp', 73)}
       WHERE {' OR '.join(f'in{j}' for j in range(len(sizes)))})"""


def _sd_sql(col: str) -> str:
    return f"(CASE WHEN c.{col} IS NULL OR c.{col} < 0.0 THEN 1.0 ELSE c.{col} END)"


def _mds_buddy_sql() -> str:
    sizes = MDS["limits"]
    aggs = ", ".join(
        f"sum(CASE WHEN in{j} THEN 1 ELSE 0 END) AS k{j}, sum(CASE WHEN in{j} THEN nb_mean END) AS s{j}, "
        f"sum(CASE WHEN in{j} THEN nb_n END) AS n{j}" for j in range(len(sizes)))

    def mult(j: int) -> str:
        m = "NULL"
        for t, v in zip(MDS["number_of_obs_thresholds"][j], MDS["multipliers"][j]):
            m = f"(CASE WHEN n{j} > {t} THEN {float(v)!r} ELSE {m} END)"
        return f"(CASE WHEN n{j} = 0 THEN 4.0 ELSE {m} END)"

    mean, sd = "0.0", "500.0"
    for j in reversed(range(len(sizes))):
        mean = f"(CASE WHEN coalesce(k{j}, 0) > 0 THEN s{j} / k{j} ELSE {mean} END)"
        sd = f"(CASE WHEN coalesce(k{j}, 0) > 0 THEN {mult(j)} * std ELSE {sd} END)"
    return f"""WITH {_sst_oracle_ctes()},
{_nb_sql('so', sizes)},
st AS (SELECT run_ym, x, y, p, {aggs} FROM nb GROUP BY 1, 2, 3, 4),
sd AS (SELECT so.run_ym, so.x, so.y, so.p, {_sd_sql('sst_sd')} AS std
       FROM so LEFT JOIN clim c ON c.t = so.p AND c.y = so.y AND c.x = so.x),
lim AS (SELECT sd.run_ym, sd.x, sd.y, sd.p, {mean} AS bm, {sd} AS bsd
        FROM sd LEFT JOIN st ON st.run_ym = sd.run_ym AND st.x = sd.x AND st.y = sd.y AND st.p = sd.p)"""


@register("super_obs", f"""WITH {_sst_oracle_ctes()}
SELECT run_ym, x, y, p, round(cell_mean, 6) AS cell_mean, cell_n FROM so""")
def q_super_obs(spark: SparkSession, sf: str) -> DataFrame:
    """A1 + S6: SST super-observations (mean anomaly, count) per month run
    and 1-degree pentad cell, over the buddy-check candidates."""
    d = sst_frame(spark, sf)
    so = BU.super_obs(d.where(_candidate(SST_CANDIDATE)), "sst_anom")
    return so.select("run_ym", "x", "y", "p", F.round("cell_mean", 6).alias("cell_mean"), "cell_n")


@register("neighbour_counts", f"""WITH {_sst_oracle_ctes()},
{_nb_sql('so', [BAYES['limits']])}
SELECT run_ym, x, y, p, count(*) AS n_neighbours, sum(nb_n) AS n_obs FROM nb GROUP BY 1, 2, 3, 4""")
def q_neighbour_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbouring occupied cells (and their obs) within +-2 x / +-2 y
    / +-4 pentads of each super-ob, x span widened by 1/cos(lat)."""
    d = sst_frame(spark, sf)
    so = BU.super_obs(d.where(_candidate(SST_CANDIDATE)), "sst_anom")
    found = BU.box_sums(so, [BAYES["limits"]], {"k": F.lit(1), "n": F.col("cell_n")}).where("k_0 > 0")
    return found.select("run_ym", "x", "y", "p", F.col("k_0").alias("n_neighbours"), F.col("n_0").alias("n_obs"))


@register("buddy_limits_sst", _mds_buddy_sql() + """
SELECT run_ym, x, y, p, round(bm, 6) AS buddy_mean, round(bsd, 6) AS buddy_sd FROM lim""")
def q_buddy_limits_sst(spark: SparkSession, sf: str) -> DataFrame:
    """A2: MDS buddy mean and limit per SST super-ob cell."""
    d = sst_frame(spark, sf)
    so = BU.super_obs(d.where(_candidate(SST_CANDIDATE)), "sst_anom", ["sst_sd"])
    lim = BU.buddy_limits(so, None, "sst_sd", MDS)
    return lim.select("run_ym", "x", "y", "p", F.round("buddy_mean", 6).alias("buddy_mean"),
                      F.round("buddy_sd", 6).alias("buddy_sd"))


@register("buddy_check_sst", _mds_buddy_sql() + """
SELECT ex.uid, CASE WHEN ex.cand AND abs(ex.sst_anom - lim.bm) >= lim.bsd THEN 1 ELSE 0 END AS sst_bud
FROM ex LEFT JOIN lim ON lim.run_ym = ex.run_ym AND lim.x = ex.x AND lim.y = ex.y AND lim.p = ex.p
WHERE ex.run_ym = ex.own""")
def q_buddy_check_sst(spark: SparkSession, sf: str) -> DataFrame:
    """A3: MDS buddy check flag for SST, reported in each report's own month."""
    d = sst_frame(spark, sf)
    out = BU.mds_buddy_check(d, "sst_anom", _candidate(SST_CANDIDATE), None, "sst_sd", MDS, "sst_bud")
    return out.where(F.col("month_match") == 1).select("uid", "sst_bud")


def _erf_sql(x: str) -> str:
    z = f"abs({x})"
    t = f"(1.0 / (1.0 + 0.5 * {z}))"
    poly = repr(BU.ERFC_COEFFS[-1])
    for c in reversed(BU.ERFC_COEFFS[:-1]):
        poly = f"({c!r} + {t} * {poly})"
    erfc = f"({t} * exp(-{z} * {z} + {poly}))"
    return f"(CASE WHEN ({x}) >= 0 THEN 1.0 - {erfc} ELSE {erfc} - 1.0 END)"


def _bayes_sql() -> str:
    sm, k = BAYES["measurement_error"], BAYES["noise_scaling"]
    p0, q = BAYES["prior_probability_of_gross_error"], BAYES["quantization_interval"]
    r_hi = DEFAULT_PARAMETERS["SST"]["maximum_anomaly"]
    r_lo = -r_hi
    s2 = "(bsd * sqrt(2.0))"
    up = f"least(sst_anom + {0.5 * q!r}, {r_hi + 0.5 * q!r})"
    lo = f"greatest(sst_anom - {0.5 * q!r}, {r_lo - 0.5 * q!r})"
    norm = f"(0.5 * ({_erf_sql(f'({r_hi + 0.5 * q!r} - bm) / {s2}')} - {_erf_sql(f'({r_lo - 0.5 * q!r} - bm) / {s2}')}))"
    good = f"(0.5 * ({_erf_sql(f'({up} - bm) / {s2}')} - {_erf_sql(f'({lo} - bm) / {s2}')}) / {norm})"
    gross = f"(1.0 / (1.0 + ({r_hi!r} - ({r_lo!r})) / {q!r}))"
    pg = f"({p0!r} * {gross} / ({p0!r} * {gross} + (1 - {p0!r}) * {good}))"
    return f"""WITH {_sst_oracle_ctes()},
{_nb_sql('so', [BAYES['limits']])},
st AS (SELECT run_ym, x, y, p, count(*) AS nn, sum(nb_mean) AS ss, sum(1.0 / nb_n) AS inv FROM nb GROUP BY 1, 2, 3, 4),
sd AS (SELECT so.run_ym, so.x, so.y, so.p, {_sd_sql('bud1')} AS s1, {_sd_sql('bud2')} AS s2, {_sd_sql('bud3')} AS s3
       FROM so LEFT JOIN clim c ON c.t = so.p AND c.y = so.y AND c.x = so.x),
lim AS (SELECT sd.run_ym, sd.x, sd.y, sd.p,
          CASE WHEN coalesce(nn, 0) > 0 THEN ss / nn ELSE 0.0 END AS bm,
          CASE WHEN coalesce(nn, 0) > 0 THEN sqrt({sm ** 2!r} + s1 * s1 + {k!r} * s2 * s2
               + ({sm ** 2!r} + {k!r} * s2 * s2) * inv / (nn * nn) + s3 * s3 / nn) ELSE 500.0 END AS bsd
        FROM sd LEFT JOIN st ON st.run_ym = sd.run_ym AND st.x = sd.x AND st.y = sd.y AND st.p = sd.p),
j AS (SELECT ex.uid, ex.cand, ex.sst_anom, lim.bm, lim.bsd FROM ex LEFT JOIN lim
      ON lim.run_ym = ex.run_ym AND lim.x = ex.x AND lim.y = ex.y AND lim.p = ex.p WHERE ex.run_ym = ex.own),
pg AS (SELECT uid, cand, CASE WHEN cand THEN {pg} END AS pg FROM j)
SELECT uid, CAST(CASE WHEN cand AND pg > 0 THEN least(floor(pg * 10), 9) ELSE 0 END AS INT) AS sst_bbud FROM pg"""


@register("bayesian_buddy_sst", _bayes_sql())
def q_bayesian_buddy_sst(spark: SparkSession, sf: str) -> DataFrame:
    """A4 + A5: Bayesian buddy check flag (0..9) for SST."""
    d = sst_frame(spark, sf)
    out = BU.bayesian_buddy_check(d, "sst", "sst_anom", _candidate(SST_CANDIDATE), None,
                                  ("bud1", "bud2", "bud3"))
    return out.where(F.col("month_match") == 1).select("uid", "sst_bbud")



