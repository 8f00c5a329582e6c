"""Registered queries: per-platform voyage checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import checks as K
from tidewater.operators import base_qc as BQ
from tidewater.operators import track as TR
from tidewater.plans import adapters as A
from tidewater.plans import sqlx as X
from tidewater.plans.catalog import _blk_sql, register
from tidewater.params import KM_TO_NM

KN = KM_TO_NM


def voyage_input(spark: SparkSession, sf: str) -> DataFrame:
    """Reports passing the date/time/position/blocklist checks, with ``ts``
    (the platform checks use only those four flags)."""
    r = BQ.prepare_reports(A.reports(spark, sf))
    r = BQ.blocklist(r)
    ok = ((K.position_check("lat", "lon") == 0) & (K.date_check("yr", "mo", "dy") == 0)
          & (K.time_check("hr") == 0) & (F.col("pos_blklst") == 0))
    return r.where(ok).drop("pos_blklst")


def _r6(c: str):
    return F.round(F.col(c), 6).alias(c)


# --- oracle fragments ------------------------------------------------------------
_GEN = "', '".join(BQ.GENERIC_IDS)


def _generic_sql(i: str = "id", y: str = "yr") -> str:
    years = " OR ".join(f"({y} BETWEEN {a} AND {b} AND {i} IN ('" + "', '".join(ids) + "'))"
                        for a, b, ids in BQ.GENERIC_IDS_BY_YEARS)
    return f"({i} IS NULL OR {i} IN ('{_GEN}') OR {years})"


def _valid_ctes() -> str:
    pos = "NOT (lat IS NULL OR lon IS NULL OR lat < -90 OR lat > 90 OR lon < -180 OR lon > 360)"
    date = (f"NOT (yr IS NULL OR mo IS NULL OR yr > 2024 OR yr < 1850 OR mo < 1 OR mo > 12 OR dy IS NULL "
            f"OR dy < 1 OR {X.ml('yr', 'mo')} IS NULL OR dy > {X.ml('yr', 'mo')})")
    time = "NOT (hr IS NULL OR hr >= 24 OR hr < 0)"
    return f"""{A.cte('reports')},
r0 AS (SELECT * REPLACE (CASE WHEN dck = 701 AND yr < 1860 AND hr IS NULL THEN 0.0 ELSE hr END AS hr) FROM reports),
v AS (SELECT *, make_timestamp(yr, mo, dy, CAST(floor(hr) AS BIGINT), CAST(floor((hr - floor(hr)) * 60) AS BIGINT), 0.0) AS ts,
             {X.jul_day('yr', 'mo', 'dy')} + hr / 24.0 AS jdh,
             CASE WHEN ds BETWEEN 0 AND 8 THEN ds * 45.0 END AS dsi,
             CASE WHEN vs IS NULL THEN NULL WHEN vs = 0 THEN 0.0 WHEN yr >= 1968 THEN vs * 5.0 - 2.0
                  ELSE vs * 3.0 - 1.0 END AS vsi
      FROM r0 WHERE {pos} AND {date} AND {time} AND {_blk_sql()} = 0)"""


def _voyage_ctes() -> str:
    L = X.lon180
    d_prev = X.dist("lat", L("lon"), "plat", L("plon"))
    d_alt = X.dist("nlat", L("nlon"), "plat", L("plon"))
    crs = X.course("plat", L("plon"), "lat", L("lon"))
    # dead reckoning
    f1a, f1o = X.dest("plat", "plon", "pdsi", f"pvsi / {KN!r} * time_diff / 2.0")
    f2a, f2o = X.dest("lat", "lon", "dsi", f"vsi / {KN!r} * time_diff / 2.0")
    r1a, r1o = X.dest("lat", "lon", "dsi - 180.0", f"vsi / {KN!r} * time_diff / 2.0")
    r2a, r2o = X.dest("plat", "plon", "pdsi - 180.0", f"pvsi / {KN!r} * time_diff / 2.0")
    ea, eo = X.interm("plat", "plon", "nlat", "nlon", "frac")
    ok = "vsi IS NOT NULL AND pvsi IS NOT NULL AND dsi IS NOT NULL AND pdsi IS NOT NULL AND time_diff IS NOT NULL"
    return f"""{_valid_ctes()},
g AS (SELECT * FROM v WHERE NOT ({_generic_sql()} OR coalesce(pt IN (6, 7), false))),
w1 AS (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lag(jdh) OVER w AS pj,
              lead(lat) OVER w AS nlat, lead(lon) OVER w AS nlon, lead(jdh) OVER w AS nj,
              lag(vsi) OVER w AS pvsi, lag(dsi) OVER w AS pdsi, row_number() OVER w AS rn,
              count(*) OVER (PARTITION BY id) AS n, first_value(dck) OVER w AS d0, first_value(yr) OVER w AS y0
       FROM g WINDOW w AS (PARTITION BY id ORDER BY ts, hr, uid)),
w2 AS (SELECT *, CASE WHEN plat IS NOT NULL THEN {d_prev} END AS distance, 24.0 * (jdh - pj) AS td0,
              CASE WHEN plat IS NOT NULL AND nlat IS NOT NULL THEN {d_alt} END AS ad, 24.0 * (nj - pj) AS atd
       FROM w1),
w3 AS (SELECT *,
         CASE WHEN plat IS NOT NULL THEN (CASE WHEN td0 IS NULL OR td0 = 0 THEN 0.0 ELSE td0 END) END AS time_diff,
         CASE WHEN plat IS NOT NULL THEN (CASE WHEN td0 IS NULL OR td0 = 0 THEN distance ELSE distance / td0 END) END AS speed,
         CASE WHEN plat IS NOT NULL THEN {crs} END AS course,
         CASE WHEN plat IS NOT NULL AND nlat IS NOT NULL THEN (CASE WHEN atd IS NULL OR atd = 0 THEN ad ELSE ad / atd END) END
           AS alt_speed
       FROM w2),
bins AS (SELECT id, least(greatest(floor({KN!r} * speed / 3.0), 0), 11) AS bin, count(*) AS c
         FROM w3 WHERE speed IS NOT NULL GROUP BY 1, 2),
md AS (SELECT id, bin FROM (SELECT id, bin, row_number() OVER (PARTITION BY id ORDER BY c DESC, bin ASC) AS r
                            FROM bins) WHERE r = 1),
ms AS (SELECT id, avg(speed) AS mean_speed FROM w3 GROUP BY id),
w4 AS (SELECT w3.*, ms.mean_speed, greatest(md.bin * 3.0 + 1.5, 8.5) / {KN!r} AS modal_speed
       FROM w3 LEFT JOIN md ON w3.id = md.id LEFT JOIN ms ON w3.id = ms.id),
w5 AS (SELECT *, CASE WHEN modal_speed IS NULL OR modal_speed <= 8.51 / {KN!r} THEN 15.0 / {KN!r}
                      ELSE modal_speed * 1.25 END AS amax,
              CASE WHEN {ok} THEN {X.dist('lat', 'lon', f'plat + ({f1a} - plat) + ({f2a} - lat)', f'plon + ({f1o} - plon) + ({f2o} - lon)')} END AS fwd_diff,
              CASE WHEN {ok} THEN {X.dist('plat', 'plon', f'lat + ({r1a} - lat) + ({r2a} - plat)', f'lon + ({r1o} - lon) + ({r2o} - plon)')} END AS rev_i
       FROM w4),
w6 AS (SELECT *, lead(rev_i) OVER w AS rev_diff, lead(time_diff) OVER w AS t1,
              lead(speed) OVER w AS nsp, lead(alt_speed) OVER w AS nalt, lag(alt_speed) OVER w AS palt
       FROM w5 WINDOW w AS (PARTITION BY id ORDER BY ts, hr, uid)),
w7 AS (SELECT *, CASE WHEN time_diff IS NOT NULL AND t1 IS NOT NULL AND time_diff + t1 <> 0
                      THEN time_diff / (time_diff + t1) ELSE 0.0 END AS frac FROM w6),
w8 AS (SELECT *, CASE WHEN plat IS NOT NULL AND nlat IS NOT NULL THEN {X.dist('lat', 'lon', ea, eo)} END AS midpoint_diff
       FROM w7)"""


def _track_sql() -> str:
    alw = f"time_diff * ((vsi + pvsi) / 2.0) / {KN!r}"
    a = ("(CASE WHEN speed > amax AND palt > amax THEN 1.0 WHEN nsp > amax AND nalt > amax THEN 2.0 "
         "WHEN speed > amax AND nsp > amax THEN 3.0 ELSE 0.0 END)")
    b_dist = (f"(CASE WHEN vsi IS NOT NULL AND pvsi IS NOT NULL AND time_diff IS NOT NULL AND fwd_diff IS NOT NULL "
              f"AND rev_diff IS NOT NULL AND vsi > 0 AND pvsi > 0 AND time_diff > 0 AND fwd_diff > {alw} "
              f"AND rev_diff > {alw} THEN 10.0 ELSE 0.0 END)")
    off = lambda x: f"(abs({x} - course) > 60.0 AND abs({x} - course) < 300.0)"
    b_dir = (f"(CASE WHEN dsi IS NOT NULL AND pdsi IS NOT NULL AND course IS NOT NULL AND ({off('dsi')} OR {off('pdsi')}) "
             f"THEN 10.0 ELSE 0.0 END)")
    msc = f"(10.0 / {KN!r})"
    b_spd = (f"(CASE WHEN vsi IS NOT NULL AND pvsi IS NOT NULL AND speed IS NOT NULL AND abs(vsi / {KN!r} - speed) > {msc} "
             f"AND abs(pvsi / {KN!r} - speed) > {msc} THEN 10.0 ELSE 0.0 END)")
    b_abs = f"(CASE WHEN speed > 40.0 / {KN!r} THEN 10.0 ELSE 0.0 END)"
    trk = (f"(CASE WHEN rn > 1 AND rn < n AND midpoint_diff > 150.0 / {KN!r} AND {a} > 0 "
           f"AND ({b_dist} + {b_dir} + {b_spd} + {b_abs}) > 0 THEN 1 ELSE 0 END)")
    return f"""WITH {_voyage_ctes()},
t AS (SELECT uid, CASE WHEN n < 3 THEN 0 ELSE {trk} END AS trk,
             CASE WHEN n < 3 AND NOT (d0 = 720 AND y0 < 1891) THEN 1 ELSE 0 END AS few FROM w8)
SELECT uid, trk, few FROM t
UNION ALL
SELECT uid, 0 AS trk, 0 AS few FROM v WHERE {_generic_sql()} OR coalesce(pt IN (6, 7), false)"""


@register("voyage_kinematics", f"""WITH {_voyage_ctes()}
SELECT uid, round(speed, 6) AS speed, round(distance, 6) AS distance, round(course, 6) AS course,
       round(time_diff, 6) AS time_diff, round(alt_speed, 6) AS alt_speed, round(mean_speed, 6) AS mean_speed,
       round(modal_speed, 6) AS modal_speed, round(CASE WHEN modal_speed IS NULL OR modal_speed <= 8.51 / {KN!r}
       THEN 15.0 / {KN!r} ELSE modal_speed * 1.25 END, 6) AS amax
FROM w4""")
def q_voyage_kinematics(spark: SparkSession, sf: str) -> DataFrame:
    """W1 + W2 + A8 + C8: speed/distance/course/time step, alternate speed,
    mean and modal speed and the speed limit, per non-exempt platform."""
    v = voyage_input(spark, sf)
    run = v.where(~(BQ.is_generic_id("id", "yr") | F.coalesce(F.col("pt").isin(6, 7), F.lit(False))))
    p = TR.default_parameters(None)
    out = TR.voyage_speed(TR.alt_speed(TR.kinematics(TR.decode_ship_motion(run))), p)
    return out.select("uid", *[_r6(c) for c in ("speed", "distance", "course", "time_diff", "alt_speed",
                                                   "mean_speed", "modal_speed", "amax")])


@register("dead_reckoning", f"""WITH {_voyage_ctes()}
SELECT uid, round(fwd_diff, 6) AS fwd_diff, round(rev_diff, 6) AS rev_diff,
       round(midpoint_diff, 6) AS midpoint_diff FROM w8""")
def q_dead_reckoning(spark: SparkSession, sf: str) -> DataFrame:
    """W3 + W4: forward/reverse dead-reckoning and midpoint discrepancies (km)."""
    v = voyage_input(spark, sf)
    run = v.where(~(BQ.is_generic_id("id", "yr") | F.coalesce(F.col("pt").isin(6, 7), F.lit(False))))
    out = TR.voyage_features(run, TR.default_parameters(None))
    return out.select("uid", _r6("fwd_diff"), _r6("rev_diff"), _r6("midpoint_diff"))


@register("track_check", _track_sql())
def q_track_check(spark: SparkSession, sf: str) -> DataFrame:
    """MDS track check flags (trk, few) for every valid report."""
    return TR.track_check(voyage_input(spark, sf)).select("uid", "trk", "few")


def _track_passes_sql(passes: int = 5) -> str:
    """The five passes of W6 one after the other, each over all reports left."""
    chain = _voyage_ctes()[len(_valid_ctes()) + 2:]
    head, verdict = _track_sql().split("t AS (SELECT uid, ", 1)
    verdict = verdict.split(" FROM w8)", 1)[0]
    out = [_valid_ctes(), "v1 AS MATERIALIZED (SELECT * FROM v)"]
    for k in range(1, passes + 1):
        out.append(f"t{k} AS MATERIALIZED (WITH {chain.replace('FROM v WHERE', f'FROM v{k} WHERE')}\nSELECT uid, {verdict} FROM w8)")
        out.append(f"v{k + 1} AS MATERIALIZED (SELECT * FROM v{k} WHERE uid NOT IN (SELECT uid FROM t{k} WHERE trk = 1))")
    hit = " UNION ALL ".join(f"SELECT uid FROM t{k} WHERE trk = 1" for k in range(1, passes + 1))
    return "WITH " + ",\n".join(out) + f""",
hit AS ({hit})
SELECT v.uid, CASE WHEN v.uid IN (SELECT uid FROM hit) THEN 1 ELSE 0 END AS trk, coalesce(t1.few, 0) AS few
FROM v LEFT JOIN t1 ON t1.uid = v.uid"""


@register("track_check_iterative", _track_passes_sql())
def q_track_check_iterative(spark: SparkSession, sf: str) -> DataFrame:
    """Track check re-run up to 4 times without the flagged reports."""
    return TR.track_check_iterative(voyage_input(spark, sf)).select("uid", "trk", "few")


@register("saturated_runs", f"""WITH {_valid_ctes()},
s AS (SELECT *, coalesce(dpt = "at" AND "at" IS NOT NULL AND dpt IS NOT NULL, false) AS sat FROM v),
c AS (SELECT *, sum(CASE WHEN sat THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY ts, hr, uid
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM s),
rr AS (SELECT id, run, count(*) AS len, min(jdh) AS t0, max(jdh) AS t1 FROM c WHERE sat GROUP BY id, run),
bad AS (SELECT id, run FROM rr WHERE len > 4 AND 24.0 * (t1 - t0) >= 48.0)
SELECT c.uid, CASE WHEN c.sat AND bad.run IS NOT NULL THEN 1 ELSE 0 END AS repsat
FROM c LEFT JOIN bad ON c.id IS NOT DISTINCT FROM bad.id AND c.run = bad.run""")
def q_saturated_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of > 4 saturated reports (DPT = AT) lasting >= 48 h."""
    return TR.saturated_runs(voyage_input(spark, sf)).select("uid", "repsat")


def _rep_sql(var: str) -> str:
    q = f'"{var}"'
    return f"""WITH {_valid_ctes()},
a AS (SELECT id, count(*) AS n_all FROM v WHERE {q} IS NOT NULL GROUP BY id),
b AS (SELECT id, {q} AS val, count(*) AS nv FROM v WHERE {q} IS NOT NULL GROUP BY id, {q}),
h AS (SELECT b.id, b.val FROM b JOIN a ON a.id IS NOT DISTINCT FROM b.id WHERE n_all > 20 AND nv / n_all > 0.7)
SELECT v.uid, CASE WHEN h.val IS NOT NULL THEN 1 ELSE 0 END AS {var}_rep
FROM v LEFT JOIN h ON v.id IS NOT DISTINCT FROM h.id AND v.{q} = h.val"""


@register("repeated_values", _rep_sql("sst"))
def q_repeated_values(spark: SparkSession, sf: str) -> DataFrame:
    """SST values repeated in > 70 % of a platform's (> 20) reports."""
    return TR.repeated_values(voyage_input(spark, sf), "sst").select("uid", "sst_rep")


@register("rounded_values", f"""WITH {_valid_ctes()},
s AS (SELECT id, count(*) AS n_all, sum(CASE WHEN dpt = floor(dpt) THEN 1 ELSE 0 END) AS n_whole
      FROM v WHERE dpt IS NOT NULL GROUP BY id),
b AS (SELECT id FROM s WHERE n_all > 20 AND n_whole / n_all >= 0.5)
SELECT v.uid, CASE WHEN b.id IS NOT NULL AND v.dpt = floor(v.dpt) THEN 1 ELSE 0 END AS dpt_round
FROM v LEFT JOIN (SELECT id, true AS hit FROM b) b ON v.id IS NOT DISTINCT FROM b.id""")
def q_rounded_values(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-number DPT values on platforms where >= 50 % are whole."""
    return TR.rounded_values(voyage_input(spark, sf), "dpt").select("uid", "dpt_round")


@register("predict_position", f"""WITH {_valid_ctes()},
p AS (SELECT uid, {X.dest('lat', X.lon180('lon'), 'dsi', f'vsi / {KN!r} * 6.0')[0]} AS pred_lat,
             {X.dest('lat', X.lon180('lon'), 'dsi', f'vsi / {KN!r} * 6.0')[1]} AS pred_lon FROM v)
SELECT uid, round(pred_lat, 6) AS pred_lat, round(pred_lon, 6) AS pred_lon FROM p""")
def q_predict_position(spark: SparkSession, sf: str) -> DataFrame:
    """Position predicted 6 h ahead from reported speed and course."""
    out = TR.predict_position(TR.decode_ship_motion(voyage_input(spark, sf)), 6.0)
    return out.select("uid", _r6("pred_lat"), _r6("pred_lon"))


# --- W7 / W8: neighbour-greedy checks (no SQL oracle: order-dependent greedy;
# tests/test_greedy.py checks them against a direct per-platform re-statement)
@register("iquam_track")
def q_iquam_track(spark: SparkSession, sf: str) -> DataFrame:
    """iQuam track check flag per valid report."""
    from tidewater.operators.greedy import iquam_track_check
    return iquam_track_check(voyage_input(spark, sf)).select("uid", "iquam_track")


@register("spike_check")
def q_spike_check(spark: SparkSession, sf: str) -> DataFrame:
    """SST spike check flag per valid report (generic IDs included)."""
    from tidewater.operators.greedy import spike_check
    return spike_check(voyage_input(spark, sf), "sst").select("uid", "sst_spike")
