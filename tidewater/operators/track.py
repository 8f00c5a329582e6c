"""Per-platform voyage operators (W1-W6, W9, A6-A8, C8, C9 time, W20).

A voyage is the time-ordered reports of one platform ID.  It is never
materialised: every quantity is a window expression over
``partitionBy(id).orderBy(ts, hr, uid)`` so the whole stage costs ONE
shuffle on ``id``.  All windows share that partitioning (Spark reuses the
exchange); windows partitioned by ``(id, x)`` are satisfied by it as well.

Skew: generic call signs (blank, SHIP, ...) form one pseudo-platform that can
hold a third of all reports.  The track check exempts them, so they are
split off *before* the window and get constant flags.  Checks that do apply
to them (saturated runs, repeated/rounded values) are written as
aggregations or chunked prefix counts, never as one window over the platform.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import geo
from tidewater.functions.checks import flag
from tidewater.functions.grid import lon180
from tidewater.operators.base_qc import is_generic_id
from tidewater.params import KM_TO_NM
from tidewater.params import parameters as default_parameters
from tidewater.session import stage_table

ORDER = ("ts", "hr", "uid")


def voyage_window(id_col: str = "id") -> Window:
    return Window.partitionBy(id_col).orderBy(*ORDER)


def _whole(id_col: str = "id") -> Window:
    return Window.partitionBy(id_col)


# --- C8: ship motion ----------------------------------------------------------
def decode_ship_motion(df: DataFrame) -> DataFrame:
    """dsi: DS 0..8 -> 0,45,..,360 (9 -> NULL); vsi: 5*VS-2 from 1968, else
    3*VS-1; VS 0 -> 0."""
    ds, vs, yr = F.col("ds"), F.col("vs"), F.col("yr")
    dsi = F.when(ds.between(0, 8), ds * 45.0)
    vsi = (F.when(vs.isNull(), F.lit(None).cast("double"))
           .when(vs == 0, F.lit(0.0))
           .when(yr >= 1968, vs * 5.0 - 2.0)
           .otherwise(vs * 3.0 - 1.0))
    return df.withColumns({"dsi": dsi, "vsi": vsi})


# --- C9: time in hours ----------------------------------------------------------
def julian_day(yr, mo, dy) -> Column:
    yr, mo, dy = (F.col(c) if isinstance(c, str) else c for c in (yr, mo, dy))
    a = F.floor((14 - mo) / 12)
    y = yr + 4800 - a
    m = mo + 12 * a - 3
    return (dy + F.floor((153 * m + 2) / 5) + 365 * y + F.floor(y / 4) - F.floor(y / 100)
            + F.floor(y / 400) - 32045)


def with_day_hours(df: DataFrame, out: str = "_jdh") -> DataFrame:
    """Fractional Julian day ``jd + hr/24``; time differences in hours are
    ``24 * (b - a)`` as in the reference."""
    return df.withColumn(out, julian_day("yr", "mo", "dy") + F.col("hr") / 24.0)


# --- W1 / W2 ----------------------------------------------------------------------
def kinematics(df: DataFrame, id_col: str = "id") -> DataFrame:
    """speed (km/h), distance (km), course (deg), time_diff (h) from the
    previous report; a zero time difference gives speed = distance."""
    w = voyage_window(id_col)
    df = with_day_hours(df)
    plat, plon, pj = (F.lag(c).over(w) for c in ("lat", "lon", "_jdh"))
    df = df.withColumns({"_plat": plat, "_plon": plon, "_pj": pj})
    df = df.withColumns({"_lon180": lon180("lon"), "_plon180": lon180("_plon")})
    lat, lon, p_lat, p_lon = (F.col(c) for c in ("lat", "_lon180", "_plat", "_plon180"))
    dist = geo.sphere_distance(lat, lon, p_lat, p_lon)
    td = 24.0 * (F.col("_jdh") - F.col("_pj"))
    df = df.withColumns({"distance": F.when(p_lat.isNotNull(), dist), "_td": td})
    td0 = F.col("_td")
    df = df.withColumns({
        "time_diff": F.when(p_lat.isNotNull(), F.when(td0.isNull() | (td0 == 0), F.lit(0.0)).otherwise(td0)),
        "speed": F.when(p_lat.isNotNull(), F.when(td0.isNull() | (td0 == 0), F.col("distance"))
                        .otherwise(F.col("distance") / td0)),
    })
    df = geo.with_course(df, p_lat, p_lon, lat, lon, "course")
    df = df.withColumn("course", F.when(p_lat.isNotNull(), F.col("course")))
    return df.drop("_plat", "_plon", "_pj", "_td", "_lon180", "_plon180")


def alt_speed(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Speed from report i-1 to i+1 (NULL at both ends)."""
    w = voyage_window(id_col)
    df = df.withColumns({"_alat": F.lag("lat").over(w), "_alon": F.lag("lon").over(w),
                         "_aj": F.lag("_jdh").over(w),
                         "_blat": F.lead("lat").over(w), "_blon": F.lead("lon").over(w),
                         "_bj": F.lead("_jdh").over(w)})
    ok = F.col("_alat").isNotNull() & F.col("_blat").isNotNull()
    d = geo.sphere_distance(F.col("_blat"), lon180("_blon"), F.col("_alat"), lon180("_alon"))
    td = 24.0 * (F.col("_bj") - F.col("_aj"))
    df = df.withColumns({"_ad": d, "_atd": td})
    sp = F.when(F.col("_atd").isNull() | (F.col("_atd") == 0), F.col("_ad")).otherwise(F.col("_ad") / F.col("_atd"))
    return df.withColumn("alt_speed", F.when(ok, sp)).drop(
        "_alat", "_alon", "_aj", "_blat", "_blon", "_bj", "_ad", "_atd")


# --- A8: mean / modal speed and limits ------------------------------------------
def voyage_speed(df: DataFrame, params: dict, id_col: str = "id") -> DataFrame:
    """Mean speed of reports 2..n; modal speed over 3-knot bins (lowest bin
    wins ties, floor 8.5 kn), speed limit ``amax``.  Bin counts are 12
    conditional window sums, so no extra shuffle."""
    tc = params["track_check"]
    w = _whole(id_col)
    has = F.col("speed").isNotNull()
    b = F.least(F.greatest(F.floor(KM_TO_NM * F.col("speed") / 3.0), F.lit(0)), F.lit(11))
    df = df.withColumn("_bin", F.when(has, b))
    counts = [F.sum(flag(F.col("_bin") == k)).over(w) for k in range(12)]
    df = df.withColumns({f"_c{k}": c for k, c in enumerate(counts)})
    best = F.greatest(*[F.struct(F.col(f"_c{k}").alias("n"), F.lit(-k).alias("nb")) for k in range(12)])
    df = df.withColumns({"mean_speed": F.avg("speed").over(w), "_nsp": F.count("speed").over(w),
                         "_best": best})
    atmode = (-F.col("_best.nb")) * 3.0 + 1.5
    amode = F.when(F.col("_nsp") > 0, F.greatest(atmode, F.lit(tc["min_speed"])) / KM_TO_NM)
    df = df.withColumn("modal_speed", amode)
    amax = (F.when(F.col("modal_speed").isNull() | (F.col("modal_speed") <= 8.51 / KM_TO_NM),
                   F.lit(tc["amax"] / KM_TO_NM))
            .otherwise(F.col("modal_speed") * tc["max_multiplier"]))
    return df.withColumn("amax", amax).drop("_bin", "_nsp", "_best", *[f"_c{k}" for k in range(12)])


# --- W3 / W4 -------------------------------------------------------------------------
def _increment(lat, lon, speed_kmh, course, td):
    dist = speed_kmh * td / 2.0
    dlat, dlon = geo.destination(lat, lon, course, dist)
    return dlat - lat, dlon - lon


def dead_reckoning(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Forward and reverse dead-reckoning discrepancies (km).  Each leg
    is half the interval at each end's own reported speed and course; the
    reverse leg runs the courses backwards from the next report."""
    w = voyage_window(id_col)
    df = df.withColumns({
        "_plat": F.lag("lat").over(w), "_plon": F.lag("lon").over(w),
        "_pvsi": F.lag("vsi").over(w), "_pdsi": F.lag("dsi").over(w),
    })
    lat, lon, vsi, dsi, td = (F.col(c) for c in ("lat", "lon", "vsi", "dsi", "time_diff"))
    plat, plon, pvsi, pdsi = (F.col(c) for c in ("_plat", "_plon", "_pvsi", "_pdsi"))
    ok = vsi.isNotNull() & pvsi.isNotNull() & dsi.isNotNull() & pdsi.isNotNull() & td.isNotNull()
    a1, o1 = _increment(plat, plon, pvsi / KM_TO_NM, pdsi, td)
    a2, o2 = _increment(lat, lon, vsi / KM_TO_NM, dsi, td)
    df = df.withColumns({"_fx": plat + a1 + a2, "_fy": plon + o1 + o2})
    fwd = geo.sphere_distance(lat, lon, F.col("_fx"), F.col("_fy"))
    b1, p1 = _increment(lat, lon, vsi / KM_TO_NM, dsi - 180.0, td)
    b2, p2 = _increment(plat, plon, pvsi / KM_TO_NM, pdsi - 180.0, td)
    df = df.withColumns({"_rx": lat + b1 + b2, "_ry": lon + p1 + p2})
    rev_at_i = geo.sphere_distance(plat, plon, F.col("_rx"), F.col("_ry"))
    df = df.withColumns({"fwd_diff": F.when(ok, fwd), "_rev_i": F.when(ok, rev_at_i)})
    # the reverse list is indexed one step back: row i carries the value of i+1
    df = df.withColumn("rev_diff", F.lead("_rev_i").over(w))
    return df.drop("_plat", "_plon", "_pvsi", "_pdsi", "_fx", "_fy", "_rx", "_ry", "_rev_i")


def midpoint_error(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Distance of report i from the great-circle point between i-1 and
    i+1 at the time fraction t0/(t0+t1) (0 when undefined)."""
    w = voyage_window(id_col)
    df = df.withColumns({"_alat": F.lag("lat").over(w), "_alon": F.lag("lon").over(w),
                         "_blat": F.lead("lat").over(w), "_blon": F.lead("lon").over(w),
                         "_t1": F.lead("time_diff").over(w)})
    t0, t1 = F.col("time_diff"), F.col("_t1")
    frac = F.when(t0.isNotNull() & t1.isNotNull() & ((t0 + t1) != 0), t0 / (t0 + t1)).otherwise(F.lit(0.0))
    df = df.withColumn("_frac", frac)
    df = geo.with_intermediate_point(df, "_alat", "_alon", "_blat", "_blon", "_frac", "_elat", "_elon")
    ok = F.col("_alat").isNotNull() & F.col("_blat").isNotNull()
    d = geo.sphere_distance(F.col("lat"), F.col("lon"), F.col("_elat"), F.col("_elon"))
    return df.withColumn("midpoint_diff", F.when(ok, d)).drop(
        "_alat", "_alon", "_blat", "_blon", "_t1", "_frac", "_elat", "_elon")


# --- W5 ------------------------------------------------------------------------------
def _track_rules(df: DataFrame, params: dict, id_col: str) -> DataFrame:
    tc = params["track_check"]
    w = voyage_window(id_col)
    df = df.withColumns({"_nsp": F.lead("speed").over(w), "_nalt": F.lead("alt_speed").over(w),
                         "_palt": F.lag("alt_speed").over(w), "_pvsi2": F.lag("vsi").over(w),
                         "_pdsi2": F.lag("dsi").over(w), "_rn": F.row_number().over(w),
                         "_n": F.count(F.lit(1)).over(_whole(id_col))})
    amax = F.col("amax")
    sp, nsp, palt, nalt = F.col("speed"), F.col("_nsp"), F.col("_palt"), F.col("_nalt")
    score_a = F.when((sp > amax) & (palt > amax), F.lit(1.0)) \
        .when((nsp > amax) & (nalt > amax), F.lit(2.0)) \
        .when((sp > amax) & (nsp > amax), F.lit(3.0)).otherwise(F.lit(0.0))
    vsi, pvsi, td = F.col("vsi"), F.col("_pvsi2"), F.col("time_diff")
    alw = td * ((vsi + pvsi) / 2.0) / KM_TO_NM
    b_dist = F.when(vsi.isNotNull() & pvsi.isNotNull() & td.isNotNull() & F.col("fwd_diff").isNotNull()
                    & F.col("rev_diff").isNotNull() & (vsi > 0) & (pvsi > 0) & (td > 0)
                    & (F.col("fwd_diff") > alw) & (F.col("rev_diff") > alw), F.lit(10.0)).otherwise(F.lit(0.0))
    mdc = tc["max_direction_change"]
    crs, dsi, pdsi = F.col("course"), F.col("dsi"), F.col("_pdsi2")

    def _off(a):
        d = F.abs(a - crs)
        return (d > mdc) & (d < 360 - mdc)

    b_dir = F.when(dsi.isNotNull() & pdsi.isNotNull() & crs.isNotNull() & (_off(dsi) | _off(pdsi)),
                   F.lit(10.0)).otherwise(F.lit(0.0))
    msc = tc["max_speed_change"] / KM_TO_NM
    b_spd = F.when(vsi.isNotNull() & pvsi.isNotNull() & sp.isNotNull()
                   & (F.abs(vsi / KM_TO_NM - sp) > msc) & (F.abs(pvsi / KM_TO_NM - sp) > msc),
                   F.lit(10.0)).otherwise(F.lit(0.0))
    b_abs = F.when(sp > tc["max_absolute_speed"] / KM_TO_NM, F.lit(10.0)).otherwise(F.lit(0.0))
    score_b = b_dist + b_dir + b_spd + b_abs
    inner = (F.col("_rn") > 1) & (F.col("_rn") < F.col("_n"))
    trk = inner & (F.col("midpoint_diff") > tc["max_midpoint_discrepancy"] / KM_TO_NM) & (score_a > 0) & (score_b > 0)
    return df.withColumn("trk", flag(trk)).drop("_nsp", "_nalt", "_palt", "_pvsi2", "_pdsi2", "_rn")


def voyage_features(df: DataFrame, params: dict, id_col: str = "id") -> DataFrame:
    """W1-W4 + A8 on one platform partitioning."""
    out = kinematics(decode_ship_motion(df), id_col)
    out = alt_speed(out, id_col)
    out = voyage_speed(out, params, id_col)
    out = dead_reckoning(out, id_col)
    return midpoint_error(out, id_col)


def track_check(df: DataFrame, params: dict | None = None, id_col: str = "id",
                generic: Column | None = None) -> DataFrame:
    """Per-report ``trk`` (1 = bad track) and ``few`` (1 = fewer than 3
    reports).  Generic IDs and buoys (PT 6/7) are exempt (trk 0, few 0) and
    never enter the window (``generic`` says which IDs are when ``id_col`` is
    no call sign); a platform of < 3 reports gets few 1 except
    deck 720 before 1891."""
    p = default_parameters(params)
    exempt = (is_generic_id(id_col, "yr") if generic is None else generic) | F.coalesce(F.col("pt").isin(6, 7), F.lit(False))
    tagged = df.withColumn("_ex", exempt)
    ex = tagged.where(F.col("_ex")).withColumns({"trk": F.lit(0), "few": F.lit(0)})
    run = tagged.where(~F.col("_ex"))
    feats = voyage_features(run, p, id_col)
    w = _whole(id_col)
    feats = feats.withColumns({"_n": F.count(F.lit(1)).over(w),
                               "_d0": F.first("dck").over(voyage_window(id_col).rowsBetween(
                                   Window.unboundedPreceding, Window.unboundedFollowing)),
                               "_y0": F.first("yr").over(voyage_window(id_col).rowsBetween(
                                   Window.unboundedPreceding, Window.unboundedFollowing))})
    checked = _track_rules(feats, p, id_col)
    few_exempt = (F.col("_d0") == 720) & (F.col("_y0") < 1891)
    checked = checked.withColumns({
        "trk": F.when(F.col("_n") < 3, F.lit(0)).otherwise(F.col("trk")),
        "few": F.when((F.col("_n") < 3) & ~few_exempt, F.lit(1)).otherwise(F.lit(0)),
    })
    cols = df.columns + ["trk", "few"]
    return checked.select(*cols).unionByName(ex.select(*cols))


def track_check_iterative(df: DataFrame, params: dict | None = None, id_col: str = "id",
                          passes: int = 4) -> DataFrame:
    """Run W5, drop flagged reports, rerun on the rest; a report flagged
    in any pass keeps its flag.  At most ``passes`` reruns.

    A platform without a newly flagged report would get the same flags again,
    so a pass reads only the platforms that the pass before changed; it stops
    when there are none.  Each pass is stored (narrow rows of those platforms)
    and the next one reads it."""
    narrow = df.select("uid", F.col(id_col), *[c for c in _TRACK_INPUT if c != id_col])
    state = stage_table(track_check(narrow, params, id_col), "track-0")
    out = [state.select("uid", "trk", "few")]
    for k in range(1, passes + 1):
        changed = state.where("trk = 1").select(id_col).distinct()
        if changed.isEmpty():
            break
        again = state.where("trk = 0").join(changed, id_col, "left_semi").drop("trk", "few")
        state = stage_table(track_check(again, params, id_col), f"track-{k}")
        out.append(state.where("trk = 1").select("uid", "trk", F.lit(None).cast("int").alias("few")))
    flags = out[0]
    for later in out[1:]:
        flags = flags.unionByName(later)
    flags = flags.groupBy("uid").agg(F.max("trk").alias("trk"), F.max("few").alias("few"))
    return df.join(flags, "uid", "left")


#: Report columns that the track check reads.
_TRACK_INPUT = ["id", "yr", "mo", "dy", "hr", "lat", "lon", "ds", "vs", "pt", "dck", "ts"]


def _join_null_safe(left: DataFrame, right: DataFrame, key: str, other: str) -> DataFrame:
    """Left join on (key, other) where missing keys are one platform."""
    r = right.withColumnRenamed(key, "_jk").withColumnRenamed(other, "_jo")
    return left.join(r, F.col(key).eqNullSafe(F.col("_jk")) & (F.col(other) == F.col("_jo")), "left").drop("_jk", "_jo")


# --- W9: saturated runs --------------------------------------------------------------
def saturated_runs(df: DataFrame, params: dict | None = None, id_col: str = "id",
                   chunk_hours: int = 24) -> DataFrame:
    """``repsat`` = 1 for reports in a run of more than ``shortest_run``
    consecutive saturated reports (DPT == AT) spanning >= ``min_time`` hours.

    Distributed gaps-and-islands: run id = number of unsaturated reports up
    to this one.  That running count is computed per (platform, time chunk)
    window plus a prefix over chunk totals (a small table), so no task ever
    holds a whole platform; runs are then aggregated by (platform, run)."""
    p = default_parameters(params)["saturated_runs"]
    sat = (F.col("dpt") == F.col("at")) & F.col("at").isNotNull() & F.col("dpt").isNotNull()
    d = with_day_hours(df.withColumn("_sat", F.coalesce(sat, F.lit(False))))
    d = d.withColumn("_chunk", F.floor(F.col("_jdh") * 24.0 / chunk_hours).cast("long"))
    d = d.withColumn("_unsat", (~F.col("_sat")).cast("int"))
    wc = Window.partitionBy(id_col, "_chunk").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_local", F.sum("_unsat").over(wc))
    totals = d.groupBy(id_col, "_chunk").agg(F.sum("_unsat").alias("_ct"))
    wt = Window.partitionBy(id_col).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_off", F.coalesce(F.sum("_ct").over(wt), F.lit(0))).drop("_ct")
    d = _join_null_safe(d, totals, id_col, "_chunk")
    d = d.withColumn("_run", F.col("_off") + F.col("_local"))
    runs = d.where(F.col("_sat")).groupBy(id_col, "_run").agg(
        F.count(F.lit(1)).alias("_len"), F.min("_jdh").alias("_t0"), F.max("_jdh").alias("_t1"))
    bad = runs.where((F.col("_len") > p["shortest_run"]) &
                     (24.0 * (F.col("_t1") - F.col("_t0")) >= p["min_time_threshold"]))
    out = _join_null_safe(d, bad.select(id_col, "_run", F.lit(1).alias("_bad")), id_col, "_run")
    out = out.withColumn("repsat", F.when(F.col("_sat") & (F.col("_bad") == 1), F.lit(1)).otherwise(F.lit(0)))
    return out.drop("_sat", "_jdh", "_chunk", "_unsat", "_local", "_off", "_run", "_bad")


# --- A6 / A7: repeated and whole-number values ----------------------------------------
def repeated_values(df: DataFrame, var: str, params: dict | None = None, id_col: str = "id",
                    out: str | None = None) -> DataFrame:
    """``<var>_rep`` = 1 where a value makes up more than ``threshold`` of a
    platform's non-missing values and the platform has more than
    ``min_count`` of them.  Two partial aggregates + joins: skew-safe."""
    p = default_parameters(params)["find_repeated_values"]
    out = out or f"{var}_rep"
    v = F.col(var)
    per_id = df.where(v.isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("_all"))
    per_val = df.where(v.isNotNull()).groupBy(id_col, var).agg(F.count(F.lit(1)).alias("_nv"))
    per_id = per_id.withColumnRenamed(id_col, "_pid")
    hits = per_val.join(per_id, F.col(id_col).eqNullSafe(F.col("_pid"))).where(
        (F.col("_all") > p["min_count"]) & (F.col("_nv") / F.col("_all") > p["threshold"])
    ).select(id_col, F.col(var).alias("_hv"), F.lit(1).alias("_hit"))
    j = df.join(hits, (df[id_col].eqNullSafe(hits[id_col])) & (df[var] == hits["_hv"]), "left")
    j = j.drop(hits[id_col])
    return j.withColumn(out, F.coalesce(F.col("_hit"), F.lit(0))).drop("_hv", "_hit")


def rounded_values(df: DataFrame, var: str = "dpt", params: dict | None = None, id_col: str = "id",
                   out: str | None = None) -> DataFrame:
    """``<var>_round`` = 1 on whole-number values of a platform whose share
    of whole numbers is >= ``threshold`` with more than ``min_count`` values."""
    p = default_parameters(params)["multiple_rounded_values"]
    out = out or f"{var}_round"
    v = F.col(var)
    whole = v == F.floor(v)
    stats = df.where(v.isNotNull()).groupBy(id_col).agg(
        F.count(F.lit(1)).alias("_all"), F.sum(flag(whole)).alias("_whole"))
    bad = stats.where((F.col("_all") > p["min_count"]) & (F.col("_whole") / F.col("_all") >= p["threshold"])) \
        .select(F.col(id_col).alias("_bid"), F.lit(1).alias("_b"))
    j = df.join(bad, df[id_col].eqNullSafe(F.col("_bid")), "left")
    return j.withColumn(out, F.when((F.col("_b") == 1) & F.coalesce(whole, F.lit(False)), F.lit(1))
                        .otherwise(F.lit(0))).drop("_bid", "_b")


# --- W20: position prediction ------------------------------------------------------
def predict_position(df: DataFrame, hours: float, id_col: str = "id") -> DataFrame:
    """Predicted position ``hours`` after each report from its reported
    speed and course (knots, degrees)."""
    dist = F.col("vsi") / KM_TO_NM * hours
    lat, lon = geo.destination(F.col("lat"), lon180("lon"), F.col("dsi"), dist)
    return df.withColumns({"pred_lat": lat, "pred_lon": lon})

