"""Per-report base QC (C1-C4, P8-P10, P14, C5 day flag, C6 humidity).

``base_qc`` is ONE projection adding ~36 flag columns named ``<type>_<flag>``
(0 pass, 1 fail); no shuffle, no UDF.  ``attach_normals`` performs the two
climatology joins (MDS-style cells for SST/AT, regular cells for the rest).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import checks as K
from tidewater.functions.calendar import report_timestamp
from tidewater.functions.grid import lon180
from tidewater.functions.humidity import humidity_columns
from tidewater.functions.solar import with_day_flag
from tidewater.operators.grid_lookup import grid_lookup
from tidewater.params import LEGACY_PRESET
from tidewater.params import parameters as default_parameters

# FIXED VALUES: deck-732 blocklist boxes [lon_w, lat_s, lon_e, lat_n] and the
# regions listed per year; IDs blocked in 2005-11..2006-01; generic IDs.
DECK732_REGIONS = {
    1: [-175, 40, -170, 55], 2: [-165, 40, -160, 60], 3: [-145, 40, -140, 50],
    4: [-140, 30, -135, 40], 5: [-140, 50, -130, 55], 6: [-70, 35, -60, 40],
    7: [-50, 45, -40, 50], 8: [5, 70, 10, 80], 9: [0, -10, 10, 0],
    10: [-30, -25, -25, -20], 11: [-60, -50, -55, -45], 12: [75, -20, 80, -15],
    13: [50, -30, 60, -20], 14: [30, -40, 40, -30], 15: [20, 60, 25, 65],
    16: [0, -40, 10, -30], 17: [-135, 30, -130, 40],
}
DECK732_YEARS = {
    1958: [1, 2, 3, 4, 5, 6, 14, 15], 1959: [1, 2, 3, 4, 5, 6, 14, 15],
    1960: [1, 2, 3, 5, 6, 9, 14, 15], 1961: [1, 2, 3, 5, 6, 14, 15, 16],
    1962: [1, 2, 3, 5, 12, 13, 14, 15, 16], 1963: [1, 2, 3, 5, 6, 12, 13, 14, 15, 16],
    1964: [1, 2, 3, 5, 6, 12, 13, 14, 16], 1965: [1, 2, 6, 10, 12, 13, 14, 15, 16],
    1966: [1, 2, 6, 9, 14, 15, 16], 1967: [1, 2, 5, 6, 9, 14, 15],
    1968: [1, 2, 3, 5, 6, 9, 14, 15], 1969: [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 13, 14, 15, 16],
    1970: [1, 2, 3, 4, 5, 6, 8, 9, 14, 15], 1971: [1, 2, 3, 4, 5, 6, 7, 8, 9, 13, 14, 16],
    1972: [4, 7, 8, 9, 10, 11, 13, 16, 17], 1973: [4, 7, 8, 10, 11, 13, 16, 17],
    1974: [4, 7, 8, 10, 11, 16, 17],
}
BLOCKED_IDS_2005 = [
    "53521    ", "53522    ", "53566    ", "53567    ", "53568    ", "53571    ",
    "53578    ", "53580    ", "53582    ", "53591    ", "53592    ", "53593    ",
    "53594    ", "53595    ", "53596    ", "53599    ", "53600    ", "53601    ",
    "53602    ", "53603    ", "53604    ", "53605    ", "53606    ", "53607    ",
    "53608    ", "53609    ", "53901    ", "53902    ",
]
GENERIC_IDS = [
    "", " ", "1        ", "58       ", "RIGG     ", "     RIGG", "SHIP     ", "ship     ",
    "     SHIP", "PLAT     ", "     PLAT", "         ", "0120     ", "0204     ", "0205     ",
    "0206     ", "0207     ", "0208     ", "0209     ", "MASKST   ", "MASKSTID ", "MASK     ",
    "XXXX     ", "/////    ",
]
GENERIC_IDS_BY_YEARS = [
    (1921, 1941, ["2        ", "00002    "]),
    (1930, 1937, ["3        "]),
    (1934, 1954, ["7        ", "00007    "]),
]
# FIXED VALUES: boxes (west, east, south, north) without night air temperature
# in deck 193; platform types of ships and with usable humidity
MAT_BOXES_193 = [(-80.0, 0.0, 40.0, 55.0), (-10.0, 30.0, 35.0, 45.0), (15.0, 45.0, -10.0, 40.0),
                 (15.0, 95.0, -10.0, 15.0), (95.0, 105.0, -10.0, 5.0)]
SHIP_PT = [0, 1, 2, 3, 4, 5, 10, 11, 12, 17]
HUMIDITY_OK_PT = [0, 1, 2, 3, 4, 5, 6, 8, 9, 10, 15]


def _any(conds) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def is_generic_id(id_col="id", yr_col="yr") -> Column:
    """NULL/blank or listed generic call signs (some only in year ranges)."""
    i, y = F.col(id_col), F.col(yr_col)
    by_year = _any((y.between(a, b) & i.isin(ids)) for a, b, ids in GENERIC_IDS_BY_YEARS)
    return i.isNull() | i.isin(GENERIC_IDS) | by_year


def blocklist(df: DataFrame, id="id", dck="dck", yr="yr", mo="mo", lat="lat", lon="lon",
              pt="pt", out="pos_blklst") -> DataFrame:
    """(0,0) positions, C-MAN (PT 13), one named id, deck 732 boxes by
    year, all of deck 874, and 28 ids in 2005-11..2006-01."""
    d, y, m = F.col(dck), F.col(yr), F.col(mo)
    # longitude normalised once (a column, so it is not re-inlined 17 times)
    df = df.withColumn("_blk_lon", lon180(lon))
    la, lo = F.col(lat), F.col("_blk_lon")
    # regions containing the point, then overlap with the year's region list
    inside = F.array_compact(F.array(*[
        F.when(lo.between(b[0], b[2]) & la.between(b[1], b[3]), F.lit(r))
        for r, b in DECK732_REGIONS.items()]))
    year_regions = F.create_map(*[x for yy, regs in DECK732_YEARS.items()
                                  for x in (F.lit(yy), F.array(*[F.lit(r) for r in regs]))])
    listed = F.try_element_at(year_regions, y)
    boxes = F.coalesce(F.arrays_overlap(inside, listed), F.lit(False))
    period = ((y == 2005) & m.isin(11, 12)) | ((y == 2006) & (m == 1))
    bad = (
        ((la == 0.0) & (lo == 0.0)) | (F.col(pt) == 13) | (F.col(id) == "SUPERIGORINA")
        | ((d == 732) & boxes) | (d == 874) | (period & F.col(id).isin(BLOCKED_IDS_2005))
    )
    return df.withColumn(out, K.flag(bad)).drop("_blk_lon")


def platform_class(df: DataFrame, pt="pt", dck="dck") -> DataFrame:
    """Isbuoy (PT 6,7), isdrifter (PT 7), isship, is780."""
    p = F.col(pt)
    return df.withColumns({
        "pos_isbuoy": K.flag(p.isin(6, 7)),
        "pos_isdrifter": K.flag(p == 7),
        "pos_isship": K.flag(p.isin(SHIP_PT)),
        "pos_is780": K.flag(F.col(dck) == 780),
    })


def source_blocklists(df: DataFrame, deck193_end_year: int = 1892) -> DataFrame:
    """P10: MAT, humidity and wind eligibility lists."""
    p, d, y = F.col("pt"), F.col("dck"), F.col("yr")
    la, lo = F.col("lat"), lon180("lon")
    boxes = _any(lo.between(w, e) & la.between(s, n) for w, e, s, n in MAT_BOXES_193)
    mat = ((p == 5) & (d == 780)) | ((d == 193) & y.between(1880, deck193_end_year) & boxes)
    return df.withColumns({
        "at_mat_blacklist": K.flag(mat),
        "dpt_hum_blacklist": K.flag(~p.isin(HUMIDITY_OK_PT) | p.isNull()),
        "w_wind_blacklist": K.flag(d.isin(708, 780)),
    })


def prepare_reports(df: DataFrame) -> DataFrame:
    """P14 + derived time: deck 701 before 1860 with no hour gets hour 0;
    ``at2`` copies AT; ``ts`` is the report timestamp (NULL if invalid)."""
    hr = F.when((F.col("dck") == 701) & (F.col("yr") < 1860) & F.col("hr").isNull(), F.lit(0.0)) \
        .otherwise(F.col("hr"))
    out = df.withColumn("hr", hr).withColumn("at2", F.col("at"))
    return out.withColumn("ts", report_timestamp("yr", "mo", "dy", "hr"))


def attach_normals(df: DataFrame, clim: DataFrame, n: int = 73, res: float = 1.0,
                   extra_mds: dict[str, str] | None = None) -> DataFrame:
    """Climatological normals ``<var>_norm`` (st. dev. ``<var>_sd``): SST, AT by MDS cells; DPT, AT2, SLP (+ st.
    dev.), SLP2, SHU, CRH, CWB, DPD by regular cells."""
    out = grid_lookup(df, clim, {"sst": "sst_norm", "at": "at_norm", **(extra_mds or {})}, n=n, res=res,
                      style="mds")
    return grid_lookup(out, clim, {
        "dpt": "dpt_norm", "dpt_sd": "dpt_sd", "at": "at2_norm", "at_sd": "at2_sd",
        "slp": "slp_norm", "slp_sd": "slp_sd", "slp2": "slp2_norm", "shu": "shu_norm",
        "crh": "crh_norm", "cwb": "cwb_norm", "dpd": "dpd_norm",
    }, n=n, res=res, style="regular")


BASE_FLAGS = [
    "pos_isbuoy", "pos_isdrifter", "pos_isship", "pos_is780", "pos_pos", "pos_date",
    "pos_time", "pos_blklst", "pos_day", "dpt_hum_blacklist", "at_mat_blacklist",
    "w_wind_blacklist", "sst_noval", "sst_freez", "sst_clim", "sst_nonorm", "sst_hardlimit",
    "at_noval", "at_clim", "at_nonorm", "at_hardlimit", "dpt_clim", "dpt_noval",
    "dpt_nonorm", "dpt_ssat", "slp_noval", "slp_clim", "slp_nonorm", "w_noval",
    "w_hardlimit", "w_consistency", "dpt_hardlimit", "at2_clim", "at2_noval",
    "at2_nonorm", "at2_hardlimit",
]


def base_qc(df: DataFrame, params: dict | None = None, preset: str = "default", flags: list[str] | None = None) -> DataFrame:
    """All base flags in one projection.  Input needs the report columns,
    the normals of ``attach_normals`` and humidity columns (``with_humidity``).

    ``preset='legacy'`` (C4) uses the older fixed climatology limits for AT
    and SST, ends the deck-193 MAT exclusion in 1893 and gives a day flag
    without a valid hour.  With ``flags`` only these are computed and only what
    they read has to be there.
    """
    legacy = preset == "legacy"
    p = default_parameters((params or {}) | {k: LEGACY_PRESET[k] for k in ("SST", "AT")} if legacy else params)
    sst_p, at_p, dpt_p, slp_p, w_p = p["SST"], p["AT"], p["DPT"], p["SLP"], p["W"]
    deck193_end = LEGACY_PRESET["mat_blacklist_deck193_end_year"] if legacy else 1892
    out = platform_class(df)
    out = blocklist(out)
    out = source_blocklists(out, deck193_end)
    pos = K.position_check("lat", "lon")
    date = K.date_check("yr", "mo", "dy")
    time = K.time_check("hr")
    if flags is None or "pos_day" in flags:
        out = with_day_flag(out, p["base"]["time_since_sun_above_horizon"], 0.0, "_day")
    day = F.when((pos == 0) & (date == 0) & (F.lit(legacy) | (time == 0)), F.col("_day")).otherwise(F.lit(1))
    dpt_hard = K.flag(
        (K.hard_limit("at", at_p["hard_limits"]) == 1)
        | (K.hard_limit("dpt", dpt_p["hard_limits"]) == 1)
        | (K.hard_limit("shu", p["SHU"]["hard_limits"]) == 1)
        | (K.hard_limit("crh", p["RH"]["hard_limits"]) == 1)
    )
    cols = {
        "pos_pos": pos,
        "pos_date": date,
        "pos_time": time,
        "pos_day": day,
        "sst_noval": K.value_check("sst"),
        "sst_freez": K.sst_freeze_check("sst", 0.0, sst_p["freezing_point"], sst_p["freeze_check_n_sigma"]),
        "sst_clim": K.climatology_check("sst", "sst_norm", sst_p["maximum_anomaly"]),
        "sst_nonorm": K.no_normal_check("sst_norm"),
        "sst_hardlimit": K.hard_limit("sst", sst_p["hard_limits"]),
        "at_noval": K.value_check("at"),
        "at_clim": K.climatology_check("at", "at_norm", at_p["maximum_anomaly"]),
        "at_nonorm": K.no_normal_check("at_norm"),
        "at_hardlimit": K.hard_limit("at", at_p["hard_limits"]),
        "dpt_clim": K.climatology_plus_stdev_check("dpt", "dpt_norm", "dpt_sd",
                                                   dpt_p["minmax_standard_deviation"],
                                                   dpt_p["maximum_standardised_anomaly"]),
        "dpt_noval": K.value_check("dpt"),
        "dpt_nonorm": K.no_normal_check("dpt_norm"),
        "dpt_ssat": K.supersat_check("dpt", "at2"),
        "slp_noval": K.value_check("slp"),
        "slp_clim": K.climatology_plus_stdev_with_lowbar("slp", "slp_norm", "slp_sd",
                                                         slp_p["maximum_standardised_anomaly"],
                                                         slp_p["lowbar"]),
        "slp_nonorm": K.no_normal_check("slp_norm"),
        "w_noval": K.value_check("w"),
        "w_hardlimit": K.hard_limit("w", w_p["hard_limits"]),
        "w_consistency": K.wind_consistency("w", "d", w_p["variable_limit"]),
        "dpt_hardlimit": dpt_hard,
        "at2_clim": K.climatology_plus_stdev_check("at2", "at2_norm", "at2_sd",
                                                   at_p["minmax_standard_deviation"],
                                                   at_p["maximum_standardised_anomaly"]),
        "at2_noval": K.value_check("at2"),
        "at2_nonorm": K.no_normal_check("at2_norm"),
        "at2_hardlimit": K.hard_limit("at", at_p["hard_limits"]),
    }
    if flags is not None:
        cols = {k: v for k, v in cols.items() if k in flags}
        return out.withColumns(cols).select(*[F.col(f"`{c}`") for c in df.columns], *flags)
    return out.withColumns(cols).drop("_day")


# --- C3: bundles of one variable ------------------------------------------------------
_POSITION = ["pos_isbuoy", "pos_isship", "pos_pos", "pos_date", "pos_time", "pos_blklst"]
BUNDLES = {
    "wind": [*_POSITION, "w_wind_blacklist", "w_noval", "w_hardlimit", "w_consistency"],
    "dat": [*_POSITION, "pos_day", "at_mat_blacklist", "at_noval", "at_clim", "at_nonorm", "at_hardlimit"],
    "slp": [*_POSITION, "pos_is780", "pos_day", "slp_noval", "slp_clim", "slp_nonorm"],
    "sst": [*_POSITION, "pos_is780", "pos_day", "sst_noval", "sst_freez", "sst_clim", "sst_nonorm", "sst_hardlimit"],
}
#: What a flag reads: report columns, and of the normals the field and cell style.
_PLACE, _DATE = {"lat", "lon"}, {"yr", "mo", "dy"}
FLAG_READS: dict[str, set[str]] = {
    "pos_isbuoy": {"pt"}, "pos_isdrifter": {"pt"}, "pos_isship": {"pt"}, "pos_is780": {"dck"}, "pos_pos": _PLACE,
    "pos_date": _DATE, "pos_time": {"hr"}, "pos_blklst": {*_PLACE, *_DATE, "id", "pt", "dck"},
    "pos_day": {*_PLACE, *_DATE, "hr"}, "at_mat_blacklist": {*_PLACE, "yr", "pt", "dck"}, "w_wind_blacklist": {"dck"},
    "w_noval": {"w"}, "w_hardlimit": {"w"}, "w_consistency": {"w", "d"},
    "at_noval": {"at"}, "at_clim": {"at", "at_norm"}, "at_nonorm": {"at_norm"}, "at_hardlimit": {"at"},
    "slp_noval": {"slp"}, "slp_clim": {"slp", "slp_norm", "slp_sd"}, "slp_nonorm": {"slp_norm"},
    "sst_noval": {"sst"}, "sst_freez": {"sst"}, "sst_clim": {"sst", "sst_norm"}, "sst_nonorm": {"sst_norm"}, "sst_hardlimit": {"sst"},
}
NORMAL_READS = {"sst_norm": ("mds", "sst"), "at_norm": ("mds", "at"), "slp_norm": ("regular", "slp"), "slp_sd": ("regular", "slp_sd")}


def qc_bundle(reports: DataFrame, clim: DataFrame, flags: list[str], params: dict | None = None, key: str = "uid",
              n: int = 73, res: float = 1.0) -> DataFrame:
    """``key`` and the listed flags.  What they read decides which report
    columns travel and which cells are looked up: wind needs no grid, SST and
    AT one MDS lookup, SLP one regular lookup; the sun is only computed for the day flag."""
    reads = set().union(*[FLAG_READS[f] for f in flags])
    base = {"yr", "mo", "dy", "hr", "lat", "lon", "id", "pt", "dck"}  # what every flag's preparation touches
    cols = sorted((reads - set(NORMAL_READS)) | base | ({"at"} if "at" in reports.columns else set()))
    out = prepare_reports(reports.select(key, *cols))
    for style in ("mds", "regular"):
        values = {field: name for name, (s, field) in NORMAL_READS.items() if name in reads and s == style}
        if values:
            out = grid_lookup(out, clim, values, n=n, res=res, style=style)
    return base_qc(out, params, flags=flags).select(key, *flags)


def with_humidity(df: DataFrame) -> DataFrame:
    return humidity_columns(df, "at", "dpt", "slp_norm")


def qc_reports(reports: DataFrame, clim: DataFrame, params: dict | None = None,
               preset: str = "default", extra_mds: dict[str, str] | None = None) -> DataFrame:
    """Reports -> normals -> humidity -> base flags (the per-report stage of
    the monthly QC job).  ``extra_mds`` fetches more fields of the MDS cell
    in the same join (e.g. the pentad st. dev. the buddy checks need)."""
    out = attach_normals(prepare_reports(reports), clim, extra_mds=extra_mds)
    return base_qc(with_humidity(out), params, preset)


def flag_counts(flagged: DataFrame, flags: list[str] | None = None) -> DataFrame:
    """K5 quicklook: (flag, value, n) for every flag column — one scan, the
    flags are unpivoted with ``stack`` and counted with a partial aggregate."""
    flags = flags or BASE_FLAGS
    long = flagged.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("flag"), F.col(f).cast("int").alias("value")) for f in flags
    ])).alias("kv")).select("kv.flag", "kv.value")
    return long.groupBy("flag", "value").agg(F.count(F.lit(1)).alias("n"))
