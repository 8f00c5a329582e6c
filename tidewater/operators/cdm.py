"""Update-style joins and bookkeeping on CDM tables.

CDM tables are kept as text at rest (StringType, NULL for ``null``); every
join here is a LEFT join of a big table with a side table keyed by
``report_id`` (or station id), so each is one shuffle at most.  Side tables
are keyed uniquely in the reference's inputs; duplicate keys multiply rows
exactly as a relational join does (no arbitrary pick).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.util import sized_broadcast


def _hist(msg: str) -> Column:
    return F.lit(";" + msg)


# --- J1: apply corrections -------------------------------------------------
def apply_corrections(table: DataFrame, corrections: DataFrame, element: str,
                      key: str = "report_id", history_msg: str | None = None,
                      is_change: str = "1") -> tuple[DataFrame, DataFrame]:
    """Replace ``element`` where the correction row says isChange = '1'.

    ``corrections``: (report_id, value, isChange).  Returns the corrected
    table (history appended on replaced rows when ``history_msg`` is given)
    and a one-row count of replacements.
    """
    c = corrections.select(F.col(key).alias("_ck"), F.col("value").alias("_cv"),
                           F.col("isChange").alias("_cc"))
    j = table.join(c, F.col(key) == F.col("_ck"), "left")
    replaced = F.coalesce(F.col("_cc") == is_change, F.lit(False))
    out = j.withColumn(element, F.when(replaced, F.col("_cv")).otherwise(F.col(element)))
    if history_msg is not None:
        out = out.withColumn("history", F.when(replaced, F.concat(F.coalesce(F.col("history"), F.lit("")),
                                                                  _hist(history_msg)))
                             .otherwise(F.col("history")))
    out = out.withColumn("_replaced", replaced)
    counts = out.agg(F.sum(F.col("_replaced").cast("int")).alias("n_corrected"),
                     F.count(F.lit(1)).alias("n_total")).withColumn("element", F.lit(element))
    return out.drop("_ck", "_cv", "_cc", "_replaced"), counts


# --- J2: duplicate-file merge ----------------------------------------------
def _members(col: Column) -> Column:
    """'{a,b}' -> array('a','b'); braces and empty members dropped."""
    inner = F.regexp_replace(F.coalesce(col, F.lit("")), r"^\{|\}$", "")
    return F.filter(F.split(inner, ","), lambda x: x != "")


def merge_duplicates(file1: DataFrame, file2: DataFrame) -> DataFrame:
    """Left join file 2 onto file 1 by uid: flag = max of both (NULL
    ignored), member lists concatenated, re-serialised as '{a,b}'."""
    b = file2.select(F.col("uid").alias("_u2"), F.col("flag").alias("_f2"),
                     F.col("duplicates").alias("_d2"))
    j = file1.join(b, F.col("uid") == F.col("_u2"), "left")
    members = F.concat(_members(F.col("duplicates")), _members(F.col("_d2")))
    return j.select(
        "uid",
        F.greatest(F.col("flag"), F.col("_f2")).cast("int").alias("flag"),
        F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")).alias("duplicates"),
    )


# --- J3: pre-processing corrections ------------------------------------------
def override_duplicates(first: DataFrame, second: DataFrame) -> DataFrame:
    """Duplicate file ``first`` (uid, flag, duplicates) updated by a later
    one: its flag replaces, its duplicates are added to those known."""
    s = second.select(F.col("uid").alias("_u"), F.col("flag").alias("_f"), F.col("duplicates").alias("_d"))
    hit = F.col("_u").isNotNull()
    return first.join(s, F.col("uid") == F.col("_u"), "left").select(
        "uid", F.when(hit, F.col("_f")).otherwise(F.col("flag")).alias("flag"),
        F.when(hit, F.concat("duplicates", "_d")).otherwise(F.col("duplicates")).alias("duplicates"))


def apply_preprocess_corrections(reports: DataFrame, dup: DataFrame, ids: DataFrame,
                                 datepos: DataFrame) -> DataFrame:
    """Three left joins by uid: duplicate flag (missing -> NULL, filled later
    by ``override_duplicate_flag``), corrected ID, corrected date/lat/lon.
    A correction replaces a value only where its row exists."""
    d = dup.select(F.col("uid").alias("_du"), F.col("flag").cast("int").alias("dup_flag"))
    i = ids.select(F.col("uid").alias("_iu"), F.col("new_id").alias("_nid"))
    ts = F.try_to_timestamp(F.col("new_date"), F.lit("yyyy-MM-dd HH:mm"))
    p = datepos.select(
        F.col("uid").alias("_pu"),
        F.year(ts).alias("_yr"), F.month(ts).alias("_mo"), F.dayofmonth(ts).alias("_dy"),
        (F.hour(ts) + F.minute(ts) / 60.0).alias("_hr"),
        F.col("new_lat").try_cast("double").alias("_lat"),
        F.col("new_lon").try_cast("double").alias("_lon"),
    )
    j = (reports.join(d, F.col("uid") == F.col("_du"), "left")
         .join(i, F.col("uid") == F.col("_iu"), "left")
         .join(p, F.col("uid") == F.col("_pu"), "left"))
    has_p = F.col("_pu").isNotNull()
    out = j.withColumns({
        "id": F.when(F.col("_iu").isNotNull(), F.col("_nid")).otherwise(F.col("id")),
        "yr": F.when(has_p, F.col("_yr")).otherwise(F.col("yr")),
        "mo": F.when(has_p, F.col("_mo")).otherwise(F.col("mo")),
        "dy": F.when(has_p, F.col("_dy")).otherwise(F.col("dy")),
        "hr": F.when(has_p, F.col("_hr")).otherwise(F.col("hr")),
        "lat": F.when(has_p, F.col("_lat")).otherwise(F.col("lat")),
        "lon": F.when(has_p, F.col("_lon")).otherwise(F.col("lon")),
    })
    return out.drop("_du", "_iu", "_nid", "_pu", "_yr", "_mo", "_dy", "_hr", "_lat", "_lon")


# --- S9: corrections reshaping -----------------------------------------------
def reshape_datepos(df: DataFrame) -> DataFrame:
    """7-column date/lat/lon correction rows -> long (uid, element, value,
    flag) via ``stack`` (one pass, no union of three scans)."""
    return df.selectExpr(
        "uid",
        "stack(3, 'date', new_date, date_flag, 'lat', new_lat, lat_flag, 'lon', new_lon, lon_flag) "
        "AS (element, value, flag)")


# --- J4 / J5: mask propagation and station id carry --------------------------
def propagate_mask(obs: DataFrame, header_valid: DataFrame, key: str = "report_id") -> DataFrame:
    """Keep only observations whose report survived header validation."""
    return obs.join(header_valid.select(key), key, "left_semi")


def carry_station_id(obs: DataFrame, header: DataFrame, key: str = "report_id") -> DataFrame:
    h = header.select(key, F.col("primary_station_id").alias("_psid"))
    return obs.join(h, key, "left").withColumn("primary_station_id", F.col("_psid")).drop("_psid")


# --- J6: update from metadata ------------------------------------------------
def update_from(table: DataFrame, meta: DataFrame, key: str, columns: list[str],
                history_msg: str | None = None) -> DataFrame:
    """Non-null metadata values overwrite the table's values on matching
    keys (pandas ``update``); history is appended on matched rows."""
    m = meta.select(F.col(key).alias("_mk"), *[F.col(c).alias(f"_m_{c}") for c in columns])
    j = table.join(m, F.col(key) == F.col("_mk"), "left")
    out = j.withColumns({c: F.coalesce(F.col(f"_m_{c}"), F.col(c)) for c in columns})
    if history_msg is not None:
        out = out.withColumn("history", F.when(F.col("_mk").isNotNull(),
                                               F.concat(F.coalesce(F.col("history"), F.lit("")), _hist(history_msg)))
                             .otherwise(F.col("history")))
    return out.drop("_mk", *[f"_m_{c}" for c in columns])


# --- J7: metadata availability ---------------------------------------------------
def update_where_available(table: DataFrame, meta: DataFrame, key: str, columns: list[str], available: Column,
                           history_msg: str | None = None) -> DataFrame:
    """J6 for the rows whose source and year have metadata (``available``);
    the other rows pass unchanged."""
    ok = F.coalesce(available, F.lit(False))
    done = update_from(table.where(ok), meta, key, columns, history_msg)
    return done.unionByName(table.where(~ok))


def unmatched_counts(table: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Ids of the table absent from the metadata, with their counts."""
    return table.join(meta.select(key).distinct(), key, "left_anti").groupBy(key).count()


# --- J8 / A18: QC flags into quality fields ----------------------------------
# FIXED VALUES: QC columns per parameter and their CDM targets.
QC_COLUMNS = {
    "SST": ["bud", "clim", "nonorm", "freez", "noval", "hardlimit"],
    "AT": ["bud", "clim", "nonorm", "noval", "mat_blacklist", "hardlimit"],
    "SLP": ["bud", "clim", "nonorm", "noval"],
    "DPT": ["bud", "clim", "nonorm", "ssat", "noval", "rep", "repsat"],
    "POS": ["trk", "date", "time", "pos", "blklst"],
    "W": ["noval", "hardlimit", "consistency", "wind_blacklist"],
}
QC_TARGETS = {
    "SST": [("observations-sst", "quality_flag")],
    "SLP": [("observations-slp", "quality_flag")],
    "AT": [("observations-at", "quality_flag")],
    "DPT": [("observations-dpt", "quality_flag"), ("observations-wbt", "quality_flag")],
    "W": [("observations-ws", "quality_flag"), ("observations-wd", "quality_flag")],
    "POS": [("header", "location_quality")],
}


def parameter_flag(qc: DataFrame, parameter: str, uid: str = "uid",
                   count_missing_as_failed: bool = False) -> DataFrame:
    """(uid, <parameter>) with '0' when every listed QC column is 0, the bad
    flag ('1', or '2' for POS) when any is non-zero, NULL when any column
    is NULL; for measured parameters NULL again when ``noval`` is 1
    (missing value is not a failed value) unless ``count_missing_as_failed``."""
    cols = QC_COLUMNS[parameter]
    bad = "2" if parameter == "POS" else "1"
    all_present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    total = reduce(lambda a, b: a + b, [F.col(c).cast("int") for c in cols])
    g = F.when(all_present, F.when(total == 0, F.lit("0")).otherwise(F.lit(bad)))
    if parameter != "POS" and not count_missing_as_failed:
        g = F.when(F.coalesce(F.col("noval").cast("int") == 1, F.lit(False)), F.lit(None).cast("string")) \
            .otherwise(g)
    return qc.select(F.col(uid).alias("uid"), g.alias(parameter))


def merge_qc_flags(qc_frames: dict[str, DataFrame], uid_prefix: str = "ICOADS-30-") -> DataFrame:
    """Outer-combine the per-parameter flags into one (report_id, POS, SST,
    AT, SLP, DPT, W, report_quality) frame.  Each parameter's frame is first
    reduced to (uid, flag) so the combine shuffles narrow rows only."""
    parts = [parameter_flag(df, p) for p, df in qc_frames.items()]
    allp = list(qc_frames)
    long = reduce(DataFrame.unionByName, [
        p.select("uid", F.lit(name).alias("param"), F.col(name).alias("flag"))
        for p, name in zip(parts, allp)])
    wide = long.groupBy("uid").pivot("param", allp).agg(F.first("flag", ignorenulls=True))
    wide = wide.withColumn("report_id", F.concat(F.lit(uid_prefix), F.col("uid"))).drop("uid")
    return add_report_quality(wide, [p for p in allp if p != "POS"])


def add_report_quality(flags: DataFrame, params: list[str]) -> DataFrame:
    """A18: '2' not checked; '1' when every assessed parameter failed; '0'
    when any passed; '1' whenever POS failed ('2')."""
    applied = reduce(lambda a, b: a + b, [F.col(p).isNotNull().cast("int") for p in params])
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(p).cast("int"), F.lit(0)) for p in params])
    rq = (F.when(F.coalesce(F.col("POS") == "2", F.lit(False)), F.lit("1"))
          .when(total < applied, F.lit("0"))
          .when((total >= applied) & (applied > 0), F.lit("1"))
          .otherwise(F.lit("2")))
    return flags.withColumn("report_quality", rq)


def apply_qc_to_header(header: DataFrame, flags: DataFrame, history_msg: str | None = None) -> DataFrame:
    """Header gets location_quality from POS (not assessed -> '3'),
    report_quality (not assessed -> '2') and report_time_quality '2'."""
    f = flags.select(F.col("report_id").alias("_rid"), F.col("POS").alias("_pos"),
                     F.col("report_quality").alias("_rq"))
    j = header.join(f, F.col("report_id") == F.col("_rid"), "left")
    out = j.withColumns({
        "location_quality": F.coalesce(F.col("_pos"), F.lit("3")),
        "report_quality": F.coalesce(F.col("_rq"), F.lit("2")),
        "report_time_quality": F.lit("2"),
    })
    if history_msg is not None:
        out = out.withColumn("history", F.when(F.col("_pos").isNotNull(),
                                               F.concat(F.coalesce(F.col("history"), F.lit("")), _hist(history_msg)))
                             .otherwise(F.col("history")))
    return out.drop("_rid", "_pos", "_rq")


def apply_qc_to_observations(obs: DataFrame, flags: DataFrame, parameter: str) -> DataFrame:
    """Observation table quality_flag from its parameter (missing -> '2')."""
    f = flags.select(F.col("report_id").alias("_rid"), F.col(parameter).alias("_q"))
    j = obs.join(f, F.col("report_id") == F.col("_rid"), "left")
    return j.withColumn("quality_flag", F.coalesce(F.col("_q"), F.lit("2"))).drop("_rid", "_q")


# --- J9: drifter tracking flags ---------------------------------------------
TRACKING_FLAGS = ["drf_agr", "drf_spd", "drf_tail1", "drf_tail2", "drf_bias", "drf_noise", "drf_short"]


def merge_tracking_flags(header: DataFrame, tracking: DataFrame, untested_is_failure: bool = False,
                         uid_prefix: str = "ICOADS-30-") -> DataFrame:
    """Sum of the seven drifter flags: 0 -> location 0; > 0 -> location 1 and
    report 1; no tracking row -> location 3.  Flag 9 (never set) counts as
    untested (0) unless ``untested_is_failure``."""
    vals = [F.col(c).cast("int") for c in TRACKING_FLAGS]
    if not untested_is_failure:
        vals = [F.when(v == 9, F.lit(0)).otherwise(v) for v in vals]
    t = tracking.select(F.concat(F.lit(uid_prefix), F.col("uid")).alias("_rid"),
                        reduce(lambda a, b: a + b, vals).alias("_trk"))
    j = header.join(t, F.col("report_id") == F.col("_rid"), "left")
    trk = F.col("_trk")
    return j.withColumns({
        "location_quality": F.when(trk.isNull(), F.lit("3")).when(trk == 0, F.lit("0")).otherwise(F.lit("1")),
        "report_quality": F.when(trk > 0, F.lit("1")).otherwise(F.col("report_quality")),
    }).drop("_rid", "_trk")


# --- C18: platform-type correction -------------------------------------------
def correct_platform_type(reports: DataFrame, rules: DataFrame, deck: str = "dck", platform: str = "pt") -> DataFrame:
    """Platform types replaced by the rule of their (deck, platform type);
    a missing type can have a rule.  ``rules``: (dck, pt, new_pt), unique by
    (dck, pt); a rule without ``new_pt`` makes the type missing."""
    r = rules.select(F.col("dck").alias("_rd"), F.col("pt").alias("_rp"), F.col("new_pt").alias("_rn"),
                     F.lit(True).alias("_rule"))
    j = reports.join(sized_broadcast(r), (F.col(deck) == F.col("_rd")) & F.col(platform).eqNullSafe(F.col("_rp")), "left")
    new = F.when(F.col("_rule"), F.col("_rn")).otherwise(F.col(platform))
    return j.withColumn(platform, new).drop("_rd", "_rp", "_rn", "_rule")


# --- O2: numeric order of text tables ------------------------------------------
def numeric_order(table: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in the numeric order of text columns; what is no number comes
    first.  One range-partitioned sort."""
    return table.orderBy(*[F.col(c).try_cast("double").asc_nulls_first() for c in columns])


# --- K2: monthly period and leaks --------------------------------------------
def assign_period(table: DataFrame, ts_col: str, source_year: int | Column, source_month: int | Column) -> DataFrame:
    """``period`` = month of the (corrected) timestamp, or the source month
    when it does not parse; ``leak`` = period differs from the source."""
    src = F.make_date(F.lit(source_year) if isinstance(source_year, int) else source_year,
                      F.lit(source_month) if isinstance(source_month, int) else source_month, F.lit(1))
    ts = F.try_to_timestamp(F.col(ts_col))
    period = F.coalesce(F.trunc(F.to_date(ts), "MM"), src)
    return table.withColumns({"period": F.date_format(period, "yyyy-MM"),
                              "leak": period != src})


# --- A16: value counts --------------------------------------------------------
def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


# --- O3: concatenation with differing columns -------------------------------
def concat_tables(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
