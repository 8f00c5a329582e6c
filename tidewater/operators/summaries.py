"""Station, source and deck summaries.

All summaries are plain ``groupBy`` aggregates (partial aggregation before
the shuffle, so a platform holding a third of the rows only costs its share
of map-side work) or unions of them; roll-ups month -> year -> all reuse the
smaller previous level instead of rescanning reports.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.util import sized_broadcast

STATION_KEYS = ["primary_station_id", "primary_station_id_scheme", "station_record_number",
                "platform_type", "station_type", "station_name", "platform_sub_type"]
# FIXED VALUES: observed-variable codes, appended in this order when the
# variable is present in more than 20 % of a station's reports.
VARIABLE_CODES = [("at", 85), ("sst", 95), ("wbt", 41), ("slp", 58), ("w", 107), ("d", 106),
                  ("dpt", 36), ("n", 21), ("ww", 102)]


def station_month(df: DataFrame, variables: list[tuple[str, int]] | None = None,
                  share: float = 20.0, by: list[str] | None = None) -> DataFrame:
    """Per station (7 keys, rows with a missing key dropped as a pandas
    groupby does): time extent, bounding box, per-variable counts and the
    codes of variables present in more than ``share`` % of reports."""
    variables = variables or VARIABLE_CODES
    keyed = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in STATION_KEYS]))
    aggs = [F.min("report_timestamp").alias("start_date"), F.max("report_timestamp").alias("end_date"),
            F.min("longitude").alias("bbox_min_lon"), F.max("longitude").alias("bbox_max_lon"),
            F.min("latitude").alias("bbox_min_lat"), F.max("latitude").alias("bbox_max_lat"),
            F.count("longitude").alias("obs_count")]
    aggs += [F.count(v).alias(f"{v}_count") for v, _ in variables]
    s = keyed.groupBy(*(by or []), *STATION_KEYS).agg(*aggs)
    codes = F.array_compact(F.array(*[
        F.when(100 * (F.col(f"{v}_count") / F.col("obs_count")) > share, F.lit(str(code)))
        for v, code in variables]))
    return s.withColumn("observed_variables", F.array_join(codes, ","))


def station_year(monthly: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Roll monthly station records up to one per (station, record)
    (and ``by``, e.g. the year): time extent and bbox, union of
    observed-variable codes (ascending), the earliest name as station_name
    and other names as alternative_name."""
    keys = [*(by or []), "primary_station_id", "station_record_number"]
    named = monthly.withColumn("_codes", F.split(F.col("observed_variables"), ","))
    agg = named.groupBy(*keys).agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
        F.min("bbox_min_lon").alias("bbox_min_lon"), F.max("bbox_max_lon").alias("bbox_max_lon"),
        F.min("bbox_min_lat").alias("bbox_min_lat"), F.max("bbox_max_lat").alias("bbox_max_lat"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_codes")))).alias("_codes"),
        F.min_by("station_name", F.struct("start_date", "station_name")).alias("station_name"),
        F.array_sort(F.collect_set("station_name")).alias("_names"),
        F.count_distinct("platform_type").alias("n_platform_types"),
    )
    return agg.select(
        *keys, "start_date", "end_date", "bbox_min_lon", "bbox_max_lon", "bbox_min_lat", "bbox_max_lat",
        F.array_join(F.filter("_codes", lambda c: c != ""), ",").alias("observed_variables"),
        "station_name",
        F.array_join(F.filter("_names", lambda n: n != F.col("station_name")), ",").alias("alternative_name"),
        (F.col("n_platform_types") == 1).alias("unique_platform_type"),
    )


def source_month(df: DataFrame, template: DataFrame | None = None, year: int | None = None,
                 month: int | None = None) -> DataFrame:
    """A14 + J17: bounding box per 'sid-dck' source, left-joined to the
    source template (a configuration table, broadcast after a bounded
    count), with the release's constant provenance columns."""
    src = F.concat(F.lpad(F.col("sid").cast("string"), 3, "0"), F.lit("-"),
                   F.lpad(F.col("dck").cast("string"), 3, "0"))
    s = df.withColumn("source_key", src).groupBy("source_key").agg(
        F.min("lon").alias("bbox_min_lon"), F.max("lon").alias("bbox_max_lon"),
        F.min("lat").alias("bbox_min_lat"), F.max("lat").alias("bbox_max_lat"))
    if template is not None:
        s = s.join(sized_broadcast(template), "source_key", "left")
    suffix = F.lit("") if year is None else F.lit(f"-{year:04d}-{month:02d}")
    return s.withColumns({
        "source_id": F.concat(F.lit("ICOADS-3-0-0T-"), F.col("source_key"), suffix),
        "product_id": F.lit("IC30"), "product_code": F.lit("ICOADS"),
    })


def deck_summary(df: DataFrame) -> DataFrame:
    """One tidy table of counts by call sign, platform, deck, year and
    (year, 5-degree cell), plus the bounding box, in ONE aggregation with
    grouping sets (a single shuffle)."""
    lon = F.when(F.col("lon") >= 180, F.col("lon") - 360).otherwise(F.col("lon"))
    cell = (F.floor((lon + 180) / 5) + 72 * F.floor((F.col("lat") + 90) / 5)).cast("long")
    d = df.select(F.col("id").alias("callsign"), F.col("pt").cast("string").alias("platform"),
                  F.col("dck").cast("string").alias("deck"), F.col("yr").alias("year"), cell.alias("cell"),
                  lon.alias("lon_n"), F.col("lat"))
    spark = df.sparkSession
    out = spark.sql("""
        SELECT CASE WHEN grouping(callsign) = 0 THEN 'callsign'
                    WHEN grouping(platform) = 0 THEN 'platform'
                    WHEN grouping(deck) = 0 THEN 'deck'
                    WHEN grouping(cell) = 0 THEN 'year_cell'
                    WHEN grouping(year) = 0 THEN 'year' ELSE 'all' END AS dimension,
               coalesce(callsign, platform, deck, CAST(year AS STRING)) AS key,
               cell, count(*) AS n,
               min(lon_n) AS min_lon, max(lon_n) AS max_lon, min(lat) AS min_lat, max(lat) AS max_lat
        FROM {d}
        GROUP BY GROUPING SETS ((callsign), (platform), (deck), (year), (year, cell), ())""", d=d)
    return out


def completeness(df: DataFrame, cols: list[str], out: str = "completeness") -> DataFrame:
    """Share of the listed fields that are present, per row."""
    present = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    return df.withColumn(out, present / float(len(cols)))


def drifter_inventory(df: DataFrame) -> DataFrame:
    """Distinct drifter IDs per month."""
    return df.where(F.col("pt") == 7).select("id", "yr", "mo").distinct()


def mean_missing(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Mean ignoring missing values (NULL when all are missing)."""
    return df.groupBy(*by).agg(F.avg(value).alias(f"{value}_mean"))


def map_codes(df: DataFrame, col: str, mapping: DataFrame, out: str | None = None) -> DataFrame:
    """Map coded values through a (code, value) table; unknown
    codes pass through, '' becomes NULL.  The table is small configuration
    and broadcast after a bounded count."""
    out = out or col
    m = mapping.select(F.col("code").alias("_code"), F.col("value").alias("_mapped"))
    j = df.join(sized_broadcast(m), F.col(col) == F.col("_code"), "left")
    v = F.coalesce(F.col("_mapped"), F.col(col).cast("string"))
    return j.withColumn(out, F.when(v == "", F.lit(None)).otherwise(v)).drop("_code", "_mapped")


def key_col(*cols: str, sep: str = "-") -> Column:
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


# --- A10: trimmed and winsorised statistics (skew-proof ranks) ----------------------
def robust_stats(df: DataFrame, value: str, key: str = "id", trim: int = 100) -> DataFrame:
    """Per ``key``: trimmed mean and population st. dev. after dropping
    n // trim values at each end of the sorted values, and the winsorised
    mean (lowest and highest n // 4 values replaced by their neighbours,
    for n >= 4).  Integer division throughout.

    Rows are first counted by (key, value), with partial sums, so a key with
    a third of all rows shrinks to its distinct values.  A distinct value
    covers the ranks [first, end); running sums over value ranges (its integer
    part, then inside it) give them, and a rank interval keeps of a value as
    many rows as it covers of those ranks."""
    d = df.where(F.col(value).isNotNull()).groupBy(F.col(key).alias("_k"), F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"))
    d = d.withColumn("_part", F.floor("_v"))
    inside = Window.partitionBy("_k", "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    parts = d.groupBy(F.col("_k").alias("_pk"), F.col("_part").alias("_pp")).agg(F.sum("_c").alias("_pc"))
    whole = Window.partitionBy("_pk")
    before = whole.orderBy("_pp").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"_base": F.coalesce(F.sum("_pc").over(before), F.lit(0)), "_n": F.sum("_pc").over(whole)})
    d = d.join(parts, F.col("_k").eqNullSafe(F.col("_pk")) & (F.col("_part") == F.col("_pp")))
    d = d.withColumn("_first", F.col("_base") + F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    d = d.withColumn("_end", F.col("_first") + F.col("_c"))
    n, v = F.col("_n"), F.col("_v")
    cut = F.floor(n / trim) if trim else F.lit(0)
    low = F.when(n >= 4, F.floor(n / 4)).otherwise(F.lit(0))

    def rows_in(start: Column, stop: Column) -> Column:
        return F.greatest(F.least(F.col("_end"), stop) - F.greatest(F.col("_first"), start), F.lit(0))

    def holds(rank: Column) -> Column:
        return (F.col("_first") <= rank) & (rank < F.col("_end"))

    d = d.withColumns({"_keep": rows_in(cut, n - cut), "_in": rows_in(low, n - low), "_low": low,
                       "_vl": F.when(holds(low), v), "_vh": F.when(holds(n - 1 - low), v)})
    stats = d.groupBy("_k").agg(
        F.max("_n").alias("n"), F.sum("_keep").alias("_kept"), F.sum(v * F.col("_keep")).alias("_s1"),
        F.sum(v * F.col("_in")).alias("_s"), F.max("_vl").alias("_vl"), F.max("_vh").alias("_vh"), F.max("_low").alias("_low"))
    stats = stats.withColumn("_mean", F.when(F.col("_kept") > 0, F.col("_s1") / F.col("_kept")))
    # squares about the mean, so that large values lose no digits
    means = stats.select(F.col("_k").alias("_mk"), "_mean")
    spread = d.join(means, F.col("_k").eqNullSafe(F.col("_mk"))).groupBy("_mk").agg(
        F.sum((v - F.col("_mean")) ** 2 * F.col("_keep")).alias("_ss"))
    out = stats.join(spread, F.col("_k").eqNullSafe(F.col("_mk")))
    w = (F.col("_s") + (F.col("_vl") + F.col("_vh")) * F.col("_low")) / F.col("n")
    return out.select(F.col("_k").alias(key), "n", F.col("_mean").alias("trimmed_mean"),
                      F.when(F.col("_kept") > 0, F.sqrt(F.col("_ss") / F.col("_kept"))).alias("trimmed_std"),
                      w.alias("winsorised_mean"))


def station_all(yearly: DataFrame) -> DataFrame:
    """All-years roll-up of yearly station records per (station,
    record): extent, bbox, observed-variable codes as a numerically sorted
    brace list, the earliest name as station_name and every other name
    (and earlier alternative names, 'NULL' ignored) as a sorted brace list;
    ``consistent`` is false when the platform type was not unique (the
    reference asserts instead of reporting)."""
    keys = ["primary_station_id", "station_record_number"]
    alt = F.filter(F.split(F.coalesce(F.col("alternative_name"), F.lit("")), ","),
                   lambda x: (x != "") & (x != "NULL"))
    d = yearly.withColumns({"_codes": F.transform(F.filter(F.split(F.col("observed_variables"), ","),
                                                           lambda c: c != ""), lambda c: c.cast("int")),
                            "_alt": alt})
    agg = d.groupBy(*keys).agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
        F.min("bbox_min_lon").alias("bbox_min_lon"), F.max("bbox_max_lon").alias("bbox_max_lon"),
        F.min("bbox_min_lat").alias("bbox_min_lat"), F.max("bbox_max_lat").alias("bbox_max_lat"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_codes")))).alias("_codes"),
        F.min_by("station_name", F.struct("start_date", "station_name")).alias("station_name"),
        F.collect_set("station_name").alias("_names"),
        F.flatten(F.collect_list("_alt")).alias("_alts"),
        F.min(F.col("unique_platform_type").cast("int")).alias("_uniq"),
    )
    others = F.array_sort(F.array_distinct(F.filter(F.concat("_names", "_alts"),
                                                    lambda n: n != F.col("station_name"))))
    return agg.select(
        *keys, "start_date", "end_date", "bbox_min_lon", "bbox_max_lon", "bbox_min_lat", "bbox_max_lat",
        F.concat(F.lit("{"), F.array_join(F.transform("_codes", lambda c: c.cast("string")), ","), F.lit("}"))
        .alias("observed_variables"),
        "station_name",
        F.concat(F.lit("{"), F.array_join(others, ","), F.lit("}")).alias("alternative_name"),
        (F.col("_uniq") == 1).alias("consistent"),
    )


# --- A12 / A13: roll-ups over a mergeable state ---------------------------------------
# FIXED VALUES: station fields that must have one value per station.
UNIQUE_FIELDS = [
    "secondary_id", "secondary_id_scheme", "station_abbreviation", "station_crs", "longitude", "latitude", "local_gravity",
    "station_type", "platform_sub_type", "operating_institute", "operating_territory", "city", "contact", "role",
    "observing_frequency", "reporting_time", "telecommunication_method", "station_automation", "measuring_system_model",
    "measuring_system_id", "comment", "optional_data", "metadata_contact", "metadata_contact_role",
]
RECORD_KEYS = ["primary_station_id", "primary_station_id_scheme", "station_record_number", "platform_type"]
_EXTENT = {"start_date": F.min, "end_date": F.max, "bbox_min_lon": F.min, "bbox_max_lon": F.max,
           "bbox_min_lat": F.min, "bbox_max_lat": F.max}


def _list_of(col: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(col), F.lit("")), ","), lambda x: (x != "") & (x != "NULL"))


def station_state(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Station records in the form that ``merge_stations`` adds up: of every
    unique field its smallest and largest value and whether it is ever
    missing (two values a field, not a set), the names with the first date of
    each, the alternative names and the observed-variable codes."""
    def field(f: str) -> Column:
        v = F.when(F.col(f) != "NULL", F.col(f).cast("string"))
        return F.struct(v.alias("lo"), v.alias("hi"), v.isNull().alias("gap")).alias(f)

    name = F.when(F.coalesce(F.col("station_name"), F.lit("")) != "", F.array(F.struct(
        F.col("start_date").alias("first"), F.col("station_name").alias("name"))))
    empty = F.array().cast("array<struct<first:string,name:string>>")
    # small parts, dealt by date too for the sake of long stations: what a task sorts to merge stays in memory
    records = records.repartition(*(by or []), *RECORD_KEYS, "start_date")
    return merge_stations(records.select(
        *(by or []), *RECORD_KEYS, *_EXTENT, F.coalesce(name, empty).alias("names"), _list_of("alternative_name").alias("others"),
        F.transform(_list_of("observed_variables"), lambda c: c.cast("int")).alias("codes"), *[field(f) for f in UNIQUE_FIELDS]), by)


def merge_stations(state: DataFrame, by: list[str] | None = None) -> DataFrame:
    """States of the same station (and ``by``) as one.  Merging states of
    years gives the state of all their records, so records are read once."""
    one = state.groupBy(*(by or []), *RECORD_KEYS).agg(
        *[f(c).alias(c) for c, f in _EXTENT.items()],
        F.array_sort(F.flatten(F.collect_list("names"))).alias("names"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("others")))).alias("others"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("codes")))).alias("codes"),
        *[F.struct(F.min(f"{f}.lo").alias("lo"), F.max(f"{f}.hi").alias("hi"), F.max(f"{f}.gap").alias("gap")).alias(f)
          for f in UNIQUE_FIELDS])
    # names come in order of their first date: the later entries of a name say nothing new
    kept = F.aggregate("names", F.array().cast("array<struct<first:string,name:string>>"), lambda acc, e: F.when(
        F.exists(acc, lambda o: o["name"] == e["name"]), acc).otherwise(F.concat(acc, F.array(e))))
    return one.withColumn("names", kept)


def station_rollup(state: DataFrame, by: list[str] | None = None, all_years: bool = False) -> DataFrame:
    """Records of the annual (A12) or the all-years roll-up (A13): extent,
    codes, the name seen first, every other and alternative name, the 24
    unique fields and ``conflicts``, the fields with more than one value (null
    then).  A missing value besides others is one more value in a year but for
    ``platform_sub_type``; over all years it is none.  Lists of all years are
    in braces."""
    def two(f: str) -> Column:
        c = F.col(f)
        mixed = c["lo"] != c["hi"]
        if not all_years and f != "platform_sub_type":
            mixed = mixed | (c["lo"].isNotNull() & c["gap"])
        return F.coalesce(mixed, F.lit(False))

    names = F.transform("names", lambda e: e["name"])
    others = F.array_distinct(F.concat(F.slice(names, 2, F.greatest(F.size(names), F.lit(1))), F.col("others")))
    text = {"observed_variables": F.array_join(F.transform("codes", lambda c: c.cast("string")), ","),
            "alternative_name": F.array_join(others, ",")}
    if all_years:
        text = {k: F.concat(F.lit("{"), v, F.lit("}")) for k, v in text.items()}
    conflicts = F.array_join(F.array_compact(F.array(*[F.when(two(f), F.lit(f)) for f in UNIQUE_FIELDS])), ",")
    return state.select(*(by or []), *RECORD_KEYS, *_EXTENT, F.get(names, F.lit(0)).alias("station_name"),
                        *[v.alias(k) for k, v in text.items()], *[F.when(~two(f), F.col(f)["lo"]).alias(f) for f in UNIQUE_FIELDS],
                        conflicts.alias("conflicts"))
