"""Registered queries of whole runs over stored tables: daily normals at 0.25
degree (J11), drifter chunks and run policies (W16), tracking merge (K9)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import checks as K
from tidewater.operators import drifter as DR
from tidewater.operators import grid_lookup as GL
from tidewater.params import DEFAULT_PARAMETERS
from tidewater.plans import adapters as A
from tidewater.plans import sqlx as X
from tidewater.plans.catalog import register
from tidewater.session import ensure_checkpoint_dir, stage_table
from tidewater.sources import sinks

RES, STEPS = 0.25, 365
_SST = DEFAULT_PARAMETERS["SST"]
_HIRES: dict[int, str] = {}


def hires_field(spark: SparkSession) -> str:
    """Folder of the daily 0.25-degree normals, stored by slice once per session."""
    if id(spark) not in _HIRES:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hires-{uuid.uuid4().hex[:12]}"
        GL.write_slices(spark.sql(A.HIRES_SQL), path, RES)
        _HIRES[id(spark)] = path
    return _HIRES[id(spark)]


def _hires_sql() -> str:
    """The field's formula at the report's own cell, without a table or join."""
    lo = f"(CASE WHEN lon >= 180 THEN lon - 360.0 ELSE lon END)"
    norm = "CASE WHEN x % 12 = (2 * CAST(floor(y / 4) AS INT) + t) % 12 THEN 28 - abs(2 * y - 719) / 32.0::DOUBLE + t % 10 / 8.0::DOUBLE END"
    ok = f"{X.valid_day('2004', 'mo', 'dy')} AND lat IS NOT NULL AND lon IS NOT NULL"
    return f"""WITH {A.cte('reports')},
k AS (SELECT uid, sst, CASE WHEN {ok} THEN {X.doy365('mo', 'dy')} - 1 END AS t,
             least(greatest({X.itrunc('(90.0 - lat) / 0.25')}, 0), 719) AS y,
             {X.pmod(X.itrunc(f'({lo} + 180.0) / 0.25'), 1440)} AS x FROM reports),
n AS (SELECT uid, sst, {norm} AS sst_norm FROM k)
SELECT uid, sst_norm, {X.f('sst IS NULL')} AS noval, {X.f('sst IS NOT NULL AND sst < -1.8')} AS freez,
       {X.f('sst IS NULL OR sst_norm IS NULL OR abs(sst - sst_norm) > 8.0')} AS clim, {X.f('sst_norm IS NULL')} AS nonorm,
       {X.hard('sst', -5.0, 45.0)} AS hardlimit FROM n"""


@register("hires_sst_qc", _hires_sql())
def q_hires_sst_qc(spark: SparkSession, sf: str) -> DataFrame:
    """Base SST flags of every report against daily 0.25-degree normals
    (365 x 720 x 1440 cells, regular cells), read by slice."""
    r = A.reports(spark, sf).select("uid", "sst", "lat", "lon", "mo", "dy")
    d = GL.slice_lookup(r, hires_field(spark), {"sst": "sst_norm"}, STEPS, RES)
    return d.select(
        "uid", "sst_norm", K.value_check("sst").alias("noval"),
        K.sst_freeze_check("sst", 0.0, _SST["freezing_point"], _SST["freeze_check_n_sigma"]).alias("freez"),
        K.climatology_check("sst", "sst_norm", _SST["maximum_anomaly"]).alias("clim"),
        K.no_normal_check("sst_norm").alias("nonorm"), K.hard_limit("sst", _SST["hard_limits"]).alias("hardlimit"))


# --- W16: which chunks a run takes --------------------------------------------------
#: Months of buoy reports: a buoy of the test tables reports in one month, so
#: its reports are spread over months by number, and one in 50 comes too late for the last run.
_BUOY_MONTHS = """
SELECT DISTINCT id, CAST(yr + floor((mo - 1 + k) / 12) AS INT) AS yr, CAST((mo - 1 + k) % 12 + 1 AS INT) AS mo, late
FROM (
  SELECT CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'V' || CAST(user_id % 300 AS STRING) END AS id,
         CAST(2000 AS INT) AS yr, CAST(1 + user_id % 12 AS INT) AS mo,
         CAST((event_id * 7) % 41 + CASE WHEN event_id % 3 = 0 THEN 9 ELSE 0 END AS INT) AS k, event_id % 50 = 0 AS late
  FROM $events WHERE user_id % 5 < 3) e
"""

_POLICY = {"take_all": "true", "take_standard": "regular", "take_new": "new", "take_noend": "regular OR start_edge"}


def _inventory_sql(name: str, src: str) -> str:
    """Chunks as islands: a month that no month of the two before precedes starts one."""
    return f"""{name}_m AS (SELECT DISTINCT id, yr * 12 + mo - 1 AS m FROM {src}),
{name}_r AS (SELECT min(m) AS lo, max(m) AS hi FROM {name}_m),
{name}_s AS (SELECT a.id, a.m FROM {name}_m a WHERE NOT EXISTS (SELECT 1 FROM {name}_m b WHERE b.id IS NOT DISTINCT FROM a.id
        AND b.m IN (a.m - 1, a.m - 2))),
{name}_c AS (SELECT m.id, max(s.m) AS start, m.m FROM {name}_m m JOIN {name}_s s ON s.id IS NOT DISTINCT FROM m.id AND s.m <= m.m GROUP BY m.id, m.m),
{name}_g AS (SELECT id, start, max(m) AS "end", count(*) AS n_months FROM {name}_c GROUP BY id, start),
{name} AS (SELECT g.*, start < lo + 2 AS start_edge, "end" > hi - 2 AS end_edge, "end" = hi - 2 AS "new",
                  NOT (start < lo + 2 OR "end" > hi - 2) AS regular FROM {name}_g g, {name}_r)"""


@register("tracking_runs", f"""WITH b AS ({A.duck(_BUOY_MONTHS)}),
old AS (SELECT id, yr, mo FROM b WHERE NOT late),
{_inventory_sql('now', 'b')}, {_inventory_sql('was', 'old')}
SELECT id, start, "end", n_months, start_edge, end_edge, "new", regular, {', '.join(f'{c} AS {n}' for n, c in _POLICY.items())},
  NOT EXISTS (SELECT 1 FROM was w WHERE w.id IS NOT DISTINCT FROM now.id AND w.start = now.start AND w."end" = now."end"
     AND w.n_months = now.n_months AND w.start_edge = now.start_edge AND w.end_edge = now.end_edge AND w."new" = now."new") AS changed
FROM now""")
def q_tracking_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk inventory of all buoys, what each of the four run policies
    takes of it, and what changed since the inventory stored by the run before."""
    months = A.view(spark, sf, _BUOY_MONTHS)
    stored = stage_table(DR.chunk_inventory(months.where("not late")), "inventory")
    now = stage_table(DR.chunk_inventory(months), "inventory")
    out = now
    for policy in DR.RUN_POLICIES:
        out = _mark(out, DR.run_chunks(now, policy), f"take_{policy}")
    return _mark(out, DR.run_chunks(now, "all", stored), "changed")


def _mark(rows: DataFrame, chosen: DataFrame, name: str) -> DataFrame:
    c = chosen.select(F.col("id").alias("_i"), F.col("start").alias("_s"), F.lit(True).alias("_y"))
    joined = rows.join(c, F.col("id").eqNullSafe(F.col("_i")) & (F.col("start") == F.col("_s")), "left")
    return joined.withColumn(name, F.coalesce("_y", F.lit(False))).drop("_i", "_s", "_y")


# --- K9: tracking files by month ------------------------------------------------------
#: Rows of two tracking runs; the second has other flags, only months 3 and 4, and a few edge cases.
_TRACK_ROWS = """
SELECT CAST(event_id AS STRING) AS "UID", CAST(1995 + user_id % 3 AS STRING) AS "YR", CAST(1 + user_id % 12 AS STRING) AS "MO",
       'V' || CAST(user_id AS STRING) AS "ID", CAST((event_id + @@run@@) % 2 AS STRING) AS drf_agr,
       event_id % 17 = @@run@@ AS edge
FROM $events WHERE @@which@@
"""
_RUN1 = dict(run=0, which="event_id % 7 <> 3")
_RUN2 = dict(run=1, which="user_id % 12 IN (2, 3) AND event_id % 2 = 0")
TRACK_COLUMNS = ["UID", "YR", "MO", "ID", "drf_agr"]


def _spark_text(text: str) -> str:
    return text.replace('"', "`")


@register("tracking_merge", f"""WITH a AS (SELECT * FROM ({A.duck(_TRACK_ROWS, **_RUN1)}) WHERE NOT edge),
b AS (SELECT * FROM ({A.duck(_TRACK_ROWS, **_RUN2)}) WHERE NOT edge),
u AS (SELECT * FROM b UNION ALL SELECT * FROM a WHERE "UID" NOT IN (SELECT "UID" FROM b))
SELECT "UID", "YR", "MO", "ID", drf_agr, CAST("YR" AS INT) AS year, CAST("MO" AS INT) AS month FROM u""")
def q_tracking_merge(spark: SparkSession, sf: str) -> DataFrame:
    """K9: two tracking runs written as files by id, re-indexed without their
    edge cases and merged into months; the second rewrites its own months."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tracking-{uuid.uuid4().hex[:12]}"
    for n, run in enumerate((_RUN1, _RUN2), 1):
        rows = A.view(spark, sf, _spark_text(_TRACK_ROWS), **run)
        kind = F.when(F.col("edge"), F.lit("edge_case")).otherwise(F.lit("regular"))
        rows.withColumn("kind", kind).drop("edge").write.partitionBy("kind").csv(f"{base}/run{n}", header=True)
        sinks.merge_months(sinks.reindex_tracking(spark, f"{base}/run{n}", TRACK_COLUMNS), f"{base}/months")
    out = spark.read.csv(f"{base}/months", header=True, schema=", ".join(f"`{c}` string" for c in TRACK_COLUMNS) + ", year int, month int")
    return out


# --- S7: months with their date leaks ---------------------------------------------------
_HEAD = ["report_id", "platform_type", "report_timestamp", "latitude"]
_PERIODS = f"""SELECT {', '.join(_HEAD)}, '2024-0' || CAST(CAST(substr(report_id, 11) AS BIGINT) % 3 + 1 AS VARCHAR) AS source_period
FROM ({A.duck(A.HEADER_SQL)})"""


@register("cdm_leaks", f"""WITH h AS ({_PERIODS}),
p AS (SELECT *, coalesce(strftime(date_trunc('month', TRY_CAST(report_timestamp AS TIMESTAMP)), '%Y-%m'), source_period) AS period FROM h),
n AS (SELECT period, count(*) AS leaks_in FROM p WHERE period <> source_period GROUP BY 1)
SELECT {', '.join(f"nullif({c}, '') AS {c}" for c in _HEAD)}, p.period, source_period, p.period <> source_period AS leak,
       coalesce(leaks_in, 0) AS leaks_in FROM p LEFT JOIN n ON n.period = p.period""")
def q_cdm_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Header rows written by month and source month, every month read
    back from its master and leak parts, with the number of its leaks."""
    from tidewater.sources import tables as T

    source = F.concat(F.lit("2024-0"), (F.substr("report_id", F.lit(11)).cast("long") % 3 + 1).cast("string"))
    h = A.view(spark, sf, A.HEADER_SQL).withColumn("source_period", source)
    h = h.withColumn("period", F.coalesce(F.date_format(F.try_to_timestamp("report_timestamp"), "yyyy-MM"), "source_period"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/periods-{uuid.uuid4().hex[:12]}"
    sinks.write_periods(h, _HEAD, path)
    manifest = spark.read.parquet(f"{path}-manifest")
    months = [r.period for r in manifest.select("period").distinct().collect()]
    out = None
    for m in sorted(months):
        rows = T.read_period(spark, path, _HEAD, m).withColumn("period", F.lit(m))
        out = rows if out is None else out.unionByName(rows)
    leaks = manifest.groupBy(F.col("period").alias("_p")).agg(F.sum(F.when(F.col("leak"), F.col("rows")).otherwise(0)).alias("leaks_in"))
    out = out.join(leaks, F.col("period") == F.col("_p")).drop("_p")
    return out.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in _HEAD], "period", "source_period", "leak", "leaks_in")


# --- K11: metadata layouts --------------------------------------------------------------
_META = ["line", "call", "name", "rcnty", "valid_from", "valid_to"]
_ED = A.duck(A.editions_sql("duckdb"))


@register("metadata_layouts", f"""WITH e AS (SELECT {', '.join(_META)}, "call" <> 'NULL' AS named FROM ({_ED})),
m AS (SELECT *, unnest(generate_series(date_trunc('month', valid_from), CAST(valid_to AS TIMESTAMP), INTERVAL 1 MONTH)) AS d FROM e WHERE named),
b AS (SELECT *, row_number() OVER (PARTITION BY d, "call" ORDER BY valid_from DESC, line) AS rk FROM m WHERE d >= valid_from)
SELECT 'country' AS layout, rcnty AS part, 'v4' AS extra, line, CASE WHEN named THEN "call" END AS "call", name, rcnty, valid_from, valid_to FROM e
UNION ALL SELECT 'master', NULL, CASE WHEN named THEN CAST(row_number() OVER (PARTITION BY "call" ORDER BY valid_from, line) AS VARCHAR) END,
  line, CASE WHEN named THEN "call" END, name, rcnty, valid_from, valid_to FROM e
UNION ALL SELECT 'monthly', strftime(d, '%Y-%m'), NULL, line, "call", name, rcnty, valid_from, valid_to FROM b WHERE rk = 1""")
def q_metadata_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Ship metadata by country, as one master table and by month, whole
    rows read back from the files of each layout."""
    from tidewater.plans.q_meta import editions

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/layouts-{uuid.uuid4().hex[:12]}"
    sinks.write_layouts(editions(spark, sf).select(*_META), path, "v4")
    shape = {"country": ("rcnty", "schema"), "master": (None, "record_number"), "monthly": ("month", None)}
    out = None
    for layout, (part, extra) in shape.items():
        files = spark.read.option("inferSchema", "false").csv(f"{path}/{layout}", sep="|", header=True, nullValue="NULL")
        text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
        rows = files.select(F.lit(layout).alias("layout"), text(part).alias("part"), text(extra).alias("extra"),
                            F.col("line").cast("long").alias("line"), "call", "name", "rcnty",
                            F.col("valid_from").cast("date").alias("valid_from"), F.col("valid_to").cast("date").alias("valid_to"))
        out = rows if out is None else out.unionByName(rows)
    return out


# --- A12 / A13 -----------------------------------------------------------------------------
def _field_sql(i: int, name: str) -> str:
    """A value per station, missing for some, 'NULL' or another one in few records."""
    if name in ("longitude", "latitude"):
        return f"CAST(user_id % {7 + i} AS STRING) AS {name}"
    return (f"CASE WHEN user_id % 3 = {i % 3} THEN NULL WHEN (event_id + {i}) % 401 = 0 THEN 'NULL' WHEN (event_id + {i}) % 997 = 0 THEN 'other' "
            f"ELSE '{name}' || CAST(user_id % {5 + i} AS STRING) END AS {name}")


def _records_sql() -> str:
    from tidewater.operators.summaries import UNIQUE_FIELDS

    fields = ",\n  ".join(_field_sql(i, f) for i, f in enumerate(UNIQUE_FIELDS))
    return f"""
SELECT CAST(2000 + event_id % 4 AS INT) AS year, 'V' || CAST(user_id AS STRING) AS primary_station_id, '1' AS primary_station_id_scheme,
  CAST(event_id % 2 + 1 AS STRING) AS station_record_number, CAST(user_id % 3 AS STRING) AS platform_type,
  CAST(2000 + event_id % 4 AS STRING) || '-' || lpad(CAST(1 + event_id % 12 AS STRING), 2, '0') || '-01' AS start_date,
  CAST(2000 + event_id % 4 AS STRING) || '-' || lpad(CAST(1 + event_id % 12 AS STRING), 2, '0') || '-28' AS end_date,
  CAST(user_id % 90 AS DOUBLE) - CAST(event_id % 10 AS DOUBLE) / 10 AS bbox_min_lon, CAST(user_id % 90 + event_id % 7 AS DOUBLE) AS bbox_max_lon,
  CAST(user_id % 50 AS DOUBLE) - CAST(event_id % 8 AS DOUBLE) / 8 AS bbox_min_lat, CAST(user_id % 50 + event_id % 5 AS DOUBLE) AS bbox_max_lat,
  CASE WHEN event_id % 60 = 0 THEN '' ELSE 'Ship ' || CAST(user_id % 50 AS STRING) || CASE WHEN event_id % 9 = 0 THEN 'X' ELSE '' END END AS station_name,
  CASE event_id % 11 WHEN 0 THEN 'NULL' WHEN 1 THEN 'Old,Older' WHEN 2 THEN 'Old' END AS alternative_name,
  CASE event_id % 4 WHEN 0 THEN '85,95' WHEN 1 THEN '107' WHEN 2 THEN '' ELSE '95,36,107' END AS observed_variables,
  {fields}
FROM $events
"""


def _rollup_sql(by: str, all_years: bool) -> str:
    from tidewater.operators.summaries import RECORD_KEYS, UNIQUE_FIELDS

    keys = ", ".join(([by] if by else []) + RECORD_KEYS)
    same = " AND ".join(f"n.{k} = r.{k}" for k in ([by] if by else []) + RECORD_KEYS)
    val = lambda f: f"nullif({f}, 'NULL')"

    def bad(f: str) -> str:
        gap = "" if all_years or f == "platform_sub_type" else f" OR (count(DISTINCT {val(f)}) = 1 AND count({val(f)}) < count(*))"
        return f"(count(DISTINCT {val(f)}) > 1{gap})"

    sel = ", ".join(f"CASE WHEN NOT {bad(f)} THEN min({val(f)}) END AS {f}" for f in UNIQUE_FIELDS)
    conflicts = " || ".join(f"CASE WHEN {bad(f)} THEN ',{f}' ELSE '' END" for f in UNIQUE_FIELDS)
    wrap = (lambda x: f"'{{' || {x} || '}}'") if all_years else (lambda x: x)
    listed = "list_filter(string_split(coalesce({0}, ''), ','), lambda x: x <> '' AND x <> 'NULL')"
    return f"""WITH s AS ({A.duck(_records_sql())}),
nm AS (SELECT {keys}, station_name, min(start_date) AS f FROM s WHERE coalesce(station_name, '') <> '' GROUP BY ALL),
n AS (SELECT {keys}, list(station_name ORDER BY f, station_name) AS names FROM nm GROUP BY ALL),
r AS (SELECT {keys}, min(start_date) AS start_date, max(end_date) AS end_date, min(bbox_min_lon) AS bbox_min_lon,
        max(bbox_max_lon) AS bbox_max_lon, min(bbox_min_lat) AS bbox_min_lat, max(bbox_max_lat) AS bbox_max_lat,
        list_sort(list_distinct(flatten(list({listed.format('alternative_name')})))) AS alts,
        list_sort(list_transform(list_distinct(flatten(list({listed.format('observed_variables')}))), lambda c: CAST(c AS INT))) AS codes,
        {sel}, substr({conflicts}, 2) AS conflicts FROM s GROUP BY ALL)
SELECT r.* EXCLUDE (alts, codes), names[1] AS station_name, {wrap("array_to_string(codes, ',')")} AS observed_variables,
  {wrap("array_to_string(list_concat(coalesce(names[2:], []), list_filter(alts, lambda x: NOT list_contains(coalesce(names[2:], []), x))), ',')")} AS alternative_name
FROM r LEFT JOIN n ON {same}"""


def _year_states(spark: SparkSession, sf: str) -> DataFrame:
    from tidewater.operators import summaries as SU

    return stage_table(SU.station_state(A.view(spark, sf, _records_sql()), ["year"]), "station-years")


@register("station_year_fields", _rollup_sql("year", False))
def q_station_year_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Annual station records with all 24 unique fields and their conflicts."""
    from tidewater.operators import summaries as SU

    return SU.station_rollup(_year_states(spark, sf), ["year"])


@register("station_all_fields", _rollup_sql("", True))
def q_station_all_fields(spark: SparkSession, sf: str) -> DataFrame:
    """All-years station records merged from the states of the years; the
    records themselves are not read again."""
    from tidewater.operators import summaries as SU

    return SU.station_rollup(SU.merge_stations(_year_states(spark, sf).drop("year")), all_years=True)


# --- C3: bundles of one variable ---------------------------------------------------------
def _bundle_query(variable: str) -> None:
    from tidewater.operators import base_qc as BQ
    from tidewater.plans.catalog import _base_flags_sql, _qc_oracle_ctes, _stepwise

    flags = BQ.BUNDLES[variable]
    sql = f"""WITH {_stepwise(_qc_oracle_ctes())}, flags AS MATERIALIZED (SELECT uid, {_base_flags_sql()} FROM qc)
SELECT uid, {', '.join(flags)} FROM flags"""

    @register(f"qc_bundle_{variable}", sql)
    def bundle(spark: SparkSession, sf: str) -> DataFrame:
        return BQ.qc_bundle(A.reports(spark, sf), A.climatology(spark), flags)


for _variable in ("wind", "dat", "slp", "sst"):
    _bundle_query(_variable)
