"""Registered queries: ship-metadata chain (S12, S14, S15, C12, C13, C15, C17, J15,
J20, O4, W17-W19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.operators import metadata as MD
from tidewater.plans import adapters as A
from tidewater.plans.catalog import register

CHECK = ["vsslM", "vssl", "platH", "anmH"]
NUMERIC = ["vsslM", "platH", "anmH"]


def editions(spark: SparkSession, sf: str) -> DataFrame:
    return A.view(spark, sf, A.editions_sql("spark"))


_ED = A.duck(A.editions_sql("duckdb"))


def _phonetic_sql(n: str) -> str:
    body = f"(CASE WHEN starts_with({n}, '(') THEN split_part({n}, ')', 2) ELSE split_part({n}, '(', 1) END)"
    letters = f"regexp_replace(coalesce({body}, ''), '[^a-zA-Z]', '', 'g')"
    digits = f"translate({letters}, '{MD._PHONETIC_FROM}', '{MD._PHONETIC_TO}')"
    col = digits
    for d in range(1, 10):
        col = f"regexp_replace({col}, '{d}+', '{d}', 'g')"
    nz = f"replace({col}, '0', '')"
    padded = f"(CASE WHEN length({nz}) < 4 THEN rpad({nz}, 4, '0') ELSE {nz} END)"
    first = f"substr({letters}, 1, 1)"
    code = (f"(CASE WHEN substr({digits}, 1, 1) = substr({padded}, 1, 1) THEN {first} || substr({padded}, 2) "
            f"ELSE {first} || {padded} END)")
    return f"(CASE WHEN length({n}) < 3 THEN '0000' ELSE {code} END)"


@register("phonetic", f"WITH e AS ({_ED}) SELECT line, name, {_phonetic_sql('name')} AS sx FROM e")
def q_phonetic(spark: SparkSession, sf: str) -> DataFrame:
    """Sound-alike code of every ship name."""
    return editions(spark, sf).select("line", "name", MD.phonetic("name").alias("sx"))


@register("unpack_float", f"""WITH e AS ({_ED}),
x AS (SELECT line, packed, replace(replace(trim(packed), '-', ''), 'I', '1') AS x FROM e)
SELECT line, packed,
  CASE WHEN x IS NULL OR x IN ('', 'NA', 'nan') THEN NULL
       WHEN regexp_full_match(x, '[0-9]+') THEN TRY_CAST(x AS DOUBLE)
       WHEN substr(x, 1, 1) = '{{' THEN 100.0 + TRY_CAST(substr(x, 2, 1) AS DOUBLE)
       ELSE (ascii(x) - 54) * 10.0 + TRY_CAST(substr(x, 2, 1) AS DOUBLE) END AS height
FROM x""")
def q_unpack_float(spark: SparkSession, sf: str) -> DataFrame:
    """Packed-float height decoding."""
    return editions(spark, sf).select("line", "packed", MD.unpack_float("packed").alias("height"))


@register("split_numbered", f"""WITH e AS ({_ED}), s AS (SELECT line, string_split_regex(coalesce(brm, ''), '[ ,]') AS p FROM e)
SELECT line, coalesce(p[1], 'NULL') AS brm1, coalesce(p[2], 'NULL') AS brm2, coalesce(p[3], 'NULL') AS brm3 FROM s""")
def q_split_numbered(spark: SparkSession, sf: str) -> DataFrame:
    """A multi-valued field split into numbered columns."""
    return MD.split_numbered(editions(spark, sf).select("line", "brm"), "brm", "[ ,]", 3)


@register("split_side", f"""WITH e AS ({_ED}), d AS (SELECT line, anDC, regexp_replace(anDC, '[^0-9.]', '', 'g') AS dg FROM e)
SELECT line, CASE WHEN anDC IS NULL THEN NULL WHEN regexp_matches(anDC, '[Pp]') THEN 'PORT'
                  WHEN regexp_matches(anDC, '[Ss]') THEN 'STARBOARD' END AS anSC,
       TRY_CAST(CASE WHEN dg = '' THEN NULL ELSE dg END AS DOUBLE) AS anDC
FROM d""")
def q_split_side(spark: SparkSession, sf: str) -> DataFrame:
    """Anemometer side from the distance field, distance cast to number."""
    return MD.split_side(editions(spark, sf).select("line", "anDC"), "anDC", "anSC")


@register("record_number", f"""WITH e AS ({_ED})
SELECT line, call, row_number() OVER (PARTITION BY call ORDER BY valid_from, line) AS record_number FROM e""")
def q_record_number(spark: SparkSession, sf: str) -> DataFrame:
    """Record number per call sign by validity start."""
    return MD.record_number(editions(spark, sf), "call", "line").select("line", "call", "record_number")


@register("renumber_intervals", f"""WITH e AS ({_ED}),
w AS (SELECT *, row_number() OVER w - 1 AS rn, count(*) OVER (PARTITION BY call) AS n, lead(valid_from) OVER w AS nx
      FROM e WINDOW w AS (PARTITION BY call ORDER BY valid_from, line)),
v AS (SELECT *, CASE WHEN nx IS NOT NULL AND datediff('day', nx, valid_to) BETWEEN -3625 AND 0 THEN nx
                     ELSE valid_to END AS vt0 FROM w)
SELECT line, call, rn AS record_number,
  CAST(CASE WHEN rn = 0 THEN valid_from - INTERVAL 12 MONTH ELSE valid_from END AS DATE) AS valid_from,
  CAST(CASE WHEN rn = n - 1 THEN vt0 + INTERVAL 60 MONTH ELSE vt0 END AS DATE) AS valid_to
FROM v""")
def q_renumber_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Record renumbering and validity gap closing per platform."""
    out = MD.renumber_intervals(editions(spark, sf), key="call", tie="line")
    return out.select("line", "call", "record_number", "valid_from", "valid_to")


@register("best_record", f"""WITH e AS ({_ED}),
m AS (SELECT e.*, unnest(generate_series(
        CAST(CASE WHEN valid_from > date_trunc('month', valid_from) THEN date_trunc('month', valid_from) + INTERVAL 1 MONTH
                  ELSE date_trunc('month', valid_from) END AS DATE),
        CAST(valid_to - INTERVAL 1 DAY AS DATE), INTERVAL 1 MONTH)) AS month FROM e),
c AS (SELECT *, count(*) OVER k AS cnt, min(vsslM) OVER k AS minc FROM m WINDOW k AS (PARTITION BY month, call)),
c2 AS (SELECT *, sum(CASE WHEN vsslM = minc THEN 1 ELSE 0 END) OVER k AS nb,
              max(CASE WHEN vsslM = minc THEN valid_from END) OVER k AS maxvf FROM c WINDOW k AS (PARTITION BY month, call)),
c3 AS (SELECT *, vsslM = minc AND (nb = 1 OR valid_from = maxvf) AS b2 FROM c2),
c4 AS (SELECT *, sum(CASE WHEN b2 THEN 1 ELSE 0 END) OVER (PARTITION BY month, call) AS nb2 FROM c3)
SELECT CAST(month AS DATE) AS month, call, line,
       call <> 'NULL' AND call IS NOT NULL AND (cnt = 1 OR (b2 AND nb2 = 1)) AS kept
FROM c4""")
def q_best_record(spark: SparkSession, sf: str) -> DataFrame:
    """J15 + W19: records valid in each month, and the single best record
    per call sign and month (lowest class, then latest start)."""
    mon = MD.valid_months(editions(spark, sf), "1900-01-01", "2100-12-01")
    out = MD.best_record(mon, key="call", cls="vsslM")
    return out.select("month", "call", "line", "kept")


def _edition_duplicates_sql() -> str:
    def gone(c: str) -> str:
        return f"({c} IS NULL OR CAST({c} AS VARCHAR) IN ('NULL', '-999999', '-999999.0'))"

    every = [*CHECK, "name", "rcnty", "vssl"]
    full = " + ".join(f"(CASE WHEN {gone(c)} THEN 0 ELSE 1 END)" for c in every)
    fits = " AND ".join(f"({gone('a.' + c)} OR {gone('b.' + c)} OR a.{c} = b.{c})" for c in CHECK)
    low = {c: f"(CASE WHEN a.line < b.line THEN a.{c} ELSE b.{c} END)" for c in CHECK}
    high = {c: f"(CASE WHEN a.line < b.line THEN b.{c} ELSE a.{c} END)" for c in CHECK}
    merged = ", ".join(f"CASE WHEN rule = 'merge' AND pick THEN (CASE WHEN {gone('lo_' + c)} THEN hi_{c} ELSE lo_{c} END) "
                       f"ELSE {c} END AS {c}" for c in CHECK)
    sides = ", ".join(f"{low[c]} AS lo_{c}, {high[c]} AS hi_{c}" for c in CHECK)
    return f"""WITH e AS ({_ED}),
d AS (SELECT * EXCLUDE (line), min(line) AS line FROM e GROUP BY ALL),
k AS (SELECT *, count(*) OVER (PARTITION BY edition, call) AS c, {_phonetic_sql('name')} AS ph, {full} AS score
      FROM d WHERE NOT {gone('call')}),
p AS (SELECT a.*, {sides},
        CASE WHEN a.rcnty IS DISTINCT FROM b.rcnty THEN 'both' WHEN coalesce(a.ph <> b.ph, true) THEN 'none'
             WHEN {fits} THEN 'merge' WHEN a.vsslM <> b.vsslM THEN 'class' WHEN a.score <> b.score THEN 'score'
             ELSE 'none' END AS rule,
        a.score > b.score OR (a.score = b.score AND a.line < b.line) AS pick, a.vsslM < b.vsslM AS higher
      FROM k a JOIN k b ON a.edition = b.edition AND a.call = b.call AND a.line <> b.line WHERE a.c = 2)
SELECT line, call, CASE rule WHEN 'both' THEN true WHEN 'merge' THEN pick WHEN 'class' THEN higher WHEN 'score' THEN pick
       ELSE false END AS kept, {merged} FROM p
UNION ALL SELECT line, call, c = 1, {', '.join(CHECK)} FROM k WHERE c <> 2
UNION ALL SELECT line, call, true, {', '.join(CHECK)} FROM d WHERE {gone('call')}"""


@register("edition_duplicates", _edition_duplicates_sql())
def q_edition_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicate resolution inside every edition."""
    e = editions(spark, sf)
    out = MD.resolve_edition_duplicates(e, CHECK, CHECK + ["name", "rcnty", "vssl"], country="rcnty", key="call",
                                        edition="edition")
    return out.select("line", "call", "kept", *CHECK)


# longest common subsequence of the pairs (a, b) of a table ``pairs``, one character of ``a`` a step
_LCS_SQL = """lcs(a, b, i, cells) AS (
  SELECT a, b, 0, list_transform(range(0, length(b) + 1), lambda x: 0) FROM pairs
  UNION ALL
  SELECT a, b, i + 1, list_concat([0], list_transform(range(1, length(b) + 1), lambda j: list_max(
    list_transform(range(1, j + 1), lambda k: CASE WHEN substr(b, k, 1) = substr(a, i + 1, 1) THEN cells[k] + 1
                                                   ELSE cells[k + 1] END))))
  FROM lcs WHERE i < length(a)),
likeness AS (SELECT a, b, 2.0 * cells[length(b) + 1] / (length(a) + length(b)) AS ratio FROM lcs WHERE i = length(a))"""


@register("name_similarity", f"""WITH RECURSIVE e AS ({_ED}),
n AS (SELECT line, name, lag(name) OVER (PARTITION BY rcnty, call ORDER BY edition, line) AS before FROM e
      WHERE call <> 'NULL'),
pairs AS (SELECT DISTINCT name AS a, before AS b FROM n WHERE before IS NOT NULL), {_LCS_SQL}
SELECT line, round(ratio, 9) AS ratio, ratio > 0.8 AS alike FROM n JOIN likeness ON name = a AND before = b""")
def q_name_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """Similarity of every ship name with the one before it under the same call sign."""
    w = Window.partitionBy("rcnty", "call").orderBy("edition", "line")
    named = editions(spark, sf).where("call <> 'NULL'")  # reports without a call sign would be one group
    n = named.select("line", "name", F.lag("name").over(w).alias("before")).where("before IS NOT NULL")
    name, before = F.col("name"), F.col("before")
    return n.select("line", F.round(MD.name_similarity(name, before), 9).alias("ratio"),
                    MD.names_alike(name, before, 0.8).alias("alike"))


_LINKED = ["line", "call", "rcnty", "sx", "record_number", "name", "alt_names", "source_file", "valid_from", "valid_to",
           *CHECK]


def _linked_sql() -> str:
    """The linkage with one state row per call sign: step n takes the n-th row
    of every call sign; a record leaves in the column ``closed`` of the step
    after which no row can reach it."""
    def gone(c: str) -> str:
        return f"({c} IS NULL OR CAST({c} AS VARCHAR) IN ('NULL', '-999999', '-999999.0'))"

    def clash(columns: list[str]) -> str:
        return " OR ".join(f"(r.{c} IS DISTINCT FROM known.{c} AND NOT {gone('r.' + c)} AND NOT {gone('known.' + c)})"
                           for c in columns)

    def struct(values: dict[str, str]) -> str:
        return "{" + ", ".join(f"'{c}': {v}" for c, v in values.items()) + "}"

    texts = [c for c in CHECK if c not in NUMERIC]
    plain = {c: f"r.{c}" for c in _LINKED}
    merged = {c: f"known.{c}" for c in _LINKED} | {
        c: f"CASE WHEN {gone('known.' + c)} THEN r.{c} ELSE known.{c} END" for c in CHECK} | {
        "valid_from": "least(known.valid_from, r.valid_from)", "valid_to": "greatest(known.valid_to, r.valid_to)",
        "alt_names": "CASE WHEN r.name = known.name OR contains(known.alt_names, r.name) THEN known.alt_names "
                     "ELSE known.alt_names || ';' || r.name END",
        "source_file": "known.source_file || ';' || r.source_file"}
    fresh = struct(plain | {"record_number": "coalesce(known.record_number, 0) + 1"})
    out = ", ".join(f"x.{c} AS {c}" for c in _LINKED)
    return f"""e AS (SELECT * EXCLUDE (line, packed, brm, anDC), min(line) AS line FROM ({_ED}) GROUP BY ALL),
d AS (SELECT *, {_phonetic_sql('name')} AS sx, 1 AS record_number, '' AS alt_names,
             CAST(edition AS VARCHAR) AS source_file FROM e),
q AS (SELECT edition, {struct({c: c for c in _LINKED})} AS r, rcnty AS country, call AS callsign,
             row_number() OVER k AS pos, count(*) OVER (PARTITION BY rcnty, call) AS n
      FROM d WHERE NOT {gone('call')} WINDOW k AS (PARTITION BY rcnty, call ORDER BY edition, line)),
pairs AS (SELECT DISTINCT x.r.name AS a, y.r.name AS b FROM q x JOIN q y
          ON x.country = y.country AND x.callsign = y.callsign AND x.r.sx <> y.r.sx), {_LCS_SQL},
alike AS (SELECT a, b FROM likeness WHERE ratio > 0.8),
fold(country, callsign, pos, n, edition, known, added, closed) AS (
  SELECT country, callsign, pos, n, edition, CASE WHEN false THEN r END, r, CASE WHEN false THEN r END FROM q WHERE pos = 1
  UNION ALL
  SELECT country, callsign, pos, n, edition, CASE rule WHEN 'absorb' THEN {struct(merged)} ELSE known END,
    CASE WHEN rule = 'new' AND added IS NULL THEN {fresh} ELSE added END,
    CASE WHEN rule = 'new' AND added IS NOT NULL THEN {fresh} ELSE closed END
  FROM (SELECT t.*, CASE WHEN known IS NULL THEN 'new' WHEN NOT (known.sx = r.sx OR alike.a IS NOT NULL) THEN 'new'
                         WHEN {clash(NUMERIC)} THEN 'drop' WHEN {clash(texts)} THEN 'new' ELSE 'absorb' END AS rule
        FROM (SELECT q.*, CASE WHEN q.edition <> f.edition AND f.added IS NOT NULL THEN f.added ELSE f.known END AS known,
                     CASE WHEN q.edition = f.edition THEN f.added END AS added,
                     CASE WHEN q.edition <> f.edition AND f.added IS NOT NULL THEN f.known END AS closed
              FROM fold f JOIN q ON q.country = f.country AND q.callsign = f.callsign AND q.pos = f.pos + 1) t
        LEFT JOIN alike ON known.name = alike.a AND r.name = alike.b)),
linked AS (SELECT {out} FROM (SELECT closed AS x FROM fold UNION ALL SELECT known FROM fold WHERE pos = n
                              UNION ALL SELECT added FROM fold WHERE pos = n) WHERE x IS NOT NULL
  UNION ALL SELECT {', '.join('d.' + c for c in _LINKED)} FROM d
  JOIN (SELECT rcnty, min(edition) AS edition FROM d GROUP BY rcnty) f USING (rcnty, edition) WHERE {gone('call')})"""


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    return MD.link_editions(editions(spark, sf).drop("packed", "brm", "anDC"), CHECK, NUMERIC)


@register("link_editions", f"WITH RECURSIVE {_linked_sql()} SELECT * EXCLUDE (line) FROM linked")
def q_link_editions(spark: SparkSession, sf: str) -> DataFrame:
    """J20 + C13: master records linked across the yearly editions per
    (country, call sign), with their sources."""
    return _linked(spark, sf).select(*[c for c in _LINKED if c != "line"])


@register("master_records", f"""WITH RECURSIVE {_linked_sql()},
u AS (SELECT *, coalesce(call, 'NULL') || '-' || coalesce(sx, 'NULL') || '-' || coalesce(rcnty, 'NULL') AS uid FROM linked),
w AS (SELECT *, row_number() OVER k - 1 AS rn, count(*) OVER (PARTITION BY uid) AS n, lead(valid_from) OVER k AS nx
      FROM u WINDOW k AS (PARTITION BY uid ORDER BY valid_from, line)),
v AS (SELECT *, CASE WHEN datediff('day', nx, valid_to) BETWEEN -3625 AND 0 THEN nx ELSE valid_to END AS vt FROM w)
SELECT uid, rn AS record_number, name, alt_names, source_file, {', '.join(CHECK)},
  CAST(CASE WHEN rn = 0 THEN valid_from - INTERVAL 12 MONTH ELSE valid_from END AS DATE) AS valid_from,
  CAST(CASE WHEN rn = n - 1 THEN vt + INTERVAL 60 MONTH ELSE vt END AS DATE) AS valid_to FROM v""")
def q_master_records(spark: SparkSession, sf: str) -> DataFrame:
    """J20 + W17: the master file, linked records under uids, renumbered by
    date, validity periods closed up."""
    return MD.master_records(_linked(spark, sf)).select(
        "uid", "record_number", "name", "alt_names", "source_file", *CHECK, "valid_from", "valid_to")


@register("anemometer_side", f"""WITH e AS ({_ED}), s AS (SELECT line, CASE WHEN starts_with(anDC, 's') THEN NULL ELSE 'C' END AS side,
  CASE WHEN anDC = 'X' THEN 'PORT' ELSE anDC END AS dist FROM e)
SELECT line, CASE WHEN regexp_matches(coalesce(dist, ''), '^[a-zA-Z]') THEN dist ELSE side END AS side,
       CASE WHEN regexp_matches(coalesce(dist, ''), '^[a-zA-Z]') THEN NULL ELSE dist END AS dist FROM s""")
def q_anemometer_side(spark: SparkSession, sf: str) -> DataFrame:
    """C17: a side that stands in the distance of the second anemometer moves to the first one's side."""
    e = editions(spark, sf).selectExpr("line", "CASE WHEN startswith(anDC, 's') THEN NULL ELSE 'C' END AS side",
                                       "CASE WHEN anDC = 'X' THEN 'PORT' ELSE anDC END AS dist")
    return MD.repair_anemometer_side(e, dist2="dist", side1="side")


@register("distinct_descriptions", f"""SELECT call, name, rcnty, vsslM, vssl, min(line) AS line FROM ({_ED})
GROUP BY ALL""")
def q_distinct_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    """Exact duplicates of ship descriptions, the first one kept."""
    return MD.keep_first(editions(spark, sf).select("call", "name", "rcnty", "vsslM", "vssl", "line"), "line")


_SPECS = {"thermometer1_id": ("TH1", ["platH_n"], []), "hygrometer1_id": ("HY1", [], ["vssl"]),
          "anemometer1_id": ("AN1", ["anmH_n"], ["anDC"])}


@register("instrument_ids", f"""WITH e AS ({_ED}),
u AS (SELECT *, call || '-' || {_phonetic_sql('name')} || '-' || rcnty AS uid, 1 AS record_number,
             CASE WHEN platH = -999999 THEN NULL ELSE platH END AS platH_n,
             CASE WHEN anmH = -999999 THEN NULL ELSE anmH END AS anmH_n FROM e)
SELECT line,
  CASE WHEN platH_n IS NOT NULL THEN uid || '-1-TH1' ELSE '' END AS thermometer1_id,
  CASE WHEN coalesce(vssl <> 'NULL', true) THEN uid || '-1-HY1' ELSE '' END AS hygrometer1_id,
  CASE WHEN anmH_n IS NOT NULL OR coalesce(anDC <> 'NULL', true) THEN uid || '-1-AN1' ELSE '' END AS anemometer1_id
FROM u""")
def q_instrument_ids(spark: SparkSession, sf: str) -> DataFrame:
    """C17: instrument identifiers for records with any instrument attribute."""
    e = editions(spark, sf)
    e = e.withColumns({
        "uid": F.concat_ws("-", F.col("call"), MD.phonetic("name"), F.col("rcnty")),
        "record_number": F.lit(1),
        "platH_n": F.when(F.col("platH") == -999999, F.lit(None)).otherwise(F.col("platH")),
        "anmH_n": F.when(F.col("anmH") == -999999, F.lit(None)).otherwise(F.col("anmH")),
    })
    return MD.instrument_ids(e, _SPECS).select("line", *_SPECS)


_RANGES = {"platH": (0.0, 25.0), "anmH": (0.0, 20.0)}


def _corr_sql() -> str:
    c = A.duck(A.UNIT_CORRECTIONS_SQL)
    parts = []
    for f, (lo, hi) in _RANGES.items():
        parts.append(f"""(SELECT edition, rcnty, factor AS f_{f}, all_values AS a_{f} FROM ({c}) WHERE field = '{f}') k_{f}""")
    return parts


def _corrected_sql() -> str:
    kp, ka = _corr_sql()
    exprs = []
    for f, (lo, hi) in _RANGES.items():
        present = f"({f} IS NOT NULL AND abs({f} + 999999.0) >= 1e-6)"
        hit = (f"(f_{f} IS NOT NULL AND ((a_{f} = 1 AND {present}) OR "
               f"(a_{f} = 0 AND {present} AND NOT ({f} BETWEEN {lo} AND {hi}))))")
        exprs.append(f"CASE WHEN {hit} THEN {f} * f_{f} ELSE {f} END AS {f}")
    return f"""SELECT e.line, e.edition, e.rcnty, {', '.join(exprs)}
FROM ({_ED}) e LEFT JOIN {kp} ON k_platH.edition = e.edition AND k_platH.rcnty = e.rcnty
              LEFT JOIN {ka} ON k_anmH.edition = e.edition AND k_anmH.rcnty = e.rcnty"""


@register("correct_units", f"SELECT line, round(platH, 6) AS platH, round(anmH, 6) AS anmH FROM ({_corrected_sql()})")
def q_correct_units(spark: SparkSession, sf: str) -> DataFrame:
    """C14: per edition/country unit corrections of heights."""
    out = MD.correct_units(editions(spark, sf), A.view(spark, sf, A.UNIT_CORRECTIONS_SQL), _RANGES)
    return out.select("line", F.round("platH", 6).alias("platH"), F.round("anmH", 6).alias("anmH"))


def _audit_sql() -> str:
    un = " UNION ALL ".join(
        f"SELECT edition, rcnty, '{f}' AS field, {f} AS v, {lo} AS lo, {hi} AS hi FROM c" for f, (lo, hi) in _RANGES.items())
    return f"""WITH c AS ({_corrected_sql()}), s AS ({un})
SELECT edition, rcnty, field, count(*) AS n,
       sum(CASE WHEN v IS NOT NULL AND abs(v + 999999.0) >= 1e-6 AND NOT (v BETWEEN lo AND hi) THEN 1 ELSE 0 END) AS n_bad,
       sum(CASE WHEN v IS NOT NULL AND abs(v + 999999.0) >= 1e-6 AND NOT (v BETWEEN lo AND hi) THEN 1 ELSE 0 END) / count(*) > 0.05
         AND count(*) > 10 AS large
FROM s GROUP BY 1, 2, 3"""


@register("range_audit", _audit_sql())
def q_range_audit(spark: SparkSession, sf: str) -> DataFrame:
    """C14: audit of out-of-range values per edition, country and field."""
    out = MD.correct_units(editions(spark, sf), A.view(spark, sf, A.UNIT_CORRECTIONS_SQL), _RANGES)
    return MD.range_audit(out, _RANGES)
