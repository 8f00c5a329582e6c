"""Ship-metadata operators.

Editions are small per call sign but large in total; every per-call-sign
step first counts rows per call sign with a partial aggregate, so only
call signs with a bounded number of rows (2 for edition duplicates) enter
a window, and hot call signs are handled by aggregate rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType

from tidewater.session import ship_package

MISSING_TEXT = "NULL"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- C12: phonetic code -------------------------------------------------------------
# FIXED VALUES: letter groups and their digits
PHONETIC_GROUPS = [("aeiouyhw", "0"), ("bfpv", "1"), ("cgjkqsxz", "2"), ("dt", "3"), ("l", "4"),
                   ("mn", "5"), ("r", "6")]
_PHONETIC_FROM = "".join(g + g.upper() for g, _ in PHONETIC_GROUPS)
_PHONETIC_TO = "".join(d * (2 * len(g)) for g, d in PHONETIC_GROUPS)
def phonetic(name) -> Column:
    """Sound-alike code of a ship name: text in leading parentheses (or
    after '(') is dropped, letters only; vowels and H/W/Y are 0; runs of one
    digit collapse; zeros removed; right-padded with 0 to at least 4; the
    first letter replaces (or precedes) the first digit.  Names shorter
    than 3 characters -> '0000'.  (Not truncated to 4.)"""
    n = _c(name)
    body = F.when(n.startswith("("), F.try_element_at(F.split(n, r"\)"), F.lit(2))).otherwise(F.split(n, r"\(")[0])
    letters = F.regexp_replace(F.coalesce(body, F.lit("")), "[^a-zA-Z]", "")
    first = F.substring(letters, 1, 1)
    digits = F.translate(letters, _PHONETIC_FROM, _PHONETIC_TO)
    number1 = F.substring(digits, 1, 1)
    collapsed = F.regexp_replace(digits, r"([1-9])\1+", "$1")
    nz = F.regexp_replace(collapsed, "0", "")
    padded = F.when(F.length(nz) < 4, F.rpad(nz, 4, "0")).otherwise(nz)
    code = F.when(number1 == F.substring(padded, 1, 1), F.concat(first, F.substr(padded, F.lit(2)))) \
        .otherwise(F.concat(first, padded))
    return F.when(F.length(n) < 3, F.lit("0000")).otherwise(code)


# --- C13: name similarity -------------------------------------------------------------
def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence: the usual table, a row at a
    time as the bits of one integer (a zero where the row rises)."""
    places: dict[str, int] = {}
    for j, char in enumerate(b):
        places[char] = places.get(char, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for char in a:
        hit = row & places.get(char, 0)
        row = (row + hit | row - hit) & full
    return len(b) - row.bit_count()


def _ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 1.0 if a == b else 2.0 * _common(a, b) / total


@F.pandas_udf(DoubleType())
def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def name_similarity(a, b) -> Column:
    """Indel ratio of two names, 2 * common subsequence / total length; 1 for
    two empty names (a null name is empty)."""
    return _ratios(F.coalesce(_c(a), F.lit("")), F.coalesce(_c(b), F.lit("")))


def names_alike(a: Column, b: Column, threshold: float) -> Column:
    """``name_similarity(a, b) > threshold``."""
    return name_similarity(a, b) > threshold


def regular_name(col) -> Column:
    """A ship's name with single spaces, single initials dotted
    ('J F K' -> 'J. F K' as matches may not overlap), and a space between a
    dot and the letter after it."""
    x = F.coalesce(_c(col), F.lit(MISSING_TEXT))
    x = F.regexp_replace(x, r"\s+", " ")
    x = F.regexp_replace(x, "( )([A-Z])( )", "$1$2.$3")
    return F.regexp_replace(x, r"([A-Z])(\.)([A-Z])", "$1$2 $3")


# --- S12 / S14 / S15: edition field decoders -----------------------------------------
def unpack_float(col) -> Column:
    """Packed heights: digits -> number; '{d' -> 100 + d; 'Ld' -> (ord(L) -
    54) * 10 + d; '-' removed and 'I' read as 1; empty/NA -> NULL."""
    x = F.replace(F.replace(F.trim(_c(col)), F.lit("-"), F.lit("")), F.lit("I"), F.lit("1"))
    numeric = x.rlike(r"^[0-9]+$")
    d1 = F.substring(x, 2, 1).try_cast("double")
    packed = F.when(F.substring(x, 1, 1) == "{", 100.0 + d1).otherwise((F.ascii(x) - 54) * 10.0 + d1)
    return F.when(x.isNull() | x.isin("", "NA", "nan"), F.lit(None).cast("double")) \
        .when(numeric, x.try_cast("double")).otherwise(packed)


def split_numbered(df: DataFrame, col: str, pattern: str, n: int | None = None) -> DataFrame:
    """Split ``col`` by regex into ``<col>1..<col>n`` (missing -> 'NULL').
    Without ``n`` the widest value of ``df`` decides (one aggregate); with
    ``n`` (a schema's width) a wider value keeps its rest in the last column."""
    base = "".join(ch for ch in col if not ch.isdigit())
    text = F.coalesce(F.col(col).cast("string"), F.lit(""))
    if n is None:
        n = df.agg(F.max(F.size(F.split(text, pattern))).alias("n")).first()["n"] or 1
    parts = F.split(text, pattern, n)
    return df.withColumns({f"{base}{i + 1}": F.coalesce(F.try_element_at(parts, F.lit(i + 1)), F.lit(MISSING_TEXT))
                           for i in range(n)}).drop(col)


def split_side(df: DataFrame, field: str, side_field: str) -> DataFrame:
    """Anemometer distance like '12P' -> side PORT/STARBOARD from the letter,
    distance stripped to digits and '.', cast to double (empty -> NULL)."""
    v = F.col(field)
    side = F.when(v.isNull(), F.lit(None)).when(v.rlike("[Pp]"), F.lit("PORT")) \
        .when(v.rlike("[Ss]"), F.lit("STARBOARD"))
    digits = F.regexp_replace(v, r"[^0-9.]", "")
    return df.withColumns({side_field: side,
                           field: F.when(digits == "", F.lit(None)).otherwise(digits).try_cast("double")})


# --- W18 / W17: record numbers and validity intervals ----------------------------------
def record_number(df: DataFrame, key: str = "callsign", tie: str = "uid") -> DataFrame:
    """record_number = 1.. per call sign in valid_from order (ties by ``tie``)."""
    w = Window.partitionBy(key).orderBy("valid_from", tie)
    return df.withColumn("record_number", F.row_number().over(w))


def renumber_intervals(df: DataFrame, key: str = "uid", gap_days: int = 3625,
                       tie: str = "record_number") -> DataFrame:
    """Per linked platform: record numbers 0..n-1 by valid_from; a
    valid_to at most ``gap_days`` before the next valid_from is moved to it;
    the first valid_from opens 12 months earlier, the last valid_to closes
    60 months later."""
    w = Window.partitionBy(key).orderBy("valid_from", tie)
    d = df.withColumns({"_rn": F.row_number().over(w) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy(key)),
                        "_next": F.lead("valid_from").over(w)})
    diff = F.datediff(F.col("valid_to"), F.col("_next"))
    vt = F.when(F.col("_next").isNotNull() & (diff >= -gap_days) & (diff <= 0), F.col("_next")) \
        .otherwise(F.col("valid_to"))
    vt = F.when(F.col("_rn") == F.col("_n") - 1, F.add_months(vt, 60)).otherwise(vt)
    vf = F.when(F.col("_rn") == 0, F.add_months(F.col("valid_from"), -12)).otherwise(F.col("valid_from"))
    return d.withColumns({"record_number": F.col("_rn"), "valid_from": vf, "valid_to": vt}) \
        .drop("_rn", "_n", "_next")


# --- J15 / W19: monthly validity and best record -----------------------------------------
def valid_months(df: DataFrame, first: str, last: str) -> DataFrame:
    """Each record exploded to the first-of-month dates d in
    [first, last] with valid_from <= d < valid_to (an interval join by
    explode + equi keys, never a range join)."""
    start = F.greatest(F.trunc(F.col("valid_from"), "MM"), F.lit(first).cast("date"))
    start = F.when(F.col("valid_from") > start, F.add_months(start, 1)).otherwise(start)
    end = F.least(F.col("valid_to"), F.date_add(F.lit(last).cast("date"), 1))
    months = F.sequence(start, F.date_sub(end, 1), F.expr("interval 1 month"))
    d = df.withColumn("_months", F.when(start < end, months).otherwise(F.array().cast("array<date>")))
    return d.withColumn("month", F.explode("_months")).drop("_months")


def best_record(monthly: DataFrame, key: str = "callsign", cls: str = "meteorological_vessel_type") -> DataFrame:
    """Per (month, call sign) keep the single record of the lowest
    vessel class, ties broken by the latest valid_from; unresolved ties and
    missing call signs are rejected (``kept`` false)."""
    named = F.col(key).isNotNull() & (F.col(key) != MISSING_TEXT)
    rest = monthly.where(~F.coalesce(named, F.lit(False))).withColumn("kept", F.lit(False))
    w = Window.partitionBy("month", key)
    d = monthly.where(named).withColumn("_cnt", F.count(F.lit(1)).over(w))
    d = d.withColumn("_minc", F.min(cls).over(w))
    d = d.withColumn("_best", F.col(cls) == F.col("_minc"))
    d = d.withColumn("_nb", F.sum(F.col("_best").cast("int")).over(w))
    d = d.withColumn("_maxvf", F.max(F.when(F.col("_best"), F.col("valid_from"))).over(w))
    d = d.withColumn("_b2", F.col("_best") & ((F.col("_nb") == 1) | (F.col("valid_from") == F.col("_maxvf"))))
    d = d.withColumn("_nb2", F.sum(F.col("_b2").cast("int")).over(w))
    kept = (F.col("_cnt") == 1) | (F.col("_b2") & (F.col("_nb2") == 1))
    return d.withColumn("kept", kept).drop("_cnt", "_minc", "_best", "_nb", "_maxvf", "_b2", "_nb2").unionByName(rest)


# --- C15: duplicates within one edition --------------------------------------------------
def _missing(c: Column) -> Column:
    return c.isNull() | c.cast("string").isin(MISSING_TEXT, "-999999", "-999999.0")


def resolve_edition_duplicates(df: DataFrame, check: list[str], all_cols: list[str], country: str = "rcnty",
                               key: str = "call", order: str = "line", edition: str | None = None) -> DataFrame:
    """Within an edition: call signs seen once (or missing) are kept; more
    than twice rejected; twice: same country and sound-alike name ->
    compatible rows (every check field equal or missing) merge into the most
    complete row, else the single highest class, else the single most
    complete row, else both rejected; same country, other name -> both
    rejected; different countries -> both kept.  Returns rows with ``kept``
    (merged rows carry the filled-in check fields).  ``edition`` names the
    edition column when ``df`` holds several.  Rows without a call sign are
    split off before the grouping; only call signs with exactly two rows
    enter a window (partition size 2)."""
    d = keep_first(df, order)
    keys = [key] + ([edition] if edition else [])
    unnamed = d.where(_missing(F.col(key))).withColumn("kept", F.lit(True))
    d = d.where(~_missing(F.col(key)))
    cnt = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    d = d.join(cnt, keys)
    miss = [_missing(F.col(c)).cast("int") for c in all_cols]
    d = d.withColumn("_cmp", (len(all_cols) - reduce(lambda a, b: a + b, miss)) / float(len(all_cols)))
    d = d.withColumn("_ph", phonetic(F.col("name")))
    pair = d.where(F.col("_cnt") == 2)
    w = Window.partitionBy(*keys).orderBy(order)
    wa = Window.partitionBy(*keys)
    pair = pair.withColumn("_pos", F.row_number().over(w))
    other = {c: F.max(F.when(F.col("_pos") == 1, F.col(c))).over(wa) for c in check + [country, "_ph"]}
    other2 = {c: F.max(F.when(F.col("_pos") == 2, F.col(c))).over(wa) for c in check + [country, "_ph"]}
    pair = pair.withColumns({f"_a_{c}": e for c, e in other.items()})
    pair = pair.withColumns({f"_b_{c}": e for c, e in other2.items()})
    same_country = F.col(f"_a_{country}").eqNullSafe(F.col(f"_b_{country}"))
    same_name = F.col("_a__ph") == F.col("_b__ph")
    compatible = reduce(lambda a, b: a & b, [
        _missing(F.col(f"_a_{c}")) | _missing(F.col(f"_b_{c}")) | (F.col(f"_a_{c}") == F.col(f"_b_{c}"))
        for c in check])
    pair = pair.withColumns({
        "_maxcmp": F.max("_cmp").over(wa), "_mincls": F.min("vsslM").over(wa),
    })
    pair = pair.withColumns({
        "_is_mc": F.col("_cmp") == F.col("_maxcmp"), "_is_hc": F.col("vsslM") == F.col("_mincls"),
    })
    pair = pair.withColumns({
        "_n_mc": F.sum(F.col("_is_mc").cast("int")).over(wa), "_n_hc": F.sum(F.col("_is_hc").cast("int")).over(wa),
        "_first_mc": F.min(F.when(F.col("_is_mc"), F.col("_pos"))).over(wa),
    })
    merge_pick = F.col("_pos") == F.col("_first_mc")
    kept = (F.when(same_country & same_name & compatible, merge_pick)
            .when(same_country & same_name & (F.col("_n_hc") == 1), F.col("_is_hc"))
            .when(same_country & same_name & (F.col("_n_mc") == 1), F.col("_is_mc"))
            .when(same_country, F.lit(False))
            .otherwise(F.lit(True)))
    merged = {c: F.when(same_country & same_name & compatible & merge_pick,
                        F.when(_missing(F.col(f"_a_{c}")), F.col(f"_b_{c}")).otherwise(F.col(f"_a_{c}")))
              .otherwise(F.col(c)) for c in check}
    pair = pair.withColumn("kept", kept).withColumns(merged)
    pair = pair.drop(*[c for c in pair.columns if c.startswith("_a_") or c.startswith("_b_")],
                     "_pos", "_maxcmp", "_mincls", "_is_mc", "_is_hc", "_n_mc", "_n_hc", "_first_mc")
    single = d.where(F.col("_cnt") == 1).withColumn("kept", F.lit(True))
    many = d.where(F.col("_cnt") > 2).withColumn("kept", F.lit(False))
    return single.unionByName(pair).unionByName(many).drop("_cnt", "_cmp", "_ph").unionByName(unnamed)


# --- J20: record linkage of successive editions --------------------------------------
def _gone(v) -> bool:
    return v is None or str(v) in (MISSING_TEXT, "-999999", "-999999.0")


def _clash(known: dict, row: dict, columns: list[str]) -> bool:
    """Two values that are there and differ (NaN equals NaN, as in Spark)."""
    for c in columns:
        a, b = known[c], row[c]
        if a != b and not (a != a and b != b) and not _gone(a) and not _gone(b):
            return True
    return False


def _rule(known: dict | None, row: dict, texts: list[str], numeric: list[str], threshold: float) -> str:
    """What becomes of a row held against the newest record of earlier editions:

    ============  =======================  ==========
    name          check columns            row
    ============  =======================  ==========
    similar       equal, or gaps only      'absorb'
    similar       a number clashes         'drop'
    similar       only texts clash         'new'
    other         any                      'new'
    ============  =======================  ==========
    """
    if known is None or not (known["sx"] == row["sx"] or _ratio(known["name"], row["name"]) > threshold):
        return "new"
    if _clash(known, row, numeric):
        return "drop"
    return "new" if _clash(known, row, texts) else "absorb"


def _absorb(known: dict, row: dict, check: list[str]) -> None:
    """The record gets the row's values where it has none, wider dates, the
    row's source and, if unknown so far, its name."""
    for c in check:
        if _gone(known[c]):
            known[c] = row[c]
    for c, pick in (("valid_from", min), ("valid_to", max)):
        if known[c] is None or row[c] is None:
            known[c] = row[c] if known[c] is None else known[c]
        else:
            known[c] = pick(known[c], row[c])
    if row["name"] != known["name"] and row["name"] not in known["alt_names"]:
        known["alt_names"] += ";" + row["name"]
    known["_sources"].append(row["source_file"])


def _fold(batches: Iterator[pa.RecordBatch], schema: pa.Schema, country: str, check: list[str], numeric: list[str],
          threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (country, call sign, edition, order) to linked records.
    The state is one call sign's: its newest ``known`` record of earlier
    editions and the first record ``added`` by the edition at hand; a record
    that no later row can reach leaves at once."""
    texts = [c for c in check if c not in numeric]
    numbers = [c for c in check if c in numeric]
    group = edition = known = added = None
    done: list[dict] = []

    def leave(*records: dict | None) -> None:
        for r in records:
            if r is not None:
                done.append(r | {"source_file": ";".join(r["_sources"])})

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pylist(done, schema=schema)
        done.clear()
        return out

    for batch in batches:
        for row in batch.to_pylist():
            if group != (row[country], row["call"]):
                leave(known, added)
                group, edition, known, added = (row[country], row["call"]), None, None, None
            if edition != row["edition"]:  # a new edition closes the one before
                if added is not None:
                    leave(known)
                    known, added = added, None
                edition = row["edition"]
            rule = _rule(known, row, texts, numbers, threshold)
            if rule == "absorb":
                _absorb(known, row, check)
            elif rule == "new":
                fresh = row | {"record_number": (known["record_number"] if known else 0) + 1, "_sources": [row["source_file"]]}
                if added is None:
                    added = fresh
                else:
                    leave(fresh)
        if len(done) > 1000:
            yield flush()
    leave(known, added)
    yield flush()


def keep_first(df: DataFrame, order: str) -> DataFrame:
    """Exact duplicates (every column but ``order`` equal) become one row
    with the smallest ``order``; a partial aggregate, so copies do not travel."""
    return df.groupBy(*[c for c in df.columns if c != order]).agg(F.min(order).alias(order))


def link_editions(df: DataFrame, check: list[str], numeric: list[str], threshold: float = 0.8,
                  country: str = "rcnty", source: str = "edition", order: str = "line") -> DataFrame:
    """Master records per (country, call sign) from all editions, with
    ``record_number``, ``alt_names`` and ``source_file`` (the sources of all
    rows in the record, joined by ';').

    The rows of a call sign are sorted by (edition, ``order``) and folded as
    they stream by: the state is the newest ``known`` record of earlier
    editions and the first record ``added`` by the edition at hand, which is
    the newest one from the next edition on.  Rows of an edition only see
    earlier editions, so several new rows of one edition share a record
    number.  Exact duplicates are dropped first.

    Rows without a call sign are never linked: those of the country's first
    edition are records of their own, later ones have no place, and none of
    them enters a group.  A null name counts as 'NULL', a null edition as
    the earliest; null dates give way to the other side's.
    """
    d = keep_first(df.withColumn("name", F.coalesce("name", F.lit(MISSING_TEXT))), order)
    d = d.withColumn("sx", phonetic(F.col("name")))
    d = d.withColumns({"record_number": F.lit(1), "alt_names": F.lit(""),
                       "source_file": F.coalesce(F.col(source).cast("string"), F.lit(MISSING_TEXT))})
    columns = ["edition", order] + [c for c in d.columns if c not in ("edition", order)]
    d = d.select(*columns)
    unnamed = _missing(F.col("call"))
    ship_package(df.sparkSession)
    schema, fold = to_arrow_schema(d.schema), _fold

    def linked_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fold(batches, schema, country, check, numeric, threshold)

    # a call sign's rows arrive one after the other, sorted on disk where they do not fit memory
    linked = d.where(~unnamed).repartition(country, "call").sortWithinPartitions(country, "call", *columns) \
        .mapInArrow(linked_rows, d.schema)
    first = df.groupBy(F.col(country).alias("_c")).agg(F.min("edition").alias("_first"))
    alone = d.where(unnamed).join(first, F.col(country).eqNullSafe(F.col("_c")) & (F.col("edition") == F.col("_first")))
    return linked.unionByName(alone.select(*columns))


def master_records(linked: DataFrame, country: str = "rcnty", order: str = "line") -> DataFrame:
    """The linked records as a master file: ``uid`` (call sign, sound code and
    country joined by '-'), record numbers from 0 by date within a uid, and
    validity periods closed up (W17)."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TEXT)) for c in ("call", "sx", country)]
    return renumber_intervals(linked.withColumn("uid", F.concat_ws("-", *named)), key="uid", tie=order)


# --- C17: instrument identifiers ----------------------------------------------------
def instrument_ids(df: DataFrame, specs: dict[str, tuple[str, list[str], list[str]]],
                   uid: str = "uid", record: str = "record_number") -> DataFrame:
    """For each output column: '<uid>-<record>-<suffix>' when any listed
    numeric field is present or any listed text field is not 'NULL', else
    ''.  ``specs`` = {out: (suffix, numeric fields, text fields)}."""
    cols = {}
    for out, (suffix, nums, texts) in specs.items():
        present = reduce(lambda a, b: a | b,
                         [F.col(c).isNotNull() for c in nums]
                         + [F.coalesce(F.col(c) != MISSING_TEXT, F.lit(True)) for c in texts])
        cols[out] = F.when(present, F.concat_ws("-", F.col(uid), F.col(record).cast("string"), F.lit(suffix))) \
            .otherwise(F.lit(""))
    return df.withColumns(cols)


def repair_anemometer_side(df: DataFrame, dist2: str = "anemometer2_distance_centreline",
                           side1: str = "anemometer1_side") -> DataFrame:
    """A letter at the start of the second anemometer's distance is really
    the first anemometer's side: move it there and blank the distance."""
    bad = F.coalesce(F.col(dist2).rlike("^[a-zA-Z]"), F.lit(False))
    return df.withColumns({side1: F.when(bad, F.col(dist2)).otherwise(F.col(side1)),
                           dist2: F.when(bad, F.lit(None)).otherwise(F.col(dist2))})


# --- C14: unit corrections and range audit ---------------------------------------------
def correct_units(df: DataFrame, corrections: DataFrame, ranges: dict[str, tuple[float, float]],
                  keys: tuple[str, str] = ("edition", "rcnty"), missing: float = -999999.0) -> DataFrame:
    """Multiply fields by an edition/country factor: ``all`` = 1 -> every
    non-missing value (documented intent; the reference selects the
    missing ones), ``all`` = 0 -> only values outside the field's range.
    ``corrections``: (edition, rcnty, field, factor, all_values) - configuration,
    pivoted to one row per (edition, country) and broadcast after a
    bounded count."""
    from tidewater.operators.util import sized_broadcast

    fields = list(ranges)
    piv = corrections.groupBy(*keys).pivot("field", fields).agg(
        F.first(F.struct(F.col("factor").cast("double").alias("f"), F.col("all_values").cast("int").alias("a"))))
    piv = piv.select(*[F.col(k).alias(f"_c_{k}") for k in keys], *[F.col(c).alias(f"_cor_{c}") for c in fields])
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_c_{k}") for k in keys])
    d = df.join(sized_broadcast(piv), cond, "left")
    cols = {}
    for c, (lo, hi) in ranges.items():
        v = F.col(c)
        present = v.isNotNull() & (F.abs(v - missing) >= 1e-6)
        out_range = present & ~v.between(lo, hi)
        f, a = F.col(f"_cor_{c}.f"), F.col(f"_cor_{c}.a")
        hit = f.isNotNull() & (((a == 1) & present) | ((a == 0) & out_range))
        cols[c] = F.when(hit, v * f).otherwise(v)
    d = d.withColumns(cols)
    return d.drop(*[f"_c_{k}" for k in keys], *[f"_cor_{c}" for c in fields])


def range_audit(df: DataFrame, ranges: dict[str, tuple[float, float]], keys: tuple[str, ...] = ("edition", "rcnty"),
                missing: float = -999999.0, share: float = 0.05, min_rows: int = 10) -> DataFrame:
    """Per (edition, country, field): non-missing values outside the
    range, and ``large`` when they exceed ``share`` of more than
    ``min_rows`` rows.  One aggregate over a stacked (field, value) view."""
    stacked = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("v"), F.lit(lo).alias("lo"),
                 F.lit(hi).alias("hi")) for c, (lo, hi) in ranges.items()])).alias("s"))
    v = F.col("s.v")
    bad = v.isNotNull() & (F.abs(v - missing) >= 1e-6) & ~v.between(F.col("s.lo"), F.col("s.hi"))
    agg = stacked.groupBy(*keys, F.col("s.field").alias("field")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(bad, 1).otherwise(0)).alias("n_bad"))
    return agg.withColumn("large", (F.col("n_bad") / F.col("n") > share) & (F.col("n") > min_rows))
