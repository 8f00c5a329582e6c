"""C13 and J20 against sequential re-statements on random names and editions."""

import datetime
import random

from pyspark.sql import functions as F

from tidewater.operators import metadata as MD

CHECK, NUMERIC = ["cls", "kind", "height"], ["cls", "height"]
SCHEMA = "line long, edition int, call string, name string, rcnty string, cls int, kind string, height double, " \
         "valid_from date, valid_to date"


def common(a: str, b: str) -> int:
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if x == y else max(table[i - 1][j], table[i][j - 1])
    return table[-1][-1]


def ratio(a: str, b: str) -> float:
    return 1.0 if not a + b else 2.0 * common(a, b) / (len(a) + len(b))


def test_name_similarity(spark):
    rng = random.Random(5)
    names = ["", "A", "SEA STAR", "SEA STARR", "X" * 40] + ["".join(rng.choices("ABC ", k=rng.randint(1, 12))) for _ in range(60)]
    pairs = [(a, b) for a in names[:25] for b in names]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", MD.name_similarity("a", "b").alias("r"),
                    *[MD.names_alike(F.col("a"), F.col("b"), t).alias(f"t{i}") for i, t in enumerate((0.5, 0.8))]).collect()
    assert len(got) == len(pairs)
    for row in got:
        want = ratio(row.a, row.b)
        assert abs(row.r - want) < 1e-12
        assert (row.t0, row.t1) == (want > 0.5, want > 0.8), (row.a, row.b)


def gone(v) -> bool:
    return v is None or str(v) in ("NULL", "-999999", "-999999.0")


def history(rows: list[dict]) -> list[dict]:
    """One call sign, edition by edition."""
    records, newest = [], None
    for edition in sorted({r["edition"] for r in rows}):
        added = []
        for row in sorted((r for r in rows if r["edition"] == edition), key=lambda r: r["line"]):
            fresh = row | {"record_number": (newest["record_number"] if newest else 0) + 1, "alt_names": "",
                           "source_file": str(edition)}
            if newest is None or not (newest["sx"] == row["sx"] or ratio(newest["name"], row["name"]) > 0.8):
                added.append(fresh)
                continue
            clash = [c for c in CHECK if newest[c] != row[c] and not gone(newest[c]) and not gone(row[c])]
            if set(clash) & set(NUMERIC):
                continue
            if clash:
                added.append(fresh)
                continue
            newest.update({c: row[c] for c in CHECK if gone(newest[c])})
            newest["valid_from"] = min(newest["valid_from"], row["valid_from"])
            newest["valid_to"] = max(newest["valid_to"], row["valid_to"])
            newest["source_file"] += f";{edition}"
            if row["name"] != newest["name"] and row["name"] not in newest["alt_names"]:
                newest["alt_names"] += ";" + row["name"]
        records += added
        newest = added[0] if added else newest
    return records


def test_linkage_follows_the_sequential_rule(spark):
    rng = random.Random(11)
    day = datetime.date(2000, 1, 1)
    names = ["SEA STAR", "SEA STARR", "SEA STAR (2)", "OCEAN WAVE", "OCEAN WAVES", "NO", None]
    rows = []
    for line in range(900):
        start = day + datetime.timedelta(days=rng.randint(0, 4000))
        rows.append((line, rng.randint(1995, 2003), f"C{rng.randint(1, 40)}", rng.choice(names), rng.choice(["GB", None]),
                     rng.choice([1, 1, 2, None, -999999]), rng.choice(["M", "M", "N", "NULL", None]),
                     rng.choice([5.0, 5.0, 6.0, -999999.0]), start, start + datetime.timedelta(days=rng.randint(1, 900))))
    rows += [(900 + i, *r[1:]) for i, r in enumerate(rows[:50])]  # exact duplicates, to be dropped
    df = spark.createDataFrame(rows, SCHEMA)
    out = MD.link_editions(df, CHECK, NUMERIC)
    cols = [*df.columns, "record_number", "alt_names", "source_file"]
    got = sorted(repr(tuple(r[c] for c in cols)) for r in out.collect())

    plain = [r.asDict() for r in df.where("line < 900").withColumn("name", F.coalesce("name", F.lit("NULL")))
             .withColumn("sx", MD.phonetic("name")).collect()]
    groups = {}
    for r in plain:
        groups.setdefault((r["rcnty"], r["call"]), []).append(r)
    want = sorted(repr(tuple(r[c] for c in cols)) for g in groups.values() for r in history(g))
    assert len(want) > 150 and got == want


def test_linkage_edges(spark):
    day = datetime.date(2000, 1, 1)
    rows = [(1, 1995, None, "A", "GB", 1, "M", 5.0, day, day), (2, 1996, "NULL", "A", "GB", 1, "M", 5.0, day, day),
            (3, 1996, "C1", "ALPHA", "GB", 1, "M", None, None, day), (4, 1997, "C1", "ALPHA", "GB", 1, "NULL", 5.0, day, None)]
    out = {r.line: r for r in MD.link_editions(spark.createDataFrame(rows, SCHEMA), CHECK, NUMERIC).collect()}
    assert set(out) == {1, 3}  # a later row without call sign has no place
    assert (out[3].height, out[3].valid_from, out[3].valid_to, out[3].source_file) == (5.0, day, day, "1996;1997")
    empty = MD.link_editions(spark.createDataFrame([], SCHEMA), CHECK, NUMERIC)
    assert empty.collect() == []
    master = MD.master_records(MD.link_editions(spark.createDataFrame(rows, SCHEMA), CHECK, NUMERIC)).collect()
    assert {(r.uid.split("-")[0], r.record_number) for r in master} == {("NULL", 0), ("C1", 0)}
