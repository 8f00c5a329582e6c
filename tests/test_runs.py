"""Runs over stored tables: sliced fields, corner stencil, changed platforms,
run policies, month merge."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import drifter as DR
from tidewater.operators import grid_lookup as GL
from tidewater.operators import track as TR
from tidewater.sources import sinks

PLACES = "uid long, lat double, lon double, mo int, dy int"


# -- J13 ------------------------------------------------------------------------
def cell(lat, lon):
    lon = lon - 360 if lon >= 180 else lon
    lon = lon + 360 if lon < -180 else lon
    return min(max(int(90 - lat), 0), 179), int(lon + 180) % 360


def interpolated(field, t, lat, lon):
    """Eight single lookups, fill-in and interpolation, one report at a time."""
    lon = lon - 360 if lon > 180 else lon
    get = lambda la, lo: field.get((t, *cell(la, lo)))
    probes = [get(lat + a, lon + b) for a in (0.001, -0.001) for b in (0.001, -0.001)
              if (lat + a < 90 if a > 0 else lat + a > -90)]
    if all(p is None for p in probes):
        return None
    centre = lambda i: i - 180 + 0.5
    x2, x1 = centre(cell(0, lon + 0.5)[1]), centre(cell(0, lon - 0.5)[1])
    x2, x1 = x2 + 360 * (x2 < lon), x1 - 360 * (x1 > lon)
    row = lambda la: 90 - cell(la, 0)[0] - 0.5
    y2 = row(lat + 0.5) if lat + 0.5 <= 90 else 89.5
    y1 = row(lat - 0.5) if lat - 0.5 >= -90 else -89.5
    q = {"11": get(y1, x1), "22": get(y2, x2), "12": get(y2, x1), "21": get(y1, x2)}

    def fill(me, beside, opposite):
        if q[me] is not None:
            return q[me]
        near = [q[b] for b in beside if q[b] is not None]
        return sum(near) / len(near) if near else q[opposite]

    f11, f22 = fill("11", ("12", "21"), "22"), fill("22", ("12", "21"), "11")
    f12, f21 = fill("12", ("11", "22"), "21"), fill("21", ("11", "22"), "12")
    y2 = y2 if lat + 0.5 <= 90 else 90.5
    y1 = y1 if lat - 0.5 >= -90 else -90.5
    return (f11 * (x2 - lon) * (y2 - lat) + f21 * (lon - x1) * (y2 - lat) + f12 * (x2 - lon) * (lat - y1)
            + f22 * (lon - x1) * (lat - y1)) / ((x2 - x1) * (y2 - y1))


def test_corner_stencil_against_single_lookups(spark):
    rng = random.Random(4)
    field = {(t, y, x): rng.random() * 30 for t in (0, 1) for y in [*range(5), *range(85, 92), *range(175, 180)]
             for x in range(360) if rng.random() < 0.6}
    rows = spark.createDataFrame([(*k, v) for k, v in field.items()] + [(0, 3, 7, None)], "t int, y int, x int, v double")
    places = [(rng.choice([rng.uniform(84.9, 90), rng.uniform(-2.5, 5), rng.uniform(-90, -84.9), 90.0, -90.0, 89.5, 88.0, 0.5, -0.5]),
               rng.choice([rng.uniform(-180, 360), 180.0, -180.0, 179.7, -179.9, 0.0, 0.5, 10.0, 359.9])) for _ in range(600)]
    reports = [(i, la, lo, 1, rng.choice([2, 7])) for i, (la, lo) in enumerate(places)]
    reports += [(900, None, 1.0, 1, 1), (901, 1.0, None, 1, 1), (902, 1.0, 1.0, 2, 30), (903, 1.0, 1.0, None, 1)]
    got = {r.uid: r.out for r in GL.bilinear_lookup(spark.createDataFrame(reports, PLACES), rows, "v", "out").collect()}
    assert len(got) == len(reports) and all(got[i] is None for i in range(900, 904))
    found = 0
    for i, la, lo, _, dy in reports[:600]:
        want = interpolated(field, 0 if dy == 2 else 1, la, lo)
        assert (got[i] is None) == (want is None), (la, lo)
        if want is not None:
            found += 1
            assert math.isclose(got[i], want, rel_tol=1e-9, abs_tol=1e-9), (la, lo)
    assert found > 200


def test_interpolation_neither_explodes_nor_groups_reports(spark):
    rows = spark.createDataFrame([(0, 1, 1, 1.0)], "t int, y int, x int, v double")
    stencil = spark.createDataFrame(
        GL.corner_stencil(rows, "v").collect(), GL.corner_stencil(rows, "v").schema)
    out = GL.bilinear_lookup(spark.createDataFrame([(1, 1.0, 1.0, 1, 1)], PLACES), rows, "v", "out", stencil=stencil)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan and plan.count("Join") == 1


# -- J11 ------------------------------------------------------------------------
@pytest.fixture(scope="module")
def slices(spark, tmp_path_factory):
    """5-degree field of 365 steps, stored by slice."""
    field = spark.range(365 * 36 * 72).select(
        F.floor(F.col("id") / 2592).cast("int").alias("t"), F.floor(F.col("id") % 2592 / 72).cast("int").alias("y"),
        (F.col("id") % 72).cast("int").alias("x"), (F.col("id") * 0.5).alias("sst"), F.lit("z").alias("other")).where("(x + y) % 7 <> 0")
    path = str(tmp_path_factory.mktemp("slices"))
    GL.write_slices(field, path, 5.0)
    return field, path


def test_slice_lookup_is_the_grid_lookup(spark, slices):
    field, path = slices
    rng = random.Random(6)
    rows = [(i, rng.uniform(-90, 90), rng.uniform(-180, 360), rng.randrange(1, 13), rng.randrange(1, 29)) for i in range(500)]
    rows += [(1000 + i, 10.0, 20.0, 3, 3) for i in range(300)]  # one busy cell
    rows += [(2000, None, 1.0, 1, 1), (2001, 1.0, 1.0, 2, 31), (2002, 1.0, 1.0, 2, 29), (2003, 90.0, 180.0, 12, 31)]
    df = spark.createDataFrame(rows, PLACES).withColumns({"sst": F.lit(1.0), "band": F.lit("b")})
    for style in ("regular", "mds"):
        want = GL.grid_lookup(df, field, {"sst": "norm"}, 365, 5.0, style).select("uid", "norm").collect()
        got = GL.slice_lookup(df, path, {"sst": "norm"}, 365, 5.0, style)
        assert got.columns == [*df.columns, "norm"]
        assert sorted((r.uid, r.norm) for r in got.collect()) == sorted((r.uid, r.norm) for r in want)


def test_only_needed_slices_are_read(spark, slices):
    _, path = slices
    df = spark.createDataFrame([(1, 80.0, 5.0, 1, 1), (2, 81.0, 5.0, 1, 2), (3, -80.0, 5.0, 1, 1)], PLACES)
    got = GL.slice_lookup(df, path, {"sst": "norm"}, 365, 5.0)
    assert got.where("norm is not null").count() >= 1
    scans = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]
    assert scans and all("band" in s.split("PartitionFilters")[1] and "t#" in s.split("PartitionFilters")[1] for s in scans if "sst" in s)
    assert not any("other" in s for s in scans)
    read = spark.read.parquet(path).where("(band = 0 and t in (0, 1)) or (band = 11 and t = 0)")
    assert len(read.inputFiles()) > 0 and read.count() < 3 * 3 * 72 + 1
    assert GL.slice_lookup(df.where("false"), path, {"sst": "norm"}, 365, 5.0).count() == 0


# -- W6 -------------------------------------------------------------------------
def voyage(name, jumps, n=30):
    rows = []
    for i in range(n):
        lat = 10 + 0.2 * i + (25 if i in jumps else 0)
        rows.append((f"{name}-{i}", name, 2000, 1, 1 + i // 4, float(6 * (i % 4)), lat, 20.0, None, None, 1, 720))
    return rows


def test_passes_read_changed_platforms_only(spark, monkeypatch):
    schema = "uid string, id string, yr int, mo int, dy int, hr double, lat double, lon double, ds int, vs int, pt int, dck int"
    rows = voyage("GOOD1", ()) + voyage("GOOD2", ()) + voyage("BAD", (10, 20)) + voyage("TWO", (5, 6)) + voyage("SHIP     ", (4,))
    df = spark.createDataFrame(rows, schema).withColumns(
        {"ts": F.make_timestamp_ntz("yr", "mo", "dy", F.col("hr").cast("int"), F.lit(0), F.lit(0)), "note": F.col("uid")})
    sizes = []
    stage = TR.stage_table

    def recorded(frame, name):
        out = stage(frame, name)
        sizes.append((name, out.count(), sorted({r.id for r in out.select("id").distinct().collect()})))
        return out

    monkeypatch.setattr(TR, "stage_table", recorded)
    got = TR.track_check_iterative(df)
    assert got.columns == [*df.columns, "trk", "few"] and got.count() == len(rows)
    # the plain form: every pass over everything that is left
    left, flagged = df, set()
    for _ in range(5):
        hit = {r.uid for r in TR.track_check(left).where("trk = 1").collect()}
        flagged |= hit
        left = left.where(~F.col("uid").isin(sorted(hit) or ["-"]))
    assert {r.uid for r in got.where("trk = 1").collect()} == flagged and flagged
    assert sizes[0][1] == len(rows) and "GOOD1" in sizes[0][2]
    assert len(sizes) > 1 and all(set(s[2]) <= {"BAD", "TWO"} for s in sizes[1:])
    assert got.where("few is null").count() == 0


# -- W16 ------------------------------------------------------------------------
def chunks_by_hand(months, first, last, gap):
    out, start, before = [], None, None
    for m in range(first, last + 1):
        if m not in months:
            continue
        if before is None or m - before > gap:
            start = m
            out.append([start, m, 0])
        out[-1][1], out[-1][2], before = m, out[-1][2] + 1, m
    return [(s, e, n, s - first < gap, e - first > last - first - gap, e - first == last - first - gap) for s, e, n in out]


def test_inventory_and_policies(spark):
    rng = random.Random(8)
    first, last = 2000 * 12, 2000 * 12 + 39
    have = {f"B{i}": {first + m for m in range(40) if rng.random() < 0.35} for i in range(60)}
    have["ENDS"] = {first, last}
    rows = [(b, m // 12, m % 12 + 1) for b, ms in have.items() for m in ms] + [("B1", (last) // 12, last % 12 + 1)]
    have["B1"].add(last)
    inv = DR.chunk_inventory(spark.createDataFrame(rows, "id string, yr int, mo int"), first, last, 2)
    got = sorted((r.id, r.start, r.end, r.n_months, r.start_edge, r.end_edge, r.new) for r in inv.collect())
    want = sorted((b, *c) for b, ms in have.items() for c in chunks_by_hand(ms, first, last, 2))
    assert got == want
    taken = {p: {(r.id, r.start) for r in DR.run_chunks(inv, p).collect()} for p in DR.RUN_POLICIES}
    regular = {(w[0], w[1]) for w in want if not w[4] and not w[5]}
    assert taken["all"] == {(w[0], w[1]) for w in want} and taken["standard"] == regular
    assert taken["new"] == {(w[0], w[1]) for w in want if w[6]}
    assert taken["noend"] == regular | {(w[0], w[1]) for w in want if w[4]}


def test_a_run_takes_changed_chunks_only(spark):
    old = [("A", 2000, 1), ("A", 2000, 2), ("B", 2000, 1), ("C", 2000, 6), (None, 2000, 3)]
    new = [*old, ("A", 2000, 9), ("B", 2000, 3), ("D", 2000, 4)]
    frame = lambda rows: spark.createDataFrame(rows, "id string, yr int, mo int")
    was, now = (DR.chunk_inventory(frame(r), 2000 * 12, 2000 * 12 + 11) for r in (old, new))
    todo = DR.run_chunks(now, "all", was)
    assert {(r.id, r.start % 12 + 1) for r in todo.collect()} == {("A", 9), ("B", 1), ("D", 4)}
    assert DR.run_chunks(now, "all", now).count() == 0
    reports = frame([r for r in new for _ in range(3)])
    assert {(r.id, r.mo) for r in DR.in_chunks(reports, todo).collect()} == {("A", 9), ("B", 1), ("B", 3), ("D", 4)}
    assert DR.in_chunks(reports, now).count() == 3 * len(new)


# -- K9 -------------------------------------------------------------------------
TRACK = ["UID", "YR", "MO", "drf_agr"]


def write_run(spark, path, rows):
    df = spark.createDataFrame(rows, "UID string, YR string, MO string, drf_agr string, name string")
    df.write.partitionBy("name").csv(path, header=True)
    return sinks.reindex_tracking(spark, path, TRACK)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".csv") and not f.startswith(".")}


def test_second_merge_rewrites_its_months_only(spark, tmp_path):
    months = str(tmp_path / "months")
    one = [(f"U{i:03d}", "2000", str(1 + i % 4), "0", "regular") for i in range(200)]
    one += [("E1", "2000", "1", "1", "edge_case"), ("N", "2001", "1", None, "regular")]
    assert sinks.merge_months(write_run(spark, str(tmp_path / "r1"), one), months) == [(2000, 1), (2000, 2), (2000, 3), (2000, 4), (2001, 1)]
    before = files(months)
    two = [("U002", "2000", "3", "9", "regular"), ("U999", "2000", "3", "1", "x"), ("U000", "2000", "1", "9", "edge_case")]
    assert sinks.merge_months(write_run(spark, str(tmp_path / "r2"), two), months) == [(2000, 3)]
    after = files(months)
    other = {f: t for f, t in before.items() if "month=3" not in f}
    assert other and {f: t for f, t in after.items() if "month=3" not in f} == other
    back = spark.read.csv(months, header=True)
    got = {r.UID: r.drf_agr for r in back.collect()}
    assert back.count() == len(got) == 202 and "E1" not in got
    assert got["U002"] == "9" and got["U999"] == "1" and got["U000"] == "0" and got["N"] is None
    # files of a month are ranges of the key, sorted inside
    spans = []
    for f in sorted(f for f in after if "year=2000/month=3" in f):
        uids = [line.split(",")[0] for line in open(f).read().splitlines()[1:]]
        assert uids == sorted(uids)
        spans.append((uids[0], uids[-1]))
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert sinks.merge_months(back.where("false").select(*TRACK, F.lit(1).alias("year"), F.lit(1).alias("month")), months) == []
    assert files(months) == after


# -- C3 -------------------------------------------------------------------------
def test_bundles_look_up_what_they_need(spark):
    from tidewater.operators import base_qc as BQ

    schema = ("uid string, id string, yr int, mo int, dy int, hr double, lat double, lon double, pt int, dck int, "
              "sst double, at double, slp double, w double, d double, note string")
    reports = spark.createDataFrame([("a", "X", 2000, 1, 1, 0.0, 1.0, 1.0, 1, 700, 1.0, 2.0, 1000.0, 3.0, 4.0, "n"),
                                     ("b", None, 2000, 2, 30, None, None, 1.0, None, 780, None, None, None, None, None, None)], schema)
    clim = spark.createDataFrame([(0, 89, 181, 1.0, 2.0, 1000.0, 2.0)], "t int, y int, x int, sst double, at double, slp double, slp_sd double")
    for name, joins in {"wind": 0, "dat": 1, "slp": 1, "sst": 1}.items():
        out = BQ.qc_bundle(reports, clim, BQ.BUNDLES[name])
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == joins, name
        assert all("note" not in line for line in plan.splitlines() if "LogicalRDD" not in line)
        assert out.columns == ["uid", *BQ.BUNDLES[name]] and out.count() == 2
        assert all(r[f] in (0, 1) for r in out.collect() for f in BQ.BUNDLES[name])


# -- A12 / A13, S7, K11 ------------------------------------------------------------
def test_states_of_years_merge_to_the_whole(spark):
    from tidewater.operators import summaries as SU
    from tidewater.plans import adapters as A
    from tidewater.plans.q_runs import _records_sql

    from tests.conftest import SF_SMALL

    records = A.view(spark, SF_SMALL, _records_sql())
    merged = SU.merge_stations(SU.station_state(records, ["year"]).drop("year"))
    whole = SU.station_state(records)
    a, b = ({tuple(map(str, r)) for r in SU.station_rollup(s, all_years=True).collect()} for s in (merged, whole))
    assert a == b and len(a) > 10
    assert SU.station_rollup(whole, all_years=True).where("conflicts <> ''").count() > 0


def test_months_open_their_parts_only(spark, tmp_path):
    from tidewater.sources import tables as T

    rows = [("r1", "2000-01", "2000-01"), ("r2", "2000-02", "2000-01"), ("r3", "2000-02", "2000-03"), (None, "2000-03", "2000-03")]
    df = spark.createDataFrame(rows, "report_id string, period string, source_period string")
    path = str(tmp_path / "cdm")
    sinks.write_periods(df, ["report_id"], path)
    got = T.read_period(spark, path, ["report_id"], "2000-02")  # leaks without a master
    assert sorted(map(tuple, got.collect())) == [("r2", "2000-01", True), ("r3", "2000-03", True)]
    assert all("period=2000-02" in f for f in got.inputFiles())
    assert [tuple(r) for r in T.read_period(spark, path, ["report_id"], "2000-03").collect()] == [(None, "2000-03", False)]
    assert T.read_period(spark, path, ["report_id"], "1999-01").count() == 0
