"""Boundary cases: attachments, duplicates in an edition, platforms without an
id, release configuration, solar position, numbered fields."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidewater.functions import solar
from tidewater.operators import metadata as MD
from tidewater.operators import select as SE
from tidewater.operators import track as TR
from tidewater.sources import fixed_width as FW

CORE = " " * 108
A1 = " 165" + " " * 6 + "926101 5" + " " * 45 + "12"
A8 = " 82U" + "8" * 98
A98 = "9815" + "AB12CD" + "1" + "0010"[:4]


def walked(spark, *lines):
    d = FW.attachments(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, value string"))
    return [[(a.id, a.body) for a in r.att] for r in d.orderBy("n").collect()]


def test_attachment_walk(spark):
    got = walked(spark, CORE + A1 + A8 + A98, CORE + A1 + A98[:10], CORE + A1 + A98 + "99 0free text", CORE, "short",
                 CORE + A1 + A1 + A98 + A1, CORE + "??zz" + A1, CORE + A98 * 40)
    assert got[0] == [("1", A1), ("8", A8), ("98", A98)]
    assert got[1] == [("1", A1), ("98", A98[:10])]
    assert got[2] == [("1", A1), ("98", A98), ("99", "99 0free text")]
    assert got[3] == got[4] == got[6] == []
    assert [i for i, _ in got[5]] == ["1", "1", "98", "1"]
    assert len(got[7]) == 40


def test_unique_id_and_encoding(spark, tmp_path):
    line = (CORE + A1 + A98).encode()
    bad = b"\xe9" + line[1:]
    quoted = b'"' + line[1:]
    (tmp_path / "f.txt").write_bytes(b"\n".join([line, bad, quoted]))
    rows = FW.read_fixed_width(spark, str(tmp_path)).select("value", "UID", "DCK", "QCZ").collect()
    assert len(rows) == 3 and {(r.UID, r.DCK, r.QCZ) for r in rows} == {("AB12CD", 926.0, 12.0)}
    assert {r.value[0] for r in rows} == {" ", "\u00e9", '"'}


def edition(spark, rows):
    return spark.createDataFrame(rows, "line int, edition int, call string, name string, rcnty string, vsslM int, platH double")


def resolve(d):
    out = MD.resolve_edition_duplicates(d, ["platH"], ["platH", "name"], key="call", edition="edition")
    return {r.line: (r.kept, r.platH) for r in out.collect()}


def test_missing_number_is_no_clash(spark):
    got = resolve(edition(spark, [
        (1, 1997, "A", "SEA STAR", "GB", 1, -999999.0), (2, 1997, "A", "SEA STAR", "GB", 1, 20.0),
        (3, 1998, "A", "SEA STAR", "GB", 1, 20.0),  # another edition: no duplicate
        (4, 1997, None, "X", "GB", 1, 1.0), (5, 1997, None, "Y", "GB", 1, 2.0), (6, 1997, "NULL", "Z", "GB", 1, 3.0),
        (7, 1997, "B", "SEA STAR", "GB", 1, 5.0), (8, 1997, "B", "OTHER", "GB", 1, 5.0)]))
    assert sorted(k for k, v in got.items() if v[0]) == [2, 3, 4, 5, 6]
    assert got[2] == (True, 20.0)


def reports(spark, ids):
    start = datetime.datetime(2020, 1, 1)
    rows = []
    for who in ids:
        for i in range(60):
            t = start + datetime.timedelta(hours=2 * i)
            rows.append((f"{who}-{i}", who, 2020, 1, t.day, float(t.hour), t, 1.0, 2.0, 10.0, 10.0, 10.0))
    return spark.createDataFrame(rows, "uid string, id string, yr int, mo int, dy int, hr double, ts timestamp, "
                                       "lat double, lon double, at double, dpt double, sst double")


def test_platform_without_id_is_checked(spark):
    d = reports(spark, [None, "SHIP     "])
    for flag, out in (("repsat", TR.saturated_runs(d)), ("sst_rep", TR.repeated_values(d, "sst")),
                      ("dpt_round", TR.rounded_values(d, "dpt"))):
        n = {r.id: r.n for r in out.groupBy("id").agg(F.sum(flag).alias("n")).collect()}
        assert n[None] == n["SHIP     "] > 0, flag


def test_release_without_or_with_two_global_rows(spark):
    inv = spark.createDataFrame([("1-1", 1990, "header")], "sid_dck string, year int, table string")
    cfg = "sid_dck string, year_init int, year_end int, exclude boolean, params_exclude array<string>"
    none = spark.createDataFrame([("1-1", 1980, 2000, False, [])], cfg)
    assert [r.included for r in SE.select_release(inv, none).collect()] == [True]
    two = none.unionByName(spark.createDataFrame([(None, 1800, 2000, False, []), (None, 1800, 2001, False, [])], cfg))
    with pytest.raises(Exception, match="more than one global"):
        SE.select_release(inv, two).collect()


def test_split_numbered_keeps_every_part(spark):
    d = spark.createDataFrame([("1,2,3",), ("4",), (None,)], "x string")
    assert MD.split_numbered(d, "x", ",").columns == ["x1", "x2", "x3"]
    assert MD.split_numbered(d, "x", ",", 2).first().x2 == "2,3"


def test_sun_stands_south_at_noon(spark):
    d = spark.createDataFrame([(2020, 172, 12, 0, 50.0, 0.0), (2020, 172, 0, 0, 50.0, 0.0)],
                              "y int, doy int, h int, m int, lat double, lon double")
    noon, night = solar.with_sun_position(d, "y", "doy", "h", "m", "lat", "lon", azimuth="az").collect()
    assert noon.sun_elev == pytest.approx(63.4, abs=0.3) and noon.az == pytest.approx(180, abs=3)
    assert night.sun_elev == pytest.approx(-16.6, abs=0.3)


def test_numeric_order(spark):
    from tidewater.operators.cdm import numeric_order

    d = spark.createDataFrame([("10", "1"), ("9", "2"), ("9", "-3"), ("x", "0"), ("-1.5", "7")], "a string, b string")
    assert [tuple(r) for r in numeric_order(d, ["a", "b"]).collect()] == [
        ("x", "0"), ("-1.5", "7"), ("9", "-3"), ("9", "2"), ("10", "1")]


def test_platform_rule_for_missing_type(spark):
    from tidewater.operators.cdm import correct_platform_type

    d = spark.createDataFrame([(1, 992, None), (2, 992, 3), (3, 5, None)], "uid int, dck int, pt int")
    rules = spark.createDataFrame([(992, None, 5), (992, 3, None)], "dck int, pt int, new_pt int")
    assert {r.uid: r.pt for r in correct_platform_type(d, rules).collect()} == {1: 5, 2: None, 3: None}


def test_grid_lookup_by_broadcast_and_by_shuffle(spark):
    from tidewater.operators.grid_lookup import grid_lookup

    field = spark.range(73 * 18 * 36).select((F.col("id") % 73).cast("int").alias("t"), (F.floor(F.col("id") / 73) % 18).cast("int").alias("y"),
                                             F.floor(F.col("id") / (73 * 18)).cast("int").alias("x"), F.col("id").cast("double").alias("v"))
    d = spark.createDataFrame([(i, 1 + i % 12, 1 + i % 28, -89.0 + 2.7 * i, -179.0 + 5.3 * i) for i in range(66)],
                              "uid int, mo int, dy int, lat double, lon double")
    plans, rows = [], []
    for limit in (10**9, 0):
        out = grid_lookup(d, field, {"v": "w"}, res=10.0, broadcast_limit_bytes=limit)
        plans.append("BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString())
        rows.append(sorted((r.uid, r.w) for r in out.collect()))
    assert plans == [True, False] and rows[0] == rows[1] and all(w is not None for _, w in rows[0])


def test_section_layouts_fill_their_length():
    for att_id, fields in FW.SECTIONS.items():
        assert 4 + sum(f[1] for f in fields) == FW.ATTACHMENT_LENGTH[att_id]


def test_sections_decoded_and_checked(spark):
    a9 = " 932" + "D" + "071" + "8" + "1" + "03" + "12" + " " + "801" + "  5" + "2" + "x" + "1" + "-905" + " 117"
    a97 = "9732" + "0112" + "1" + "  free    " + "ABCD" + "20150301" + "0"
    a95 = "9561" + "0102"
    rows = [CORE + a9 + a97 + a95, CORE + a9 + " 932" + "Z" + " " * 27, CORE, CORE + A1]
    d = FW.attachments(spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "n int, value string"))
    got = FW.check_sections(FW.decode_sections(d)).orderBy("n").collect()
    cloud = got[0].att9
    assert (cloud.CCe, cloud.WWe, cloud.Ne, cloud.NHe, cloud.He) == (13.0, 7.0, 1.0, 8.0, 1.0)
    assert (cloud.CLe, cloud.CMe, cloud.CHe, cloud.UM, cloud.UH, cloud.SBI) == (3.0, 12.0, None, 2.0, None, 1.0)
    assert (cloud.AM, cloud.AH, cloud.SA, cloud.RI) == pytest.approx((8.01, 0.05, -90.5, 1.17))
    error = got[0].att97
    assert (error.ICNE, error.FNE, error.CEF, error.ERRD, error.ARCE, error.CDE, error.ASIE) == (
        1.0, 12.0, 1.0, "  free    ", "ABCD", 20150301.0, 0.0)
    assert (got[0].att95.ICNR, got[0].att95.FNR, got[0].att95.DPRO) == (1.0, 2.0, None)  # cut short
    assert got[0].section_check == "att9.AM:att9.SA"
    assert got[1].att9.CCe == 35.0 and got[1].att9.AM is None and got[1].section_check == "att9.CCe"  # the last one counts
    assert got[2].att9 is None and got[3].att5 is None and got[3].section_check == ""


def test_sections_of_another_schema(spark):
    schema = {"98": FW.section_schema("UID 6 - - c; RN1 1 0 5 b")}
    d = FW.attachments(spark.createDataFrame([(CORE + A98,)], "value string"))
    row = FW.check_sections(FW.decode_sections(d, schema, "x"), schema, "x").first()
    assert (row.x98.UID, row.x98.RN1, row.section_check) == ("AB12CD", 1.0, "")
