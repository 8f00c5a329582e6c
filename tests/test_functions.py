"""Expression goldens: documented humidity examples, erf, calendar and cells."""

import math

import pytest
from pyspark.sql import functions as F

from tidewater.functions import calendar as CAL
from tidewater.functions import grid as G
from tidewater.functions import humidity as H
from tidewater.operators.buddy import erf


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).collect()[0]["v"]


@pytest.mark.parametrize("expr,want", [
    (lambda: H.vap(F.lit(10.0), F.lit(15.0), F.lit(1013.0)), 12.3),
    (lambda: H.vap_from_sh(F.lit(7.6), F.lit(1013.0)), 12.3),
    (lambda: H.sh(F.lit(10.0), F.lit(15.0), F.lit(1013.0)), 7.6),
    (lambda: H.rh(F.lit(10.0), F.lit(15.0), F.lit(1013.0)), 72.0),
    (lambda: H.wb(F.lit(10.0), F.lit(15.0), F.lit(1013.0)), 12.2),
    (lambda: H.dpd(F.lit(10.0), F.lit(15.0)), 5.0),
    (lambda: H.td_from_vap(F.lit(12.3), F.lit(1013.0), F.lit(15.0)), 10.0),
])
def test_humidity_documented_examples(spark, expr, want):
    assert _one(spark, expr()) == pytest.approx(want, abs=1e-9)


def test_erf_matches_math(spark):
    xs = [i / 10.0 for i in range(-40, 41)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", erf(F.col("x")).alias("e"))
    for r in df.collect():
        assert r["e"] == pytest.approx(math.erf(r["x"]), abs=2e-7)


@pytest.mark.parametrize("mo,dy,pentad,doy", [
    (1, 1, 1, 1), (1, 5, 1, 5), (1, 6, 2, 6), (2, 28, 12, 59), (2, 29, 12, 60),
    (3, 1, 12, 60), (12, 31, 73, 365),
])
def test_pentad_and_doy(spark, mo, dy, pentad, doy):
    assert _one(spark, CAL.pentad(F.lit(mo), F.lit(dy))) == pentad
    assert _one(spark, CAL.doy365(F.lit(mo), F.lit(dy))) == doy


@pytest.mark.parametrize("lat,y", [(90.0, 0), (89.5, 0), (0.0, 90), (-0.5, 90), (-90.0, 179), (45.0, 44)])
def test_mds_lat(spark, lat, y):
    assert _one(spark, G.mds_yindex(F.lit(lat))) == y


@pytest.mark.parametrize("lon,x", [(0.0, 179), (0.5, 180), (-180.0, 0), (180.0, 359), (-0.5, 179)])
def test_mds_lon(spark, lon, x):
    assert _one(spark, G.mds_xindex(F.lit(lon))) == x


@pytest.mark.parametrize("yr,mo,n", [(2024, 2, 29), (2023, 2, 28), (1900, 2, 28), (2000, 2, 29), (2024, 4, 30)])
def test_month_length(spark, yr, mo, n):
    assert _one(spark, CAL.month_length(F.lit(yr), F.lit(mo))) == n


def test_track_terms_fit_compiled_methods(spark):
    """Course and midpoint are staged: no generated method of the track check
    is longer than the 8,000 bytes that the JVM compiles."""
    import re

    from tidewater.operators import track as TR

    rows = [(f"u{i}", "A", 2000, 1, 1 + i // 4, 6.0 * (i % 4), 10.0 + (i // 2), 190.0, 1, 2, 5, 700) for i in range(12)]
    df = spark.createDataFrame(rows, "uid string, id string, yr int, mo int, dy int, hr double, lat double, lon double, ds int, vs int, "
                                     "pt int, dck int").withColumn("ts", F.make_timestamp("yr", "mo", "dy", F.col("hr").cast("int"), F.lit(0), F.lit(0)))
    feats = TR.voyage_features(df, TR.default_parameters(None))
    got = {r["uid"]: r for r in feats.select("uid", "course", "distance", "midpoint_diff").collect()}
    assert got["u1"]["course"] == 0.0 and got["u1"]["distance"] == 0.0  # no way between two reports at one place
    assert abs(got["u2"]["course"]) % 360 < 1e-9 and abs(got["u2"]["distance"] - 111.195) < 0.01
    assert abs(got["u2"]["midpoint_diff"] - 111.195 / 2) < 0.01
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the final plan, without running it
    try:
        plan = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(
            TR.voyage_features(df, TR.default_parameters(None))._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert sizes and max(sizes) < 8000
