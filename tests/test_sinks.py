"""Sinks and scans round-trip through files in a private scratch folder."""

import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.plans import adapters as A
from tidewater.sources import fixed_width as FW
from tidewater.sources import sinks as K
from tidewater.sources import tables as T


def test_cdm_roundtrip(spark):
    out = tempfile.mkdtemp(prefix="tw-cdm-")
    h = A.view(spark, SF_SMALL, A.HEADER_SQL)
    cols = ["report_id", "primary_station_id", "report_timestamp", "history"]
    K.write_cdm(h, cols, out, partition_by=["sid_dck"])
    back = T.read_cdm(spark, out, cols)
    assert back.count() == h.count()
    assert back.where(F.col("primary_station_id").isNull()).count() == h.where(F.col("primary_station_id").isNull()).count()


def test_reports_pipe_roundtrip(spark):
    out = tempfile.mkdtemp(prefix="tw-rep-")
    r = A.reports(spark, SF_SMALL)
    cols = [c.lower() for c in T.REPORT_COLUMNS]
    r2 = r.select(*[F.col(c) if c in r.columns else F.lit(None).cast("string").alias(c) for c in cols])
    r2.write.mode("overwrite").csv(out, sep="|", header=False, nullValue="")
    back = T.read_reports(spark, out)
    assert back.count() == r.count()
    assert back.where(F.col("SST").isNotNull()).count() == r.where(F.col("sst").isNotNull()).count()


def test_partition_lines(spark):
    out = tempfile.mkdtemp(prefix="tw-lines-")
    lines = A.view(spark, SF_SMALL, A.LINES_SQL)
    FW.partition_lines(lines, out)
    back = spark.read.text(out)
    assert back.count() == lines.count()
    assert back.select("tag").distinct().count() > 1
    assert back.select("value").exceptAll(lines.select("value")).count() == 0


def test_flag_block_prints_nine(spark):
    df = spark.createDataFrame([("a", 1, None, 1), ("b", 0, 1, 0)], "uid string, sst_bud int, sst_clim int, month_match int")
    rows = {r["UID"]: (r["bud"], r["clim"]) for r in K.flag_block(df, "SST", ["bud", "clim"]).collect()}
    assert rows == {"a": (1, 9)}


def test_read_edition_delimited_and_fixed(spark):
    import os

    from tidewater.sources.editions import read_edition

    d = tempfile.mkdtemp(prefix="tw-ed-")
    rows = ["ÅRHUS;12.00;3,5;ot", "BELLE ÎLE;NA;-4/5;", ";OT;12 M;abc"]
    with open(os.path.join(d, "ed.txt"), "w", encoding="iso-8859-1") as fh:
        fh.write("\n".join(rows) + "\n")
    cols = [("name", "object", 10), ("vsslM", "int", 5), ("platH", "float", 6), ("call", "object", 3)]
    got = [tuple(r) for r in read_edition(spark, d, cols).collect()]
    assert sorted(got) == sorted([("ÅRHUS", 12, 3.5, "OT"), ("BELLE ÎLE", -999999, 4.5, "NULL"),
                                  ("NULL", 0, 12.0, "ABC")])
    f = tempfile.mkdtemp(prefix="tw-edf-")
    with open(os.path.join(f, "ed.txt"), "w", encoding="iso-8859-1") as fh:
        fh.write("ÅRHUS     12.00   3,5ot \n" + "          NA     -4/5   \n")
    got = sorted(tuple(r) for r in read_edition(spark, f, cols, fmt="fixed").collect())
    assert got == sorted([("ÅRHUS", 12, 3.5, "OT"), ("NULL", -999999, 4.5, "NULL")])
