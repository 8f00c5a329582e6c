"""Calendar steps (C9), text forms (C19), variable blocks (K7), flag filters (P5) and grid orientation."""

import datetime

from pyspark.sql import functions as F

from tidewater.functions import calendar as C
from tidewater.functions import text as TX
from tidewater.operators import grid_lookup as G
from tidewater.operators import select as S
from tidewater.sources import sinks as K


def test_calendar_steps(spark):
    rows = [(2000, 3, 1), (1999, 3, 1), (2000, 1, 1), (2001, 2, 29), (2001, 13, 1), (None, 1, 1), (1850, 12, 31), (1900, 2, 28)]
    df = spark.createDataFrame(rows, "yr int, mo int, dy int")
    day = ("yr", "mo", "dy")
    got = df.select(*day, C.previous_day(*day).alias("p"), C.julian_day(*day).alias("j")).collect()
    for r, (y, m, d) in zip(got, rows):
        try:
            want = datetime.date(y, m, d) - datetime.timedelta(1)
        except (ValueError, TypeError):
            assert (r.p.yr, r.p.mo, r.p.dy, r.j) == (None, None, None, None)
            continue
        assert (r.p.yr, r.p.mo, r.p.dy) == (want.year, want.month, want.day)
        assert r.j == want.toordinal() + 1 + 1721425  # day 1 of the calendar is 1721426
    step = spark.range(1).select(C.month_step(F.lit(2000), F.lit(1), -1).alias("a"), C.month_step(F.lit(1999), F.lit(12), 1).alias("b"),
                                 C.months_through(F.lit(1999), F.lit(11), F.lit(2000), F.lit(2)).alias("c"),
                                 C.months_through(F.lit(2000), F.lit(2), F.lit(1999), F.lit(2)).alias("d")).first()
    assert (tuple(step.a), tuple(step.b)) == ((1999, 12), (2000, 1))
    assert [tuple(x) for x in step.c] == [(1999, 11), (1999, 12), (2000, 1), (2000, 2)] and step.d == []


def test_hours_between(spark):
    def hours(*v):
        cols = [F.lit(x).cast("double" if i % 4 == 3 else "int") for i, x in enumerate(v)]
        return spark.range(1).select(C.hours_between(*cols).alias("h")).first().h

    assert hours(2000, 2, 28, 23.5, 2000, 3, 1, 0.5) == 25.0
    assert hours(2000, 3, 1, 0.5, 2000, 2, 28, 23.5) == -25.0
    assert hours(2000, 3, 1, None, 2000, 3, 1, 1.0) is None
    assert hours(2000, 3, 1, 24.0, 2000, 3, 1, 1.0) is None
    assert hours(2001, 2, 29, 1.0, 2001, 3, 1, 1.0) is None


def test_text_forms(spark):
    df = spark.createDataFrame([(2000, 2, 29, 0.5), (2001, 2, 29, 1.5), (None, 1, 1, None), (800, 1, 5, -2.5)],
                               "yr int, mo int, dy int, v double")
    got = df.select(TX.date_text("yr", "mo", "dy").alias("d"), TX.value_text("v").alias("t"), TX.scaled_integer("v", 1, -99).alias("i"))
    assert [tuple(r) for r in got.collect()] == [
        ("2000-02-29", "0.5", 0), ("0000-00-00", "1.5", 2), ("0000-00-00", "\\N", -99), ("0800-01-05", "-2.5", -2)]


def test_variable_block_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("u1", "S, 1  ", 2000, 1, 7, 1.0, 2.0, 3.0, 20.5, 18.0), ("u2", None, 2000, 2, 30, None, 2.0, 3.0, None, 18.0),
                                ("u3", '"Q"', 2001, 1, 1, 1.0, 2.0, 3.0, 20.5, None)],
                               "uid string, id string, yr int, mo int, dy int, hr double, lat double, lon double, sst double, sst_norm double")
    block = K.variable_block(df, ["sst"])
    out = str(tmp_path / "block")
    for _ in range(2):  # a rerun replaces its months
        K.write_variable_block(block, out)
    back = K.read_variable_block(spark, out, block.drop("f_yr", "f_mo").schema).drop("f_yr", "f_mo")
    assert sorted(map(repr, back.collect())) == sorted(map(repr, block.drop("f_yr", "f_mo").collect()))
    got = {r.UID: r for r in back.collect()}
    assert (got["u1"].PENTAD, got["u1"].SST_ANOM, got["u2"].DATE, got["u2"].PENTAD) == (2, 2.5, "0000-00-00", None)
    assert "\\N" in spark.read.text(out).where("value LIKE 'u3%'").first().value


def test_flag_split_keeps_every_row_once(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 0, 1), (3, None, 0), (4, 1, 1)], "i int, a int, b int")
    good, bad = S.flag_split(df, [("a", 0), ("b", 0)])
    assert [r.i for r in good.collect()] == [1] and sorted(r.i for r in bad.collect()) == [2, 3, 4]
    assert df.where(S.passes_flags([("a", 1)])).count() == 1


def test_grid_orientation(spark):
    cells = [(t, y, x, float(t * 100 + y * 10 + x)) for t in range(2) for y in range(2) for x in range(4)]  # 90-degree cells
    field = spark.createDataFrame(cells, "t int, y int, x int, value double")
    other = field.select("t", F.pmod(F.col("x") + 2, F.lit(4)).alias("y"), (1 - F.col("y")).alias("x"), "value")
    two = other.withColumn("z", F.lit(0)).unionByName(other.withColumn("z", F.lit(1)))
    got = G.as_grid_table(two, 2, 90.0, flip_lat=True, roll_lon=True, transpose=True, level="z")
    assert sorted(map(tuple, got.collect())) == cells
    assert G.as_grid_table(field.where("t < 0"), 2, 90.0).count() == 0
