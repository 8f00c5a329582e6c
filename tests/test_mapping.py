"""Rule tables compiled to projections."""

import pytest

from tidewater.operators import mapping as MAP

RULES = [
    MAP.Rule("header", "report_id", ("uid",), "prefix:R-", required=True),
    MAP.Rule("header", "station", ("id",), "trim", default="none"),
    MAP.Rule("header", "kind", ("pt",), "code:pt", default="0"),
    MAP.Rule("header", "source", ("pt", "id"), "join:/"),
    MAP.Rule("observations-at", "report_id", ("uid",), "prefix:R-"),
    MAP.Rule("observations-at", "observation_value", ("at",), "kelvin:2", required=True),
]


def test_rules_make_tables(spark):
    d = spark.createDataFrame([("1", " A ", 5, 10.0), ("2", "  ", 9, None), (None, "B", 5, 1.0), ("4", None, None, -273.15)],
                              "uid string, id string, pt int, at double")
    got = MAP.map_to_cdm(d, RULES, {"pt": {"5": "2"}})
    assert {tuple(r) for r in got["header"].collect()} == {
        ("R-1", "A", "2", "5/ A "), ("R-2", "none", "0", "9/  "), ("R-4", "none", "0", None)}
    assert {tuple(r) for r in got["observations-at"].collect()} == {("R-1", "283.15"), (None, "274.15"), ("R-4", "0.00")}
    assert all(t == "string" for x in got.values() for _, t in x.dtypes)


def test_faulty_rules_are_errors():
    with pytest.raises(ValueError, match="two rules"):
        MAP.compile_rules([MAP.Rule("header", "a", (), "constant:1"), MAP.Rule("header", "a", (), "constant:2")])
    with pytest.raises(ValueError, match="no transform"):
        MAP.compile_rules([MAP.Rule("header", "a", ("x",), "nothing")])
