"""Operator 11 against counting row by row in every order."""

import itertools
import re

from pyspark.sql import functions as F

from tidewater.llm import audit

from . import brute

LABELS = "doc_id long, quality int, toxic int"


def conditions(text, smaller):
    w = brute.words(text)
    return {
        "A": len(w) < 200,
        "B": 100 * len(set(w)) < 50 * len(w),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
        "E": smaller,
    }


def by_rows(docs, labels):
    rows = []
    for i, t, s in docs:
        text = t or ""
        smaller = any(j is not None and (t2 or "") == text and (i is None or j < i) for j, t2, _ in docs)
        hit = [x for x in labels if x[0] is not None and x[0] == i]
        rows.append((s or "", conditions(text, smaller), any(x[1] == 1 for x in hit), any(x[2] == 1 for x in hit)))
    out, shapley = {}, {}
    for order in itertools.permutations("ABCDE"):
        for part in {r[0] for r in rows}:
            alive = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in alive if r[1][f]]
                alive = [r for r in alive if not r[1][f]]
                fails = [r for r in rows if r[0] == part and r[1][f]]
                out[part, "".join(order), step] = [
                    len(alive), len(gone), len(fails) - len(gone), sum(sum(r[1].values()) == 1 for r in fails),
                    sum(r[2] for r in gone), sum(r[3] for r in gone), f]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: (*v[:-1], shapley[k[0], v[-1]]) for k, v in out.items()}


def test_audit_against_rows(spark):
    long = " ".join(f"w{i}" for i in range(250))
    docs = [
        (1, long, "a"), (2, long, "a"), (3, long + " #", "a"), (4, long.upper(), "b"), (5, "x y " * 150, "b"), (6, "x y " * 150, None),
        (7, None, "a"), (8, "", "a"), (None, "", "b"), (None, "", "b"), (None, long, ""), (9, "AB " * 40, None), (2, long + " z", "a"),
        (10, "é ß 你 " * 80 + long, "b"), (11, "one $", "c"), (11, "one $", "c"), (12, " ".join(f"v{i}" for i in range(20000)), "c"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, None), (None, 1, 1), (7, 1, 0), (9, None, 1), (5, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns(
        {"part": F.lit(1), "r": F.lit("x"), "prefix": F.lit(2), "A": F.lit(0), "good": F.lit(3)}).repartition(4)
    got = audit.audit_texts(frame, spark.createDataFrame(labels, LABELS)).collect()
    want = by_rows(docs, labels)
    assert len(got) == len(want)
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got} == want


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert audit.audit_texts(empty, spark.createDataFrame([], LABELS)).count() == 0
    one = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, source string")
    got = audit.audit_texts(one, spark.createDataFrame([], LABELS)).collect()
    assert len(got) == 600 and {r.part for r in got} == {""}
    assert all(r.shapley == (120 if r.filter_order[r.step - 1] == "A" else 0) for r in got)


def test_failing_ids_do_not_depend_on_labels(spark):
    """Removing an id table from the relations changes what the others remove."""
    rows = spark.createDataFrame([(i, "p", 0, 0) for i in range(10)], "r long, part string, good int, toxic int")
    fails = {"X": rows.where("r < 6").select("r"), "Y": rows.where("r >= 4").select("r")}
    removed, kept = audit.prefix_counts(rows, fails)
    assert {(r.prefix, r["filter"]): r.removed for r in removed.collect()} == {(0, "X"): 6, (0, "Y"): 6, (1, "Y"): 4, (2, "X"): 4}
    assert {r.prefix: r.kept for r in kept.collect()} == {0: 10, 1: 4, 2: 4}
