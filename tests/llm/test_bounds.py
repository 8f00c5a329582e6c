"""Faults found on odd tables: samples at any size, ids that are missing or
stand on several texts, units of the mix."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import bloom, common, decontam, langid, mixing, toxicity


def test_sample_of_any_table_size(spark):
    rows = spark.range(200_000)
    for table_size in (10**3, 2 * 10**5, 2 * 10**6):
        n = rows.where(common.sampled(F.col("id"), 1000, table_size)).count()
        want = min(200_000, 200_000 * 1000 / table_size)
        assert abs(n - want) <= 6 * want**0.5
    # far beyond a million times the bound some rows are still learned from
    assert spark.range(1).select(common.sampled(F.lit(0), 40_000, 10**12)).count() == 1
    texts = spark.range(2_000_001).select(F.col("id").alias("doc_id"), F.lit("le la").alias("text"), F.lit("fr").alias("lang"))
    assert langid.learn(texts, max_train=3).langs == ["fr"]


def test_unfitted_toxicity_is_named(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, toxic int")
    one = spark.createDataFrame([(1, "a", 1)], "doc_id long, text string, toxic int")
    for labelled in (empty, one):
        model = toxicity.learn(labelled)
        assert not model.fitted
        assert not toxicity.score(one, model, F.col("text"), ["doc_id"]).first().fitted


def test_items_without_or_with_repeated_ids(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    items = spark.createDataFrame([(None, a), (None, b), (7, b), (7, c), (7, c), (8, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + a + " y"), (2, b), (3, "z " + c), (4, "clean " * 50)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.similarity) for r in decontam.find_leaks(docs, items).collect()}
    assert got == {(1, None, 1.0), (2, None, 1.0), (2, 7, 1.0), (3, 7, 1.0)}


@pytest.mark.parametrize("ids", ["null", "repeated", "own"])
def test_mix_meets_targets_without_ids(spark, ids):
    rows = [({"null": None, "repeated": 3, "own": i}[ids], "s", 10, f"text {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long, text string")
    got = mixing.mix_to_targets(docs, F.col("words"), F.lit(1.0), tie=F.md5("text")).collect()
    assert {r.target for r in got} == {1500.0}
    assert sum(r.taken for r in got) == 1500


def test_mix_takes_short_rows_without_ids_like_others(spark):
    rows = [(None, "s", 10 if i % 2 else 20, f"text {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long, text string")
    got = mixing.mix_to_targets(docs, F.col("words"), F.lit(1.0), tie=F.md5("text")).collect()
    twice = {size: np.mean([r.copies == 2 for r in got if r.size == size]) for size in (10, 20)}
    assert abs(twice[10] - 0.5) < 0.15 and abs(twice[20] - 0.5) < 0.15


def test_mix_never_exceeds_its_epochs(spark):
    rows = [(i, "a" if i < 90 else "b", 0 if i % 3 else 10, "") for i in range(180)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long, text string")
    assert max(r.copies for r in mixing.mix_to_targets(docs, F.col("words"), F.lit(1.0), share=9.0).collect()) == 2


def test_bloom_split_keeps_every_row(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("wide").alias("text"))
    wanted = rows.where("k % 10 = 0").select("k")
    passed, others = bloom.split(rows, ["k"], wanted)
    assert passed.count() + others.count() == 1000
    assert passed.where("k % 10 = 0").count() == 0 and others.count() < 130
    passed, others = bloom.split(rows, ["k"], wanted.limit(0))
    assert passed.count() == 1000 and others.count() == 0
