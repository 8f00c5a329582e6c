"""The pipeline end to end on the smallest tables, and its odd rows."""

import corpus_pipeline
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.llm import common

from . import brute


def test_stages(spark):
    docs = common.table(spark, SF_SMALL, "documents")
    columns = docs.columns
    odd = spark.createDataFrame([(None, None, "en", None), (-5, "", "en", "src0"), (-6, "", None, "src0")],
                                "doc_id long, text string, lang string, source string")
    docs = docs.unionByName(odd, allowMissingColumns=True).withColumn("size", F.lit(3)).withColumn("score", F.lit("x"))
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = common.materialise(stage(spark, before, SF_SMALL), f"t-{name}")
        if name != "sharding":
            assert after.columns == columns
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before.where("doc_id is not null").collect()]
            want = {i for i, (_, c) in brute.near_components(rows, 5).items() if i == c}
            assert {r.doc_id for r in after.collect() if r.doc_id is not None} == want
        if name == "mixing":
            assert after.select("doc_id").distinct().count() <= before.count() < after.count()
        if name == "sharding":
            assert after.count() == before.count()
        before = after


def test_near_duplicates_without_ids(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(100)) for k in "abc")
    rows = [(5, a), (9, b), (None, a + " more"), (None, b + " more"), (None, c), (None, c + " more"), (None, c), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text[:1]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF_SMALL).collect()]
    assert sorted(got, key=str) == [(5, "a"), (9, "b"), (None, ""), (None, "c")]


def test_leaks_of_rows_without_or_with_repeated_ids(spark, tmp_path):
    item = " ".join(f"b{i}" for i in range(30))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, "x " + item), (None, "clean one"), (4, item + " y"), (4, "clean two"), (5, "clean three"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path)).collect()]
    assert sorted(got, key=str) == [(4, "clean two"), (5, "clean three"), (None, "clean one"), (None, None)]


def test_run_on_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        common.table(spark, SF_SMALL, t).where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_of_any_name_stay(spark, tmp_path):
    """Extra columns that carry the stages' own names come back unchanged."""
    item = " ".join(f"b{i}" for i in range(30))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int").withColumn("quality", F.lit(1)).write.parquet(
        f"{tmp_path}/labels.parquet")
    rows = [(i, f"text number {i} " + ("nasty stuff" if i % 2 else "fine words") * 3, "en", "s") for i in range(40)]
    rows += [(50, item, "en", "s"), (51, "fine words alone", "en", "s"), (51, "fine words alone", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    odd = {c: F.concat(F.lit(c), F.col("doc_id")) for c in ("k__", "h__", "t__", "maybe__", "n", "size", "copies", "words__", "label")}
    before = docs = docs.withColumns(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, str(tmp_path))
        assert after.columns == docs.columns
        assert all(r[c] == f"{c}{r.doc_id}" for r in after.collect() for c in odd)
        before = after


def test_no_labels_no_classifier(spark, tmp_path):
    common.table(spark, SF_SMALL, "labels").where("false").write.parquet(f"{tmp_path}/labels.parquet")
    docs = common.table(spark, SF_SMALL, "documents")
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == docs.count()
    docs.limit(0).select(F.lit(1).alias("item_id"), "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path)).count() == docs.count()
