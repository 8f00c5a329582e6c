"""Corpus pipeline: documents through five training-data stages.

``STAGES`` holds (name, function) pairs; each function takes
(spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read back as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bloom, common, decontam, mixing, ring, setsketch, toxicity
from tidewater.llm.queries import quality_weights, text_tie

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _shield(docs: DataFrame, used: list[str]) -> DataFrame:
    """Columns that a stage does not use get names that no operator has."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in used else f"in__{c}") for c in docs.columns])


def _unshield(out: DataFrame, docs: DataFrame, used: list[str]) -> DataFrame:
    return out.select(*[F.col(c if c in used else f"`in__{c}`").alias(c) for c in docs.columns])


def _id(column: str = "doc_id"):
    return F.coalesce(F.col(column).cast("long"), F.lit(common.LAST_ID))


def _without(docs: DataFrame, key: dict[str, Column], rejected: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key stands in ``rejected`` (few rows): a
    Bloom filter lets most documents pass, and only the others are shuffled."""
    passed, others = bloom.split(docs.withColumns(key), list(key), rejected)
    return passed.unionByName(others.join(rejected, list(key), "left_anti"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier (learned from ``labels`` that
    are not held out) does not predict as toxic.  With no labels of both
    classes there is no classifier and every document stays."""
    used = ["doc_id", "text"]
    labels = common.table(spark, sf_dir, "labels").select("doc_id", "toxic").distinct()
    known = docs.select(*used).where(~common.held_out(F.col("doc_id"))).join(labels, "doc_id")
    model = toxicity.learn(known)
    if not model.fitted:
        return docs
    key = {"k__": _id(), "t__": F.xxhash64("text")}
    # rejected rows by id and text, found on small batches; the documents do not pass through Python
    scored = toxicity.score(docs.select(*used).withColumns(key), model, F.col("text"), list(key))
    toxic = common.materialise(scored.where("predicted = 1").select(*key).distinct(), "toxic")
    return _unshield(_without(_shield(docs, used), key, toxic), docs, used)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each component of texts whose 5-word
    shingle sets are 0.8 similar; a repeated row stays once."""
    used = ["doc_id", "text"]
    raw = F.col("text").cast("binary")
    key = {"k__": _id(), "h__": F.xxhash64(raw)}
    first = setsketch.first_rows(docs.select(*used), F.col("text"), shingle=5, threshold=0.8).toDF(*key)
    first = common.materialise(first, "first-rows")
    # keys of which not every row stays: not the first of a component, or repeated
    held = docs.select(*used).select(*[c.alias(k) for k, c in key.items()]).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    held = held.join(first.withColumn("stays", F.lit(True)), list(key), "left")
    changed = common.materialise(held.where("n > 1 or stays is null").select(*key), "changed")
    rows = _shield(docs, used).withColumns(key)
    passed, others = bloom.split(rows, list(key), changed)
    once = others.withColumn("t__", F.sha2(raw, 256)).dropDuplicates([*key, "t__"]).drop("t__")
    return _unshield(passed.unionByName(once.join(first, list(key), "left_semi")), docs, used)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    used = ["doc_id", "text"]
    items = common.table(spark, sf_dir, "benchmark").select("item_id", "text")
    leaks = decontam.leaking_texts(docs.select(*used), items).select("doc", "t").distinct().toDF("k__", "t__")
    rows = _shield(docs, used).withColumns({"k__": _id(), "t__": F.xxhash64("text")})
    return _unshield(rows.join(leaks, ["k__", "t__"], "left_anti"), docs, used)  # no Python in this stage


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken."""
    used = ["doc_id", "text", "source"]
    quality = quality_weights(common.table(spark, sf_dir, "labels"))
    sized = _shield(docs, used).withColumn("words__", common.word_count(F.col("text")))
    rows = sized.join(quality, "doc_id", "left")
    mixed = mixing.mix_to_targets(rows, F.col("words__"), F.coalesce("__quality", F.lit(1.0)), tie=text_tie(F.col("text")))
    taken = mixed.where("copies > 0").withColumn("copy__", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return _unshield(taken, docs, used)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return ring.shard_documents(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Model scores and sketches are not SQL; tests/llm holds the brute-force checks.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; rows of the last one."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
