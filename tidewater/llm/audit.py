"""Operator 11: how filters interact, from relations of failing ids.

Every filter is stored once as a table of the row numbers that fail it.  The
rows that survive a set of filters ("prefix", a bit mask) are a relation of
their own; a left-semi join of it with the next filter's table gives what that
filter removes there, a left-anti join what it leaves.  Prefixes of one size
are stacked in one table, so n filters need n rounds whatever the number of
orders, and a prefix is derived once, by its highest bit, not once an order.
All orders, redundancies and Shapley sums are then arithmetic on the counts by
(part, prefix, filter), a table bounded by parts * n * 2^(n-1).

Rows that fail nothing survive every prefix: one chain of left-anti joins
counts them and the rounds run on the others.  Rows are narrow (a row
number and a code for part and labels); texts are read once and never shuffled.

Edge cases: a null text is empty; a null part is the empty string; rows
without id and rows that repeat an id count each for themselves; of equal
texts the rows of the smallest id pass filter E, null ids are larger than any;
several labels of one id count as 1 if any is; an empty table gives no rows;
clashing extra columns do not matter, only the named ones are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, WORD, materialise, words_of

#: Limits of the five text filters (fixed values of the contract).
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SYMBOLS = 200, 50, 2, r"[#$%&*|]"


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text that is not null."""
    words = words_of(text)
    return {
        "A": F.regexp_count(text, F.lit(WORD)) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MAX_CAPITALS * F.char_length(text),
        "D": text.rlike(SYMBOLS),
    }


def number_rows(docs: DataFrame, text: str, part: str, labels: DataFrame) -> DataFrame:
    """(r, id, part, good, toxic, digest, A .. D): a row number, what rows are
    counted by, and the conditions; written once, so the numbers stay."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").alias("label_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"), F.sha2(body.cast("binary"), 256).alias("digest"),
        *[c.alias(name) for name, c in text_conditions(body).items()])
    best = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    joined = rows.join(best, "label_id", "left").withColumn("r", F.monotonically_increasing_id())
    return materialise(joined.select("r", "id", "part", "digest", F.coalesce("good", F.lit(0)).cast("byte").alias("good"),
                                     F.coalesce("toxic", F.lit(0)).cast("byte").alias("toxic"), "A", "B", "C", "D"), "audit-rows")


def copies(rows: DataFrame) -> DataFrame:
    """Rows whose text a smaller id has: what is left when every digest's
    smallest id is taken away.  Joined on digest and id, so a text that a
    third of all rows share is no hot key."""
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id"))
    return rows.join(firsts, ["digest", "id"], "left_anti")


def failing(rows: DataFrame, conditions: dict[str, DataFrame | Column]) -> dict[str, DataFrame]:
    """One stored id table (r) per filter."""
    return {name: materialise((rows.where(c) if isinstance(c, Column) else c).select("r"), f"audit-{name}")
            for name, c in conditions.items()}


def prefix_counts(rows: DataFrame, fails: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``rows`` (r, part, good, toxic) and failing ids -> (part, prefix,
    filter, removed, good_lost, toxic_lost) for every prefix without the
    filter, where any row is removed, and (part, prefix, kept), where any row
    that fails something is left, with prefix -1 for the rows that fail nothing."""
    count = [F.count(F.lit(1)).alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost")]
    tables = list(fails.values())
    clean = rows
    for t in tables:
        clean = clean.join(t, "r", "left_anti")
    any_fail = tables[0]
    for t in tables[1:]:
        any_fail = any_fail.unionByName(t)
    dirty = rows.join(any_fail, "r", "left_semi").select(F.lit(0).cast("int").alias("prefix"), "r", "part", "good", "toxic")
    alive = materialise(dirty, "audit-survivors")
    kept = [clean.groupBy("part").agg(F.count(F.lit(1)).alias("kept")).select("part", F.lit(-1).alias("prefix"), "kept")]
    removed = []
    for _ in range(len(tables)):
        kept.append(alive.groupBy("part", "prefix").agg(F.count(F.lit(1)).alias("kept")))
        left = []
        for bit, (name, t) in enumerate(fails.items()):
            open_ = alive.where((F.col("prefix").bitwiseAND(F.lit(1 << bit))) == 0)
            gone = open_.join(t, "r", "left_semi")
            removed.append(gone.groupBy("part", "prefix").agg(*count).withColumn("filter", F.lit(name)))
            left.append(open_.where(F.col("prefix") < (1 << bit)).join(t, "r", "left_anti")
                        .withColumn("prefix", F.col("prefix") + F.lit(1 << bit)))
        step = left[0]
        for x in left[1:]:
            step = step.unionByName(x)
        # counts of this round are written before the next one starts, so no plan holds more than one round
        removed[-len(tables):] = [_stored(removed[-len(tables):], "audit-removed")]
        alive = materialise(step.select("prefix", "r", "part", "good", "toxic"), "audit-survivors")
    kept = _stored(kept, "audit-kept")
    out = removed[0]
    for x in removed[1:]:
        out = out.unionByName(x)
    return out, kept


def _stored(frames: list[DataFrame], name: str) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return materialise(out, name)


def order_steps(names: Sequence[str]) -> list[tuple[str, int, str, int, int]]:
    """(order, step, filter, prefix before, prefix after) of all permutations."""
    bit = {n: 1 << i for i, n in enumerate(names)}
    out = []
    for order in permutations(names):
        before = 0
        for step, name in enumerate(order, 1):
            out.append(("".join(order), step, name, before, before | bit[name]))
            before |= bit[name]
    return out


def audit(rows: DataFrame, fails: dict[str, DataFrame]) -> DataFrame:
    """One row per part, order of all filters and step, zeros included."""
    spark, names = rows.sparkSession, list(fails)
    n, full = len(names), (1 << len(names)) - 1
    removed, kept = prefix_counts(rows.select("r", "part", "good", "toxic"), fails)
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    # the grid of (part, prefix, filter): fixed pairs, exploded from every part
    pairs = [(p, name, p | 1 << i) for i, name in enumerate(names) for p in range(full + 1) if not p >> i & 1]
    grid = parts.select("part", "rows", F.explode(F.array(*[
        F.struct(F.lit(p).alias("prefix"), F.lit(name).alias("filter"), F.lit(q).alias("after")) for p, name, q in pairs])).alias("g"))
    grid = grid.select("part", "rows", "g.*")
    cells = grid.join(removed, ["part", "prefix", "filter"], "left").na.fill(0, ["removed", "good_lost", "toxic_lost"])
    # a filter's counts over all prefixes, once for every part and filter
    weight = F.lit(0)
    for p in range(full + 1):
        k = bin(p).count("1")
        weight = F.when(F.col("prefix") == p, F.lit(factorial(k) * factorial(max(n - 1 - k, 0)))).otherwise(weight)
    alone = F.create_map(*[x for i, name in enumerate(names) for x in (F.lit(name), F.lit(full & ~(1 << i)))])
    whole = cells.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("prefix") == 0, F.col("removed")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("prefix") == alone[F.col("filter")], F.col("removed")).otherwise(0)).alias("unique_fails"),
        F.sum(F.col("removed") * weight).alias("shapley"))
    clean = kept.where("prefix = -1").select("part", F.col("kept").alias("clean"))
    left = kept.where("prefix >= 0").select("part", F.col("prefix").alias("after"), "kept")
    cells = (cells.join(whole, ["part", "filter"]).join(left, ["part", "after"], "left").join(clean, "part", "left"))
    steps = spark.createDataFrame(order_steps(names), "filter_order string, step int, filter string, prefix int, after int")
    out = cells.drop("after").join(F.broadcast(steps.drop("after")), ["prefix", "filter"])  # n * n! rows, 600 for five filters
    return out.select(
        "part", "filter_order", "step", (F.coalesce("kept", F.lit(0)) + F.coalesce("clean", F.lit(0))).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_texts(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """The five filters of the contract over all texts."""
    rows = number_rows(docs, text, part, labels)
    return audit(rows, failing(rows, {**{c: F.col(c) for c in "ABCD"}, "E": copies(rows)}))
