"""Operator 1: mix sources to target weights (Efraimidis-Spirakis sampling).

A source's target comes from its weight; complete epochs are taken first and
the rest is a weighted sample without replacement: every document gets the
exponential key ``-ln(u) / quality`` (``u`` from a hash of its id), documents
are put in key order within their source and taken while the running sum of
their sizes stays within the budget.

Scale: the order within a source is found on narrow rows and cut into about
sqrt(n) key ranges, so the running sum is a sum over earlier ranges plus a sum
inside one range; no window holds a whole source, however large.  What comes
out is the last key that is taken, one row per source, and the documents
themselves are only compared with it: their texts are not shuffled here.  The
only global step is one row per source.

Edge cases: null text has size 0; null source is a source of its own, last in
order; a source of size 0 has target 0; equal keys are ordered by id, size and
``tie`` (such as a digest of the text), and a null id is hashed by ``tie``, so rows without id are taken at random
like others; rows equal in all of these are taken together, none more often than ``max_epochs`` allows; texts of any
length count whole; an empty table gives no rows; input columns that carry a name of the result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: 52 hash bits, so that u is exact in a double.
_U_BITS = 52


def unit_hash(doc_id: Column, seed: str, tie: Column) -> Column:
    """Uniform number in (0, 1) decided by the seed and the id, or by ``tie`` where there is none."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), tie)))
    bits = F.conv(F.substring(F.md5(text), 1, _U_BITS // 4), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(2**_U_BITS))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float,
                   max_epochs: float) -> DataFrame:
    """``sizes`` (source, source_size) -> the same with ``target``.

    Targets are ``min(max_epochs * size, level * weight)`` with the level at
    which they add up to ``share`` of all sizes: sources are ordered by the
    level at which they are full, and the first one that is not full at the
    level left for it and all later ones sets it.  One row per source, the
    only step that sees all sources at once.
    """
    every = Window.partitionBy()
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    fill = every.orderBy("__full", F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sizes.withColumn("__w", F.element_at(kinds, place))
        .withColumn("__cap", F.col("source_size").cast("double") * max_epochs)
        .withColumn("__full", F.col("__cap") / F.col("__w"))
        .withColumn("__budget", F.sum("source_size").over(every).cast("double") * share)
        .withColumn("__left", F.col("__budget") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
        .withColumn("__wleft", F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), F.lit(0.0)))
        .withColumn("__level", F.col("__left") / F.col("__wleft"))
        .withColumn("__rank", F.row_number().over(fill))
        .withColumn("__open", F.when(F.col("__level") <= F.col("__full"), F.struct("__rank", "__level")))
        .withColumn("__first", F.min("__open").over(every))
        .withColumn("target", F.when(F.col("__first").isNotNull() & (F.col("__rank") >= F.col("__first.__rank")),
                                     F.col("__first.__level") * F.col("__w")).otherwise(F.col("__cap")))
        .select("source", "source_size", "target", "__n")
    )


def mix_to_targets(docs: DataFrame, size: Column, quality: Column, weights: Sequence[float] = (5, 2, 1),
                   share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix", tie: Column | None = None) -> DataFrame:
    """``docs`` (doc_id, source, ...) plus ``size``, ``source_size``,
    ``target`` (its source's), ``copies`` (times the mix takes the document)
    and ``taken`` (``copies * size``)."""
    tie = F.coalesce((F.lit("") if tie is None else tie).cast("string"), F.lit(""))
    new = {"size", "source_size", "target", "copies", "taken"}
    keep = [c for c in docs.columns if c not in new]
    key = -F.log(unit_hash(F.col("doc_id"), seed, F.col("__tie"))) / F.col("__q")
    rows = (
        docs.withColumns({"__size": size, "__q": F.greatest(quality.cast("double"), F.lit(1e-9)), "__tie": tie})
        .withColumn("__key", key)
        .select(*keep, F.col("__size").cast("long").alias("size"), "__key", "__tie")
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__n"))
    plan = materialise(
        source_targets(sizes, weights, share, max_epochs)
        .withColumn("__epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                    .otherwise(F.lit(0)).cast("long"))
        .withColumn("__rest", F.col("target") - F.col("__epochs") * F.col("source_size")),
        "mix-plan")
    # the order of a source, on narrow rows: running sums by key range, then inside it
    units = rows.groupBy("source", "__key", "doc_id", "size", "__tie").agg(F.count("*").alias("__rows"))
    units = units.withColumn("__sum", F.col("size") * F.col("__rows"))
    place = F.floor((1 - F.exp(-F.col("__key"))) * F.ceil(F.sqrt(F.col("__n")))).cast("long")
    here = materialise(
        units.join(plan.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
        .select("__s", "__rest", place.alias("__range"), F.struct("__key", "doc_id", "size", "__tie").alias("__at"), "__sum"), "mix-order")
    base = (
        here.groupBy("__s", "__range").agg(F.sum("__sum").alias("__base"))
        .withColumn("__base", F.sum("__base").over(Window.partitionBy("__s").orderBy("__range")) - F.col("__base"))
        .select(F.col("__s").alias("__bs"), F.col("__range").alias("__br"), "__base")
    )
    inner = Window.partitionBy("__s", "__range").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    # the document on the edge is taken if that brings the sum nearer to the target
    taken = (
        here.join(base, F.col("__s").eqNullSafe(F.col("__bs")) & (F.col("__range") == F.col("__br")))
        .withColumn("__end", F.col("__base") + F.sum("__sum").over(inner))
        .where(F.col("__end") - F.col("__sum") / 2 <= F.col("__rest"))
    )
    edge = taken.groupBy("__s").agg(F.max("__at").alias("__edge"))
    rule = materialise(plan.withColumnRenamed("source", "__ps").join(edge, F.col("__ps").eqNullSafe(F.col("__s")), "left").drop("__s"), "mix-rule")
    last = F.coalesce(F.struct("__key", "doc_id", "size", "__tie") <= F.col("__edge"), F.lit(False))
    return (
        rows.join(rule, F.col("source").eqNullSafe(F.col("__ps")))
        # empty documents at the front of the order would get one more where nothing is left to take
        .withColumn("copies", F.least(F.col("__epochs") + last.cast("long"), F.ceil(F.lit(float(max_epochs)))))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(*keep, "size", "source_size", "target", "copies", "taken")
    )
