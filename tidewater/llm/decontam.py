"""Operator 10 [native]: benchmark decontamination by SimHash windows.

A document holds a benchmark item if one of its windows, as many words long as
the item, has a weighted shingle similarity of 0.8 or more with it: shingles
are 5 lower-case words, a shingle's weight is how often it occurs, and the
similarity is the sum of the smaller weights over the sum of the larger ones.

1. Windows.  A window that similar shares most of its shingles with items of
   its size, and the best window for an item starts at such a shingle.  So
   windows are taken at shingles that items of that size have, where enough of
   them lie within the window; this loses no match.
2. Fingerprints.  Every window and item gets a 64-bit SimHash of its words.
3. Multi-index blocks.  A fingerprint is cut into 4 blocks of 16 bits; item
   blocks are listed with all values up to 3 bits away.  Two fingerprints up
   to RADIUS = 15 bits apart agree with the listed values in some block, so
   every window within the radius of an item meets it in an equi-join.
   The fingerprint is over words and the similarity over shingles, so 0.8 does
   not bound the distance: a run of one word at an end that is replaced may
   turn more than 15 bits.  Such pairs meet in rare shingles: a match shares
   0.8 of an item's shingles, so at least one of its rarest fifth (and one
   more), which windows are joined with.  This loses no match.
4. Verification on the full shingles of window and item.

Scale: documents are never paired with each other; the shingle table of the
benchmark is broadcast while it has at most MAX_BROADCAST rows, beyond that
Spark joins by shuffle.  What is grouped by document is bounded by its length.

Edge cases: null, blank and empty texts and items match nothing; an item of
fewer than 5 words is one shingle; a document shorter than the item is one
window; rows that share an id are searched each by itself and report what any
of them holds; of equally similar windows the last is reported; null ids count as
one document and come back null; an item without id, or one of several texts under one id, is searched
like any other and reported by its id; texts of any length are read whole; other columns are not looked at; empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GAP, LAST_ID, WORD, materialise

SHINGLE = 5
BLOCKS, BLOCK_RADIUS = 4, 3
BITS = 64 // BLOCKS
#: Fingerprints this near are guaranteed to meet.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
MAX_BROADCAST = 1_000_000
_BLANKS = " \t\n\x0b\x0c\r"


def lower_words(text: Column) -> Column:
    """Lower-case words; null, blank and empty texts give null."""
    bare = F.btrim(F.lower(text), F.lit(_BLANKS))
    return F.when(bare != "", F.split(bare, GAP))


def grams(words: Column, size: Column | int) -> Column:
    """Hash of the ``size`` words from each position on (of all, if there are
    fewer).  A number of words that is known beforehand needs no slices; both
    forms give the same hashes."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0)))
    if isinstance(size, int):
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, size)))


def enough(shingles: Column, hundredths: int) -> Column:
    """Fewest shared shingles with which two windows of so many can reach the similarity."""
    return F.greatest(F.ceil(shingles * (2 * hundredths) / (100 + hundredths) - 1e-9), F.lit(1)).cast("int")


def simhash(words: DataFrame, keys: list[str], word: str) -> DataFrame:
    """``keys`` and ``mark``: per group the majority of every bit of the word hashes."""
    bits = words.select(*keys, F.xxhash64(word).alias("__h"))
    sums = bits.groupBy(*keys).agg(F.count("*").alias("__n"), *[
        F.sum(F.shiftrightunsigned("__h", b).bitwiseAND(1)).alias(f"__b{b}") for b in range(64)])
    mark = F.lit(0).cast("long")
    for b in range(64):
        mark = mark.bitwiseOR(F.when(F.col(f"__b{b}") * 2 > F.col("__n"), F.shiftleft(F.lit(1).cast("long"), b))
                              .otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, mark.alias("mark"))


def _block(mark: Column, i: int) -> Column:
    return F.shiftrightunsigned(mark, i * BITS).bitwiseAND(2**BITS - 1)


def _rare(bench: DataFrame, hundredths: int) -> DataFrame:
    """(size, h, item): the rarest shingles of each item, so many that what
    is left weighs less than a match shares."""
    held = bench.select("item", "size", F.explode("grams").alias("h")).groupBy("item", "size", "h").agg(
        F.count("*").alias("ic"))
    often = held.groupBy("size", "h").agg(F.count("*").alias("holders"))
    by_item = Window.partitionBy("item", "size")
    upto = F.sum("ic").over(by_item.orderBy("holders", "h").rowsBetween(Window.unboundedPreceding, 0))
    left = F.sum("ic").over(by_item) - upto + F.col("ic")  # weight of this shingle and the more frequent ones
    return held.join(often, ["size", "h"]).withColumn("left", left).withColumn("all", F.sum("ic").over(by_item)).where(
        F.col("left") * 100 >= F.col("all") * hundredths).select("size", "h", "item")


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", hundredths: int = 80) -> DataFrame:
    """``docs`` (doc_id, <text>) and ``items`` (item_id, <text>) -> (doc_id,
    item_id, similarity, start_word): every pair that reaches the similarity,
    with its best window."""
    best = leaking_texts(docs, items, text, hundredths).groupBy("doc", "item_id").agg(F.max("b").alias("b"))
    return best.select(F.when(F.col("doc") != LAST_ID, F.col("doc")).alias("doc_id"), "item_id",
                       F.col("b.s").alias("similarity"), F.col("b.start").cast("long").alias("start_word"))


def leaking_texts(docs: DataFrame, items: DataFrame, text: str = "text", hundredths: int = 80) -> DataFrame:
    """The same for each text of an id: (doc, t, item_id, b), with t the
    xxhash64 of the text, b the best window and LAST_ID for a null id."""
    given = materialise(items.select("item_id", lower_words(F.col(text)).alias("words")).where("words is not null").distinct(), "items")
    # an item is a text: ids may be missing or stand on several texts
    bench = materialise(
        given.select("words").distinct().withColumn("item", F.monotonically_increasing_id())
        .withColumn("size", F.size("words")).withColumn("gram", F.least("size", F.lit(SHINGLE)))
        .withColumn("grams", grams(F.col("words"), F.col("gram"))), "bench")
    ids = given.join(bench.select("words", "item"), "words").select("item", "item_id")
    gram_sizes = [r["gram"] for r in bench.select("gram").distinct().collect()]  # at most SHINGLE rows
    seeds = materialise(bench.select(F.explode("grams").alias("h"), "size", "gram").distinct(), "seeds")
    if seeds.count() <= MAX_BROADCAST:
        seeds = F.broadcast(seeds)
    texts = docs.where(F.col(text).rlike(WORD)).select(
        F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    pages = texts.select("doc", "t", lower_words(F.col("text")).alias("words"))

    # 1. windows where shingles of items of their size lie dense enough
    hits = None
    for g in gram_sizes or [SHINGLE]:
        # outer: Spark would evaluate the shingles once more to filter empty arrays, of which there are none
        at = pages.select("doc", "t", F.size("words").alias("n"), F.posexplode_outer(grams(F.col("words"), g)).alias("pos", "h"))
        part = at.join(seeds.where(F.col("gram") == g), "h").select("doc", "t", "n", "size", "gram", "pos")
        hits = part if hits is None else hits.unionByName(part)
    span = F.col("size") - F.col("gram")
    need = enough(F.least(F.col("size"), F.col("n")) - F.col("gram") + 1, hundredths)
    start = F.greatest(F.least(F.col("pos"), F.col("n") - F.col("size")), F.lit(0))
    dense = (
        hits.groupBy("doc", "t", "n", "size", "gram").agg(F.sort_array(F.collect_list("pos")).alias("all"))
        .withColumn("need", F.when(F.col("n") < F.col("size"), F.lit(1)).otherwise(need))
        .withColumn("pos", F.filter("all", lambda p, i: F.coalesce(
            F.get("all", i + F.col("need") - 1) - p <= span, F.lit(False))))
        .select("doc", "t", "n", "size", "gram", F.explode("pos").alias("pos"))
        .select("doc", "t", "size", "gram", start.alias("start")).distinct()
    )
    key = ["doc", "t", "size", "start"]
    windows = materialise(
        texts.join(dense, ["doc", "t"]).withColumn("words", lower_words(F.col("text")))
        .select(*key, "gram", F.slice("words", F.col("start") + 1, F.col("size")).alias("words")).dropDuplicates(key), "windows")

    # 2. fingerprints
    marks = simhash(windows.select(*key, F.explode("words").alias("w")), key, "w")
    item_marks = simhash(bench.select("item", "size", F.explode("words").alias("w")), ["item", "size"], "w")

    # 3. blocks
    near = [m for m in range(2**BITS) if m.bit_count() <= BLOCK_RADIUS]
    listed = item_marks.select(
        "item", "size", F.col("mark").alias("i_mark"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("block"), _block(F.col("mark"), i).alias("v")) for i in range(BLOCKS)])).alias("b"))
    listed = listed.select("item", "size", "i_mark", "b.block", F.col("b.v").alias("v0"), F.explode(F.lit(near)).alias("m"))
    listed = listed.select("item", "size", "i_mark", "block", F.col("v0").bitwiseXOR(F.col("m")).alias("v"))
    asked = marks.select(
        *key, "mark",
        F.explode(F.array(*[F.struct(F.lit(i).alias("block"), _block(F.col("mark"), i).alias("v")) for i in range(BLOCKS)])).alias("b"))
    # not broadcast: 2,788 rows an item, small as they are written, would stand in the driver's memory
    met = asked.select(*key, "mark", "b.block", "b.v").join(listed.hint("merge"), ["size", "block", "v"])
    near_pairs = met.where(F.bit_count(F.col("mark").bitwiseXOR(F.col("i_mark"))) <= RADIUS).select(*key, "item")

    # matches outside the radius: at least one of the rarest shingles of the item lies in the window
    rare = materialise(_rare(bench, hundredths), "rare")
    if rare.count() <= MAX_BROADCAST:
        rare = F.broadcast(rare)
    laid = windows.select(*key, F.explode(F.array_distinct(grams(F.col("words"), F.col("gram")))).alias("h"))
    pairs = near_pairs.unionByName(laid.join(rare, ["size", "h"]).select(*key, "item")).distinct()

    # 4. exact similarity
    counts = windows.select(*key, F.explode(grams(F.col("words"), F.col("gram"))).alias("h")).groupBy(*key, "h").agg(
        F.count("*").alias("c"))
    item_counts = bench.select("item", F.size("grams").alias("i_all"), F.explode("grams").alias("h")).groupBy(
        "item", "i_all", "h").agg(F.count("*").alias("ic"))
    every = windows.select(*key, F.size(grams(F.col("words"), F.col("gram"))).alias("all"))
    shared = (
        pairs.join(counts, key).join(item_counts, ["item", "h"])
        .groupBy(*key, "item", "i_all").agg(F.sum(F.least("c", "ic")).alias("both"))
        .join(every.distinct(), key)
    )
    either = F.col("all") + F.col("i_all") - F.col("both")
    return (
        shared.where(F.col("both") * 100 >= either * hundredths)
        .groupBy("doc", "t", "item").agg(F.max(F.struct((F.col("both") / either).alias("s"), "start")).alias("b"))
        .join(ids, "item").select("doc", "t", "item_id", "b")
    )
