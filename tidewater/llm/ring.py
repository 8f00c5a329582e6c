"""Operator 7 [native]: consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a ring of 64-bit hashes; a document
belongs to the next point clockwise from the hash of its id.  A shard holds
at most its share of the rows (``n / shards``, the remainder going to the
first shards); keys beyond it continue clockwise to the next shard with room.
The shares add up to all rows, so counts differ by at most one, and only
overflowing keys leave the place the ring alone gives them.

Scale: the arcs between points are ``shards * vnodes`` rows whatever the
input, so their counts are settled on the driver and come back as a broadcast
table of pieces (arc, first rank, last rank, shard, first slot).  Ranks inside
an arc are a running sum over about sqrt(n) cells plus one inside a cell.
Rows that agree in everything are counted before the shuffle and laid out
again at the end.

Edge cases: null text counts as no bytes (size 8) and has a null checksum; a
null id has a hash of its own; repeated rows each get a slot; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

_BUCKET_BITS = 12


def ring_points(spark: SparkSession, shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise; shards * vnodes rows."""
    ids = spark.range(shards * vnodes).select(
        F.pmod("id", F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("node"))
    points = ids.select(F.xxhash64(F.lit("vnode"), "shard", "node").alias("at"), "shard").collect()
    return sorted((p["at"], p["shard"]) for p in points)


def arc_table(spark: SparkSession, points: list[tuple[int, int]]) -> DataFrame:
    """One row per leading-bits bucket of the ring: the points inside it and
    the first one after it, so that a key finds its arc by an equi-join."""
    shift, low = 64 - _BUCKET_BITS, -(2 ** (_BUCKET_BITS - 1))
    inside: dict[int, list[tuple[int, int]]] = {b: [] for b in range(low, -low)}
    for arc, (at, _) in enumerate(points):
        inside[at >> shift].append((at, arc))
    rows, after = [], 0
    for b in range(-low - 1, low - 1, -1):
        rows.append((b, inside[b], after))
        after = inside[b][0][1] if inside[b] else after
    return spark.createDataFrame(rows, "bucket long, points array<struct<at: long, arc: int>>, after int")


def arc_of(rows: DataFrame, position: Column, arcs: DataFrame) -> DataFrame:
    """Adds ``arc``: index of the next point clockwise from ``position``."""
    rows = rows.withColumn("__at", position).withColumn("__b", F.shiftright("__at", 64 - _BUCKET_BITS))
    met = F.filter("points", lambda p: p["at"] >= F.col("__at"))
    return (
        rows.join(F.broadcast(arcs), F.col("__b") == F.col("bucket"))  # 4096 rows
        .withColumn("arc", F.when(F.size(met) > 0, F.element_at(met, 1)["arc"]).otherwise(F.col("after")))
        .drop("__b", "bucket", "points", "after")
    )


def settle(counts: dict[int, int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Pieces (arc, first rank, end rank, shard, first slot): every arc fills
    its own shard as far as that has room, then overflow continues clockwise."""
    room, used, pieces, over = list(room), [0] * len(room), [], []

    def put(arc: int, first: int, n: int, shard: int) -> int:
        n = min(n, room[shard])
        if n:
            pieces.append((arc, first, first + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return n

    for arc in sorted(counts):
        done = put(arc, 0, counts[arc], owners[arc])
        if done < counts[arc]:
            over.append((arc, done))
    for arc, done in over:
        step = 0
        while done < counts[arc]:
            step += 1
            done += put(arc, done, counts[arc] - done, owners[(arc + step) % len(owners)])
    return pieces


def shard_rows(rows: DataFrame, key: Column, columns: list[str], shards: int = 24, vnodes: int = 128) -> DataFrame:
    """``rows`` (``columns``) plus ``shard`` and ``slot`` (gapless from 0 in
    its shard)."""
    spark = rows.sparkSession
    points = ring_points(spark, shards, vnodes)
    placed = arc_of(rows.select(*columns, key.alias("__k")), F.xxhash64(F.lit("key"), F.col("__k")),
                    arc_table(spark, points))
    groups = materialise(placed.groupBy(*columns, "__at", "arc").agg(F.count("*").alias("__c")), "ring-groups")
    per_arc = {r["arc"]: r["n"] for r in groups.groupBy("arc").agg(F.sum("__c").alias("n")).collect()}
    total = sum(per_arc.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    pieces = spark.createDataFrame(settle(per_arc, [s for _, s in points], room),
                                   "p_arc int, p_from long, p_to long, shard int, p_slot long")
    cells = max(1, round((total / len(points)) ** 0.5))
    here = groups.withColumn("__cell", F.pmod(F.xxhash64("__at", *columns), F.lit(cells)))
    base = (
        here.groupBy("arc", "__cell").agg(F.sum("__c").alias("__n"))
        .withColumn("__base", F.sum("__n").over(Window.partitionBy("arc").orderBy("__cell")) - F.col("__n"))
        .select(F.col("arc").alias("__ba"), F.col("__cell").alias("__bc"), "__base")
    )
    inner = (Window.partitionBy("arc", "__cell").orderBy("__at", *columns)
             .rowsBetween(Window.unboundedPreceding, 0))
    first = F.greatest("__rank", "p_from")
    last = F.least(F.col("__rank") + F.col("__c"), F.col("p_to")) - 1
    return (
        here.join(base, (F.col("arc") == F.col("__ba")) & (F.col("__cell") == F.col("__bc")))
        .withColumn("__rank", F.col("__base") + F.sum("__c").over(inner) - F.col("__c"))
        .join(F.broadcast(pieces),  # at most shards * (vnodes + 1) rows
              (F.col("arc") == F.col("p_arc")) & (F.col("__rank") < F.col("p_to"))
              & (F.col("__rank") + F.col("__c") > F.col("p_from")))
        .withColumn("__r", F.explode(F.sequence(first, last)))
        .select(*columns, "shard", (F.col("p_slot") + F.col("__r") - F.col("p_from")).alias("slot"))
    )


def shard_documents(docs: DataFrame, shards: int = 24, vnodes: int = 128) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 8), text_crc32, law (``rows``), shard, slot
    and grown_shard (null under this law) for every document."""
    raw = F.col("text").cast("binary")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    out = shard_rows(rows, F.col("doc_id"), ["doc_id", "size", "text_crc32"], shards, vnodes)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
