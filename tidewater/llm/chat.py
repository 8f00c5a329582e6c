"""Operator 4: chat formatting with a prefix tree.

A turn is written as ``[TURN]role[TEXT]text[/TURN]``.  In role and text a
backslash is doubled and every control string gets a backslash after its first
character, so no control string of a text survives and the text comes back
exactly.  Conversations that share initial turns share the nodes of a prefix
tree: a node is a turn in the context of all turns before it.  Every node is
emitted once, depth first, with

* ``start``/``end``: its place in the stream of its tree, in code points,
* ``position``: the position id of its first code point, i.e. how much of the
  conversation precedes it,
* ``attend``: the stream intervals of its ancestors, merged where they touch,
* ``loss_start``/``loss_end``: the part of its segment under the loss mask
  (the text of an assistant turn; null for other roles).

``paths`` says for every conversation through which nodes it runs.

Scale: a node is known by 128 bits that depend on all turns up to it.  Equal
conversations are one path; distinct paths are dealt by range of their whole
node sequence, so a tree whose first turn very many conversations share is
spread over tasks, and depth-first order is the sorted order of the paths.  A
node belongs to the first path through it, found with partial aggregates; its
place is a sum over earlier ranges plus one inside its range.  Only the turns
of one conversation are ever ordered together.

Edge cases: null text and null role count as empty; turns are taken in order
of turn (null first), equal ones by role and text; repeated rows are turns of
their own; a null conv_id is one conversation, which comes back null; an empty
table gives no rows; a conversation that is the beginning of another one ends
at an inner node.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LAST_ID, materialise, ready

TURN, TEXT, END = "[TURN]", "[TEXT]", "[/TURN]"
#: Control strings that may not stand in a text (fixed values of the template
#: and of the chat formats around it).
CONTROL = [TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]"]
ROLE_UNDER_LOSS = "assistant"
_FIRST = r"([<\[])(?=" + "|".join(sorted({re.escape(c[1:]) for c in CONTROL})) + ")"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _FIRST, r"$1\\")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def read_segment(segment: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    role, _, text = segment[len(TURN): -len(END)].partition(TEXT)
    if not segment.startswith(TURN) or not segment.endswith(END):
        raise ValueError("not a formatted turn")
    return unescape(role), unescape(text)


def format_tree(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``turns`` (conv_id, turn, role, text) -> (nodes, paths, members).

    nodes: tree, start, end, position, attend, segment, loss_start, loss_end;
    paths: path, idx, tree, start (the nodes of every distinct path in order);
    members: conv_id, path."""
    ready(turns.sparkSession)
    rows = turns.select(
        F.coalesce("conv_id", F.lit(LAST_ID)).alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    body = escaped(F.col("text"))
    steps = materialise(
        rows.withColumn("idx", F.row_number().over(order))
        .withColumn("node1", F.bit_xor(F.xxhash64("idx", "role", "text")).over(upto))
        .withColumn("node2", F.bit_xor(F.xxhash64(F.lit("second"), "text", "idx", "role")).over(upto))
        .withColumn("segment", F.concat(head, body, F.lit(END)))
        .withColumn("chars", F.length("segment").cast("long"))
        .withColumn("position", F.sum("chars").over(upto) - F.col("chars"))
        .withColumn("loss_start", F.when(F.col("role") == ROLE_UNDER_LOSS, F.length(head)))
        .withColumn("loss_end", F.col("loss_start") + F.length(body))
        .drop("role", "text", "turn"), "turns")

    # one path for each distinct conversation
    whole = steps.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("idx", "node1", "node2"))).alias("nodes"))
    whole = whole.select("conv", F.col("nodes.node1").alias("n1"), F.element_at("nodes", -1)["node2"].alias("n2"))
    named = materialise(whole.select("conv", "n1", F.struct(F.element_at("n1", -1).alias("a"), F.col("n2").alias("b"),
                                                            F.size("n1").alias("len")).alias("leaf")), "whole")
    firsts = named.groupBy("leaf").agg(F.min("conv").alias("path"))
    members = materialise(named.join(firsts, "leaf").select("conv", "path"), "members")
    kept = named.select(F.col("conv").alias("path"), "n1", "leaf").join(firsts.select("leaf", "path"), ["leaf", "path"])
    # depth-first order of the paths: by range, then inside the range
    parts = kept.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = materialise(kept.select("path", "n1").repartitionByRange(int(parts), "n1", "path")
                        .select("path", "n1", F.spark_partition_id().alias("part")), "ranges")
    inside = Window.partitionBy("part").orderBy("n1", "path")
    ranked = dealt.select("path", F.struct("part", F.row_number().over(inside).alias("at")).alias("rank"))
    own = materialise(steps.join(ranked, steps["conv"] == ranked["path"]).drop("conv"), "path-turns")

    # a node belongs to the first path through it
    node = ["node1", "node2"]
    owner = own.groupBy(*node).agg(F.min("rank").alias("first"))
    fresh = own.join(owner, node).where(F.col("rank") == F.col("first")).drop("first")
    emitted = materialise(fresh, "fresh")
    ranges = emitted.groupBy(F.col("rank.part").alias("part")).agg(F.sum("chars").alias("n"))
    base = ranges.select("part", (F.sum("n").over(Window.partitionBy().orderBy("part")) - F.col("n")).alias("base"))  # one row a range
    flow = (Window.partitionBy("part").orderBy("rank.at", "idx").rowsBetween(Window.unboundedPreceding, 0))
    placed = materialise(
        emitted.withColumn("part", F.col("rank.part")).join(base, "part")
        .withColumn("g_start", F.col("base") + F.sum("chars").over(flow) - F.col("chars"))
        .select(*node, "g_start", "chars"), "placed")
    through = materialise(own.select("path", "idx", "rank", *node, "position", "segment", "loss_start", "loss_end")
                          .join(placed, node), "through")
    root = Window.partitionBy("path").orderBy("idx")
    seen = (
        through.withColumn("tree", F.first("node1").over(root)).withColumn("zero", F.first("g_start").over(root))
        .withColumn("start", F.col("g_start") - F.col("zero")).withColumn("end", F.col("start") + F.col("chars"))
    )
    paths = seen.select("path", "idx", "tree", "start")
    nodes = _attend(seen.join(owner.toDF("node1", "node2", "first"), node)
                    .select("path", "idx", "tree", "start", "end", "position", "segment", "loss_start", "loss_end",
                            (F.col("rank") == F.col("first")).alias("mine")))
    members = members.select(F.when(F.col("conv") != LAST_ID, F.col("conv")).alias("conv_id"), "path")
    return materialise(nodes, "nodes"), materialise(paths, "paths"), members


_NODES = ("tree long, start long, end long, position long, segment string, loss_start int, loss_end int, "
          "attend array<struct<start: long, end: long>>")


def _attend(seen: DataFrame) -> DataFrame:
    """The nodes that each path is the first to have, with the intervals of
    their ancestors; rows stream by in path order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, spans = None, []
        for b in batches:
            rows, lists = [], []
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            walk = zip(*(cols[c].to_pylist() for c in ("path", "start", "end", "mine")), strict=True)
            for i, (p, start, end, mine) in enumerate(walk):
                if p != path:
                    path, spans = p, []
                if mine:
                    rows.append(i)
                    lists.append([{"start": s, "end": e} for s, e in spans])
                if spans and spans[-1][1] == start:
                    spans[-1] = (spans[-1][0], end)
                else:
                    spans.append((start, end))
            names = ["tree", "start", "end", "position", "segment", "loss_start", "loss_end"]
            got = [cols[n].take(pa.array(rows, pa.int64())) for n in names]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch([*got, pa.array(lists, kind)], names=[*names, "attend"])

    return seen.repartition("path").sortWithinPartitions("path", "idx").mapInArrow(run, _NODES)


def read_back(nodes: DataFrame, paths: DataFrame, members: DataFrame) -> DataFrame:
    """Digests of every conversation, from the emitted nodes alone: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    steps = paths.join(nodes.select("tree", "start", "segment", "loss_start", "loss_end"), ["tree", "start"])
    steps = steps.select("path", "idx", "segment", "loss_start", "loss_end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, state = None, None

        def row():
            n, turns, chars, loss, total = state
            return (path, n, turns.hexdigest(), chars, loss.hexdigest(), total)

        for b in batches:
            done = []
            for p, _, segment, lo, hi in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p != path:
                    if state:
                        done.append(row())
                    path, state = p, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_segment(segment)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if lo is not None:
                    text = unescape(segment[lo:hi])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(segment)
            if done:
                yield _table(done)
        if state:
            yield _table([row()])

    names = ["path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def _table(done: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

    digests = materialise(
        steps.repartition("path").sortWithinPartitions("path", "idx").mapInArrow(
            run, "path long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"),
        "digests")
    return members.join(digests, "path").select("conv_id", *names[1:])
