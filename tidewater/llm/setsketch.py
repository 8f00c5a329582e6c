"""Operator 5: near duplicates by SetSketch registers.

Each text's shingle set gets ``REGISTERS`` registers: the smallest of
exponential hash values of its shingles, truncated on the scale
``floor(1 - log_b x)`` with a base near 1, so registers merge by maximum and
agree with a probability that follows the Jaccard similarity.  Texts that
agree in a whole band of registers are candidates; the similarity of a
candidate pair is estimated by maximum likelihood from how many registers are
larger, smaller and equal, given both set sizes; what may reach the threshold
is verified on the full sets.

Texts with equal sets are one class, so copies are never paired.  In the first
bands every member of a bucket (texts that agree in a band) is tested against
the smallest one, and verified links merge their components.  Buckets of all
bands that still hold several components are then put together to clusters,
and inside a cluster the intersections of all sets are counted at once, by
matrix products over the shingles that several of them have.  So every pair
that shares a bucket is either in one component already or tested exactly; no
pairs are laid out as rows.  A link at the threshold is missed by all bands
with a chance of about 3e-6, a more similar one far less often.

Scale: buckets are found by aggregation with partial sums.  A cluster is cut
into blocks of bounded rows and bytes, and each pair of blocks is one group,
so no task holds a large cluster.  Full sets are made again from the texts
only for those that need them, which a Bloom filter picks before the shuffle.

Edge cases: null, blank and empty texts have an empty set, are linked with
nothing and are their own component; a text shorter than a shingle is one
shingle; repeated rows are linked as copies; a null id counts as the largest
and comes back null; rows that share an id, or have none, are judged each by
its own text, and a component of null ids only has the id 2^63-1; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import LAST_ID, materialise, ready
from .graph import components
from .words import mix, shingle_set, word_hashes

BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
BASE, RATE = 1.02, 20.0
#: Estimates may lie this far below the threshold (about five standard deviations).
SLACK = 0.2
#: Bands of the first round.
FIRST_BANDS = 3
#: Rows and bytes of sets in one block of a cluster.
BLOCK_ROWS, BLOCK_BYTES = 1024, 16 << 20
#: Columns of one matrix product.
COLUMNS = 4096
_PIECE = 2048
_TURN = (mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFT = (mix(np.arange(1001, REGISTERS + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def registers(shingles: np.ndarray) -> np.ndarray:
    """Register values (uint16) of a non-empty set."""
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), _PIECE):
        v = short[None, at: at + _PIECE] * _TURN[:, None]
        v += _SHIFT[:, None]
        v ^= v >> np.uint32(16)
        v *= np.uint32(0x7FEB352D)
        v ^= v >> np.uint32(15)
        np.minimum(low, v.min(axis=1), out=low)
    x = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 65535).astype(np.uint16)


def _joint(x: np.ndarray) -> np.ndarray:
    """Chance that one register exceeds the other, for the share ``x`` of
    elements that only its set has."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def likely_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, grid: int = 100) -> np.ndarray:
    """Maximum likelihood Jaccard similarity of register rows ``a`` and ``b``
    of sets with ``na`` and ``nb`` elements, on a grid."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = REGISTERS - more - less
    u, v = (na / (na + nb))[:, None], (nb / (na + nb))[:, None]
    top = np.minimum(u / v, v / u)
    j = top * np.linspace(0, 1, grid + 1)[None, :]
    up, down = _joint(u - v * j), _joint(v - u * j)
    tiny = 1e-12
    fit = (more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.clip(1 - up - down, tiny, 1)))
    return np.take_along_axis(j, fit.argmax(axis=1)[:, None], axis=1)[:, 0]


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def sketch(docs: DataFrame, raw: Column, shingle: int) -> DataFrame:
    """``docs`` (id, t, ...) -> (id, t, n, digest, regs); digest names the shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digest, regs = [], [], []
            for text in b.column(2):
                s = shingle_set(word_hashes((text.as_py() or b"").lower()), shingle)
                n.append(len(s))
                digest.append(_digest(s))
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                                   pa.array(regs, pa.binary())], names=["id", "t", "n", "digest", "regs"])

    return docs.select("id", "t", raw.alias("raw")).mapInArrow(run, "id long, t long, n long, digest binary, regs binary")


def _buckets(reps: DataFrame, bands: int) -> DataFrame:
    """(key, rid, label): one row for each band of each class."""
    keys = [F.xxhash64(F.lit(i), F.substring("regs", 2 * ROWS * i + 1, 2 * ROWS)) for i in range(bands)]
    return reps.select(F.explode(F.array(*keys)).alias("key"), "rid", "label")


def _mixed(rows: DataFrame) -> DataFrame:
    """(key, centre, c_label): buckets that hold several components, with
    their smallest member."""
    parts = rows.groupBy("key", "label").agg(F.min("rid").alias("rid")).groupBy("key").agg(
        F.count("*").alias("kinds"), F.min(F.struct("rid", "label")).alias("c"))
    return parts.where("kinds > 1").select("key", F.col("c.rid").alias("centre"), F.col("c.label").alias("c_label"))


def _likely(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose estimate comes within SLACK of the threshold."""
    right = reps.select(F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    left = reps.select(F.col("rid").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    near = F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(threshold - 1e-9)
    rows = pairs.join(right, "b").join(left, "a").where(near).select("a", "b", "na", "nb", "ra", "rb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), _PIECE):
                part = b.slice(at, _PIECE)
                ra, rb = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (4, 5))
                na, nb = (part.column(i).to_numpy().astype(float) for i in (2, 3))
                ok = likely_similarity(ra, rb, na, nb) >= threshold - SLACK
                yield part.select(["a", "b"]).filter(pa.array(ok))

    return rows.mapInArrow(run, "a long, b long").distinct()


def _full_sets(docs: DataFrame, raw: Column, classes: DataFrame, rids: DataFrame, shingle: int) -> DataFrame:
    """(rid, set): sorted shingles of the classes with these numbers, from the
    texts that stand for them."""
    wanted = classes.join(rids, "rid", "left_semi").select("digest", "rid", F.xxhash64("id", "t").alias("row"))
    sent = docs.sparkSession.sparkContext.broadcast(bloom.build(wanted.select("row")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(bloom.may_hold(sent.value, b.column(0).to_numpy())))
            data = [shingle_set(word_hashes((t.as_py() or b"").lower()), shingle) for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array([_digest(x) for x in data], pa.binary()),
                                   pa.array([x.tobytes() for x in data], pa.binary())], names=["row", "digest", "set"])

    made = docs.select(F.xxhash64("id", "t").alias("row"), raw.alias("raw")).mapInArrow(sets, "row long, digest binary, set binary")
    return materialise(made.join(wanted, ["row", "digest"]).select("rid", "set").distinct(), "sets")


def _verify(pairs: DataFrame, full: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose full sets reach the threshold (in hundredths, exactly)."""
    hundredths = round(threshold * 100)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both > 0 and 100 * both >= hundredths * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    rows = (pairs.join(full.select(F.col("rid").alias("b"), F.col("set").alias("sb")), "b")
            .join(full.select(F.col("rid").alias("a"), F.col("set").alias("sa")), "a").select("a", "b", "sa", "sb"))
    return rows.mapInArrow(test, "a long, b long").distinct()


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of sets (left x right).  Shingles that
    few pairs share are counted pair by pair, the others by matrix products."""
    owner = np.concatenate([np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (left, right)])
    side = np.repeat([0, 1], [sum(map(len, left)), sum(map(len, right))])
    values = np.concatenate([*left, *right])
    order = np.argsort(values, kind="stable")  # left before right
    values, owner, side = values[order], owner[order], side[order]
    start = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    rights = np.add.reduceat(side, start)
    lefts = np.diff(np.append(start, len(values))) - rights
    counts = np.zeros((len(left), len(right)), np.float32)
    few = (lefts > 0) & (rights > 0) & (lefts * rights <= 64)
    for n, m in np.unique(np.stack([lefts[few], rights[few]], axis=1), axis=0):
        at = start[few & (lefts == n) & (rights == m)]
        l = owner[at[:, None] + np.arange(n)]
        r = owner[at[:, None] + n + np.arange(m)]
        pair = (l[:, :, None] * len(right) + r[:, None, :]).ravel()
        counts += np.bincount(pair, minlength=counts.size).reshape(counts.shape).astype(np.float32)
    many = np.flatnonzero((lefts > 0) & (rights > 0) & ~few)
    column = np.full(len(start), -1)
    column[many] = np.arange(len(many))
    column = np.repeat(column, np.diff(np.append(start, len(values))))
    for at in range(0, len(many), COLUMNS):
        a, b = (np.zeros((len(s), min(COLUMNS, len(many) - at)), np.float32) for s in (left, right))
        for k, m in ((0, a), (1, b)):
            here = (side == k) & (column >= at) & (column < at + COLUMNS)
            m[owner[here], column[here] - at] = 1
        counts += a @ b.T
    return counts


def block_links(left: list[np.ndarray], right: list[np.ndarray], l_label: np.ndarray, r_label: np.ndarray,
                hundredths: int) -> set[tuple[int, int]]:
    """Pairs of labels that connect what links between left and right sets
    (and equal labels) connect: a forest, not all pairs."""
    both = shared_counts(left, right)
    sizes = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :]
    linked = (both > 0) & (100 * both >= hundredths * (sizes - both))
    names, at = np.unique(np.concatenate([l_label, r_label]), return_inverse=True)
    l_at, r_at = at[: len(left)], at[len(left):]
    root = np.arange(len(names))
    while True:
        before = root.copy()
        l_root, r_root = root[l_at], root[r_at]
        low = np.where(linked, r_root[None, :], len(names)).min(axis=1, initial=len(names))
        np.minimum.at(root, l_at, np.minimum(l_root, low))
        low = np.where(linked, root[l_at][:, None], len(names)).min(axis=0, initial=len(names))
        np.minimum.at(root, r_at, np.minimum(r_root, low))
        if (root == before).all():
            return {(int(names[r]), int(names[i])) for i, r in enumerate(root) if r != i}


def _test_clusters(members: DataFrame, full: DataFrame, threshold: float) -> DataFrame:
    """``members`` (rid, label, cluster, n) -> (a, b): labels that exact links
    inside a cluster connect.  Blocks of a cluster meet pair by pair."""
    hundredths = round(threshold * 100)
    sizes = members.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    laid = members.join(sizes, "cluster").withColumn("mine", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = (
        laid.select("cluster", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rid", "label")
        .join(full, "rid")
    )

    def test(key, table):
        _, i, j = (k.as_py() for k in key)
        mine, label = (table.column(c).to_numpy() for c in ("mine", "label"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        l, r = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        found = block_links([sets[x] for x in l], [sets[x] for x in r], label[l], label[r], hundredths) if len(l) and len(r) else ()
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return rows.groupBy("cluster", "i", "j").applyInArrow(test, "a long, b long")


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (rid, label) after the links (a, b) between labels."""
    found = components(links)
    found = found.select(F.col("node").alias("label"), F.col("label").alias("to"))
    return materialise(labels.join(found, "label", "left").select("rid", F.coalesce("to", "label").alias("label")), "merged")


def _classes(docs: DataFrame, text: Column, shingle: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``docs`` (doc_id, ...) -> rows (id, t, n, digest, ...) with t a hash of
    the text, and classes (digest, label, id, t): one row per shingle set with
    the number of its component and the smallest row that has it."""
    ready(docs.sparkSession)
    raw = text.cast("binary")
    docs = docs.withColumns({"id": F.coalesce("doc_id", F.lit(LAST_ID)), "t": F.xxhash64(raw)})
    sig = materialise(sketch(docs, raw, shingle), "sketch")
    # nodes of the graph are numbers of classes: several classes may have one id
    classes = materialise(
        sig.where("n > 0").groupBy("digest").agg(F.min(F.struct("id", "t", "n", "regs")).alias("c"))
        .select("digest", "c.*", F.monotonically_increasing_id().alias("rid")), "classes")
    labels = classes.select("rid", F.col("rid").alias("label"))
    # members of a bucket against its smallest one
    rows = _buckets(classes.join(labels, "rid"), FIRST_BANDS)
    pairs = rows.join(_mixed(rows), "key").where("rid <> centre").select(F.col("centre").alias("a"), F.col("rid").alias("b"))
    likely = materialise(_likely(pairs.distinct(), classes, threshold), "likely")
    if not likely.isEmpty():
        rids = likely.select(F.col("a").alias("rid")).union(likely.select("b")).distinct()
        links = _verify(likely, _full_sets(docs, raw, classes, rids, shingle), threshold)
        labels = _merge(labels, links)  # every class is its own label so far
    # buckets of all bands that hold several components, put together
    rows = _buckets(classes.join(labels, "rid"), BANDS)
    edges = materialise(rows.join(_mixed(rows), "key").select("rid", "centre").distinct(), "edges")
    if not edges.isEmpty():
        clusters = components(edges.select(F.col("rid").alias("a"), F.col("centre").alias("b")))
        members = materialise(
            clusters.toDF("rid", "cluster").join(labels, "rid").join(classes.select("rid", "n"), "rid"), "members")
        full = _full_sets(docs, raw, classes, members.select("rid"), shingle)
        labels = _merge(labels, materialise(_test_clusters(members, full, threshold), "cluster-links"))
    return sig, materialise(classes.select("digest", "rid", "id", "t").join(labels, "rid").select("digest", "label", "id", "t"), "components")


def near_duplicates(docs: DataFrame, text: Column, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` (doc_id, ...) -> (doc_id, n_shingles, component_id, digest):
    one row per row; digest names the shingle set (null if empty)."""
    sig, classes = _classes(docs, text, shingle, threshold)
    first = classes.groupBy("label").agg(F.min("id").alias("component_id"))
    comp = classes.select("digest", "label").join(first, "label").select("digest", "component_id")
    return (
        sig.select("id", "n", "digest").join(comp, "digest", "left")
        .select(F.when(F.col("id") == LAST_ID, F.lit(None)).otherwise(F.col("id")).cast("long").alias("doc_id"),
                F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"), "digest")
    )


def first_rows(docs: DataFrame, text: Column, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` (doc_id, ...) -> (id, t): one row of each component, that with
    the smallest id and of these with the smallest xxhash64 of the text, and
    every row without shingles.  A null id is LAST_ID."""
    sig, classes = _classes(docs, text, shingle, threshold)
    first = classes.groupBy("label").agg(F.min(F.struct("id", "t")).alias("f")).select("f.*")
    return first.union(sig.where("n = 0").select("id", "t").distinct())
