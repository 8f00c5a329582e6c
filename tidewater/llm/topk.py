"""Operator 9: exact top-k inner product search with an impact-ordered index.

Vectors are packed into blocks.  A block's postings are (dimension, vector,
component), cut into segments by quantised impact, the size of the component:
segment 0 holds the largest components of all dimensions, and so on.  Queries
are scored a segment at a time, in descending impact.  After each segment a
vector's score lies within ``length of the query * length of what is left of
the vector`` of its partial score, so the scan stops as soon as every query
has k vectors that nothing else can pass; vectors whose upper bound reaches
the k-th lower bound are rescored exactly in integers.

Blocks of vectors are dealt to spans and blocks of queries to chunks; a cell
is a span and a chunk, and its blocks meet in one task, whose memory bounds
both.  There the queries stay and the vectors pass block by block: a block is
indexed once for all queries of the cell, and the k-th best score so far is the
threshold of the next block.  A cell returns k rows a query, and a window ranks
them.  Nothing is joined, so nothing is broadcast.

Edge cases: vectors that are null or hold null or non-finite components take
no part; an empty vector has score 0 with everything; of vectors of different
lengths the common components count; equal scores go to the smaller id; rows
that repeat an id are candidates each for themselves, rows that repeat a
query id ask each for themselves and the k best of all their pairs count, and a query's
own id is never its candidate; rows with a null id take no part; an empty table gives no
rows.  Components need at most 52 bits after scaling and scores must fit 64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, ready

BLOCK = 4096
QUERIES = 512
#: Components of a block of vectors, of a cell's vectors and of a cell's queries
#: at most, whatever the number of dimensions.
BLOCK_VALUES, SPAN_VALUES, ASKED_VALUES = 2**19, 2**24, 2**22
#: Cells at least, so that a small table still spreads.
SPREAD = 128
#: Segments of a block: the shares of its largest components they hold.
SEGMENTS = (0.25, 0.25, 0.25, 0.25)


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as long; null if any is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _kind(data: np.ndarray) -> type:
    """Smallest integer type that holds the components."""
    most = int(np.abs(data).max(initial=0))
    return next((t for t in (np.int16, np.int32) if most <= np.iinfo(t).max), np.int64)


def _pack(rows: DataFrame, size: int) -> DataFrame:
    """(id, x) -> blocks (ids, width, data) of up to ``size`` vectors each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        rows: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            width = max(len(r) for r in rows)
            data = np.zeros((len(rows), width), np.int64)
            for i, r in enumerate(rows):
                data[i, : len(r)] = r
            data = data.astype(_kind(data))
            return pa.record_batch([pa.array([np.array(ids, np.int64).tobytes()]), pa.array([width], pa.int32()),
                                    pa.array([data.tobytes()])], names=["ids", "width", "data"])

        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids.append(i)
                rows.append(x.values.to_numpy())
                if len(ids) == size:
                    yield block()
                    ids, rows = [], []
        if ids:
            yield block()

    return rows.mapInArrow(run, "ids binary, width int, data binary")


def _read(ids: bytes, width: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(data) // (len(ids) * width) if width else 8]
    return ids, np.frombuffer(data, kind).reshape(len(ids), width).astype(np.int64)


def index_block(x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Segments of a block in descending impact, each as the matrix of its
    postings, and after each the length of what is left of every vector."""
    size = np.abs(x)
    edges = np.quantile(size, 1 - np.cumsum(SEGMENTS)[:-1]) if x.size else np.zeros(len(SEGMENTS) - 1)
    segments, left, upper = [], [], np.inf
    for low in [*edges, -1]:
        here = np.where((size >= low) & (size < upper), x, 0) if low >= 0 else np.where(size < upper, x, 0)
        segments.append(here.astype(np.float64))
        rest = np.where(size < low, x, 0).astype(np.float64) if low >= 0 else np.zeros(x.shape)
        left.append(np.sqrt((rest * rest).sum(axis=1)))
        upper = min(upper, low)
    return segments, left


def best_of(found: np.ndarray, k: int) -> np.ndarray:
    """The k best rows (query row, id, score) of each query row, best first."""
    found = found[np.lexsort((found[:, 1], -found[:, 2], found[:, 0]))]
    new = np.flatnonzero(np.diff(found[:, 0], prepend=-1))
    place = np.arange(len(found)) - np.repeat(new, np.diff(np.append(new, len(found))))
    return found[place < k]


def search_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int,
                 index: tuple[list[np.ndarray], list[np.ndarray]] | None = None,
                 floor: np.ndarray | None = None) -> np.ndarray:
    """Rows (query row, id, score) of the k best rows of the block for each
    query, exactly.  ``index``: what ``index_block`` made of the block;
    ``floor``: scores below which a query needs no rows."""
    segments, left = index_block(x) if index is None else index
    q = np.pad(q[:, : x.shape[1]], ((0, 0), (0, max(0, x.shape[1] - q.shape[1]))))
    floor = np.full(len(q), -np.inf) if floor is None else floor
    qf = q.astype(np.float64)
    q_len = np.sqrt((qf * qf).sum(axis=1))
    rounding = 1e-12 * q_len[:, None] * np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))[None, :]
    own = q_ids[:, None] == ids[None, :]
    score = np.zeros((len(q), len(x)))
    found: list[np.ndarray] = [np.zeros((0, 3), np.int64)]
    open_ = np.arange(len(q))
    part = max(1, 2**20 // max(1, x.shape[1]))
    for here, rest in zip(segments, left, strict=True):
        score += qf[open_] @ here.T
        bound = q_len[open_, None] * rest[None, :] * (1 + 1e-12) + rounding
        low = floor[open_]
        if np.isneginf(low).any():
            at = min(k, len(x)) - 1
            low = np.maximum(low, -np.partition(np.where(own, np.inf, bound - score), at, axis=1)[:, at])
        maybe = (score + bound >= low[:, None]) & ~own
        few = maybe.sum(axis=1) <= 4 * k if rest.any() else np.ones(len(open_), bool)
        rows, at = np.nonzero(maybe & few[:, None])  # proven: nothing else can be among the k
        rows = open_[rows]
        for i in range(0, len(rows), part):
            r, c = rows[i : i + part], at[i : i + part]
            found.append(np.column_stack([r, ids[c], np.einsum("ij,ij->i", x[c], q[r])]))
        if few.all():
            break
        if few.any():
            open_, score, rounding, own = open_[~few], score[~few], rounding[~few], own[~few]
    return best_of(np.concatenate(found), k)


class _Cell:
    """Queries of a cell, and their k best rows of the vectors that passed."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.found: list[np.ndarray] = []
        self.floor: list[np.ndarray] = []

    def ask(self, ids: np.ndarray, q: np.ndarray) -> None:
        self.parts.append((ids, q.astype(_kind(q))))
        self.found.append(np.zeros((0, 3), np.int64))
        self.floor.append(np.full(len(ids), -np.inf))

    def search(self, ids: np.ndarray, x: np.ndarray) -> None:
        index = index_block(x) if self.parts else None
        for n, (q_ids, q) in enumerate(self.parts):
            new = search_block(q_ids, q.astype(np.int64), ids, x, self.k, index, self.floor[n])
            if not len(new):
                continue
            self.found[n] = best = best_of(np.concatenate([self.found[n], new]), self.k)
            last = np.flatnonzero(np.bincount(best[:, 0], minlength=len(q_ids)) == self.k)
            # rows are in the order of the queries, best first: the k-th of each that has k
            self.floor[n][last] = best[np.searchsorted(best[:, 0], last, "right") - 1, 2]

    def rows(self) -> Iterator[pa.RecordBatch]:
        for (q_ids, _), best in zip(self.parts, self.found, strict=True):
            cols = (q_ids[best[:, 0]], best[:, 1], best[:, 2])
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding") -> DataFrame:
    """``vectors`` (vec_id, <vector>) -> (query_id, rank, vec_id, score)."""
    ready(vectors.sparkSession)
    rows = materialise(
        vectors.select(F.col("vec_id").cast("long").alias("id"), scaled(F.col(vector)).alias("x"), is_query.alias("ask"))
        .where("id is not null and x is not null"), "vectors")
    asked = rows.where("ask").select("id", "x")
    n, n_asked, width = rows.agg(F.count(F.lit(1)), F.count_if("ask"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    width = max(1, width)
    block = max(1, min(BLOCK, BLOCK_VALUES // width, n // SPREAD + 1))
    some = max(1, min(QUERIES, ASKED_VALUES // width))
    # a cell is a span of the vectors and a chunk of the queries
    chunks = -(-n_asked // max(some, ASKED_VALUES // width)) or 1
    spans = max(-(-SPREAD // chunks), -(-n // max(block, SPAN_VALUES // width)))
    number = F.xxhash64("ids", "data")
    x = (_pack(rows.select("id", "x"), block).withColumn("span", F.pmod(number, F.lit(spans)))
         .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>"))))
    q = (_pack(asked.repartition(n_asked // some + 1), some).withColumn("chunk", F.pmod(number, F.lit(chunks)))
         .withColumn("span", F.explode(F.sequence(F.lit(0), F.lit(spans - 1)).cast("array<bigint>"))))
    cells = (
        q.withColumn("vectors", F.lit(False)).unionByName(x.withColumn("vectors", F.lit(True)))
        .select((F.col("span") * chunks + F.col("chunk")).alias("cell"), "vectors", "ids", "width", "data")
        .repartition(spans * chunks, "cell").sortWithinPartitions("cell", "vectors")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, cell = None, _Cell(k)
        for b in batches:
            for i in range(len(b)):
                here, of_vectors, *data = [c[i].as_py() for c in b.columns]
                if here != number:
                    yield from cell.rows()
                    number, cell = here, _Cell(k)
                (cell.search if of_vectors else cell.ask)(*_read(*data))
        yield from cell.rows()

    best = cells.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
