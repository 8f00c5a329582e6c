"""Operator 12: embedding whitening with components from contour integration.

Components of a vector become integers floor(64 c); the constant 1,000,000
that the contract adds moves the mean and cancels in every covariance, so it
only enters sums by arithmetic.  Two Spark passes give exact integers: sums
per dimension, then products of entries centred at the rounded mean, summed as
38-digit decimals.  The covariance n^2 V = n G - T T' is therefore exact
before its one rounding to double, whatever the size of the mean.

The spectrum of V (dimensions squared, the same for any number of rows) is cut
into intervals by inertia counts; Spark tasks solve one interval each
(``feast``), a last Rayleigh-Ritz step makes the vectors of all intervals
orthonormal, and inertia confirms that none is missing.  A third pass measures
the covariance of the whitened rows, a fourth writes them.

Edge cases: vectors that are null or hold null or non-finite entries take no
part; of vectors of different lengths the missing entries count as 0; rows that
repeat an id, or have none, are rows of their own; components with a
variance of at most 1e-10 of the largest are rounding and left out, so equal
vectors, a single vector, empty vectors and an empty table give no rows;
components of equal variance are any orthonormal basis, the same for all rows;
``deviation`` is null where it exceeds a long; components beyond 2^40 in size
after scaling are an error; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import feast
from .common import materialise, ready

SCALE = 64
COMPONENTS = 32
LIMIT = 2**40
#: Smallest variance of a component, as a share of the largest.
RANK = 1e-10
_SUM = pa.decimal128(38, 0)


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of each entry as long; null if any is null or not finite."""
    c = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform(c, lambda v: F.floor(F.greatest(F.least(v * scale, F.lit(2.0 * LIMIT)), F.lit(-2.0 * LIMIT))).cast("long"))
    return F.when(~bad, whole)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as integers; missing entries are 0."""
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _products(z: np.ndarray) -> np.ndarray:
    """z'z in exact integers: by floating point where all sums stay below 2^53."""
    size = int(np.abs(z).max(initial=0))
    if size * size * len(z) < 2**53:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    if size * size * len(z) < 2**62:
        return z.T @ z
    return z.astype(object).T @ z.astype(object)


def _sums(cells: dict[tuple[int, int], int]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([k[0] for k in cells], pa.int32()), pa.array([k[1] for k in cells], pa.int32()),
                            pa.array([int(v) for v in cells.values()], _SUM)], names=["i", "j", "s"])


def _gather(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """Exact sums by cell: at most width^2 / 2 rows come to the driver."""
    out = np.zeros(shape, object)
    for i, j, s in parts.groupBy("i", "j").agg(F.sum("s").cast("decimal(38,0)")).collect():
        out[i, j] = int(s)
    return out


@dataclass
class Fit:
    """Rows, rounded means, exact sums of the centred entries, covariance."""

    n: int
    mean: np.ndarray
    rest: list[int]
    covariance: np.ndarray


def fit(rows: DataFrame) -> Fit:
    """``rows`` (id, x array<long>): exact covariance over all of them."""
    row = rows.agg(F.count(F.lit(1)), F.max(F.size("x")),
                   F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x"))))).first()
    n, width, size = row[0], row[1] or 0, row[2] or 0
    if size > LIMIT:
        raise ArithmeticError(f"an entry is {size} after scaling, more than {LIMIT}")
    x = rows.select("x")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for b in batches:
            total += _matrix(b.column(0), width).sum(axis=0).astype(object)
        yield _sums({(0, j): s for j, s in enumerate(total)})

    s = _gather(x.mapInArrow(add, "i int, j int, s decimal(38,0)"), (1, width))[0] if width else np.zeros(0, object)
    mean = np.array([(2 * v + n) // (2 * n) for v in s], np.int64)
    rest = [v - n * int(m) for v, m in zip(s, mean, strict=True)]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for b in batches:
            total += _products(_matrix(b.column(0), width) - mean).astype(object)
        yield _sums({(i, j): total[i, j] for i in range(width) for j in range(i, width)})

    g = _gather(x.mapInArrow(multiply, "i int, j int, s decimal(38,0)"), (width, width)) if width else np.zeros((0, 0), object)
    v = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            v[i, j] = v[j, i] = (n * g[i, j] - rest[i] * rest[j]) / (n * n)  # one rounding
    return Fit(n, mean, rest, v)


def components(rows: DataFrame, v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues of ``v`` (falling) and their unit vectors (columns),
    one Spark task an interval; checked against the inertia of ``v``."""
    wanted = min(wanted, len(v))
    if not wanted or not np.any(v):
        return np.zeros(0), np.zeros((len(v), 0))
    scale = float(np.trace(v))
    a = v / scale
    found = feast.intervals(a, wanted)
    spark = rows.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high, count in zip(*[c.to_pylist() for c in b.columns], strict=True):
                values, vectors = feast.solve(a, feast.Interval(low, high, count))
                yield pa.record_batch([pa.array(values), pa.array([c.tobytes() for c in np.ascontiguousarray(vectors.T)])],
                                      names=["value", "vector"])

    tasks = spark.createDataFrame([(float(x.low), float(x.high), int(x.count)) for x in found], "low double, high double, count int")
    got = tasks.repartitionByRange(len(found), "low").mapInArrow(run, "value double, vector binary").collect()
    values, vectors = feast.polish(a, np.array([np.frombuffer(r.vector) for r in got]).T)
    low = min(x.low for x in found)
    if feast.count_above(a, low) != len(values) or (np.diff(values) > 0).any():
        raise ArithmeticError("the eigenpairs found are not those that inertia counts")
    keep = np.flatnonzero(values[:wanted] > RANK * values[0])
    vectors = vectors[:, keep]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))])
    return values[keep] * scale, vectors * sign


def whiten(vectors: DataFrame, vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """``vectors`` (vec_id, <vector>) -> one row per vector and component:
    vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    ready(spark)
    rows = materialise(vectors.select(F.col("vec_id"), scaled(F.col(f"`{vector}`")).alias("x")).where("x is not null"), "whiten-rows")
    f = fit(rows)
    e, c = components(rows, f.covariance, wanted)
    k, width, n = len(e), len(f.mean), f.n
    id_type = rows.schema["vec_id"].dataType.simpleString()
    result = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return spark.createDataFrame([], result)
    left = np.array([r / n for r in f.rest])
    base = c / np.sqrt(e)
    explained = e / np.trace(f.covariance)

    def project(z: np.ndarray) -> np.ndarray:
        return (z - left) @ base

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for b in batches:
            w = project(_matrix(b.column(0), width) - f.mean)
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        i, j = np.indices(total.shape)
        yield pa.record_batch([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])

    moments = np.zeros((k + 1, k))
    for i, j, s in rows.select("x").mapInArrow(measure, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s")).collect():
        moments[i, j] = s
    covariance = moments[:k] / n - np.outer(moments[k], moments[k]) / n**2
    error = float(np.abs(covariance - np.eye(k)).max())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = _matrix(b.column(1), width) - f.mean
            w = project(z)
            far = n * (int(np.abs(z).max(initial=0)) + 1)
            if far * far * width < 2**63:
                d = ((n * z - np.array(f.rest, np.int64)) ** 2).sum(axis=1).tolist()
            else:
                d = [int(x) if x < 2**63 else None for x in ((n * z.astype(object) - np.array(f.rest, object)) ** 2).sum(axis=1)]
            take = pa.array(np.repeat(np.arange(len(b)), k))
            full = len(b) * k
            yield pa.record_batch([
                b.column(0).take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(b))), pa.array(np.full(full, n)),
                pa.array(d, pa.int64()).take(take), pa.array(w.ravel()), pa.array(np.tile(explained, len(b))), pa.array(np.full(full, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(write, result)
