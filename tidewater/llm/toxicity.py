"""Operator 8: toxicity by a linear classifier over character n-grams scaled
by naive Bayes log-count ratios.

A feature is the presence of a hashed character n-gram in the lower-case text.
Its ratio ``r = log(p / q)`` compares smoothed document frequencies in toxic
and clean texts.  The classifier is logistic regression on ``x * r`` over the
features that occur in enough texts and separate the classes best; it is
fitted by quasi-Newton steps, each a Spark job that adds up loss and gradient
over the training rows with the weights broadcast.

Only the fit is bounded: ``max_train`` labelled rows chosen by a hash of the
id, and ``features`` n-gram buckets.  Scoring reads every whole text.

Edge cases: null and empty texts score the intercept, texts of any length are
read whole; with one class or nothing to learn from the model is not ``fitted``
(a column says so) and every score is 0.5 for no rows, else the smoothed share
of toxic rows; a document labelled twice is learned from once for each label;
null ids are never learned from; repeated rows are scored alike; an empty
table gives no rows; columns that are not kept may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, ready, sampled
from .ngrams import GROUP, groups, hashed

SIZES = (4, 5)
BITS = 18
PAD = max(SIZES) - 1
MAX_TRAIN = 24_000
FEATURES = 20_000
#: Partitions of the training table: its size is bounded, so is their number.
TRAIN_PARTS = 12


@dataclass
class ToxicityModel:
    weight: np.ndarray  # by bucket; 0 where a bucket is no feature
    bias: float
    #: Whether there were rows of both classes to learn from.
    fitted: bool = True


def present(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram bucket present in a text, once each.
    Texts too long for one group are worked off alone, piece by piece."""
    many = np.int64((1 << BITS) + 1)
    long = {i for i, t in enumerate(texts) if t and len(t) > GROUP}
    for points, starts, owner in groups([None if i in long else t for i, t in enumerate(texts)], PAD):
        rows = np.repeat(owner, np.diff(np.append(starts, len(points)))).astype(np.int64)
        keys = _distinct(np.concatenate([rows * many + hashed(points, starts, PAD, n, BITS) for n in SIZES]))
        keys = keys[keys % many < many - 1]
        yield keys // many, keys % many
    for i in sorted(long):
        parts = [_distinct(np.concatenate([hashed(points, starts, PAD, n, BITS) for n in SIZES]))
                 for points, starts, _ in groups([texts[i]], PAD)]
        bucket = _distinct(np.concatenate(parts))
        bucket = bucket[bucket < many - 1]
        yield np.full(len(bucket), i, np.int64), bucket


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def _document_counts(train: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Per bucket: toxic and clean documents that hold it; and how many there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), np.int64)
        for b in batches:
            label = b.column(1).to_numpy()
            for row, bucket in present(b.column(0).to_pylist()):
                for y in (0, 1):
                    seen[y] += np.bincount(bucket[label[row] == y], minlength=1 << BITS)
        for y in (0, 1):
            at = np.flatnonzero(seen[y])
            yield pa.record_batch([pa.array(np.full(len(at), y)), pa.array(at), pa.array(seen[y][at])],
                                  names=["y", "bucket", "n"])

    got = (train.select("text", "y").mapInArrow(count, "y long, bucket long, n long")
           .groupBy("y", "bucket").agg(F.sum("n").alias("n")).toArrow())  # at most 2 x buckets rows
    table = np.zeros((2, 1 << BITS))
    table[got["y"].to_numpy(), got["bucket"].to_numpy()] = got["n"].to_numpy()
    size = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
    return table[1], table[0], size.get(1, 0), size.get(0, 0)


def learn(labelled: DataFrame, max_train: int = MAX_TRAIN, features: int = FEATURES, steps: int = 20,
          l2: float = 2.0, min_docs: int = 5) -> ToxicityModel:
    """``labelled`` (doc_id, text, toxic): rows to learn from."""
    ready(labelled.sparkSession)
    rows = labelled.where("toxic is not null")
    train = materialise(
        rows.where(sampled(F.col("doc_id"), max_train, rows.count()))
        .select(F.lower("text").alias("text"), (F.col("toxic") > 0).cast("long").alias("y"))
        .repartition(TRAIN_PARTS), "toxic-train")
    has1, has0, n1, n0 = _document_counts(train)
    weight = np.zeros((1 << BITS) + 1, np.float32)
    bias = float(np.log((n1 + 0.5) / (n0 + 0.5)))
    if not n1 or not n0:
        return ToxicityModel(weight, bias, fitted=False)
    ratio = np.log((has1 + 1) / (n1 + 2)) - np.log((has0 + 1) / (n0 + 2))
    both = has1 + has0
    expected = both * n1 / (n1 + n0)
    score = np.where(both >= min_docs, (has1 - expected) ** 2 / np.maximum(expected, 1e-9), 0)
    chosen = np.sort(np.argsort(-score, kind="stable")[:features])
    chosen = chosen[score[chosen] > 0]
    place = np.full((1 << BITS) + 1, -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    r = ratio[chosen]
    place_sent = labelled.sparkSession.sparkContext.broadcast(place)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists: list[list[np.ndarray]] = [[] for _ in range(len(b))]
            for row, bucket in present(b.column(0).to_pylist()):
                at = place_sent.value[bucket]
                row, at = row[at >= 0], at[at >= 0].astype(np.int32)
                cut = np.flatnonzero(np.diff(row)) + 1
                for i, part in zip(row[np.append(0, cut)] if len(row) else (), np.split(at, cut), strict=False):
                    lists[i].append(part)
            data = [np.concatenate(x).tobytes() if x else b"" for x in lists]
            yield pa.record_batch([pa.array(data, pa.binary()), b.column(1)], names=["x", "y"])

    sparse = materialise(train.select("text", "y").mapInArrow(encode, "x binary, y long"), "toxic-features")
    n = n1 + n0

    def loss(v: np.ndarray) -> tuple[float, np.ndarray]:
        f, g = _log_loss(sparse, r, v)
        g[:-1] += l2 * v[:-1]
        return (f + l2 / 2 * float(v[:-1] @ v[:-1])) / n, g / n

    v = minimise(loss, np.append(np.zeros(len(chosen)), bias), steps)
    weight[chosen] = (v[:-1] * r).astype(np.float32)
    return ToxicityModel(weight, float(v[-1]))


def _log_loss(sparse: DataFrame, r: np.ndarray, v: np.ndarray) -> tuple[float, np.ndarray]:
    """Log loss and its gradient, added up over the training partitions."""
    sent = sparse.sparkSession.sparkContext.broadcast((r, v))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, v = sent.value
        total, wr = np.zeros(len(v) + 1), v[:-1] * r
        for b in batches:
            lists = [np.frombuffer(x, np.int32) for x in b.column(0).to_pylist()]
            at, row = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            sign = 2.0 * b.column(1).to_numpy() - 1
            margin = sign * (np.bincount(row, weights=wr[at], minlength=len(lists)) + v[-1])
            pull = -sign / (1 + np.exp(np.clip(margin, -500, 500)))
            total[: len(r)] += np.bincount(at, weights=pull[row], minlength=len(r)) * r
            total[len(r)] += pull.sum()
            total[-1] += np.logaddexp(0, -margin).sum()
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    total = np.zeros(len(v) + 1)
    for part in sparse.mapInArrow(run, "sum binary").collect():  # one row a partition, TRAIN_PARTS of them
        total += np.frombuffer(part["sum"])
    sent.destroy()  # one for every step, which driver and executors would keep
    return float(total[-1]), total[:-1]


def minimise(loss, v: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with step halving."""
    f, g = loss(v)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, used = g.copy(), []
        for s, y in reversed(pairs):
            a = (s @ d) / (s @ y)
            used.append(a)
            d -= a * y
        if pairs:
            s, y = pairs[-1]
            d *= (s @ y) / (y @ y)
        else:
            d *= min(1.0, 1.0 / (np.abs(g).sum() + 1e-12)) * 10
        for (s, y), a in zip(pairs, reversed(used), strict=True):
            d += (a - (y @ d) / (s @ y)) * s
        t, slope = 1.0, float(g @ d)
        while t > 1e-4:
            new_f, new_g = loss(v - t * d)
            if new_f <= f - 1e-4 * t * slope:
                break
            t /= 4
        else:
            return v
        s, y = -t * d, new_g - g
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        done = f - new_f < 1e-6 * max(1.0, f)
        v, f, g = v + s, new_f, new_g
        if done:
            break
    return v


def score(docs: DataFrame, model: ToxicityModel, text: Column, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``score`` (0 to 1), ``predicted`` (score >= 0.5) and ``fitted``."""
    ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.lower(text).alias("__text"))
    schema = rows.drop("__text").schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            texts = b.column(len(keep)).to_pylist()
            logit = np.full(len(texts), m.bias)
            for row, bucket in present(texts):
                logit += np.bincount(row, weights=m.weight[bucket], minlength=len(texts))
            out = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
            yield pa.record_batch([*b.columns[:-1], pa.array(out), pa.array((out >= 0.5).astype(np.int32))],
                                  names=[*b.schema.names[:-1], "score", "predicted"])

    return rows.mapInArrow(run, schema).withColumn("fitted", F.lit(model.fitted))
