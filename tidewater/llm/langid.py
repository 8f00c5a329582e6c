"""Operator 3: language identification by multinomial naive Bayes over hashed
character n-grams.

Counts of n-gram buckets by language are gathered in Spark from a bounded
sample of the labelled rows (``max_train`` rows, chosen by a hash of the id).
The matrix of log probabilities (languages x buckets) is broadcast, and each
Arrow batch of whole texts is scored in numpy: the log probabilities of a
text's n-grams are added up per language.

Edge cases: null text and text without a letter give ``und`` with score 0;
with nothing to learn from every text is ``und``; equal scores go to the
language first in order; null ids are never learned from; repeated rows are
scored alike (and counted as often as they occur); an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ready, sampled
from .ngrams import groups, hashed

SIZES = (1, 2, 3)
BITS = 16
PAD = max(SIZES) - 1
#: Rows learned from, at most (about): a documented bound of the model fit.
MAX_TRAIN = 40_000
MAX_LANGS = 512


@dataclass
class LanguageModel:
    langs: list[str]
    logp: np.ndarray  # languages x (buckets + 1); the last bucket is padding
    prior: np.ndarray


def learn(labelled: DataFrame, max_train: int = MAX_TRAIN, alpha: float = 0.1) -> LanguageModel:
    """``labelled`` (doc_id, text, lang): rows with text and lang to learn from."""
    rows = labelled.where("text is not null and lang is not null")
    sample = rows.where(sampled(F.col("doc_id"), max_train, rows.count()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            names = b.column(1).to_pylist()
            for points, starts, owner in groups(b.column(0).to_pylist(), PAD):
                by_lang: dict[str, list[int]] = {}
                for i, row in enumerate(owner):
                    by_lang.setdefault(names[row], []).append(i)
                width = np.diff(np.append(starts, len(points)))
                grams = [hashed(points, starts, PAD, size, BITS) for size in SIZES]
                for name, pieces in by_lang.items():
                    mine = np.repeat(np.isin(np.arange(len(starts)), pieces), width)
                    c = seen.setdefault(name, np.zeros((1 << BITS) + 1, np.int64))
                    for h in grams:
                        c += np.bincount(h[mine], minlength=len(c))
        for name, c in seen.items():
            at = np.flatnonzero(c[:-1])
            yield pa.record_batch([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(c[at])],
                                  names=["lang", "bucket", "n"])

    ready(rows.sparkSession)
    counts = (sample.select(F.lower("text").alias("text"), "lang")
              .mapInArrow(count, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    docs = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(docs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    langs = sorted(docs)
    table = np.full((len(langs), 1 << BITS), alpha)
    got = counts.toArrow()  # at most languages x buckets rows
    place = {lang: i for i, lang in enumerate(langs)}
    at = np.array([place[x] for x in got["lang"].to_pylist()], np.int64)
    np.add.at(table, (at, got["bucket"].to_numpy()), got["n"].to_numpy())
    logp = np.log(table / table.sum(axis=1, keepdims=True)) if langs else table
    total = max(1, sum(docs.values()))
    return LanguageModel(langs, np.hstack([logp, np.zeros((len(langs), 1))]).astype(np.float32),
                         np.log(np.array([docs[x] / total for x in langs])))


def log_scores(texts: list[str | None], model: LanguageModel) -> np.ndarray:
    """Rows x languages: log prior plus log probabilities of all n-grams."""
    out = np.tile(model.prior, (len(texts), 1))
    for points, starts, owner in groups(texts, PAD):
        for size in SIZES:
            h = hashed(points, starts, PAD, size, BITS)
            for i, row in enumerate(model.logp):
                np.add.at(out[:, i], owner, np.add.reduceat(row[h], starts, dtype=np.float64))
    return out


def predict(docs: DataFrame, model: LanguageModel, text: Column, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score`` (posterior of the prediction)."""
    ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.when(text.rlike(r"\p{L}"), F.lower(text)).alias("__text"))
    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            texts = b.column(len(keep)).to_pylist()
            pred, score = ["und"] * len(texts), np.zeros(len(texts))
            if m.langs:
                logs = log_scores(texts, m)
                best = logs.argmax(axis=1)
                post = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                for i, t in enumerate(texts):
                    if t is not None:
                        pred[i], score[i] = m.langs[best[i]], post[i]
            yield pa.record_batch([*b.columns[:-1], pa.array(pred, pa.string()), pa.array(score)],
                                  names=[*b.schema.names[:-1], "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
