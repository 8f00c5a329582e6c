"""Operator 13: language-model scores from subword lattices.

Tokens are the words of a text, ASCII letters in lower case, and one end.  The
probability of a word is the sum over all segmentations of its lattice
(``lattice``): every piece of an existing vocabulary that fits is an edge,
weighted by the vocabulary's scores, which expected counts over the words of
the training texts re-weight (``ROUNDS`` rounds; the vocabulary itself is never
changed).  A word that training texts hold has one more edge, the whole word:

    p(w) = (c - d + (1 + d V) L(w)) / (N + 1)

with its count c, N training tokens, V distinct ones, L the lattice's marginal
probability and the discount d = n1 / (n1 + 2 n2) from the numbers of words
seen once and twice; an unseen word has c - d = 0.  L gives the end its share
of training tokens and words the rest.  The log-probabilities of a text's
tokens add up to that of the text.

Spark's part: words are counted in tasks and summed by word (the count table
grows with the corpus); expected counts are sums over that table, bounded by
the vocabulary; every distinct word is scored once.  Texts then meet their
words by a 64-bit hash.  The ``FREQUENT`` most frequent words, which would be
hot keys of that join, are broadcast (at most 4 MB) and summed inside the
task; any other word has less than 1 in ``FREQUENT`` of all tokens.

Edge cases: a null text is empty and has its end only; a text or word of any
length is read whole; repeated rows are scored each for themselves, and rows
without id are scored and never learned from; without training texts N = V = 0,
the vocabulary's own scores remain, an end has L = 1/2; an empty table gives
no rows; columns that are not kept may have any name, kept ones must differ from the
result's.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lattice
from .common import materialise, ready
from .words import word_hashes

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS = 3
FREQUENT = 1 << 17
#: Distinct words a task holds before it hands on its counts.
HELD = 300_000
#: The end of a text in the table of words; no word is empty.
END = b""


@dataclass
class Totals:
    """Of the training tokens: all, distinct, distinct seen once and twice, ends."""

    n: int
    v: int
    n1: int
    n2: int
    ends: int

    def discount(self) -> float:
        return min(0.95, max(0.05, self.n1 / (self.n1 + 2 * self.n2))) if self.n1 else 0.5

    def end_share(self) -> float:
        return self.ends / self.n if self.n else 0.5


def tokens(raw: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z in lower case (``bytes`` knows ASCII only)."""
    return (raw or b"").lower().split()


def count_words(rows: DataFrame) -> DataFrame:
    """(raw binary, learn boolean) -> (word binary, c, uses long): uses in
    training texts and in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            words = list(held[0].keys() | held[1].keys())
            c = [held[1][w] for w in words]
            uses = [held[0][w] + n for w, n in zip(words, c, strict=True)]
            return pa.record_batch([pa.array(words, pa.binary()), pa.array(c, pa.int64()), pa.array(uses, pa.int64())],
                                   names=["word", "c", "uses"])

        for b in batches:
            for raw, learn in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                into = held[bool(learn)]
                into.update(tokens(raw.as_py()))
                into[END] += 1
                if len(held[0]) + len(held[1]) > HELD:
                    yield out()
                    held[0].clear()
                    held[1].clear()
        yield out()

    # one row a word and task: no combining in Spark before the shuffle, which is dealt by its set number
    # of partitions, since the lattices of a few MB of words are hours of work
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = rows.mapInArrow(run, "word binary, c long, uses long").repartition(parts, "word")
    return materialise(counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("uses").alias("uses")), "words")


def totals(words: DataFrame) -> Totals:
    seen = F.col("c") > 0
    row = words.agg(F.sum("c").alias("n"), F.count_if(seen).alias("v"), F.count_if(F.col("c") == 1).alias("n1"),
                    F.count_if(F.col("c") == 2).alias("n2"), F.sum(F.when(F.col("word") == F.lit(END), F.col("c"))).alias("e")).first()
    return Totals(row.n or 0, row.v, row.n1, row.n2, row.e or 0)


def fit(words: DataFrame, path: str = VOCABULARY, rounds: int = ROUNDS) -> lattice.Pieces:
    """The vocabulary, re-weighted by expected counts over the training words,
    each once: its weights are for words that were not counted."""
    pieces = lattice.load(path)
    prior = pieces.log_p
    learned = words.where(F.col("c") > 0).where(F.col("word") != F.lit(END)).select("word")
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], pieces: lattice.Pieces = pieces) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(len(pieces.log_p))
            for b in batches:
                counts += lattice.expected(pieces, lattice.all_code_points(b.column(0).to_pylist()))
            at = np.flatnonzero(counts)
            yield pa.record_batch([pa.array(at, pa.int64()), pa.array(counts[at])], names=["piece", "used"])

        used = learned.mapInArrow(run, "piece long, used double").groupBy("piece").agg(F.sum("used").alias("used")).toArrow()
        counts = np.zeros(len(prior))
        counts[used["piece"].to_numpy()] = used["used"].to_numpy()
        pieces = lattice.refit(pieces, counts, prior)
    return pieces


def log10_word(pieces: lattice.Pieces, t: Totals, words: list[bytes], c: np.ndarray) -> np.ndarray:
    """log10 p of every word (or the end), given its training count."""
    d, share = t.discount(), t.end_share()
    is_end = np.array([w == END for w in words], bool)
    low = np.full(len(words), np.log(share) if share > 0 else -np.inf)
    marginal = lattice.forward(pieces, lattice.all_code_points([w for w in words if w != END]))
    low[~is_end] = marginal + np.log1p(-share) if share < 1 else marginal
    low = low + np.log1p(d * t.v)
    own = np.where(c > 0, np.maximum(c - d, 0.0), 0.0)
    with np.errstate(divide="ignore"):
        return (np.logaddexp(np.log(own), low) - np.log(t.n + 1.0)) / np.log(10)


def base_word(t: Totals, c: np.ndarray) -> np.ndarray:
    """The base: training counts with 0.1 added."""
    return (c + 0.1) / (t.n + 0.1 * (t.v + 1))


def score_words(words: DataFrame, pieces: lattice.Pieces, t: Totals) -> DataFrame:
    """(word, c, uses) -> (h, uses, known, base, lp): one row a distinct word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(0).to_pylist()
            c = b.column(1).to_numpy()
            h = word_hashes(b" ".join(raw))  # no word holds a space
            base = np.log10(base_word(t, c))
            yield pa.record_batch([pa.array(h.view(np.int64)), b.column(2), pa.array((c > 0).astype(np.int64)),
                                   pa.array(base), pa.array(log10_word(pieces, t, raw, c))], names=["h", "uses", "known", "base", "lp"])

    return materialise(words.mapInArrow(run, "h long, uses long, known long, base double, lp double"), "word-scores")


def score_texts(docs: DataFrame, text: Column, learn: Column, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep`` columns plus n_tokens, n_known, train_tokens, base_score and
    score (log10) of every row; rows where ``learn`` holds are learned from."""
    ready(docs.sparkSession)
    raw = text.cast("binary")
    words = count_words(docs.select(raw.alias("raw"), F.coalesce(learn, F.lit(False)).alias("learn")))
    t = totals(words)
    pieces = fit(words, vocabulary)
    scored = score_words(words.where(F.col("word") != F.lit(END)), pieces, t)
    top = scored.orderBy(F.col("uses").desc(), "h").limit(FREQUENT).toArrow()
    order = np.argsort(top["h"].to_numpy())
    hot = [top[name].to_numpy()[order] for name in ("h", "known", "base", "lp")]
    end = [float(t.ends > 0), float(np.log10(base_word(t, np.array(t.ends)))),
           float(log10_word(pieces, t, [END], np.array([t.ends]))[0])]
    shared = docs.sparkSession.sparkContext.broadcast((hot, end))

    rows = docs.select(F.monotonically_increasing_id().alias("row__"), raw.alias("raw__"), *[F.col(f"`{c}`") for c in keep])
    sums = "row__ long, h__ long, uses__ long, tokens__ long, known__ long, base__ double, lp__ double"
    kept = [rows.schema[c] for c in keep]
    schema = rows.select("row__").schema.fromDDL(sums)
    for field in kept:
        schema = schema.add(field.name, field.dataType, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (held, known, base, lp), end = shared.value
        for b in batches:
            row, n = b.column(0).to_numpy(), len(b)
            own = np.zeros((4, n))  # tokens, known, base, lp
            parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for i in range(n):
                h = word_hashes((b.column(1)[i].as_py() or b"").lower()).view(np.int64)
                distinct, uses = np.unique(h, return_counts=True)
                at = np.searchsorted(held, distinct)
                at[at == len(held)] = 0
                hit = held[at] == distinct if len(held) else np.zeros(len(distinct), bool)
                at, n_hit = at[hit], uses[hit]
                own[:, i] = [len(h) + 1, known[at] @ n_hit + end[0], base[at] @ n_hit + end[1], lp[at] @ n_hit + end[2]]
                parts.append((np.full((~hit).sum(), row[i]), distinct[~hit], uses[~hit]))
            none = [pa.nulls(n, pa.int64())] * 2
            longs = [pa.array(x.astype(np.int64)) for x in own[:2]]
            yield pa.record_batch([pa.array(row), *none, *longs, pa.array(own[2]), pa.array(own[3]),
                                   *[b.column(2 + j) for j in range(len(keep))]], names=schema.names)
            row, h, uses = (np.concatenate(x) for x in zip(*parts, strict=True))
            empty = [pa.nulls(len(row), pa.int64())] * 2 + [pa.nulls(len(row), pa.float64())] * 2
            yield pa.record_batch([pa.array(row), pa.array(h), pa.array(uses.astype(np.int64)), *empty,
                                   *[pa.nulls(len(row), b.column(2 + j).type) for j in range(len(keep))]], names=schema.names)

    read = materialise(rows.mapInArrow(run, schema), "text-words")
    rare = (read.where("h__ is not null").select("row__", F.col("h__").alias("h"), "uses__")
            .join(scored.select("h", "known", "base", "lp"), "h")
            .groupBy("row__").agg(F.sum(F.col("known") * F.col("uses__")).alias("known"), F.sum(F.col("base") * F.col("uses__")).alias("base"),
                                  F.sum(F.col("lp") * F.col("uses__")).alias("lp")))
    out = read.where("h__ is null").join(rare, "row__", "left")
    return out.select(
        *[F.col(f"`{c}`") for c in keep], F.col("tokens__").alias("n_tokens"),
        (F.col("known__") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(t.n).cast("long").alias("train_tokens"),
        (F.col("base__") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("lp__") + F.coalesce("lp", F.lit(0.0))).alias("score"))
