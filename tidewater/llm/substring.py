"""Operator 2: substring deduplication by seed and extend.

A repeat is a run of ``window`` or more words that also occurs earlier
(smaller id, or earlier in the same document).  Every window of that many
words has a winnowed anchor, the smallest hash of the word n-grams in it, so
equal windows have equal anchors.

1. Seeds.  Anchors are joined across documents by an aggregation on the
   anchor; one that occurs once in the corpus cannot seed a repeat.
2. Extension.  An anchor that occurs again is extended to both sides to every
   window whose anchor it is, and each of these is looked up by a 64-bit hash
   of all its words: the first document of a window keeps it, in the others
   (and at later places in the first) it is a repeat.
3. Repeats that overlap or touch are joined to maximal ones and cut out.

Scale: both lookups are aggregations with partial sums, so a passage that
very many documents share meets in one row a task, and no pairs are formed.
What comes back to a document (its unique anchors, the windows it is the first
to have) is bounded by its own length.  Copies of a whole text are found by a
hash of it and take part only in the last step.

Edge cases: null and blank texts have no words; a text with fewer words than a
window loses nothing; a null id counts as the largest and comes back null;
rows that share an id are judged alike, none counting as the earlier one
(a repeated row is no repeat of itself); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, ready
from .words import gram_hashes, word_hashes

WINDOW = 20
#: Words in an anchor n-gram.
ANCHOR = 5


def _slide(a: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    held = 1
    while held * 2 <= width:
        a = pick(a[:-held], a[held:])
        held *= 2
    more = width - held
    return pick(a[: len(a) - more], a[more:]) if more else a


def window_anchors(words: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """The anchor of each window of a document."""
    return _slide(gram_hashes(words, anchor), window - anchor + 1, np.minimum)


def _as_long(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def _anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(h, id, many): distinct anchors of each text; ``many`` if two windows of
    it that do not share one place have that anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            out_h, out_n, out_i = [], [], []
            for i, text in enumerate(b.column(1)):
                w = word_hashes(text.as_py())
                if len(w) < window:
                    continue
                grams = gram_hashes(w, anchor)
                low = _slide(grams, window - anchor + 1, np.minimum)
                low = np.unique(low)
                all_grams = np.sort(grams)
                times = np.searchsorted(all_grams, low, "right") - np.searchsorted(all_grams, low, "left")
                out_h.append(low)
                out_n.append(times)
                out_i.append(np.full(len(low), ids[i]))
            if out_h:
                yield pa.record_batch([_as_long(np.concatenate(out_h)), pa.array(np.concatenate(out_i)),
                                       pa.array(np.concatenate(out_n) > 1)], names=["h", "id", "many"])

    return docs.mapInArrow(run, "h long, id long, many boolean")


def _windows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(w, id): distinct windows of each text whose anchor occurs again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            for i, (text, alone) in enumerate(zip(b.column(1), b.column(2), strict=True)):
                _, hashes, open_ = _open_windows(text.as_py(), alone, window, anchor)
                hit = np.unique(hashes[open_])
                if len(hit):
                    yield pa.record_batch([_as_long(hit), pa.array(np.full(len(hit), ids[i]))], names=["w", "id"])

    return docs.mapInArrow(_packed(run), "w long, id long")


def _packed(run, rows: int = 100_000):
    """Joins the small batches of ``run`` to larger ones."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += len(b)
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return packed


def _numbers(scalar) -> np.ndarray:
    """Values of an array<long> cell, sorted; null gives []."""
    return np.sort(scalar.values.to_numpy().view(np.uint64)) if scalar.is_valid else np.zeros(0, np.uint64)


def _held(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    return among[np.minimum(at, len(among) - 1)] == values


def _open_windows(raw: bytes | None, alone, window: int, anchor: int):
    """Number of words, hash of each window, and whether its anchor occurs again."""
    w = word_hashes(raw)
    if len(w) < window:
        return len(w), np.zeros(0, np.uint64), np.zeros(0, bool)
    return len(w), gram_hashes(w, window), ~_held(window_anchors(w, window, anchor), _numbers(alone))


def _covered(n: int, gone: np.ndarray, window: int) -> np.ndarray:
    """Words that a window in ``gone`` (by start) covers."""
    step = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(gone)
    step[at] += 1
    np.add.at(step, at + window, -1)
    return np.cumsum(step[:-1]) > 0


def remove_repeats(docs: DataFrame, text: Column, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` (doc_id, ...) -> (doc_id, n_words, n_removed, kept, repeats):
    the kept words joined by one space, and the maximal repeats as
    (first word, end word) spans."""
    ready(docs.sparkSession)
    rows = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).cast("long").alias("id"), text.cast("binary").alias("raw"))
    # the smallest id of each text; the other rows with that text are whole repeats
    firsts = (rows.where("raw is not null").groupBy(F.sha2("raw", 256).alias("t")).agg(F.min("id").alias("id"))
              .groupBy("id").agg(F.collect_list("t").alias("firsts")))
    first = rows.join(firsts, "id", "left").withColumn(
        "copy", ~F.coalesce(F.array_contains("firsts", F.sha2("raw", 256)), F.col("raw").isNull())).drop("firsts")
    search = first.where("not copy").select("id", "raw")
    alone = (
        _anchors(search, window, anchor).groupBy("h")
        .agg(F.min("id").alias("id"), F.max("id").alias("last"), F.max("many").alias("many"))
        .where("id = last and not many")
        .groupBy("id").agg(F.collect_list("h").alias("alone"))
    )
    seen = first.join(alone, "id", "left")
    kept = (
        _windows(seen.where("not copy").select("id", "raw", "alone"), window, anchor).groupBy("w").agg(F.min("id").alias("id"))
        .groupBy("id").agg(F.collect_list("w").alias("own"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {"n_words": [], "n_removed": [], "kept": [], "repeats": []}
            for raw, copy, alone, own in zip(*(b.column(i) for i in range(1, 5)), strict=True):
                raw = raw.as_py() or b""
                words = raw.split()  # bytes.split() cuts at the six ASCII white-space characters
                n = len(words)
                if copy.as_py():
                    covered = np.full(n, n >= window)
                else:
                    _, hashes, open_ = _open_windows(raw, alone, window, anchor)
                    gone = open_ & ~_held(hashes, _numbers(own))
                    mine = np.flatnonzero(open_ & ~gone)  # windows that are first here: later places repeat them
                    again = np.ones(len(mine), bool)
                    again[np.unique(hashes[mine], return_index=True)[1]] = False
                    gone[mine[again]] = True
                    covered = _covered(n, gone, window)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], covered, [0])).astype(np.int8)))
                out["n_words"].append(n)
                out["n_removed"].append(int(covered.sum()))
                out["kept"].append(b" ".join([w for w, c in zip(words, covered, strict=True) if not c] if covered.any() else words))
                out["repeats"].append([{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2], strict=True)])
            yield pa.record_batch([
                b.column(0), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()),
                pa.array(out["kept"], pa.binary()).cast(pa.string()),
                pa.array(out["repeats"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["id", "n_words", "n_removed", "kept", "repeats"])

    done = seen.join(kept, "id", "left").select("id", "raw", "copy", "alone", "own").mapInArrow(
        cut, "id long, n_words long, n_removed long, kept string, repeats array<struct<start: long, end: long>>")
    return done.select(F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), "n_words", "n_removed", "kept", "repeats")
