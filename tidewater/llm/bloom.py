"""A plain Bloom filter of ids, to drop rows before a shuffle.

It never drops a row that is wanted; the join that follows drops the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import mix

#: Bound of the broadcast filter in bits (32 MB); beyond it more rows pass.
MAX_BITS = 2**28
_HASHES = 5


def _slots(ids: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for i in range(_HASHES):
        yield mix(ids.view(np.uint64) + np.uint64((i + 1) * 0x632BE59BD9B4E019 % 2**64)) % np.uint64(bits)


def build(ids: DataFrame) -> np.ndarray:
    """Filter words of ``ids`` (one long column)."""
    bits = int(min(MAX_BITS, max(1024, 10 * ids.count())))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for slot in _slots(b.column(0).to_numpy(), bits):
                yield pa.record_batch([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(
                    (np.uint64(1) << (slot & np.uint64(63))).view(np.int64))], names=["word", "bit"])

    words = np.zeros(-(-bits // 64), np.uint64)
    parts = ids.mapInArrow(fill, "word long, bit long").groupBy("word").agg({"bit": "bit_or"}).toDF("word", "bit").toArrow()
    words[parts["word"].to_numpy()] = parts["bit"].to_numpy().view(np.uint64)
    return np.append(words, np.uint64(bits))


def may_hold(words: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids may be in the filter (all that are, and few others)."""
    ok = np.ones(len(ids), bool)
    for slot in _slots(ids, int(words[-1])):
        ok &= (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0
    return ok


def in_filter(words: np.ndarray, key: Column) -> Column:
    """Whether ``key`` (long) may be in the filter, for a whole DataFrame: the
    filter is broadcast and only the key goes through Python."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def held(ids: pd.Series) -> pd.Series:
        return pd.Series(may_hold(sent.value, ids.to_numpy(np.int64)))

    return held(key)


def split(rows: DataFrame, keys: list[str], ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``keys`` are surely not in ``ids`` (the same columns), and
    the others, of which few are in it by mistake.  Rows of the first part need
    no join, so wide rows are not shuffled for a few that are looked for."""
    words = build(ids.select(F.xxhash64(*keys).alias("key")))
    flagged = rows.withColumn("maybe__", in_filter(words, F.xxhash64(*keys)))
    return flagged.where("not maybe__").drop("maybe__"), flagged.where("maybe__").drop("maybe__")
