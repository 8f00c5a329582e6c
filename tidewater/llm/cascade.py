"""Operator 6: URL filter by Bloom filter cascades.

A list of (host, path) keys is encoded for the complete set of keys that the
corpus can ask for: level 0 holds the listed keys, level 1 the asked keys that
level 0 takes for listed, level 2 the listed keys that level 1 takes for
unlisted, and so on until a level makes no mistake.  A key is listed if the
first level that denies it is an odd one (or all levels accept it and the last
is even): exact for every key of the corpus, with no join when pages are
judged.  Filters are about as large as the list, not as the corpus.

A page asks for its host and parent domains times the prefixes of its path, of
the label counts and lengths that the rules have; the longest listed key wins.

Edge cases: a url that is null or has no ``://`` has empty host and path and
meets no rule; such pages get the default verdict; repeated rows are judged
alike; an empty table gives no rows; an empty rule list meets nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UPPER, materialise, ready

#: Size bound of one broadcast level, in bits.
MAX_BITS = 2**31
Level = tuple[int, int, int, np.ndarray]  # salt, bits, hashes, words


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def asked_keys(host: Column, path: Column, labels: Sequence[int], lengths: Sequence[int]) -> Column:
    """Array of keys (domain of ``labels`` labels + path prefix of ``lengths``)."""
    parts = F.split(host, r"\.")
    keys = [
        F.when((F.length(host) > 0) & (F.size(parts) >= n) & (F.length(path) >= m),
               F.concat(F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."), F.substring(path, 1, m)))
        for n in labels for m in lengths
    ]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def _hash(i: int) -> Callable[[Column], Column]:
    return lambda key: F.xxhash64(F.lit(i), key)


def _hashes(key: str) -> list[Column]:
    return [_hash(i)(F.col(key)).alias(f"h{i}") for i in (1, 2)]


def _slots(h1: np.ndarray, h2: np.ndarray, level: Level) -> Iterator[np.ndarray]:
    salt, bits, hashes, _ = level
    a, b = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
    for i in range(hashes):
        x = (a + np.uint64(2 * i + 1) * b) ^ np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        yield (x ^ (x >> np.uint64(29))) % np.uint64(bits)


def accepts(h1: np.ndarray, h2: np.ndarray, level: Level) -> np.ndarray:
    ok = np.ones(len(h1), bool)
    for slot in _slots(h1, h2, level):
        ok &= (level[3][slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0
    return ok


def listed(h1: np.ndarray, h2: np.ndarray, levels: Sequence[Level]) -> np.ndarray:
    """Exact membership of keys of the corpus."""
    out, alive = np.zeros(len(h1), bool), np.arange(len(h1))
    for i, level in enumerate(levels):
        ok = accepts(h1[alive], h2[alive], level)
        out[alive[~ok]] = i % 2 == 1
        alive = alive[ok]
    out[alive] = len(levels) % 2 == 1
    return out


def _build(keys: DataFrame, n: int, salt: int, rate: float, max_bits: int) -> Level:
    """One Bloom filter over ``keys`` (h1, h2); words meet on the driver, at most ``max_bits``."""
    bits = max(64, math.ceil(n * math.log2(1 / rate) / math.log(2)))
    if bits > max_bits:
        raise ValueError(f"a level needs {bits} bits, the bound is {max_bits}")
    level = (salt, bits, max(1, round(math.log2(1 / rate))), np.zeros(0, np.uint64))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h1, h2 = (b.column(i).to_numpy() for i in (0, 1))
            for slot in _slots(h1, h2, level):
                yield pa.record_batch([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(
                    (np.uint64(1) << (slot & np.uint64(63))).view(np.int64))], names=["word", "bit"])

    words = keys.select("h1", "h2").mapInArrow(fill, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("w"))
    full = np.zeros(bits // 64 + 1, np.uint64)
    for r in words.toLocalIterator():
        full[r["word"]] = np.uint64(r["w"] % 2**64)
    return level[:3] + (full,)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    sent = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [b.schema.get_field_index(c) for c in ("h1", "h2")]
            yield b.filter(pa.array(accepts(*(b.column(i).to_numpy() for i in at), sent.value)))

    return keys.mapInArrow(run, keys.schema)


def build_cascade(keys: DataFrame, asked: DataFrame, max_bits: int = MAX_BITS, max_levels: int = 60) -> list[Level]:
    """Levels for the listed ``keys`` (key) over all ``asked`` keys (key)."""
    yes = materialise(keys.select("key").distinct().select("key", *_hashes("key")), "listed")
    n_yes, n_all = yes.count(), asked.count()
    if not n_yes:
        return []
    # level 0 leaves about as many mistakes as there are listed keys
    rate = min(0.5, n_yes * math.sqrt(0.5) / max(1, n_all))
    levels = [_build(yes, n_yes, 0, rate, max_bits)]
    asked = asked.select("key", *_hashes("key"))
    no = materialise(_passing(asked, levels[0]).join(yes.select("key"), "key", "left_anti"), "mistaken")
    sides = [no, yes]  # the next level holds sides[0], which sides[1] must tell apart
    while (n := sides[0].count()) and len(levels) < max_levels:
        levels.append(_build(sides[0], n, len(levels), 0.5, max_bits))
        sides = [materialise(_passing(sides[1], levels[-1]), f"level{len(levels)}"), sides[0]]
    if n:
        raise ValueError(f"{max_levels} levels do not tell all keys apart")
    return levels


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``rules`` holds (verdict, host, path).  One cascade for each verdict
    answers which asked keys carry it.
    """
    spark = pages.sparkSession
    ready(spark)
    labels = sorted({len(h.split(".")) for _, h, _ in rules})
    lengths = sorted({len(p) for _, _, p in rules})
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rows = rows.withColumn("asked", asked_keys(F.col("host"), F.col("path"), labels, lengths))
    universe = materialise(rows.select(F.explode("asked").alias("key")).distinct(), "asked")
    verdicts = sorted({v for v, _, _ in rules})
    cascades = {}
    for v in verdicts:
        keys = spark.createDataFrame([(h + p,) for w, h, p in rules if w == v], "key string")
        cascades[v] = build_cascade(keys, universe)
    sent = spark.sparkContext.broadcast(cascades)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = dict(zip(b.schema.names, b.columns, strict=True))
            keys, owner = d["asked"].flatten(), np.repeat(np.arange(len(b)), np.diff(d["asked"].offsets.to_numpy()))
            h1, h2 = (d[c].flatten().to_numpy() for c in ("h1", "h2"))
            rule, verdict = [None] * len(b), [default] * len(b)
            for v, levels in sent.value.items():
                hit = np.flatnonzero(listed(h1, h2, levels)) if levels else ()
                for i in hit:
                    key, row = keys[int(i)].as_py(), owner[i]
                    if rule[row] is None or len(key) > len(rule[row]):
                        rule[row], verdict[row] = key, v
            yield pa.record_batch([d["page_id"], d["host"], d["path"], pa.array(rule, pa.string()),
                                   pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    with_hashes = rows.select("page_id", "host", "path", "asked", *[
        F.transform("asked", _hash(i)).alias(f"h{i}") for i in (1, 2)])
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, verdict string"
    return with_hashes.mapInArrow(run, schema)
