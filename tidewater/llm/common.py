"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import ensure_checkpoint_dir, ship_package

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: A null doc_id counts as the largest id.
LAST_ID = 2**63 - 1
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(col, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give []."""
    parts = F.split(F.coalesce(text, F.lit("")), GAP)
    return F.filter(parts, lambda w: w != F.lit(""))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 is 0.  A null id is held out (never learned from)."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(5)) == 0, F.lit(True))


def sampled(key: Column, most: int, rows: int) -> Column:
    """About ``most`` of ``rows`` rows, by a 63-bit hash of ``key``, at any table size."""
    limit = min(2**63, -(-most * 2**63 // max(1, rows))) - 1
    return F.shiftrightunsigned(F.xxhash64(key), 1) <= F.lit(limit)


#: Rows that Arrow hands to Python at once while a table is written: whole
#: texts and sets are long, so fewer than Spark's 10,000.
ARROW_ROWS = 1000
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, and what it computed is never computed twice."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(_ARROW)
    spark.conf.set(_ARROW, str(min(int(before), ARROW_ROWS)) if int(before) > 0 else str(ARROW_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_ARROW, before)
    return spark.read.schema(df.schema).parquet(path)


def ready(spark: SparkSession) -> None:
    """Executors need this package to unpickle the Arrow functions."""
    ship_package(spark)
