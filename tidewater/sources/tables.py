"""Delimited table scans.

All readers pass an explicit schema (no inference pass over the data) and
let Spark prune columns and push filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIPE = "|"
# FIXED VALUES: columns of the headerless working report table
REPORT_COLUMNS = ["YR", "MO", "DY", "HR", "LAT", "LON", "DS", "VS", "ID", "AT", "SST", "DPT", "DCK", "SLP",
                  "SID", "PT", "UID", "W", "D", "IRF", "bad_data", "outfile"]
_INT = {"YR", "MO", "DY", "DS", "VS", "DCK", "SID", "PT", "IRF"}
_TEXT = {"ID", "UID", "outfile"}


def report_schema() -> str:
    def t(c):
        return "int" if c in _INT else "string" if c in _TEXT else "boolean" if c == "bad_data" else "double"
    return ", ".join(f"`{c}` {t(c)}" for c in REPORT_COLUMNS)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Headerless 22-column pipe table; a blank ID becomes empty text
    (as the reference's clean-up) and rows are sorted YR, MO, DY, HR, ID
    within partitions (a global sort is never needed downstream)."""
    df = spark.read.csv(path, sep=PIPE, header=False, schema=report_schema(), mode="PERMISSIVE")
    df = df.withColumn("ID", F.when(F.col("ID") == " ", F.lit("")).otherwise(F.col("ID")))
    return df.sortWithinPartitions("YR", "MO", "DY", "HR", "ID")


def read_cdm(spark: SparkSession, path: str, columns: list[str], source_period: str | None = None) -> DataFrame:
    """CDM table files (header line, '|' separated, 'null' = missing),
    all text; ``leak`` marks rows read from a file of another period when
    the layout is partitioned by ``period``."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = spark.read.csv(path, sep=PIPE, header=True, schema=schema, nullValue="null")
    if source_period is not None and "period" in df.columns:
        df = df.withColumn("leak", F.col("period") != F.lit(source_period))
    return df


def read_corrections(spark: SparkSession, path: str, element: str) -> DataFrame:
    """(gzipped) pipe correction files, no quoting, first 3 columns:
    report_id, <element>, <element>.isChange."""
    df = spark.read.csv(path, sep=PIPE, header=False, quote="",
                        schema="report_id string, value string, isChange string")
    return df.withColumn("element", F.lit(element))


def read_qc_flags(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """QC flag CSV (header line, ',' separated) keeping only ``UID`` and
    the listed flag columns; malformed lines are dropped."""
    df = spark.read.csv(path, header=True, mode="DROPMALFORMED", inferSchema=False)
    return df.select(F.col("UID").alias("uid"), *[F.col(c).cast("int").alias(c) for c in columns])


def read_period(spark: SparkSession, path: str, columns: list[str], period: str) -> DataFrame:
    """One month of a CDM table written by period, its master part and the
    date-leak parts of other source months, as the manifest lists them (only
    their files are opened); a month may have leaks without a master.  ``leak`` says
    which; a month that nothing belongs to has no rows."""
    manifest = spark.read.parquet(f"{path}-manifest").where(F.col("period") == period)
    schema = ", ".join(f"`{c}` string" for c in columns)
    out = None
    for part in manifest.orderBy("source_period").collect():  # at most one part per source month
        folder = f"{path}/period={period}/source_period={part.source_period}"
        rows = spark.read.csv(folder, sep=PIPE, header=True, schema=schema, nullValue="null")
        rows = rows.withColumns({"source_period": F.lit(part.source_period), "leak": F.lit(part.leak)})
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], schema + ", source_period string, leak boolean")
