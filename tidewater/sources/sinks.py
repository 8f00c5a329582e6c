"""Sinks (K1-K3, K6-K9, K11).

Writers partition by the keys the reference spreads over files (source,
month) so every task writes its own files and reruns overwrite only the
partitions they produce (``partitionOverwriteMode=dynamic``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.anomaly import anomaly
from tidewater.functions.calendar import pentad, valid_day_2004
from tidewater.functions.text import MISSING, date_text
from tidewater.operators.util import sized_broadcast
from tidewater.session import open_folders, stage_table

PIPE = "|"


def _replace(df: DataFrame) -> DataFrameWriter:
    """Overwrite only the partitions that ``df`` has rows for."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def write_cdm(df: DataFrame, columns: list[str], path: str, partition_by: list[str] | None = None) -> None:
    """K1: CDM table, fixed column order, 'null' for missing, header line;
    partitions without rows produce no files."""
    parts = partition_by or []
    out = df.select(*columns, *[p for p in parts if p not in columns])
    (_replace(out).partitionBy(*parts)
     .csv(path, sep=PIPE, header=True, nullValue="null"))


def write_by_month(df: DataFrame, path: str, order: list[str] | None = None, pieces: int = 16,
                   by: tuple[str, str] = ("yr", "mo")) -> None:
    """K3 / K9: one folder per (year, month), several sorted files in each: the
    reports of a month are dealt to ``pieces`` tasks by uid, so no task
    writes a whole month."""
    order = order or ["YR", "MO", "DY", "HR", "ID"]
    own = [c for c in df.columns if c.lower() == "uid"] or order
    piece = F.pmod(F.xxhash64(*own), F.lit(pieces))
    (_replace(df.repartition(*by, piece).sortWithinPartitions(*by, *order))
     .partitionBy(*by).csv(path, sep=PIPE, header=False, nullValue=""))


def reindex_tracking(spark: SparkSession, source: str, columns: list[str]) -> DataFrame:
    """K9: rows of all tracking files below ``source`` but those of edge cases
    (chunks that may still change), all text, with the report month."""
    rows = (spark.read.option("recursiveFileLookup", "true").csv(source, header=True, schema=", ".join(f"`{c}` string" for c in columns))
            .where(~F.contains(F.col("_metadata.file_path"), F.lit("edge_case"))))
    return rows.withColumns({"year": F.col("YR").cast("int"), "month": F.col("MO").cast("int")})


def merge_months(rows: DataFrame, path: str, key: str = "UID", by: tuple[str, str] = ("year", "month"),
                 pieces: int = 16) -> list[tuple[int, int]]:
    """K9: merge ``rows`` into a table stored by month and sorted by ``key``:
    a row that is there already is replaced, and only months that ``rows`` has
    are read and rewritten.  Returns these months.

    Within a month the files are ranges of the key, dealt to ``pieces`` tasks a
    month, so a month needs no single task.  The merged months are staged in the
    checkpoint folder before they replace the old ones."""
    spark = rows.sparkSession
    new = stage_table(rows, "tracking-new")
    months = sorted((r[0], r[1]) for r in new.select(*by).distinct().collect())  # as many as there are months
    if not months:
        return []
    merged = new
    if _exists(spark, path):
        own = F.lit(False)
        for y in sorted({m[0] for m in months}):
            own = own | ((F.col(by[0]) == y) & F.col(by[1]).isin([m[1] for m in months if m[0] == y]))
        # partition columns are filters on folders: other months are not read
        old = spark.read.csv(path, header=True, schema=new.schema).where(own)
        merged = new.unionByName(old.join(new.select(*by, key), [*by, key], "left_anti").select(*new.columns))
    merged = stage_table(merged, "tracking-merged")
    (_replace(merged.repartitionByRange(pieces * len(months), *by, key).sortWithinPartitions(*by, key))
     .partitionBy(*by).csv(path, header=True, emptyValue=""))
    return months


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def flag_block(df: DataFrame, parameter: str, flags: list[str], uid: str = "uid",
               month_match: str | None = "month_match") -> DataFrame:
    """K6: UID plus the parameter's flags, never-set flags printed as 9,
    current-month reports only."""
    d = df.where(F.col(month_match) == 1) if month_match and month_match in df.columns else df
    return d.select(F.col(uid).alias("UID"),
                    *[F.coalesce(F.col(f"{parameter.lower()}_{f}"), F.lit(9)).cast("int").alias(f) for f in flags])


def write_flags(block: DataFrame, path: str) -> None:
    """K6: a flag block as CSV with a header line."""
    _replace(block).csv(path, header=True)


def variable_block(df: DataFrame, variables: list[str]) -> DataFrame:
    """K7: a report's identity, date, pentad (NULL for a day no year has) and position, and for every
    variable its value and, where the column ``<variable>_norm`` is there, its anomaly."""
    cols = [F.col("uid").alias("UID"), F.trim("id").alias("ID"), date_text("yr", "mo", "dy").alias("DATE"),
            F.when(valid_day_2004("mo", "dy"), pentad("mo", "dy")).alias("PENTAD"), F.col("hr").alias("HR"), F.col("lat").alias("LAT"), F.col("lon").alias("LON")]
    for v in variables:
        cols.append(F.col(v).alias(v.upper()))
        if f"{v}_norm" in df.columns:
            cols.append(anomaly(v, f"{v}_norm").alias(f"{v.upper()}_ANOM"))
    return df.select(*cols, *[F.col(c).alias(f"f_{c}") for c in ("yr", "mo")])


def write_variable_block(block: DataFrame, path: str) -> None:
    """K7: variable blocks as comma text, a folder a month, the missing mark for NULL."""
    _replace(block).partitionBy("f_yr", "f_mo").csv(path, header=True, nullValue=MISSING)


def read_variable_block(spark: SparkSession, path: str, schema) -> DataFrame:
    """Variable blocks as ``write_variable_block`` leaves them."""
    return spark.read.csv(path, header=True, schema=schema, nullValue=MISSING)


def write_metadata(df: DataFrame, path: str, by: str | None = "rcnty") -> None:
    """Metadata records, one folder per country (or one table)."""
    w = _replace(df)
    if by:
        w = w.partitionBy(by)
    with open_folders(df.sparkSession):
        w.csv(path, sep=PIPE, header=True, nullValue="NULL")


def write_periods(df: DataFrame, columns: list[str], path: str, period: str = "period", source: str = "source_period") -> None:
    """CDM rows by the month they belong to and the month of the
    source file they came from, and a manifest of these parts beside them.  A
    month's master part is the one from its own source; the others are leaks."""
    write_cdm(df, columns, path, partition_by=[period, source])
    parts = df.groupBy(F.col(period).alias("period"), F.col(source).alias("source_period")).agg(F.count(F.lit(1)).alias("rows"))
    parts.withColumn("leak", F.col("period") != F.col("source_period")).write.mode("overwrite").parquet(f"{path}-manifest")


def write_layouts(df: DataFrame, path: str, schema_version: str, call: str = "call", country: str = "rcnty") -> None:
    """Ship metadata records in their three layouts, from one staged pass:
    ``country`` (all columns and the schema version, one folder a country),
    ``master`` (sorted by call sign and begin of validity, records of a
    call sign numbered; those without one have no number) and ``monthly``
    (one folder a month: of the records of a call sign that are valid on its
    first day the one that began last)."""
    from pyspark.sql import Window

    rows = stage_table(df, "metadata")
    named = F.col(call).isNotNull() & (F.col(call) != "NULL")
    write_metadata(rows.withColumn("schema", F.lit(schema_version)), f"{path}/country", country)
    order = Window.partitionBy(call).orderBy("valid_from", "line")
    numbered = rows.where(named).withColumn("record_number", F.row_number().over(order)).unionByName(
        rows.where(~named).withColumn("record_number", F.lit(None).cast("int")))
    master = numbered.repartitionByRange(call, "valid_from", "line").sortWithinPartitions(call, "valid_from", "line")
    write_metadata(master, f"{path}/master", None)
    # the first days that an interval holds: from the month after its begin, or its own
    first = F.when(F.dayofmonth("valid_from") == 1, F.col("valid_from")).otherwise(F.add_months(F.trunc("valid_from", "month"), 1))
    days = F.sequence(first, F.col("valid_to"), F.expr("interval 1 month"))
    monthly = rows.where(named).withColumn("_first", first).where(F.col("_first") <= F.col("valid_to")).withColumn("month", F.explode(days))
    # dates and numbers are compared in place in a hash map; a struct would sort all months of all records
    top = monthly.groupBy(F.col("month").alias("_d"), F.col(call).alias("_k")).agg(F.max("valid_from").alias("_v"))
    top = sized_broadcast(stage_table(top, "layout-dates"))
    ties = monthly.join(top, (F.col("month") == F.col("_d")) & (F.col(call) == F.col("_k")) & (F.col("valid_from") == F.col("_v")))
    last = ties.groupBy("month", F.col(call).alias("_c")).agg(F.min("line").alias("_l"))
    last = sized_broadcast(stage_table(last, "layout-lines"))
    own = monthly.alias("a").join(last.alias("b"), (F.col("a.month") == F.col("b.month")) & (F.col(f"a.{call}") == F.col("_c"))
                                  & (F.col("line") == F.col("_l")), "left_semi")
    write_metadata(own.drop("_first").withColumn("month", F.date_format("month", "yyyy-MM")), f"{path}/monthly", "month")
