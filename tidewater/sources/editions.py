"""Ship-metadata edition scans (S11) with the edition converters.

An edition is fixed-width or ';'-delimited text in ISO-8859-1; the schema
lists (name, kind, width) per column.  Conversion is column expressions on
the decoded text (no row-wise Python).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MISSING_INT = -999999
MISSING_FLOAT = -999999.0
MISSING_TEXT = "NULL"


def to_int(c: Column) -> Column:
    """Strip, drop '-', '.00' and '.0'; 'OT' -> 0; blank/NA/nan -> missing."""
    x = F.trim(c)
    x = F.replace(F.replace(F.replace(x, F.lit("-"), F.lit("")), F.lit(".00"), F.lit("")), F.lit(".0"), F.lit(""))
    return (F.when(x == "OT", F.lit(0)).when(x.isNull() | x.isin("", "NA", " ", "nan"), F.lit(MISSING_INT))
            .otherwise(x.try_cast("int")))


def to_float(c: Column) -> Column:
    """Strip, drop '-', ',' -> '.', '..' -> '.', drop ' M' and 'm', '/' -> '.'."""
    x = F.trim(c)
    for a, b in (("-", ""), (",", "."), ("..", "."), (" M", ""), ("m", ""), ("/", ".")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.when(x.isNull() | x.isin("", "NA"), F.lit(MISSING_FLOAT)).otherwise(x.try_cast("double"))


def to_text(c: Column) -> Column:
    x = F.upper(F.trim(c))
    return F.when(x.isNull() | x.isin("", "-", "NAN", "."), F.lit(MISSING_TEXT)).otherwise(x)


CONVERTERS = {"int": to_int, "float": to_float, "object": to_text}


def read_edition(spark: SparkSession, path: str, columns: list[tuple[str, str, int]], fmt: str = "delimited",
                 encoding: str = "ISO-8859-1", sep: str = ";") -> DataFrame:
    """``columns`` = [(name, kind, width)]; ``fmt`` 'delimited' (';')
    or 'fixed' (widths).  Values arrive as text and pass the edition
    converters for their kind."""
    if fmt == "delimited":
        schema = ", ".join(f"`{n}` string" for n, _k, _w in columns)
        raw = spark.read.option("encoding", encoding).csv(path, sep=sep, header=False, schema=schema, quote="")
        cols = [CONVERTERS[k](F.col(n)).alias(n) for n, k, _w in columns]
        return raw.select(*cols)
    lines = spark.read.option("encoding", encoding).csv(path, sep="\u0001", header=False,
                                                        schema="value string", quote="", ignoreLeadingWhiteSpace=False,
                                                        ignoreTrailingWhiteSpace=False)
    pos, cols = 1, []
    for n, k, w in columns:
        cols.append(CONVERTERS[k](F.substring("value", pos, w)).alias(n))
        pos += w
    return lines.select(*cols)
