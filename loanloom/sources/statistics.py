"""Counts and ranges of written tables from the files' own statistics, without reading a row.

Spark's second Parquet reader answers count, min and max from the footers. It is switched on
in a session of its own, so the caller's settings stay as they are. Floating point numbers are left out of
ranges: footers do not tell 0.0 from -0.0 and may lack NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.naming import quote
from loanloom.operators import gold
from loanloom.operators.profile import missing_report
from loanloom.sources.raw import Audit

SETTINGS = {"spark.sql.sources.useV1SourceList": "csv,json,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def footer_aggregate(spark: SparkSession, path: str, aggregates: Sequence[Column]) -> DataFrame:
    """`aggregates` (counts; smallest and largest of whole numbers) of the Parquet files at `path`."""
    session = spark.newSession()
    for name, value in SETTINGS.items():
        session.conf.set(name, value)
    return session.read.parquet(path).agg(*aggregates)


def audit(spark: SparkSession, path: str, table: str, key: str) -> Audit:
    """What `raw.write_audited` counts, of a table that was written before."""
    rows, keys = footer_aggregate(spark, path, [F.count(F.lit(1)).alias("n"), F.count(quote(key)).alias("k")]).first()
    rows, keys = rows or 0, keys or 0  # a sum of the files' counts, null without any
    return Audit(table, rows, len(spark.read.parquet(path).columns), rows - keys)


def missing_profile(spark: SparkSession, path: str) -> DataFrame:
    """`profile.missing_profile` of a written table."""
    columns = spark.read.parquet(path).columns
    counts = [F.count(quote(c)).alias(f"c{i}") for i, c in enumerate(columns)]
    n, *filled = footer_aggregate(spark, path, [F.count(F.lit(1)).alias("n"), *counts]).first()
    rows = [(c, n or 0, k or 0) for c, k in zip(columns, filled, strict=True)]
    return missing_report(spark.createDataFrame(rows, "column_name string, n long, filled long"))


def ranges(spark: SparkSession, path: str) -> dict[str, tuple[int | None, int | None]]:
    """Smallest and largest value of every column of whole numbers; None without any.

    Where a file has no value of a column that has some elsewhere, its footer has no range, which
    Spark refuses: the rows of these columns are read then.
    """
    whole = [f.name for f in spark.read.parquet(path).schema if isinstance(f.dataType, WHOLE)]
    counts = [F.count(quote(c)).alias(f"c{i}") for i, c in enumerate(whole)]
    filled = footer_aggregate(spark, path, counts).first() if whole else []
    names = [c for c, n in zip(whole, filled, strict=True) if n]
    found = dict.fromkeys(whole, (None, None))
    if names:
        ends = [fold(quote(c)).alias(f"{tag}{i}") for i, c in enumerate(names) for tag, fold in (("lo", F.min), ("hi", F.max))]
        try:
            row = footer_aggregate(spark, path, ends).first()
        except Exception as refused:
            if "No min/max found" not in str(refused):
                raise
            row = spark.read.parquet(path).agg(*ends).first()
        found |= {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(names)}
    return found


def narrow_numeric(spark: SparkSession, path: str) -> DataFrame:
    """`gold.narrow_numeric` of a written table, which is read once, when the result is."""
    return gold.narrow_numeric(spark.read.parquet(path), ranges(spark, path))
