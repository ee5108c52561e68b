"""Sinks: datasets as Parquet, sidecars as JSON or headered CSV. All rerun idempotently."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write, and go on from the written copy: its lineage starts at the files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV; spaces around values are part of them."""
    writer = df.write.mode("overwrite").option("header", True)
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(side, False)
    writer.csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_types(spark: SparkSession, types: list[str], path: str) -> None:
    """The types a book was built with, so that scoring reuses the same columns."""
    write_json(spark.createDataFrame([(types,)], "types array<string>"), path)


def read_types(spark: SparkSession, path: str) -> list[str]:
    return spark.read.schema("types array<string>").json(path).first()["types"]


def feature_dictionary(book: DataFrame, key: str, origin: str = "bureau_book") -> DataFrame:
    """One row per feature of the book, in column order."""
    rows = [(c, origin) for c in book.columns if c != key]
    return book.sparkSession.createDataFrame(rows, "feature string, origin string")


def write_holdout(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write both sides of a split in one pass and read them back.

    The side is the partition folder, so reading one side never touches the other.
    """
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return tuple(written.filter(F.col("split") == s).drop("split") for s in ("train", "validation"))
