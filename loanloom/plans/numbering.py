"""Consecutive numbers for sorted rows, given where the rows lie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.sources.shared import fresh_path
from loanloom.sources.sinks import write_parquet


def numbered(df: DataFrame, *order: Column | str, name: str = "number") -> DataFrame:
    """`df` with its rows' places, from 0, in the order given; any number of rows.

    The sorted parts are written with a place inside the part, to which the sizes of the
    parts before, one row each, are added.
    """
    placed = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", 33)
    placed = placed.withColumns({"_part": part, "_place": F.col("_id") - F.shiftleft(part, 33)}).drop("_id")
    placed = write_parquet(placed, fresh_path(df.sparkSession, "numbered"))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    offsets = sizes.select("_part", before.alias("_before"))
    joined = placed.join(offsets, "_part")
    return joined.withColumn(name, F.col("_before") + F.col("_place")).select(*df.columns, name)
