"""The most frequent of any number of categories, exact, from sketches that merge.

A frequent-items sketch is a few hundred counters, however many categories there are. Loads
are sketched once and their sketches combined. The sketch names candidates; one narrow
pass counts those exactly. The sketch's error bound then proves the list complete, that is, no
category outside can reach the last place, or all categories are counted after all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.naming import quote

#: Counters of a sketch: a power of two, of which three quarters are in use.
COUNTERS = 1024
TRACKED = COUNTERS * 3 // 4
#: A sketch of m counters misjudges a count by at most 3.5 / m of all rows. Categories whose lower
#: bound lies under that are not listed, so one that is missing has at most twice as many rows.
UNLISTED_SHARE = 2 * 3.5 / COUNTERS


def sketches(history: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """One row per load (value of `by`): its sketch, and its rows with a category (`n`) and without (`n_null`).

    Without rows there are no loads, hence no sketch.
    """
    values = [
        F.expr(f"approx_top_k_accumulate({quote(column)}, {TRACKED})").alias("sketch"),
        F.count(quote(column)).alias("n"),
        F.count_if(F.col(quote(column)).isNull()).alias("n_null"),
    ]
    # always grouped: the sketch function cannot take a task without rows otherwise
    return history.groupBy(F.col(by) if by else F.lit("all").alias("load")).agg(*values)


@dataclass(frozen=True)
class Found:
    """The ranked categories and whether the sketch proved them complete."""

    ranked: DataFrame
    proven: bool


def _exact(history: DataFrame, column: str) -> DataFrame:
    return history.groupBy(F.col(quote(column)).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def most_frequent(history: DataFrame, column: str, top: int, stored: DataFrame | None = None) -> Found:
    """value and n of the `top` categories by falling count, null among them, ties by name with null first.

    `stored` are the `sketches` of the loads that `history` consists of; without them it is sketched here.
    """
    spark = history.sparkSession
    stored = sketches(history, column) if stored is None else stored
    combined = f"approx_top_k_estimate(approx_top_k_combine(sketch, {TRACKED}), {TRACKED})"
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "n_null")]
    row = stored.groupBy(F.lit(1).alias("_all")).agg(F.expr(combined).alias("items"), *totals).first()
    _, items, n, nulls = row or (1, [], 0, 0)
    # at most TRACKED names leave Spark and come back as a broadcast list
    candidates = [(i["item"],) for i in items if i["item"] is not None]
    kind = history.schema[column].dataType.simpleString()
    listed = spark.createDataFrame(candidates, f"_candidate {kind}")
    counted = _exact(history.join(F.broadcast(listed), F.col(quote(column)) == F.col("_candidate"), "left_semi"), column)
    if nulls:
        counted = counted.unionByName(spark.createDataFrame([(None, nulls)], f"value {kind}, n long"))
    order = [F.desc("n"), F.col("value").asc_nulls_first()]
    rows = counted.orderBy(*order).collect()
    covered = sum(r["n"] for r in rows) == n + nulls
    if covered or (len(rows) >= top and rows[top - 1]["n"] > UNLISTED_SHARE * n):
        return Found(spark.createDataFrame(rows[:top], counted.schema), True)
    return Found(_exact(history, column).orderBy(*order).limit(top), False)
