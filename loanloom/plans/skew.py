"""Grouping many rows into wide rows without a hot task.

A wide aggregate keeps hundreds of buffers per key, far more bytes than the few
rows a key usually has. Partial results would therefore be larger than the rows, so
rows are shuffled once as they are and aggregated where they land. That is wrong for
a key with very many rows: all of them would land in one task. Such keys go the other
way: every task first folds its rows of a hot key into one, and only these move.
Which way a key takes never changes its result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.sources.shared import fresh_path
from loanloom.sources.sinks import write_parquet

#: A key with more rows than this is hot: whatever the table, no other key brings more into one task.
HOT_ROWS = 100_000
#: Keys that the list of hot ones may hold; it is broadcast. Beyond 10^11 rows the bar rises,
#: so that no more can be hot.
MOST_HOT = 1_000_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS, most: int = MOST_HOT) -> DataFrame:
    """The keys with more than `hot_rows` rows, as a written table; fewer than `most` of them.

    One pass over the key column. Null is no key.
    """
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    found = write_parquet(counted.filter(F.col("_rows") > hot_rows), fresh_path(df.sparkSession, "hot-keys"))
    n, rows = found.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    if n >= most:
        # fewer than `most` keys can have more than this share of the rows listed
        found = found.filter(F.col("_rows") > rows / most)
    return found.select(key)


def wide_aggregate(
    df: DataFrame,
    key: str,
    aggregates: Sequence[Column],
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    hot_rows: int = HOT_ROWS,
    parts: int | None = None,
    in_place: bool = False,
) -> DataFrame:
    """`prepare(df).groupBy(key).agg(*aggregates)`, hash-partitioned by `key`, in `parts` parts.

    `prepare` is a narrow step (derived columns) that runs after the shuffle, so its
    columns are never moved. Rows with a null key are dropped. One job over the key
    column finds the hot keys; without any the plan is a single shuffle. With some, both
    halves of the union are partitioned alike, which Spark keeps: a later join on `key`
    moves only the other side. With `in_place` the rows already lie partitioned by key,
    hot keys apart, and nothing moves.
    """
    df = df.filter(F.col(key).isNotNull())

    def folded(rows: DataFrame) -> DataFrame:
        return prepare(rows).groupBy(key).agg(*aggregates)

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(key) if parts is None else rows.repartition(parts, key)

    if in_place:
        return folded(df)
    hot = hot_keys(df, key, hot_rows)
    if hot.isEmpty():
        return folded(dealt(df))
    listed = F.broadcast(hot)
    cold = folded(dealt(df.join(listed, key, "left_anti")))
    melted = folded(df.join(listed, key, "left_semi"))
    return cold.unionByName(melted if parts is None else dealt(melted))
