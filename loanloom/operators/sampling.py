"""Samples and holdouts decided by a hash of the key.

The order of rows, the number of partitions and the other columns have no say, so
every feature set sees the same rows on the same side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions import columns as C
from loanloom.sources.shared import fresh_path
from loanloom.sources.sinks import write_parquet
from loanloom.specs import SEED, TRAIN_PERCENT

#: Hexadecimal digits resolved per round, 65 536 cells for each class, and rounds. The rows of
#: a class's last cell, one in 4 billion, are ordered.
DIGITS, ROUNDS = 4, 2


def last_digests(digests: DataFrame, quotas: DataFrame) -> DataFrame:
    """class and the `quota`-th smallest digest of each (`last`), for any number of classes.

    `digests` has class and digest, `quotas` class and quota, at least 1 and at most the rows
    of the class. A round counts the rows per class and leading digits, so that only those
    in the cells that hold the answers go on; all classes share each round.
    """
    state = quotas.select(F.col("class").alias("_class"), F.lit("").alias("_prefix"), F.col("quota").alias("_left"))
    same = F.col("class").eqNullSafe(F.col("_class"))
    for k in range(1, ROUNDS + 1):
        inside = digests.join(state, same & F.col("digest").startswith(F.col("_prefix")))
        cells = inside.groupBy("class", F.substring("digest", 1, k * DIGITS).alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.max("_left").alias("_left")
        )
        seen = F.sum("n").over(Window.partitionBy("class").orderBy("cell"))
        cells = cells.withColumn("_seen", seen).filter("_seen >= _left AND _seen - n < _left")
        found = cells.select(F.col("class").alias("_class"), F.col("cell").alias("_prefix"), (F.col("_left") - F.col("_seen") + F.col("n")).alias("_left"))
        state = write_parquet(found, fresh_path(digests.sparkSession, "cells"))
    inside = digests.join(state, same & F.col("digest").startswith(F.col("_prefix")))
    place = F.row_number().over(Window.partitionBy("class").orderBy("digest"))
    return inside.withColumn("_place", place).filter("_place = _left").select("class", F.col("digest").alias("last"))


def sample_n(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """A simple random sample of n rows; the whole table if it has no more.

    `key` must be unique and not null. The result is a filter on the table: nothing is
    shuffled.
    """
    if n <= 0:
        return df.limit(0)
    digest = C.key_digest(F.col(key), seed)
    digests = df.select(F.lit(0).alias("class"), digest.alias("digest"))
    if df.count() <= n:
        return df
    quota = df.sparkSession.createDataFrame([(0, n)], "class int, quota long")
    return df.filter(digest <= last_digests(digests, quota).first()["last"])


def _side(is_train: Column) -> Column:
    return F.when(is_train, "train").otherwise("validation")


def split(df: DataFrame, key: str, seed: int = SEED, train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """Adds `split`. Each row's side is independent of its class, so classes keep their
    shares up to chance; a narrow projection."""
    return df.withColumn("split", _side(C.hash_percent(F.col(key), seed) < train_percent))


def class_quotas(counts: DataFrame, rows: Callable[[Column], Column]) -> DataFrame:
    """`rows(total)` rows shared among the classes in proportion, rounded so that they add up.

    `counts` has class and n. Largest remainders are rounded up, ties by the class's name; that
    order is over one row per class.
    """
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = counts.withColumn("_total", F.sum("n").over(every)).withColumn("_rows", rows(F.col("_total")))
    df = df.withColumn("_exact", F.col("_rows") * F.col("n") / F.col("_total")).withColumn("_floor", F.floor("_exact"))
    place = F.row_number().over(Window.orderBy(F.desc(F.col("_exact") - F.col("_floor")), F.col("class").cast("string")))
    more = place <= F.col("_rows") - F.sum("_floor").over(every)
    return df.select("class", (F.col("_floor") + F.when(more, 1).otherwise(0)).alias("quota"))


def _with_last(df: DataFrame, key: str, label: str, seed: int, rows: Callable[[Column], Column]) -> tuple[DataFrame, Column]:
    """`df` joined to its class's last digest, and whether a row is among the quota."""
    digest = C.key_digest(F.col(key), seed)
    digests = df.select(F.col(label).alias("class"), digest.alias("digest"))
    counts = digests.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    quotas = write_parquet(class_quotas(counts, rows), fresh_path(df.sparkSession, "quotas"))
    last = last_digests(digests, quotas.filter("quota > 0"))
    last = write_parquet(last, fresh_path(df.sparkSession, "last")).toDF("_class", "_last")
    joined = df.join(last, F.col(label).eqNullSafe(F.col("_class")), "left")
    return joined, F.coalesce(digest <= F.col("_last"), F.lit(False))


def stratified_sample(df: DataFrame, key: str, label: str, n: int, seed: int = SEED) -> DataFrame:
    """A sample of n rows with the class shares of the table; all rows if it has no more.

    `key` must be unique; `label` may have any number of values.
    """
    joined, is_first = _with_last(df, key, label, seed, lambda total: F.least(total, F.lit(max(n, 0))))
    return joined.filter(is_first).drop("_class", "_last")


def stratified_split(
    df: DataFrame, key: str, label: str, seed: int = SEED, train_percent: int = TRAIN_PERCENT
) -> DataFrame:
    """Adds `split` with the exact share of every class on either side.

    `key` must be unique; `label` may have any number of values. The number of jobs does not
    depend on it.
    """
    joined, is_first = _with_last(df, key, label, seed, lambda total: total - F.ceil(total * (100 - train_percent) / 100))
    return joined.withColumn("split", _side(is_first)).drop("_class", "_last")
