"""Quantiles of tables that come load by load, from sketches that merge.

Every load is sketched once, a few kilobytes per column; the sketches of any loads merge into those of their
union. An answer's rank is off by at most `rank_error(k)` of all rows, with 99 % confidence for
each answer. `quantiles` finds exact ones, by passes over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.naming import quote

K = 4096


def rank_error(k: int = K) -> float:
    """The sketch family's published bound on the error of a rank, as a share of all rows."""
    return 2.296 / k**0.9021


def _value(column: str) -> str:
    """The column as double; NaN counts as missing."""
    return f"nullif(cast({quote(column)} AS double), double('NaN'))"


def sketches(df: DataFrame, columns: Sequence[str], by: str | None = None, k: int = K) -> DataFrame:
    """One row per load (value of `by`) and column: its sketch. One pass over the rows."""
    load = F.col(by).cast("string") if by else F.lit("all")
    folds = [F.expr(f"kll_sketch_agg_double({_value(c)}, {k})").alias(f"s{i}") for i, c in enumerate(columns)]
    listed = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return df.groupBy(load.alias("load")).agg(*folds).select("load", F.inline(listed))


def quantiles(stored: DataFrame, probs: Sequence[float], k: int = K) -> DataFrame:
    """column_name, n, prob and value from the merged sketches of the loads in `stored`.

    Columns without values have no row.
    """
    merged = stored.groupBy("column_name").agg(F.expr(f"kll_merge_agg_double(sketch, {k})").alias("_all"))
    merged = merged.filter(F.expr("kll_sketch_get_n_double(_all) > 0"))
    listed = ", ".join(f"double({p!r})" for p in probs)
    values = F.expr(f"kll_sketch_get_quantile_double(_all, array({listed}))")
    asked = F.arrays_zip(F.array(*map(F.lit, probs)).alias("prob"), values.alias("value"))
    return merged.select("column_name", F.expr("kll_sketch_get_n_double(_all)").alias("n"), F.inline(asked))


def audit(df: DataFrame, answers: DataFrame, k: int = K) -> DataFrame:
    """`answers` with `within`: does the value lie between the exact quantiles at prob -+ the error?

    One pass that counts the rows below and up to each answer, all together.
    """
    asked = answers.collect()  # probs times columns
    counts = [
        fold.alias(f"{tag}{i}")
        for i, r in enumerate(asked)
        for tag, fold in (
            ("below", F.count_if(F.expr(f"{_value(r.column_name)} < {r.value!r}D"))),
            ("up_to", F.count_if(F.expr(f"{_value(r.column_name)} <= {r.value!r}D"))),
        )
    ]
    found, error = df.agg(*counts).first(), rank_error(k)
    rows = [
        (r.column_name, r.n, r.prob, found[f"below{i}"] <= (r.prob + error) * r.n and found[f"up_to{i}"] >= (r.prob - error) * r.n)
        for i, r in enumerate(asked)
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, n long, prob double, within boolean")
