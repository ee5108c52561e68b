"""Data profiling. Each report is one aggregate over its table; exact quantiles take further
passes over a copy of their columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.naming import quote
from loanloom.operators.quantiles import exact_quantiles
from loanloom.specs import TableSpec


def _per_column(
    df: DataFrame, columns: Mapping[str, Sequence[Column]], parts: Sequence[str], common: Sequence[Column] = ()
) -> DataFrame:
    """One aggregate over `df`, as one row per named column holding its `parts`.

    `common` are aggregates that every row repeats.
    """
    lists = [F.array(*[folds[i] for folds in columns.values()]).alias(p) for i, p in enumerate(parts)]
    names = F.lit(list(columns)).alias("column_name")
    folded = df.agg(*common, *lists)
    shared = folded.columns[: len(common)]
    return folded.select(*shared, F.inline(F.arrays_zip(names, *parts)))


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in without]


def target_profile(df: DataFrame, target: str = "target") -> DataFrame:
    """Rows, positives, their rate, and negatives per positive."""
    hit = F.col(target)
    counted = df.agg(
        F.count(hit).alias("n"),
        F.count_if(hit).alias("n_positive"),
        F.count_if(~hit).alias("n_negative"),
    )
    return counted.select(
        "n",
        "n_positive",
        F.try_divide("n_positive", "n").alias("positive_rate"),
        F.try_divide("n_negative", "n_positive").alias("negatives_per_positive"),
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Nulls per column: count, share, and whether the column is complete or all null."""
    filled = {c: [F.count(quote(c))] for c in df.columns}
    return missing_report(_per_column(df, filled, ["filled"], [F.count(F.lit(1)).alias("n")]))


def missing_report(counted: DataFrame) -> DataFrame:
    """The profile from column_name, n and filled of every column."""
    missing = F.col("n") - F.col("filled")
    return counted.select(
        "column_name",
        missing.alias("n_missing"),
        F.try_divide(missing, "n").alias("missing_share"),
        (missing == 0).alias("is_complete"),
        ((F.col("filled") == 0) & (F.col("n") > 0)).alias("is_all_null"),
    )


def top_missing(df: DataFrame, n: int = 15) -> DataFrame:
    return missing_profile(df).orderBy(F.desc("missing_share"), "column_name").limit(n)


def _double(column: str) -> Column:
    return F.col(quote(column)).cast("double")


def _quantile(quantiles: Mapping[tuple[str, float], float | None], prob: float, columns: Sequence[str]) -> Column:
    """The quantile of the row's `column_name`: a short list, looked up by position."""
    values = F.array(*[F.lit(quantiles[c, prob]).cast("double") for c in columns])
    return F.get(values, F.array_position(F.lit(list(columns)), F.col("column_name")).cast("int") - 1)


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, exact median, smallest and largest value of each column."""
    quantiles = exact_quantiles(df, columns, [0.5])
    folds = {c: [F.avg(_double(c)), F.min(_double(c)), F.max(_double(c))] for c in columns}
    rows = _per_column(df, folds, ["mean", "min", "max"])
    return rows.select("column_name", "mean", _quantile(quantiles, 0.5, columns).alias("median"), "min", "max")


def outlier_profile(df: DataFrame, columns: Sequence[str], tail: float = 0.999) -> DataFrame:
    """The tail quantile, the largest value, and how many medians that is."""
    quantiles = exact_quantiles(df, columns, [0.5, tail])
    rows = _per_column(df, {c: [F.max(_double(c))] for c in columns}, ["max"])
    return rows.select(
        "column_name",
        _quantile(quantiles, tail, columns).alias("tail_value"),
        "max",
        F.try_divide("max", _quantile(quantiles, 0.5, columns)).alias("max_to_median"),
    )


def rate_by_segment(
    df: DataFrame, segments: Sequence[str], target: str = "target", small_n: int = 100
) -> DataFrame:
    """Rows and target rate per value of each segment column; small groups are flagged."""
    cells = F.array(
        *[
            F.struct(F.lit(s).alias("segment"), F.col(quote(s)).cast("string").alias("value"))
            for s in segments
        ]
    )
    hit = F.col(target)
    return (
        df.select(hit, F.inline(cells))
        .groupBy("segment", "value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(hit).alias("n_positive"),
            F.try_divide(F.count_if(hit), F.count(hit)).alias("positive_rate"),
        )
        .withColumn("is_small", F.col("n") < small_n)
    )


def target_correlation(
    df: DataFrame, columns: Sequence[str], target: str = "target", top: int | None = None
) -> DataFrame:
    """Pearson correlation of each column with the target, strongest first; the first `top`."""
    y = F.col(target).cast("int").cast("double")
    folds = {}
    for c in columns:
        paired_x, paired_y = F.when(y.isNotNull(), _double(c)), F.when(_double(c).isNotNull(), y)
        folds[c] = [F.covar_pop(_double(c), y), F.stddev_pop(paired_x), F.stddev_pop(paired_y)]
    rows = _per_column(df, folds, ["joint", "spread", "target_spread"])
    # Null, not an error as from `corr`, where a column or the target is constant.
    correlation = F.try_divide(F.col("joint"), F.col("spread") * F.col("target_spread"))
    rows = rows.select("column_name", correlation.alias("correlation"))
    ranked = rows.orderBy(F.abs("correlation").desc_nulls_last(), "column_name")
    return ranked if top is None else ranked.limit(top)


def histogram_by_target(df: DataFrame, column: str, width: float, target: str = "target") -> DataFrame:
    """Rows per fixed-width bin and target value; null values form no bin."""
    start = F.floor(F.col(column) / F.lit(float(width))) * F.lit(float(width))
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(start.alias("bin_start"), F.col(target))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def history_coverage(abt: DataFrame, flag: str = "has_bureau_history") -> DataFrame:
    return abt.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(flag)).alias("n_with_history"),
        F.avg(F.col(flag).cast("int")).alias("coverage"),
    )


def sentinel_audit(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows hit by each sentinel rule of the table, read off the raw columns."""
    renames: Mapping[str, str] = spec.renames
    raw_name = {renames.get(c, c): c for c in raw.columns}
    hits = {
        f.name: F.trim(F.col(quote(f.name))) == spec.text_sentinel
        for f in raw.schema
        if isinstance(f.dataType, T.StringType)
    } | {
        raw_name[s.column]: F.col(quote(raw_name[s.column])) == F.lit(s.value)
        for s in spec.sentinels
        if s.column in raw_name
    }
    folds = {renames.get(c, c): [F.count_if(hit)] for c, hit in hits.items()}
    rows = _per_column(raw, folds, ["n_sentinel"], [F.count(F.lit(1)).alias("n")])
    share = F.try_divide("n_sentinel", "n").alias("sentinel_share")
    return rows.select("column_name", "n_sentinel", share)
