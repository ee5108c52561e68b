"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.naming import type_part
from loanloom.operators import evaluate, gold, model, profile, sampling, silver
from loanloom.plans import at_rest, pipeline, pruning
from loanloom.plans.skew import HOT_ROWS
from loanloom.sources import raw, sinks, views
from loanloom.sources.buckets import WIDE_ROWS_PER_BUCKET, AtRest, bucket_count, write_at_rest
from loanloom.sources.shared import fresh_path
from loanloom.specs import (
    APPLICATION,
    BOOK,
    BUREAU,
    ModelParams,
    RANKING_PARAMS,
    RANKING_SAMPLE_ROWS,
)

#: The types that the book of these queries gets columns for: a list saved when a model
#: was trained, as in scoring, so that the columns do not depend on the table size.
#: `top_types` and `type_bucket_profile` find the list in the data.
SAVED_TYPES = (
    "Brand#2",
    "Brand#19",
    "Brand#4",
    "Brand#16",
    "Brand#17",
    "Brand#8",
    "Brand#9",
    "Brand#25",
)
SEGMENT_COLUMNS = ("organization_type", "owns_car", "has_mobile_phone")
SUMMARY_COLUMNS = ("age_years", "employment_years", "total_income")
CATEGORY_COLUMNS = ("credit_status", "credit_type", "credit_currency")
SAMPLE_ROWS = 1000
#: One tree with one split, small enough to be computed in SQL, and its features.
STUMP = ModelParams(trees=1, depth=1)
STUMP_FEATURES = ("owns_car", "has_mobile_phone", "document_2_provided")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


#: Moves exact decimal halves, on which the engines' rounding differs, off the edge.
OFF_EDGE = 1e-11 / 3


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Sums of fractions depend on their order in the last digits; compare fewer."""
    return df.withColumns({c: F.round(F.col(c) + OFF_EDGE, digits) for c in columns})


def rounded_ratios(df: DataFrame) -> DataFrame:
    names = [
        c
        for c in df.columns
        if c.endswith(("_mean", "_sum")) and any(r.name in c for r in BOOK.ratios)
    ]
    return rounded(df, names, 8)


def application(spark: SparkSession, sf: str) -> DataFrame:
    return silver.application(views.raw_app(spark, sf))


def bureau(spark: SparkSession, sf: str) -> DataFrame:
    return silver.bureau(views.raw_bureau(spark, sf))


def renamed_app(spark: SparkSession, sf: str) -> DataFrame:
    return silver.rename(views.raw_app(spark, sf), APPLICATION.renames)


def book(spark: SparkSession, sf: str) -> DataFrame:
    return gold.book(bureau(spark, sf), SAVED_TYPES)


def written(df: DataFrame, name: str) -> DataFrame:
    return sinks.write_parquet(df, fresh_path(df.sparkSession, name))


def laid_down(application: DataFrame, history: DataFrame) -> tuple[AtRest, AtRest]:
    """Both tables in the same buckets."""
    root = fresh_path(history.sparkSession, "rest")
    buckets = bucket_count(history.count(), per=WIDE_ROWS_PER_BUCKET)
    lines = write_at_rest(history, f"{root}/history", BOOK.key, buckets, HOT_ROWS)
    return write_at_rest(application, f"{root}/application", BOOK.key, buckets), lines


# -- sources and sinks -----------------------------------------------------


def _csv_ingest(spark: SparkSession, table: DataFrame, spec, infer_unknown: bool = False) -> DataFrame:
    root = fresh_path(spark, "ingest")
    sinks.write_csv(table, f"{root}/raw/{spec.name}.csv")
    raw.ingest(spark, spec, f"{root}/raw", f"{root}/bronze", infer_unknown)
    return spark.read.parquet(f"{root}/bronze/{spec.name}").drop("_ingested_at")


@query
def bronze_csv_ingest(spark, sf):
    return _csv_ingest(spark, views.raw_app(spark, sf), APPLICATION)


@query
def bronze_csv_ingest_bureau(spark, sf):
    return _csv_ingest(spark, views.raw_bureau(spark, sf), BUREAU)


@query
def bronze_unknown_columns(spark, sf):
    """Columns that the spec does not know get types of their own."""
    table = views.raw_app(spark, sf).withColumns(
        {"NEW_COUNT": F.col("SK_ID_CURR") % 7, "NEW_RATE": F.col("SK_ID_CURR") / 2 + 0.25, "NEW_TEXT": F.concat(F.lit("t"), "SK_ID_CURR")}
    )
    return _csv_ingest(spark, table, APPLICATION, infer_unknown=True)


@query
def table_audit(spark, sf):
    root = fresh_path(spark, "audit")
    tables = {APPLICATION.name: views.raw_app(spark, sf), BUREAU.name: views.raw_bureau(spark, sf)}
    audits = [
        raw.write_audited(raw.with_lineage(df, f"{name}.csv"), f"{root}/{name}", name, "SK_ID_CURR")
        for name, df in tables.items()
    ]
    return raw.audit_frame(spark, audits)


# -- silver ----------------------------------------------------------------


@query
def silver_rename(spark, sf):
    return renamed_app(spark, sf)


@query
def clean_sentinel_strings(spark, sf):
    columns = ["SK_ID_BUREAU", "CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE"]
    return silver.clean_sentinels(views.raw_bureau(spark, sf).select(*columns))


@query
def to_bool_flags(spark, sf):
    columns = ["application_id", "target", "owns_car", "has_mobile_phone", "document_2_provided"]
    flags = renamed_app(spark, sf).select(*columns)
    return silver.to_bool(flags, APPLICATION.yes_no_flags, APPLICATION.zero_one_flags)


@query
def sentinel_flag(spark, sf):
    rows = renamed_app(spark, sf).select("application_id", "days_employed")
    return silver.flag_sentinels(rows, APPLICATION.sentinels)


@query
def days_to_years(spark, sf):
    days = ["days_birth", "days_registration", "days_id_publish", "days_last_phone_change"]
    rows = renamed_app(spark, sf).select("application_id", *days)
    return silver.derive(rows, APPLICATION.derived)


@query
def silver_application(spark, sf):
    return application(spark, sf)


@query
def silver_bureau(spark, sf):
    return bureau(spark, sf)


# -- gold ------------------------------------------------------------------


@query
def ratio_columns(spark, sf):
    return gold.ratios(bureau(spark, sf)).select("bureau_credit_id", *[r.name for r in BOOK.ratios])


@query
def segment_all(spark, sf):
    return rounded_ratios(gold.segment_stats(bureau(spark, sf), "all"))


@query
def segment_active(spark, sf):
    return rounded_ratios(gold.segment_stats(bureau(spark, sf), "active"))


@query
def segment_closed(spark, sf):
    return rounded_ratios(gold.segment_stats(bureau(spark, sf), "closed"))


@query
def bureau_meta(spark, sf):
    return gold.meta(bureau(spark, sf))


@query
def top_types(spark, sf):
    return gold.top_types(bureau(spark, sf))


@query
def status_counts(spark, sf):
    return gold.status_counts(bureau(spark, sf))


@query
def type_bucket_counts(spark, sf):
    return gold.type_counts(bureau(spark, sf), SAVED_TYPES)


def by_rank(df: DataFrame, types: Sequence[str]) -> DataFrame:
    """Columns of types named by the rank of the type; ranks without a type are 0."""
    names = {}
    for i, t in enumerate(types, 1):
        for end in ("count", "share"):
            names[f"{BOOK.prefix}_type_{type_part(t)}_{end}"] = f"{BOOK.prefix}_type_rank_{i}_{end}"
    empty = {"count": F.lit(0).cast("long"), "share": F.lit(0.0)}
    missing = {
        f"{BOOK.prefix}_type_rank_{i}_{end}": empty[end]
        for i in range(len(types) + 1, BOOK.top_n + 1)
        for end in empty
        if f"{BOOK.prefix}_type_other_{end}" in df.columns
    }
    return df.withColumnsRenamed(names).withColumns(missing)


@query
def type_rank_counts(spark, sf):
    history = bureau(spark, sf)
    types = gold.top_type_list(history)
    return by_rank(gold.type_counts(history, types), types)


@query
def type_bucket_profile(spark, sf):
    return gold.type_profile(bureau(spark, sf))


@query
def category_shares(spark, sf):
    return gold.category_profile(bureau(spark, sf), SAVED_TYPES)


@query
def bureau_book(spark, sf):
    return rounded_ratios(book(spark, sf))


@query
def bureau_book_ranked(spark, sf):
    history = bureau(spark, sf)
    types = gold.top_type_list(history)
    return rounded_ratios(by_rank(gold.book(history, types), types))


@query
def feature_dictionary(spark, sf):
    features = book(spark, sf)
    missing = profile.missing_profile(features).withColumnRenamed("column_name", "feature")
    listed = sinks.feature_dictionary(features, BOOK.key)
    return listed.join(missing, "feature").select("feature", "origin", "n_missing")


@query
def abt(spark, sf):
    return rounded_ratios(gold.abt(application(spark, sf), book(spark, sf)))


@query
def abt_ranked(spark, sf):
    history = bureau(spark, sf)
    types = gold.top_type_list(history)
    return rounded_ratios(gold.abt(application(spark, sf), by_rank(gold.book(history, types), types)))


@query
def narrow_abt(spark, sf):
    """The whole base table, key included, in the smallest types. Those of whole numbers depend on the
    data, so longs are long again in the result; fractions stay narrow.

    The table is built twice, for the ranges and for the rows, so its history is moved once, to buckets."""
    needed = dict.fromkeys([*gold.history_columns(BOOK), BOOK.category, BOOK.recency])
    apps, history = laid_down(application(spark, sf), bureau(spark, sf).select(*needed))
    types = gold.top_type_list(history.rows())
    wide = rounded_ratios(at_rest.abt(apps, by_rank(at_rest.book(history, types), types)))
    longs = [f.name for f in wide.schema if f.dataType.simpleString() == "bigint"]
    return gold.narrow_numeric(wide).withColumns({c: F.col(c).cast("long") for c in longs})


@query
def narrow_numeric(spark, sf):
    counted = gold.abt(application(spark, sf), gold.meta(bureau(spark, sf)))
    return gold.narrow_numeric(counted.drop(BOOK.key))


# -- profile ---------------------------------------------------------------


@query
def target_profile(spark, sf):
    return profile.target_profile(application(spark, sf))


@query
def missing_profile(spark, sf):
    return profile.missing_profile(application(spark, sf))


@query
def top_missing(spark, sf):
    return profile.top_missing(application(spark, sf), 15)


@query
def numeric_summary(spark, sf):
    summary = profile.numeric_summary(application(spark, sf), SUMMARY_COLUMNS)
    return rounded(summary, ["mean", "median", "min", "max"])


@query
def outlier_profile(spark, sf):
    report = profile.outlier_profile(application(spark, sf), SUMMARY_COLUMNS)
    return rounded(report, ["tail_value", "max", "max_to_median"])


@query
def default_rate_by_segment(spark, sf):
    return profile.rate_by_segment(application(spark, sf), SEGMENT_COLUMNS)


@query
def target_correlation(spark, sf):
    rows = application(spark, sf)
    columns = profile.numeric_columns(rows, without=["application_id"])
    return rounded(profile.target_correlation(rows, columns), ["correlation"])


@query
def top_correlations(spark, sf):
    rows = application(spark, sf)
    columns = profile.numeric_columns(rows, without=["application_id"])
    return rounded(profile.target_correlation(rows, columns, top=5), ["correlation"])


@query
def histogram_by_target(spark, sf):
    return profile.histogram_by_target(application(spark, sf), "age_years", 0.5)


@query
def history_coverage(spark, sf):
    with_counts = gold.abt(application(spark, sf), gold.meta(bureau(spark, sf)))
    return profile.history_coverage(with_counts)


@query
def sentinel_audit(spark, sf):
    audits = [
        profile.sentinel_audit(table, spec).select(F.lit(spec.name).alias("table_name"), "*")
        for table, spec in ((views.raw_app(spark, sf), APPLICATION), (views.raw_bureau(spark, sf), BUREAU))
    ]
    return audits[0].unionByName(audits[1])


# -- samples and evaluation ------------------------------------------------


@query
def sample_n(spark, sf):
    rows = application(spark, sf).select("application_id", "target", "total_income")
    return sampling.sample_n(rows, "application_id", SAMPLE_ROWS)


@query
def sample_n_stratified(spark, sf):
    rows = application(spark, sf).select("application_id", "target", "total_income")
    return sampling.stratified_sample(rows, "application_id", "target", SAMPLE_ROWS)


@query
def stratified_split(spark, sf):
    return sampling.split(application(spark, sf).select("application_id", "target"), "application_id")


@query
def stratified_split_exact(spark, sf):
    rows = application(spark, sf).select("application_id", "target")
    return sampling.stratified_split(rows, "application_id", "target")


@query
def holdout_datasets(spark, sf):
    sides = pipeline.holdout(application(spark, sf), fresh_path(spark, "holdout"))
    counted = [
        side.groupBy(model.LABEL)
        .agg(F.count(F.lit(1)).alias("n"), F.max("total_income").alias("max_income"))
        .select(F.lit(name).alias("split"), "*")
        for name, side in zip(("train", "validation"), sides)
    ]
    return counted[0].unionByName(counted[1])


@query
def holdout_datasets_exact(spark, sf):
    sides = pipeline.holdout(application(spark, sf), fresh_path(spark, "holdout"), stratify="target")
    counted = [
        side.groupBy(model.LABEL)
        .agg(F.count(F.lit(1)).alias("n"), F.max("total_income").alias("max_income"))
        .select(F.lit(name).alias("split"), "*")
        for name, side in zip(("train", "validation"), sides)
    ]
    return counted[0].unionByName(counted[1])


@query
def category_index(spark, sf):
    rows = bureau(spark, sf).select("application_id", "bureau_credit_id", *CATEGORY_COLUMNS)
    return model.category_index(rows, CATEGORY_COLUMNS)


@query
def model_input(spark, sf):
    return model.model_input(application(spark, sf))


@query
def roc_auc(spark, sf):
    return evaluate.roc_auc(application(spark, sf), "total_income", "target")


@query
def roc_auc_quality(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    return evaluate.roc_auc(documents.join(labels, "doc_id"), "n_chars", "quality")


@query
def roc_curve(spark, sf):
    return evaluate.roc_curve(application(spark, sf), "total_income", "target")


@query
def auc_by_split(spark, sf):
    sides = sampling.split(application(spark, sf), "application_id")
    return evaluate.roc_auc(sides, "total_income", "target", by=["split"])


# -- models ----------------------------------------------------------------


@query
def gbt_score(spark, sf):
    rows = written(sampling.split(application(spark, sf), "application_id"), "application")
    train = rows.filter(F.col("split") == "train")
    features = model.feature_columns(rows)
    labelled = model.model_input(train.drop("split"))
    fitted = model.fit(labelled, features, ModelParams())
    return model.score(fitted, rows, ["application_id", "split"])


def ranked_book(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """The book with the types that are frequent in the data, and these."""
    history = bureau(spark, sf)
    types = gold.top_type_list(history)
    return gold.book(history, types), types


def _ranking(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Importance of every column of the base table, and the book's dictionary.

    The ranking trains on a sample of applications, which their keys decide: it is drawn before
    the join, so that the history of no other application moves. Types are those of all history."""
    features, types = ranked_book(spark, sf)
    asked = sampling.sample_n(application(spark, sf), "application_id", RANKING_SAMPLE_ROWS)
    table = written(pruning.abt(asked, bureau(spark, sf), types), "abt")
    params = RANKING_PARAMS["full_abt"]
    layout = pipeline.Layout(fresh_path(spark, "ranking"))
    ranking = pipeline.rank_features(layout, "full_abt", table, params, RANKING_SAMPLE_ROWS)
    return ranking, sinks.feature_dictionary(features, BOOK.key)


@query
def gain_importance(spark, sf):
    return _ranking(spark, sf)[0]


@query
def importance_origin(spark, sf):
    return model.importance_origin(*_ranking(spark, sf))


@query
def gain_importance_application(spark, sf):
    """The ranking run without the book."""
    params = RANKING_PARAMS["application_only"]
    layout = pipeline.Layout(fresh_path(spark, "ranking"))
    return pipeline.rank_features(layout, "application_only", application(spark, sf), params)


@query
def model_metrics(spark, sf):
    features, types = ranked_book(spark, sf)
    table = written(gold.abt(application(spark, sf), features), "abt")
    names = [c for c in features.columns if c != BOOK.key]
    layout = pipeline.Layout(fresh_path(spark, "models"))
    return pipeline.train_and_compare(layout, table, names, ModelParams(), types)


def _stump_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = application(spark, sf).select("application_id", "target", *STUMP_FEATURES)
    return written(sampling.split(rows, "application_id"), "stump")


def _stump(spark: SparkSession, sf: str) -> tuple[model.Fitted, DataFrame]:
    rows = _stump_rows(spark, sf)
    train = model.model_input(rows.filter(F.col("split") == "train").drop("split"))
    return model.fit(train, STUMP_FEATURES, STUMP), rows


@query
def stump_score(spark, sf):
    fitted, rows = _stump(spark, sf)
    return rounded(model.score(fitted, rows, ["application_id", "split"]), [model.SCORE], 9)


@query
def stump_importance(spark, sf):
    fitted, _ = _stump(spark, sf)
    return rounded(model.gain_importance(spark, fitted, top=20), ["gain"], 12)


@query
def stump_origin(spark, sf):
    fitted, _ = _stump(spark, sf)
    book_side = sinks.feature_dictionary(gold.meta(bureau(spark, sf)), BOOK.key)
    return rounded(model.importance_origin(model.gain_importance(spark, fitted), book_side), ["gain"], 12)


@query
def stump_metrics(spark, sf):
    """The last feature alone against all three."""
    rows = application(spark, sf).select("application_id", "target", *STUMP_FEATURES)
    layout = pipeline.Layout(fresh_path(spark, "stumps"))
    report = pipeline.train_and_compare(layout, rows, STUMP_FEATURES[:2], STUMP)
    settings = [F.col(f"params.{c}").alias(c) for c in ("trees", "depth", "learning_rate", "seed")]
    report = report.select(*[c for c in report.columns if c != "params"], *settings)
    return rounded(report, ["auc_train", "auc_val", "auc_gain"], 9)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """One row per application with the summary of its credit history."""
    return gold.abt(application(spark, sf), gold.book(bureau(spark, sf)))
