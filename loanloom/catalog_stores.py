"""Registered queries over what is kept: tables at rest, increments, sketches, loads, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.catalog import (
    SAVED_TYPES,
    STUMP,
    STUMP_FEATURES,
    SUMMARY_COLUMNS,
    _stump,
    application,
    bureau,
    laid_down,
    query,
    rounded,
    rounded_ratios,
    written,
)
from loanloom.operators import distinct, evaluate, gold, heavy, increments, kll, model, sampling
from loanloom.plans import at_rest, pipeline, pruning
from loanloom.sources import loads, raw, sinks, statistics, views
from loanloom.sources.buckets import WIDE_ROWS_PER_BUCKET, bucket_count
from loanloom.sources.shared import fresh_path
from loanloom.specs import APPLICATION, BOOK, BUREAU

# -- increments ------------------------------------------------------------


def _loads(spark, sf):
    """The history as two loads."""
    history = bureau(spark, sf)
    first = F.col("bureau_credit_id") % 10 < 7
    return {"monday": history.filter(first), "tuesday": history.filter(~first)}


def _state(spark, sf) -> increments.BookState:
    parts = _loads(spark, sf)
    buckets = bucket_count(parts["monday"].count(), per=WIDE_ROWS_PER_BUCKET)
    state = increments.create(spark, fresh_path(spark, "book"), SAVED_TYPES, buckets)
    for name, load in [*parts.items(), ("tuesday", parts["tuesday"])]:  # the last delivery comes twice
        state.fold(load, name)
    return state


@query
def book_after_load(spark, sf):
    return rounded_ratios(_state(spark, sf).book())


@query
def type_frequencies_after_load(spark, sf):
    return _state(spark, sf).type_frequencies().select(F.col("value").alias("credit_type"), "n")


@query
def load_log(spark, sf):
    return _state(spark, sf).log().select("load", "rows", "null_keys")


@query
def distinct_types_bitmap(spark, sf):
    history = bureau(spark, sf)
    return distinct.distinct_types(history, distinct.dictionary(history, BOOK.category))


# -- tables at rest --------------------------------------------------------


def _at_rest(spark, sf):
    return laid_down(application(spark, sf), bureau(spark, sf))


@query
def book_at_rest(spark, sf):
    return rounded_ratios(at_rest.book(_at_rest(spark, sf)[1], SAVED_TYPES))


@query
def abt_at_rest(spark, sf):
    apps, history = _at_rest(spark, sf)
    return rounded_ratios(at_rest.abt(apps, at_rest.book(history, SAVED_TYPES)))


# -- frequent categories ---------------------------------------------------


@query
def top_types_sketched(spark, sf):
    """From one stored sketch per load."""
    history = bureau(spark, sf).withColumn("load", F.col("bureau_credit_id") % 4)
    kept = written(heavy.sketches(history, BOOK.category, by="load"), "sketches")
    found = heavy.most_frequent(history, BOOK.category, BOOK.top_n, kept).ranked
    return found.filter("value IS NOT NULL").withColumnRenamed("value", BOOK.category)


@query
def top_open_categories(spark, sf):
    """Thousands of categories of much the same frequency, which a sketch cannot tell apart."""
    return heavy.most_frequent(bureau(spark, sf), "days_credit", 20).ranked


# -- loads -----------------------------------------------------------------


def _delivery(spark, sf, part: int, path: str, shift: int = 0, broken: bool = True) -> None:
    """Stand-in input: every second line as a CSV file, some with an amount that is no number."""
    table = views.raw_bureau(spark, sf).filter(F.col("SK_ID_BUREAU") % 2 == part).withColumn("DAYS_CREDIT", F.col("DAYS_CREDIT") + shift)
    amount = F.col("AMT_CREDIT_SUM").cast("string")
    if broken:
        amount = F.when(F.col("SK_ID_BUREAU") % 97 == 0, "n/a").otherwise(amount)
    sinks.write_csv(table.withColumn("AMT_CREDIT_SUM", amount), path)


def _delivered(spark, sf, again: bool = False) -> tuple[str, list[loads.LoadAudit]]:
    root, audits = fresh_path(spark, "loads"), []
    deliveries = [("monday.csv", 0, 0, True), ("tuesday.csv", 1, 0, True), *([("monday.csv", 0, 1, False)] if again else [])]
    for i, (name, part, shift, broken) in enumerate(deliveries):
        _delivery(spark, sf, part, f"{root}/raw-{i}/{name}", shift, broken)
        audits.append(loads.ingest_load(spark, BUREAU, f"{root}/raw-{i}/{name}", name, f"{root}/bronze"))
    return f"{root}/bronze", audits


@query
def bronze_accepted(spark, sf):
    return loads.accepted(spark, _delivered(spark, sf)[0]).drop("_ingested_at")


@query
def bronze_quarantine(spark, sf):
    return loads.quarantine(spark, _delivered(spark, sf)[0]).drop("_ingested_at")


@query
def load_audit(spark, sf):
    return loads.audit_frame(spark, _delivered(spark, sf, again=True)[1])


@query
def bronze_reload(spark, sf):
    """The first file comes again, mended: its rows and its quarantine are replaced, the other file's are not."""
    root, _ = _delivered(spark, sf, again=True)
    good = loads.accepted(spark, root).select("SK_ID_BUREAU", "DAYS_CREDIT", "AMT_CREDIT_SUM", "_source_file")
    bad = loads.quarantine(spark, root).groupBy("_source_file").agg(F.count(F.lit(1)).alias("n_rejected"))
    return good.join(F.broadcast(bad), "_source_file", "left").fillna(0, ["n_rejected"])  # one row per file


# -- models ----------------------------------------------------------------


@query
def saved_stump_score(spark, sf):
    """Scores of the folder that the one-split model was saved to, read in another session."""
    fitted, rows = _stump(spark, sf)
    path = fresh_path(spark, "model")
    fitted.save(path)
    loaded = model.Fitted.load(spark.newSession(), path)
    return rounded(model.score(loaded, rows, ["application_id", "split"]), [model.SCORE], 9)


ERRORS = ["auc_baseline", "auc_challenger", "auc_gain", "gain_error"]


@query
def paired_auc(spark, sf):
    rows = application(spark, sf).withColumn("target", F.col("target").cast("int"))
    return rounded(evaluate.paired_auc(rows, "total_income", "age_years", "target"), [*ERRORS, "z"], 9)


@query
def stump_paired_gain(spark, sf):
    """The saved one-split models of one and of three features on the validation rows."""
    rows = application(spark, sf).select("application_id", "target", *STUMP_FEATURES)
    layout = pipeline.Layout(fresh_path(spark, "stumps"))
    pipeline.train_and_compare(layout, rows, STUMP_FEATURES[:2], STUMP)
    unseen = sampling.split(rows, "application_id").filter("split = 'validation'").drop("split")
    report = pipeline.paired_comparison(layout, model.model_input(unseen))
    return rounded(report, ERRORS, 9).drop("z")


# -- pruning, footers, quantile sketches ------------------------------------


@query
def abt_pruned(spark, sf):
    """The base table of every tenth application."""
    some = application(spark, sf).filter("application_id % 10 = 3")
    return rounded_ratios(pruning.abt(some, bureau(spark, sf), SAVED_TYPES))


def _written_at(df, name: str) -> str:
    path = fresh_path(df.sparkSession, name)
    sinks.write_parquet(df, path)
    return path


@query
def table_audit_from_footers(spark, sf):
    tables = {APPLICATION.name: views.raw_app(spark, sf), BUREAU.name: views.raw_bureau(spark, sf)}
    paths = {name: _written_at(raw.with_lineage(df, f"{name}.csv"), name) for name, df in tables.items()}
    return raw.audit_frame(spark, [statistics.audit(spark, path, name, "SK_ID_CURR") for name, path in paths.items()])


@query
def missing_profile_from_footers(spark, sf):
    return statistics.missing_profile(spark, _written_at(application(spark, sf), "application"))


@query
def narrow_numeric_from_footers(spark, sf):
    counted = gold.abt(application(spark, sf), gold.meta(bureau(spark, sf)))
    return statistics.narrow_numeric(spark, _written_at(counted.drop(BOOK.key), "abt"))


@query
def quantiles_from_sketches(spark, sf):
    """Quantiles merged from four loads, held against the rows."""
    rows = application(spark, sf)
    loads = rows.withColumn("load", F.col("application_id") % 4)
    kept = written(kll.sketches(loads, SUMMARY_COLUMNS, by="load"), "quantile-sketches")
    return kll.audit(rows, kll.quantiles(kept, (0.001, 0.25, 0.5, 0.75, 0.999)))
