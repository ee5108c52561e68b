"""The whole chain, layer by layer, with every layer written as Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators import evaluate, gold, model, sampling, silver
from loanloom.sources import raw, sinks
from loanloom.specs import APPLICATION, BOOK, BUREAU, BookSpec, ModelParams, TableSpec


@dataclass(frozen=True)
class Layout:
    """Folders of the layers under one root."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"


def to_bronze(spark: SparkSession, raw_dir: str, layout: Layout) -> list[raw.Audit]:
    return [raw.ingest(spark, t, raw_dir, f"{layout.root}/bronze") for t in (APPLICATION, BUREAU)]


def to_silver(spark: SparkSession, layout: Layout, table: TableSpec) -> DataFrame:
    bronze = spark.read.parquet(layout.path("bronze", table.name))
    return sinks.write_parquet(silver.transform(bronze, table), layout.path("silver", table.name))


def to_gold(
    spark: SparkSession, layout: Layout, types: Sequence[str] | None = None, spec: BookSpec = BOOK, narrow: bool = False
) -> DataFrame:
    """Book, its sidecars and the base table. Without `types` those of the data are used
    and kept for scoring; `narrow` stores the base table in the smallest types."""
    application, history = (
        spark.read.parquet(layout.path("silver", t.name)) for t in (APPLICATION, BUREAU)
    )
    if types is None:
        types = gold.top_type_list(history, spec)
        sinks.write_types(spark, types, layout.path("gold", "top_types"))
    book = sinks.write_parquet(gold.book(history, types, spec), layout.path("gold", "bureau_book"))
    sinks.write_csv(sinks.feature_dictionary(book, spec.key), layout.path("gold", "feature_dictionary"))
    abt = gold.abt(application, book, spec)
    return sinks.write_parquet(gold.narrow_numeric(abt) if narrow else abt, layout.path("gold", "abt"))


def holdout(
    abt: DataFrame, path: str, key: str = "application_id", stratify: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows as datasets with a 0/1 label.

    With `stratify`, every value of that column has its exact share on either side.
    """
    sides = sampling.stratified_split(abt, key, stratify) if stratify else sampling.split(abt, key)
    return sinks.write_holdout(model.model_input(sides, key, keep=["split"]), path)


def train_and_publish(
    layout: Layout,
    name: str,
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    params: ModelParams,
    types: Sequence[str] = (),
) -> DataFrame:
    """Train one model; write it, its scores, its metrics and its validation ROC curve.

    Returns the metrics row. `types` are those of the book that the rows were built with.
    """
    fitted = model.fit(train, features, params, types=types)
    fitted.save(layout.path("models", name))
    scored = model.scores(fitted, train, validation, layout.path("scores", name))
    unseen = scored.filter(F.col("split") == "validation")
    sinks.write_csv(
        evaluate.roc_curve(unseen, model.SCORE, model.LABEL), layout.path("models", f"{name}_roc")
    )
    metrics = model.metrics(name, fitted, scored)
    path = layout.path("models", f"{name}_metrics")
    sinks.write_json(metrics, path)
    return train.sparkSession.read.schema(metrics.schema).json(path)


def train_and_compare(
    layout: Layout, abt: DataFrame, book_features: Sequence[str], params: ModelParams, types: Sequence[str] = ()
) -> DataFrame:
    """Baseline (application columns) against challenger (all columns): same rows, same
    settings. Training is a chain of short passes, so both go on at the same time."""
    train, validation = holdout(abt, layout.path("gold", "holdout"))
    features = model.feature_columns(train)
    own = [c for c in features if c not in {*book_features, BOOK.history_flag}]

    def published(name: str, columns: Sequence[str]) -> DataFrame:
        return train_and_publish(layout, name, train, validation, columns, params, types)

    with ThreadPoolExecutor(2) as pool:
        run = inheritable_thread_target(abt.sparkSession)(published)
        jobs = [pool.submit(run, name, columns) for name, columns in (("baseline", own), ("challenger", features))]
    return model.compare(*[job.result() for job in jobs])


def paired_comparison(layout: Layout, validation: DataFrame) -> DataFrame:
    """The gain of the saved challenger over the saved baseline on the same rows, with its standard error."""
    fitted = [model.Fitted.load(validation.sparkSession, layout.path("models", n)) for n in ("baseline", "challenger")]
    return evaluate.paired_auc(model.paired_scores(*fitted, validation), "baseline", "challenger", model.LABEL)


def score_saved(spark: SparkSession, path: str, application: DataFrame, history: DataFrame, key: str = "application_id") -> DataFrame:
    """Key and score of every application, by a saved model: its own types shape the book, whatever
    types are frequent in `history` now."""
    fitted = model.Fitted.load(spark, path)
    return model.score(fitted, gold.abt(application, gold.book(history, fitted.types)), [key])


def rank_features(
    layout: Layout, name: str, table: DataFrame, params: ModelParams, sample_rows: int | None = None, top: int | None = None
) -> DataFrame:
    """Mean gain per split of the table's features, from a model of its own; written as
    CSV, and beside it the model's metrics as JSON. `sample_rows` trains on a random sample,
    `top` keeps the best features."""
    rows = table if sample_rows is None else sampling.sample_n(table, "application_id", sample_rows)
    train, validation = holdout(rows, layout.path("gold", f"holdout_{name}"))
    fitted = model.fit(train, model.feature_columns(train), params)
    scored = model.scores(fitted, train, validation, layout.path("scores", f"importance_{name}"))
    sinks.write_json(model.metrics(name, fitted, scored), layout.path("models", f"importance_{name}_metrics"))
    ranking = model.gain_importance(table.sparkSession, fitted, top)
    sinks.write_csv(ranking, layout.path("models", f"importance_{name}"))
    return ranking
