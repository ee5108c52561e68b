"""Boosted trees over the base table: inputs, training, scoring, importance, comparison."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.naming import quote
from loanloom.operators.evaluate import roc_auc
from loanloom.sources.shared import ensure_checkpoint_dir, fresh_path
from loanloom.sources.sinks import write_json, write_parquet
from loanloom.specs import LINEAGE_COLUMNS, ModelParams

LABEL = "__y__"
FEATURES = "__features__"
SCORE = "score"
#: Stands for a missing number, below every real one. Bin borders need not lie between, so
#: every feature with missing values also has a 0/1 indicator, shared by those missing in the same rows.
MISSING = -1e15
#: Categories of a text feature that trees tell apart; the rest, unseen ones and null are one
#: more. Bins of every feature.
CATEGORIES, BINS = 60, 64
#: Training rows for a task: trees make many short passes, so small tables use few tasks.
ROWS_PER_TASK = 50_000


def model_input(
    df: DataFrame, key: str = "application_id", target: str = "target", keep: Sequence[str] = ()
) -> DataFrame:
    """The features and the 0/1 label: no key, no lineage, no target. `keep` comes last."""
    features = df.drop(key, target, *LINEAGE_COLUMNS, *keep).columns
    label = F.col(quote(target)).cast("int").alias(LABEL)
    return df.select(*[F.col(quote(c)) for c in features], label, *keep)


def feature_columns(df: DataFrame, without: Sequence[str] = ("application_id", "target", "split", LABEL)) -> list[str]:
    return [c for c in df.columns if c not in (*without, *LINEAGE_COLUMNS)]


def string_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]


def _index_name(column: str) -> str:
    return f"{column}_index"


def _ranks(df: DataFrame, column: str) -> DataFrame:
    """_value and _rank of every category: by falling frequency, ties by name, from 0.

    Numbered where the sorted categories lie, with the counts of the parts before; any
    number of categories.
    """
    counted = df.filter(F.col(quote(column)).isNotNull()).groupBy(F.col(quote(column)).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    placed = counted.orderBy(F.desc("_n"), "_value").withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", 33)
    placed = write_parquet(placed.select("_value", part.alias("_part"), (F.col("_id") - F.shiftleft(part, 33)).alias("_place")), fresh_path(df.sparkSession, "ranks"))
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")  # one row per part
    parts = parts.select("_part", before.alias("_before"))
    return placed.join(parts, "_part").select("_value", (F.col("_before") + F.col("_place")).cast("double").alias("_rank"))


def category_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The category columns replaced by their indexes, null by the number of categories."""
    order = [_index_name(c) if c in columns else c for c in df.columns]
    for c in columns:
        ranks = _ranks(df, c)
        total = ranks.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
        joined = df.join(ranks, F.col(quote(c)) == F.col("_value"), "left")
        df = joined.withColumn(_index_name(c), F.coalesce("_rank", total)).drop("_value", "_rank")
    return df.select(*[F.col(quote(c)) for c in order])


def top_categories(df: DataFrame, column: str, n: int = CATEGORIES) -> list[str]:
    """The `n` most frequent categories."""
    counted = df.filter(F.col(quote(column)).isNotNull()).groupBy(F.col(quote(column)).alias("v")).count()
    return [r["v"] for r in counted.orderBy(F.desc("count"), "v").limit(n).collect()]


def category_indexer(df: DataFrame, columns: Sequence[str]) -> StringIndexerModel:
    """The most frequent categories by rank; all others, null and unseen ones come last."""
    labels = [top_categories(df, c) or [""] for c in columns]
    indexer = StringIndexerModel.from_arrays_of_labels(labels, list(columns), [_index_name(c) for c in columns], handleInvalid="keep")
    return indexer


BUNDLE = "features array<string>, texts array<string>, indicators array<string>, types array<string>, params struct<trees:int,depth:int,learning_rate:double,seed:long>"


@dataclass(frozen=True)
class Fitted:
    """A trained pipeline, the logical features it reads, those of them that have an
    indicator of missing values (one of all that are missing in the same rows), its settings, those that are text, and the types that the
    book of its training rows had columns for."""

    pipeline: PipelineModel
    features: tuple[str, ...]
    params: ModelParams
    indicators: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()
    types: tuple[str, ...] = ()

    def inputs(self) -> list[str]:
        """The feature behind every input of the trees."""
        return [*self.features, *self.indicators]

    def save(self, path: str) -> None:
        """All that scoring needs, in one folder: the trees and what they were trained with."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        row = (*map(list, (self.features, self.texts, self.indicators, self.types)), tuple(asdict(self.params).values()))
        write_json(SparkSession.active().createDataFrame([row], BUNDLE), f"{path}/bundle")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Fitted":
        """What `save` wrote, in any session."""
        r = spark.read.schema(BUNDLE).json(f"{path}/bundle").first()
        trees = PipelineModel.load(f"{path}/pipeline")
        return cls(trees, tuple(r.features), ModelParams(**r.params.asDict()), tuple(r.indicators), tuple(r.texts), tuple(r.types))


def _number(column: str) -> Column:
    """The column as a double; NaN counts as missing."""
    number = F.col(quote(column)).cast("double")
    return F.when(~F.isnan(number), number)


def _missing_name(column: str) -> str:
    return f"{column}__missing"


def _numeric(df: DataFrame, features: Sequence[str], strings: Sequence[str], indicators: Sequence[str]) -> DataFrame:
    """Every feature that is not text as a double without nulls, and the indicators."""
    as_double = {c: F.coalesce(_number(c), F.lit(MISSING)).alias(c) for c in features if c not in strings}
    missing = [_number(c).isNull().cast("double").alias(_missing_name(c)) for c in indicators]
    return df.select(*[as_double.get(c, F.col(quote(c))) for c in df.columns], *missing)


def _with_missing(df: DataFrame, numbers: Sequence[str]) -> list[str]:
    """The features that have missing values; one aggregate."""
    if not numbers:
        return []
    found = df.agg(*[F.bool_or(_number(c).isNull()).alias(f"_{i}") for i, c in enumerate(numbers)]).first()
    return [c for c, some in zip(numbers, found, strict=True) if some]


def _told_apart(df: DataFrame, missing: Sequence[str]) -> list[str]:
    """The first of all features that are missing in the very same rows: the indicators of the others
    would be copies of its own, and of equal splits trees take the first.

    Two aggregates: a count and a hash of the rows name the candidates, which are then held against the first.
    """
    if len(missing) < 2:
        return list(missing)
    # The hash is a column of its own: in every mark it would be as many expressions as pairs of features.
    hashed = df.select("*", F.xxhash64(*[_number(c) for c in missing]).alias("__row__"))
    marks = [F.when(_number(c).isNull(), F.col("__row__")) for c in missing]
    signs = hashed.agg(*[F.struct(F.count(m), F.bit_xor(m)).alias(f"_{i}") for i, m in enumerate(marks)]).first()
    first: dict[tuple, str] = {}
    pairs = [(c, first.setdefault(tuple(sign), c)) for c, sign in zip(missing, signs, strict=True)]
    pairs = [(c, other) for c, other in pairs if c != other]
    if not pairs:
        return list(missing)
    differ = [F.bool_or(_number(c).isNull() != _number(other).isNull()).alias(f"_{i}") for i, (c, other) in enumerate(pairs)]
    copies = {c for (c, _), some in zip(pairs, df.agg(*differ).first(), strict=True) if not some}
    return [c for c in missing if c not in copies]


def fit(
    train: DataFrame, features: Sequence[str], params: ModelParams, label: str = LABEL, types: Sequence[str] = ()
) -> Fitted:
    """Train on `train`; read it from files, as every tree level passes over it.

    `types` are kept with the model, so that scoring builds the same book.
    """
    ensure_checkpoint_dir(train.sparkSession)
    strings = string_columns(train, features)
    indicators = _told_apart(train, _with_missing(train, [c for c in features if c not in strings]))
    rows = _numeric(train.select(*[F.col(quote(c)) for c in features], label), features, strings, indicators)
    rows = rows.repartition(max(1, -(-train.count() // ROWS_PER_TASK)))
    indexers = [category_indexer(rows, strings)] if strings else []
    inputs = [_index_name(c) if c in strings else c for c in features]
    assembler = VectorAssembler(inputCols=[*inputs, *map(_missing_name, indicators)], outputCol=FEATURES)
    trees = GBTClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.learning_rate,
        seed=params.seed,
        maxBins=BINS,
        checkpointInterval=10,
    )
    prepared = PipelineModel(stages=[*indexers, assembler]).transform(rows).select(FEATURES, label)
    # From files of two columns: every pass would else carry the plan of all features along.
    grown = trees.fit(write_parquet(prepared, fresh_path(train.sparkSession, "prepared")))
    pipeline = PipelineModel(stages=[*indexers, assembler, grown])
    return Fitted(pipeline, tuple(features), params, tuple(indicators), tuple(strings), tuple(types))


def score(fitted: Fitted, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """`keep` and the probability of class 1, row by row."""
    strings = fitted.texts
    needed = list(dict.fromkeys([*keep, *fitted.features]))
    kept = df.select(*needed, *[F.col(quote(c)).alias(f"__keep_{i}") for i, c in enumerate(keep)])
    scored = fitted.pipeline.transform(_numeric(kept, fitted.features, strings, fitted.indicators))
    return scored.select(
        *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)],
        vector_to_array("probability")[1].alias(SCORE),
    )


def gain_importance(spark: SparkSession, fitted: Fitted, top: int | None = None) -> DataFrame:
    """Mean gain per split of each feature that some tree splits on, best first; the first
    `top` of them. Splits on whether a feature is missing are splits on the feature.

    Read from the saved trees: the model's own importances are normalised totals.
    """
    path = fresh_path(spark, "trees")
    fitted.pipeline.stages[-1].write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("nodeData.*")
    names = F.array(*[F.lit(c) for c in fitted.inputs()])
    ranking = (
        nodes.filter(F.col("gain") > 0)
        .groupBy(names[F.col("split.featureIndex")].alias("feature"))
        .agg(F.avg("gain").alias("gain"))
        .orderBy(F.desc("gain"), "feature")
    )
    return ranking if top is None else ranking.limit(top)


def importance_origin(ranking: DataFrame, dictionary: DataFrame, top: int = 30) -> DataFrame:
    """The best `top` features with where each comes from, and that origin's share of them."""
    best = ranking.orderBy(F.desc("gain"), "feature").limit(top)
    tagged = best.join(dictionary, "feature", "left").withColumn(
        "origin", F.coalesce("origin", F.lit("application"))
    )
    # At most `top` rows from here on.
    origins = tagged.groupBy("origin").agg(F.count(F.lit(1)).alias("n_features"))
    n = origins.agg(F.sum("n_features").alias("n"))
    shares = origins.select(
        "origin", "n_features", (F.col("n_features") / n.scalar()).alias("share")
    )
    return tagged.join(shares, "origin").select("feature", "gain", "origin", "n_features", "share")


def scores(fitted: Fitted, train: DataFrame, validation: DataFrame, path: str) -> DataFrame:
    """Label, score and side of every row, written to `path`."""
    sides = {"train": train, "validation": validation}
    scored = [
        score(fitted, rows, [LABEL]).withColumn("split", F.lit(side)) for side, rows in sides.items()
    ]
    return write_parquet(scored[0].unionByName(scored[1]), path)


def paired_scores(baseline: Fitted, challenger: Fitted, rows: DataFrame) -> DataFrame:
    """Label and both models' scores of every row, one after the other where the row lies."""
    first = score(baseline, rows, rows.columns).withColumnRenamed(SCORE, "baseline")
    return score(challenger, first, [LABEL, "baseline"]).withColumnRenamed(SCORE, "challenger")


def metrics(name: str, fitted: Fitted, scored: DataFrame) -> DataFrame:
    """One row: AUC on both sides, sizes and settings."""
    by_side = roc_auc(scored, SCORE, LABEL, by=["split"])

    def of(side: str, value: Column) -> Column:
        return F.max(F.when(F.col("split") == side, value))

    rows = F.col("n_positive") + F.col("n_negative")
    settings = asdict(fitted.params)
    return by_side.agg(
        F.lit(name).alias("model"),
        of("train", F.col("auc")).alias("auc_train"),
        of("validation", F.col("auc")).alias("auc_val"),
        F.lit(len(fitted.features)).alias("n_features"),
        of("train", rows).alias("n_train"),
        of("validation", rows).alias("n_val"),
        F.struct(*[F.lit(v).alias(k) for k, v in settings.items()]).alias("params"),
    )


def compare(baseline: DataFrame, challenger: DataFrame) -> DataFrame:
    """Two metrics rows and each one's validation gain over the baseline."""
    reference = baseline.select("auc_val")
    return baseline.unionByName(challenger).withColumn(
        "auc_gain", F.col("auc_val") - reference.scalar()
    )
