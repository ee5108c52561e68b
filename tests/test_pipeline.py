import tempfile

import pytest
from pyspark.sql import functions as F

from loanloom.operators import evaluate, gold, model, sampling
from loanloom.plans import pipeline
from loanloom.sources import raw, shared, sinks, views
from loanloom.specs import APPLICATION, BOOK, BUREAU, LINEAGE_COLUMNS, ModelParams

SMALL = ModelParams(trees=3, depth=2, learning_rate=0.3)


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sinks.write_csv(views.raw_app(spark, sf_dir), f"{root}/raw/application_train.csv")
    sinks.write_csv(views.raw_bureau(spark, sf_dir), f"{root}/raw/bureau.csv")
    layout = pipeline.Layout(f"{root}/lake")
    audits = pipeline.to_bronze(spark, f"{root}/raw", layout)
    for table in (APPLICATION, BUREAU):
        pipeline.to_silver(spark, layout, table)
    pipeline.to_gold(spark, layout)
    return layout, audits


@pytest.fixture
def abt(spark, built):
    return spark.read.parquet(built[0].path("gold", "abt"))


def test_layers_keep_every_row(spark, built, abt, sf_dir):
    layout, audits = built
    n = views.raw_app(spark, sf_dir).count()
    assert [a.rows for a in audits] == [n, views.raw_bureau(spark, sf_dir).count()]
    assert [a.null_keys for a in audits] == [0, 0]
    assert spark.read.parquet(layout.path("silver", "application_train")).count() == n
    assert abt.count() == n
    assert not set(LINEAGE_COLUMNS) & set(abt.columns)


def test_reruns_replace(spark, built, abt):
    layout, _ = built
    n = abt.count()
    pipeline.to_gold(spark, layout)
    assert spark.read.parquet(layout.path("gold", "abt")).count() == n


def test_saved_types_give_the_same_book(spark, built):
    layout, _ = built
    types = sinks.read_types(spark, layout.path("gold", "top_types"))
    history = spark.read.parquet(layout.path("silver", "bureau"))
    assert types == gold.top_type_list(history) and 0 < len(types) <= 8
    few = history.filter("credit_type = 'Brand#2'")
    written = spark.read.parquet(layout.path("gold", "bureau_book"))
    assert gold.book(few, types).columns == written.columns


def test_dictionary_file_lists_the_book(spark, built):
    layout, _ = built
    book = spark.read.parquet(layout.path("gold", "bureau_book"))
    listed = spark.read.option("header", True).csv(layout.path("gold", "feature_dictionary"))
    assert {r["feature"] for r in listed.collect()} == set(book.columns) - {"application_id"}


def test_csv_columns_may_come_in_any_order(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(f"{root}/bureau.csv", "w") as f:
        f.write("NEW_COLUMN,DAYS_CREDIT,SK_ID_CURR\nx,-5,7\n,,8\n")
    df = raw.read_csv(spark, f"{root}/bureau.csv", BUREAU)
    assert df.dtypes == [("NEW_COLUMN", "string"), ("DAYS_CREDIT", "int"), ("SK_ID_CURR", "bigint")]
    assert [tuple(r) for r in df.collect()] == [("x", -5, 7), (None, None, 8)]
    assert raw.ingest(spark, BUREAU, root, f"{root}/bronze") == raw.Audit("bureau", 2, 5, 0)


def test_types_of_unknown_columns(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(f"{root}/bureau.csv", "w") as f:
        f.write("NEW,DAYS_CREDIT,OTHER,SK_ID_CURR\n1.5,-5,x,7\n,,,8\n")
    df = raw.read_csv(spark, f"{root}/bureau.csv", BUREAU, infer_unknown=True)
    assert df.dtypes == [("NEW", "double"), ("DAYS_CREDIT", "int"), ("OTHER", "string"), ("SK_ID_CURR", "bigint")]


def test_narrow_base_table(spark, built):
    layout, _ = built
    plain = spark.read.parquet(layout.path("gold", "abt"))
    rows, columns = plain.count(), plain.columns
    narrow = pipeline.to_gold(spark, layout, narrow=True)
    assert narrow.columns == columns and narrow.count() == rows
    assert "double" not in dict(narrow.dtypes).values() and dict(narrow.dtypes)["bureau_credit_count"] == "tinyint"
    pipeline.to_gold(spark, layout)


def test_malformed_values_fail(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(f"{root}/bureau.csv", "w") as f:
        f.write("SK_ID_CURR,DAYS_CREDIT\n1,many\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.read_csv(spark, f"{root}/bureau.csv", BUREAU).collect()
    assert raw.read_csv(spark, f"{root}/bureau.csv", BUREAU, infer=True).dtypes[1] == ("DAYS_CREDIT", "string")


def test_holdout_is_disjoint_and_complete(spark, abt):
    train, validation = pipeline.holdout(abt, shared.fresh_path(spark, "holdout"))
    assert train.columns == validation.columns
    assert train.columns[-1] == model.LABEL and "application_id" not in train.columns
    sizes = {r["split"]: r["count"] for r in sampling.split(abt, "application_id").groupBy("split").count().collect()}
    assert (train.count(), validation.count()) == (sizes["train"], sizes["validation"])


def test_category_index_orders_by_frequency_then_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "k string")
    got = [r["k_index"] for r in model.category_index(df, ["k"]).collect()]
    assert got == [1.0, 0.0, 2.0, 2.0, 3.0] or got == [2.0, 1.0, 0.0, 0.0, 3.0]


def test_any_number_of_categories(spark):
    df = spark.range(12_000).select(F.col("id").cast("string").alias("k")).repartition(5)
    ranked = sorted(str(i) for i in range(12_000))
    indexed = model.category_index(df.select("k", F.col("k").alias("own")), ["own"])
    got = {r["k"]: r["own_index"] for r in indexed.collect()}
    assert got == {k: float(i) for i, k in enumerate(ranked)}


def test_missing_values_are_seen(spark):
    """One value in a thousand is missing, or NaN, and tells the class; bins cannot."""
    rows = spark.range(4000).select(
        (F.col("id") % 500 == 0).cast("int").alias(model.LABEL),
        F.when(F.col("id") % 500 > 0, F.rand(1)).alias("holes"),
        F.when(F.col("id") % 500 == 0, F.lit(float("nan"))).otherwise(F.rand(2)).alias("nans"),
    )
    rows = sinks.write_parquet(rows, shared.fresh_path(spark, "holes"))
    for feature in ("holes", "nans"):
        fitted = model.fit(rows, [feature], SMALL)
        assert fitted.indicators == (feature,)
        scored = model.score(fitted, rows, [model.LABEL])
        assert evaluate.roc_auc(scored, model.SCORE, model.LABEL).first()["auc"] == 1
        assert [r["feature"] for r in model.gain_importance(spark, fitted).collect()] == [feature]


def test_rare_categories_are_one(spark):
    rows = spark.range(500).select((F.col("id") % 2).cast("int").alias(model.LABEL), F.concat(F.lit("c"), F.col("id") % 200).alias("kind"))
    fitted = model.fit(sinks.write_parquet(rows, shared.fresh_path(spark, "kinds")), ["kind"], SMALL)
    assert len(fitted.pipeline.stages[0].labelsArray[0]) == model.CATEGORIES


def test_exact_holdout(spark, abt):
    train, validation = pipeline.holdout(abt, shared.fresh_path(spark, "exact"), stratify="target")
    counts = [r["count"] for side in (train, validation) for r in side.groupBy(model.LABEL).count().orderBy(model.LABEL).collect()]
    n = abt.count()
    assert sum(counts[:2]) == n - -(-n * 20 // 100) and abs(counts[1] / sum(counts[:2]) - counts[3] / sum(counts[2:])) < 0.005


def test_comparison_and_importance(spark, built, abt):
    layout, _ = built
    book_features = [c for c in spark.read.parquet(layout.path("gold", "bureau_book")).columns if c != BOOK.key]
    models = pipeline.Layout(shared.fresh_path(spark, "models"))
    rows = {r["model"]: r for r in pipeline.train_and_compare(models, abt, book_features, SMALL).collect()}
    assert rows["baseline"]["n_features"] == len(abt.columns) - len(book_features) - 3
    assert rows["challenger"]["n_features"] == len(abt.columns) - 2
    assert rows["baseline"]["n_train"] == rows["challenger"]["n_train"]
    assert rows["baseline"]["n_train"] + rows["baseline"]["n_val"] == abt.count()
    assert rows["baseline"]["auc_gain"] == 0
    assert rows["challenger"]["params"]["trees"] == 3
    assert all(0 <= r["auc_train"] <= 1 for r in rows.values())
    curve = spark.read.option("header", True).csv(models.path("models", "challenger_roc"))
    assert curve.columns == ["fpr", "tpr"] and curve.count() > 2
    ranking = pipeline.rank_features(models, "full_abt", abt, SMALL, 1000)
    listed = spark.read.option("header", True).csv(models.path("models", "importance_full_abt"))
    assert listed.columns == ["feature", "gain"] and listed.count() == ranking.count() > 0
    report = spark.read.json(models.path("models", "importance_full_abt_metrics")).first()
    assert 0 <= report["auc_val"] <= 1 and pipeline.rank_features(models, "best", abt, SMALL, 1000, top=2).count() == 2


def test_model_survives_saving_and_finds_the_signal(spark):
    df = spark.range(600).select(
        (F.col("id") % 2).cast("int").alias(model.LABEL),
        F.when(F.col("id") % 2 == 1, F.rand(1)).alias("signal"),
        F.rand(2).alias("noise"),
        F.lit(1.0).alias("flat"),
        F.when(F.col("id") % 3 == 0, "x").alias("kind"),
    )
    df = sinks.write_parquet(df, shared.fresh_path(spark, "toy"))
    fitted = model.fit(df, ["signal", "noise", "flat", "kind"], SMALL)
    ranking = model.gain_importance(spark, fitted).collect()
    assert ranking[0]["feature"] == "signal" and "flat" not in {r["feature"] for r in ranking}
    dictionary = spark.createDataFrame([("signal", "bureau_book")], "feature string, origin string")
    tagged = model.importance_origin(model.gain_importance(spark, fitted), dictionary, top=1).collect()
    assert [(r["feature"], r["origin"], r["share"]) for r in tagged] == [("signal", "bureau_book", 1.0)]
    path = shared.fresh_path(spark, "model")
    fitted.save(path)
    again = model.Fitted.load(spark, path)
    a = model.score(fitted, df, [model.LABEL]).collect()
    assert a == model.score(again, df, [model.LABEL]).collect()
    assert all((r[model.SCORE] > 0.5) == (r[model.LABEL] == 1) for r in a)


def test_shared_dir_is_the_one_the_cluster_names(spark, monkeypatch):
    class Conf:
        def get(self, key, default):
            return "/shared/folder/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert shared.shared_dir(Session()) == "/shared/folder"


def test_features_missing_together_share_an_indicator(spark):
    rows = [(None, None, 1.0, float("nan")), (2.0, 5.0, None, 3.0), (4.0, 1.0, None, 3.0), (4.0, 1.0, 2.0, 3.0), (None, None, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    assert model._told_apart(df, ["a", "b", "c", "d"]) == ["a", "c"]
    # as many missing, in other rows
    other = spark.createDataFrame([(None, 1.0), (2.0, None)], "a double, b double")
    assert model._told_apart(other, ["a", "b"]) == ["a", "b"] and model._told_apart(df, []) == []


def test_indicators_ask_as_many_expressions_as_features(spark, monkeypatch):
    """Every mark of a feature held the hash of all features: the plan of 250 did not fit the driver."""
    asked = []
    kind = type(spark.range(1))
    whole = kind.agg
    monkeypatch.setattr(kind, "agg", lambda self, *columns: asked.append(sum(len(str(c)) for c in columns)) or whole(self, *columns))
    sizes = []
    for n in (10, 40):
        rows = [tuple(float(i) if i != j else None for j in range(n)) for i in range(n)]
        df = spark.createDataFrame(rows, ", ".join(f"c{j} double" for j in range(n)))
        asked.clear()
        assert model._told_apart(df, df.columns) == df.columns
        sizes.append(sum(asked))
    assert sizes[1] < 6 * sizes[0]
