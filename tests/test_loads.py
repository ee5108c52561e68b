"""Quarantine, loads that come again, and models that outlive their session."""

import pytest
from pyspark.sql import functions as F

from loanloom import catalog
from loanloom.operators import gold, model
from loanloom.plans import pipeline
from loanloom.sources import loads
from loanloom.sources.shared import fresh_path
from loanloom.specs import BUREAU, ModelParams

HEADER = "SK_ID_CURR,SK_ID_BUREAU,CREDIT_TYPE,DAYS_CREDIT,NEW"


def delivered(spark, *lines, name="a.csv"):
    path = f"{fresh_path(spark, 'raw')}/{name}"
    spark.createDataFrame([(x,) for x in [HEADER, *lines]], "value string").coalesce(1).write.text(path)
    return path


def rejected(spark, root):
    return sorted(tuple(r)[:2] for r in loads.quarantine(spark, root).collect())


def test_quarantine(spark):
    root = fresh_path(spark, "bronze")
    bad = ["1,3,Car,ten,x", "1,4", "1,5,Car,1,x,more", "x,6,Car,-3,", "1,7,Car,99999999999,x"]
    path = delivered(spark, "1,1,Car,-1,x", *bad, ',2,"a,b",,', ",,,,")
    audit = loads.ingest_load(spark, BUREAU, path, "a.csv", root)
    assert (audit.rows, audit.rejected, audit.null_keys) == (3, 5, 2)
    found = {r.SK_ID_BUREAU: r for r in loads.accepted(spark, root).collect()}
    assert set(found) == {1, 2, None} and (found[2].CREDIT_TYPE, found[2].DAYS_CREDIT, found[1].NEW) == ("a,b", None, "x")
    assert rejected(spark, root) == sorted(("a.csv", b) for b in bad)


def kept_all(spark, root):
    rows = loads.accepted(spark, root).select("SK_ID_BUREAU", "DAYS_CREDIT", "_source_file").collect()
    return sorted(tuple(r) for r in rows)


def test_a_load_replaces_itself_only(spark):
    root = fresh_path(spark, "bronze")

    def ingest(name, *lines):
        loads.ingest_load(spark, BUREAU, delivered(spark, *lines, name=name), name, root)

    ingest("a.csv", "1,1,Car,-1,x", "1,2,Car,x,x")
    ingest("b.csv", "1,3,Car,-1,x", "1,4,Car,x,x")
    assert kept_all(spark, root) == [(1, -1, "a.csv"), (3, -1, "b.csv")] and len(rejected(spark, root)) == 2
    ingest("a.csv", "1,1,Car,-1,x", "1,2,Car,-2,x")  # mended: its quarantine empties
    ingest("a.csv", "1,1,Car,-1,x", "1,2,Car,-2,x")
    assert kept_all(spark, root) == [(1, -1, "a.csv"), (2, -2, "a.csv"), (3, -1, "b.csv")]
    assert rejected(spark, root) == [("b.csv", "1,4,Car,x,x")]
    ingest("b.csv", "1,4,Car,x,x")  # no good row any more
    assert kept_all(spark, root) == [(1, -1, "a.csv"), (2, -2, "a.csv")]
    ingest("a.csv")  # nothing but a header
    assert kept_all(spark, root) == [] and len(rejected(spark, root)) == 1


def test_a_failed_delivery_keeps_the_old_rows(spark, monkeypatch):
    root = fresh_path(spark, "bronze")
    loads.ingest_load(spark, BUREAU, delivered(spark, "1,1,Car,-1,x"), "a.csv", root)
    whole = loads.read_permissive
    fails = F.raise_error(F.lit("lost")).cast("int")
    monkeypatch.setattr(loads, "read_permissive", lambda *a: whole(*a).withColumn("DAYS_CREDIT", fails))
    with pytest.raises(Exception, match="lost"):
        loads.ingest_load(spark, BUREAU, delivered(spark, "1,2,Car,-1,x"), "a.csv", root)
    monkeypatch.undo()
    assert kept_all(spark, root) == [(1, -1, "a.csv")]


def test_only_plain_names(spark):
    for name in ("a/b.csv", "", "..", "a=b"):
        with pytest.raises(ValueError):
            loads.ingest_load(spark, BUREAU, "/nowhere", name, "/nowhere")


def test_good_rows_do_not_open_the_quarantine(spark):
    root = fresh_path(spark, "bronze")
    loads.ingest_load(spark, BUREAU, delivered(spark, "1,1,Car,-1,x", "1,2,Car,x,x"), "a.csv", root)
    plan = loads.accepted(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_rejected" in plan


def test_saved_model_scores_alike(spark, sf_dir):
    """In another session, with missing values, unseen categories and types that were not frequent."""
    app, history = catalog.application(spark, sf_dir), catalog.bureau(spark, sf_dir)
    types = ["Brand#2", "Brand#19"]
    book = gold.book(history, types).select("application_id", "bureau_credit_count", "bureau_type_brand_2_count", "bureau_all_days_credit_min")
    abt = catalog.written(gold.abt(app, book), "abt")
    train = model.model_input(abt)
    features = [*model.feature_columns(app), *[c for c in book.columns if c != "application_id"]]
    fitted = model.fit(train, features, ModelParams(trees=3, depth=3), types=types)
    path = fresh_path(spark, "model")
    fitted.save(path)
    other = spark.newSession()
    loaded = model.Fitted.load(other, path)
    assert (loaded.features, loaded.indicators, loaded.texts, loaded.types, loaded.params) == (
        fitted.features, fitted.indicators, fitted.texts, tuple(types), fitted.params,
    )
    odd = abt.withColumns({"organization_type": F.lit("never seen"), "days_birth": F.lit(None).cast("int"), "total_income": F.lit(float("nan"))})
    for rows in (abt, odd):
        expected = {tuple(r) for r in model.score(fitted, rows, ["application_id"]).collect()}
        assert {tuple(r) for r in model.score(loaded, rows, ["application_id"]).collect()} == expected
    few = history.filter("credit_type = 'Brand#4'")
    scored = pipeline.score_saved(other, path, app, few)
    whole = model.score(fitted, gold.abt(app, gold.book(few, types)), ["application_id"])
    assert {tuple(r) for r in scored.collect()} == {tuple(r) for r in whole.collect()} and scored.count() == app.count()
