import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.operators import profile, sampling
from loanloom.operators.quantiles import exact_quantiles
from loanloom.specs import APPLICATION


@pytest.fixture(scope="module")
def numbers(spark):
    """A third of `tied` is one value; `gap` is mostly null."""
    df = spark.range(0, 3000, 1, 4)
    return df.select(
        "id",
        F.rand(1).alias("even"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.hash("id") % 1000).cast("double")).alias("tied"),
        F.when(F.col("id") % 500 == 0, F.col("id").cast("double")).alias("gap"),
        F.lit(None).cast("double").alias("void"),
        F.when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("nans"),
        F.exp(F.rand(2) * 40).alias("wide"),
    ).cache()


@pytest.mark.parametrize("inside_rows", [1, 20, 10**6])
def test_quantiles_against_numpy(numbers, inside_rows):
    columns = ["even", "tied", "gap", "void", "nans", "wide"]
    probs = [0.0, 0.333, 0.5, 0.999, 1.0]
    got = exact_quantiles(numbers, columns, probs, inside_rows)
    rows = numbers.toPandas()
    for c in columns:
        values = rows[c].dropna().astype(float)
        for p in probs:
            expected = np.quantile(values, p) if len(values) else None
            assert got[c, p] == (expected if expected is None else pytest.approx(expected, rel=1e-12)), (c, p)


def test_missing_profile(numbers):
    got = {r["column_name"]: r for r in profile.missing_profile(numbers).collect()}
    assert got["void"]["is_all_null"] and got["void"]["missing_share"] == 1
    assert got["id"]["is_complete"] and got["id"]["n_missing"] == 0
    assert got["gap"]["n_missing"] == 2994 and not got["gap"]["is_all_null"]


def test_profiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "target boolean, x double")
    assert profile.missing_profile(df).filter("is_all_null").count() == 0
    assert profile.target_profile(df).first()["positive_rate"] is None
    assert profile.numeric_summary(df, ["x"]).first()["median"] is None


def test_rate_by_segment(spark):
    df = spark.createDataFrame([(True, "a", True), (False, "a", None), (False, None, True)], "target boolean, s string, t boolean")
    got = {(r["segment"], r["value"]): (r["n"], r["positive_rate"], r["is_small"]) for r in profile.rate_by_segment(df, ["s", "t"], small_n=2).collect()}
    assert got == {
        ("s", "a"): (2, 0.5, False), ("s", None): (1, 0.0, True),
        ("t", "true"): (2, 0.5, False), ("t", None): (1, 0.0, True),
    }


def test_correlation_is_ranked_by_strength(spark):
    df = spark.createDataFrame([(True, 1.0, 5.0, 1.0), (False, 2.0, 5.0, 0.9), (True, 0.5, 5.0, 0.2)], "target boolean, down double, flat double, weak double")
    got = [(r["column_name"], r["correlation"]) for r in profile.target_correlation(df, ["weak", "flat", "down"]).collect()]
    assert [n for n, _ in got] == ["down", "weak", "flat"]
    assert dict(got)["flat"] is None
    assert dict(got)["down"] == pytest.approx(np.corrcoef([1, 0, 1], [1, 2, 0.5])[0, 1])


def test_sentinel_audit(spark):
    df = spark.createDataFrame([("XNA", 365243), (" XNA", 1), (None, None)], "CODE_GENDER string, DAYS_EMPLOYED int")
    got = {r["column_name"]: r["n_sentinel"] for r in profile.sentinel_audit(df, APPLICATION).collect()}
    assert got == {"gender": 2, "days_employed": 1}


@pytest.mark.parametrize("n", [1, 10, 999, 3000])
def test_sample_takes_the_smallest_digests(numbers, n):
    import hashlib

    got = {r["id"] for r in sampling.sample_n(numbers.select("id"), "id", n).collect()}
    ranked = sorted(range(3000), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert got == set(ranked[:n])


def test_sample_of_more_than_all_is_all(numbers):
    assert sampling.sample_n(numbers, "id", 5000).count() == 3000
    assert sampling.sample_n(numbers, "id", 0).count() == 0


def test_digest_search_of_all_classes_at_once(spark, numbers):
    """Crowded cells (equal leading digits) and several classes, null among them."""
    digest = F.concat(F.when(F.col("id") % 2 == 0, "0000000").otherwise("f"), F.md5(F.col("id").cast("string")))
    label = F.when(F.col("id") % 3 > 0, F.col("id") % 3)
    digests = numbers.select(label.alias("class"), digest.alias("digest"))
    ordered = {}
    for r in digests.collect():
        ordered.setdefault(r["class"], []).append(r["digest"])
    for n in (1, 400, 1000):
        quotas = spark.createDataFrame([(c, n) for c in ordered], "class long, quota long")
        got = {r["class"]: r["last"] for r in sampling.last_digests(digests, quotas).collect()}
        assert got == {c: sorted(d)[n - 1] for c, d in ordered.items()}


def test_split_depends_on_the_key_alone(numbers):
    a = sampling.split(numbers, "id").select("id", "split")
    b = sampling.split(numbers.select("id").repartition(7), "id")
    assert a.exceptAll(b).count() == 0
    assert "Exchange" not in sampling.split(numbers.select("id"), "id")._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert 0.77 < a.filter("split = 'train'").count() / 3000 < 0.83


def test_class_quotas_add_up(spark):
    def quotas(counts, n):
        df = spark.createDataFrame(list(counts.items()), "class string, n long")
        return {r["class"]: r["quota"] for r in sampling.class_quotas(df, lambda total: F.lit(n)).collect()}

    assert quotas({"true": 24825, "false": 282686}, 246008) == {"true": 19860, "false": 226148}
    assert quotas({"a": 3, "b": 3, "c": 1}, 5) == {"a": 2, "b": 2, "c": 1}


def test_stratified_sample(numbers):
    df = numbers.select("id", (F.col("id") % 10 == 0).alias("y"))
    counts = {r["y"]: r["count"] for r in sampling.stratified_sample(df, "id", "y", 100).groupBy("y").count().collect()}
    assert counts == {True: 10, False: 90}
    assert sampling.stratified_sample(df, "id", "y", 10**6).count() == 3000
    assert sampling.stratified_sample(df, "id", "y", 0).count() == 0 and sampling.stratified_sample(df.limit(0), "id", "y", 5).count() == 0
    # any number of classes, here one for each row or two
    many = numbers.select("id", F.floor(F.col("id") / 2).alias("y"))
    assert sampling.stratified_sample(many, "id", "y", 100).count() == 100
    sides = sampling.stratified_split(many, "id", "y").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in sides} == {"train": 2400, "validation": 600}


def test_exact_stratified_split(numbers):
    df = numbers.select("id", (F.col("id") % 10 == 0).alias("y"))
    counts = {(r["y"], r["split"]): r["count"] for r in sampling.stratified_split(df, "id", "y").groupBy("y", "split").count().collect()}
    assert counts == {(True, "train"): 240, (True, "validation"): 60, (False, "train"): 2160, (False, "validation"): 540}
