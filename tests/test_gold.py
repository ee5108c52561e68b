import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom import catalog
from loanloom.operators import gold, silver
from loanloom.plans.skew import hot_keys
from loanloom.sources import sinks, views
from loanloom.specs import APPLICATION, BOOK, BUREAU, INDICATORS

REAL_TYPES = [
    "Consumer credit",
    "Credit card",
    "Car loan",
    "Mortgage",
    "Microloan",
    "Loan for business development",
    "Another type of loan",
    "Unknown type of loan",
]

FIELDS = "application_id long, credit_status string, credit_type string, days_credit int, credit_amount long, credit_debt_amount long, credit_limit_amount long, credit_overdue_amount long"
ROWS = [
    (1, "Active", "a", -10, 100, 50, 0, 1),
    (1, "Closed", "b", -20, 0, 50, 200, None),
    (1, "Frozen", None, -30, -5, None, 100, 2),
    (1, None, "a", -40, None, 5, None, 3),
    (2, "Closed", "c", -50, 10, 5, 10, 0),
    (None, "Active", "a", -60, 10, 5, 10, 0),
]


@pytest.fixture
def history(spark):
    """Edge rows, the other silver columns null."""
    df = spark.createDataFrame(ROWS, FIELDS)
    rest = {
        "days_overdue": "int", "days_to_credit_end": "int", "days_enddate_fact": "int",
        "max_overdue_amount": "long", "credit_prolongation_count": "int",
        "days_credit_update": "int", "annuity_amount": "long",
    }
    df = df.withColumns({c: F.lit(None).cast(t) for c, t in rest.items()})
    return silver.derive(df, BUREAU.derived)


def by_key(df, key="application_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_book_has_its_248_features_in_order(spark, history):
    book = gold.book(history, REAL_TYPES)
    meta = "credit_count active_count closed_count distinct_credit_types days_since_first_credit days_since_last_credit".split()
    stats = [f"{s}_{c}_{f}" for s in ("all", "active", "closed") for c in INDICATORS for f in ("min", "max", "mean", "sum")]
    categories = [f"status_{s}" for s in ("active", "closed", "sold", "bad_debt")] + [
        f"type_{t.lower().replace(' ', '_')}" for t in [*REAL_TYPES, "other"]
    ]
    parts = [*meta, *stats, *[f"{c}_count" for c in categories], *[f"{c}_share" for c in categories]]
    assert book.columns == ["application_id", *[f"bureau_{p}" for p in parts]]
    assert len(book.columns) == 249
    assert len(gold.zero_filled(book.columns, "application_id")) == 28


def test_base_table_has_377_columns(spark, history):
    schema = T.StructType([f for f in APPLICATION.raw_schema()])
    raw = spark.createDataFrame([], schema).withColumns({"_ingested_at": F.current_timestamp(), "_source_file": F.lit("x")})
    abt = gold.abt(silver.application(raw), gold.book(history, REAL_TYPES))
    assert len(abt.columns) == 377
    assert abt.columns[-1] == "has_bureau_history"


def test_ratios(history):
    got = by_key(gold.ratios(history).filter("application_id = 1"), "days_credit")
    assert got[-10]["debt_to_credit_ratio"] == 0.5 and got[-10]["limit_usage_ratio"] is None
    assert got[-20]["debt_to_credit_ratio"] is None and got[-20]["limit_usage_ratio"] == 0.25
    assert got[-30]["overdue_to_credit_ratio"] is None and got[-30]["limit_usage_ratio"] is None
    assert got[-40]["debt_to_credit_ratio"] is None


def test_meta(history):
    got = by_key(gold.meta(history))
    assert set(got) == {1, 2}
    one = got[1]
    assert one["bureau_credit_count"] == 4
    assert (one["bureau_active_count"], one["bureau_closed_count"]) == (1, 1)
    assert one["bureau_distinct_credit_types"] == 2
    assert (one["bureau_days_since_first_credit"], one["bureau_days_since_last_credit"]) == (40, 10)


def test_top_types_rank_null_then_drop_it(spark):
    rows = [(None,)] * 5 + [("b",)] * 3 + [("a",)] * 3 + [("c",)]
    df = spark.createDataFrame(rows, "credit_type string")
    spec = gold.BookSpec(top_n=3)
    assert gold.top_type_list(df, spec) == ["a", "b"]


def test_categories(history):
    got = by_key(gold.category_profile(history, ["a", "zzz"]))[1]
    assert got["bureau_type_a_count"] == 2 and got["bureau_type_zzz_count"] == 0
    assert got["bureau_type_other_count"] == 2
    assert got["bureau_status_bad_debt_count"] == 0
    assert sum(got[f"bureau_type_{t}_share"] for t in ("a", "zzz", "other")) == 1
    assert sum(got[f"bureau_status_{s}_share"] for s in ("active", "closed", "sold", "bad_debt")) == 0.5


@pytest.mark.parametrize("types", [["Other"], ["a b", "a-b"]])
def test_types_with_one_column_name_are_refused(history, types):
    with pytest.raises(ValueError, match="several columns"):
        gold.type_counts(history, types)


def test_base_table_rules(spark, history):
    apps = spark.createDataFrame([(1, True), (2, False), (3, False), (None, True)], "application_id long, target boolean")
    got = by_key(gold.abt(apps, gold.book(history, ["a"])))
    assert set(got) == {1, 2, 3, None}
    assert got[1]["has_bureau_history"] and got[2]["has_bureau_history"]
    assert not got[3]["has_bureau_history"] and got[None]["has_bureau_history"] is False
    assert got[3]["bureau_credit_count"] == 0 and got[3]["bureau_type_other_count"] == 0
    assert got[3]["bureau_type_other_share"] is None and got[3]["bureau_distinct_credit_types"] is None
    assert got[2]["bureau_active_credit_amount_sum"] is None
    assert got[2]["bureau_active_credit_prolongation_count_sum"] == 0


def brute_force(rows):
    """The statistics of the book by hand, for the columns the edge rows fill."""
    groups = defaultdict(list)
    for r in rows:
        if r["application_id"] is not None:
            groups[r["application_id"]].append(r)
    result = {}
    for key, members in groups.items():
        out = {}
        for segment, status in BOOK.segments.items():
            inside = [m for m in members if status is None or m["credit_status"] == status]
            for c in INDICATORS:
                vs = [m[c] for m in inside if m[c] is not None]
                name = f"bureau_{segment}_{c}_"
                out[name + "min"] = min(vs, default=None)
                out[name + "max"] = max(vs, default=None)
                out[name + "sum"] = sum(vs) if vs else None
                out[name + "mean"] = sum(vs) / len(vs) if vs else None
        out["bureau_credit_count"] = len(members)
        out["bureau_distinct_credit_types"] = len({m["credit_type"] for m in members} - {None})
        result[key] = out
    return result


def same(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12))


@pytest.mark.parametrize("hot_rows", [10**6, 2, 0])
def test_book_against_brute_force_whatever_is_hot(history, hot_rows):
    expected = brute_force([r.asDict() for r in gold.ratios(history).collect()])
    got = by_key(gold.book(history, ["a"], hot_rows=hot_rows))
    assert set(got) == set(expected)
    for key, features in expected.items():
        wrong = {f: (got[key][f], v) for f, v in features.items() if not same(got[key][f], v)}
        assert not wrong


def assert_same_rows(a, b, key="application_id"):
    """Equal values; sums of fractions may differ in the last digits."""
    fractions = [c for c in a.columns if "_ratio_" in c]
    exact = [c for c in a.columns if c not in fractions]
    assert a.select(*exact).exceptAll(b.select(*exact)).count() == 0 and a.count() == b.count()
    other = b.select(key, *[F.col(c).alias(f"_{i}") for i, c in enumerate(fractions)])
    off = F.lit(False)
    for i, c in enumerate(fractions):
        x, y = F.col(c), F.col(f"_{i}")
        close = F.abs(x - y) <= 1e-9 * F.greatest(F.abs(x), F.abs(y), F.lit(1.0))
        off = off | (x.isNull() != y.isNull()) | F.coalesce(~close, F.lit(False))
    assert a.select(key, *fractions).join(other, key).filter(off).count() == 0


def test_one_application_with_a_third_of_all_rows(spark, sf_dir):
    rows = silver.bureau(views.raw_bureau(spark, sf_dir))
    skewed = rows.withColumn(
        "application_id", F.when(F.col("bureau_credit_id") % 3 == 0, F.lit(-1)).otherwise(F.col("application_id"))
    )
    n = skewed.filter("application_id = -1").count()
    assert [r[0] for r in hot_keys(skewed, "application_id", n // 2).collect()] == [-1]
    apps = skewed.select("application_id").distinct()
    split = gold.abt(apps, gold.book(skewed, ["Brand#2"], hot_rows=n // 2))
    assert_same_rows(split, gold.abt(apps, gold.book(skewed, ["Brand#2"])))
    assert split.filter("application_id = -1").first()["bureau_credit_count"] == n


def test_more_than_ten_thousand_hot_keys(spark):
    rows = silver.bureau(views.raw_bureau(spark, "/root/testdata/sf0.001"))
    many = spark.range(12_000).select(F.col("id").alias("application_id")).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    one = rows.limit(1).drop("application_id")
    crowd = many.join(F.broadcast(one)).withColumn("credit_amount", F.col("application_id") + F.col("k")).drop("k")
    assert hot_keys(crowd, "application_id", 1).count() == 12_000
    assert hot_keys(crowd, "application_id", 1, most=100).count() < 100
    split = gold.segment_stats(crowd, "all", hot_rows=1)
    assert_same_rows(split, gold.segment_stats(crowd, "all"))


def test_result_does_not_depend_on_partitioning(spark, sf_dir):
    rows = silver.bureau(views.raw_bureau(spark, sf_dir))
    a = gold.segment_stats(rows, "active")
    b = gold.segment_stats(rows.repartition(5, "credit_type"), "active")
    exact = [c for c in a.columns if "_ratio_" not in c]
    assert a.select(*exact).exceptAll(b.select(*exact)).count() == 0


def test_invariants(spark, sf_dir):
    app = catalog.application(spark, sf_dir)
    abt = gold.abt(app, gold.book(catalog.bureau(spark, sf_dir)))
    rows = sinks.write_parquet(abt, f"{catalog.fresh_path(spark, 'abt')}")
    assert rows.count() == app.count()
    broken = rows.filter(
        "bureau_active_count + bureau_closed_count > bureau_credit_count"
        " or has_bureau_history <> (bureau_credit_count > 0)"
        " or bureau_all_credit_amount_min > bureau_all_credit_amount_mean"
        " or bureau_all_credit_amount_mean > bureau_all_credit_amount_max"
        " or bureau_all_credit_amount_sum < bureau_active_credit_amount_sum"
    )
    assert broken.count() == 0
    shares = [c for c in rows.columns if c.startswith("bureau_type_") and c.endswith("_share")]
    total = sum((F.col(c) for c in shares), F.lit(0.0))
    assert rows.filter("has_bureau_history").filter(F.abs(total - 1) > 1e-12).count() == 0


def test_wide_rows_are_shuffled_once(spark, sf_dir):
    rows = catalog.bureau(spark, sf_dir).select("*")
    plan = gold.segment_stats(rows, "all")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan
    apps = catalog.application(spark, sf_dir)
    abt = gold.abt(apps, gold.book(rows, ["Brand#2"]))._jdf.queryExecution().executedPlan().toString()
    # applications; history rows; the two narrow exchanges of the counts
    assert abt.count("Exchange hashpartitioning") == 4


def test_narrow_numeric(spark):
    df = spark.createDataFrame([(1, 300, None, 2**40, 1.5), (-128, 0, None, 0, 2.5)], "a long, b long, c long, d long, e double")
    narrowed = gold.narrow_numeric(df)
    assert [f.dataType.simpleString() for f in narrowed.schema] == ["tinyint", "smallint", "bigint", "bigint", "float"]
    assert [tuple(r) for r in narrowed.collect()] == [(1, 300, None, 2**40, 1.5), (-128, 0, None, 0, 2.5)]


def test_feature_dictionary(history):
    rows = sinks.feature_dictionary(gold.book(history, REAL_TYPES), "application_id").collect()
    assert len(rows) == 248 and rows[0] == ("bureau_credit_count", "bureau_book")
