import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.naming import needs_fallback, silver_names
from loanloom.operators import silver
from loanloom.specs import APPLICATION, BUREAU


def empty(spark, spec, without=()):
    fields = [f for f in spec.raw_schema() if f.name not in without]
    return spark.createDataFrame([], T.StructType(fields))


def values(df):
    return [tuple(r) for r in df.collect()]


def test_names():
    raw = ["Bar_x", "Mixed", "foo", "X_MEDI", "_source_file", "TARGET"]
    assert silver_names(["FOO"], {}) == ["foo"]
    assert silver_names(raw, APPLICATION.renames) == [
        "bar_x", "Mixed", "foo", "building_x_medi", "_source_file", "target",
    ]
    assert not needs_fallback("_ingested_at")
    # capitals of any script; digits and signs are none
    assert [needs_fallback(n) for n in ("ÉTÉ", "Été_x", "Été", "été_x", "123", "1_2", "Δ_AVG")] == [True, True, False, False, False, False, True]
    assert silver_names(["ÉTÉ", "Δ_AVG"], {}) == ["été", "building_δ_avg"]


def test_both_spellings_of_one_column_are_refused():
    with pytest.raises(ValueError, match="bureau_credit_id"):
        silver_names(["SK_ID_BUREAU", "SK_BUREAU_ID"], BUREAU.renames)


def test_names_that_differ_only_in_case_are_refused():
    with pytest.raises(ValueError, match="foo"):
        silver_names(["FOO", "foo"], {})


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(1, 2)], "SK_ID_CURR long, `odd.name` int")
    assert silver.application(df).columns == ["application_id", "odd.name"]


def test_raw_widths():
    assert len(APPLICATION.types) == 122
    assert len(APPLICATION.renames) == 80
    assert len(BUREAU.types) == 18
    assert len(APPLICATION.zero_one_flags) == 27


def test_silver_widths(spark):
    lineage = {"_ingested_at": F.current_timestamp(), "_source_file": F.lit("x")}
    app = silver.application(empty(spark, APPLICATION).withColumns(lineage))
    history = silver.bureau(empty(spark, BUREAU, ["SK_BUREAU_ID"]).withColumns(lineage))
    assert len(app.columns) == 130
    assert len(history.columns) == 22
    assert sum(isinstance(f.dataType, T.BooleanType) for f in app.schema) == 29 + 1
    assert sum(c.endswith(("_avg", "_mode", "_medi")) for c in app.columns) == 47


def test_text_sentinel(spark):
    rows = ["XNA", " XNA ", "XNA\t", "xna", " a ", None]
    df = spark.createDataFrame([(r, 1) for r in rows], "s string, n int")
    assert [v for v, _ in values(silver.clean_sentinels(df))] == [None, None, "XNA\t", "xna", " a ", None]


def test_yes_no(spark):
    df = spark.createDataFrame([(v,) for v in ("Y", "N", "y", "", None)], "f string")
    assert values(silver.to_bool(df, yes_no=["f", "absent"])) == [(True,), (False,), (False,), (False,), (None,)]


def test_yes_no_flags_do_not_become_all_null(spark):
    df = spark.createDataFrame([("Y",), ("N",)], "FLAG_OWN_CAR string")
    assert values(silver.application(df)) == [(True,), (False,)]


@pytest.mark.parametrize(
    "kind, given, expected",
    [
        ("int", [1, 0, 2, None], [True, False, False, None]),
        ("double", [1.0, 1.9, 0.0, float("nan"), None], [True, True, False, False, None]),
        ("string", ["1", " 1 ", "1.0", "0", "Y", "", None], [True, True, True, False, None, None, None]),
        ("boolean", [True, False, None], [True, False, None]),
    ],
)
def test_zero_one(spark, kind, given, expected):
    df = spark.createDataFrame([(v,) for v in given], f"f {kind}")
    assert [v for (v,) in values(silver.to_bool(df, zero_one=["f"]))] == expected


def test_employment_sentinel(spark):
    df = spark.createDataFrame([(365243,), (-3652,), (None,)], "DAYS_EMPLOYED int")
    got = silver.application(df).select("is_employment_anomaly", "days_employed", "employment_years")
    first, second, third = values(got)
    assert first == (True, None, None)
    assert second[:2] == (False, -3652) and second[2] == pytest.approx(9.99863, abs=1e-5)
    assert third == (None, None, None)


def test_two_directional_days_keep_their_sign(spark):
    df = spark.createDataFrame([(-5, 7.0, -3.0, None)], "DAYS_CREDIT int, DAYS_CREDIT_ENDDATE double, DAYS_ENDDATE_FACT double, DAYS_CREDIT_UPDATE int")
    row = silver.bureau(df).first()
    assert row["days_to_credit_end"] == 7.0
    assert (row["days_since_credit_started"], row["days_since_credit_closed"], row["days_since_credit_update"]) == (5, 3.0, None)


def test_silver_is_one_narrow_projection(spark):
    plan = silver.application(empty(spark, APPLICATION))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
