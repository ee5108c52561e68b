"""Tables at rest, the incremental book, bitmaps and sketches against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_gold import assert_same_rows, by_key, history  # noqa: F401

from loanloom import catalog, catalog_stores
from loanloom.operators import distinct, gold, heavy, increments
from loanloom.plans import at_rest
from loanloom.plans.numbering import numbered
from loanloom.sources import buckets, sinks
from loanloom.sources.shared import fresh_path
from loanloom.specs import BOOK


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- numbers and bitmaps -----------------------------------------------------


def test_numbered(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(7)
    assert [tuple(r) for r in numbered(rows, "v").orderBy("v").collect()] == [(i, i) for i in range(5000)]
    assert numbered(rows.limit(0), "v").count() == 0


@pytest.mark.parametrize("categories", [1, 64, 65, 300])
def test_distinct_types(spark, categories):
    draw = random.Random(categories)
    rows = [(draw.randrange(20), None if draw.random() < 0.1 else f"t{draw.randrange(categories)}") for _ in range(2000)]
    rows += [(77, None), (None, "t0")]
    df = spark.createDataFrame(rows, "application_id long, credit_type string")
    expected = {k: len({t for a, t in rows if a == k and t is not None}) for k, _ in rows if k is not None}
    assert dict(tuple(r) for r in distinct.distinct_types(df, distinct.dictionary(df, "credit_type")).collect()) == expected


def test_dictionary_grows(spark):
    first = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "t string")
    second = spark.createDataFrame([("c",), ("a",), (None,), ("A",)], "t string")
    known = sinks.write_parquet(distinct.dictionary(first, "t"), fresh_path(spark, "dictionary"))
    both = distinct.dictionary(second, "t", known)
    assert {tuple(r) for r in both.collect()} == {("a", 0, 2), ("b", 1, 2), ("A", 2, 1), ("c", 3, 1), (None, None, 2)}
    assert distinct.words(first.limit(0).select(F.lit(None).cast("long").alias("number"))) == 1


def test_bitmaps_need_one_exchange(spark, sf_dir):
    rows = catalog.bureau(spark, sf_dir)
    known = sinks.write_parquet(distinct.dictionary(rows, BOOK.category), fresh_path(spark, "dictionary"))
    plan = plan_of(distinct.distinct_types(rows, known))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("partial_bit_or") == 1


# -- increments ----------------------------------------------------------------


def folded(spark, loads, types, hot_rows=10**6, n=3):
    root = fresh_path(spark, "state")
    state = increments.create(spark, root, types, n)
    for i, load in enumerate(loads):
        assert state.fold(load, f"load {i}", hot_rows)
    return increments.opened(spark, root)


@pytest.mark.parametrize("hot_rows", [10**6, 1])
def test_state_equals_the_book(spark, history, hot_rows):  # noqa: F811
    """Entities in several loads, types and entities that come late, an empty load, rows without a key."""
    many = history.unionByName(history.withColumns({"credit_type": F.concat(F.lit("late "), F.col("credit_amount").cast("string"))}))
    late = history.filter("application_id = 1").withColumn("application_id", F.lit(9).cast("long"))
    wide = spark.range(150).select(F.col("id").cast("string").alias("name")).join(history.filter("application_id = 2").drop("credit_type"))
    wide = wide.withColumnRenamed("name", "credit_type").select(history.columns)
    loads = [history, many.filter("false"), many, late, wide]
    state = folded(spark, loads, ["a"], hot_rows)
    whole = loads[0]
    for load in loads[1:]:
        whole = whole.unionByName(load)
    expected = gold.book(whole, ["a"])
    assert state.book().columns == expected.columns
    assert_same_rows(state.book(), expected)
    assert [tuple(r)[1:4] for r in state.log().orderBy("version").collect()] == [
        (f"load {i}", load.count(), load.filter("application_id IS NULL").count()) for i, load in enumerate(loads)
    ]
    counts = Counter(r.credit_type for r in whole.select("credit_type").collect())
    assert {r.value: r.n for r in state.type_frequencies().collect()} == counts


def test_loads_are_folded_once(spark, history):  # noqa: F811
    state = folded(spark, [history], ["a"])
    before = state.book().collect()
    assert not state.fold(history, "load 0") and state.book().collect() == before
    with pytest.raises(ValueError):
        increments.create(spark, fresh_path(spark, "state"), ["a"], 2).book()


def test_a_failed_load_leaves_nothing(spark, history, monkeypatch):  # noqa: F811
    state = folded(spark, [history], ["a"])
    before = by_key(state.book())

    def lost(*args):
        buckets.write_buckets(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(increments, "write_buckets", lost)
    with pytest.raises(RuntimeError):
        state.fold(history, "load 1")
    monkeypatch.undo()
    assert by_key(state.book()) == before
    assert state.fold(history, "load 1")
    assert {r["bureau_credit_count"] for r in state.book().collect()} == {2 * r["bureau_credit_count"] for r in before.values()}


def test_old_history_is_not_read(spark, sf_dir):
    """The first load's files are emptied before the second one is folded."""
    rows = catalog.bureau(spark, sf_dir)
    first, second = rows.filter("bureau_credit_id % 3 = 0"), rows.filter("bureau_credit_id % 3 <> 0")
    path = fresh_path(spark, "first")
    state = folded(spark, [sinks.write_parquet(first, path)], ["Brand#2"])
    first.limit(0).write.mode("overwrite").parquet(path)
    state.fold(second, "second")
    assert_same_rows(state.book(), gold.book(rows, ["Brand#2"]))


def test_the_state_does_not_move(spark, sf_dir):
    rows = catalog.bureau(spark, sf_dir)
    state = folded(spark, [rows], ["Brand#2"], n=5)
    types = state.type_frequencies()
    load = state._buffers(rows, types, 1, 10**6)
    both = state._stored(0, state._schema(0)).unionByName(load)
    plan = plan_of(both.groupBy("application_id").agg(F.max("bureau_credit_count")))
    assert plan.count("Exchange hashpartitioning(application_id") == 1 and "Bucketed: true" in plan
    assert "Exchange" not in plan_of(state.book())


# -- tables at rest ------------------------------------------------------------


@pytest.fixture
def no_broadcasts(spark):
    """Joins as those of large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nothing_moves_between_buckets(spark, sf_dir, no_broadcasts):
    root, rows, apps = fresh_path(spark, "rest"), catalog.bureau(spark, sf_dir), catalog.application(spark, sf_dir)
    lines = buckets.write_at_rest(rows, f"{root}/history", BOOK.key, 6, 10**6)
    buckets.write_at_rest(apps, f"{root}/apps", BOOK.key, 6)
    again = buckets.read_at_rest(spark, f"{root}/apps")
    abt = at_rest.abt(again, at_rest.book(lines, ["Brand#2"]))
    # the distinct count included
    assert "Exchange" not in plan_of(abt) and plan_of(abt).count("Bucketed: true") == 3
    assert_same_rows(abt, gold.abt(apps, gold.book(rows, ["Brand#2"])))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("loanloom_")]


def test_hot_and_keyless_rows_lie_beside(spark, sf_dir, no_broadcasts):
    rows = catalog.bureau(spark, sf_dir)
    third = F.when(F.col("bureau_credit_id") % 3 == 0, F.lit(-1)).when(F.col("bureau_credit_id") % 100 != 1, F.col("application_id"))
    rows = rows.withColumn("application_id", third)
    apps = rows.select("application_id").distinct().withColumn("x", F.lit(1))
    root = fresh_path(spark, "rest")
    lines = buckets.write_at_rest(rows, f"{root}/history", BOOK.key, 4, 100)
    assert lines.has_loose and {r[0] for r in lines.loose.select("application_id").distinct().collect()} == {-1, None}
    assert lines.rows().count() == rows.count()
    kept = buckets.write_at_rest(apps, f"{root}/apps", BOOK.key, 4)
    abt = at_rest.abt(kept, at_rest.book(lines, ["Brand#2"]))
    assert_same_rows(abt, gold.abt(apps, gold.book(rows, ["Brand#2"])))
    # hot rows are folded before they move; the buckets stay where they are
    assert plan_of(abt).count("Bucketed: true") == 3


def test_empty_table_at_rest(spark, sf_dir):
    rows = catalog.bureau(spark, sf_dir).limit(0)
    lines = buckets.write_at_rest(rows, fresh_path(spark, "rest"), BOOK.key, None, 10)
    assert lines.buckets == 1 and at_rest.book(lines, ["a"]).count() == 0


def test_number_of_buckets_is_bounded():
    assert [buckets.bucket_count(n) for n in (0, 1, 2_000_001, 10**15)] == [1, 1, 2, buckets.MOST_BUCKETS]


def test_buckets_of_wide_rows_are_smaller(spark, sf_dir, monkeypatch):
    """A bucket's wide rows are sorted by one task; those of 2 million lines would spill."""
    assert buckets.bucket_count(600_000, per=buckets.WIDE_ROWS_PER_BUCKET) == 6
    monkeypatch.setattr(catalog, "WIDE_ROWS_PER_BUCKET", 1000)
    lines = catalog.bureau(spark, sf_dir)
    assert catalog_stores._at_rest(spark, sf_dir)[1].buckets == -(-lines.count() // 1000)


def test_buckets_of_the_state_are_smaller(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(catalog_stores, "WIDE_ROWS_PER_BUCKET", 1000)
    first = catalog_stores._loads(spark, sf_dir)["monday"].count()
    assert catalog_stores._state(spark, sf_dir).buckets == -(-first // 1000)


def test_narrow_table_moves_its_history_once(spark, sf_dir, no_broadcasts):
    plan = plan_of(catalog.narrow_abt(spark, sf_dir))
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 3


def test_reload_counts_meet_the_rows_where_they_lie(spark, sf_dir, no_broadcasts):
    """All rows of a file would else land in one task."""
    plan = plan_of(catalog_stores.bronze_reload(spark, sf_dir))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_ranking_sample_is_drawn_before_the_join(spark, sf_dir, monkeypatch):
    """The rows are those of a sample of the whole base table."""
    seen = []
    monkeypatch.setattr(catalog, "RANKING_SAMPLE_ROWS", 100)
    monkeypatch.setattr(catalog.pipeline, "rank_features", lambda layout, name, table, *more: seen.append(table))
    catalog._ranking(spark, sf_dir)
    whole = gold.abt(catalog.application(spark, sf_dir), catalog.ranked_book(spark, sf_dir)[0])
    expected = catalog.sampling.sample_n(whole, "application_id", 100)
    assert seen[0].count() == 100 and seen[0].columns == whole.columns
    assert_same_rows(seen[0], expected)


# -- frequent categories ---------------------------------------------------------


def frequent(values, top):
    counted = sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
    return counted[:top]


@pytest.mark.parametrize("kind", ["few", "skewed", "flat", "ties", "empty", "nulls"])
def test_most_frequent(spark, kind):
    draw = random.Random(kind)
    many = [f"c{draw.randrange(20_000):05d}" for _ in range(30_000)]
    values = {
        "few": draw.choices(["a", "b", None, "c"], [5, 3, 4, 1], k=1000),
        "skewed": many + [f"hot{i}" for i in range(10) for _ in range(2_000 - 10 * i)] + [None] * 1_950,
        "flat": many,
        "ties": many + [f"hot{i}" for i in range(12) for _ in range(1_000)],
        "empty": [],
        "nulls": [None] * 5,
    }[kind]
    df = spark.createDataFrame([(v, i % 5) for i, v in enumerate(values)], "`my type` string, load int").repartition(6)
    kept = sinks.write_parquet(heavy.sketches(df, "my type", by="load"), fresh_path(spark, "sketches"))
    for stored in (None, kept):
        found = heavy.most_frequent(df, "my type", 9, stored)
        assert [tuple(r) for r in found.ranked.collect()] == frequent(values, 9)
        assert found.proven == (kind != "flat")
