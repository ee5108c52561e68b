"""Pruned history, statistics from footers, merged quantiles and paired AUCs against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F
from test_gold import assert_same_rows
from test_stores import plan_of

from loanloom import catalog
from loanloom.operators import evaluate, gold, kll, profile
from loanloom.plans import pruning
from loanloom.sources import raw, sinks, statistics
from loanloom.sources.shared import fresh_path

# -- pruning -------------------------------------------------------------------


@pytest.mark.parametrize("most", [64, 1 << 10, 1 << 27])
def test_no_asked_row_is_lost(spark, most):
    history = spark.range(20_000).select(F.when(F.col("id") % 50 != 0, F.col("id") % 5000).alias("k"), "id")
    asked = spark.range(0, 10_000, 25).select(F.when(F.col("id") != 50, F.col("id")).alias("k"))
    left = pruning.only_asked_for(history, asked, "k", most)
    wanted = history.join(asked.filter("k IS NOT NULL").distinct(), "k", "left_semi")
    assert wanted.exceptAll(left).count() == 0 and left.exceptAll(history).count() == 0
    n = left.count()
    # a full bitmap lets all pass; a large one nearly none that were not asked for
    assert (n == 20_000) if most == 64 else n >= wanted.count()
    if most == 1 << 27:
        assert n < wanted.count() + 20_000 / 20


def test_size_of_the_bitmap_is_bounded():
    assert [pruning.bitmap_bits(n) for n in (0, 1, 2, 1000, 10**12)] == [64, 64, 64, 1 << 15, pruning.MOST_BITS]


def test_only_asked_history_moves(spark, sf_dir):
    apps, history = catalog.application(spark, sf_dir), catalog.bureau(spark, sf_dir)
    some = apps.filter("application_id % 10 = 3")
    abt = pruning.abt(some, history, ["Brand#2"])
    assert_same_rows(abt, gold.abt(some, gold.book(history, ["Brand#2"])))
    kept = pruning.only_asked_for(history, some, "application_id")
    assert kept.count() < 0.2 * history.count()
    plan = plan_of(kept.repartition("application_id"))
    exchange, test = plan.index("Exchange hashpartitioning(application_id"), plan.index("BroadcastHashJoin")
    assert exchange < test  # printed from the top: rows are tested before they move
    assert pruning.abt(some.limit(0), history, ["Brand#2"]).count() == 0


# -- footers -------------------------------------------------------------------


def test_footers(spark):
    rows = [(i, -i * 2**33, None, None if i % 3 else f"t{i}", i / 7, i % 2 == 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "`k.x` int, big long, none long, t string, d double, b boolean").repartition(5)
    path = fresh_path(spark, "footers")
    table = sinks.write_parquet(df, path)
    assert statistics.audit(spark, path, "a", "t") == raw.Audit("a", 1000, 6, 666)
    assert sorted(statistics.missing_profile(spark, path).collect()) == sorted(profile.missing_profile(table).collect())
    assert statistics.ranges(spark, path) == {"k.x": (0, 999), "big": (-999 * 2**33, 0), "none": (None, None)}
    narrow, expected = statistics.narrow_numeric(spark, path), gold.narrow_numeric(table)
    assert narrow.schema == expected.schema and narrow.exceptAll(expected).count() == 0
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_files_without_a_value(spark):
    path = fresh_path(spark, "footers")
    for value in (None, 5, 300):
        spark.range(10).select("id", F.lit(value).cast("long").alias("v")).coalesce(1).write.mode("append").parquet(path)
    assert statistics.ranges(spark, path) == {"id": (0, 9), "v": (5, 300)}


def test_no_row_is_read(spark):
    path = fresh_path(spark, "footers")
    spark.range(100).write.parquet(path)
    plan = plan_of(statistics.footer_aggregate(spark, path, [F.count(F.lit(1)), F.min("id"), F.max("id")]))
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan
    empty = fresh_path(spark, "footers")
    spark.range(0).write.parquet(empty)
    assert statistics.ranges(spark, empty) == {"id": (None, None)}
    assert statistics.audit(spark, empty, "e", "id") == raw.Audit("e", 0, 1, 0)
    assert statistics.missing_profile(spark, empty).first().n_missing == 0


# -- quantiles -----------------------------------------------------------------


def test_merged_quantiles(spark):
    draw = random.Random(3)
    values = [draw.choice([None, float("nan"), draw.gauss(0, 1), 1.0]) for _ in range(20_000)]
    df = spark.createDataFrame([(v, 7, i % 5) for i, v in enumerate(values)], "`x.y` double, c int, load int")
    df = df.withColumn("none", F.lit(None).cast("double"))
    kept = sinks.write_parquet(kll.sketches(df, ["x.y", "c", "none"], by="load", k=400), fresh_path(spark, "sketches"))
    assert kept.select("load").distinct().count() == 5
    answers = kll.quantiles(kept, [0.0, 0.1, 0.5, 0.9, 1.0], k=400)
    real = sorted(v for v in values if v is not None and not math.isnan(v))
    error = kll.rank_error(400)
    assert 0.009 < error < 0.012
    for r in answers.collect():
        assert r.n == (len(real) if r.column_name == "x.y" else 20_000)
        if r.column_name == "c":
            assert r.value == 7
        else:
            low, high = max(0, math.floor((r.prob - error) * r.n)), min(r.n - 1, math.ceil((r.prob + error) * r.n))
            assert real[low] <= r.value <= real[high]
    audited = kll.audit(df, answers, 400).collect()
    assert len(audited) == 10 and all(r.within for r in audited)
    off = answers.withColumn("value", F.col("value") + 0.5)
    assert not any(r.within for r in kll.audit(df, off, 400).filter("column_name = 'c'").collect() if 0 < r.prob < 1)
    assert kll.quantiles(kll.sketches(df.limit(0), ["c"]), [0.5]).count() == 0


# -- paired AUCs ---------------------------------------------------------------


def brute_pairs(rows):
    """AUCs and the variance of their difference from all pairs of a positive and a negative."""
    rows = [r for r in rows if None not in r and not any(math.isnan(x) for x in r)]
    pos, neg = [r for r in rows if r[2] == 1], [r for r in rows if r[2] == 0]

    def wins(p, n, s):
        return 1.0 if p[s] > n[s] else 0.5 if p[s] == n[s] else 0.0

    of_pos = [[sum(wins(p, n, s) for n in neg) / len(neg) for s in (0, 1)] for p in pos]
    of_neg = [[sum(wins(p, n, s) for p in pos) / len(pos) for s in (0, 1)] for n in neg]
    auc = [sum(v[s] for v in of_pos) / len(pos) for s in (0, 1)]

    def variance(values):
        gains = [b - a for a, b in values]
        mean = sum(gains) / len(gains)
        return sum((g - mean) ** 2 for g in gains) / (len(gains) - 1) / len(gains)

    return len(pos), len(neg), *auc, auc[1] - auc[0], math.sqrt(variance(of_pos) + variance(of_neg))


def test_paired_auc(spark):
    draw = random.Random(8)
    rows = []
    for _ in range(300):
        y = draw.randrange(2)
        a = round(draw.gauss(y, 2), 1)
        rows.append((a, round(a + draw.gauss(y, 1), 1), y))
    rows += [(0.0, 0.0, k % 2) for k in range(150)]  # a third share one score
    rows += [(None, 1.0, 1), (1.0, None, 0), (1.0, 1.0, None), (float("nan"), 1.0, 1)]
    df = spark.createDataFrame(rows, "base double, more double, y int").repartition(6)
    got = evaluate.paired_auc(df, "base", "more", "y").first()
    expected = brute_pairs(rows)
    assert all(math.isclose(g, e, rel_tol=1e-9) for g, e in zip(got, expected, strict=False))
    assert math.isclose(got.z, expected[4] / expected[5], rel_tol=1e-9)
    alone = evaluate.roc_auc(df.filter("more IS NOT NULL AND base IS NOT NULL AND NOT isnan(base)"), "more", "y").first()
    assert math.isclose(alone.auc, got.auc_challenger)


def test_paired_auc_without_spread(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1), (2.0, 2.0, 0), (3.0, 3.0, 1), (3.0, 3.0, 0)], "a double, b double, y int")
    same = evaluate.paired_auc(df, "a", "b", "y").first()
    assert (same.auc_gain, same.gain_error, same.z) == (0.0, 0.0, None)
    lonely = evaluate.paired_auc(df.filter("a = 1"), "a", "b", "y").first()
    assert (lonely.n_positive, lonely.n_negative, lonely.auc_gain, lonely.gain_error) == (1, 0, None, None)
    none = evaluate.paired_auc(df.limit(0), "a", "b", "y").first()
    assert (none.n_positive, none.auc_baseline, none.z) == (0, None, None)
    with pytest.raises(Exception, match="must be 0 or 1"):
        evaluate.paired_auc(df.withColumn("y", F.lit(2)), "a", "b", "y").collect()
