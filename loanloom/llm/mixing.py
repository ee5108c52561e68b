"""Mixing sources to target weights by Pareto order sampling.

A source gets a target number of words. Of its rate, target over size, every document has the
whole copies for certain, and the rest as its inclusion probability p for one more.
Documents are ranked by (u / (1 - u)) / (p / (1 - p)), where u is a hash of the row, and
taken in this order until the rest of the target is reached. Sizes are words, so the
sample's fixed size is its number of words; it misses the target by less than one document.

The cut is found without sorting a source: ranks fall into bins, whose sizes are summed in
the tasks first; only the documents of the bin that holds the cut are ordered. Whether a row
is taken then follows from its own rank and its source's cut, so texts are never moved.

Null texts have size 0 and are never taken. A null source is a source, last in the order
of weights. Rows that are equal in id and text share a rank and are taken or left together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.quality import SPACES, SPLIT
from loanloom.llm.session import stored

#: Weights of the sources in order, repeating; share of all words; most copies of a text.
WEIGHTS, SHARE, COPIES = (5, 2, 1), 1.5, 2.0
#: Bins of ranks for each source.
BINS = 4096


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPLIT))).cast("long")


def uniform(*columns: str) -> Column:
    """A number inside (0, 1) that depends on the row alone."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 12).cast("double") + 0.5) / F.lit(float(2**52))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, copies: float = COPIES) -> DataFrame:
    """source, source_size and target, from rows of (source, size).

    Targets stop at `copies` times the source; the excess goes to the others by weight
    until none is above. That is a level with target = min(copies * size, level * weight):
    in the order of copies * size / weight, the sources before some place are full. The two
    orders are over one small row per source, whatever the number of documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.orderBy("_ratio", F.col("source").cast("binary").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    df = by_source.withColumn("_weight", weight).withColumn("_most", copies * F.col("source_size"))
    df = df.withColumn("_ratio", F.col("_most") / F.col("_weight"))
    total = share * F.sum("source_size").over(every)
    full = F.coalesce(F.sum("_most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weights_left = F.sum("_weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    # the level if all before are full and this source is not
    df = df.withColumn("_level", (total - full) / weights_left)
    df = df.withColumn("_fits", F.col("_level") <= F.col("_ratio"))
    df = df.withColumn("_first", F.min(F.when(F.col("_fits"), F.col("_ratio"))).over(every))
    df = df.withColumn("_final", F.max(F.when(F.col("_fits") & (F.col("_ratio") == F.col("_first")), F.col("_level"))).over(every))
    target = F.when(F.col("_ratio") >= F.col("_first"), F.col("_final") * F.col("_weight")).otherwise(F.col("_most"))
    return df.select("source", "source_size", target.alias("target"))


def _rank(p: Column) -> Column:
    """The Pareto rank q = odds(u) / odds(p), as q / (1 + q) in (0, 1); null where p is 0."""
    odds = (F.col("_u") / (1 - F.col("_u"))) / F.when(p > 0, p / (1 - p))
    return odds / (1 + odds)


def _same_source() -> Column:
    return F.col("source").eqNullSafe(F.col("_source"))


def cuts(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """For each source its whole copies, p and the place of its cut.

    `rows` has source, size and _u; `goal` is what `targets` returns. Documents in bins below
    `_bin`, or in it with a rank of at most `_cut`, get one copy more.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = goal.withColumn("_whole", F.floor(rate)).withColumn("_p", rate - F.floor(rate))
    goal = goal.withColumn("_rest", F.col("_p") * F.col("source_size"))
    sources = goal.select(F.col("source").alias("_source"), "source_size", "target", "_whole", "_p", "_rest")
    ranked = rows.join(sources.select("_source", "_p", "_rest"), _same_source()).drop("_source")
    ranked = ranked.withColumn("_q", _rank(F.col("_p"))).withColumn("_bin", F.floor(F.col("_q") * BINS))
    ranked = ranked.filter("_rest > 0 AND size > 0")
    bins = ranked.groupBy("source", "_bin").agg(F.sum("size").alias("_size"), F.first("_rest").alias("_rest"))
    bins = bins.withColumn("_upto", F.sum("_size").over(Window.partitionBy("source").orderBy("_bin")))
    edge = bins.filter("_upto >= _rest AND _upto - _size < _rest")
    edge = edge.select(F.col("source").alias("_source"), F.col("_bin").alias("_edge"), (F.col("_upto") - F.col("_size")).alias("_before"))
    edge = stored(edge, "mix-edges")
    inside = ranked.join(edge, _same_source() & (F.col("_bin") == F.col("_edge")))
    upto = F.col("_before") + F.sum("size").over(Window.partitionBy("source").orderBy("_q"))
    taken = inside.withColumn("_in", upto - F.col("size") / 2 <= F.col("_rest")).filter("_in")
    last = taken.groupBy(F.col("source").alias("_s")).agg(F.max("_q").alias("_cut"))
    found = sources.join(edge.withColumnRenamed("_source", "_e"), F.col("_source").eqNullSafe(F.col("_e")), "left")
    found = found.join(last, F.col("_source").eqNullSafe(F.col("_s")), "left")
    return found.select("_source", "source_size", "target", "_whole", "_p", F.col("_edge").alias("_bin"), "_cut")


def with_copies(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`rows` with source_size, target and `copies`, decided from each row and its source."""
    q = _rank(F.col("_p"))
    extra = (F.floor(q * BINS) < F.col("_bin")) | (q <= F.col("_cut"))
    copies = F.col("_whole") + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0)
    joined = rows.join(found, _same_source(), "left")
    joined = joined.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("int"))
    return joined.drop("_source", "_whole", "_p", "_bin", "_cut", "_u")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken words of every row."""
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), uniform("doc_id", "text").alias("_u"))
    rows = stored(rows, "mix-sizes")
    found = stored(cuts(rows, stored(targets(rows), "mix-targets")), "mix-cuts")
    return with_copies(rows, found).withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of `docs` as often as the mix takes them."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select("source", n_words(F.col("text")).alias("size"), uniform("doc_id", "text").alias("_u"), whole)
    few = stored(rows.drop("_row"), "mix-sizes")
    found = stored(cuts(few, stored(targets(few), "mix-targets")), "mix-cuts")
    counted = with_copies(rows, found).filter("copies > 0")
    return counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
