"""The book kept up to date load by load, without reading older history again.

A stored state holds, for every entity, buffers that merge: least and largest values, sums,
counts, and a bitmap of its categories. A load is folded to the same buffers and joined to the state by
a union and one more fold; the state lies in buckets by entity, so that only the load's rows move.

Layout under the root: `settings`, one row; `log`, one row per folded load; `buffers-0`, `buffers-1`
and `types-0`, `types-1`, of which the last row of the log names the valid ones. The other side is
written first and becomes valid with the row of the log, so a load that failed half-way has left nothing
behind and is simply folded again, and one that is in the log already is left alone. One
writer at a time; readers of the side before last finish before the load after next.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.naming import quote
from loanloom.operators import distinct, gold
from loanloom.plans.skew import HOT_ROWS, wide_aggregate
from loanloom.sources.buckets import read_buckets, write_buckets
from loanloom.sources.sinks import write_json, write_parquet
from loanloom.specs import BOOK, BookSpec

SETTINGS = "types array<string>, buckets int"
LOG = "version int, load string, rows long, null_keys long, words int"
MERGES = {"min": F.min, "max": F.max, "sum": F.sum, "or": F.bit_or}
_KIND_OF_PART = {"min": "min", "max": "max", "sum": "sum", "n": "sum"}


def _word(w: int) -> str:
    return f"_types_word_{w}"


def _plain_buffers(types: Sequence[str], spec: BookSpec) -> dict[str, tuple[str, Column]]:
    """How buffers merge, and how history rows fold to them, by name."""
    meta = f"{spec.prefix}_{{}}".format
    counts = {meta("credit_count"): F.count(F.lit(1))}
    counts |= {
        meta(f"{segment}_count"): F.count_if(F.col(spec.status) == status)
        for segment, status in spec.segments.items()
        if status is not None
    }
    counts |= gold.status_count_columns(spec) | gold.type_count_columns(types, spec)
    return {
        **{name: ("sum", fold) for name, fold in counts.items()},
        meta("days_since_first_credit"): ("max", F.max(spec.recency)),
        meta("days_since_last_credit"): ("min", F.min(spec.recency)),
    }


def _segment_kinds(spec: BookSpec) -> list[str]:
    """The kinds of `gold.segment_buffers`, in their order."""
    folded = [i for i in spec.indicators if i not in spec.mirrors]
    return [kind for _ in folded for kind in _KIND_OF_PART.values()]


@dataclass(frozen=True)
class BookState:
    spark: SparkSession
    root: str
    types: tuple[str, ...]
    buckets: int
    spec: BookSpec = BOOK

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(f"{self.root}/log")

    def _last(self):
        return self.log().orderBy(F.desc("version")).first()

    def _folds(self, words: int) -> list[Column]:
        """History rows with numbered categories to buffers."""
        plain = [fold.alias(name) for name, (_, fold) in _plain_buffers(self.types, self.spec).items()]
        bits = [distinct.bitmap(w).alias(_word(w)) for w in range(words)]
        segments = [b for s in self.spec.segments for b in gold.segment_buffers(s, self.spec)]
        return [*plain, *bits, *segments]

    def _kinds(self, words: int) -> list[str]:
        plain = [kind for kind, _ in _plain_buffers(self.types, self.spec).values()]
        return [*plain, *["or"] * words, *[k for _ in self.spec.segments for k in _segment_kinds(self.spec)]]

    def _buffers(self, history: DataFrame, types: DataFrame, words: int, hot_rows: int) -> DataFrame:
        """One row per entity of a load, partitioned like the state."""
        spec = self.spec
        needed = dict.fromkeys([*gold.history_columns(spec), spec.category, spec.recency])
        rows = distinct.with_numbers(history.select(*needed), spec.category, types)
        return wide_aggregate(
            rows, spec.key, self._folds(words), lambda part: gold.ratios(part, spec), hot_rows, self.buckets
        )

    def _stored(self, version: int, schema) -> DataFrame:
        return read_buckets(self.spark, f"{self.root}/buffers-{version % 2}", schema, self.spec.key, self.buckets)

    def _schema(self, version: int):
        return self.spark.read.parquet(f"{self.root}/buffers-{version % 2}").schema

    def type_frequencies(self) -> DataFrame:
        """Every category of all loads with its number and its count of rows."""
        last = self._last()
        if last is None:
            return self.spark.createDataFrame([], "value string, number long, n long")
        return self.spark.read.parquet(f"{self.root}/types-{last.version % 2}")

    def fold(self, history: DataFrame, load: str, hot_rows: int = HOT_ROWS) -> bool:
        """Add a load of history rows; False if one of this name is in already."""
        if not self.log().filter(F.col("load") == load).isEmpty():
            return False
        last = self._last()
        version = last.version + 1 if last else 0
        side = version % 2
        known = self.type_frequencies() if last else None
        types = write_parquet(distinct.dictionary(history, self.spec.category, known), f"{self.root}/types-{side}")
        words = distinct.words(types)
        merged = self._buffers(history, types, words, hot_rows)
        if last:
            both = self._stored(last.version, self._schema(last.version)).unionByName(merged, allowMissingColumns=True)
            names = [c for c in merged.columns if c != self.spec.key]
            merges = [MERGES[k](quote(c)).alias(c) for c, k in zip(names, self._kinds(words), strict=True)]
            merged = both.groupBy(self.spec.key).agg(*merges)
        write_buckets(merged, f"{self.root}/buffers-{side}", self.spec.key, self.buckets)
        counts = history.agg(F.count(F.lit(1)), F.count_if(F.col(self.spec.key).isNull())).first()
        row = self.spark.createDataFrame([(version, load, *counts, words)], LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return True

    def book(self) -> DataFrame:
        """`gold.book` of all loads, from the buffers alone; nothing moves."""
        spec, last = self.spec, self._last()
        if last is None:
            raise ValueError("no load has been folded yet")
        stored = self._stored(last.version, self._schema(last.version))
        meta = f"{spec.prefix}_{{}}".format
        plain = [meta("credit_count"), *[meta(f"{s}_count") for s, status in spec.segments.items() if status is not None]]
        counts = list(gold.status_count_columns(spec) | gold.type_count_columns(self.types, spec))
        return stored.select(
            spec.key,
            *plain,
            distinct.bits_set([_word(w) for w in range(last.words)]).alias(meta("distinct_credit_types")),
            meta("days_since_first_credit"),
            meta("days_since_last_credit"),
            *[f for segment in spec.segments for f in gold.segment_features(segment, spec)],
            *counts,
            *gold.share_columns(counts, meta("credit_count")),
        )


def create(spark: SparkSession, root: str, types: Sequence[str], buckets: int, spec: BookSpec = BOOK) -> BookState:
    """An empty state. `types` get columns of their own in the book, as in scoring; the state's
    type frequencies tell whether they are still the most frequent ones."""
    write_json(spark.createDataFrame([(list(types), buckets)], SETTINGS), f"{root}/settings")
    spark.createDataFrame([], LOG).write.mode("overwrite").parquet(f"{root}/log")
    return BookState(spark, root, tuple(types), buckets, spec)


def opened(spark: SparkSession, root: str, spec: BookSpec = BOOK) -> BookState:
    found = spark.read.schema(SETTINGS).json(f"{root}/settings").first()
    return BookState(spark, root, tuple(found.types), found.buckets, spec)
