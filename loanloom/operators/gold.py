"""Gold: history rows to one feature row per entity, and the analytical base table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions import columns as C
from loanloom.functions.naming import quote, require_distinct, share_name, status_part, text, type_part
from loanloom.plans.skew import HOT_ROWS, wide_aggregate
from loanloom.specs import BOOK, BookSpec, LINEAGE_COLUMNS, STATISTICS


def ratios(history: DataFrame, spec: BookSpec = BOOK) -> DataFrame:
    return history.withColumns(
        {r.name: C.guarded_ratio(F.col(r.numerator), F.col(r.denominator)) for r in spec.ratios}
    )


# -- segment statistics ----------------------------------------------------


# A book has some 400 expressions. Written as SQL text, each is handed to Spark at once.


def _buffer(segment: str, indicator: str, part: str) -> str:
    return quote(f"_{segment}_{indicator}_{part}")


def segment_buffers(segment: str, spec: BookSpec) -> list[Column]:
    status = spec.segments[segment]
    folds = {"min": "min({0})", "max": "max({0})", "sum": "sum({0})", "n": "count({0})"}
    buffers = []
    for name in spec.indicators:
        if name not in spec.mirrors:
            c = quote(name)
            if status is not None:
                c = f"CASE WHEN {quote(spec.status)} = {text(status)} THEN {c} END"
            for part, fold in folds.items():
                buffers.append(F.expr(f"{fold.format(c)} AS {_buffer(segment, name, part)}"))
    return buffers


def segment_features(segment: str, spec: BookSpec) -> list[Column]:
    plain = {"min": "{min}", "max": "{max}", "mean": "try_divide({sum}, {n})", "sum": "{sum}"}
    mirrored = {"min": "-{max}", "max": "-{min}", "mean": "try_divide(-{sum}, {n})", "sum": "-{sum}"}
    features = []
    for name in spec.indicators:
        base = spec.mirrors.get(name, name)
        values = plain if base == name else mirrored
        parts = {p: _buffer(segment, base, p) for p in ("min", "max", "sum", "n")}
        for s in STATISTICS:
            feature = quote(f"{spec.prefix}_{segment}_{name}_{s}")
            features.append(F.expr(f"{values[s].format(**parts)} AS {feature}"))
    return features


def history_columns(spec: BookSpec) -> list[str]:
    """The columns that the statistics need from the history rows, before ratios."""
    own = [i for i in spec.indicators if i not in spec.mirrors and i not in {r.name for r in spec.ratios}]
    parts = [c for r in spec.ratios for c in (r.numerator, r.denominator)]
    return list(dict.fromkeys([spec.key, spec.status, *own, *parts]))


def segment_stats(
    history: DataFrame, segment: str, spec: BookSpec = BOOK, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Min, max, mean and sum of each indicator over the segment's rows, per entity.

    Entities without a row in the segment have no output row.
    """
    status = spec.segments[segment]
    rows = history if status is None else history.filter(F.col(spec.status) == status)
    folded = wide_aggregate(
        rows.select(*history_columns(spec)),
        spec.key,
        segment_buffers(segment, spec),
        prepare=lambda part: ratios(part, spec),
        hot_rows=hot_rows,
    )
    return folded.select(spec.key, *segment_features(segment, spec))


# -- counts ----------------------------------------------------------------


def meta_buffers(spec: BookSpec) -> list[Column]:
    return [
        F.count(F.lit(1)).alias(f"{spec.prefix}_credit_count"),
        *[
            F.count_if(F.col(spec.status) == status).alias(f"{spec.prefix}_{segment}_count")
            for segment, status in spec.segments.items()
            if status is not None
        ],
        F.count_distinct(spec.category).alias(f"{spec.prefix}_distinct_credit_types"),
        F.max(spec.recency).alias(f"{spec.prefix}_days_since_first_credit"),
        F.min(spec.recency).alias(f"{spec.prefix}_days_since_last_credit"),
    ]


def _named(history: DataFrame, spec: BookSpec) -> DataFrame:
    return history.filter(F.col(spec.key).isNotNull())


def meta(history: DataFrame, spec: BookSpec = BOOK) -> DataFrame:
    """Credit counts, distinct types and recency per entity."""
    return _named(history, spec).groupBy(spec.key).agg(*meta_buffers(spec))


def type_frequencies(history: DataFrame, spec: BookSpec = BOOK) -> DataFrame:
    return history.groupBy(spec.category).agg(F.count(F.lit(1)).alias("n"))


def top_types(history: DataFrame, spec: BookSpec = BOOK) -> DataFrame:
    """The most frequent types. Null takes part in the ranking and is dropped after it."""
    ranked = type_frequencies(history, spec).orderBy(F.desc("n"), F.asc(spec.category))
    return ranked.limit(spec.top_n).filter(F.col(spec.category).isNotNull())


def top_type_list(history: DataFrame, spec: BookSpec = BOOK) -> list[str]:
    """At most `top_n` names, on the driver: they become column names."""
    rows = top_types(history, spec).collect()
    return [r[spec.category] for r in sorted(rows, key=lambda r: (-r["n"], r[spec.category]))]


def status_count_columns(spec: BookSpec) -> dict[str, Column]:
    return {
        f"{spec.prefix}_status_{status_part(s)}_count": F.count_if(F.col(spec.status) == s)
        for s in spec.statuses
    }


def type_count_columns(types: Sequence[str], spec: BookSpec) -> dict[str, Column]:
    name = f"{spec.prefix}_type_{{}}_count".format
    require_distinct([name(type_part(t)) for t in [*types, spec.other]])
    bucket = C.type_bucket(F.col(spec.category), types, spec.other)
    return {name(type_part(t)): F.count_if(bucket == t) for t in [*types, spec.other]}


def _counts(history: DataFrame, counts: dict[str, Column], spec: BookSpec) -> DataFrame:
    total = F.count(F.lit(1)).alias("_total")
    return (
        _named(history, spec).groupBy(spec.key).agg(*[c.alias(n) for n, c in counts.items()], total)
    )


def share_columns(names: Sequence[str], total: str) -> list[Column]:
    return [(F.col(n) / F.col(total)).alias(share_name(n)) for n in names]


def status_counts(history: DataFrame, spec: BookSpec = BOOK) -> DataFrame:
    """Rows per known status; other statuses count in the total only."""
    return _counts(history, status_count_columns(spec), spec).drop("_total")


def type_counts(history: DataFrame, types: Sequence[str], spec: BookSpec = BOOK) -> DataFrame:
    """Rows per kept type, the rest and nulls under `other`."""
    return _counts(history, type_count_columns(types, spec), spec).drop("_total")


def type_profile(history: DataFrame, spec: BookSpec = BOOK) -> DataFrame:
    """Rows of each (entity, type bucket) that occurs, one row per pair."""
    types = top_type_list(history, spec)
    bucket = C.type_bucket(F.col(spec.category), types, spec.other).alias("type_bucket")
    return _named(history, spec).groupBy(spec.key, bucket).agg(F.count(F.lit(1)).alias("n"))


def category_profile(history: DataFrame, types: Sequence[str], spec: BookSpec = BOOK) -> DataFrame:
    """All category counts, then the share of each in the entity's rows."""
    counts = status_count_columns(spec) | type_count_columns(types, spec)
    folded = _counts(history, counts, spec)
    return folded.select(spec.key, *counts, *share_columns(list(counts), "_total"))


# -- book and base table ---------------------------------------------------


def book(
    history: DataFrame,
    types: Sequence[str] | None = None,
    spec: BookSpec = BOOK,
    hot_rows: int = HOT_ROWS,
    in_place: bool = False,
) -> DataFrame:
    """All features of every entity with history: one wide aggregation and one narrow.

    `types` are the types that get columns of their own: those of the data at hand
    (found by one small job) or, when scoring, the list the model was trained with.
    With `in_place` the history already lies partitioned by entity.
    """
    if types is None:
        types = top_type_list(history, spec)
    counts = status_count_columns(spec) | type_count_columns(types, spec)
    # Counts need few buffers, so rows are folded before they move; the two exchanges
    # of the distinct count carry little. Both parts end up partitioned by the key.
    counted = (
        _named(history, spec)
        .groupBy(spec.key)
        .agg(*meta_buffers(spec), *[c.alias(n) for n, c in counts.items()])
    )
    folded = wide_aggregate(
        history.select(*history_columns(spec)),
        spec.key,
        [b for segment in spec.segments for b in segment_buffers(segment, spec)],
        prepare=lambda part: ratios(part, spec),
        hot_rows=hot_rows,
        in_place=in_place,
    )
    meta_names = [c for c in counted.columns if c not in (spec.key, *counts)]
    return counted.join(folded, spec.key).select(
        spec.key,
        *meta_names,
        *[f for segment in spec.segments for f in segment_features(segment, spec)],
        *counts,
        *share_columns(list(counts), f"{spec.prefix}_credit_count"),
    )


def zero_filled(book_columns: Sequence[str], key: str) -> list[str]:
    """Book columns that are 0 for entities without history: every `_count` in a name."""
    return [c for c in book_columns if c != key and "_count" in c]


def abt(
    application: DataFrame,
    book: DataFrame,
    spec: BookSpec = BOOK,
    fill: Sequence[str] | None = None,
) -> DataFrame:
    """One row per application with its book, counts filled with 0 where there is none.

    The key is unique on both sides. Should applications repeat a key very often, give
    the book as a written table: the join is then between plain shuffles, which Spark
    splits where they are skewed.
    """
    fill = set(zero_filled(book.columns, spec.key) if fill is None else fill)
    kept = application.drop(*LINEAGE_COLUMNS)
    features = [f for f in book.schema if f.name != spec.key]
    require_distinct([*kept.columns, *(f.name for f in features), spec.history_flag])
    # Rows without a key match nothing; they stay out of the join, where all of them
    # would meet in one task.
    named = F.col(spec.key).isNotNull()
    joined = kept.filter(named).join(book, spec.key, "left")
    rows = joined.unionByName(kept.filter(~named), allowMissingColumns=True)
    has_history = F.coalesce(F.col(f"{spec.prefix}_credit_count"), F.lit(0)) > 0
    filled = [
        F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name)
        if f.name in fill
        else F.col(f.name)
        for f in features
    ]
    return rows.select(*kept.columns, *filled, has_history.alias(spec.history_flag))


# -- storage types ---------------------------------------------------------

INTEGER_RANGES = (
    (T.ByteType(), 2**7),
    (T.ShortType(), 2**15),
    (T.IntegerType(), 2**31),
)


def _smallest(low: int | None, high: int | None) -> T.DataType:
    if low is not None:
        for kind, bound in INTEGER_RANGES:
            if -bound <= low and high < bound:
                return kind
    return T.LongType()


def narrow_numeric(df: DataFrame, ranges: Mapping[str, tuple[int | None, int | None]] | None = None) -> DataFrame:
    """Doubles to floats (lossy) and longs to the smallest type that holds their values.

    One aggregate finds the range of all long columns, if `ranges` does not tell it.
    """
    longs = [f.name for f in df.schema if isinstance(f.dataType, T.LongType)]
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    kinds = dict.fromkeys(doubles, T.FloatType())
    if ranges is not None:
        kinds |= {c: _smallest(*ranges[c]) for c in longs}
    elif longs:
        ends = [F.struct(F.min(quote(c)), F.max(quote(c))) for c in longs]
        kinds |= {c: _smallest(*r) for c, r in zip(longs, df.agg(*ends).first())}
    return df.select(
        *[F.col(quote(c)).cast(kinds[c]).alias(c) if c in kinds else F.col(quote(c)) for c in df.columns]
    )
