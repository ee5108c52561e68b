"""Exact quantiles of many columns without a sort, a shuffle of rows or a big buffer.

Each order statistic that a quantile needs lies in a known open interval of values.
A round asks `percentile_approx` for two values close around it, counts the rows
below, at and between them, and so finds the statistic or a much smaller interval.
A round is two aggregates over all columns and moves only sketches and counts. When
few rows are left in an interval, they are fetched. The rounds read a copy of the columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from loanloom.functions.naming import quote
from loanloom.sources.shared import fresh_path
from loanloom.sources.sinks import write_parquet

ACCURACY = 5_000
#: Rows that one aggregation buffer may hold at the end.
INSIDE_ROWS = 10_000


def _values(column: str) -> Column:
    """The column as double; NaN counts as missing."""
    return F.nullif(F.col(quote(column)).cast("double"), F.lit(float("nan")))


@dataclass(frozen=True)
class _Search:
    """Looks for the value of 0-based `rank`: strictly between `low` and `high` (None is
    unbounded), where `inside` rows lie, with `below` rows at `low` or lower."""

    column: str
    rank: int
    below: int
    inside: int
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def cell(self) -> Column:
        c = _values(self.column)
        within = F.lit(True)
        if self.low is not None:
            within = within & (c > self.low)
        if self.high is not None:
            within = within & (c < self.high)
        return F.when(within, c)

    def cuts(self) -> Column:
        at, margin = (self.rank - self.below) / self.inside, 3 / ACCURACY
        return F.percentile_approx(self.cell(), [max(at - margin, 0.0), min(at + margin, 1.0)], ACCURACY)

    def counts(self, cuts: Sequence[float]) -> Column:
        c, (a, b) = self.cell(), cuts
        return F.struct(
            F.count_if(c < a),
            F.count_if(c == a),
            F.count_if((c > a) & (c < b)),
            F.count_if((c == b) & F.lit(a < b)),
        )

    def narrowed(self, cuts: Sequence[float], counts: Row) -> _Search:
        a, b = cuts
        start, left = self.below, counts
        parts = [(self.low, a), a, (a, b), b, (b, self.high)]
        sizes = [*left, self.inside - sum(left)]
        for part, size in zip(parts, sizes):
            if self.rank < start + size:
                if isinstance(part, tuple):
                    return replace(self, low=part[0], high=part[1], below=start, inside=size)
                return replace(self, found=part)
            start += size
        raise AssertionError("rank beyond the rows counted")


def _one_row(df: DataFrame, folds: Sequence[Column]) -> Row:
    return df.agg(*folds).first()


def _order_statistics(
    df: DataFrame, wanted: Sequence[_Search], inside_rows: int
) -> dict[tuple[str, int], float]:
    searches = list(wanted)
    results = {}
    while searches:
        few = [s for s in searches if s.inside <= inside_rows]
        if few:
            lists = _one_row(df, [F.array_sort(F.collect_list(s.cell())) for s in few])
            results |= {(s.column, s.rank): inside[s.rank - s.below] for s, inside in zip(few, lists)}
        many = [s for s in searches if s.inside > inside_rows]
        if not many:
            break
        cuts = _one_row(df, [s.cuts() for s in many])
        counts = _one_row(df, [s.counts(c) for s, c in zip(many, cuts)])
        searches = [s.narrowed(c, k) for s, c, k in zip(many, cuts, counts)]
        results |= {(s.column, s.rank): s.found for s in searches if s.found is not None}
        searches = [s for s in searches if s.found is None]
    return results


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], inside_rows: int = INSIDE_ROWS
) -> dict[tuple[str, float], float | None]:
    """Linearly interpolated quantiles by (column, probability); null without values."""
    narrow = df.select(*[_values(c).alias(c) for c in columns])
    df = write_parquet(narrow, fresh_path(df.sparkSession, "quantiles"))  # the source is read once
    sizes = dict(zip(columns, _one_row(df, [F.count(_values(c)) for c in columns])))
    at = {(c, p): (n - 1) * p for c, n in sizes.items() if n for p in probs}
    ranks = {(c, r) for (c, _), x in at.items() for r in (math.floor(x), math.ceil(x))}
    found = _order_statistics(df, [_Search(c, r, 0, sizes[c]) for c, r in sorted(ranks)], inside_rows)
    results: dict[tuple[str, float], float | None] = {(c, p): None for c in columns for p in probs}
    for (c, p), x in at.items():
        a, b = found[c, math.floor(x)], found[c, math.ceil(x)]
        results[c, p] = a + (b - a) * (x - math.floor(x))
    return results
