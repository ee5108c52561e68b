"""Book and base table over tables that lie in buckets by entity: no row of them moves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.operators import gold
from loanloom.sources.buckets import AtRest
from loanloom.specs import BOOK, BookSpec


def book(history: AtRest, types: Sequence[str] | None = None, spec: BookSpec = BOOK) -> DataFrame:
    """`gold.book`, aggregated inside the buckets.

    Hot entities, which lie beside the buckets, are folded where their rows are and dealt to
    the buckets' partitioning afterwards, one row each.
    """
    if types is None:
        types = gold.top_type_list(history.rows(), spec)
    cold = gold.book(history.table, types, spec, in_place=True)
    if not history.has_loose:
        return cold
    hot = gold.book(history.loose, types, spec, hot_rows=0)
    return cold.unionByName(hot.repartition(history.buckets, spec.key))


def abt(application: AtRest, book: DataFrame, spec: BookSpec = BOOK) -> DataFrame:
    """`gold.abt` bucket by bucket; applications without a key have no history to look for."""
    rows = gold.abt(application.table, book, spec)
    if not application.has_loose:
        return rows
    nothing = book.sparkSession.createDataFrame([], book.schema)
    return rows.unionByName(gold.abt(application.loose.filter(F.col(spec.key).isNull()), nothing, spec))
