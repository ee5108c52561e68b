"""Silver: readable names, clean values, real types. Narrow plans, one projection each."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions import columns as C
from loanloom.functions.naming import quote, silver_names
from loanloom.specs import APPLICATION, BUREAU, Derived, NumericSentinel, TableSpec, TEXT_SENTINEL


def _project(exprs: Mapping[str, Column], df: DataFrame) -> DataFrame:
    return df.select(*[c.alias(name) for name, c in exprs.items()])


def _as_is(df: DataFrame) -> dict[str, Column]:
    return {name: F.col(quote(name)) for name in df.columns}


def rename(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Dictionary names where the source has the column, fallback names elsewhere."""
    new = silver_names(df.columns, renames)
    return _project(dict(zip(new, _as_is(df).values())), df)


def clean_sentinels(df: DataFrame, sentinel: str = TEXT_SENTINEL) -> DataFrame:
    """Null out the text sentinel in every string column."""
    return _project(
        {
            f.name: C.without_text_sentinel(F.col(quote(f.name)), sentinel)
            if isinstance(f.dataType, T.StringType)
            else F.col(quote(f.name))
            for f in df.schema
        },
        df,
    )


def to_bool(df: DataFrame, yes_no: Iterable[str] = (), zero_one: Iterable[str] = ()) -> DataFrame:
    """Flags as booleans; flags that the table lacks are skipped."""
    exprs = _as_is(df)
    exprs |= {n: C.is_yes(exprs[n]) for n in yes_no if n in exprs}
    exprs |= {n: C.is_one(exprs[n], df.schema[n].dataType) for n in zero_one if n in exprs}
    return _project(exprs, df)


def _with_sentinels(exprs: dict[str, Column], sentinels: Iterable[NumericSentinel]) -> dict[str, Column]:
    known = [s for s in sentinels if s.column in exprs]
    flags = {s.flag: C.is_sentinel(exprs[s.column], s.value) for s in known}
    return exprs | {s.column: C.without_sentinel(exprs[s.column], s.value) for s in known} | flags


def _with_derived(exprs: dict[str, Column], derived: Iterable[Derived]) -> dict[str, Column]:
    return exprs | {d.name: C.negated(exprs[d.source], d.divisor) for d in derived if d.source in exprs}


def flag_sentinels(df: DataFrame, sentinels: Iterable[NumericSentinel]) -> DataFrame:
    return _project(_with_sentinels(_as_is(df), sentinels), df)


def derive(df: DataFrame, derived: Iterable[Derived]) -> DataFrame:
    return _project(_with_derived(_as_is(df), derived), df)


def transform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every silver rule of the table in a single projection over the raw columns."""
    exprs = {}
    for field, name in zip(df.schema, silver_names(df.columns, spec.renames)):
        c = F.col(quote(field.name))
        if isinstance(field.dataType, T.StringType):
            c = C.without_text_sentinel(c, spec.text_sentinel)
        if name in spec.yes_no_flags:
            c = C.is_yes(c)
        elif name in spec.zero_one_flags:
            c = C.is_one(c, field.dataType)
        exprs[name] = c
    exprs = _with_sentinels(exprs, spec.sentinels)
    return _project(_with_derived(exprs, spec.derived), df)


def application(df: DataFrame) -> DataFrame:
    return transform(df, APPLICATION)


def bureau(df: DataFrame) -> DataFrame:
    return transform(df, BUREAU)
