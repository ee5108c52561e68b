"""Column expressions. All are built-in Spark expressions, free of Python at run time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def without_text_sentinel(c: Column, sentinel: str) -> Column:
    """Null where the text is the sentinel apart from spaces; else the text untouched."""
    return F.when(F.trim(c) != sentinel, c)


def is_yes(c: Column) -> Column:
    return c == "Y"


def is_one(c: Column, kind: T.DataType) -> Column:
    """Does the integer part equal 1? Null for null and for text that is no number.

    The range test says the same as a cast to int without raising on any input.
    """
    if isinstance(kind, T.BooleanType):
        return c
    if isinstance(kind, T.StringType):
        c = c.try_cast(T.DecimalType(38, 18))
    return (c >= 1) & (c < 2)


def is_sentinel(c: Column, value: float) -> Column:
    return c == F.lit(value)


def without_sentinel(c: Column, value: float) -> Column:
    return F.nullif(c, F.lit(value))


def negated(c: Column, divisor: float | None = None) -> Column:
    return -c if divisor is None else -c / F.lit(divisor)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator)


def type_bucket(c: Column, kept: Sequence[str], other: str) -> Column:
    """The value if it is one of `kept`, else `other`; null goes to `other`."""
    return F.when(c.isin(list(kept)), c).otherwise(F.lit(other))


def key_digest(key: Column, seed: int) -> Column:
    """md5 of `seed:key` as 32 hexadecimal digits: a fixed, even shuffle of the keys."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_percent(key: Column, seed: int) -> Column:
    """An integer in 0..99, decided by the key alone."""
    return F.conv(F.substr(key_digest(key, seed), F.lit(1), F.lit(8)), 16, 10).cast("long") % 100
