"""History of entities that nobody asks for, left out before it moves.

The keys asked for set bits in a bitmap by their hash. Its words are a broadcast table of bounded size,
whatever the number of keys, against which every history row is tested where it lies. Rows that pass by
chance only cost their way: the join behind still goes by the key itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.naming import quote
from loanloom.operators import gold
from loanloom.sources.shared import fresh_path
from loanloom.sources.sinks import write_parquet
from loanloom.specs import BOOK, BookSpec

WORD_BITS = 64
#: Bits for each key: one of so many rows of other keys passes by chance.
BITS_PER_KEY = 32
#: The largest bitmap: 2 million words, some 100 MB where it is broadcast.
MOST_BITS = 1 << 27
#: A bitmap with a larger share of its bits set would let most rows pass.
FULL = 0.5


def bitmap_bits(keys: int, most: int = MOST_BITS) -> int:
    """A power of two, so that tables of near sizes share a plan."""
    return min(most, 1 << max(6, (max(1, keys) * BITS_PER_KEY - 1).bit_length()))


def _place(key: str, bits: int) -> str:
    return f"(xxhash64({quote(key)}) & {bits - 1}L)"


def key_bitmap(df: DataFrame, key: str, bits: int) -> DataFrame:
    """_word and _bits: at most bits / 64 rows, folded in the tasks before they move."""
    rows = df.filter(F.col(key).isNotNull()).select(F.expr(_place(key, bits)).alias("_place"))
    bit = F.expr(f"bit_or(shiftleft(1L, cast(_place % {WORD_BITS} AS int)))")
    words = rows.groupBy(F.expr(f"_place div {WORD_BITS}").alias("_word")).agg(bit.alias("_bits"))
    return write_parquet(words, fresh_path(df.sparkSession, "key-bitmap"))


def only_asked_for(history: DataFrame, asked: DataFrame, key: str, most: int = MOST_BITS) -> DataFrame:
    """The rows of `history` whose key may be among those of `asked`; no row of such a key is lost.

    `asked` that has too many keys for the largest bitmap leaves `history` as it is.
    """
    keys = asked.filter(F.col(key).isNotNull()).count()
    bits = bitmap_bits(keys, most)
    if keys > FULL * bits:
        return history
    words = F.broadcast(key_bitmap(asked, key, bits))  # bits / 64 rows at most
    place, named = _place(key, bits), history.filter(F.col(key).isNotNull())
    joined = named.join(words, F.expr(f"{place} div {WORD_BITS}") == F.col("_word"))
    is_set = F.expr(f"shiftright(_bits, cast({place} % {WORD_BITS} AS int)) & 1L") == 1
    return joined.filter(is_set).select(*[F.col(quote(c)) for c in history.columns])


def abt(application: DataFrame, history: DataFrame, types: Sequence[str] | None = None, spec: BookSpec = BOOK) -> DataFrame:
    """`gold.abt` of some applications: only their history reaches the wide shuffle.

    Without `types` those frequent in all of `history` get columns, as in the whole base table.
    """
    if types is None:
        types = gold.top_type_list(history, spec)
    return gold.abt(application, gold.book(only_asked_for(history, application, spec.key), types, spec), spec)
