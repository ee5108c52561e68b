"""Quality rules whose thresholds come from the data: quantile sketches per language and source.

Built-in functions only. One pass derives the signals of every text inside its row, without
a shuffle. A signal's sketch counts values by the logarithm, in buckets 2 % wide: the counts of a pair of language
and source are sums, so sketches of tasks, languages and all documents merge, are folded in the tasks before
they move, and are the same on every run. The quartiles of a pair are drawn towards those of its
language by PRIOR documents, and these towards those of all documents: a pair's own documents
count at every size, and the more there are, the more. The fences are joined back to the signals.

Null texts count as empty: no words, which fails the base rules. Null languages and sources are
values of their own. Every row gives one row, also repeated rows and rows without an
id. Only the named columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.session import stored

SPACES = " \t\n\x0b\f\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8


@dataclass(frozen=True)
class Signal:
    """Rejected above the third quartile plus `spreads` interquartile ranges, `least` at least."""

    name: str
    least: float
    spreads: float = 4.0


SIGNALS = (
    Signal("symbols_per_word", 0.1),
    Signal("capital_share", 0.25),
    Signal("echo_share", 0.2),
    Signal("repeated_line_share", 0.4),
    Signal("repeated_window_share", 0.3),
    Signal("chars_per_word", 6.0),
)
#: Documents of its own that the language counts for in the quartiles of a pair.
PRIOR = 20
QUARTILES = (0.25, 0.75)
#: Each bucket of a sketch reaches so many times as far as the one below; ZERO is that of 0.
GROWTH, ZERO = 1.02, -1_000_000


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _pairs(column: str, step: int, fn) -> Column:
    """`fn` of the elements that stand `step` apart."""
    n = F.greatest(F.size(column) - step, F.lit(0))
    return F.zip_with(F.slice(column, 1, n), F.slice(column, step + 1, n), fn)


def with_signals(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with the counts of the base rules and the signals."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("_words", F.filter(F.split(text, SPLIT), lambda w: w != ""))
    df = df.withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w)))
    df = df.withColumn("_echoes", F.size(F.filter(_pairs("_h1", 1, lambda a, b: a == b), lambda x: x)))
    for size in (1, 2, 4):  # windows of twice the size from two windows
        df = df.withColumn(f"_h{2 * size}", _pairs(f"_h{size}", size, lambda a, b: F.xxhash64(a, b)))
    # (hash, place) of the windows, only where some window is repeated
    places = F.arrays_zip(F.col(f"_h{WINDOW}").alias("h"), F.sequence(F.lit(1), F.size(f"_h{WINDOW}")).alias("i"))
    repeated = F.size(F.array_distinct(f"_h{WINDOW}")) < F.size(f"_h{WINDOW}")
    df = df.withColumn("_sorted", F.when(repeated, F.sort_array(places)))
    twice = _pairs("_sorted", 1, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    df = df.withColumn("_places", F.when(F.col("_sorted").isNotNull(), F.sort_array(F.array_distinct(F.flatten(F.filter(twice, lambda x: x.isNotNull()))))))
    covered = F.aggregate(_pairs("_places", 1, lambda a, b: F.least(F.lit(WINDOW), b - a)), F.lit(WINDOW), lambda s, x: s + x)
    lines = F.filter(F.split(text, "\n"), lambda x: _without(x, SPACES) != "")
    df = df.withColumn("_lines", lines)
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(_without(text, SPACES)).cast("long"),
            "n_symbols": (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.when(F.col("_places").isNull(), F.lit(0)).otherwise(covered).cast("long"),
            "_n_lines": F.size("_lines"),
            "_capitals": F.length(text) - F.length(_without(text, CAPITALS)),
        }
    )
    words = F.col("n_words")
    df = df.withColumns(
        {
            "symbols_per_word": _share(F.col("n_symbols"), words),
            "capital_share": _share(F.col("_capitals"), F.col("word_chars")),
            "echo_share": _share(F.col("_echoes"), words),
            "repeated_line_share": _share(F.col("n_dup_lines"), F.col("_n_lines")),
            "repeated_window_share": _share(F.col("n_repeat_words"), words),
            "chars_per_word": _share(F.col("word_chars"), words),
            "base_failed": (words < 20) | (100 * F.col("n_repeat_words") > 30 * words),
        }
    )
    inner = ["_words", "_echoes", "_h1", "_h2", "_h4", "_h8", "_sorted", "_places", "_lines", "_n_lines", "_capitals"]
    return df.drop(*inner)


def _bucket(value: Column) -> Column:
    return F.when(value > 0, F.floor(F.log(value) / F.log(F.lit(GROWTH))).cast("int")).otherwise(F.lit(ZERO))


def _quartiles(sketches: DataFrame, *by: str) -> DataFrame:
    """_rows, _low and _high of every group and signal: the middles of the buckets they lie in."""
    cells = sketches.groupBy(*by, "_signal", "_bucket").agg(F.sum("_n").alias("_n"))
    # at most one cell for each bucket
    listed = cells.groupBy(*by, "_signal").agg(F.sort_array(F.collect_list(F.struct("_bucket", "_n"))).alias("_cells"), F.sum("_n").alias("_rows"))

    def at(q: float) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("bucket"))

        def add(state: Column, cell: Column) -> Column:
            seen = state["seen"] + cell["_n"]
            here = F.when(seen >= F.ceil(F.col("_rows") * q), cell["_bucket"])
            return F.struct(seen.alias("seen"), F.coalesce(state["bucket"], here).alias("bucket"))

        bucket = F.aggregate("_cells", start, add)["bucket"]
        return F.when(bucket == ZERO, 0.0).otherwise(F.pow(F.lit(GROWTH), bucket + 0.5))

    return listed.select(*by, "_signal", "_rows", *[at(q).alias(c) for q, c in zip(QUARTILES, ("_low", "_high"), strict=True)])


def _drawn(prior: int) -> list[Column]:
    """The quartiles of each row, drawn towards the wider group's `_wide_low` and `_wide_high`."""
    own = F.col("_rows") / (F.col("_rows") + prior)
    return [(own * F.col(c) + (1 - own) * F.col(f"_wide{c}")).alias(c) for c in ("_low", "_high")]


def fences(scored: DataFrame, prior: int = PRIOR, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """_lang, _source and an upper fence per signal, from sketches over all documents."""
    cells = [F.struct(F.lit(i).alias("_signal"), _bucket(F.col(s.name)).alias("_bucket")) for i, s in enumerate(SIGNALS)]
    rows = scored.select(F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"), F.inline(F.array(*cells)))
    sketches = stored(rows.groupBy("_lang", "_source", "_signal", "_bucket").agg(F.count(F.lit(1)).alias("_n")), "quality-sketches")

    def wide(df: DataFrame, *by: str) -> DataFrame:
        named = {"_low": "_wide_low", "_high": "_wide_high", "_signal": "_wide_signal", **{c: f"_wide{c}" for c in by}}
        return df.select(*[F.col(c).alias(to) for c, to in named.items()])

    same = F.col("_signal") == F.col("_wide_signal")
    every = wide(_quartiles(sketches))  # one row for each signal
    by_lang = _quartiles(sketches, "_lang").join(F.broadcast(every), same)
    by_lang = stored(wide(by_lang.select("_lang", "_signal", *_drawn(prior)), "_lang"), "quality-languages")
    own = _quartiles(sketches, "_lang", "_source").join(by_lang, same & F.col("_lang").eqNullSafe(F.col("_wide_lang")))
    own = own.select("_lang", "_source", "_signal", *_drawn(prior))

    def fence(i: int, s: Signal) -> Column:
        limit = F.col("_high") + F.greatest(s.spreads * (F.col("_high") - F.col("_low")), F.lit(s.least))
        return F.max(F.when(F.col("_signal") == i, limit)).alias(f"_{s.name}_fence")

    return own.groupBy("_lang", "_source").agg(*[fence(i, s) for i, s in enumerate(SIGNALS)])


def judged(scored: DataFrame, limits: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """`scored` with `kept`: the base rules hold and no signal is above its fence."""
    same = F.col(lang_col).eqNullSafe(F.col("_lang")) & F.col(source_col).eqNullSafe(F.col("_source"))
    within = ~F.col("base_failed")
    for s in SIGNALS:
        within &= F.col(s.name) <= F.col(f"_{s.name}_fence")
    return scored.join(limits, same, "left").withColumn("kept", F.coalesce(within, F.lit(False))).drop(*limits.columns)


def rules(docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """doc_id, the counts, signals, base_failed and kept of every row."""
    scored = with_signals(docs.select("doc_id", "text", "lang", "source")).drop("text")
    scored = stored(scored, "quality-signals")
    return judged(scored, stored(fences(scored, prior), "quality-fences")).drop("lang", "source")


def kept(docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """The rows of `docs` that pass, with their columns.

    The texts are read twice, for the fences and for the verdicts, rather than moved.
    """
    renamed = docs.select(F.col("text"), F.col("lang"), F.col("source"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    scored = with_signals(renamed)
    limits = stored(fences(scored.drop("_row"), prior), "quality-fences")
    return judged(scored, limits).filter("kept").select("_row.*")
