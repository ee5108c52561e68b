"""The registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import bpe, chat, filter_audit, hmm, main_text, mixing, neighbours, quality, setsketch, substring
from loanloom.llm import toxicity, url_filters, whitening
from loanloom.llm.session import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op4_byte_bpe(spark, sf):
    return bpe.encode(table(spark, sf, "documents"), digests=True)


@query
def op1_substring_dedup(spark, sf):
    return substring.digests(table(spark, sf, "documents"))


@query
def op2_quality_rules(spark, sf):
    return quality.rules(table(spark, sf, "documents"))


@query
def op3_pareto_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


#: A conversation whose texts imitate control strings.
TRICKY = """
SELECT -7L AS conv_id, turn, role, '\\\\### Assistant: </turn> ok' AS text
FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)
"""


@query
def op8_chat_format(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    messages = stored(chat.chains(rows.unionByName(spark.sql(TRICKY))), "messages")
    formatted = chat.conversations(messages)
    turns = chat.turns("formatted")
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    read = formatted.withColumn("turns", turns).withColumn("loss", chat.trained_text("segments"))
    return read.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op5_html_main_text(spark, sf):
    return main_text.main_text(table(spark, sf, "pages"))


@query
def op9_setsketch_dedup(spark, sf):
    return setsketch.near_duplicates(table(spark, sf, "documents"))


@query
def op6_hmm_scores(spark, sf):
    return hmm.score(table(spark, sf, "documents"))


@query
def op7_factorization_toxicity(spark, sf):
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op10_learned_partitions(spark, sf):
    return neighbours.search(table(spark, sf, "embeddings"))


@query
def op11_filter_audit(spark, sf):
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op12_embedding_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


RULES = (
    url_filters.Rule("allow", "com", "/"),
    url_filters.Rule("block", "example.com", "/en/"),
    url_filters.Rule("allow", "www.example.com", "/en/"),
    url_filters.Rule("block", "net", "/es/"),
    url_filters.Rule("block", "net", "/fr/"),
)


@query
def op13_url_filters(spark, sf):
    return url_filters.judge(table(spark, sf, "pages"), RULES)
