"""From raw documents to encoded training data, stage by stage.

Every stage works on whole rows: no column is dropped or added before the last one, whatever
their names, and repeated rows and rows without an id are documents like others. An empty
table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanloom.llm import bpe, mixing, quality, setsketch, substring
from loanloom.llm.session import stored

#: Near duplicates share this many hundredths of their shingles.
LINK = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a fence of their language and source go."""
    return quality.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 or more) stays, that of the smallest id."""
    return setsketch.deduplicated(docs, link=LINK)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that a document of a smaller id has too are cut out."""
    return substring.deduplicated(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as the mix of sources takes them: not at all, once or twice."""
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every remaining text."""
    return bpe.encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]
#: Sketches, samples by hash and token ids are not expressible in SQL; the tests
#: hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
