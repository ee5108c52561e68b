"""Bronze: headered CSV to Parquet with lineage, counted while it is written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.naming import quote
from loanloom.specs import TableSpec


@dataclass(frozen=True)
class Audit:
    """Counts of a written table; `null_keys` rows cannot join to any entity."""

    table: str
    rows: int
    columns: int
    null_keys: int


def read_csv(
    spark: SparkSession, path: str, spec: TableSpec, infer: bool = False, infer_unknown: bool = False
) -> DataFrame:
    """Scan a headered CSV with the spec's types, whatever the order of its columns.

    Columns the spec does not know stay text; with `infer_unknown` Spark guesses their types,
    with `infer` those of all columns, at the price of another scan. Malformed values fail the
    job rather than turn into nulls.
    """
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    header = reader.csv(path).columns
    types = dict(spec.types)
    if infer_unknown and any(n not in types for n in header):
        guessed = spark.read.option("header", True).option("inferSchema", True).csv(path).schema
        types = {f.name: f.dataType for f in guessed} | types
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in header])
    reader = spark.read.option("header", True).schema(schema)
    return reader.option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def with_lineage(df: DataFrame, source_file: str) -> DataFrame:
    return df.withColumns({"_ingested_at": F.current_timestamp(), "_source_file": F.lit(source_file)})


def write_audited(df: DataFrame, path: str, table: str, key: str) -> Audit:
    """Overwrite `path` as Parquet; the counts come out of the same pass."""
    seen = Observation()
    counts = (F.count(F.lit(1)).alias("rows"), F.count_if(F.col(quote(key)).isNull()).alias("null_keys"))
    df.observe(seen, *counts).write.mode("overwrite").parquet(path)
    return Audit(table, seen.get["rows"], len(df.columns), seen.get["null_keys"])


def ingest(
    spark: SparkSession, spec: TableSpec, raw_dir: str, bronze_dir: str, infer_unknown: bool = False
) -> Audit:
    source_file = f"{spec.name}.csv"
    rows = read_csv(spark, f"{raw_dir}/{source_file}", spec, infer_unknown=infer_unknown)
    df = with_lineage(rows, source_file)
    key = next(raw for raw, new in spec.renames.items() if new == spec.key)
    return write_audited(df, f"{bronze_dir}/{spec.name}", spec.name, key)


def audit_frame(spark: SparkSession, audits: list[Audit]) -> DataFrame:
    rows = [(a.table, a.rows, a.columns, a.null_keys) for a in audits]
    return spark.createDataFrame(rows, "table_name string, n_rows long, n_columns int, n_null_keys long")
