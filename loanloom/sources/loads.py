"""Bronze load by load: malformed rows to quarantine, and any load delivered again replaces itself.

A load is one file. Its rows are parsed once and written once, under folders of the load and of
whether a row was rejected, while one observation counts both kinds. A load that comes again
replaces its own folders as the write commits, and no other load's; until then readers see the
old rows, and a failed write leaves them as they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.naming import quote
from loanloom.sources.raw import with_lineage
from loanloom.specs import TableSpec

RECORD, LOAD, REJECTED = "_corrupt_record", "_source_file", "_rejected"
#: Names that a folder can hold as they are.
_plain_name = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


@dataclass(frozen=True)
class LoadAudit:
    """Counts of one load; `null_keys` are accepted rows that join to no entity."""

    table: str
    load: str
    rows: int
    rejected: int
    null_keys: int


def read_permissive(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """A headered CSV with the spec's types; unknown columns stay text. The text of a line with a value
    of another type, or with too few or too many values, is in `_corrupt_record`, which else is null."""
    header = spark.read.option("header", True).csv(path).columns
    fields = [T.StructField(n, spec.types.get(n, T.StringType())) for n in header]
    schema = T.StructType([*fields, T.StructField(RECORD, T.StringType())])
    reader = spark.read.option("header", True).schema(schema).option("enforceSchema", False)
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).csv(path)


def ingest_load(spark: SparkSession, spec: TableSpec, path: str, load: str, root: str) -> LoadAudit:
    """Write the CSV at `path` as load `load` of the table at `root`, in place of an earlier delivery."""
    if not _plain_name.fullmatch(load):
        raise ValueError(f"{load!r} cannot name a load")
    rows = with_lineage(read_permissive(spark, path, spec), load).withColumn(REJECTED, F.col(RECORD).isNotNull())
    key = next(raw for raw, new in spec.renames.items() if new == spec.key)
    bad, seen = F.col(REJECTED), Observation()
    counts = {"rows": F.count_if(~bad), "rejected": F.count_if(bad), "null_keys": F.count_if(~bad & F.col(quote(key)).isNull())}
    writer = rows.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(LOAD, REJECTED).parquet(root)
    found = seen.get
    # a side that has no rows this time was not replaced
    nothing = rows.drop(LOAD, REJECTED).limit(0)
    for side, n in (("false", found["rows"]), ("true", found["rejected"])):
        if not n:
            nothing.write.mode("overwrite").parquet(f"{root}/{LOAD}={load}/{REJECTED}={side}")
    return LoadAudit(spec.name, load, found["rows"], found["rejected"], found["null_keys"])


def _whole(spark: SparkSession, root: str) -> DataFrame:
    plain = spark.read.parquet(root)
    kinds = {LOAD: T.StringType(), REJECTED: T.BooleanType()}
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in plain.schema])
    return spark.read.schema(schema).parquet(root)


def accepted(spark: SparkSession, root: str) -> DataFrame:
    """The good rows of all loads; the others' files are not opened."""
    return _whole(spark, root).filter(~F.col(REJECTED)).drop(REJECTED, RECORD)


def quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The rejected lines of all loads as they were delivered."""
    return _whole(spark, root).filter(REJECTED).select(LOAD, F.col(RECORD).alias("record"), "_ingested_at")


def audit_frame(spark: SparkSession, audits: list[LoadAudit]) -> DataFrame:
    rows = [(a.table, a.load, a.rows, a.rejected, a.null_keys) for a in audits]
    return spark.createDataFrame(rows, "table_name string, load string, n_rows long, n_rejected long, n_null_keys long")
