"""Tables that lie partitioned by a key, so that grouping and joining by it moves nothing.

Rows are dealt to a fixed number of buckets once, when they are written; two tables with
the same number of buckets join bucket by bucket. Rows without a key, and those of keys with
very many rows, would make one bucket long, so they lie beside the buckets as plain files. What
a reader needs is written next to the data: the catalog keeps no entry, and any
session can read the folder.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.naming import quote, text
from loanloom.plans.skew import hot_keys
from loanloom.sources.sinks import write_json

#: Rows that a bucket should hold, and the most buckets of a table; beyond, buckets grow.
ROWS_PER_BUCKET, MOST_BUCKETS = 2_000_000, 20_000
#: The same where a bucket is folded to wide rows: a key's hundreds of buffers take some 2 KB, and
#: those of a whole bucket are sorted in the memory of one task.
WIDE_ROWS_PER_BUCKET = 100_000


def bucket_count(rows: int, most: int = MOST_BUCKETS, per: int = ROWS_PER_BUCKET) -> int:
    return max(1, min(most, -(-rows // per)))


def _name() -> str:
    return quote(f"loanloom_{uuid.uuid4().hex}")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """`df` at `path`, one sorted file for each bucket, and read back from there."""
    spark, name = df.sparkSession, _name()
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return read_buckets(spark, path, df.schema, key, buckets)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The buckets at `path`. Spark learns about them from a table that lasts for this call only."""
    name, columns = _name(), ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema)
    by = f"CLUSTERED BY ({quote(key)}) SORTED BY ({quote(key)}) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION {text(path)}")
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


@dataclass(frozen=True)
class AtRest:
    """`table` lies in buckets by `key`; `loose` are the rows without a key and of hot keys."""

    table: DataFrame
    loose: DataFrame
    key: str
    buckets: int
    has_loose: bool

    def rows(self) -> DataFrame:
        return self.table.unionByName(self.loose) if self.has_loose else self.table


def write_at_rest(
    df: DataFrame, path: str, key: str, buckets: int | None = None, hot_rows: int | None = None
) -> AtRest:
    """Lay `df` down in buckets by `key`; without `hot_rows` keys are taken for unique.

    Give tables that will be joined the same number of `buckets`; without one it
    follows from the number of rows.
    """
    spark, named = df.sparkSession, F.col(key).isNotNull()
    if buckets is None:
        buckets = bucket_count(df.count())
    cold, loose = df.filter(named), df.filter(~named)
    if hot_rows is not None:
        hot = hot_keys(df, key, hot_rows)
        if not hot.isEmpty():
            listed = F.broadcast(hot)  # bounded, see there
            loose = loose.unionByName(df.join(listed, key, "left_semi").select(df.columns))
            cold = cold.join(listed, key, "left_anti")
    write_buckets(cold, f"{path}/buckets", key, buckets)
    loose.write.mode("overwrite").parquet(f"{path}/loose")
    has_loose = not spark.read.schema(df.schema).parquet(f"{path}/loose").isEmpty()
    settings = [(key, buckets, has_loose, df.schema.json())]
    write_json(spark.createDataFrame(settings, "key string, buckets int, has_loose boolean, fields string"), f"{path}/settings")
    return read_at_rest(spark, path)


def read_at_rest(spark: SparkSession, path: str) -> AtRest:
    fields = "key string, buckets int, has_loose boolean, fields string"
    s = spark.read.schema(fields).json(f"{path}/settings").first()
    schema = T.StructType.fromJson(json.loads(s.fields))
    table = read_buckets(spark, f"{path}/buckets", schema, s.key, s.buckets)
    return AtRest(table, spark.read.schema(schema).parquet(f"{path}/loose"), s.key, s.buckets, s.has_loose)
