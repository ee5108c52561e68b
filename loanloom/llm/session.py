"""What Python tasks need: the package on every executor, and tables in the shared folder."""

from __future__ import annotations

import contextlib
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.sources.shared import fresh_path

_shipped: set[str] = set()
#: How many rows Spark hands to a Python task at a time.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="loanloom-package-")) / "loanloom.zip"
    with zipfile.ZipFile(target, "w") as package:
        for file in sorted(root.rglob("*.py")):
            package.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """What is computed meanwhile goes to Python tasks `rows` rows at a time (None: as the session has it).

    Spark holds a batch several times over, outside its heap, so large rows need small batches.
    """
    before = spark.conf.get(BATCH, None)
    if rows:
        spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        if rows and before is None:
            spark.conf.unset(BATCH)
        elif rows:
            spark.conf.set(BATCH, before)


def stored(df: DataFrame, name: str, batch: int | None = None, **options: str) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, safe against lost executors.

    `batch`: rows that its Python tasks get at a time.
    """
    path = fresh_path(df.sparkSession, name)
    with batches_of(df.sparkSession, batch):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled(df: DataFrame, n: int, *by: str) -> DataFrame:
    """About `n` rows, chosen by a hash of the columns `by`; all rows if there are no more.

    Tasks drop the others where they are; 2 n rows at most come out, whatever repeats.
    """
    total = df.count()
    if total <= n:
        return df
    place = F.shiftrightunsigned(F.xxhash64(*by), 11).cast("double") / float(2**53)
    return df.filter(place < n / total).limit(2 * n)
