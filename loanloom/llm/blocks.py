"""Documents packed into blocks: rows of a few megabytes that array code handles at once.

Blocks are written once, bucketed by their number, so that answers for a block join to it
without moving the texts again. A block asks about its keys with one entry per distinct key,
however often a key occurs in it, and gets one answer: no key has more entries than there
are blocks.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import text as words
from loanloom.llm.session import batches_of, ship_package
from loanloom.sources.shared import fresh_path

#: Bytes of text in a block, and in the bucket of blocks that one task reads. Spark refuses a
#: table of more than 100 000 buckets, so beyond 1.6 TB the buckets grow; a task reads them block by block.
BLOCK_BYTES, BUCKET_BYTES, MOST_BUCKETS = 2_000_000, 32_000_000, 50_000
#: A row's number is its block's times 2**PLACE_BITS plus its place there.
PLACE_BITS = 16
#: Documents, and blocks, that Spark hands to a Python task at a time: one to a few megabytes.
DOCUMENTS, ONE_BLOCK = 256, 1
#: Bytes of keys that meet in one group.
GROUP_BYTES = 16_000_000


def to_ipc(table: pa.Table) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue()


def from_ipc(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


@dataclass(frozen=True)
class Blocks:
    """The table of blocks, its number of buckets, and the bytes of all texts."""

    table: DataFrame
    buckets: int
    size: int

    def without_rest(self) -> "Blocks":
        return replace(self, table=self.table.drop("rest"))

    def groups(self) -> int:
        """Groups that keys are dealt to, so that a group's keys fit in memory."""
        return max(1, -(-self.size // GROUP_BYTES))

    def with_answers(self, answers: DataFrame, columns: list[str]) -> "Blocks":
        """Adds the lists of all answers to each block; only the answers are moved."""
        dealt = answers.withColumnRenamed("block", "_to").repartition(self.buckets, "_to")
        listed = dealt.groupBy("_to").agg(*[F.collect_list(c).alias(c) for c in columns])
        joined = self.table.join(listed.hint("shuffle_hash"), F.col("block") == F.col("_to"), "left")
        return replace(self, table=joined.drop("_to"))

    def map(self, fn: Callable, schema: str) -> DataFrame:
        """The record batches that `fn(row)` yields for each block, given as a dict of its columns."""

        def run(batches):
            for batch in batches:
                for k in range(batch.num_rows):
                    yield from fn({c: batch[c][k].as_py() for c in batch.schema.names})

        ship_package(self.table.sparkSession)
        return self.table.mapInArrow(run, schema)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK_BYTES, derive: Callable | None = None, columns: Sequence[str] = ()
) -> Blocks:
    """block, ids, offsets, text and the other columns (`rest`) of blocks of documents.

    Inside a block the documents are in the order of their ids, null last. A longer text
    is a block of its own. With `derive`, blocks have the bytes of the `columns` that it makes of the bytes and
    offsets of the texts, in place of offsets, text and `rest`.
    """
    spark = docs.sparkSession
    names = ["block", "ids", *(columns if derive else ("offsets", "text", "rest"))]
    ship_package(spark)

    def packed(rows: pa.Table, k: int) -> pa.RecordBatch:
        order = np.argsort(words.ids(rows[id_col]), kind="stable")
        rows = rows.take(pa.array(order)).combine_chunks()
        data, offsets = words.as_bytes(rows[text_col].cast(pa.large_string()))
        block = (TaskContext.get().partitionId() << 24) | k
        values = derive(data, offsets) if derive else (offsets.tobytes(), data.tobytes(), to_ipc(rows.drop_columns([text_col])))
        values = (words.ids(rows[id_col]).tobytes(), *values)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *(pa.array([v], pa.binary()) for v in values)], names)

    def run(batches):
        waiting, held, rows, k = [], 0, 0, 0
        for batch in batches:
            sizes = np.diff(words.as_bytes(batch[text_col])[1]) + 64
            at = 0
            while at < batch.num_rows:
                upto = int(np.searchsorted(np.cumsum(sizes[at:]), size - held, "right")) + at
                upto = min(max(upto, at + (not held)), at + (1 << PLACE_BITS) - rows)
                if upto > at:
                    waiting.append(batch.slice(at, upto - at))
                    held += int(sizes[at:upto].sum())
                    rows += upto - at
                at = upto
                if at < batch.num_rows or held >= size:
                    yield packed(pa.Table.from_batches(waiting), k)
                    waiting, held, rows, k = [], 0, 0, k + 1
        if waiting:
            yield packed(pa.Table.from_batches(waiting), k)

    blocks = docs.mapInArrow(run, "block long, " + ", ".join(f"{c} binary" for c in names[1:]))
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(1, min(MOST_BUCKETS, -(-total // BUCKET_BYTES)))
    with batches_of(spark, DOCUMENTS):
        table = bucketed(blocks, buckets)
    return Blocks(table, buckets, total)


def bucketed(blocks: DataFrame, n: int) -> DataFrame:
    """`blocks` written to the shared folder, bucketed by block; the catalog keeps no entry."""
    name = f"loanloom_blocks_{uuid.uuid4().hex}"
    path = fresh_path(blocks.sparkSession, "blocks")
    writer = blocks.write.option("path", path).option("compression", "zstd").option("parquet.block.size", 16 << 20)
    writer.bucketBy(n, "block").saveAsTable(name)
    found = blocks.sparkSession.table(name)
    blocks.sparkSession.sql(f"DROP TABLE {name}")  # the files stay
    return found


def groups_of(keys: np.ndarray, n_groups: int) -> np.ndarray:
    """The group of each 64-bit key, by its upper half, so that equal keys meet."""
    return ((keys >> np.uint64(32)) * np.uint64(n_groups) >> np.uint64(32)).astype(np.int64)


def split_sorted(keys: np.ndarray, n_groups: int) -> list[tuple[int, int, int]]:
    """(group, from, to) of the groups in sorted keys."""
    found = groups_of(keys, n_groups)
    edges = np.flatnonzero(np.r_[True, found[1:] != found[:-1], True]) if len(found) else np.zeros(1, int)
    return [(int(found[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def grouped(table: pa.Table, column: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The entries of all rows of a group one after the other, and the row each comes from."""
    parts = [np.frombuffer(x, dtype) for x in table[column].to_pylist()]
    rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return np.concatenate(parts) if parts else np.zeros(0, dtype), rows
