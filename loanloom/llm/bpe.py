"""Byte-level BPE: long texts are cut into overlapping chunks that are encoded in parallel.

A chunk is split into pre-tokens from its own start, so the first of them may be wrong.
Where a chunk and its predecessor agree on a boundary inside their overlap, they agree from
there on, as the pattern never looks back; the chunks are stitched there. Each
stitched part is then encoded. Decoding concatenates the bytes of the ids.

Null texts count as empty and have no ids. Every input row gives one output row, also
repeated rows and rows without an id. Only the named id and text columns are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.session import ship_package

#: Code points of a chunk, and of its overlap with the next one.
CHUNK, OVERLAP = 65_536, 1_024
#: Texts that are encoded before their rows are sent on.
ROWS = 256
CHUNKS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int32()), ("at", pa.int64()), ("chunk", pa.string()), ("whole", pa.bool_())])

_loaded: dict[tuple[str, str], "Codec"] = {}


def default_vocabulary() -> tuple[str, str]:
    """Path of the ranks and the pattern of pre-tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


class Codec:
    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.find = regex.compile(pattern).finditer
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes = {i: b for b, i in ranks.items()}
        self.digits = {i: str(i) for i in ranks.values()}

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def starts(self, text: str, at: int) -> list[int]:
        """Places in the document where pre-tokens start, when `text`, which begins at `at`,
        is split from its own beginning."""
        return [at + m.start() for m in self.find(text)]

    def stitched(self, chunks: list[tuple[int, str, bool]]) -> Iterator[str]:
        """Parts between boundaries on which neighbouring chunks agree, one after the other.

        Where an overlap holds no common boundary, as in one very long pre-token, the next
        chunk is appended and the whole split anew from the last boundary that is certain.
        """
        at, text, _ = chunks[0]
        for later, more, _ in chunks[1:]:
            mine = {p for p in self.starts(text, at) if p >= later}
            common = min(mine.intersection(self.starts(more, later)), default=None)
            if common is None:
                text += more[at + len(text) - later :]
            else:
                yield text[: common - at]
                at, text = common, more[common - later :]
        yield text


def codec(vocabulary: tuple[str, str]) -> Codec:
    if vocabulary not in _loaded:
        _loaded[vocabulary] = Codec(*vocabulary)
    return _loaded[vocabulary]


def _rows(doc_ids: list, encoded: list[list[int]], use: Codec, digests: bool) -> pa.RecordBatch:
    columns = {"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(map(len, encoded), pa.int64())}
    if digests:
        columns["ids_sha256"] = pa.array([hashlib.sha256(" ".join(map(use.digits.__getitem__, x)).encode()).hexdigest() for x in encoded])
        columns["decoded_sha256"] = pa.array([hashlib.sha256(use.decode(x)).hexdigest() for x in encoded])
    else:
        columns["ids"] = pa.array(encoded, pa.list_(pa.int32()))
    return pa.RecordBatch.from_pydict(columns)


def _schema(digests: bool) -> str:
    return "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>")


def encode(
    docs: DataFrame,
    vocabulary: tuple[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    digests: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, ids of each row's whole text.

    With `digests`, hex SHA-256 digests of the decimal ids and of the decoded bytes replace
    the ids, so that these need not travel.
    """
    vocabulary = vocabulary or default_vocabulary()
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    long_text = F.coalesce(F.length("text") > chunk, F.lit(False))

    def short(batches):
        use = codec(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                encoded = [use.encoding.encode_ordinary(x or "") for x in rows["text"].to_pylist()]
                yield _rows(rows["doc_id"].to_pylist(), encoded, use, digests)

    def cut(batches):
        """A row for each chunk; the last one is longer than an overlap."""
        for batch in batches:
            for row, doc, text in zip(*(batch[c].to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                for k, at in enumerate(range(0, max(1, len(text) - overlap), chunk)):
                    values = (row, doc, k, at, text[at : at + chunk + overlap], at + chunk + overlap >= len(text))
                    yield pa.RecordBatch.from_pylist([dict(zip(CHUNKS.names, values, strict=True))], CHUNKS)

    def bounds(batches):
        """Where pre-tokens start in the overlaps with the chunk before and the one after."""
        use = codec(vocabulary)
        for batch in batches:
            starts = [use.starts(t, a) for t, a in zip(batch["chunk"].to_pylist(), batch["at"].to_pylist(), strict=True)]
            ats = batch["at"].to_pylist()
            head = [[p for p in x if p < a + overlap] for x, a in zip(starts, ats, strict=True)]
            tail = [[p for p in x if p >= a + chunk] for x, a in zip(starts, ats, strict=True)]
            yield batch.append_column("head", pa.array(head, pa.list_(pa.int64()))).append_column("tail", pa.array(tail, pa.list_(pa.int64())))

    def parts(batches):
        use = codec(vocabulary)
        for batch in batches:
            encoded = []
            for text, at, since, until in zip(*(batch[c].to_pylist() for c in ("chunk", "at", "since", "until")), strict=True):
                encoded.append(use.encoding.encode_ordinary(text[since - at : len(text) if until is None else until - at]))
            yield pa.RecordBatch.from_arrays([batch["row"], batch["doc_id"], batch["k"], pa.array(encoded, pa.list_(pa.int32()))], ["row", "doc_id", "k", "ids"])

    def joined_first(table):
        """One document in which some overlap holds no common boundary."""
        use = codec(vocabulary)
        rows = sorted(zip(*(table[c].to_pylist() for c in ("at", "chunk", "whole")), strict=True))
        ids = [i for part in use.stitched(rows) for i in use.encoding.encode_ordinary(part)]
        return pa.table([table["row"].slice(0, 1), table["doc_id"].slice(0, 1), pa.array([0], pa.int32()), pa.array([ids], pa.list_(pa.int32()))], ["row", "doc_id", "k", "ids"])

    def finished(batches):
        use = codec(vocabulary)
        for batch in batches:
            yield _rows(batch["doc_id"].to_pylist(), batch["ids"].to_pylist(), use, digests)

    in_order = Window.partitionBy("row").orderBy("k")
    common = F.array_min(F.array_intersect("tail", F.lead("head").over(in_order)))
    chunks = (
        docs.filter(long_text)
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", "text")
        .mapInArrow(cut, "row long, doc_id long, k int, at long, chunk string, whole boolean")
        .repartition("row", "k")
        .mapInArrow(bounds, "row long, doc_id long, k int, at long, chunk string, whole boolean, head array<long>, tail array<long>")
        .withColumn("until", F.when(~F.col("whole"), common))
        .withColumn("since", F.when(F.col("k") == 0, F.lit(0)).otherwise(F.lag("until").over(in_order)))
        .withColumn("agreed", F.bool_and(F.col("whole") | F.col("until").isNotNull()).over(Window.partitionBy("row")))
        .drop("head", "tail")
    )
    out = "row long, doc_id long, k int, ids array<int>"
    agreed = chunks.filter("agreed").repartition("row", "k").mapInArrow(parts, out)
    others = chunks.filter("NOT agreed").groupBy("row").applyInArrow(joined_first, out)
    whole = (
        agreed.unionByName(others)
        .groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts"))
        .select("doc_id", F.flatten("parts.ids").alias("ids"))
    )
    return docs.filter(~long_text).mapInArrow(short, _schema(digests)).unionByName(whole.mapInArrow(finished, _schema(digests)))


def decode(encoded: DataFrame, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """doc_id and the bytes of its `ids`; a null list gives no bytes."""
    vocabulary = vocabulary or default_vocabulary()
    ship_package(encoded.sparkSession)

    def run(batches):
        use = codec(vocabulary)
        for batch in batches:
            body = [use.decode(x or []) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"].cast(pa.int64()), "bytes": pa.array(body, pa.binary())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")
