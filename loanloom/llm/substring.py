"""Substring dedup by prefix-partitioned suffix trees over words.

Every position of every text is a suffix, cut at `size` words. A repeat of `size` words is an
internal node at that depth with leaves from two documents, and all leaves but those of the
smallest id go.

1. Documents are packed into blocks. Whole copies (equal word sequences) lie under the same
   nodes as the smallest of their group and are settled by a digest.
2. Inside a block, equal suffixes are found at once; only one leaf for each distinct suffix,
   that of the smallest id, takes part in the trees of all documents.
3. Suffixes that cannot have a second leaf are pruned: equal windows share the smallest hash
   of their short grams, so a window whose smallest hash occurs in one block only is unique.
4. The others go to groups by a prefix of 1, 2, 3, 5, 8 or all words: the shortest
   that no more suffixes share than fit in memory, as counted over all documents. Suffixes
   that agree in all words have at most one leaf for each block.
5. A group's suffixes are sorted, word by word; neighbours with a common prefix of `size`
   words lie under one deep node. Its leaves but the smallest are reported to their blocks.

A suffix is 16 bits of each word's hash, for the order and the depth of nodes, and 64
bits of the whole window; leaves under one node agree in all 272.

Words are runs outside space and 0x09-0x0D. Null texts have no words, rows with equal ids are
not smaller than each other, and a null id is larger than all others. Every row gives
one row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import blocks as packing
from loanloom.llm import text as words
from loanloom.llm.session import stored

SIZE = 13
#: Words of the short grams that prune unique windows.
GRAM = 7
PREFIXES = (1, 2, 3, 5, 8, 13)
#: Suffixes of all documents that may share a group, and bins of counted prefixes for each.
GROUP_SUFFIXES, BINS_PER_GROUP = 2_000_000, 4


class Block:
    """Words and windows of one block; whole copies have no windows."""

    def __init__(self, row: dict, size: int):
        self.size, self.data = size, row["text"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        self.words = words.words(np.frombuffer(row["text"], np.uint8), self.offsets)
        self.first, self.doc = self.words.first, self.words.text_of_word()
        self.codes = self.words.codes()
        self.valid = words.window_starts(self.first, size, max(0, len(self.codes) - size + 1))
        self.copied = np.zeros(len(self.ids), bool)
        for x in row.get("copies") or []:
            self.copied[np.frombuffer(x, np.int32)] = True
        self.valid &= ~self.copied[self.doc[: len(self.valid)]]

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each document's words."""
        place = (np.arange(len(self.codes)) - self.first[self.doc]).astype(np.uint64)
        lengths, out = np.diff(self.first).astype(np.uint64), []
        for seed in (0x51ED270B, 0x2545F491):
            sums = np.zeros(len(place) + 1, np.uint64)
            np.cumsum(words.mix(self.codes + words.mix(place + np.uint64(seed))), out=sums[1:])
            out.append(words.mix(sums[self.first[1:]] - sums[self.first[:-1]] + lengths))
        return out[0], out[1]

    def smallest_grams(self, gram: int) -> np.ndarray:
        """For each window the smallest hash of the grams inside it."""
        least = words.window_hashes(self.codes, gram)
        width, have = self.size - gram + 1, 1
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[: len(least) - step], least[step:])
            have += step
        return least

    def nodes(self, among: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The chosen windows sorted, equal ones by id; where each node begins; all hashes."""
        hashes = words.window_hashes(self.codes, self.size)
        at = np.flatnonzero(among)
        order = at[np.argsort(hashes[at], kind="stable")]
        new = np.ones(len(order), bool)
        new[1:] = hashes[order[1:]] != hashes[order[:-1]]
        return order, new, hashes

    def removed_words(self, leaves: list[bytes]) -> np.ndarray:
        """True for every word under a window to remove; `leaves` are places from the trees."""
        order, new, _ = self.nodes(self.valid)
        node = np.cumsum(new) - 1
        least = order[new]
        go = self.ids[self.doc[order]] > self.ids[self.doc[least]][node]
        reported = np.zeros(len(self.valid), bool)
        for x in leaves:
            reported[np.frombuffer(x, np.int32)] = True
        go |= reported[least][node]
        edges = np.zeros(len(self.codes) + 1, np.int64)
        np.add.at(edges, order[go], 1)
        np.add.at(edges, order[go] + self.size, -1)
        return (np.cumsum(edges)[:-1] > 0) | self.copied[self.doc]

    def document(self, d: int) -> bytes:
        return self.data[self.offsets[d] : self.offsets[d + 1]]


def whole_copies(blocks: packing.Blocks, size: int) -> DataFrame:
    """block and the places of documents whose words equal those of a smaller id."""

    def digests(row):
        block = Block(row, size)
        use = np.flatnonzero(np.diff(block.first) >= size)
        a, b = (x[use].view(np.int64) for x in block.digests())
        columns = [a, b, block.ids[use], np.full(len(use), row["block"], np.int64), use.astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "id", "block", "place"])

    found = blocks.without_rest().map(digests, "a long, b long, id long, block long, place int")
    found = stored(found, "digests")
    ends = found.groupBy(F.col("a").alias("_a"), F.col("b").alias("_b")).agg(F.min("id").alias("_least"), F.max("id").alias("_most"))
    later = found.join(ends.filter("_least < _most"), (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")) & (F.col("id") > F.col("_least")))

    def packed(table):
        places = np.asarray(table["place"], np.int32)
        return pa.table({"block": table["block"].slice(0, 1), "copies": pa.array([places.tobytes()], pa.binary())})

    return later.select("block", "place").groupBy("block").applyInArrow(packed, "block long, copies binary")


def repeated_grams(blocks: packing.Blocks, size: int, gram: int) -> DataFrame:
    """block and those smallest grams of its windows that another block has too."""
    n_groups = blocks.groups()

    def ask(row):
        block = Block(row, size)
        keys = np.unique(block.smallest_grams(gram)[block.valid])
        parts = packing.split_sorted(keys, n_groups)
        columns = [[g for g, _, _ in parts], [row["block"]] * len(parts), [keys[a:b].tobytes() for _, a, b in parts]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["grp", "block", "keys"])

    def common(table):
        keys, rows = packing.grouped(table, "keys", np.uint64)
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        return answers(table, "repeated", rows[twice], keys[twice])

    asked = blocks.without_rest().map(ask, "grp long, block long, keys binary")
    return asked.groupBy("grp").applyInArrow(common, "block long, repeated binary")


def answers(table: pa.Table, name: str, rows: np.ndarray, values: np.ndarray) -> pa.Table:
    """One row for each block, with the values of its rows; `rows` ascends."""
    edges = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1], True]) if len(rows) else np.zeros(1, int)
    to = np.asarray(table["block"])[rows[edges[:-1]]]
    return pa.table({"block": pa.array(to, pa.int64()), name: pa.array([values[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())})


def prefixes(codes: np.ndarray, at: np.ndarray, size: int):
    """(number of words, hash of so many words) of the suffixes at the given places."""
    value = np.zeros(len(at), np.uint64)
    for d in range(size):
        value = words.mix(value * np.uint64(3) + codes[at + d])
        if d + 1 in PREFIXES or d + 1 == size:
            yield d + 1, value


def crowded_prefixes(blocks: packing.Blocks, size: int, n_bins: int, limit: int) -> dict[int, np.ndarray]:
    """For each prefix length the bins that more than `limit` suffixes share.

    Their number is at most the number of suffixes over `limit`, for each length.
    """

    def run(batches):
        counts = {}
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block({c: batch[c][k].as_py() for c in batch.schema.names}, size)
                for d, value in prefixes(block.codes, np.flatnonzero(block.valid), size):
                    found = np.bincount(packing.groups_of(value, n_bins), minlength=n_bins)
                    counts[d] = counts.get(d, 0) + found
        for d, found in counts.items():
            used = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), d, np.int32)), pa.array(used), pa.array(found[used])], ["d", "bin", "n"])

    counted = blocks.without_rest().table.mapInArrow(run, "d int, bin long, n long")
    found = counted.groupBy("d", "bin").agg(F.sum("n").alias("n")).filter(F.col("n") > limit).collect()
    out: dict[int, list[int]] = {}
    for row in found:
        out.setdefault(row["d"], []).append(row["bin"])
    return {d: np.sort(np.array(x)) for d, x in out.items()}


def _suffix(size: int) -> np.dtype:
    return np.dtype([("words", "<u2", (size,)), ("hash", "<u8"), ("id", "<i8"), ("place", "<i4")])


def suffixes(blocks: packing.Blocks, size: int, gram: int, crowded: dict[int, np.ndarray], n_bins: int) -> DataFrame:
    """grp, block and the packed suffixes that may have leaves in another block."""

    def run(row):
        block = Block(row, size)
        parts = [np.frombuffer(x, np.uint64) for x in row["repeated"] or []]
        if not parts:
            return
        repeated = np.sort(np.concatenate(parts))
        least = block.smallest_grams(gram)
        near = np.minimum(np.searchsorted(repeated, least), len(repeated) - 1)
        order, new, hashes = block.nodes(block.valid & (repeated[near] == least))
        at = order[new]
        group = np.full(len(at), -1, np.int64)
        for k, (d, value) in enumerate(prefixes(block.codes, at, size)):
            bins = packing.groups_of(value, n_bins)
            fits = np.ones(len(at), bool) if d == size else ~np.isin(bins, crowded.get(d, np.zeros(0, int)))
            now = fits & (group < 0)
            group[now] = k * n_bins + bins[now]
        order = np.argsort(group, kind="stable")
        at, group = at[order], group[order]
        out = np.zeros(len(at), _suffix(size))
        short = (block.codes >> np.uint64(48)).astype(np.uint16)
        for d in range(size):
            out["words"][:, d] = short[at + d]
        out["hash"], out["id"], out["place"] = hashes[at], block.ids[block.doc[at]], at
        edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(at) else np.zeros(1, int)
        columns = [group[edges[:-1]], np.full(len(edges) - 1, row["block"], np.int64)]
        packed = [out[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(packed, pa.binary())], ["grp", "block", "suffixes"])

    return blocks.without_rest().map(run, "grp long, block long, suffixes binary")


def subtree(found: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of the tree's leaves, and the common prefix, in words, of each with the one before."""
    padded = np.zeros((len(found), -(-size // 4) * 4), "<u2")
    padded[:, :size] = found["words"]
    keys = padded.astype(">u2").view(">u8").astype(np.uint64)
    order = np.lexsort((found["id"], found["hash"], *keys.T[::-1]))
    found = found[order]
    depth = np.zeros(len(found), np.int64)
    same = np.ones(max(0, len(found) - 1), bool)
    for d in range(size):
        same &= found["words"][1:, d] == found["words"][:-1, d]
        if d == size - 1:
            same &= found["hash"][1:] == found["hash"][:-1]
        depth[1:] += same
    return order, depth


def repeats(packed: DataFrame, size: int) -> DataFrame:
    """block and the places of leaves that hang under a deep node beside a smaller id."""

    def run(table):
        entry = _suffix(size)
        parts = [np.frombuffer(x, entry) for x in table["suffixes"].to_pylist()]
        found, rows = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        order, depth = subtree(found, size)
        deep = depth >= size
        node = np.cumsum(~deep) - 1
        ids = found["id"][order]
        go = order[ids > ids[~deep][node]]
        go.sort()
        return answers(table, "leaves", rows[go], found["place"][go])

    return packed.groupBy("grp").applyInArrow(run, "block long, leaves binary")


def settled(docs: DataFrame, size: int, block_bytes: int, group_suffixes: int) -> packing.Blocks:
    """The blocks of `docs` with `copies` and `leaves`, which say what to remove."""
    gram = min(GRAM, size)
    blocks = packing.pack(docs, size=block_bytes)
    copied = stored(whole_copies(blocks, size), "copies")
    known = blocks.with_answers(copied, ["copies"])
    n_bins = max(1, BINS_PER_GROUP * -(-blocks.size // (6 * group_suffixes)))
    crowded = crowded_prefixes(known, size, n_bins, group_suffixes)
    repeated = stored(repeated_grams(known, size, gram), "grams")
    asked = blocks.with_answers(copied.unionByName(repeated, allowMissingColumns=True), ["copies", "repeated"])
    leaves = stored(repeats(suffixes(asked, size, gram, crowded, n_bins), size), "leaves")
    return blocks.with_answers(copied.unionByName(leaves, allowMissingColumns=True), ["copies", "leaves"])


def _bounds(block: Block, gone: np.ndarray):
    """(document, first and last word, words removed) of every document."""
    total = np.zeros(len(gone) + 1, np.int64)
    np.cumsum(gone, out=total[1:])
    for d in range(len(block.ids)):
        a, b = block.first[d], block.first[d + 1]
        yield d, a, b, int(total[b] - total[a])


def digests(docs: DataFrame, size: int = SIZE, block_bytes: int = packing.BLOCK_BYTES, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """doc_id, n_words, n_removed, and the SHA-256 of the kept words, joined by one space."""
    docs = docs.select("doc_id", "text")

    def run(row):
        block = Block(row, size)
        gone = block.removed_words(row["leaves"] or [])
        removed, shas = [], []
        for d, a, b, n in _bounds(block, gone):
            kept = block.document(d).split()
            if n:
                kept = compress(kept, ~gone[a:b])
            removed.append(n)
            shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        columns = [words.id_column(block.ids), pa.array(np.diff(block.first)), pa.array(removed, pa.int64()), pa.array(shas, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    blocks = settled(docs, size, block_bytes, group_suffixes)
    return blocks.without_rest().map(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame, size: int = SIZE, block_bytes: int = packing.BLOCK_BYTES, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """`docs` without the repeated words; each run of them goes up to the next kept word.

    `n_chars`, where there is such a column, is counted anew for changed texts. A null text
    comes out empty.
    """
    names = docs.columns

    def run(row):
        block = Block(row, size)
        gone = block.removed_words(row["leaves"] or [])
        table = packing.from_ipc(row["rest"])
        texts, changed = [], np.zeros(len(block.ids), bool)
        for d, a, b, n in _bounds(block, gone):
            whole = block.document(d)
            if n:
                changed[d] = True
                start = block.words.start[a:b] - block.offsets[d]
                cut = gone[a:b]
                turns = np.flatnonzero(np.diff(np.r_[False, cut, False].astype(np.int8)))
                begin, end = turns[::2], turns[1::2]
                stops = np.r_[start, len(whole)]
                edges = np.r_[0, np.c_[start[begin], stops[end]].ravel(), len(whole)]
                whole = b"".join(whole[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
            texts.append(whole.decode())
        columns = {**{c: table[c] for c in table.column_names}, "text": pa.array(texts, pa.string())}
        if "n_chars" in columns:
            kind = columns["n_chars"].type
            lengths = pa.array(list(map(len, texts)), pa.int64()).cast(kind)
            columns["n_chars"] = pc.if_else(pa.array(changed), lengths, columns["n_chars"].combine_chunks())
        yield from pa.table({c: columns[c] for c in names}).combine_chunks().to_batches()

    return settled(docs, size, block_bytes, group_suffixes).map(run, docs.schema)
