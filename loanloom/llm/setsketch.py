"""MinHash near-dedup with SetSketch registers.

A document's set are its distinct shingles of five words, lower-cased A-Z. Each shingle starts
a Poisson process whose points fall on random registers; a register keeps the smallest
point, as the truncated logarithm floor(1 - log_b x) to a base b near 1. Registers of unions are
maxima of registers, and equal registers are as likely as sets are similar.

1. Documents with equal sets are one class, found by a digest; its smallest row stands for it.
2. Bands of registers put the classes into buckets. Each is paired with its bucket's smallest.
3. Pairs go on if their sizes allow the link and the likelihood of their registers, taken
   jointly over larger, smaller and equal ones, peaks near it or above.
4. The survivors are compared on full sets: one side's set travels, once for each block.
5. Where a bucket still holds several components, all its pairs across components are
   compared on full sets, chunk by chunk, so that no link is lost to step 2.

Shingles are 64-bit hashes. Null, empty and blank texts have an empty set and no links; with fewer
than five words the whole sequence is the only shingle. Repeated rows are in one class. A null
id is larger than all others; a component of rows without ids has a null id. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import blocks as packing
from loanloom.llm import text as words
from loanloom.llm.components import components
from loanloom.llm.session import stored

SHINGLE = 5
#: Links have 100 * intersection >= link * union; this is the link of the query.
LINK = 85
#: Bands and registers of a band: a pair at the threshold shares no band with probability 4e-7 (5e-5 at 80).
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Base and rate of the registers, and their largest value.
BASE, RATE, LARGEST = 1.001, 20.0, 65_535
#: Estimates miss by 0.16, five standard deviations of 125 registers, in 3 cases of 10 million.
MARGIN = 0.16
#: Classes of a bucket that are compared with each other at a time, and shared elements.
CHUNK, COLUMNS = 256, 8_192
#: Bytes of text whose shingles are made, and drawn from, at a time; one longer text is a piece of its own.
PIECE = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Sets:
    """The sets of a block's documents, one after the other, each sorted."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        data, offsets = np.frombuffer(row["text"], np.uint8), np.frombuffer(row["offsets"], np.int64)
        self.pieces = list(words.pieces(data, offsets, PIECE))
        found = [self._shingles(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]) for at, to in self.pieces]
        self.element = np.concatenate([np.zeros(0, np.uint64), *(element for element, _ in found)])
        self.doc = np.concatenate([np.zeros(0, np.int64), *(doc + at for (_, doc), (at, _) in zip(found, self.pieces, strict=True))])
        self.first = np.searchsorted(self.doc, np.arange(len(self.ids) + 1))
        self.sizes = np.diff(self.first)

    @staticmethod
    def _shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct shingles of every text, sorted, and the texts they are of."""
        found = words.words(data, offsets, lower=True)
        codes, lengths = found.codes(), np.diff(found.first)
        hashes = words.window_hashes(codes, SHINGLE)
        at = np.flatnonzero(words.window_starts(found.first, SHINGLE, len(hashes)))
        element, doc = hashes[at], found.text_of_word()[at]
        for n in range(1, SHINGLE):  # whole sequences
            short = np.flatnonzero(lengths == n)
            whole = words.window_hashes(codes, n)[found.first[short]] if len(short) else np.zeros(0, np.uint64)
            element, doc = np.r_[element, words.mix(whole + np.uint64(n))], np.r_[doc, short]
        order = np.lexsort((element, doc))
        element, doc = element[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (element[1:] != element[:-1]) | (doc[1:] != doc[:-1])
        return element[new], doc[new]

    def of(self, d: int) -> np.ndarray:
        return self.element[self.first[d] : self.first[d + 1]]

    def digests(self) -> list[np.ndarray]:
        out = []
        for seed in (0x3C79AC49, 0x1B873593):
            sums = np.zeros(len(self.element) + 1, np.uint64)
            np.cumsum(words.mix(self.element + np.uint64(seed)), out=sums[1:])
            out.append(words.mix(sums[self.first[1:]] - sums[self.first[:-1]] + self.sizes.astype(np.uint64)))
        return out

    def registers(self) -> np.ndarray:
        """A row of registers for each document."""
        parts = [self._drawn(at, to) for at, to in self.pieces]
        return np.concatenate([np.zeros((0, REGISTERS), np.uint16), *parts])

    def _drawn(self, at: int, to: int) -> np.ndarray:
        """The registers of the documents from `at` up to `to`."""
        least = np.full((to - at, REGISTERS), np.inf)
        flat, own = least.reshape(-1), slice(self.first[at], self.first[to])
        element, doc, j = self.element[own], self.doc[own] - at, 0
        x = np.zeros(len(element))
        while len(element):
            many = 1 if j < 6 else 32  # later only few shingles, of small sets, go on
            drawn = words.mix(element[:, None] + _STEP * np.arange(j + 1, j + many + 1, dtype=np.uint64))
            points = x[:, None] + np.cumsum(-np.log(((drawn >> np.uint64(11)) + 0.5) * 2.0**-53), axis=1) / (REGISTERS * RATE)
            place = ((words.mix(drawn ^ _STEP) >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(flat, doc[:, None] * REGISTERS + place, points)
            j += many
            more = points[:, -1] < least.max(axis=1)[doc]  # a later point could still be a minimum
            element, doc, x = element[more], doc[more], points[more, -1]
        with np.errstate(divide="ignore"):
            values = np.floor(1 - np.log(least) / np.log(BASE))
        return np.clip(values, 0, LARGEST).astype(np.uint16)


def likeliest(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity of largest joint likelihood, from registers (rows) and sizes of sets."""
    more, fewer = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - fewer
    u = n_a / (n_a + n_b)
    v = 1 - u

    def share(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def log(count, p):
        return np.where(count > 0, count * np.log(np.maximum(p, 1e-300)), 0.0)

    def likelihood(j):
        p, q = share(np.maximum(u - v * j, 0)), share(np.maximum(v - u * j, 0))
        return log(more, p) + log(fewer, q) + log(same, 1 - p - q)

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):  # the likelihood is concave
        third = (high - low) / 3
        left = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def sketches(blocks: packing.Blocks) -> DataFrame:
    """row, id, n, the digest a, b and the registers of every document; no registers for empty sets."""

    def run(block):
        sets = Sets(block)
        a, b = sets.digests()
        registers = sets.registers()
        some = sets.sizes > 0
        rows = (block["block"] << packing.PLACE_BITS) + np.arange(len(sets.ids))
        columns = [pa.array(rows), pa.array(sets.ids), pa.array(sets.sizes, pa.int64())]
        columns += [pa.array(x.view(np.int64), mask=~some) for x in (a, b)]
        columns.append(pa.array([r.tobytes() if s else None for r, s in zip(registers, some, strict=True)], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, ["row", "id", "n", "a", "b", "registers"])

    return blocks.without_rest().map(run, "row long, id long, n long, a long, b long, registers binary")


def _register_rows(column) -> np.ndarray:
    data, _ = words.as_bytes(column)
    return data.view(np.uint16).reshape(-1, REGISTERS)


def _numbers(column) -> np.ndarray:
    return np.asarray(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)


def band_rows(classes: DataFrame) -> DataFrame:
    """key and row: the buckets of every class."""

    def run(batches):
        for batch in batches:
            registers = _register_rows(batch["registers"]).astype(np.uint64)
            key = np.tile(words.mix(np.arange(BANDS, dtype=np.uint64)), (len(registers), 1))
            for k in range(ROWS):
                key = words.mix(key + registers[:, k::ROWS])
            rows = np.repeat(_numbers(batch["row"]), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(rows)], ["key", "row"])

    return classes.select("row", "registers").mapInArrow(run, "key long, row long")


def likely(pairs: DataFrame, classes: DataFrame, link: int) -> DataFrame:
    """The pairs (u, v) that can be links by size and by likelihood."""
    left, right = (classes.select(F.col("row").alias(f"_{x}"), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}")) for x in "uv")
    allowed = F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * link
    both = pairs.join(left, F.col("u") == F.col("_u")).join(right, F.col("v") == F.col("_v")).filter(allowed)

    def run(batches):
        for batch in batches:
            n_u, n_v = (_numbers(batch[c]) for c in ("n_u", "n_v"))
            found = likeliest(_register_rows(batch["r_u"]), _register_rows(batch["r_v"]), n_u, n_v)
            keep = pa.array(found >= link / 100 - MARGIN)
            yield pa.RecordBatch.from_arrays([batch[c].filter(keep) for c in "uv"], ["u", "v"])

    return both.select("u", "v", "n_u", "n_v", "r_u", "r_v").mapInArrow(run, "u long, v long")


def sets_of(rows: DataFrame, blocks: packing.Blocks) -> DataFrame:
    """_row and the full set of the given rows, read from their blocks."""
    bits = packing.PLACE_BITS

    def read(block):
        if block["row"]:
            sets, at = Sets(block), np.array(block["row"])
            found = [sets.of(r - (block["block"] << bits)).tobytes() for r in at]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found, pa.binary())], ["_row", "set"])

    asked = rows.select("row").distinct().select(F.shiftright("row", bits).alias("block"), "row")
    return blocks.without_rest().with_answers(asked, ["row"]).map(read, "_row long, set binary")


def verified(pairs: DataFrame, blocks: packing.Blocks, link: int) -> DataFrame:
    """The pairs (u, v) whose full sets make a link.

    The sets of the v's are read from their blocks and sent to the blocks of the u's, once
    for each block and v.
    """
    bits = packing.PLACE_BITS
    found = sets_of(pairs.select(F.col("v").alias("row")), blocks)
    by_block = pairs.groupBy(F.shiftright("u", bits).alias("block"), "v").agg(F.collect_list("u").alias("u"))
    sent = by_block.join(found, F.col("v") == F.col("_row")).select("block", F.struct("v", "u", "set").alias("ask"))

    def compare(block):
        if not block["ask"]:
            return
        sets, out = Sets(block), []
        for ask in block["ask"]:
            other = np.frombuffer(ask["set"], np.uint64)
            for u in ask["u"]:
                own = sets.of(u - (block["block"] << bits))
                common = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * common >= link * (len(own) + len(other) - common):
                    out.append((u, ask["v"]))
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["u", "v"])

    return blocks.without_rest().with_answers(sent, ["ask"]).map(compare, "u long, v long")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, on the shared elements."""
    element = np.concatenate([*left, *right])
    sets = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    _, column, times = np.unique(element, return_inverse=True, return_counts=True)
    use = times[column] > 1
    column = (np.cumsum(times > 1) - 1)[column[use]]
    out, rows, n = np.zeros((len(left), len(right)), np.float32), sets[use], int((times > 1).sum())
    for a in range(0, n, COLUMNS):
        part = (column >= a) & (column < a + COLUMNS)
        matrix = np.zeros((len(left) + len(right), min(COLUMNS, n - a)), np.float32)
        matrix[rows[part], column[part] - a] = 1
        out += matrix[: len(left)] @ matrix[len(left) :].T
    return out.astype(np.int64)


def links_across(members: DataFrame, labels: DataFrame, blocks: packing.Blocks, chunk: int, link: int) -> DataFrame:
    """Links (u, v) across components inside buckets of three or more classes that hold several
    components, as many as join them.

    `members` has key, row, hub and the bucket's size. Pairs with the hub were settled
    before; all others are compared on full sets, chunk by chunk.
    """
    known = members.filter("size > 2").join(labels, F.col("row") == F.col("node"), "left")
    known = known.withColumn("label", F.coalesce("label", "row")).drop("node")
    mixed = known.groupBy(F.col("key").alias("_key")).agg(F.min("label").alias("_l"), F.max("label").alias("_m"), F.min("size").alias("_size"))
    rows = known.filter("row <> hub").join(mixed.filter("_l < _m"), F.col("key") == F.col("_key"))
    rows = stored(rows.select("key", "row", "label", F.ceil(F.col("_size") / chunk).cast("int").alias("chunks")), "mixed-buckets")
    found = stored(sets_of(rows, blocks), "sets", packing.ONE_BLOCK)
    rows = rows.withColumn("c", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("d", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("key", "row", "label", "c", F.least("c", "d").alias("i"), F.greatest("c", "d").alias("j"))
    rows = rows.join(found, F.col("row") == F.col("_row")).drop("_row")

    def run(table):
        row, label, c = (_numbers(table[x]) for x in ("row", "label", "c"))
        sets = [np.frombuffer(x, np.uint64) for x in table["set"].to_pylist()]
        i, j = _numbers(table["i"])[0], _numbers(table["j"])[0]
        left, right = np.flatnonzero(c == i), np.flatnonzero(c == j)
        u, v = [], []
        if len(np.unique(label)) > 1 and len(left) and len(right):
            common = common_counts([sets[x] for x in left], [sets[x] for x in right])
            sizes = np.array([len(x) for x in sets])
            linked = 100 * common >= link * (sizes[left][:, None] + sizes[right][None, :] - common)
            a, b = np.nonzero(linked & (label[left][:, None] != label[right][None, :]))
            joined = {}

            def root(x):
                while (up := joined.get(x, x)) != x:
                    x = up
                return x

            for x, y in zip(left[a], right[b], strict=True):
                p, q = root(label[x]), root(label[y])
                if p != q:  # otherwise the components are joined already
                    joined[p] = q
                    u.append(row[x])
                    v.append(row[y])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return rows.groupBy("key", "i", "j").applyInArrow(run, "u long, v long").distinct()


def grouped(blocks: packing.Blocks, chunk: int = CHUNK, link: int = LINK) -> DataFrame:
    """row, id, n, component (its smallest id) and first (its first row) of every document."""
    everything = stored(sketches(blocks), "sketches", packing.ONE_BLOCK)
    some = everything.filter("n > 0")
    smallest = some.groupBy(F.col("a").alias("_a"), F.col("b").alias("_b")).agg(F.min(F.struct("id", "row")).alias("_first"))
    of_class = some.drop("registers").join(smallest, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")))
    of_class = stored(of_class.select("row", F.col("_first.row").alias("class"), F.col("_first.id").alias("class_id")), "classes")
    heads = of_class.filter("row = class").select(F.col("row").alias("_row"))
    classes = stored(some.join(heads, F.col("row") == F.col("_row")).select("row", "n", "registers"), "class-registers")

    bands = stored(band_rows(classes), "bands")
    buckets = bands.groupBy(F.col("key").alias("_key")).agg(F.min("row").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stored(bands.join(buckets, F.col("key") == F.col("_key")).drop("_key"), "buckets")
    pairs = members.filter("row <> hub").select(F.col("row").alias("u"), F.col("hub").alias("v")).distinct()
    links = stored(verified(stored(likely(pairs, classes, link), "pairs"), blocks, link), "links", packing.ONE_BLOCK)
    labels = stored(components(links), "labels")
    more = stored(links_across(members, labels, blocks, chunk, link), "more-links")
    if not more.isEmpty():
        labels = stored(components(links.unionByName(more)), "labels")

    label = labels.select("node", "label")
    of_class = of_class.join(label, F.col("class") == F.col("node"), "left").withColumn("label", F.coalesce("label", "class"))
    of_class = stored(of_class.select("row", "class", "class_id", "label"), "members")
    first = of_class.groupBy(F.col("label").alias("_label")).agg(F.min(F.struct("class_id", "class")).alias("_first"))
    of_class = of_class.join(first, F.col("label") == F.col("_label"))
    of_class = of_class.select(F.col("row").alias("_row"), F.col("_first.class_id").alias("component"), F.col("_first.class").alias("first"))
    found = everything.select("row", "id", "n").join(of_class, F.col("row") == F.col("_row"), "left").drop("_row")
    return found.withColumns({"component": F.coalesce("component", "id"), "first": F.coalesce("first", "row")})


def near_duplicates(docs: DataFrame, block_bytes: int = packing.BLOCK_BYTES, chunk: int = CHUNK, link: int = LINK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    found = grouped(packing.pack(docs.select("doc_id", "text"), size=block_bytes), chunk, link)

    def known(name):
        return F.when(F.col(name) != words.NO_ID, F.col(name))

    kept = F.when(F.col("id") == words.NO_ID, F.col("row") == F.col("first")).otherwise(F.col("id") == F.col("component"))
    return found.select(known("id").alias("doc_id"), F.col("n").alias("n_shingles"), known("component").alias("component_id"), kept.alias("kept"))


def deduplicated(docs: DataFrame, block_bytes: int = packing.BLOCK_BYTES, chunk: int = CHUNK, link: int = LINK) -> DataFrame:
    """One row of `docs` for each component: the first of its smallest id. A null text comes out empty."""
    blocks = packing.pack(docs, size=block_bytes)
    bits = packing.PLACE_BITS
    first = grouped(blocks, chunk, link).filter("row = first").select(F.shiftright("row", bits).alias("block"), "row")
    names = docs.columns

    def run(block):
        if block["row"]:
            places = np.sort(np.array(block["row"]) - (block["block"] << bits))
            table = packing.from_ipc(block["rest"])
            offsets = np.frombuffer(block["offsets"], np.int64)
            texts = [block["text"][offsets[d] : offsets[d + 1]].decode() for d in places]
            table = table.take(pa.array(places)).append_column("text", pa.array(texts, pa.string()))
            yield from table.select(names).combine_chunks().to_batches()

    return blocks.with_answers(stored(first, "kept"), ["row"]).map(run, docs.schema)
