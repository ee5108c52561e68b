"""How the filters of a corpus interact: what each removes in every order of applying them.

A document fails some of five filters; its truth table is a 32-bit word, in which bit S tells
whether it survives the filters of the subset S. Counts of survivors of all subsets are the
positional population counts of the words: carry-save adders fold the words of a task's batch
three to two, bit position by bit position, until a few are left to count. Every order of
filters is then a walk through 32 numbers, for each part of the corpus and each label.

Null texts are empty ones, null sources are the part ''. A document without an id has no label
and counts as larger than all ids, so that it repeats every equal text with an id, but not another
without one. Repeated rows count each; labels that disagree about an id count as set where
one of them is. Texts of any length are read whole. Without documents there are no rows.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import text as words
from loanloom.llm.session import ship_package, stored

FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
SUBSETS = 1 << len(FILTERS)
#: The word of a document by the set of filters that it fails.
SURVIVES = [sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)]
#: Fixed values of the filters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, MARKS = 200, 50, 2, b"#$%&*|"

_capital = np.zeros(256, bool)
_capital[65:91] = True
_mark = np.zeros(256, bool)
_mark[list(MARKS)] = True
_leads = (np.arange(256) & 0xC0) != 0x80


def failures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The filters A to D that each text fails, as bits."""

    def counted(table: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=sums[1:])
        return np.diff(sums[offsets])

    found = words.words(data, offsets)
    codes, n, distinct = found.codes(), np.diff(found.first), np.zeros(len(offsets) - 1, np.int64)
    for k in np.flatnonzero(n):
        own = np.sort(codes[found.first[k] : found.first[k + 1]])
        distinct[k] = 1 + np.count_nonzero(own[1:] != own[:-1])
    short = n < LEAST_WORDS
    repetitive = 100 * distinct < LEAST_DISTINCT * n
    shouting = 100 * counted(_capital) > MOST_CAPITALS * counted(_leads)
    return short + 2 * repetitive + 4 * shouting + 8 * (counted(_mark) > 0)


def signals(docs: DataFrame) -> DataFrame:
    """doc_id, part, the filters A to D that the whole text fails, and 128 bits of the text."""

    def run(batches):
        for batch in batches:
            data, offsets = words.as_bytes(batch["text"])
            for a, b in words.pieces(data, offsets):
                own = offsets[a : b + 1] - offsets[a]
                body = data[offsets[a] : offsets[b]]
                digests = [hashlib.blake2b(body[x:y], digest_size=16).digest() for x, y in zip(own[:-1], own[1:], strict=True)]
                failed = pa.array(failures(body, own), pa.int32())
                ids, part = batch["doc_id"].slice(a, b - a), batch["part"].slice(a, b - a)
                yield pa.RecordBatch.from_arrays([ids, part, failed, pa.array(digests, pa.binary())], ["doc_id", "part", "failed", "digest"])

    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("part"), "text")
    return rows.mapInArrow(run, "doc_id long, part string, failed int, digest binary")


def survival(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, good, toxic and the word of every document.

    Only the first document of a text survives E: the pair of id and text is looked up in
    the table of least ids, so a text with very many copies is spread by their ids.
    """
    rows = stored(signals(docs), "signals")
    firsts = rows.groupBy(F.col("digest").alias("_digest")).agg(F.min("doc_id").alias("_least")).withColumn("_first", F.lit(True))
    same = F.col("doc_id").eqNullSafe(F.col("_least")) & (F.col("digest") == F.col("_digest"))
    rows = rows.join(firsts, same, "left")
    failed = F.col("failed") + F.when(F.col("_first"), 0).otherwise(REPEATED)
    rows = rows.select("doc_id", "part", F.get(F.array(*map(F.lit, SURVIVES)), failed).cast("long").alias("word"))
    marks = [F.coalesce(F.bool_or(F.col(c) == 1), F.lit(False)).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))]
    flags = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(*marks)
    # a written table: should documents repeat an id very often, Spark splits the join there
    flags = stored(flags, "flags")
    named = rows.filter("doc_id IS NOT NULL").join(flags, F.col("doc_id") == F.col("_id"), "left")
    nameless = rows.filter("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    known = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return named.select("part", *known, "word").unionByName(nameless.drop("doc_id"))


def positional_counts(found: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set, lowest first."""
    planes, out = [found.astype(np.uint32)], np.zeros(32, np.int64)
    weight = 0
    while weight < len(planes):
        plane = planes[weight]
        while (third := len(plane) // 3) > 0:
            a, b, c = plane[:third], plane[third : 2 * third], plane[2 * third : 3 * third]
            either = a ^ b
            carry = (a & b) | (either & c)
            plane = np.concatenate([either ^ c, plane[3 * third :]])
            if weight + 1 == len(planes):
                planes.append(carry)
            else:
                planes[weight + 1] = np.concatenate([planes[weight + 1], carry])
        for word in plane:  # two at most
            out += ((int(word) >> np.arange(32)) & 1) << weight
        weight += 1
    return out


def survivors(rows: DataFrame) -> DataFrame:
    """part and n: survivors of each of the 32 subsets, of all documents, good and toxic ones.

    Batches are folded to 96 numbers a part where they are; only those are shuffled.
    """

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch["part"].dictionary_encode()
            good, toxic = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("good", "toxic"))
            key = coded.indices.to_numpy().astype(np.int64) * 4 + 2 * good + toxic
            order = np.argsort(key, kind="stable")
            word, key = batch["word"].to_numpy()[order], key[order]
            counts = np.zeros((len(coded.dictionary), 3, SUBSETS), np.int64)
            edges = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part, label = divmod(int(key[a]), 4)
                found = positional_counts(word[a:b])
                counts[part, 0] += found
                counts[part, 1] += found * (label // 2)
                counts[part, 2] += found * (label % 2)
            flat = pa.array(counts.reshape(-1))
            lists = pa.FixedSizeListArray.from_arrays(flat, 3 * SUBSETS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([coded.dictionary, lists], ["part", "n"])

    folded = rows.mapInArrow(run, "part string, n array<long>")
    sums = [F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(3 * SUBSETS)]
    return folded.groupBy("part").agg(*sums).select("part", F.array(*[f"n{k}" for k in range(3 * SUBSETS)]).alias("n"))


def orders(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the survivors of the subsets."""
    steps = [(o, k) for o in map("".join, permutations(FILTERS)) for k in range(1, len(FILTERS) + 1)]
    which = np.array([FILTERS.index(o[k - 1]) for o, k in steps])
    before = np.array([sum(1 << FILTERS.index(f) for f in o[: k - 1]) for o, k in steps])
    after, alone, every = before | 1 << which, 1 << which, SUBSETS - 1
    names = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                n, good, toxic = np.array(batch["n"][row].as_py()).reshape(3, SUBSETS)
                removed = n[before] - n[after]
                sums = np.zeros(len(FILTERS), np.int64)
                np.add.at(sums, which, removed)
                lost = (n[0] - n[alone] - removed, n[every ^ alone] - n[every], good[before] - good[after], toxic[before] - toxic[after])
                numbers = [pa.array(x, pa.int64()) for x in (n[after], removed, *lost, sums[which])]
                part = pa.array([batch["part"][row].as_py()] * len(steps), pa.string())
                place = [pa.array([o for o, _ in steps]), pa.array([k for _, k in steps], pa.int32())]
                yield pa.RecordBatch.from_arrays([part, *place, *numbers], ["part", "filter_order", "step", *names])

    return counts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What every filter keeps and removes, at each step of every order, for each part."""
    return orders(survivors(survival(docs, labels)))
