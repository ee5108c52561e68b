"""Toxicity scores by a factorization machine over hashed terms.

Terms are words, runs of letters in lower case, and their first four and five bytes, which
generalise to unseen forms. Every term has a weight and a vector; the score of a text is the
logistic of the bias, the weights of its terms and the products of all pairs of
their vectors, so that two terms may mean together what neither means alone. The sum over pairs
takes one pass: half of the squared sum less the sum of squares. Only terms take part whose
share of toxic texts is further from the overall share than chance explains; weights with
little evidence stay 0 (follow the regularised leader), so that long texts gather no noise.

The model is fitted on about FIT_ROWS labelled rows, chosen by a hash of the id; the rows
whose CRC-32 of the id as text is 2 modulo 4 are never among them. It has 2 ** BITS weights and
vectors whatever the corpus, and is applied to whole texts. Labels, languages, sources and ids
are not inputs.

Null and empty texts have the bias alone as their score. A null label is no label; a null id
counts as the empty text and cannot be labelled. Without labels of both kinds the
score is the share of toxic labels, or 0. Every row gives one row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm import text as words
from loanloom.llm.session import sampled, ship_package, stored

BITS, FACTORS = 18, 4
#: Bytes of text whose terms are sorted at a time.
PIECE_BYTES = 500_000
#: Labelled rows that a model is fitted on, about, and about how many bytes their terms may have on
#: the driver; texts of any length take part, very long ones make it fewer rows.
FIT_ROWS, FIT_BYTES = 12_000, 256_000_000
#: A term is used if it is in so many labelled texts, and its toxic ones miss their expected
#: number by more than so many standard deviations and one text.
LEAST_TEXTS, DEVIATIONS = 3, 3.0
#: Passes over the rows, rows of a step; rate and penalties of the weights, rate and decay of the vectors.
PASSES, BATCH, RATE, L1, L2, VECTOR_RATE, DECAY = 6, 32, 0.5, 0.5, 0.5, 2e-2, 1e-4
PREFIXES = (4, 5)
TOXIC = 0.3

_letters = np.zeros(256, bool)
_letters[97:123] = True
_letters[128:] = True


def held_out(id_column: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) of every term that occurs in a text, in the order of both."""
    found = words.words(data, offsets, part=_letters)
    doc, out = found.text_of_word().astype(np.int64) << BITS, []
    for kind, codes in enumerate(found.codes(*PREFIXES)):
        out.append(doc | (words.mix(codes + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int64))
    pairs = np.unique(np.concatenate(out))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    known: np.ndarray

    def scores(self, text: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """The probability of label 1 for texts 0 .. n - 1."""
        use = self.known[term]
        text, term = text[use], term[use]
        total = self.bias + np.bincount(text, self.weight[term], n)
        for f in self.factor.T:
            v = f[term]
            total += 0.5 * (np.bincount(text, v, n) ** 2 - np.bincount(text, v * v, n))
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def telling(term_lists: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """True for the terms that tell toxic texts from others."""
    size, share = 1 << BITS, labels.mean()
    counts, toxic = np.zeros(size), np.zeros(size)
    for x, label in zip(term_lists, labels, strict=True):
        counts[x] += 1
        toxic[x] += label
    usual = counts * share
    return (counts >= LEAST_TEXTS) & (np.abs(toxic - usual) > DEVIATIONS * np.sqrt(usual * (1 - share)) + 1)


def fit(term_lists: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> Machine:
    """Logistic loss; weights by the proximal leader, vectors by steps with rates of their own."""
    size = 1 << BITS
    weight, factor = np.zeros(size), np.zeros((size, FACTORS))
    share = float(labels.mean()) if len(labels) else 0.0
    if not 0 < share < 1:
        return Machine(60.0 if share else -60.0, weight, factor, np.zeros(size, bool))
    random, bias = np.random.default_rng(seed), float(np.log(share / (1 - share)))
    known = telling(term_lists, labels)
    term_lists = [x[known[x]] for x in term_lists]
    factor[known] = random.normal(0, 0.01, (int(known.sum()), FACTORS))
    pull, sum_w, sum_v = np.zeros(size), np.zeros(size), np.full((size, FACTORS), 1e-2)
    for _ in range(PASSES):
        order = random.permutation(len(labels))
        for a in range(0, len(order), BATCH):
            rows = order[a : a + BATCH]
            lists = [term_lists[r] for r in rows]
            term, text = np.concatenate(lists), np.repeat(np.arange(len(rows)), [len(x) for x in lists])
            v = factor[term]
            sums = np.stack([np.bincount(text, v[:, f], len(rows)) for f in range(FACTORS)], 1)
            pairs = 0.5 * ((sums**2).sum(1) - np.bincount(text, (v * v).sum(1), len(rows)))
            total = bias + np.bincount(text, weight[term], len(rows)) + pairs
            error = 1 / (1 + np.exp(-np.clip(total, -60, 60))) - labels[rows]
            used, place = np.unique(term, return_inverse=True)
            slope = np.bincount(place, error[text], len(used))
            grown = np.sqrt(sum_w[used] + slope**2)
            pull[used] += slope - (grown - np.sqrt(sum_w[used])) / RATE * weight[used]
            sum_w[used] += slope**2
            beyond = np.sign(pull[used]) * np.maximum(np.abs(pull[used]) - L1, 0)
            weight[used] = -beyond / ((1 + grown) / RATE + L2)
            slopes = error[text][:, None] * (sums[text] - v)
            slopes = np.stack([np.bincount(place, slopes[:, f], len(used)) for f in range(FACTORS)], 1) + DECAY * factor[used]
            sum_v[used] += slopes**2
            factor[used] -= VECTOR_RATE * slopes / np.sqrt(sum_v[used])
    return Machine(bias, weight.astype(np.float32), factor.astype(np.float32), known)


def sample(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS, size: int = FIT_BYTES) -> tuple[list[np.ndarray], np.ndarray]:
    """Terms and labels of about `limit` labelled whole texts; of fewer, chosen by a hash of the id,
    where their terms would have more than `size` bytes."""
    usable = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("label")).filter("label IN (0, 1) AND _id IS NOT NULL")
    usable = sampled(usable.filter(~held_out(F.col("_id"))), limit, "_id")
    joined = docs.select("doc_id", F.lower("text").alias("text")).join(F.broadcast(usable), F.col("doc_id") == F.col("_id"))
    joined = joined.select("doc_id", "text", "label")

    def run(batches):
        for batch in batches:
            data, offsets = words.as_bytes(batch["text"])
            for a, b in words.pieces(data, offsets, PIECE_BYTES):
                text, term = terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                edges = np.searchsorted(text, np.arange(b - a + 1))
                lists = [term[x:y].astype(np.int32).tobytes() for x, y in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), batch["label"].slice(a, b - a), pa.array(lists, pa.binary())], ["doc_id", "label", "terms"])

    # one row for each id and label, whatever repeats
    found = joined.mapInArrow(run, "doc_id long, label int, terms binary").groupBy("doc_id", "label").agg(F.min("terms").alias("terms"))
    found = stored(found, "toxicity-terms")
    held = found.agg(F.sum(F.octet_length("terms"))).first()[0] or 0
    if held > size:
        place = F.shiftrightunsigned(F.xxhash64(F.lit("fit"), "doc_id"), 11).cast("double") / float(2**53)
        found = found.filter(place < size / held)
    rows = found.toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    return [np.frombuffer(x, np.int32) for x in rows["terms"].to_pylist()], np.array(rows["label"].to_pylist(), float)


def score(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    ship_package(docs.sparkSession)
    machine = fit(*sample(docs, labels, limit))

    def run(batches):
        for batch in batches:
            data, offsets = words.as_bytes(batch["text"])
            for a, b in words.pieces(data, offsets, PIECE_BYTES):
                found = machine.scores(*terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), b - a)
                columns = [batch[c].slice(a, b - a) for c in ("doc_id", "held_out")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found), pa.array((found >= TOXIC).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.lower("text").alias("text"))
    return docs.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
