"""A hidden Markov language model, trained by Baum-Welch counts from all partitions.

A token is a lower-cased word or the end of a text. In training, words fall into SYMBOLS buckets by
the hash and hidden states emit buckets; that is all the driver holds of the model, whatever the
corpus. A last pass then counts the states of every word, 8 numbers each, which stay in Spark and
are sent to the blocks of documents that ask for them, once for each block and word. A word of c
occurrences, E of them in a state, has (c + 1) * (E + BACK_OFF * bucket's share) / (c + BACK_OFF) there;
an unknown word has one by its bucket's shares. States that tell nothing apart would thus give the
add-one unigram model. Shares are sent as 8-bit numbers, right to 2 %; what is scored with adds up to 1 as it is sent.

Training starts from fixed noise around the counts of all training documents. Every Baum-Welch
pass reads all of them, every word of every text, until the likelihood gains less than TOLERANCE or
after PASSES; after every two the model is moved on along their path (squared extrapolation).
Posteriors and likelihoods of a text are those of the whole text, by the scaled recursions, in single
precision for training and in double for scores; long texts are cut into segments whose transfer matrices are chained in both
directions.

Null texts count as empty: one end, no words. Training documents are those whose CRC-32 of
the id as text is not 2 modulo 7, a null id as the empty text. Every row gives one row. Without
training documents all words are unknown.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import blocks as packing
from loanloom.llm import text as words
from loanloom.llm.session import ship_package, stored

STATES, SYMBOL_BITS = 8, 12
SYMBOLS = 1 << SYMBOL_BITS
END = SYMBOLS
#: Words of a segment, words that are handled at once in training, and words whose segments are put in order
#: together: the more, the fewer short steps over the longest texts.
SEGMENT, TOKENS, ORDERED = 2048, 1 << 20, 1 << 21
#: Most passes over all training documents, and the least share of the log-likelihood that a pass gains.
PASSES, TOLERANCE = 10, 1e-4
#: Most times the length of a pass that a model is moved on.
FARTHEST = 8.0
#: Occurrences that a bucket's shares of the states count for in those of its words.
BACK_OFF = 1.0
#: Larger blocks have fewer distinct words in all.
BLOCK_BYTES = 8_000_000
#: Bytes of text that are taken apart at once, which the processor's cache can hold with their sums.
PIECE_BYTES = 250_000


def held_out(doc_id: int) -> bool:
    return zlib.crc32(b"" if doc_id == words.NO_ID else str(int(doc_id)).encode()) % 7 == 2


def symbols(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - SYMBOL_BITS)).astype(np.int64)


#: What blocks keep of their texts: where each one's words begin, the distinct word codes, sorted, and
#: the number of every word among them. Texts are taken apart once; no later pass needs them.
COLUMNS = ("first", "keys", "numbers")


def taken_apart(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """`COLUMNS` of texts. The bytes of the numbers lie by place, the lowest ones first, which packs better."""
    codes, lengths = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for a, b in words.pieces(data, offsets, PIECE_BYTES):
        found = words.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=True)
        codes.append(found.codes())
        lengths.append(np.diff(found.first))
    keys, numbers = np.unique(np.concatenate(codes), return_inverse=True)
    return np.cumsum(np.concatenate(lengths)).tobytes(), keys.tobytes(), numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


class Texts:
    """Distinct word codes, words as their numbers, and training flags of a block's documents."""

    def __init__(self, row: dict):
        self.ids, self.first = (np.frombuffer(row[c], np.int64) for c in ("ids", "first"))
        self.keys = np.frombuffer(row["keys"], np.uint64)
        self.numbers = np.ascontiguousarray(np.frombuffer(row["numbers"], np.uint8).reshape(4, -1).T).view("<u4")[:, 0].astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        self.held = np.array([held_out(i) for i in self.ids], bool)

    def training_counts(self) -> np.ndarray:
        """Occurrences of every distinct word in training documents."""
        return np.bincount(self.numbers[~self.held[self.doc]], minlength=len(self.keys)).astype(np.uint32)

    def sequences(self, docs: np.ndarray, labels: np.ndarray | None = None, end: int = END) -> tuple[np.ndarray, np.ndarray]:
        """Symbols (or `labels` of the words) of the chosen documents, each followed by an end, and where each begins."""
        labels = symbols(self.keys)[self.numbers] if labels is None else labels
        lengths = np.diff(self.first)[docs] + 1
        first = np.r_[0, np.cumsum(lengths)]
        out = np.full(first[-1], end)
        place = np.ones(first[-1], bool)
        place[first[1:] - 1] = False
        chosen = np.zeros(len(self.ids), bool)
        chosen[docs] = True
        out[place] = labels[chosen[self.doc]]
        return out, first


@dataclass
class Model:
    start: np.ndarray  # states
    step: np.ndarray  # states x states
    emit: np.ndarray  # (symbols + 1) x states

    def single(self) -> "Model":
        """The same in single precision, which halves the time of a pass."""
        return Model(*(x.astype(np.float32) for x in (self.start, self.step, self.emit)))

    def relative(self) -> tuple["Model", np.ndarray]:
        """With emissions divided by the largest of each symbol; the logarithms of these."""
        top = self.emit.max(1)
        return replace(self, emit=self.emit / top[:, None]), np.log(top.astype(np.float64))


@dataclass
class Counts:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray
    #: Natural logarithm of the probability of what was counted.
    log: float = 0.0

    @classmethod
    def zero(cls, states: int, size: int = SYMBOLS + 1) -> "Counts":
        return cls(np.zeros(states), np.zeros((states, states)), np.zeros((size, states)))

    def add(self, other: "Counts") -> None:
        self.start += other.start
        self.step += other.step
        self.emit += other.emit
        self.log += other.log

    def smoothed(self, unseen: np.ndarray) -> np.ndarray:
        """Emissions with `unseen` counts for the symbols, dealt to the states by their share of all tokens."""
        total = self.emit.sum()
        share = self.emit.sum(0) / total if total else np.full(len(self.start), 1 / len(self.start))
        return self.emit + np.maximum(share, 1e-9) * unseen[:, None]

    def model(self, unseen: np.ndarray) -> Model:
        """Parameters of largest likelihood, with one count more for every state and step."""
        start, step, emit = self.start + 1.0, self.step + 1.0, self.smoothed(unseen)
        return Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))


class Segments:
    """Sequences cut into segments, and the matrices that lead through all but the first of each.

    Numbers have the type of the model's. Vectors are normed every other step; between, a step
    leaves them the least step probability at least, as emissions are 1 in one state of the relative model.
    """

    def __init__(self, tokens: np.ndarray, first: np.ndarray, model: Model):
        self.tokens, self.model = tokens, model
        lengths = np.diff(first)
        n = -(-lengths // SEGMENT)
        self.seq = np.repeat(np.arange(len(lengths)), n)
        k = np.arange(len(self.seq)) - np.repeat(np.cumsum(n) - n, n)
        self.at = first[:-1][self.seq] + k * SEGMENT
        self.length = np.minimum(first[1:][self.seq] - self.at, SEGMENT)
        self.head, self.tail = np.flatnonzero(k == 0), np.flatnonzero(k > 0)
        states = len(model.start)
        self.rows, self.logs = self.run(self.tail, np.tile(model.step, (len(self.tail), 1, 1)))
        #: Normed forward vectors at the end of every segment that has a next one.
        self.forward = np.zeros((len(self.seq), states), model.step.dtype)

    def run(self, segments: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward vectors (segments, r, states) at the ends of segments, normed, and log10 of their norms."""
        order = np.argsort(-self.length[segments], kind="stable")
        at, length, rows = self.at[segments][order], self.length[segments][order], rows[order]
        logs, states = np.zeros(rows.shape[:2]), rows.shape[2]
        active = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), "left")
        step, emit, ones = self.model.step, self.model.emit, np.ones(states, rows.dtype)
        for t, many in enumerate(active):
            part = rows[:many]
            if t:
                part = (part.reshape(-1, states) @ step).reshape(part.shape)
            part *= emit.take(self.tokens[at[:many] + t], 0)[:, None, :]
            if t % 2 or t == len(active) - 1:
                scale = part @ ones  # faster than sums of short rows
                logs[:many] += np.log10(scale)
                part /= scale[:, :, None]
            rows[:many] = part
        scale = rows.sum(2)
        logs += np.log10(scale)
        rows /= scale[:, :, None]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return rows[back], logs[back]

    def onward(self, segments: np.ndarray) -> np.ndarray:
        """log10 of the probability of every sequence; `segments` are the first ones to run."""
        forward, logs = self.run(segments, np.tile(self.model.start, (len(segments), 1, 1)))
        self.forward[segments], out = forward[:, 0], np.zeros(self.seq[-1] + 1 if len(self.seq) else 0)
        out[self.seq[segments]] = logs[:, 0]
        for j, k in enumerate(self.tail):
            row = self.logs[j] + np.log10(np.maximum(self.forward[k - 1], 1e-37))
            top = row.max()
            vector = 10.0 ** (row - top) @ self.rows[j]
            out[self.seq[k]] += top + np.log10(vector.sum())
            self.forward[k] = vector / vector.sum()
        return out

    def backward(self) -> np.ndarray:
        """Backward vectors at the end of every segment, up to a factor."""
        out = np.ones((len(self.seq), len(self.model.start)))
        for j in range(len(self.tail) - 1, -1, -1):
            k = self.tail[j]
            vector = 10.0 ** (self.logs[j] - self.logs[j].max()) * (self.rows[j] @ out[k])
            out[k - 1] = vector / vector.sum()
        return out.astype(self.model.step.dtype)


def expected(tokens: np.ndarray, first: np.ndarray, model: Model, labels: np.ndarray | None = None, size: int = SYMBOLS + 1) -> Counts:
    """Baum-Welch counts of the sequences, with posteriors given the whole of each. Emissions are
    counted by symbol or by the `labels` below `size` of the tokens."""
    out = Counts.zero(len(model.start), size)
    labels = tokens if labels is None else labels
    relative, logs = model.relative()
    cut = Segments(tokens, first, relative)
    # sequences of one segment need no vectors from others
    cut.onward(cut.head[np.isin(cut.head + 1, cut.tail)])
    beta = cut.backward()
    order = np.argsort(-cut.length, kind="stable")
    # groups of bounded tokens, at least one segment each
    upto = np.cumsum(cut.length[order])
    edges = np.unique(np.r_[0, np.searchsorted(upto, np.arange(TOKENS, upto[-1] if len(upto) else 0, TOKENS)) + 1, len(order)])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        _expect(cut, order[a:b], beta, labels, out)
    out.log += logs @ np.bincount(tokens, minlength=len(logs))
    return out


def _expect(cut, segments, beyond, labels, out) -> None:
    """Adds the counts of segments, longest first; `beyond` are the backward vectors at their ends."""
    model, at, length = cut.model, cut.at[segments], cut.length[segments]
    steps, active = int(length[0]), np.searchsorted(-length, -np.arange(length[0]), "left")
    # rows in order of time: row[t] is the first of the tokens that are t-th in their segments
    row = np.r_[0, np.cumsum(active)]
    place = np.empty(row[-1], np.int64)
    for t in range(steps):
        np.add(at[: active[t]], t, out=place[row[t] : row[t + 1]])
    later = np.isin(segments, cut.tail)
    before = cut.forward[segments - 1]
    emitted = model.emit.take(cut.tokens[place], 0)
    alphas, scales = np.empty_like(emitted), {}
    ends, ones = np.diff(np.r_[active, 0]) < 0, np.ones(len(model.start), alphas.dtype)
    for t in range(steps):
        many, alpha = active[t], alphas[row[t] : row[t + 1]]
        if t:
            np.matmul(alphas[row[t - 1] : row[t - 1] + many], model.step, out=alpha)
        else:
            alpha[:] = np.where(later[:, None], before @ model.step, model.start)
        alpha *= emitted[row[t] : row[t + 1]]
        if t % 2:
            scales[t] = alpha @ ones  # faster than sums of short rows
            alpha /= scales[t][:, None]
            out.log += np.log(scales[t]).sum(dtype=np.float64)
        if ends[t]:
            out.log += np.log(alpha[active[t + 1] if t < steps - 1 else 0 :].sum(1)).sum(dtype=np.float64)
    # backward; posteriors take the place of the forward vectors
    many, beta, pairs = 0, np.zeros((0, len(model.start)), alphas.dtype), np.zeros_like(out.step)
    back = np.ascontiguousarray(model.step.T)
    for t in range(steps - 1, -1, -1):
        alpha = alphas[row[t] : row[t + 1]]
        if t < steps - 1:
            ahead = emitted[row[t + 1] : row[t + 2]]
            ahead *= beta
            if t + 1 in scales:
                ahead /= scales[t + 1][:, None]
            pairs += alpha[:many].T @ ahead
            beta = ahead @ back
        if active[t] > many:  # segments that end here
            last = beyond[segments[many : active[t]]]
            last = last / (alpha[many:] * last).sum(1, keepdims=True)
            beta, many = np.concatenate([beta, last]), active[t]
        alpha *= beta
    out.step += model.step * pairs
    out.start += alphas[: active[0]][~later].sum(0, dtype=np.float64)
    out.step += model.step * (before[later].T @ (emitted[: active[0]] * beta)[later])
    seen, posterior = labels[place].astype(np.intp), np.empty(len(place))
    for k in range(len(model.start)):
        posterior[:] = alphas[:, k]  # once contiguous and in double precision, it is counted faster
        out.emit[:, k] += np.bincount(seen, posterior, len(out.emit))


def log_likelihoods(tokens: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """log10 of the exact probability of each sequence."""
    cut = Segments(tokens, first, model)
    return cut.onward(cut.head)


def word_counts(blocks: packing.Blocks) -> tuple[np.ndarray, np.ndarray, int]:
    """Training words and distinct ones per bucket; training documents."""
    n_groups = blocks.groups()

    def ask(row):
        texts = Texts(row)
        counts = texts.training_counts()
        keys, counts = texts.keys[counts > 0], counts[counts > 0]
        parts = packing.split_sorted(keys, n_groups)
        columns = [pa.array([g for g, _, _ in parts], pa.int64())]
        columns += [pa.array([x[a:b].tobytes() for _, a, b in parts], pa.binary()) for x in (keys, counts)]
        yield pa.RecordBatch.from_arrays(columns, ["grp", "keys", "counts"])

    def add(table):
        keys, _ = packing.grouped(table, "keys", np.uint64)
        counts, _ = packing.grouped(table, "counts", np.uint32)
        known, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, counts, len(known)).astype(np.int64)
        buckets = symbols(known)
        used = np.unique(buckets)
        of_bucket = [np.bincount(buckets, w, SYMBOLS)[used].astype(np.int64) for w in (total, total > 0)]
        return pa.table([pa.array(c) for c in (used, *of_bucket)], ["symbol", "n", "v"])

    asked = blocks.map(ask, "grp long, keys binary, counts binary")
    sums = asked.groupBy("grp").applyInArrow(add, "symbol long, n long, v long")
    sums = sums.groupBy("symbol").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    n, v = np.zeros(SYMBOLS), np.zeros(SYMBOLS)
    for row in sums.collect():  # at most SYMBOLS rows
        n[row["symbol"]], v[row["symbol"]] = row["n"], row["v"]

    def trained(row):
        yield pa.RecordBatch.from_arrays([pa.array([int((~np.array([held_out(i) for i in np.frombuffer(row["ids"], np.int64)], bool)).sum())], pa.int64())], ["n"])

    ends = replace(blocks, table=blocks.table.select("ids")).map(trained, "n long").agg(F.sum("n")).first()[0] or 0
    return n, v, int(ends)


#: The share that each 8-bit number stands for: from 1 down to 2 ** -15.9, in steps of 4 %.
SHARES = 2.0 ** (-np.arange(256) / 16)


def rounded(shares: np.ndarray) -> np.ndarray:
    """The 8-bit numbers of shares of the states, none of which is 0."""
    return np.round(-16 * np.log2(np.clip(shares, SHARES[-1], 1.0))).astype(np.uint8)


def weights(counts: np.ndarray, rounded_shares: np.ndarray) -> np.ndarray:
    """What words of these counts and rounded shares have in the states, 1 + count in all."""
    shares = SHARES[rounded_shares]
    return (counts + 1.0)[:, None] * shares / shares.sum(1, keepdims=True)


def word_states(blocks: packing.Blocks, model: Model, of_bucket: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """Answers (block, part) with the training count of each distinct word of a block and its shares of
    the states, in the order of word codes; the weights of all known words per state."""
    n_groups, states, single = blocks.groups(), len(model.start), model.single()

    def ask(row):
        texts = Texts(row)
        keys, counts = texts.keys, texts.training_counts()
        docs = np.flatnonzero(~texts.held)
        labels, _ = texts.sequences(docs, texts.numbers, len(keys))
        found = expected(*texts.sequences(docs), single, labels, len(keys) + 1).emit[:-1]
        shares = rounded(found / np.maximum(counts, 1)[:, None])
        parts = packing.split_sorted(keys, n_groups)
        columns = [pa.array([g for g, _, _ in parts], pa.int64()), pa.array([row["block"]] * len(parts), pa.int64())]
        columns += [pa.array([x[a:b].tobytes() for _, a, b in parts], pa.binary()) for x in (keys, counts, shares)]
        yield pa.RecordBatch.from_arrays(columns, ["grp", "block", "keys", "counts", "shares"])

    def add(table):
        keys, rows = packing.grouped(table, "keys", np.uint64)
        counts, _ = packing.grouped(table, "counts", np.uint32)
        shares = SHARES[packing.grouped(table, "shares", np.uint8)[0].reshape(-1, states)]
        shares *= (counts / shares.sum(1))[:, None]
        known, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, counts, len(known)).astype(np.int64)
        found = np.stack([np.bincount(inverse, shares[:, k], len(known)) for k in range(states)], 1)
        found += BACK_OFF * of_bucket[symbols(known)]
        used = rounded(found / found.sum(1, keepdims=True))
        sums = weights(total, used)[total > 0].sum(0)
        edges = np.searchsorted(rows, np.arange(table.num_rows + 1))
        spans = list(zip(edges[:-1], edges[1:], strict=True))
        parts = [[x[inverse[a:b]].tobytes() for a, b in spans] for x in (total, used)]
        grp = table["grp"].slice(0, 1).to_pylist() * (table.num_rows + 1)
        columns = [pa.array(grp, pa.int64()), pa.array([*table["block"].to_pylist(), None], pa.int64())]
        columns += [pa.array([*parts[0], sums.tobytes()], pa.binary()), pa.array([*parts[1], None], pa.binary())]
        return pa.table(columns, ["grp", "block", "counts", "shares"])

    asked = blocks.map(ask, "grp long, block long, keys binary, counts binary, shares binary")
    answers = stored(asked.groupBy("grp").applyInArrow(add, "grp long, block long, counts binary, shares binary"), "word-states")

    def state_rows(batches):
        for batch in batches:
            for x in batch["counts"].to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(range(states), pa.int64()), pa.array(np.frombuffer(x))], ["state", "weight"])

    sums = answers.filter("block IS NULL").select("counts").mapInArrow(state_rows, "state long, weight double")
    total = np.zeros(states)
    for row in sums.groupBy("state").agg(F.sum("weight").alias("weight")).collect():  # one row for each state
        total[row["state"]] = row["weight"]
    return answers.filter("block IS NOT NULL").select("block", F.struct("grp", "counts", "shares").alias("part")), total


def begin(overall: np.ndarray, states: int) -> Model:
    """States told apart by fixed noise around the shares of all symbols."""
    random = np.random.default_rng(11)
    noise = random.dirichlet(np.full(states, 0.5), SYMBOLS + 1)
    emit = overall[:, None] * (0.2 / states + noise)
    step = np.full((states, states), 0.1 / (states - 1)) if states > 1 else np.ones((1, 1))
    np.fill_diagonal(step, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1.0 / states), step, emit / emit.sum(0))


def training(blocks: packing.Blocks) -> DataFrame:
    """tokens and first of the training documents of every block, written once for all passes."""

    def run(row):
        texts = Texts(row)
        tokens, first = texts.sequences(np.flatnonzero(~texts.held))
        columns = [pa.array([x.tobytes()], pa.binary()) for x in (tokens.astype(np.uint16), first.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["tokens", "first"])

    return stored(blocks.map(run, "tokens binary, first binary"), "hmm-tokens")


def train(sequences: DataFrame, model: Model) -> Counts:
    """The counts of one Baum-Welch pass over all training documents."""
    states, single = len(model.start), model.single()
    shapes = [(states,), (states, states), (SYMBOLS + 1, states), (1,)]

    def groups(batches):
        """Blocks of about ORDERED tokens together, as the arrays are handled step by step."""
        held, size = [], 0
        for batch in batches:
            for tokens, first in zip(batch["tokens"], batch["first"], strict=True):
                held.append((np.frombuffer(tokens.as_buffer(), np.uint16), np.frombuffer(first.as_buffer(), np.int64) + size))
                size += len(held[-1][0])
                if size >= ORDERED:
                    yield held
                    held, size = [], 0
        yield held

    def run(batches):
        total = Counts.zero(states)
        for held in groups(batches):
            if held:
                tokens = np.concatenate([tokens for tokens, _ in held])
                total.add(expected(tokens, np.concatenate([[0], *(first[1:] for _, first in held)]), single))
        flat = np.concatenate([np.reshape(x, -1) for x in (total.start, total.step, total.emit, total.log)])
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], ["i", "value"])

    found = sequences.mapInArrow(run, "i long, value double").groupBy("i").agg(F.sum("value").alias("value"))
    flat = np.zeros(sum(int(np.prod(s)) for s in shapes))
    rows = found.toArrow()  # one number for each parameter
    flat[np.asarray(rows["i"].combine_chunks())] = np.asarray(rows["value"].combine_chunks())
    start, step, emit, log = np.split(flat, np.cumsum([int(np.prod(s)) for s in shapes])[:-1])
    return Counts(start, step.reshape(shapes[1]), emit.reshape(shapes[2]), float(log[0]))


def logs_of(model: Model) -> list[np.ndarray]:
    return [np.log(x) for x in (model.start, model.step, model.emit)]


def farther(models: list[Model], weight: Counts) -> Model:
    """Where three models in a row lead to: a squared extrapolation of the logarithms of their parameters,
    whose length follows from how the two moves compare under the expected counts `weight`."""
    a, b, c = map(logs_of, models)
    move = [y - x for x, y in zip(a, b, strict=True)]
    bend = [z - 2 * y + x for x, y, z in zip(a, b, c, strict=True)]
    counts = (weight.start, weight.step, weight.emit)
    lengths = [sum((w * x * x).sum() for w, x in zip(counts, side, strict=True)) for side in (move, bend)]
    far = min(max(1.0, np.sqrt(lengths[0] / lengths[1])), FARTHEST) if lengths[1] > 0 else 1.0
    start, step, emit = (np.exp(x + 2 * far * m + far * far * v) for x, m, v in zip(a, move, bend, strict=True))
    return Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))


def fit(sequences: DataFrame, model: Model, unseen: np.ndarray, passes: int, tolerance: float = TOLERANCE) -> tuple[Model, Counts]:
    """Baum-Welch passes until the likelihood stops rising, `passes` at most; the counts of the best.
    After every two passes the model is moved on along their path; a move that lowers the likelihood is taken back."""
    best, last, plain = Counts.zero(len(model.start)), -np.inf, None
    path = [model]
    for _ in range(passes):
        counts = train(sequences, path[-1])
        if counts.log < last and plain is not None:
            path, plain = [plain], None
            continue
        best, gain, last = counts, counts.log - last, counts.log
        plain = None
        path.append(counts.model(unseen))
        if gain <= tolerance * abs(last):
            break
        if len(path) == 3:
            plain = path[-1]
            path = [farther(path, counts)]
    return best.model(unseen), best


def score(docs: DataFrame, states: int = STATES, passes: int = PASSES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    blocks = packing.pack(docs, size=block_bytes, derive=taken_apart, columns=COLUMNS)
    n_b, v_b, ends = word_counts(blocks)
    n_tokens, n_types = int(n_b.sum()) + ends, int(v_b.sum()) + (ends > 0)
    unseen = np.r_[v_b + 1, 1.0]
    overall = np.r_[n_b, ends] + unseen
    model, counts = fit(training(blocks), begin(overall / overall.sum(), states), unseen, passes)
    buckets = counts.smoothed(unseen)
    of_bucket = buckets / buckets.sum(1, keepdims=True)
    answers, total = word_states(blocks, model, of_bucket)
    end, total = buckets[END:], total + buckets[END] + of_bucket[:END].sum(0)
    unit = np.log10(n_tokens + n_types + 1)

    def run(row):
        texts = Texts(row)
        docs = np.arange(len(texts.ids))
        parts = sorted((p["grp"], p["counts"], p["shares"]) for p in row["part"] or [])
        counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for _, x, _ in parts)])
        shares = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x, np.uint8) for _, _, x in parts)]).reshape(-1, states)
        own = replace(model, emit=np.concatenate([weights(counts, shares), end]) / total)
        known = np.log10(counts + 1.0)
        lengths = np.diff(texts.first)

        def summed(value, end):
            sums = np.r_[0.0, np.cumsum(value)]
            return sums[texts.first[1:]] - sums[texts.first[:-1]] + end

        base = summed(known[texts.numbers] - unit, np.log10(ends + 1.0) - unit)
        scores = log_likelihoods(*texts.sequences(docs, texts.numbers, len(texts.keys)), own)
        n_known = summed((counts > 0).astype(float)[texts.numbers], float(ends > 0)).round().astype(np.int64)
        columns = [words.id_column(texts.ids), pa.array(texts.held), pa.array(lengths + 1), pa.array(n_known)]
        columns += [pa.array(np.full(len(docs), n_tokens)), pa.array(base), pa.array(scores)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.with_answers(answers, ["part"]).map(run, schema)
