"""The operators on documents against plain versions and on edge rows."""

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanloom.llm import blocks as packing
from loanloom.llm import bpe, hmm, mixing, quality, session, setsketch, substring, toxicity
from loanloom.llm.components import components


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def key(row):
    return tuple((x is None, str(type(x)), x) for x in row)


def same(found, expected):
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


@pytest.fixture(params=["edge", "sample"])
def docs(request, edge_docs, sample_docs):
    return edge_docs if request.param == "edge" else sample_docs


# -- substring dedup ---------------------------------------------------------


@pytest.mark.parametrize("block_bytes,group_suffixes", [(2_000_000, 2_000_000), (50_000, 400)])
def test_substring(docs, block_bytes, group_suffixes):
    found = substring.digests(docs, block_bytes=block_bytes, group_suffixes=group_suffixes)
    same(found.collect(), plain.substring(pairs(docs)))


def test_substring_other_size(sample_docs):
    same(substring.digests(sample_docs, size=5).collect(), plain.substring(pairs(sample_docs), 5))


def test_substring_texts(docs):
    found = substring.deduplicated(docs, block_bytes=60_000)
    assert found.schema == docs.schema
    rows = found.collect()
    kept = [(d, [x for x, g in zip(w, gone) if not g]) for d, w, gone in plain.kept_words(pairs(docs))]
    same([(r.doc_id, tuple(plain.words(r.text))) for r in rows], [(d, tuple(w)) for d, w in kept])
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in rows)


def test_subtree_finds_deep_nodes():
    found = np.zeros(5, substring._suffix(3))
    found["words"] = [[1, 2, 3], [1, 2, 4], [1, 2, 3], [9, 9, 9], [1, 2, 3]]
    found["hash"], found["id"] = [7, 8, 7, 9, 7], [5, 1, 2, 0, 9]
    order, depth = substring.subtree(found, 3)
    assert list(found["id"][order]) == [2, 5, 9, 1, 0] and list(depth) == [0, 3, 3, 2, 0]


# -- quality -----------------------------------------------------------------


def test_quality_counts(docs):
    found = quality.rules(docs)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    same(found.select(*names).collect(), [(d, *plain.base_counts(t)) for d, t in pairs(docs)])
    assert not found.filter("kept AND base_failed").count() and not found.filter("kept IS NULL").count()


def test_quality_keeps_good_and_drops_bad(spark, sf_dir, sample_docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    joined = quality.rules(sample_docs).join(labels, "doc_id").filter("NOT base_failed")
    wrong = joined.filter("kept <> (quality = 1)").count()
    assert wrong <= 0.02 * joined.count()


def test_fences_follow_the_source(spark):
    """Symbols are normal in one source and rejected in the other."""
    rows = [(i, " ".join(f"t{i}w{k}" + "#" * (s == "code") for k in range(30)), "en", s, 1) for i, s in enumerate(["code", "prose"] * 300)]
    rows.append((9999, " ".join(f"odd{k}#" for k in range(30)), "en", "prose", 1))
    kept = {r.doc_id: r.kept for r in quality.rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert not kept.pop(9999) and all(kept.values())


def plain_fences(rows, prior=quality.PRIOR):
    """Upper limits of the signals by (lang, source), from buckets of the values' logarithms."""

    def quartiles(values):
        cells = sorted(-math.inf if v <= 0 else math.floor(math.log(v) / math.log(1.02)) for v in values)
        return [0.0 if c == -math.inf else 1.02 ** (c + 0.5) for c in (cells[math.ceil(len(cells) * q) - 1] for q in (0.25, 0.75))]

    def drawn(values, wider):
        own = len(values) / (len(values) + prior)
        return [own * a + (1 - own) * b for a, b in zip(quartiles(values), wider, strict=True)]

    out = defaultdict(dict)
    for s in quality.SIGNALS:
        every = quartiles([r[s.name] for r in rows])
        for lang in {r["lang"] for r in rows}:
            by_lang = drawn([r[s.name] for r in rows if r["lang"] == lang], every)
            for source in {r["source"] for r in rows if r["lang"] == lang}:
                low, high = drawn([r[s.name] for r in rows if (r["lang"], r["source"]) == (lang, source)], by_lang)
                out[lang, source][s.name] = high + max(s.spreads * (high - low), s.least)
    return out


def test_verdicts_against_brute_force(docs):
    scored = quality.with_signals(docs.select("doc_id", "text", "lang", "source"))
    rows = [r.asDict() for r in scored.collect()]
    limits = plain_fences(rows)
    found = {(r["_lang"], r["_source"]): r for r in quality.fences(scored).collect()}
    assert set(found) == set(limits)
    for group, fences in limits.items():
        assert all(math.isclose(found[group][f"_{n}_fence"], v, rel_tol=1e-9) for n, v in fences.items())
    expected = [
        (r["doc_id"], not r["base_failed"] and all(r[n] <= v for n, v in limits[r["lang"], r["source"]].items())) for r in rows
    ]
    same([tuple(r) for r in quality.rules(docs).select("doc_id", "kept").collect()], expected)


def test_fences_are_the_same_on_every_run(sample_docs):
    scored = quality.with_signals(sample_docs)
    runs = [sorted(map(str, quality.fences(scored.repartition(n)).collect())) for n in (1, 5)]
    assert runs[0] == runs[1]


def test_every_document_of_a_small_source_counts(spark):
    """A source's fence moves steadily towards its own documents; no size switches it."""
    prose = [(" ".join(f"w{i}x{k}" for k in range(30)), "prose") for i in range(2000)]
    limits = []
    for n in (0, 5, 20, 80, 320):
        code = [(" ".join(f"t{i}w{k}#" for k in range(30)), "code") for i in range(n)]
        rows = [(i, t, "en", s) for i, (t, s) in enumerate(prose + code + [("a b", "code")])]
        scored = quality.with_signals(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
        limits.append(quality.fences(scored).filter("_source = 'code'").first()["_symbols_per_word_fence"])
    assert limits[0] < limits[1] < limits[2] and min(limits[2:]) > 0.5


def test_kept_rows_are_whole(edge_docs):
    kept = quality.kept(edge_docs)
    assert kept.schema == edge_docs.schema
    verdicts = quality.rules(edge_docs).filter("kept")
    same(kept.select("doc_id").collect(), [tuple(r) for r in verdicts.select("doc_id").collect()])


# -- mixing ------------------------------------------------------------------


def test_mixing(docs):
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(plain.words(r.text))
    goal, taken, largest = plain.targets(sizes), defaultdict(int), defaultdict(int)
    found = mixing.mix(docs).collect()
    same([(r.doc_id, r.size, r.source_size) for r in found], [(r.doc_id, len(plain.words(r.text)), sizes[r.source]) for r in rows])
    assert sorted(map(key, found)) == sorted(map(key, mixing.mix(docs).collect()))
    for r in found:
        assert math.isclose(r.target, goal[r.source], rel_tol=1e-9, abs_tol=1e-9) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    copies = max(Counter((r.doc_id, r.text) for r in rows).values())
    for source, words in goal.items():
        assert abs(taken[source] - words) <= copies * largest[source]
    mixed = mixing.mixed(docs)
    assert mixed.schema == docs.schema
    expected = [(r.doc_id,) for r in found for _ in range(r.copies)]
    same(mixed.select("doc_id").collect(), expected)


def test_pareto_ranks_are_unbiased(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d e").alias("text"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"))
    found = mixing.mix(df)
    sums = {r.source: (r.t, r.target) for r in found.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).collect()}
    assert all(abs(t - goal) <= 5 for t, goal in sums.values())


# -- byte-level BPE ----------------------------------------------------------


@pytest.mark.parametrize("chunk,overlap", [(65_536, 1_024), (100, 20), (64, 8)])
def test_bpe_round_trip(edge_docs, chunk, overlap):
    use = bpe.codec(bpe.default_vocabulary())
    encoded = bpe.encode(edge_docs, chunk=chunk, overlap=overlap)
    expected = [(d, tuple(use.encoding.encode_ordinary(t or ""))) for d, t in pairs(edge_docs)]
    same([(r.doc_id, tuple(r.ids)) for r in encoded.collect()], expected)
    decoded = bpe.decode(encoded).collect()
    same([(r.doc_id, bytes(r["bytes"])) for r in decoded], [(d, (t or "").encode()) for d, t in pairs(edge_docs)])


def test_bpe_hard_boundaries(spark):
    texts = [" " * 900 + "x" * 40, "a" * 1500, "ab " * 400 + "q" * 500 + " yy" * 300, "it's we'll " * 99, "\n \t " * 200, "é日" * 300, "1" * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    use = bpe.codec(bpe.default_vocabulary())
    for chunk, overlap in ((100, 20), (37, 5)):
        found = {r.doc_id: list(r.ids) for r in bpe.encode(df, chunk=chunk, overlap=overlap).collect()}
        assert found == {i: use.encoding.encode_ordinary(t) for i, t in enumerate(texts)}


def test_bpe_digests(edge_docs):
    use = bpe.codec(bpe.default_vocabulary())
    expected = []
    for d, t in pairs(edge_docs):
        ids = use.encoding.encode_ordinary(t or "")
        expected.append((d, len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(t or "")))
    same(bpe.encode(edge_docs, digests=True).collect(), expected)


# -- hidden Markov model -----------------------------------------------------


def test_hmm_base(docs):
    rows = pairs(docs)

    def held(d):
        return zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2

    tokens = [(d, [*plain.words((t or "").translate(plain.LOWER)), None]) for d, t in rows]
    counts = Counter(w for d, x in tokens if not held(d) for w in x)
    n, v = sum(counts.values()), len(counts)
    expected = sorted((d is None, d or 0, held(d), len(x), sum(counts[w] > 0 for w in x), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in x), 5)) for d, x in tokens)
    found = hmm.score(docs, block_bytes=100_000).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_hmm_beats_the_base(sample_docs):
    found = hmm.score(sample_docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


def test_hmm_takes_texts_apart_once(edge_docs, monkeypatch):
    """Blocks hold words as numbers and no texts, so that no later pass can take them apart again."""
    packed = hmm.packing.pack(edge_docs.select("doc_id", "text"), size=5_000, derive=hmm.taken_apart, columns=hmm.COLUMNS)
    assert packed.table.columns == ["block", "ids", *hmm.COLUMNS]
    texts = [hmm.Texts(r.asDict()) for r in packed.table.collect()]
    assert sum(len(t.ids) for t in texts) == edge_docs.count()
    rows = [(t or "").encode() for _, t in pairs(edge_docs)]
    data, offsets = np.frombuffer(b"".join(rows), np.uint8), np.r_[0, np.cumsum([len(t) for t in rows])]
    whole = hmm.words.words(data, offsets, lower=True)
    assert sorted(int(c) for t in texts for c in t.keys[t.numbers]) == sorted(map(int, whole.codes()))
    for size in (1, 100, 10**9):  # texts are taken apart in pieces
        monkeypatch.setattr(hmm, "PIECE_BYTES", size)
        got = hmm.Texts({"ids": bytes(8 * len(rows)), **dict(zip(hmm.COLUMNS, hmm.taken_apart(data, offsets), strict=True))})
        assert (got.first == whole.first).all() and (got.keys[got.numbers] == whole.codes()).all()
        kept = np.repeat(~got.held, np.diff(whole.first))
        assert dict(zip(got.keys, got.training_counts(), strict=True)) == Counter({c: 0 for c in got.keys}) | Counter(whole.codes()[kept])
    empty = hmm.Texts({"ids": b"", **dict(zip(hmm.COLUMNS, hmm.taken_apart(data[:0], offsets[:1]), strict=True))})
    assert not len(empty.keys) and not len(empty.numbers) and not len(empty.doc)


def test_forward_is_exact():
    random = np.random.default_rng(1)
    model = hmm.Model(np.array([0.3, 0.7]), np.array([[0.9, 0.1], [0.2, 0.8]]), random.dirichlet(np.ones(hmm.SYMBOLS + 1), 2).T)
    sequences = [random.integers(0, hmm.SYMBOLS + 1, n) for n in (1, 5, 512, 513, 1500, 3, hmm.SEGMENT, hmm.SEGMENT + 1, 2 * hmm.SEGMENT + 7)]

    def forward(seq):
        alpha, log = model.start * model.emit[seq[0]], 0.0
        for t in range(len(seq)):
            if t:
                alpha = (alpha @ model.step) * model.emit[seq[t]]
            log += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        return log

    found = hmm.log_likelihoods(np.concatenate(sequences), np.r_[0, np.cumsum([len(s) for s in sequences])], model)
    assert np.allclose(found, [forward(s) for s in sequences], rtol=1e-12)


def test_single_precision_counts_as_double():
    random = np.random.default_rng(8)
    lengths = [1, 2, 40, hmm.SEGMENT, hmm.SEGMENT + 1, 3 * hmm.SEGMENT + 5]
    tokens, first = random.integers(0, hmm.SYMBOLS + 1, sum(lengths)), np.r_[0, np.cumsum(lengths)]
    # states that hardly ever change and rule each other's symbols out
    emit = random.dirichlet(np.full(hmm.SYMBOLS + 1, 0.02), 3).T + 1e-12
    step = np.full((3, 3), 1e-9) + np.eye(3)
    model = hmm.Model(np.full(3, 1 / 3), step / step.sum(1, keepdims=True), emit / emit.sum(0))
    double, single = hmm.expected(tokens, first, model), hmm.expected(tokens, first, model.single())
    assert np.isclose(single.log, double.log, rtol=1e-6)
    for a, b in ((single.start, double.start), (single.step, double.step), (single.emit, double.emit)):
        assert np.allclose(a, b, rtol=1e-3, atol=0.02)


def test_extrapolation_keeps_a_model():
    random = np.random.default_rng(9)
    tokens, first = random.integers(0, 300, 4000), np.arange(0, 4001, 80)
    unseen = np.ones(hmm.SYMBOLS + 1)
    models = [hmm.begin(unseen / unseen.sum(), 4)]
    for _ in range(2):
        counts = hmm.expected(tokens, first, models[-1])
        models.append(counts.model(unseen))
    moved = hmm.farther(models, counts)
    assert np.isclose(moved.start.sum(), 1) and np.allclose(moved.step.sum(1), 1) and np.allclose(moved.emit.sum(0), 1)
    still = hmm.farther([models[0]] * 3, counts)  # no move: the same model
    assert np.allclose(still.emit, models[0].emit)


def test_baum_welch_never_loses_likelihood():
    random = np.random.default_rng(2)
    tokens = np.concatenate([random.integers(0, 40, 60) if k % 2 else random.integers(40, 80, 60) for k in range(40)])
    first = np.arange(0, len(tokens) + 1, 60)
    emit = random.dirichlet(np.ones(hmm.SYMBOLS + 1), 2).T
    model, last = hmm.Model(np.array([0.5, 0.5]), np.array([[0.8, 0.2], [0.3, 0.7]]), emit), -np.inf
    for _ in range(6):
        counts = hmm.expected(tokens, first, model)
        assert math.isclose(counts.emit.sum(), len(tokens), rel_tol=1e-9) and math.isclose(counts.start.sum(), 40, rel_tol=1e-9)
        model = counts.model(np.full(hmm.SYMBOLS + 1, 1e-9))
        now = hmm.log_likelihoods(tokens, first, model).sum()
        assert now > last - 1e-6 * abs(now)
        last = now


def test_counts_of_long_texts_are_exact():
    """Posteriors of a text of many segments are those given the whole text."""
    random = np.random.default_rng(5)
    model = hmm.Model(random.dirichlet(np.ones(3)), random.dirichlet(np.ones(3), 3), random.dirichlet(np.ones(hmm.SYMBOLS + 1), 3).T)
    first = np.r_[0, np.cumsum([1, 512, 513, 1400, 7])]
    tokens = random.integers(0, hmm.SYMBOLS + 1, first[-1])
    start, step, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((hmm.SYMBOLS + 1, 3))
    for a, b in zip(first[:-1], first[1:], strict=True):
        alpha, beta = [model.start * model.emit[tokens[a]]], [np.ones(3)]
        for t in range(a + 1, b):
            ahead = (alpha[-1] / alpha[-1].sum()) @ model.step * model.emit[tokens[t]]
            alpha.append(ahead)
        for t in range(b - 1, a, -1):
            pair = model.step * np.outer(alpha[t - a - 1], model.emit[tokens[t]] * beta[0])
            step += pair / pair.sum()
            behind = model.step @ (model.emit[tokens[t]] * beta[0])
            beta.insert(0, behind / behind.sum())
        gamma = np.array(alpha) * np.array(beta)
        gamma /= gamma.sum(1, keepdims=True)
        start += gamma[0]
        np.add.at(emit, tokens[a:b], gamma)
    found = hmm.expected(tokens, first, model)
    assert all(np.allclose(x, y, rtol=1e-9, atol=1e-12) for x, y in [(found.start, start), (found.step, step), (found.emit, emit)])


def test_long_texts_are_trained_like_others(spark):
    """Two vocabularies in long runs: states tell them apart though every text has more than 20 KB."""
    random = np.random.default_rng(6)
    rows = [(i, " ".join(f"{'ab'[k // 250 % 2]}word{w}" for k, w in enumerate(random.integers(0, 300, 3000)))) for i in range(30)]
    assert min(len(t) for _, t in rows) > 20_000
    found = hmm.score(spark.createDataFrame(rows, "doc_id long, text string"))
    gain = found.filter("held_out").agg(F.sum("score") - F.sum("base_score"), F.sum("n_tokens")).first()
    assert gain[0] > 0.2 * gain[1]  # log10(2) is 0.301


def test_states_tell_words_of_a_bucket_apart(spark):
    """Frequent words tell the runs apart; a bucket has five rare words, of both vocabularies."""
    random = np.random.default_rng(7)

    def word(k):
        v = k // 50 % 2
        return f"f{v}x{random.integers(0, 20)}" if random.random() < 0.5 else f"w{2 * random.integers(0, 10_000) + v}"

    rows = [(i, " ".join(word(k) for k in range(2000))) for i in range(100)]
    found = hmm.score(spark.createDataFrame(rows, "doc_id long, text string"))
    gain = found.filter("held_out").agg(F.sum("score") - F.sum("base_score"), F.sum("n_tokens")).first()
    assert gain[0] > 0.16 * gain[1]  # with the states of buckets alone 0.114


# -- toxicity ----------------------------------------------------------------


def test_toxicity(spark, sample_docs):
    bad = ["idiot and scum you are", "what a moron and loser", "you idiot loser go", "scum moron talk"]
    rows = [(i, f"word{i % 7} text number {i % 31} " + (bad[i % 4] if i % 5 == 0 else "nice day today"), int(i % 5 == 0)) for i in range(800)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (5, None, None), (4, 1, 7)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert len(found) == 800 and all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    held = [i for i in found if found[i].held_out]
    assert held and all(found[i].predicted == rows[i][2] and 0 <= found[i].score <= 1 for i in held)


def test_toxicity_edges(spark, edge_docs, no_docs):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = toxicity.score(edge_docs, empty).collect()
    assert len(found) == edge_docs.count() and all(r.score < 0.3 and r.predicted == 0 for r in found)
    assert toxicity.score(no_docs, empty).count() == 0


def test_long_labelled_texts_are_fitted(spark):
    """Texts of any length take part; too many terms make it fewer rows, by their ids alone."""
    filler = " ".join(f"{'abcdefghij'[i % 10] * 3}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(8_000))
    rows = [(i, ("bad " if i % 2 else "good ") + (filler if i % 4 < 2 else "text")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    lists, marks = toxicity.sample(docs, labels)
    eligible = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert marks.tolist() == [i % 2 for i in eligible]
    assert sum(len(x) > 300 for x in lists) == sum(i % 4 < 2 for i in eligible)
    held = sum(x.nbytes for x in lists)
    fewer, _ = toxicity.sample(docs, labels, size=held // 3)
    assert 0 < sum(x.nbytes for x in fewer) < held / 2 and any(len(x) > 300 for x in fewer)


def test_machine_learns_pairs():
    """Two terms are harmless alone and toxic together."""
    random = np.random.default_rng(0)
    lists, labels = [], []
    for _ in range(3000):
        a, b = random.random(2) < 0.5
        lists.append(np.array([k for k, on in ((3, a), (8, b)) if on], np.int32))
        labels.append(float(a and b))
    machine = toxicity.fit(lists, np.array(labels))
    text = np.array([0, 1, 2, 2])
    scores = machine.scores(text, np.array([3, 8, 3, 8]), 4)
    assert scores[2] > 0.8 and scores[0] < 0.3 and scores[1] < 0.3 and scores[3] < 0.3


# -- near duplicates ---------------------------------------------------------


@pytest.mark.parametrize("block_bytes,chunk", [(2_000_000, 512), (40_000, 2)])
def test_near_duplicates(docs, block_bytes, chunk):
    found = setsketch.near_duplicates(docs, block_bytes, chunk).collect()
    same([(r.doc_id, r.n_shingles, r.component_id) for r in found], plain.near_duplicates(pairs(docs)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found if r.doc_id is not None)


def test_one_of_each_group_stays(docs):
    found = setsketch.deduplicated(docs, block_bytes=40_000)
    assert found.schema == docs.schema
    groups = plain.groups(pairs(docs))
    least = {}
    for doc, _, root in groups:
        least[root] = min(least.get(root, plain.LAST), plain.order(doc))
    same(found.select("doc_id").collect(), [(None if x == plain.LAST else x,) for x in least.values()])


def test_chains_of_links(spark):
    """Neighbours are linked, the ends are not; every link counts, also of a large group."""
    base = [f"w{i}" for i in range(300)]
    rows = []
    for k in range(40):
        for copy in range(3):
            words = base[: 300 - 4 * k] + [f"n{j}" for j in range(4 * k)]
            words[150] = f"c{copy}" if copy else words[150]
            rows.append((100 + 3 * k + copy, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same([tuple(r)[:3] for r in setsketch.near_duplicates(docs, 5_000, 4).collect()], plain.near_duplicates(rows))


def test_registers_estimate_similarity():
    random = np.random.default_rng(4)
    text = [f"w{i}" for i in range(1200)]
    other = [w if random.random() > 0.02 else w + "x" for w in text]
    bodies = [" ".join(x).encode() for x in (text, other)]
    row = {"ids": np.arange(2).tobytes(), "text": b"".join(bodies), "offsets": np.cumsum([0, *map(len, bodies)]).astype(np.int64).tobytes()}
    sets = setsketch.Sets(row)
    registers, sizes = sets.registers(), sets.sizes
    true = len(np.intersect1d(sets.of(0), sets.of(1))) / len(np.union1d(sets.of(0), sets.of(1)))
    found = setsketch.likeliest(registers[:1], registers[1:], sizes[:1], sizes[1:])
    assert abs(found[0] - true) < 0.15 and setsketch.likeliest(registers, registers, sizes, sizes).min() > 0.99


def test_sets_hold_a_piece_of_a_block_at_a_time(monkeypatch):
    """Memory follows the piece, not the block of 2 MB; sets and registers don't depend on the piece."""
    texts = [" ".join(f"w{(k * 7919 + i * i) % 50_021}" for i in range(300)) for k in range(1000)] + ["", "a b", " "]
    bodies = [t.encode() for t in texts]
    row = {"ids": np.arange(len(texts)).tobytes(), "text": b"".join(bodies), "offsets": np.cumsum([0, *map(len, bodies)]).astype(np.int64).tobytes()}
    tracemalloc.start()
    sets = setsketch.Sets(row)
    registers = sets.registers()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    monkeypatch.setattr(setsketch, "PIECE", 10**9, raising=False)
    whole = setsketch.Sets(row)
    assert (whole.element == sets.element).all() and (whole.sizes == sets.sizes).all() and (whole.registers() == registers).all()


def test_large_rows_come_in_small_batches(spark, monkeypatch):
    """Documents are packed, and blocks read, a few at a time; the session's setting stays."""
    seen, before = [], spark.conf.get(session.BATCH)
    bucketed = packing.bucketed
    monkeypatch.setattr(packing, "bucketed", lambda *a: seen.append(spark.conf.get(session.BATCH)) or bucketed(*a))
    docs = spark.range(600, numPartitions=1).selectExpr("id AS doc_id", "concat('a b ', id) AS text")
    blocks = packing.pack(docs, size=2_000)
    assert seen == [str(packing.DOCUMENTS)] and blocks.table.count() > 5

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    found = session.stored(blocks.table.coalesce(1).mapInArrow(sizes, "n long"), "batches", packing.ONE_BLOCK)
    assert [tuple(r) for r in found.distinct().collect()] == [(1,)] and found.count() == blocks.table.count()
    assert spark.conf.get(session.BATCH) == before


def test_components(spark):
    random = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 50)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    joined = {x for a, b in edges if a != b for x in (a, b)}
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {x: root(x) for x in joined}


# -- all ---------------------------------------------------------------------


def test_empty_tables(no_docs):
    for found in (
        substring.digests(no_docs),
        substring.deduplicated(no_docs),
        quality.rules(no_docs),
        quality.kept(no_docs),
        mixing.mix(no_docs),
        mixing.mixed(no_docs),
        bpe.encode(no_docs),
        bpe.encode(no_docs, digests=True),
        hmm.score(no_docs),
        setsketch.near_duplicates(no_docs),
        setsketch.deduplicated(no_docs),
    ):
        assert found.count() == 0


def test_number_of_buckets_is_bounded(sample_docs, monkeypatch):
    """More buckets would be needed than the table may have: results stay, the catalog stays empty."""
    from loanloom.llm import blocks

    def results():
        return [sorted(map(str, f(sample_docs).collect())) for f in (substring.digests, setsketch.near_duplicates)]

    before = results()
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 10_000)
    monkeypatch.setattr(blocks, "MOST_BUCKETS", 4)
    packed = blocks.pack(sample_docs, size=5_000)
    assert packed.buckets == 4 and packed.size > 40_000
    assert results() == before
    assert not [t.name for t in sample_docs.sparkSession.catalog.listTables() if t.name.startswith("loanloom_blocks")]
