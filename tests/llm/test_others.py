"""Pages, conversations, vectors, the pipeline and the registered queries."""

import hashlib
import html
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from loanloom.llm import bpe, chat, main_text, mixing, neighbours
from loanloom.llm.queries import QUERIES

# -- pages -------------------------------------------------------------------

PARAGRAPH = "A paragraph with enough text in it to be taken for the body of an article, no doubt."


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("<p></p>", ""),
        ("<nav><a href=x>Menu</a></nav><footer>Foot</footer>", ""),
        ("<article><h1>T</h1><p>One.<p>Two &amp; three&nbsp;&eacute;\n  four<br>five</article><p>out</p>", "T\n\nOne.\n\nTwo & three é four five"),
        ("<body><header>Site</header><main><p>In.</p><div class='side-bar ad'>Buy</div><p>More.</p></main></body>", "In.\n\nMore."),
        ("<article><p>Body</p><section id=comments><p>" + PARAGRAPH + "</p></section></article>", "Body"),
        ("<div class=sidebar><p>" + PARAGRAPH + "</p></div><div><p>" + PARAGRAPH + "</p><p>Short.</p></div><aside>x</aside>", PARAGRAPH + "\n\nShort."),
        ("<script>var a='<p>" + PARAGRAPH + "</p>'</script><style>p{}</style><p>" + PARAGRAPH + "</p>", PARAGRAPH),
        ("<form><p>" + PARAGRAPH + "</p></form><!-- <p>no</p> --><p>" + PARAGRAPH + " 1 < 2</p>", PARAGRAPH + " 1 < 2"),
        ("<ARTICLE><P>a <b>b</b>c</P><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></ARTICLE>", "a bc\n\nx\n\ny\n\n1 2"),
        ("<form id=page><header>x</header><article class='post has-comments'><p>In a form.</p><form><p>mail</p></form></article></form>", "In a form."),
        ("<div class='content with-sidebar'><p>" + PARAGRAPH + "</p></div><div class='entryComments'><p>" + PARAGRAPH + "</p></div>", PARAGRAPH),
        ("<div id='cookie-notice'>" + PARAGRAPH + "</div><p>" + PARAGRAPH + "</p><p><a href=x>" + PARAGRAPH + "</a></p>", PARAGRAPH),
        ("<p title=\"a>b\">" + PARAGRAPH + "<p unclosed='x>" + PARAGRAPH, PARAGRAPH + "\n\n" + PARAGRAPH),
        # a wrapper of the whole page with a word of page layout
        ("<div class='page-with-sidebar'><article><p>Only.</p></article></div>", "Only."),
        ("<div id='nav-open'><main><p>" + PARAGRAPH + "</p></main></div>", PARAGRAPH),
        # such an article counts only where the page marks no other
        ("<div class=sidebar><article>Teaser</article></div><article><p>Body</p></article>", "Body"),
        ("<div class=sidebar><aside><article>Teaser</article></aside></div><p>" + PARAGRAPH + "</p>", PARAGRAPH),
        ("<div class=comments><article><p>" + PARAGRAPH + "</p></article></div><article><p>Body</p></article>", "Body"),
        # windows judge the marks: a title or a teaser alone is not the article
        ("<article><h1>Title</h1></article><div><p>" + PARAGRAPH + "</p><p>" + PARAGRAPH + "</p></div>", "\n\n".join(["Title", PARAGRAPH, PARAGRAPH])),
        ("<main><p>" + PARAGRAPH + "</p><article class=teaser>short</article><p>Last.</p></main>", "\n\n".join([PARAGRAPH, "short", "Last."])),
    ],
)
def test_main_text(page, text):
    assert main_text.extract(page) == text


def test_windows_decide():
    """The same lines give other articles once the text around them is denser than the marked ones."""
    marked, around = ("Marked text.", 0, 3), (PARAGRAPH, 0, 0)
    assert main_text.article_level([marked, ("", 0, 0), ("Short.", 0, 0)]) == 3
    assert main_text.article_level([marked, ("", 0, 0), around]) == 0
    assert main_text.article_level([(PARAGRAPH, 0, 3), ("", 0, 0), around]) == 3
    assert main_text.article_level([marked, ("", 0, 0), (PARAGRAPH, len(PARAGRAPH), 0)]) == 3  # links
    assert main_text.article_level([marked, (PARAGRAPH, 0, 2), around]) == 2
    assert main_text.article_level([]) == 0


def test_pages_with_known_text(spark, sf_dir):
    """The pages' articles are paragraphs under a heading; every block comes out whole, in order."""
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("text", F.lit("own"))
    found = {r.page_id: r for r in main_text.main_text(rows).collect()}
    for page in rows.collect():
        inner = page.html[page.html.index("<article>") : page.html.index("</article>")]
        for tag in ("</p>", "<p>", "</h1>", "<h1>"):
            inner = inner.replace(tag, "\n")
        blocks = [" ".join(re.sub(r"<[^>]*>", "", x.replace("<br>", " ")).split()) for x in inner.split("\n")]
        assert found[page.page_id].text == "\n\n".join(html.unescape(b) for b in blocks if b)
        assert found[page.page_id].n_chars == len(found[page.page_id].text) and found[page.page_id].url == page.url


def test_pages_edges(spark):
    rows = [(None, None, None), (1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (2, None, "<p>" + "word " * 200_000 + "</p>")]
    found = main_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in found) == [(0, "", 0), (1, "u", 1), (1, "u", 1), (2, "", 999_999)]
    assert main_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# -- chat --------------------------------------------------------------------


def formatted(turns):
    def written(text):
        for a, b in chat.ESCAPES:
            text = text.replace(a, b)
        return text

    return "".join(f"<turn:{written(r)}>\n{written(t)}</turn>\n" for r, t in turns)


def test_chat_round_trip(spark):
    tricky = ["</turn>\n", "\\b\\l\\g", "<turn:assistant>\nhi", "\\", "<<>>", "\\\\b", "", "a\nb", "é\U0001f600"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(tricky)]
    rows += [(2, 0, "system", None), (2, 1, None, "no role"), (None, 5, "assistant", "null tree"), (3, 4, "assistant", "same"), (3, 4, "assistant", "same")]
    rows += [(4, k, "a>b<c\\", f"turn {k}") for k in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("own") for c in ("tree", "message", "score", "up", "m2")})
    out = chat.conversations(chat.chains(df)).withColumn("turns", chat.turns("formatted")).withColumn("loss", chat.trained_text("segments"))
    expected = defaultdict(list)
    for c, _, r, t in rows:
        expected[c].append((r or "", t or ""))
    found = {r.tree: r for r in out.collect()}
    assert set(found) == set(expected)
    for c, turns in expected.items():
        assert [tuple(t) for t in found[c].turns] == turns and found[c].formatted == formatted(turns)
        assert found[c].loss == "".join(t for r, t in turns if r == "assistant")
    assert chat.conversations(chat.chains(df.limit(0))).count() == 0


def test_circles_of_replies(spark):
    """A message that replies to itself, circles of two and of five with replies below, beside a plain chain and a null tree."""
    rows = [(1, 5, 5), (1, 6, 5), (2, 3, 4), (2, 4, 3), (2, 9, 3), (2, 1, 9)]
    rows += [(3, 10 + i, 10 + (i + 1) % 5) for i in range(5)] + [(4, i, i - 1 if i else None) for i in range(12)]
    rows += [(None, 1, 2), (None, 2, 1), (None, 7, 1)]
    df = spark.createDataFrame([(t, m, p, 0.0, "user", f"{m}") for t, m, p in rows], "tree long, message long, parent long, score double, role string, text string")
    found = defaultdict(list)
    for r in chat.paths(df).collect():
        found[r.tree, r.leaf].append((r.place, r.message))
    # 5 -> 5; 3 <-> 4 opens at 3; 10 -> 11 -> .. -> 14 -> 10 opens at 10, whose replies run 14, 13, 12, 11
    assert {k: [m for _, m in sorted(v)] for k, v in found.items()} == {
        (1, 6): [5, 6], (2, 1): [3, 9, 1], (2, 4): [3, 4], (3, 11): [10, 14, 13, 12, 11], (4, 11): list(range(12)), (None, 2): [1, 2], (None, 7): [1, 7],
    }
    assert chat.conversations(df).count() == 7


def test_a_long_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} <" + "x" * (200_000 if i == 500 else 3)) for i in range(3_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat.conversations(chat.chains(df)).select(chat.turns("formatted").alias("turns")).first()
    assert [(t.role, t.text) for t in r.turns] == [x[2:] for x in rows]


def test_reply_trees(spark):
    """Every root-to-leaf path, and the best ones, of random trees."""
    choose = random.Random(5)
    rows = []
    for tree in range(30):
        for m in range(choose.randint(1, 25)):
            parent = None if m == 0 or choose.random() < 0.1 else choose.randrange(m) if choose.random() < 0.95 else 999
            rows.append((tree, m, parent, choose.choice([0.0, 1.0, 2.5, None]), "user", f"{tree}.{m}"))
    df = spark.createDataFrame(rows, "tree long, message long, parent long, score double, role string, text string")
    by = {(t, m): (p, s or 0.0) for t, m, p, s, _, _ in rows}

    def path(t, m):
        out = []
        while (t, m) in by:
            out.append(m)
            m = by[t, m][0]
        return out[::-1]

    leaves = [(t, m) for t, m in by if not any(t2 == t and p == m for (t2, _), (p, _) in by.items())]
    found = defaultdict(list)
    for r in chat.paths(df).collect():
        found[r.tree, r.leaf].append((r.place, r.message))
    assert {k: [m for _, m in sorted(v)] for k, v in found.items()} == {k: path(*k) for k in leaves}
    assert all([p for p, _ in sorted(v)] == list(range(1, len(v) + 1)) for v in found.values())
    best = defaultdict(list)
    for t, m in leaves:
        best[t].append((-sum(by[t, x][1] for x in path(t, m)) / len(path(t, m)), m))
    chosen = {(r.tree, r.leaf) for r in chat.paths(df, branches=2).select("tree", "leaf").distinct().collect()}
    assert chosen == {(t, m) for t, v in best.items() for _, m in sorted((round(s, 9), m) for s, m in v)[:2]}


# -- vectors -----------------------------------------------------------------


def nearest(rows, every, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = set()
    for i, v in ok:
        if i % every:
            continue
        scores = sorted((-round(float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))), 12), j) for j, w in ok if j != i)
        out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])}
    return out


def test_exact_on_few_vectors(spark):
    """One part: the result is that of brute force, with ties, copies, unusable and missing rows."""
    draw = random.Random(2)
    rows = [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, rows[10][1]) for i in range(30)] + [(300, rows[10][1])]
    rows += [(400, None), (401, []), (450, [0.0] * 4), (402, [1.0, None, 2.0, 3.0]), (403, [float("nan"), 1.0, 1.0, 1.0]), (404, [float("inf"), 1.0, 1.0, 1.0]), (None, rows[1][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("own"))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    for chunk in (20_000, 7):
        found = {(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in neighbours.search(df, every=10, chunk=chunk).collect()}
        assert found == nearest(rows, 10, 5)
    assert neighbours.search(df.limit(0)).count() == 0
    assert neighbours.search(df.filter("vec_id = 0")).count() == 0
    assert neighbours.search(df.filter("vec_id < 3"), every=1).count() == 6


def test_every_length_is_searched(spark):
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0, 1) for _ in range((4, 3, 4, 1)[i % 4])]) for i in range(200)] + [(1000, [1.0, 2.0, 3.0, 4.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = set()
    for d in {len(v) for _, v in rows}:
        expected |= nearest([r for r in rows if len(r[1]) == d], 5, 5)
    found = {(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in neighbours.search(df, every=5).collect()}
    assert found == expected and len({q for q, *_ in found}) == 40


@pytest.mark.parametrize("chunk", [20_000, 40])
def test_any_number_of_ties(spark, chunk):
    """A hundred different vectors with the very same cosine: the smallest ids are nearest."""
    rows = [(1000 - i, [2.0 ** (i - 50), 0.0]) for i in range(100)] + [(i, [0.0, float(i)]) for i in range(1, 50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = {(r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.search(df, every=100, chunk=chunk).collect()}
    assert found == {(1000, n + 1, 901 + n, 1.0) for n in range(5)}


def test_recall_on_embeddings(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    expected = nearest([(r.vec_id, r.embedding) for r in table.collect()], 50, 5)
    found = {(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in neighbours.search(table).collect()}
    assert len({x[::2] for x in found} & {x[::2] for x in expected}) >= 0.9 * len(expected)


def test_recall(spark, monkeypatch):
    """Many parts over clustered vectors: the recall asked for, from part of the comparisons."""
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(40, 32))
    vectors = centres[draw.integers(0, 40, 4000)] + 0.4 * draw.normal(size=(4000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    expected = nearest([(i, v.tolist()) for i, v in enumerate(vectors)], 50, 5)
    found = {(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in neighbours.search(df).collect()}
    assert len({x[::2] for x in found} & {x[::2] for x in expected}) >= 0.9 * len(expected)
    router, probes = neighbours.fit(vectors, 5)
    assert probes <= router.w2.shape[1] // 2


def test_parts_are_balanced():
    draw = np.random.default_rng(3)
    unit = neighbours.units(draw.normal(size=(1000, 16)) + 4 * np.eye(16)[draw.integers(0, 3, 1000)])
    part = neighbours.balanced_parts(neighbours.neighbour_graph(unit, 8), 8)
    sizes = np.bincount(part, minlength=8)
    assert sizes.min() >= 110 and sizes.max() <= 140


# -- pipeline and queries ------------------------------------------------------


def stage_by_stage(docs, verdicts, copies):
    """Plain stages; the verdicts of the fences and the draws of the mix are given."""
    rows = [r for r in docs if verdicts[r["doc_id"]]]
    groups = plain.groups([(r["doc_id"], r["text"]) for r in rows], corpus_pipeline.LINK)
    least = {}
    for r, (_, _, root) in zip(rows, groups, strict=True):
        if root not in least or r["doc_id"] < least[root]["doc_id"]:
            least[root] = r
    rows = list(least.values())
    cut = plain.kept_words([(r["doc_id"], r["text"]) for r in rows])
    return [(d, [x for x, g in zip(w, gone) if not g]) for d, w, gone in cut for _ in range(copies.get(d, 0))]


def test_pipeline(spark, sf_dir, sample_docs):
    from loanloom.llm import quality, setsketch, substring

    verdicts = {r.doc_id: r.kept for r in quality.rules(sample_docs).collect()}
    before = substring.deduplicated(setsketch.deduplicated(quality.kept(sample_docs), link=corpus_pipeline.LINK))
    copies = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
    expected = stage_by_stage([r.asDict() for r in sample_docs.collect()], verdicts, copies)
    use = bpe.codec(bpe.default_vocabulary())
    found = corpus_pipeline.run(spark, sf_dir).collect()
    decoded = [(r.doc_id, tuple(plain.words(use.decode(r.ids).decode()))) for r in found]
    assert Counter(decoded) == Counter((d, tuple(w)) for d, w in expected)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "source_mixing", "byte_bpe"]


def test_stage_links_at_80(spark):
    """A pair of similarity 0.82 is one document to the stage and two to the query; 0.77 are two to both."""
    from loanloom.llm import setsketch

    def pair(i, changed):
        words = [f"w{i}x{k}" for k in range(204)]
        return [(10 * i, " ".join(words)), (10 * i + 1, " ".join([*words[: 204 - changed], *(f"n{k}" for k in range(changed))]))]

    # 200 shingles each: (200 - n) / (200 + n) is 0.818 for 20 and 0.770 for 26
    docs = spark.createDataFrame(pair(1, 20) + pair(2, 26), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [10, 20, 21]
    assert setsketch.near_duplicates(docs).filter("kept").count() == 4


def test_stages_on_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.schema == docs.schema
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_every_operator_is_registered():
    names = contract.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and "pipeline" in names
    assert set(QUERIES) <= set(names)


def test_chat_query(spark, sf_dir):
    def digest(x):
        return hashlib.sha256(x.encode()).hexdigest()

    tricky = "\\### Assistant: </turn> ok"
    turns = defaultdict(list, {-7: [(0, "user", tricky), (1, "assistant", tricky)]})
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    expected = set()
    for c, found in turns.items():
        found = [x[1:] for x in sorted(found)]
        loss = "".join(t for r, t in found if r == "assistant")
        expected.add((c, len(found), digest("".join(f"{r}\n{t}\n" for r, t in found)), len(loss), digest(loss), len(formatted(found))))
    assert {tuple(r) for r in QUERIES["op8_chat_format"](spark, sf_dir).collect()} == expected
