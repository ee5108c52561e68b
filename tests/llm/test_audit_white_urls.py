"""Filter interactions, whitened vectors and url rules against plain versions."""

import math
import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.llm import filter_audit, url_filters, whitening
from loanloom.llm.oracles import ORACLES
from loanloom.llm.queries import RULES
from loanloom.llm.url_filters import Rule

# -- filter audit ----------------------------------------------------------------

LABELS = "doc_id long, quality int, toxic int"


def failures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = {"A"} if len(words) < 200 else set()
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
        out.add("C")
    if re.search("[#$%&*|]", text):
        out.add("D")
    return out


def plain_audit(docs, labels):
    """Every order applied filter by filter, on sets of row numbers."""
    ids = {}
    for r in docs:
        key = r["text"] or ""
        ids.setdefault(key, set()).add(math.inf if r["doc_id"] is None else r["doc_id"])
    fails, part = [], {}
    for i, r in enumerate(docs):
        own = failures(r["text"] or "")
        if min(ids[r["text"] or ""]) < (math.inf if r["doc_id"] is None else r["doc_id"]):
            own.add("E")
        fails.append(own)
        part.setdefault(r["source"] or "", []).append(i)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for name, rows in part.items():
        sums = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(rows)
            for step, f in enumerate(order, 1):
                gone = [i for i in left if f in fails[i]]
                left = [i for i in left if f not in fails[i]]
                sums[f] += len(gone)
                out[name, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(f in fails[i] for i in rows) - len(gone),
                    sum(fails[i] == {f} for i in rows),
                    sum(docs[i]["doc_id"] in good for i in gone),
                    sum(docs[i]["doc_id"] in toxic for i in gone),
                ]
        for (own, order, step), row in out.items():
            if own == name:
                row.append(sums[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found_audit(docs, labels):
    return {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(docs, labels).collect()}


def test_audit_on_edges(spark, edge_docs, edge_rows, no_docs):
    labels = [(1, 1, 0), (1, 0, 1), (5, None, None), (6, 0, 1), (7, 1, 1), (None, 1, 1), (99, 1, 1)]
    table = spark.createDataFrame(labels, LABELS).withColumn("part", F.lit("own"))
    docs = [dict(zip(("doc_id", "text", "lang", "source"), r[:4], strict=True)) for r in edge_rows]
    assert found_audit(edge_docs, table) == plain_audit(docs, labels)
    assert filter_audit.audit(no_docs, table).count() == 0
    none = spark.createDataFrame([], LABELS)
    assert {k: v[4:6] for k, v in found_audit(edge_docs, none).items()} == {k: (0, 0) for k in plain_audit(docs, [])}


def test_audit_on_hot_texts(spark):
    """A third of all rows are copies of one text, another third of one id."""
    draw = random.Random(5)
    rows = [(i, "same text") for i in range(400)] + [(7, f"Own {i} #") for i in range(400)] + [(1000 + i, " ".join(draw.choices("abcdefgh", k=300))) for i in range(400)]
    rows = [(d, t, "en", f"s{k % 3}") for k, (d, t) in enumerate(rows)]
    labels = [(d, d % 2, d % 3) for d in range(0, 1400, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(7)
    plain = plain_audit([dict(zip(("doc_id", "text", "lang", "source"), r, strict=True)) for r in rows], labels)
    assert found_audit(docs, spark.createDataFrame(labels, LABELS)) == plain


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 12345])
def test_positional_counts(n):
    words = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64)
    expected = [int(((words >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(32)]
    assert filter_audit.positional_counts(words).tolist() == expected


# -- whitening -------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, n string, x string, d string, copies string"


def plain_white(rows):
    """By length: ids, x, deviations and the leading eigenvectors of V."""
    out = {}
    for d in {len(v) for _, v in rows}:
        own = [(i, v) for i, v in rows if len(v) == d]
        x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in own]
        n, sums = len(own), [sum(col) for col in zip(*x)]
        deviations = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
        centred = np.array([[(n * a - s) / n for a, s in zip(r, sums)] for r in x], float).reshape(n, d)
        values, vectors = np.linalg.eigh(centred.T @ centred / n) if d else (np.zeros(0), np.zeros((0, 0)))
        out[d] = ([i for i, _ in own], n, deviations, centred, values[::-1], vectors[:, ::-1])
    return out


def check_white(found, rows):
    per_id = {}
    for r in found:
        per_id.setdefault((r.vec_id, r.component), []).append(r)
    expected_rows = 0
    for d, (ids, n, deviations, centred, values, vectors) in plain_white(rows).items():
        k = sum(values[:8] > 1e-12 * max(values.sum(), 1e-300))
        expected_rows += k * n
        for c in range(k):
            white = centred @ vectors[:, c] / np.sqrt(values[c])
            got = [per_id[i, c + 1] for i in ids]
            own = [min((r for r in many if r.n == n and r.deviation_exact == str(dev)), key=lambda r: abs(abs(r.whitened) - abs(w))) for many, dev, w in zip(got, deviations, white, strict=True)]
            sign = np.sign(sum(r.whitened * w for r, w in zip(own, white, strict=True)))
            assert np.allclose([r.whitened for r in own], sign * white, atol=1e-6)
            assert all(r.deviation == dev for r, dev in zip(own, deviations, strict=True) if dev < 2**63)
            assert all(r.deviation is None for r, dev in zip(own, deviations, strict=True) if dev >= 2**63)
            assert all(abs(r.explained / (values[c] / values.sum()) - 1) < 1e-9 and r.identity_error < 1e-6 for r in own)
    assert len(found) == expected_rows


def test_whitening_on_edges(spark):
    draw = np.random.default_rng(3)
    scales = np.linspace(1, 3, 12)
    rows = [(i, (draw.normal(size=12) * scales).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(300)] + [(7, rows[8][1]), (7, rows[8][1]), (None, rows[9][1])]
    short = [(5000 + i, draw.normal(size=3).tolist()) for i in range(40)]
    lonely, empty = [(6000, [1.0, 2.0])], [(6001, [])]
    equal = [(6100 + i, [0.5] * 5) for i in range(9)]
    bad = [(1, None), (2, [1.0, None]), (3, [float("nan")] * 12), (4, [float("inf")] + [0.0] * 11), (5, [-float("inf")] * 3), (6, [1e300, 0.0, 0.0])]
    good = rows + short + lonely + empty + equal
    df = spark.createDataFrame([(i, v, *["own"] * 4) for i, v in good + bad], VECTORS).repartition(5)
    check_white(whitening.whiten(df).collect(), good)
    assert whitening.whiten(df.limit(0)).count() == 0


def test_whitening_of_large_entries(spark):
    """Beyond 64 bits the deviations are still exact."""
    rows = [(i, [float(7**k * (i % 5 + 1)) for k in (1, 12, 15)]) for i in range(50)]
    df = spark.createDataFrame([(i, v, *["own"] * 4) for i, v in rows], VECTORS)
    found = {r.vec_id: r.deviation_exact for r in whitening.whiten(df).collect()}
    (ids, _, deviations, *_) = plain_white(rows)[3]
    assert found == {i: str(d) for i, d in zip(ids, deviations, strict=True)} and max(deviations) > 2**63


def test_whitening_of_embeddings(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    check_white(whitening.whiten(table).collect(), [(r.vec_id, r.embedding) for r in table.collect()])


# -- url filters -----------------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, rule string, u string, label string"


def canonical(href):
    return f'<head><link rel="canonical" href="{href}"></head>'


def refresh(url):
    return f"<meta content='0; URL={url}' HTTP-EQUIV=Refresh>"


URLS = [
    (1, "http://www.example.com/en/1", None, "allow"),
    (2, "http://sub.example.com/en/1", None, "block"),
    (3, "http://com/x", None, "allow"),
    (4, "http://notexample.com/en/1", None, "allow"),
    (5, "https://x.NET/es/1?a#b", "", "block"),
    (6, "https://x.net/en/1", canonical("https://x.net/es/1"), "block"),
    (7, "https://x.net/en/2#part", canonical("/en/1"), "block"),
    (8, "https://far.org/a/b", refresh("https://x.net/en/2"), "block"),
    (9, "https://far.org/a/c", "<p>" + refresh("b") + "</p>", "block"),
    (10, "https://good.org/1", canonical("http://www.example.com/en/1") + refresh("https://x.net/fr/9"), "allow"),
    (11, "https://good.org/2", canonical("?page=1"), "allow"),
    (12, "https://hidden.org/1", "<!-- " + canonical("https://x.net/es/1") + " --><script>'" + canonical("https://x.net/es/1") + "'</script>", "allow"),
    (13, "https://self.org/1", canonical("https://self.org/1#top"), "allow"),
    (14, "https://other.org/1", "<link rel='stylesheet' href='https://x.net/es/1'><link rel=canonical href=//x.net/es/1>", "block"),
    (15, "https://amp.org/1", canonical("https://y.net/fr/?a=1&amp;b=2"), "block"),
    (16, "https://amp2.org/1", canonical("https://y.net/fr/?a=1&b=2"), "block"),
    (17, None, canonical("https://x.net/es/1"), "allow"),
    (18, "no scheme", canonical("https://x.net/es/1"), "allow"),
    (19, "mailto:a@b.net", refresh("https://x.net/es/1"), "allow"),
    (20, "", None, "allow"),
    (21, "https://x.net", None, "allow"),
    (22, "https://x.net?q=/es/", None, "allow"),
    (22, "https://x.net?q=/es/", None, "allow"),
    (None, "https://x.net/es/", None, "block"),
    (23, "https://far.org/a/c", None, "block"),
    (24, "https://tricky.org/" + "é" * 3000, "<link " * 50_000 + "<!--" * 50_000, "allow"),
    (25, "HTTPS://Far.org/a/b", None, "block"),
    (26, "https://mailed.org/", canonical("mailto:x@y.net"), "allow"),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, *["own"] * 4) for r in rows], PAGES)


@pytest.mark.parametrize("in_plan", [200, 0])
def test_url_rules(spark, in_plan):
    df = pages(spark, [r[:3] for r in URLS])
    found = url_filters.judge(df, RULES, in_plan=in_plan).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    places = sorted(((r[0], *place(r[1])) for r in URLS), key=lambda r: str(r))
    assert sorted(((r.page_id, r.host, r.path) for r in found), key=lambda r: str(r)) == places
    assert sorted((str(r.page_id), r.verdict) for r in found) == sorted((str(r[0]), r[3]) for r in URLS)
    rule = {r.page_id: r.rule for r in found}
    assert [rule[k] for k in (1, 2, 3, 4, 5, 6, 17, 21)] == ["www.example.com/en/", "example.com/en/", "com/", "com/", "net/es/", None, None, None]
    assert sorted(map(key, found)) and url_filters.judge(df.limit(0), RULES, in_plan=in_plan).count() == 0


def place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host) :]).group()


def test_urls_against_sql(spark):
    rows = [r[:3] for r in URLS if r[0] != 24]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    names = "page_id, host, path, rule, verdict"
    expected = con.execute(f"SELECT {names} FROM ({ORACLES['op13_url_filters']})").fetchall()
    found = [tuple(r) for r in url_filters.judge(pages(spark, rows), RULES).select(*names.split(", ")).collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_long_chains_and_hubs(spark):
    """A chain of redirects, a hub with a third of all pages, loops and cycles, as a given table too."""
    chain = [(i, f"http://c.org/{i}", canonical(f"/{i + 1}")) for i in range(40)]
    hub = [(100 + i, f"http://h.org/{i}", refresh("http://hub.net/fr/home")) for i in range(300)]
    cycle = [(1000 + i, f"http://o.org/{i}", canonical(f"http://o.org/{(i + 1) % 7}")) for i in range(7)]
    rest = [(2000 + i, f"http://r{i % 50}.org/{i}", "<p>x</p>") for i in range(300)]
    redirects = spark.createDataFrame([("http://c.org/40", "http://x.net/es/1"), ("http://o.org/3", "http://o.org/3"), (None, "http://x.net/es/1"), ("x", None)], "u string, v string")
    df = pages(spark, chain + hub + cycle + rest).repartition(9)
    found = {r.page_id: r.verdict for r in url_filters.judge(df, RULES, redirects).collect()}
    assert found == {p: "block" if p < 1000 else "allow" for p, _, _ in chain + hub + cycle + rest}
    assert {r.verdict for r in url_filters.judge(df, RULES).filter("page_id < 40").collect()} == {"allow"}


def test_many_rules(spark):
    """The joined form equals the one in the plan; equal lengths go to the longer host, then to allow."""
    draw = random.Random(11)
    hosts = ["a.b.org", "b.org", "org", "xb.org", "net", "b.net"]
    rules = [Rule(draw.choice(["allow", "block"]), draw.choice(hosts), draw.choice(["/", "/p", "/p/q/", "", "/qq"])) for _ in range(25)]
    rules += [Rule("block", "org", "/same"), Rule("allow", "org", "/same")]
    rows = [(i, f"http://{draw.choice(['', 'w.'])}{draw.choice(hosts)}{draw.choice(['', '/', '/p', '/p/q/r', '/same', '/qq?'])}", None) for i in range(300)]
    forms = [sorted(map(tuple, url_filters.judge(pages(spark, rows), rules, in_plan=n).collect())) for n in (200, 0)]
    assert forms[0] == forms[1] and {r[4] for r in forms[0]} == {"allow", "block"}
    assert {r[4] for r in forms[0] if r[2] == "/same"} == {"allow"}
    assert url_filters.judge(pages(spark, rows), []).filter("verdict = 'allow' AND rule IS NULL").count() == 300
