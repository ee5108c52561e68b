"""URL rules whose block decisions follow redirects and canonical links to all aliases.

A rule is a host, a path prefix and a verdict. It fits its host and all subdomains, where the
url's path starts with its own; the longest one (host and path together) wins, then that of
the longer host, then allow. Pages without a rule take the decision of their aliases: the urls
that redirects and canonical links tie together, in whatever direction and number, form
a component, and a component with an explicitly allowed url is allowed, one with only blocked
ones is blocked. Targets that are no pages themselves count too. All else is allowed.

Links are read from the html: `<link rel=canonical href=..>` and `<meta http-equiv=refresh
content="0; url=..">`, outside comments, scripts and styles, references like `&amp;` decoded, relative
ones resolved against the page's url (dot segments stay); a tag ends at its first `>` and holds no `<`. A crawler's
redirects can be given as well. Aliases are compared without fragment and white space around, scheme and host in
lower case. Everything is built of DataFrame functions.

Null urls and urls without `://` have an empty host and path, fit no rule and have no
aliases; null html has no links. Repeated pages get equal verdicts. Without pages there are no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.session import stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space and control characters around a url are no part of it.
BLANK = "".join(map(chr, range(33)))
#: More rules than this are joined by host instead of being part of the plan.
IN_PLAN = 200


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """From the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule_host: Column, rule_path: Column) -> Column:
    host = F.col("host")
    under = (host == rule_host) | F.endswith(host, F.concat(F.lit("."), rule_host))
    return under & F.startswith(F.col("path"), rule_path)


def _rank(rule: Rule) -> tuple:
    return len(rule.name), len(rule.host), rule.verdict == "allow"


def judged(urls: DataFrame, rules: Sequence[Rule], in_plan: int = IN_PLAN) -> DataFrame:
    """`urls` with `rule` and `ruled` (its verdict) of the longest rule that fits host and path.

    A short list is one expression. The hosts of a longer one are looked up among the distinct
    hosts' endings; what comes back, the few rules above a host, joins to the urls.
    """
    if len(rules) <= in_plan:
        ordered = sorted(dict.fromkeys(rules), key=_rank, reverse=True)
        fits = [(_fits(F.lit(r.host), F.lit(r.path)), r) for r in ordered]
        none = F.lit(None).cast("string")
        return urls.withColumns(
            {
                "rule": F.coalesce(*[F.when(c, F.lit(r.name)) for c, r in fits], none),
                "ruled": F.coalesce(*[F.when(c, F.lit(r.verdict)) for c, r in fits], none),
            }
        )
    spark = urls.sparkSession
    rows = [(r.host, r.path, r.verdict, r.name, *map(int, _rank(r))) for r in dict.fromkeys(rules)]
    listed = stored(spark.createDataFrame(rows, "_of string, path string, ruled string, rule string, length int, own int, allows int"), "rules")
    hosts = stored(urls.select("host").distinct(), "hosts")
    labels = F.split("host", r"\.")
    endings = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    above = hosts.select("host", F.explode(endings).alias("_of")).join(listed, "_of")
    of_host = above.groupBy(F.col("host").alias("_host")).agg(F.collect_list(F.struct("length", "own", "allows", "path", "ruled", "rule")).alias("_rules"))
    # written, so that Spark can split the join where one host has very many urls
    of_host = stored(of_host, "host-rules")
    best = F.array_max(F.filter("_rules", lambda r: F.startswith(F.col("path"), r["path"])))
    joined = urls.join(of_host, F.col("host") == F.col("_host"), "left").withColumn("_best", best)
    return joined.withColumns({"rule": F.col("_best.rule"), "ruled": F.col("_best.ruled")}).drop("_host", "_rules", "_best")


def alias_of(url: Column) -> Column:
    """The url that aliases are compared by; null where there is no `://`."""
    shown = F.btrim(F.substring_index(url, "#", 1), F.lit(BLANK))
    found = F.regexp_extract(shown, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)", 0)
    rest = F.substr(shown, F.length(found) + 1)
    rooted = F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(F.length(found) > 0, F.concat(F.translate(found, CAPITALS, SMALL), rooted))


#: What the html of a page holds besides tags that count.
UNSEEN = r"(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script|$)|<style\b.*?(?:</style|$)"
WHOLE = "u IS NOT NULL AND v IS NOT NULL"
TAGS = r"(?i)<(?:link|meta)\s[^<>]*>"


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute, quoted or not."""
    pattern = rf"""(?i)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])


def _decoded(text: Column) -> Column:
    for reference, sign in (("&(?:quot|#34|#x22);", '"'), ("&(?:apos|#39|#x27);", "'"), ("&(?:sol|#47|#x2f);", "/"), ("&(?:colon|#58|#x3a);", ":"), ("&(?:amp|#38|#x26);", "&")):
        text = F.regexp_replace(text, f"(?i){reference}", sign)
    return F.btrim(text, F.lit(BLANK))


def _target(tag: Column) -> Column:
    """The url that a canonical link or a refresh names, as it is written; empty for other tags."""
    canonical = F.rlike(_attribute(tag, "rel"), F.lit(r"(?i)(^|\s)canonical(\s|$)"))
    refresh = F.lower(F.trim(_attribute(tag, "http-equiv"))) == "refresh"
    after = F.regexp_extract(_attribute(tag, "content"), r"""(?i)[;,]\s*(?:url\s*=\s*)?["']?\s*([^\s"']+)""", 1)
    is_link = F.rlike(tag, F.lit(r"(?i)^<link"))
    return _decoded(F.when(is_link & canonical, _attribute(tag, "href")).when(~is_link & refresh, after).otherwise(""))


def resolved(base: Column, reference: Column) -> Column:
    """A reference as a whole url; `base` is whole."""
    plain = F.regexp_replace(base, r"(?s)[?#].*$", "")
    scheme = F.regexp_extract(base, r"(?s)^([^:/?#]+:)//", 1)
    site = F.regexp_extract(base, r"(?s)^[^:/?#]+://[^/?#]*", 0)
    folder = F.regexp_extract(F.substr(plain, F.length(site) + 1), r"(?s)^.*/", 0)
    return (
        F.when(F.rlike(reference, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), reference)
        .when(F.startswith(reference, F.lit("//")), F.concat(scheme, reference))
        .when(F.startswith(reference, F.lit("/")), F.concat(site, reference))
        .when(F.startswith(reference, F.lit("?")), F.concat(plain, reference))
        .otherwise(F.concat(site, F.when(F.length(folder) > 0, folder).otherwise("/"), reference))
    )


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """u and v: the alias of each page and of every url that it names as its canonical or next one."""
    seen = F.regexp_replace(F.col(html_col), UNSEEN, "")
    tags = F.explode(F.regexp_extract_all(seen, F.lit(TAGS), F.lit(0))).alias("_tag")
    rows = pages.select(F.col(url_col).alias("_url"), tags).filter(F.rlike("_tag", F.lit("(?i)canonical|refresh")))
    # written without a filter on the results, which Spark would compute twice over
    named = stored(rows.select("_url", _target(F.col("_tag")).alias("_to")), "named").filter("_to <> '' AND _url IS NOT NULL")
    return stored(named.select(alias_of(F.col("_url")).alias("u"), alias_of(resolved(F.col("_url"), F.col("_to"))).alias("v")), "named-links").filter(WHOLE)


def components(edges: DataFrame) -> DataFrame:
    """node and label (the component's smallest node) for all nodes of the edges u, v.

    Large and small stars in turn: each node hands its larger, then its smaller neighbours to the
    least of them, until nothing moves; rounds grow with the logarithm of the longest chain. The
    least neighbours are folded in the tasks and written, so both sides of each join are plain shuffles,
    which Spark splits where one url has very many aliases.
    """

    def starred(rows: DataFrame) -> DataFrame:
        least = stored(rows.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.col("_u")).alias("m")), "least")
        return rows.join(least, F.col("u") == F.col("_u")).select("u", "v", "m")

    both = [F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")]
    edges = stored(edges.filter("u <> v").select(*both).distinct(), "links")
    before = None
    while (now := edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()) != before:
        before = now
        mirrored = stored(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "mirrored")
        large = stored(starred(mirrored).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        small = starred(large)
        moved = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def _placed(urls: DataFrame, url_col: str) -> DataFrame:
    return urls.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})


def decisions(edges: DataFrame, rules: Sequence[Rule], in_plan: int = IN_PLAN) -> DataFrame:
    """alias and verdict of every url in a component that has explicitly allowed or blocked urls."""
    nodes = stored(components(edges), "components")
    ruled = judged(_placed(nodes, "node"), rules, in_plan)
    verdict = F.when(F.bool_or(F.col("ruled") == "allow"), "allow").when(F.bool_or(F.col("ruled") == "block"), "block")
    known = ruled.groupBy(F.col("label").alias("_label")).agg(verdict.alias("followed"))
    known = stored(known.filter("followed IS NOT NULL"), "known")
    return nodes.join(known, F.col("label") == F.col("_label")).select(F.col("node").alias("_alias"), "followed")


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None, in_plan: int = IN_PLAN) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; `redirects` has whole urls u and v."""
    edges = links(pages)
    if redirects is not None:
        known = redirects.select(alias_of(F.col("u")).alias("u"), alias_of(F.col("v")).alias("v"))
        edges = edges.unionByName(stored(known, "redirects").filter(WHOLE))
    followed = stored(decisions(edges, rules, in_plan), "followed")
    rows = judged(_placed(pages.select("page_id", "url"), "url"), rules, in_plan)
    rows = rows.withColumn("_own", alias_of(F.col("url")))
    open_, closed = rows.filter("ruled IS NULL AND _own IS NOT NULL"), rows.filter("ruled IS NOT NULL OR _own IS NULL")
    joined = open_.join(followed, F.col("_own") == F.col("_alias"), "left").drop("_alias")
    rows = joined.unionByName(closed.withColumn("followed", F.lit(None).cast("string")))
    return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", "followed", F.lit("allow")).alias("verdict"))
