"""DuckDB SQL of the numbered operators' queries, where SQL can express them.

The others rest on sketches (2), hashes of rows (3), a vocabulary (4), markup (5), trained
models (6, 7), a search that need not be exact (10) or eigenvectors (12); tests hold them against plain versions.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')".format
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRINGS = f"""
WITH docs AS (SELECT doc_id, {WORDS("text")} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM places WHERE i + 12 <= len(w)),
firsts AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k),
starts AS (SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM starts, (SELECT unnest(range(13)) AS j)),
kept AS (SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS text FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_ESCAPED = "replace(replace(replace({0}, '\\', '\\b'), '<', '\\l'), '>', '\\g')".format

CHAT = f"""
WITH turns AS (
 SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, turn, role, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)),
joined AS (
 SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum(length('<turn:' || {_ESCAPED("role")} || '>' || chr(10) || {_ESCAPED("text")} || '</turn>' || chr(10))) AS chars
 FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
 sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM joined
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {WORDS(LOWERED)} AS w FROM documents),
shingles AS (
 SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
 FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM docs)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
 SELECT u, v FROM common JOIN sizes x ON u = x.doc_id JOIN sizes y ON v = y.doc_id
 WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)),
reached(doc_id, other) AS (
 SELECT doc_id, doc_id FROM docs UNION SELECT reached.doc_id, v FROM reached JOIN links ON other = u),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_substring_dedup": SUBSTRINGS.strip(),
    "op8_chat_format": CHAT.strip(),
    "op9_setsketch_dedup": NEAR_DUPLICATES.strip(),
}

AUDIT = f"""
WITH letters(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
 SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
 FROM letters a, letters b, letters c, letters d, letters e WHERE (a.b | b.b | c.b | d.b | e.b) = 31),
steps AS (SELECT filter_order, CAST(k AS INT) AS step, bits[k] AS own, list_sum(bits[:k])::INT AS done FROM orders, (SELECT unnest(range(1, 6)) AS k)),
docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {WORDS("text")} AS w FROM documents),
flags AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failed AS (
 SELECT doc_id, part,
  CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN min(doc_id) OVER (PARTITION BY t) < coalesce(doc_id, 9223372036854775807) THEN 16 ELSE 0 END AS fails
 FROM docs),
cases AS (
 SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
 FROM failed LEFT JOIN flags USING (doc_id) GROUP BY ALL),
rows AS (
 SELECT part, filter_order, step, own,
  sum(CASE WHEN fails & done = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN fails & (done - own) = 0 AND fails & own > 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN fails & (done - own) > 0 AND fails & own > 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN fails & (done - own) = 0 AND fails & own > 0 THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN fails & (done - own) = 0 AND fails & own > 0 THEN toxic ELSE 0 END) AS toxic_lost
 FROM cases, steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
 CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
 CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM rows
"""

# URLs: written out once for each place of a column
_FOLDED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
_TRIMMED = r"regexp_replace({0}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')".format
_ATTRIBUTE = r"""(?i)[\s"''/]%s\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
_SIGNS = (("quot|#34|#x22", '"'), ("apos|#39|#x27", "''"), ("sol|#47|#x2f", "/"), ("colon|#58|#x3a", ":"), ("amp|#38|#x26", "&"))


def _host(c: str) -> str:
    return _FOLDED(f"regexp_extract(coalesce({c}, ''), '(?s)^.*?://([^/?#]*)', 1)")


def _path(c: str) -> str:
    return f"regexp_extract(coalesce({c}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _shown(c: str) -> str:
    return _TRIMMED(f"regexp_replace({c}, '(?s)#.*$', '')")


def _attribute(name: str) -> str:
    return " || ".join(f"regexp_extract(tag, '{_ATTRIBUTE % name}', {g})" for g in (1, 2, 3))


def _decoded(c: str) -> str:
    for reference, sign in _SIGNS:
        c = f"regexp_replace({c}, '(?i)&(?:{reference});', '{sign}', 'g')"
    return _TRIMMED(c)


def _alias(c: str) -> str:
    start = f"regexp_extract({c}, '(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 0)"
    rest = f"substr({c}, length({start}) + 1)"
    return f"CASE WHEN {start} <> '' THEN {_FOLDED(start)} || CASE WHEN starts_with({rest}, '/') THEN {rest} ELSE '/' || {rest} END END"


_REFRESH = r"""regexp_extract(%s, '(?i)[;,]\s*(?:url\s*=\s*)?["'']?\s*([^\s"'']+)', 1)""" % _attribute("content")

URLS = rf"""
WITH RECURSIVE rules(h, p, v) AS (
 VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
placed AS (SELECT page_id, url, {_host("url")} AS host, {_path("url")} AS path, {_shown("url")} AS shown FROM pages),
tags AS (
 SELECT url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script|$)|<style\b.*?(?:</style|$)', '', 'g'),
  '(?i)<(?:link|meta)\s[^<>]*>')) AS tag FROM pages),
named AS (
 SELECT url, {_shown("url")} AS shown,
  CASE WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches({_attribute("rel")}, '(?i)(^|\s)canonical(\s|$)') THEN {_decoded(_attribute("href"))}
   WHEN regexp_matches(tag, '(?i)^<meta') AND lower(trim({_attribute("http-equiv")})) = 'refresh' THEN {_decoded(_REFRESH)} ELSE '' END AS t
 FROM tags),
bases AS (
 SELECT shown, t, regexp_replace(url, '(?s)[?#].*$', '') AS plain, regexp_extract(url, '(?s)^([^:/?#]+:)//', 1) AS scheme,
  regexp_extract(url, '(?s)^[^:/?#]+://[^/?#]*', 0) AS site FROM named WHERE t <> ''),
whole AS (
 SELECT shown, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN t WHEN starts_with(t, '//') THEN scheme || t
  WHEN starts_with(t, '/') THEN site || t WHEN starts_with(t, '?') THEN plain || t
  ELSE site || coalesce(nullif(regexp_extract(substr(plain, length(site) + 1), '(?s)^.*/', 0), ''), '/') || t END AS full_url FROM bases),
targets AS (SELECT shown, {_shown("full_url")} AS target FROM whole),
links AS (SELECT u, v FROM (SELECT {_alias("shown")} AS u, {_alias("target")} AS v FROM targets) WHERE u IS NOT NULL AND v IS NOT NULL AND u <> v),
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reached(node, other) AS (SELECT u, u FROM both_ways UNION SELECT node, v FROM reached JOIN both_ways ON other = u),
nodes AS (SELECT DISTINCT other, {_host("other")} AS host, {_path("other")} AS path FROM reached),
ruled AS (
 SELECT other, arg_max(v, length(h) + length(p)) AS v FROM nodes JOIN rules
 ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY other),
followed AS (SELECT node, min(v) AS followed FROM reached JOIN ruled USING (other) GROUP BY node),
places AS (SELECT DISTINCT host, path FROM placed),
own AS (
 SELECT host, path, arg_max(h || p, length(h) + length(p)) AS rule, arg_max(v, length(h) + length(p)) AS verdict
 FROM places JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, followed, 'allow') AS verdict
FROM placed LEFT JOIN own USING (host, path) LEFT JOIN followed ON {_alias("shown")} = node
"""

ORACLES |= {"op11_filter_audit": AUDIT.strip(), "op13_url_filters": URLS.strip()}
