"""Main text of HTML pages by the distribution of text over line blocks.

Markup is stripped first: every block-level element becomes a line; scripts, styles, forms,
menus, headers, footers, sidebars, notices, adverts and reader comments (by element, role or a
word of their class or id) leave an empty line, a gap. Text lengths are then summed over sliding
windows of lines. A region begins where the sum surges and ends where it dives; lines
between are kept. Marks of the article (its element, main, a class name) are candidates that the
windows judge: the surest mark counts whose densest window is not beaten twice over by running text outside
it. Then lines outside are gaps too and any text makes a surge; without such a mark a surge needs as
much running text as a paragraph has, and text of links does not count.

An element that marks an article inside a wrapper with a class of page layout (sidebar, menu and the like) is
the weakest mark, so it counts where the page has no other; inside elements of that kind it is left out.

A null or empty page has an empty text, as has a page without any region. Every row
gives one row, also repeated rows. Only the named columns are read.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.session import ship_package

#: Lines of a window; text that makes a surge on pages without a marked article.
LINES, SURGE = 3, 80
#: Pages that are handled before their rows are sent on.
ROWS = 200

RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head nav footer aside form menu dialog button select svg template object canvas audio video map datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disclaimer discussion disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice "
    "notification overlay pagination popup promo promoted promotion recommended related replies reply respond share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
#: How surely an element marks the article; the surest marks on a page count.
ARTICLE = {"article": 3, "main": 2}
CONTENT = frozenset("article articlebody content entry maincontent post story".split())
#: Words that turn a class name into a remark about its element.
REMARKS = frozenset("has no not with without".split())
#: The words among them that also hold for elements that mark articles.
NOT_ARTICLES = frozenset("comment comments recommended related replies reply".split())
#: Words of page layout, which wrappers of a whole page may have too.
LAYOUT = frozenset("masthead menu modal nav navbar navigation overlay sidebar toolbar topbar".split())
#: Elements that end an open element of the same kind.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",)}

_token = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*+)>",
    re.S,
)
_attribute = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_part = re.compile(r"[a-z]+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")
_raw_end = {name: re.compile(rf"</{name}\b[^>]*>|\Z", re.I) for name in RAW}


def _marks(rest: str) -> tuple[set[str], set[str]]:
    """Words of class and id names, and the role."""
    words, roles = set(), set()
    if "=" in rest:
        for name, *values in _attribute.findall(rest):
            value = html.unescape(next((v for v in values if v), ""))
            if name.lower() == "role":
                roles.update(value.lower().split())
            else:
                for token in value.split():
                    parts = _part.findall(_camel.sub(" ", token).lower())
                    if parts and parts[0] not in REMARKS:
                        words.update(parts)
    return words, roles


def lines(page: str) -> list[tuple[str, int, int]]:
    """(text, characters in links, mark of the article around it) of every line; ("", 0, 0) is a gap."""
    out: list[tuple[str, int, int]] = []
    text: list[str] = []
    # name, dropped (1 by a form around it, which may hold a whole page, 3 by a class of page layout), mark of the article
    stack: list[tuple[str, int, int]] = []
    linked, at = [0], 0

    def flush(gap: bool = False) -> None:
        line = " ".join("".join(text).split())
        text.clear()
        if line:
            out.append((line, min(linked[0], len(line)), stack[-1][2] if stack else 0))
        linked[0] = 0
        if gap and (not out or out[-1][0]):
            out.append(("", 0, 0))

    def add(piece: str) -> None:
        if piece and not (stack and stack[-1][1]):
            plain = html.unescape(piece)
            text.append(plain)
            if any(name == "a" for name, _, _ in stack[-4:]):
                linked[0] += len(plain.strip())

    def leave(k: int) -> None:
        """Close the elements from `k` on."""
        if any(x[0] in BLOCKS or x[1] for x in stack[k:]):
            flush(gap=bool(stack[k][1]) and not (k and stack[k - 1][1]))
        del stack[k:]

    while match := _token.search(page, at):
        add(page[at : match.start()])
        at = match.end()
        name = (match["name"] or match["name2"] or "").lower()
        if not name:
            continue
        if match["close"] or match["close2"]:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if k is not None:
                leave(k)
            elif name in BLOCKS:
                flush()
            continue
        if name in RAW:
            at = _raw_end[name].search(page, at).end()
            continue
        if name in BLOCKS:
            k = next((k for k in range(len(stack) - 1, max(-1, len(stack) - 4), -1) if stack[k][0] == "p"), None)
            if k is not None:
                leave(k)
            if stack and stack[-1][0] in SIBLINGS.get(name, ()):
                leave(len(stack) - 1)
            flush()
        if name in ("br", "td", "th"):
            text.append(" ")
        if name in VOID:
            continue
        if name == "body":
            while stack and stack[-1][0] == "head":
                leave(len(stack) - 1)
        dropped, level = (stack[-1][1], stack[-1][2]) if stack else (0, 0)
        words, roles = _marks(match["rest"] or match["rest2"] or "")
        revived = dropped in (1, 3) and name in ARTICLE
        weakest = dropped == 3
        if revived:
            dropped = 0
        if dropped in (0, 3) and name not in ("html", "body"):
            unwanted = name in DROPPED or roles & ROLES or (name == "header" and not level)
            if unwanted or words & (NOT_ARTICLES if name in ARTICLE else MARKS):
                if not dropped:
                    flush(gap=True)
                form = name == "form" and not dropped
                dropped = 1 if form else 2 if unwanted or words & MARKS - LAYOUT else 3
        if revived and weakest and not dropped:
            level = max(level, 1)
        elif not dropped:
            level = max(level, ARTICLE.get(name, 0), 2 if "main" in roles else 0, 1 if words & CONTENT else 0)
        stack.append((name, dropped, level))
    add(page[at:] if not page[at:].startswith("<") or len(page) - at < 2 else "")
    flush()
    return out


def window_sums(lengths: list[int], window: int) -> list[int]:
    return [sum(lengths[i : i + window]) for i in range(len(lengths))]


def article_level(found: list[tuple[str, int, int]], window: int = LINES, surge: int = SURGE) -> int:
    """The surest mark whose densest window holds against the running text outside it; 0 if none does."""
    for mark in sorted({level for _, _, level in found if level}, reverse=True):
        inside = max(window_sums([len(t) if level >= mark else 0 for t, _, level in found], window))
        outside = max(window_sums([len(t) - linked if level < mark else 0 for t, linked, level in found], window))
        if outside < surge or outside <= 2 * inside:
            return mark
    return 0


def kept_lines(found: list[tuple[str, int, int]], window: int = LINES, surge: int = SURGE) -> list[str]:
    """The lines between surges and dives of the text in windows of lines."""
    marked = article_level(found, window, surge)
    if marked:
        lengths, least = [len(t) if level >= marked else 0 for t, _, level in found], 1
    else:
        lengths, least = [len(t) - linked for t, linked, _ in found], surge
    sums = window_sums(lengths, window)
    if sums and max(sums) < least:
        least = max(1, max(sums))  # the densest place of a page without a paragraph
    out, i, n = [], 0, len(lengths)
    while i < n:
        # a surge: enough text in the window, and its first line has some
        if sums[i] < least or not lengths[i]:
            i += 1
            continue
        while i < n and lengths[i]:  # up to the dive
            out.append(found[i][0])
            i += 1
    return out


def extract(page: str | None) -> str:
    return "\n\n".join(kept_lines(lines(page))) if page else ""


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    ship_package(pages.sparkSession)
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                texts = [extract(page) for page in rows["html"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows["page_id"], rows["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"]
                )

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
