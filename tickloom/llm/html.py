"""Main text of HTML pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element. Containers that are never the article
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments, hidden
parts) leave an empty line; menus, headers and footers outside an article leave as many
as a window is wide, and so do the borders of outermost articles. Lines that are mostly link text count as
empty outside articles. The text lengths of `width` lines in a
row are summed: where the sum leaves zero is a surge, where it returns to zero a dive. All that lies
in the outermost <article> and <main> elements is one stretch, nested ones and several included. Of it and
the stretches between surge and dive outside, the one with the most text is the main text, whole: short
paragraphs between its ends count like long ones. A stretch outside is widened to the smallest container
(a div, section or cell of more than one line) around it, so menus in the midst of the content don't cut it;
without a container, to the next menu, header, footer or article.

A class, id or role tells of such a container only as a whole name or by its first word (after a word for a
place, as in site-footer), and not with a state behind it (comments-open). Articles and what
holds the page's main, or its only articles, are not left out for that, except in comments.

Defined results: a null or empty html, or a page without text, has the empty text; unclosed
elements end with the page, and an unclosed container hides only its own line; of stretches
with equal text the first is taken; repeated rows give repeated results; an empty table gives no
rows. Extra columns are ignored. Texts are never cut.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import slices, texts

WIDTH = 3
#: Share of link text from which a line outside an article is a menu.
LINK_SHARE = 0.6

# Names of HTML elements.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
LEFT_OUT = RAW | frozenset("head nav header footer aside form menu dialog button select svg canvas object audio video".split())
ARTICLE = frozenset("article main".split())
# Words in class, id or role that name what isn't the article.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert"
    " popup modal overlay newsletter subscribe subscription signup sidebar aside widget widgets comment comments commentlist respond replies disqus"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead footer colophon share sharing social related recommended"
    " complementary contentinfo search toolbar skip disclaimer".split()
)

# Those that name comments; words before them that tell their place, and words behind them that tell a state of what has the class.
COMMENTS = frozenset("comment comments commentlist respond replies disqus".split())
PLACES = frozenset("site page main primary secondary top bottom left right global".split())
STATES = frozenset("open closed enabled disabled on off".split())
#: Elements left out by their name that are not if they hold a main, or the page's only articles.
SPARED = frozenset("header footer aside form dialog".split())
#: What holds the content of a page without an article or main.
CONTAINERS = frozenset("div section td center blockquote".split())

#: Between what comes before and after these, outside an article, there is always a dive.
BORDERS = frozenset("nav header footer".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
GAP = re.compile(r"\s+")


def _tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, name or text, attributes); kind: text, open, close. What scripts and the like hold is left out."""
    out, at, size = [], 0, len(page)
    lower = None
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            out.append(("text", page[at:], ""))
            break
        if m.start() > at:
            out.append(("text", page[at : m.start()], ""))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        out.append(("close" if m[1] else "open", name, m[3]))
        if name in RAW and not m[1] and not m[3].endswith("/"):
            lower = page.lower() if lower is None and len(page.lower()) == size else lower
            end = lower.find(f"</{name}", at) if lower is not None else page.find(f"</{name}", at)
            if end >= 0:
                at = end
    return out


def _telling(name: str) -> str:
    """The word of MARKED that a class name is, or that it begins with; empty if there is none, or if it names a state."""
    first, *rest = [w for w in re.split(r"[^a-z0-9]+", name) if w] or [""]
    if first in PLACES and len(rest) == 1:
        first, rest = rest[0], []
    return first if first in MARKED and not (rest and rest[-1] in STATES) else ""


def _left_out(name: str, attributes: str, holds: bool = False) -> bool:
    """Whether an element is never the article. holds: whether it has an article or main in it that counts."""
    if name in LEFT_OUT and not (holds and name in SPARED):
        return True
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id", "role"):
            if name in ("body", "html", "main"):
                continue
            if name == "article":
                if "comment" in value.split():
                    return True
                continue
            words = {_telling(x) for x in value.split()} - {""}
            if words & COMMENTS or words and not holds:
                return True
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _closers(tokens: list[tuple[str, str, str]]) -> dict[int, int]:
    """For every opening tag that is closed, the place of its closing tag."""
    out: dict[int, int] = {}
    open_tags: dict[str, list[int]] = {}
    for i, (kind, name, attributes) in enumerate(tokens):
        if kind == "open" and name not in VOID and not attributes.endswith("/"):
            open_tags.setdefault(name, []).append(i)
        elif kind == "close" and open_tags.get(name):
            out[open_tags[name].pop()] = i
    return out


def _skipped(tokens: list[tuple[str, str, str]], closers: dict[int, int]) -> dict[int, int]:
    """For every opening tag of an element that is left out, the place behind the element.

    An element that holds a main, or the page's only articles, isn't left out for its name or class.
    """
    at = {n: [i for i, (kind, name, _) in enumerate(tokens) if kind == "open" and name == n] for n in ARTICLE}
    inside = lambda i, places: bool(places) and bisect_left(places, closers.get(i, i)) > bisect_right(places, i)

    def walk(of: list[str]) -> tuple[dict[int, int], bool]:
        out, i, any_article = {}, 0, False
        while i < len(tokens):
            kind, name, attributes = tokens[i]
            if kind == "open" and name not in VOID and _left_out(name, attributes, any(inside(i, at[n]) for n in of)):
                out[i] = closers.get(i, i) + 1
                i = out[i]
                continue
            any_article |= kind == "open" and name in ARTICLE
            i += 1
        return out, any_article

    out, any_article = walk(["main"])
    return out if any_article or not at["article"] else walk(["main", "article"])[0]


def lines(page: str, width: int = WIDTH) -> list[tuple[str, int, int]]:
    """The lines of a page with the place of their end and the outermost article or main they lie in (its number from 1, else 0).

    Empty lines stand where something was left out; those at borders have the place -1.
    """
    return _lines(_tokens(page), width)


def _lines(tokens: list[tuple[str, str, str]], width: int) -> list[tuple[str, int, int]]:
    closers = _closers(tokens)
    skipped = _skipped(tokens, closers)
    out: list[tuple[str, int, int]] = []
    parts: list[str] = []
    links = total = link_end = regions = 0
    skip_to, article_end, last = -1, 0, 0
    border = [("", -1, 0)] * width

    def flush() -> None:
        nonlocal links, total
        text = GAP.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append(("" if not article_end and total and links / total >= LINK_SHARE else text, last, regions if article_end else 0))
        parts.clear()
        links = total = 0

    for i, (kind, name, attributes) in enumerate(tokens):
        if i < skip_to:
            continue
        if article_end and i >= article_end:
            flush()
            article_end = 0
            out.extend(border)
        if kind == "text":
            parts.append(name)
            last = i if name.strip() else last
            n = len(name.strip())
            total += n
            links += n if i < link_end else 0
        elif kind == "open" and i in skipped:
            if name in BLOCKS or name in ("script", "style", "noscript", "template"):
                if name in BLOCKS:
                    flush()
                    if name in BORDERS and not article_end:
                        out.extend(border)
                    elif not out or out[-1][0]:
                        out.append(("", i, 0))
            else:
                parts.append(" ")
            skip_to = skipped[i]
        elif name in BLOCKS:
            flush()
            if kind == "open" and name in ARTICLE and not article_end:
                out.extend(border)
                regions += 1
                article_end = closers.get(i, len(tokens))
        elif name == "br":
            parts.append(" ")
        elif name == "a" and kind == "open":
            link_end = closers.get(i, i)
    flush()
    return out


def _container(found: list[tuple[str, int, int]], begin: int, end: int, tokens: list[tuple[str, str, str]]) -> tuple[int, int] | None:
    """The first and last line of the smallest container of the stretch that has more than one line; None if that is the page."""
    texts_at = [(place, k) for k, (text, place, _) in enumerate(found) if text]
    places = [place for place, _ in texts_at]
    first, last = (next(found[k][1] for k in order if found[k][0]) for order in (range(begin, end), range(end - 1, begin - 1, -1)))
    # Those that close last come first; the smallest one is the one that opens last.
    for a, b in sorted(((a, b) for a, b in _closers(tokens).items() if tokens[a][1] in CONTAINERS and a < first and b > last), reverse=True):
        low, high = bisect_left(places, a), bisect_left(places, b)
        if high - low > 1:
            return texts_at[low][1], texts_at[high - 1][1]
    return None


def main_text(page: str, width: int = WIDTH) -> str:
    """The main text, one block per line: all in the outermost articles and mains, or the blocks of the container in which
    those between the surge and the dive with the most text lie, whichever of the two has more."""
    tokens = _tokens(page)
    found = _lines(tokens, width)
    sizes = [len(text) if not region else 0 for text, _, region in found]
    best, best_size, begin, size, window = (0, 0), 0, None, 0, 0
    for i in range(len(found) + width):
        window += sizes[i] if i < len(found) else 0
        window -= sizes[i - width] if i >= width else 0
        if window and begin is None:  # surge
            begin, size = i, 0
        size += sizes[i] if i < len(found) else 0
        if not window and begin is not None:  # dive
            if size > best_size:
                best, best_size = (begin, min(i, len(found))), size
            begin = None
    if sum(len(text) for text, _, region in found if region) >= max(best_size, 1):
        return "\n".join(text for text, _, region in found if region and text)
    if not best_size:
        return ""
    begin, end = best
    held = _container(found, begin, end, tokens)
    if held:
        begin, end = min(begin, held[0]), max(end, held[1] + 1)
    else:  # In no container only borders end the text; lines of links don't.
        while begin and found[begin - 1][1] >= 0:
            begin -= 1
        while end < len(found) and found[end][1] >= 0:
            end += 1
    return "\n".join(text for text, _, _ in found[begin:end] if text)


def _extract(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2):
        found = [main_text(h, width) for h in texts(batch.column(2)).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, width: int = WIDTH) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of pages (page_id, url, html)."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(lambda b: _extract(b, width), f"page_id {kind}, url string, text string, n_chars long")
