"""The main text of HTML pages.

Method: tree scoring.  Paragraphs pass points for their length and their commas to the
elements they stand in, the nearer the more, and an element's points are discounted by
the share of its text that is links.  The best element is kept, with those of its
siblings that score well beside it, are of its kind or hold running text, and with headings and
loose text of their parent.  A page without body is scored as one itself.

Menus, forms and the like are left out by their element before anything is scored.
Elements named in class, id or role as sidebars, widgets or the like are left out too,
unless they hold an article or main element or most of the paragraph points of what they
stand in: the article, or a page that has none.  Comments, adverts and notices can outweigh
a short article, so no points save them, and an article that is a comment counts as one.

Time is linear in the page: open elements are found by tag, and no bracket is searched for
an end twice.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rolehabit.llm.common import map_batches, query, table

_RAW = {"script", "style", "template", "textarea", "noscript", "iframe", "svg", "title", "noframes", "xmp"}
_DROPPED = _RAW | {"head", "nav", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "object", "canvas", "audio", "video"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby",
           "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
_PARAGRAPH = {"p", "pre", "td", "blockquote", "li", "dd", "dt"}
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
_FRAME = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "tr"}
#: A start tag ends an open one of these, unless one of the latter stands between.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_BOILERPLATE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "byline-share", "comment", "comments",
                "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "masthead", "menu", "menubar", "modal", "nav",
                "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "pager", "popup", "promo", "promoted", "related", "replies", "respond",
                "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "login", "signup"}
#: What a reader or an advertiser wrote, and what is about the site: the last word of such a name.
_REMARK = {"comment", "comments", "reply", "replies", "respond", "disqus"}
_FIRM = _REMARK | {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promoted", "notice", "notices", "cookie", "cookies",
                   "consent", "gdpr"}
#: Words behind it that only say that something is held.
_HOLDERS = {"area", "block", "body", "box", "container", "holder", "inner", "item", "list", "outer", "panel", "section", "thread", "wrap", "wrapper"}
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
#: A tag that the page ends within.
_CUT_TAG = re.compile(r"""</?[a-zA-Z][^\s<>]*+(?:\s++[^\s<>=]++\s*+=\s*+(?:"[^"]*+"?+|'[^']*+'?+|[^\s"'<>]*+))*+\s*+\Z""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_TAG_NAME = re.compile(r"</?[a-zA-Z][^\s/>]*+")
_QUOTES = re.compile("[>\"']")
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Words that make a name say that something is there or not, rather than what the element is.
_MODIFIERS = {"with", "without", "no", "has", "is", "not", "hide", "show"}


class Element:
    __slots__ = ("tag", "parent", "parts", "dropped", "named", "firm", "beyond", "points", "length", "linked", "commas")

    def __init__(self, tag: str, parent: Element | None, dropped: bool = False):
        self.tag, self.parent, self.dropped, self.named = tag, parent, dropped, False
        self.firm, self.beyond = False, self
        self.parts: list[str | Element] = []
        self.points, self.length, self.linked, self.commas = 0.0, 0, 0, 0


def _unwanted(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _DROPPED:
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    if tag == "header":  # an article's own header holds its title
        return not in_article
    for name, *values in _NAMES.findall(attributes):
        value = "".join(values)
        if name.lower() == "hidden" or (name.lower() == "aria-hidden" and value.lower() == "true"):
            return True
    return False


def _named(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether a class, the id or the role names something beside the article, and whether nothing can save it."""
    if tag in ("html", "body", "main"):
        return False, False
    named = firm = False
    for name, *values in _NAMES.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for token in "".join(values).split():
                words = [w.lower() for w in _WORDS.findall(token)]
                if not words or words[0] in _MODIFIERS:
                    continue
                named |= not _BOILERPLATE.isdisjoint(words)
                words = [w for w in words if not w.isdigit()]
                while words and words[-1] in _HOLDERS:
                    words.pop()
                firm |= bool(words) and words[-1] in (_REMARK if tag == "article" else _FIRM)
    return (firm, firm) if tag == "article" else (named or firm, firm)


class _Ends:
    """Whether a bracket has an end outside quotes, for pages where one was seen without: one pass from behind."""

    def __init__(self, page: str):
        self.at = [m.start() for m in _QUOTES.finditer(page)]
        self.end = [False] * (len(self.at) + 1)
        later: dict[str, int] = {}
        for k in range(len(self.at) - 1, -1, -1):
            c = page[self.at[k]]
            self.end[k] = c == ">" or (c in later and self.end[later[c] + 1])
            later[c] = k

    def after(self, place: int) -> bool:
        return self.end[bisect_left(self.at, place)]


def parsed(page: str) -> Element:
    """The page as a tree; end tags that fit nothing are passed over, missing ones are implied."""
    root = Element("root", None)
    path = [root]  # open elements
    opened: dict[str, list[int]] = defaultdict(list)  # their places in the path, by tag
    at, size, last, ends = 0, len(page), page.rfind(">"), None

    def close(depth: int) -> None:
        while len(path) > depth:
            opened[path.pop().tag].pop()

    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            tag = size
        here = path[-1]
        if tag > at:
            here.parts.append(html.unescape(page[at:tag]))
        if tag == size:
            break
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = end + 3 if end >= 0 else size
            continue
        if page.startswith(("<!", "<?"), tag):
            end = page.find(">", tag)
            at = end + 1 if end >= 0 else size
            continue
        found = None
        if tag < last:
            name_ends = ends and _TAG_NAME.match(page, tag)
            if not ends or (name_ends and ends.after(name_ends.end())):
                found = _TAG.match(page, tag)
            if not found:
                found = _PLAIN_TAG.match(page, tag)
                if found and not ends:
                    ends = _Ends(page)
        elif _CUT_TAG.match(page, tag):
            break
        if not found:  # a bracket that opens nothing is text
            here.parts.append("<")
            at = tag + 1
            continue
        at = found.end()
        name = found[2].lower()
        if found[1]:
            if opened.get(name):
                close(opened[name][-1])
            elif name == "br":
                here.parts.append(" ")
            continue
        closes, stops = _ENDS.get(name, (set(), set()))
        if name not in _INLINE and name != "br":
            closes, stops = closes | {"p"}, stops | {"table", "button", "object"}
        if any(opened.get(t) for t in closes):
            stop = max((opened[t][-1] for t in stops if opened.get(t)), default=0)
            # of each tag the first that is open within the stop
            inner = [opened[t][k] for t in closes if (k := bisect_right(opened[t], stop)) < len(opened[t])]
            if inner:
                close(min(inner))
                here = path[-1]
        if name in _VOID:
            if name not in _INLINE:
                here.parts.append(" ")
            continue
        child = Element(name, here, here.dropped or _unwanted(name, found[3], bool(opened.get("article") or opened.get("main"))))
        if not child.dropped:
            child.named, child.firm = _named(name, found[3])
        here.parts.append(child)
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
        elif not found[3].endswith("/") or name in _PARAGRAPH | {"div", "a"}:
            opened[name].append(len(path))
            path.append(child)
    return root


def _in_order(root: Element) -> list[Element]:
    """All elements that are not dropped, parents first."""
    found, waiting = [], [root]
    while waiting:
        element = waiting.pop()
        if not element.dropped:
            found.append(element)
            waiting += [p for p in reversed(element.parts) if isinstance(p, Element)]
    return found


def _points(e: Element, length: int, commas: int) -> float:
    """What the element gives as a paragraph; 0 if it is none."""
    direct = any(isinstance(p, str) and p.strip() for p in e.parts)
    if not length or not (e.tag in _PARAGRAPH or (direct and e.tag not in _INLINE)):
        return 0.0
    return (1 if length >= 25 else 0) + commas + min(length / 100, 3)


def _drop_named(root: Element) -> None:
    """Leave out named elements, but not what holds an article or, unless firm, most of an article's or the page's points."""
    elements = _in_order(root)
    held = {id(e): [0, 0, 0, 0.0, False] for e in elements}  # length, linked, commas, points, holds an article
    for e in reversed(elements):
        own = held[id(e)]
        texts = [p for p in e.parts if isinstance(p, str)]
        own[0] += sum(len(p.strip()) for p in texts)
        own[2] += sum(p.count(",") + p.count("，") + p.count("、") for p in texts)
        if e.tag == "a":
            own[1] = own[0]
        own[3] += _points(e, own[0], own[2]) * (1 - own[1] / own[0] if own[0] else 0)
        own[4] |= e.tag in ("article", "main") and not e.firm
        if e.parent:
            above = held[id(e.parent)]
            above[0] += own[0]
            above[1] += own[1]
            above[2] += own[2] if e.tag in _INLINE else 0
            above[3] += own[3]
            above[4] |= own[4]
    whole = held[id(root)][3]
    articles = any(e.tag in ("article", "main") and not e.firm and held[id(e)][3] for e in elements)
    within: dict[int, Element | None] = {}
    for e in elements:  # parents first
        within[id(e)] = (e.parent if e.parent.tag in ("article", "main") else within[id(e.parent)]) if e.parent else None
        if not e.named:
            continue
        *_, points, article = held[id(e)]
        around = within[id(e)]
        if e.firm:
            e.dropped = not article
        elif around:
            e.dropped = points <= held[id(around)][3] / 2
        else:
            e.dropped = not article and (articles or points <= whole / 2)


def _text(elements: list[str | Element]) -> str:
    """Their text: blocks and breaks part words, inline elements do not."""
    out: list[str] = []
    waiting: list[str | Element] = list(reversed(elements))
    while waiting:
        part = waiting.pop()
        if isinstance(part, str):
            out.append(part)
        elif not part.dropped:
            if part.tag not in _INLINE:
                out.append(" ")
                waiting.append(" ")
            waiting += reversed(part.parts)
    return " ".join("".join(out).split())


def main_text(page: str | None) -> str:
    """The article of a page; empty if it has no text."""
    root = parsed(page or "")
    _drop_named(root)
    elements = _in_order(root)
    for e in elements:  # lists and tables hold paragraphs for what they stand in
        if e.tag in _FRAME and e.parent:
            e.beyond = e.parent.beyond
    for e in reversed(elements):
        own = [p for p in e.parts if isinstance(p, str)]
        e.length += sum(len(p.strip()) for p in own)
        e.commas += sum(p.count(",") + p.count("，") + p.count("、") for p in own)
        if e.tag == "a":
            e.linked = e.length
        if e.parent:
            e.parent.length += e.length
            e.parent.linked += e.linked
            if e.tag in _INLINE:
                e.parent.commas += e.commas
        points = _points(e, e.length, e.commas)
        if points:
            direct = any(p.strip() for p in own)
            above, share = (e if direct and e.tag not in _PARAGRAPH else e.parent or e).beyond, 1.0
            level = 0
            while above and level < 4:
                above.points += points * share
                above, level = above.parent, level + 1
                share = 1 / 2 if level == 1 else 1 / (3 * level)
    scored = [(e.points * (1 - e.linked / e.length), -k, e) for k, e in enumerate(elements) if e.length and e.tag not in _INLINE | _FRAME]
    if not scored:
        return _text([root])
    best_score, _, best = max(scored, key=lambda s: s[:2])
    # a root that is best is judged by what stands in it
    whole = best.tag == "root"
    parent = best if whole else best.parent
    loose = [p for p in parent.parts if isinstance(p, Element) and not p.dropped and p.tag in _INLINE]
    length = sum(len(p.strip()) for p in parent.parts if isinstance(p, str)) + sum(p.length for p in loose)
    loose_kept = sum(p.linked for p in loose) < 0.5 * length
    kept: list[str | Element] = []
    for part in parent.parts:
        if isinstance(part, str) or part.tag in _INLINE:
            if part is best or loose_kept:
                kept.append(part)
            continue
        if part.dropped:
            continue
        density = part.linked / part.length if part.length else 1
        well = part.points > 0 and part.points * (1 - density) >= best_score / 5
        alike = part.tag == best.tag and part.points > 0 and density < 0.25
        running = part.tag in _PARAGRAPH and part.length > 80 and density < 0.25
        within = (whole or parent.tag in ("article", "main") or part.tag in _HEADING) and density < 0.5
        if part is best or well or alike or running or within:
            kept.append(part)
    return _text(kept)


def extract(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), page: str = "html") -> DataFrame:
    """One row per row of ``pages``: the keys, text, n_chars (code points).

    Null and empty pages, and pages without text, give an empty text.  Null keys and
    repeated rows keep one row each; other columns are left behind; an empty table gives
    an empty one.  One pass without a shuffle.
    """
    kinds = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    names = [*keys, "text", "n_chars"]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = [main_text(v) for v in batch.columns[-1].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names)

    return map_batches(pages.select(*keys, page), batches, f"{kinds}, text string, n_chars long")


@query()
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
