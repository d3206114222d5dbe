"""Main-text extraction from flat text blocks.

A page is cut into flat blocks at block-level tags. Each block has a word
count, a link density, those of its neighbours, and its place in the page. A
decision tree, grown from a small table of labelled pages, splits on these
first; what a page says itself about a block (inside a marked article, inside a
menu, footer or notice) are further features of its lower splits. A page
without any such marks is told by the block features alone.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

# HTML element names and the words that name page furniture in class, id and role.
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "textarea", "select", "title",
       "head", "button", "canvas", "audio", "video"}
SCRIPTS = {"script", "style"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "ruby", "rp", "rt", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "img", "input", "link", "meta", "source", "picture"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
FURNITURE = {"nav", "footer", "aside", "form", "dialog", "menu", "header"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert",
                   "menu", "menubar", "toolbar", "form"}
FURNITURE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo",
    "promotion", "menu", "navbar", "navigation", "nav", "breadcrumb", "breadcrumbs", "sidebar", "masthead", "footer",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "disclaimer", "popup", "modal", "overlay",
    "newsletter", "subscribe", "signup", "login", "search", "share", "sharing", "social", "related", "recommended",
    "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "widget", "toolbar", "pagination",
    "pager", "copyright", "topbar", "skip"}
# Words of layout: with these a furniture word names furniture (comment-list, left-sidebar), with others it need not
# (share-price, notice-of-appeal).
LAYOUT_WORDS = {
    "area", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "card", "col", "column", "container",
    "content", "desktop", "fixed", "float", "footer", "form", "frame", "global", "group", "head", "header", "holder",
    "icons", "inner", "item", "items", "js", "layout", "left", "links", "list", "main", "mobile", "module", "outer",
    "page", "panel", "post", "posts", "primary", "right", "row", "secondary", "section", "site", "slot", "sticky",
    "strip", "text", "title", "top", "unit", "wide", "wp", "wrap", "wrapper", "zone"}
MAIN_WORDS = {"article", "post", "entry", "story", "content", "main", "articlebody"}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z|(?=<))", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+))")
_RAW_END = {name: re.compile(rf"</{name}\s*>?", re.I) for name in RAW}
_WORD = re.compile(r"\w+")

BLOCK_FEATURES = ("words", "links", "prev_words", "prev_links", "next_words", "next_links", "before", "share", "heading")
MARKS = ("furniture", "main", "page_has_main")
FEATURES = BLOCK_FEATURES + MARKS

# Labelled pages, one a line, their blocks in page order: + main text or - the rest, words, /share of them in links in
# per cent, then h (heading), f (the page marks it as furniture), c (inside a marked main container).
LABELLED = """
-1/100f -1/100f -1/100f -14f +8hc +42c +57/2c +61c +1c +66c -12f
-2/100f -1/100f -9f +11hc +120c +33c +5c +88/4c -4/100f -22f
-1/100f -3/100f -30f +6hc +18c +44/9c +3c +3c +2c +71c -18/10f -35/5f -7f
-2/100 -1/100 -2/100 -3/100 +7h +54 +81/3 +46 +39 -6/50 -9
-1/100 -1/100 -1/100 -1/100 +9h +33 +62 +28/7 +5h +47 +70 -5/100 -4/100 -12
-3/100 -2/100 -6/100 +90 +64/2 +110 +38 -8/60 -3/100
+7h +36 +52 +41
+40 +35 +38
+12 +9 +14
+25 +31
+2
+6
+48
+4h +3
+5h +80
+8h +22 +17 +26
-5/100 -7/100 -6/100 -9/100 -4/100
-8/90 -12/85 -7/100 -15/80 -6/100
-2/100 -2/100 +6h +13 +28 +9 +31 +16 -3/100 -2/100 -7
-1/100 -2/100 -1/100 +4h +150 +2 +3 +95 +4 +130/1 -10/70 -14/100 -9/90 -8
-4/100 -3/100 +10h +27/15 +34/20 +45/12 +52/8 -11/100 -9/100 -13/100 -6
-1/100 -1/100 -4/75 +58 +6h +44 +5h +63 +4/25 +29 -2/100 -2/100 -11/30
-3/67 -2/100 -2/100 +75 +82 +91 -5/60 -4/100 -3/100 -5
+9h +66 +48/5 +73 -4/100 -5/100 -6/100 -3/100
+5h +21 +19 +24 +18 -2/100 -3/100 -2/100
-2/100 -1/100 -3/100 -2/100 -1/100 +12h +37 +4 +6 +5 +41 +29 -8/100 -6/100
-6f -2/100f +8hc +2/100c +45c +4/100c +50c +16/45c +25c -40/10f -75f -9f
-3/100f -48hf -27f +5hc +12c +10/60c +18c -64f -22f -6/50f -2f
-1/100f -15f +1c +120c +5/100c +2c -33f -10f
-30f -5f +10c +4c +80c -120f -41f -90f -8f
-2/100f -27 +9hc +90c +14c -35 -9 -15/5f
-1/100f -12 +6hc +55c +26c +70c -5 -22/10f
-5/100f -26f +33 +45/5 +90 +28 -7hf -60f -17f
-10f +7h +60 +6h +70 +4h +36 -5hf -62f -41f
-1/100 -2/100 -3/100 +15 +44 +11 +67 +23 -5/80 -6/100 -11/91
-2/100 -4/100 -3/100 +6h +8 +7 +9 +6 +8 +7 -2/100 -1/100
-1/100 -1/100 +5h +32 +9/44 +54 +7/29 +61 -1/100 -1/100 -4
-2/100 -5/100 -2/100 +3h +102 +2h +87 +3h +96 -7/100 -6/100 -5/100 -10
+11h +29 +33 +7/100 +46 +38 -3/100 -2/100 -4/100
-1/100 -2/100 +6h +420 +2 +380 +1 +510 +3 +290 -3/100 -6
+5h +500 +1 +2 +460 +1 +390 +2 +610
-2/100 -2/100 -3/100 +8h +310 +4 +1 +270 +2 +3 +450 +5 +330 -6/100 -4/100 -2/100
-1/100 -2/100 -1/100 +77 +3/100 +85 +52 -9/100 -2/100 -6/33
"""


def with_neighbours(page: list[dict]) -> list[tuple]:
    """The features of a page's blocks, in the order of ``FEATURES``."""
    has_main = any(b["main"] and not b["furniture"] and b["words"] for b in page)
    none = {"words": 0, "links": 0.0}
    unlinked = [b["words"] * (1 - b["links"]) for b in page]
    total, most, seen = sum(unlinked) or 1.0, max(unlinked, default=0) or 1.0, 0.0
    rows = []
    for k, b in enumerate(page):
        prev, following = page[k - 1] if k else none, page[k + 1] if k + 1 < len(page) else none
        rows.append((b["words"], b["links"], prev["words"], prev["links"], following["words"], following["links"],
                     seen / total, unlinked[k] / most, b["heading"], b["furniture"], b["main"], has_main))
        seen += unlinked[k]
    return rows


_LABELLED_BLOCK = re.compile(r"([+-])(\d+)(?:/(\d+))?(h?)(f?)(c?)")


def labelled_pages() -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, labels) of each labelled page."""
    pages = []
    for line in LABELLED.strip().splitlines():
        found = _LABELLED_BLOCK.findall(line)
        page = [{"words": int(n), "links": int(links or 0) / 100, "heading": bool(h), "furniture": bool(f),
                 "main": bool(c)} for _, n, links, h, f, c in found]
        pages.append((np.array(with_neighbours(page), dtype=float), np.array([float(m[0] == "+") for m in found])))
    return pages


# What marks say about a block: (furniture, main, page_has_main) and the label. What a page marks as furniture is none of
# its text whatever it looks like; what stands unmarked inside the marked article is the article's, outside of it the rest.
MARKED = (((1, 0, 0), 0), ((1, 0, 1), 0), ((1, 1, 1), 0), ((0, 1, 1), 1), ((0, 0, 1), 0))


def labelled_blocks(pages: list | None = None, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """All labelled blocks, and copies of them on marked pages, in ``rounds`` places each.

    A copy keeps its words, links and heading, and gets the marks, with their
    label, and the neighbours and place of other labelled blocks. All marks
    occur alike with each copy, so copies say nothing about block features.
    """
    pages = labelled_pages() if pages is None else pages
    x, y = np.concatenate([p[0] for p in pages]), np.concatenate([p[1] for p in pages])
    order = np.random.default_rng(0)
    xs, ys = [x], [y]
    neighbours, place = slice(2, 6), slice(6, 8)
    for _ in range(rounds):
        copies = x.copy()
        copies[:, neighbours] = x[order.permutation(len(x)), neighbours]
        copies[:, place] = x[order.permutation(len(x)), place]
        for marks, label in MARKED:
            xs.append(np.hstack([copies[:, :-3], np.tile(np.array(marks, float), (len(x), 1))]))
            ys.append(np.full(len(x), float(label)))
    return np.concatenate(xs), np.concatenate(ys)


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 12, least: int = 1, marks_from: int = 3, level: int = 0):
    """A binary tree by Gini impurity: (feature, threshold, below, above) or the label of a leaf.

    The block features split first; the marks follow on the three levels from
    ``marks_from`` on, then all features.
    """
    label = int(y.mean() >= 0.5)
    if level == depth or len(y) < 2 * least or y.min() == y.max():
        return label
    best = None
    n_block, n_all = len(BLOCK_FEATURES), len(FEATURES)
    first, last = (0, n_block) if level < marks_from else (n_block, n_all) if level < marks_from + len(MARKS) else (0, n_all)
    if (x[:, first:last] == x[:1, first:last]).all():
        first, last = 0, n_all
    for f in range(first, last):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], y[order]
        cuts = np.nonzero(v[1:] > v[:-1])[0]
        cuts = cuts[(cuts + 1 >= least) & (len(t) - cuts - 1 >= least)]
        if not len(cuts):
            continue
        ones = np.cumsum(t)
        n, m = cuts + 1.0, len(t) - cuts - 1.0
        a, b = ones[cuts], ones[-1] - ones[cuts]
        impurity = a * (1 - a / n) + b * (1 - b / m)
        i = int(np.argmin(impurity))
        if best is None or impurity[i] < best[0] - 1e-9:
            best = (impurity[i], f, (v[cuts[i]] + v[cuts[i] + 1]) / 2)
    if best is None:
        return label
    _, f, cut = best
    low = x[:, f] <= cut
    rest = (depth, least, marks_from, level + 1)
    return (f, float(cut), grow_tree(x[low], y[low], *rest), grow_tree(x[~low], y[~low], *rest))


@lru_cache(maxsize=1)
def tree():
    return grow_tree(*labelled_blocks())


def is_main(features: tuple, node=None) -> bool:
    node = tree() if node is None else node
    while isinstance(node, tuple):
        node = node[2] if features[node[0]] <= node[1] else node[3]
    return bool(node)


def _names_furniture(token: str) -> bool:
    """A class or id names furniture: a word of the list, alone or beside words of layout and numbers."""
    parts = [p for p in re.split(r"[_-]+", token) if p and not p.isdigit()]
    return any(p in FURNITURE_WORDS for p in parts) and all(p in FURNITURE_WORDS or p in LAYOUT_WORDS for p in parts)


def _names(attributes: str) -> tuple[set[str], set[str], bool]:
    """(classes and id, words of role, hidden or not)."""
    words, roles, hidden = set(), set(), False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            words |= set(value.split())
        elif key == "role":
            roles |= set(value.split())
        elif key == "style" and "display:none" in value.replace(" ", "") or key == "aria-hidden" and value == "true":
            hidden = True
    return words, roles, hidden


class _Context:
    """The open containers, innermost last: (name, furniture, main)."""

    def __init__(self):
        self.open: list[tuple[str, bool, bool]] = []
        self.furniture = self.main = False

    def enter(self, name: str, attributes: str) -> None:
        words, roles, hidden = _names(attributes) if attributes.strip() else (set(), set(), False)
        main = self.main or name in ("article", "main") or "main" in roles or any(
            MAIN_WORDS.issuperset(re.split(r"[_-]+", w)) for w in words)
        whole_page = name in ("html", "body")
        # the header of an article holds its title, that of a page its furniture
        own = name in FURNITURE and not (name == "header" and self.main)
        furniture = self.furniture or not whole_page and (
            own or hidden or bool(roles & FURNITURE_ROLES) or any(map(_names_furniture, words)))
        self.open.append((name, furniture, main))
        self.furniture, self.main = furniture, main

    def leave(self, name: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == name:
                del self.open[k:]
                break
        _, self.furniture, self.main = self.open[-1] if self.open else ("", False, False)


# Elements that a page may leave open; only their own attributes, not their nesting, are of use.
_LOOSE = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody", "tfoot"} | HEADINGS


def blocks(html: str) -> list[dict]:
    """Flat text blocks of a page in page order."""
    found: list[dict] = []
    context = _Context()
    pieces: list[str] = []
    linked: list[str] = []
    in_link = 0
    heading = False

    def flush() -> None:
        nonlocal heading
        text = re.sub(r"\s+", " ", unescape("".join(pieces))).strip()
        if text:
            n = len(_WORD.findall(text))
            links = min(n, len(_WORD.findall(unescape(" ".join(linked)))))
            found.append({"text": text, "words": n, "links": links / n if n else 0.0, "heading": heading,
                          "furniture": context.furniture or loose_furniture, "main": context.main})
        pieces.clear()
        linked.clear()

    def take(text: str) -> None:
        pieces.append(text)
        if in_link:
            linked.append(text)

    at, loose_furniture = 0, False
    while at < len(html):
        m = _MARKUP.search(html, at)
        if m is None:
            take(html[at:])
            break
        if m.start() > at:
            take(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                take(m[0][9:].removesuffix("]]>"))
            continue
        closing, name, attributes = m[1], m[2].lower(), m[3]
        if name in RAW:
            if not closing and not attributes.endswith("/") and name != "head":
                end = _RAW_END[name].search(html, at)
                # an element of controls that is left open ends with its tag, it doesn't take the page along
                at = end.end() if end else len(html) if name in SCRIPTS else at
            if name not in ("title", "head"):
                pieces.append(" ")
            continue
        if name == "a":
            in_link = 0 if closing else 1
            continue
        if name in INLINE:
            if name == "br":
                take(" ")
            continue
        flush()
        in_link = 0 if name not in _LOOSE else in_link
        if name in _LOOSE:
            heading = name in HEADINGS and not closing
            words, roles, hidden = _names(attributes) if attributes.strip() else (set(), set(), False)
            loose_furniture = not closing and (hidden or any(map(_names_furniture, words)) or bool(roles & FURNITURE_ROLES))
        elif closing:
            heading = loose_furniture = False
            context.leave(name)
        else:
            heading = loose_furniture = False
            if name not in VOID and not attributes.endswith("/"):
                context.enter(name, attributes)
    flush()
    return found


def main_text(html: str | None) -> tuple[str, int, int]:
    """(main text, its blocks, all blocks) of a page; null and empty pages give an empty text."""
    own = blocks(html or "")
    kept = [b["text"] for b, features in zip(own, with_neighbours(own)) if is_main(features)]
    return "\n".join(kept), len(kept), len(own)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_main_blocks, n_blocks) of every row of ``pages``.

    The whole html is read; a null or empty one, and one without main text,
    gives an empty text. Repeated rows give repeated answers, null ids and urls
    stay null, other columns are not read, an empty table gives no rows.
    """
    slim = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema.fields}

    def make():
        tree()

        def f(part):
            done = [main_text(h) for h in part["html"]]
            return {"page_id": part["page_id"], "url": part["url"], "text": [d[0] for d in done],
                    "n_chars": [len(d[0]) for d in done], "n_main_blocks": [d[1] for d in done],
                    "n_blocks": [d[2] for d in done]}
        return f

    return map_rows(slim, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, "
                          "n_main_blocks int, n_blocks int", make)
