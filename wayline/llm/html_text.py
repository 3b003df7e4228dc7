"""Main text of web pages by tag-path ratios.

A page is a sequence of text blocks, each under a root-to-leaf path of block tags. Per
path, over the page and in each container, the text length (link text counts for a
quarter) and the punctuation are added up and divided by the number of its blocks. The
ratios are smoothed over the page order, among blocks in the same surroundings, and fused. What stands in the container of a strong
path shares its strength (headings, lists and short lines of an article), what stands
elsewhere doesn't. Paths over a share of the page's best are content. Tags and class
names only exclude: menus, headers, footers, sidebars, notices, adverts, forms and
reader comments that say that they are.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts

# HTML's own element names, by what they are for.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
IN_HEAD = {"title", "meta", "link", "style", "script", "base", "noscript", "template"}
UNSHOWN = {"head", "title", "script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "select", "option", "button", "textarea", "dialog", "datalist"}
FRAME = {"nav", "footer", "aside", "menu", "form"}
INLINE_UNSHOWN = UNSHOWN - {"head", "dialog"}
BLOCK = {"html", "body", "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"} | UNSHOWN
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"} - UNSHOWN | {"form"}
SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Class names, ids and roles of parts beside the article, whole or with one of the words around them.
ASIDE = ("ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "sidebar", "aside", "widget", "related", "recommended", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "comment", "comments", "reply", "replies", "disqus", "pager", "pagination", "copyright", "legal", "disclaimer", "search", "complementary", "contentinfo", "alert", "alerts", "toolbar", "skip", "hidden")
BEFORE = ("site", "page", "main", "global", "top", "bottom", "left", "right", "cookie", "gdpr", "privacy", "user", "reader", "post", "article", "blog", "google", "primary", "secondary", "sub", "mobile", "social", "related", "footer", "header", "sidebar", "nav", "share", "comment", "comments", "newsletter", "ad", "alert", "skip")
AFTER = ("box", "container", "wrapper", "wrap", "area", "section", "list", "block", "bar", "banner", "links", "link", "menu", "item", "items", "slot", "unit", "content", "inner", "outer", "form", "thread", "buttons", "icons", "posts", "articles", "text", "notice", "message", "overlay")
MARK = re.compile(rf"(?:(?:{'|'.join(BEFORE)})[-_]?)?({'|'.join(ASIDE)})(?:[-_]?(?:{'|'.join(AFTER)}))?(?:[-_]?[0-9]+)?")
COMMENTS = {"comment", "comments", "reply", "replies", "disqus"}
# Of these an article may have its own.
OWN = {"header", "masthead"}
PUNCTUATION = re.compile(r"[.,;:!?¿¡…。，、！？]")
LINK_WEIGHT = 0.25
THRESHOLD = 0.13  # of the best path's score
HALF_LENGTH, HALF_MARKS = 30, 4  # a path's own ratios count in full far beyond these
FORM_PROSE = (100, 2)  # a form with a block of so many characters and sentence signs wraps text, as server-side forms wrap pages
DEEPEST = 256  # elements below count as in the one at this depth
OVERRULED = 0.1  # where what isn't excluded holds less of the page's score, class names are not believed


class _Blocks(HTMLParser):
    """Text blocks in page order: (path, text, length of link text, numbers of the elements
    around its own). A path's parts are names (tag and classes), those beside the article
    followed by ``!`` and what says so."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        # An element that hides its text, and is never closed, hides nothing.
        self.closings = Counter(x.lower() for x in re.findall(r"</([a-zA-Z]+)", html) if x.lower() in UNSHOWN)
        self.open: list[tuple[str, str, bool, int]] = []
        self.blocks: list[tuple[tuple[str, ...], str, int, tuple[int, ...]]] = []
        self.forms: list[list[tuple[int, int]]] = []  # of each block the forms around it: place in the path, number
        self.prose: set[int] = set()  # forms that hold prose
        self.number = 0
        self.text: list[str] = []
        self.linked = self.links = self.unshown = 0

    def flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            shown = [x for x in self.open if x[1]]
            self.blocks.append((tuple(x[1] for x in shown), text, self.linked, tuple(x[3] for x in shown[:-1])))
            forms = [(at, x[3]) for at, x in enumerate(shown) if x[0] == "form"]
            self.forms.append(forms)
            if len(text) - self.linked >= FORM_PROSE[0] and len(PUNCTUATION.findall(text)) >= FORM_PROSE[1]:
                self.prose.update(number for _, number in forms)
        self.text, self.linked = [], 0

    def close_from(self, at: int):
        if any(x[0] not in INLINE_UNSHOWN for x in self.open[at:]):
            self.flush()
        self.unshown -= sum(x[2] for x in self.open[at:])
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append("\n")
        if tag not in IN_HEAD and tag != "head" and self.open and self.open[-1][0] == "head":
            self.close_from(len(self.open) - 1)
        if tag in VOID or tag in UNSHOWN and tag not in ("head", "script", "style") and self.closings[tag] <= sum(x[0] == tag for x in self.open):
            if tag == "hr":
                self.flush()
            return
        if tag == "a":
            self.links += 1
        if tag not in BLOCK:
            return
        if tag not in INLINE_UNSHOWN:
            self.flush()
        closes = SIBLING.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name in closes:
                self.close_from(at)
                break
            if name in ("ul", "ol", "dl", "table", "article", "section", "div", "td", "th", "body"):
                break
        given = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden")}
        tokens = [x.lower() for k in ("class", "id", "role") for x in given.get(k, "").split()]
        marks = [m[1] for m in map(MARK.fullmatch, tokens) if m]
        inside = any(x[0] in ("article", "main") for x in self.open)
        if inside:
            marks = [m for m in marks if m not in OWN]
        if tag in FRAME or tag == "header" and not inside:
            marks.append(tag)
        if tag in ("article", "main", "html", "body"):
            marks = []
        name = ".".join([tag, *sorted(given.get("class", "").lower().split())])
        mark = "!".join(["", *marks])
        unshown = tag in UNSHOWN or "hidden" in given or given.get("aria-hidden") == "true"
        self.open.append((tag, "" if tag in ("html", "body") else name + mark, unshown, self.number))
        self.number += 1
        self.unshown += unshown

    def handle_endtag(self, tag):
        if tag in self.closings:
            self.closings[tag] -= 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag not in BLOCK or tag in ("html", "body"):
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.close_from(at)
                return
        if tag == "p":
            self.flush()

    def handle_data(self, data):
        if self.unshown:
            return
        self.text.append(data)
        if self.links:
            self.linked += len(data)


def blocks_of(html: str) -> list[tuple[tuple[str, ...], str, int, tuple[int, ...]]]:
    parser = _Blocks(html)
    parser.feed(html)
    parser.close()
    parser.flush()
    # A form that wraps prose is no form to fill in.
    wraps = lambda forms: {at for at, number in forms if number in parser.prose}
    bare = lambda path, at: tuple(part.replace("!form", "") if i in at else part for i, part in enumerate(path))
    return [(bare(path, wraps(forms)), *rest) for (path, *rest), forms in zip(parser.blocks, parser.forms)]


def _excluded(path: tuple[str, ...], believe_names: bool = True) -> bool:
    """Whether a part of the path is marked as beside the article, by its tag, as comments or, if they are believed, by other names."""
    for part in path:
        name, *marks = part.split("!")
        tag = name.split(".")[0]
        if any(believe_names or m in COMMENTS or m == tag for m in marks):
            return True
    return False


def _shared(a: tuple[str, ...], b: tuple[str, ...]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def path_ratios(paths: list, of: list[int], blocks) -> tuple[np.ndarray, np.ndarray]:
    """Text length and punctuation of each of the distinct ``paths``, for each of its blocks; ``of`` has each block's path."""
    length, marks, count = np.zeros(len(paths)), np.zeros(len(paths)), np.zeros(len(paths))
    for i, (_, text, linked, _) in zip(of, blocks):
        share = max(0.0, 1 - (1 - LINK_WEIGHT) * min(linked, len(text)) / len(text))
        length[i] += len(text) * share
        marks[i] += len(PUNCTUATION.findall(text)) * share
        count[i] += 1
    return length / count, marks / count


def path_scores(blocks) -> np.ndarray:
    """The score of each block: its path's, in the container that it stands in."""
    common = blocks[0][3]
    for b in blocks:
        common = common[: _shared(common, b[3])]
    around = [b[3][len(common) :][:DEEPEST] for b in blocks]
    containers = {c: i for i, c in enumerate(dict.fromkeys(around))}
    of = [containers[c] for c in around]

    # A path's ratios over the page and in the container, fused.
    every = {x: i for i, x in enumerate(dict.fromkeys(b[0] for b in blocks))}
    key = {x: i for i, x in enumerate(dict.fromkeys(zip((b[0] for b in blocks), of)))}
    whole = [every[b[0]] for b in blocks]
    group = [key[b[0], c] for b, c in zip(blocks, of)]
    ratios = np.sqrt(np.stack(path_ratios(list(every), whole, blocks))[:, whole] * np.stack(path_ratios(list(key), group, blocks))[:, group])
    alike: dict[tuple[int, int], float] = {}

    def likeness(i: int, j: int) -> float:
        key = (of[i], of[j])
        if key not in alike:
            alike[key] = 1.0 if of[i] == of[j] else (_shared(around[i], around[j]) / max(len(around[i]), len(around[j]), 1)) ** 2
        return alike[key]

    # Gaussian weights over the page order, times the blocks' lengths, times the containers' likeness.
    weight = np.array([len(b[1]) for b in blocks], float)
    smooth, total = np.zeros_like(ratios), np.zeros(len(blocks))
    for away in range(-2, 3):
        at = np.arange(max(0, -away), min(len(blocks), len(blocks) - away))
        near = at + away
        w = np.exp(-(away**2) / 2) * weight[near] * np.array([likeness(i, j) for i, j in zip(at, near)])
        smooth[:, at] += w * ratios[:, near]
        total[at] += w
    length, marks = (np.bincount(group, x * weight) / np.bincount(group, weight) for x in smooth / total)
    fused = length * (1 + marks)
    # A container is as strong as its best path; what stands beside it, in part of what is around it, shares little.
    strong = np.zeros(len(containers))
    np.maximum.at(strong, [c for _, c in key], fused)
    best: dict[tuple[int, ...], float] = {}
    for c, i in containers.items():
        for depth in range(len(c) + 1):
            best[c[:depth]] = max(best.get(c[:depth], 0.0), strong[i] * ((depth / len(c)) ** 3 if c else 1.0))
    held = [max(best[c[:depth]] for depth in range(len(c) + 1)) for c in containers]
    support = np.array([held[c] for _, c in key])
    # Of a path's own ratios it matters that there is text at all, not how much more than elsewhere.
    some = length / (length + HALF_LENGTH) * (1 + marks / (marks + HALF_MARKS))
    return (np.sqrt(some / some.max()) * support / support.max())[group]


def extract(html: str | None) -> str:
    """The page's main text, its blocks joined by a line feed; empty for no html."""
    blocks = blocks_of(html or "")
    kept = [b for b in blocks if not _excluded(b[0])]
    if len(kept) < len(blocks):
        # Names can be wrong about the article itself, which then holds nearly all of the page's score.
        told = [b for b in blocks if not _excluded(b[0], False)]
        if told and len(told) > len(kept):
            score = dict(zip(map(id, told), path_scores(told)))
            every, unmarked = (sum(score[id(b)] for b in part) for part in (told, kept))
            if unmarked < OVERRULED * every and max(len(b[1]) for b in told) > 10 * max([20, *(len(b[1]) for b in kept)]):
                kept = told
    if not kept:
        return ""
    score = path_scores(kept)
    return "\n".join(b[1] for b, x in zip(kept, score) if x >= THRESHOLD * score.max())


def extract_main_text(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns, ``text`` and ``n_chars`` (code points) of every row.

    A null or empty page, and one without text, gives an empty string. Repeated rows
    and pages of any length are handled row by row.
    """
    def texts_of(pages):
        texts = [extract(html) for html in pages]
        return [texts, [len(text) for text in texts]]

    return map_texts(pages, keep, html_column, texts_of, "text string, n_chars long")
