"""Main text of web pages as the maximum-scoring run of words and tags."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from cytoframe.llm.html_pages import labelled_pages

_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
_IN_TAG = re.compile(r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)")
#: A reference of more digits than Python would read at once.
_LONG_REFERENCE = re.compile(r"&#0*+(\d*+);?")
_CLASS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_MAYBE_HIDDEN = re.compile(r"hidden|none", re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Elements whose text is raw and never content.
_RAW = {"script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "select", "noframes"}
#: Elements that hold page furniture.
_OUTSIDE = {"head", "nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "label", "option"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "picture", "source", "input", "object", "canvas", "math", "semantics", "annotation", "mi", "mo", "mn", "ms", "mtext", "mrow", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot", "mover", "munder", "munderover", "mtable", "mtr", "mtd", "mstyle", "mspace"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Words of class, id and role that mark page furniture or content.
_FURNITURE = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "adbox", "adslot", "adunit", "banner", "sponsor", "sponsored", "promo", "promotion", "nav", "navbar", "navigation", "menu", "submenu", "topbar", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "header", "masthead", "comment", "comments", "commentlist", "commentform", "discussion", "disqus", "respond", "reply", "replies", "notice", "cookie", "cookies", "cookiebar", "cookiebanner", "consent", "gdpr", "alert", "popup", "modal", "overlay", "share", "sharing", "social", "related", "recommended", "subscribe", "subscription", "newsletter", "signup", "login", "form", "search", "widget", "pagination", "pager", "toolbar", "complementary", "contentinfo", "dialog", "hidden"}
_CONTENT = {"article", "content", "post", "entry", "story", "main", "body", "text", "articlebody"}
#: Names that wrappers of whole pages bear too, and headings that name their section's head.
_WEAK = {"header", "form", "banner", "widget", "search", "notice", "alert", "overlay", "modal", "promo", "promotion", "related"}
_OF_HEADINGS = {"header", "banner", "masthead"}
#: Words beside which a furniture word still says what an element is, where the name is an id within content.
_HOLDERS = {"box", "list", "area", "section", "wrapper", "wrap", "container", "block", "posts", "articles", "links", "bar", "slot", "unit", "inner", "site", "page", "top", "bottom", "left", "right"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: No tag costs less.
LEAST = -0.01
_ABOUT = {"has", "with", "no", "without", "is", "not"}
#: Classes that hide an element; in others, as overflow-hidden and hidden-xs, the word says something else.
_HIDING = {"hidden", "is-hidden", "visually-hidden"}
#: A name of these words alone, with "side", is a sidebar's; side-by-side is a layout.
_SIDES = {"side", "left", "right", "col", "column", "box", "area", "content"}
_SPLIT = re.compile(r"[^a-z]+")


def _hidden(attributes: str) -> bool:
    """Whether the attributes hidden, aria-hidden or style hide an element; what other ones say does not count."""
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").strip()
        if name == "hidden" and value.lower() != "false" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _NOT_SHOWN.search(value):
            return True
    return False


def _kind(name: str, attributes: str, within: bool = False) -> tuple[str, bool]:
    """"out" for furniture, "in" for marked content, else "", and whether it is furniture by a weak name alone.

    ``within`` marked content an id made of other words too, as form-factor, is a
    place in the text.
    """
    if name in _OUTSIDE:
        return "out", name in ("form", "header")
    if attributes:
        if _MAYBE_HIDDEN.search(attributes) and _hidden(attributes):
            return "out", False
        words, furniture = set(), set()
        for m in _CLASS.finditer(attributes):
            is_id = m[0][:2].lower() == "id"
            for name_ in (m[1] or m[2] or m[3] or "").lower().split():
                own = set(_SPLIT.split(name_)) - {""}
                if name_ in _HIDING:
                    furniture.add("hidden")
                own.discard("hidden")
                if own & _ABOUT:  # "has-sidebar" says what an element holds, not what it is
                    continue
                words |= own
                if not (within and is_id and own - _FURNITURE - _HOLDERS):
                    furniture |= own & _FURNITURE
                if "side" in own and own <= _SIDES:
                    furniture.add("sidebar")
        if name in _HEADINGS:
            furniture -= _OF_HEADINGS
        if furniture and name not in ("body", "html", "article", "main"):
            return "out", furniture <= _WEAK
        if words & _CONTENT:
            return "in", False
    return "in" if name in ("article", "main") else "", False


class _Open:
    """The open elements, with the places of what is asked for, so that each question takes one step at any depth."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool, str]] = []  # name, furniture, content, the tag's kind
        self.places: dict[str, list[int]] = {}
        self.furniture: list[int] = []
        self.solid: list[int] = []
        self.content = self.links = 0

    def push(self, name: str, kind: str) -> None:
        at = len(self.stack)
        self.stack.append((name, kind.endswith("out"), kind == "in", kind))
        self.places.setdefault(name, []).append(at)
        if kind.endswith("out"):
            self.furniture.append(at)
        if name not in _INLINE:
            self.solid.append(at)
        self.content += kind == "in"
        self.links += name == "a"

    def last(self, name: str) -> int:
        places = self.places.get(name)
        return places[-1] if places else -1

    def furniture_from(self, at: int) -> bool:
        return bool(self.furniture) and self.furniture[-1] >= at

    def pop(self) -> tuple[str, bool, bool, str]:
        own = self.stack.pop()
        at = len(self.stack)
        self.places[own[0]].pop()
        if self.furniture and self.furniture[-1] == at:
            self.furniture.pop()
        if self.solid and self.solid[-1] == at:
            self.solid.pop()
        self.content -= own[2]
        self.links -= own[0] == "a"
        return own


def markup(page: str) -> Iterator[tuple[int, int, str | None, str, str]]:
    """(start, end, name or None, slash, attributes) of each comment, declaration and tag, in one scan.

    A tag ends at the first > outside quotes, or, where its quotes do not
    close, at the first one; a < that no > follows is text.
    """
    at, last_end = page.find("<"), page.rfind(">")
    while at >= 0:
        end = -1
        name, slash, attributes = None, "", ""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4) + 3
            end = end if end > 2 else len(page)
        elif page.startswith("<![CDATA[", at):
            end = page.find("]]>", at + 9) + 3
            end = end if end > 2 else len(page)
        elif at < last_end:
            if page[at + 1] in "!?":
                end = page.find(">", at) + 1
            elif m := _NAME.match(page, at + 1):
                slash, name = m[1], m[2].lower()
                inner = _IN_TAG.match(page, m.end())
                close = inner.end() if inner else page.find(">", m.end())
                if close >= 0:
                    attributes, end = page[m.end() : close], close + 1
        if end > 0:
            yield at, end, name, slash, attributes
        at = page.find("<", max(end, at + 1))


def tokens(page: str) -> list[tuple]:
    """The tokens of a page (`_scan`), whatever the names of the elements around its text.

    An element of a weak name, as a form or a header, that holds most of a page's
    text is none of its furniture, where nothing else is marked as content.
    """
    held: list[tuple[int, int]] = []
    found, total, marked = _scan(page, frozenset(), held)
    around = frozenset(at for at, n in held if 2 * n > total)
    return _scan(page, around, [])[0] if around and not marked else found


def _scan(page: str, spared: frozenset[int], held: list[tuple[int, int]]) -> tuple[list[tuple], int, bool]:
    """A page as a list of ("w", text, in a link), ("t", name) and ("b",), where a block ends.

    Page furniture and raw elements are tags alone: their text never scores.
    Elements that nobody closes end with the one around them.  The work grows
    with the page's length, whatever is nested or left open in it.  Elements that
    start at ``spared`` places are no furniture; ``held`` gets (place, characters)
    of those of weak names.  Also the characters of all text, and whether marked
    content outside furniture has any.
    """
    out: list[tuple] = []
    total, marked = 0, False
    weak: dict[int, tuple[int, int]] = {}  # depth of an open element: its place, the characters before it
    own = _Open()
    ends: dict[str, tuple[int, int]] = {}  # the next end tag of a raw element, where one was looked for
    position = 0
    for start, end, name, closing, attributes in markup(page):
        if start < position:  # within a raw element
            continue
        if start > position:
            total += len(page[position:start].strip())
            if not own.furniture:
                marked = marked or own.content > 0 and bool(page[position:start].strip())
                out.append(("w", page[position:start], own.links > 0))
        position = end
        if name is None:
            continue
        if name in _RAW:
            if closing:
                continue
            if ends.get(name, (0, 0))[0] < position:
                m = re.compile(rf"</{name}\s*+>", re.I).search(page, position)
                ends[name] = m.span() if m else (len(page) + 1, 0)
            found = ends[name][1]
            position = found if found else len(page) if name in ("script", "style") else position
            if name not in ("script", "style", "noscript", "template", "svg"):
                out.append(("b",))
            continue
        if name not in _INLINE:
            out.append(("b",))
        if closing:
            at = own.last(name)
            if at < 0:
                continue
            if own.furniture_from(at + 1) and name in ("p", "li", "span", "b", "i", "a", "em", "strong"):
                continue  # the end tag of something outside the furniture cannot close it
            while len(own.stack) > at:
                x = own.pop()
                if found := weak.pop(len(own.stack), None):
                    held.append((found[0], total - found[1]))
                out.append(("t", "/" + (x[3] or x[0])))
            continue
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and own.solid:
            # such elements end where the next one starts, with inline ones that are open in them
            at = own.solid[-1]
            if own.stack[at][0] == name and not own.furniture_from(at):
                while len(own.stack) > at:
                    own.pop()
                    if found := weak.pop(len(own.stack), None):
                        held.append((found[0], total - found[1]))
        kind, is_weak = _kind(name, attributes, own.content > 0)
        if start in spared:
            kind = ""
        elif kind == "out" and name == "header" and own.content and not own.furniture and not attributes:
            kind = ""  # an article's own head, with its title
        if own.content:  # within marked content nothing but its end is a border
            kind = "inner out" if kind == "out" else ""
        if kind != "in" or own.furniture or not _joined(out):
            out.append(("t", kind if kind else name))
        if name not in _VOID and not attributes.endswith("/"):
            if is_weak and kind.endswith("out"):
                weak[len(own.stack)] = start, total
            own.push(name, kind)
    if position < len(page):
        total += len(page[position:].strip())
        if not own.furniture:
            marked = marked or own.content > 0
            out.append(("w", page[position:], own.links > 0))
    held += [(at, total - before) for at, before in weak.values()]
    return out, total, marked


def _joined(out: list[tuple]) -> bool:
    """Whether marked content has ended right before; if so, without its end: what follows goes on with it."""
    k = len(out) - 1
    while k >= 0 and (out[k][0] == "b" or out[k][0] == "w" and not out[k][1].strip()):
        k -= 1
    if k >= 0 and out[k] == ("t", "/in"):
        del out[k]
        return True
    return False


def decoded(text: str) -> str:
    """``text`` with its character references decoded, whatever their length."""
    if "&#" in text:
        text = _LONG_REFERENCE.sub(lambda m: m[0] if len(m[0]) < 20 else f"&#{m[1]};" if 0 < len(m[1]) < 8 else "\ufffd", text)
    return html.unescape(text)


def blocks(page: str, weights: dict[str, float]) -> list[tuple[float, float, str]]:
    """Each block as (score of the tags before it, score of its words, its text)."""
    found: list[tuple[float, float, str]] = []
    tags, words, parts = 0.0, 0.0, []

    def close() -> None:
        nonlocal tags, words, parts
        text = " ".join(decoded("".join(parts)).split()) if parts else ""
        if text:
            found.append((tags, words, text))
            tags, words = 0.0, 0.0
        parts = []

    word, link = weights["word"], weights["link"]
    for token in tokens(page):
        if token[0] == "w":
            parts.append(token[1])
            words += (link if token[2] else word) * len(token[1].split())
        elif token[0] == "b":
            close()
        else:
            if token[1] == "br":
                parts.append(" ")
            elif token[1].lstrip("/") not in _INLINE:
                close()
            tags += weights.get(token[1], weights["other"] if token[1].lstrip("/") not in _INLINE else 0.0)
    close()
    return found


def best_run(scored: list[tuple[float, float, str]]) -> tuple[int, int]:
    """First and end block of the run with the greatest sum, in one scan; the earlier of equal ones."""
    best, top, start, total = (0, 0), 0.0, 0, 0.0
    for i, (tags, words, _) in enumerate(scored):
        if total + tags <= 0:
            start, total = i, 0.0
        else:
            total += tags
        total += words
        if total > top:
            best, top = (start, i + 1), total
    return best


@cache
def learned_weights(rounds: int = 30) -> tuple[tuple[str, float], ...]:
    """Weights under which the best run of each labelled page is its main text.

    A structured perceptron over tag counts: where the best run is wrong, tags
    of the true run gain and tags of the found one lose; words stay positive and
    tags negative.  The weights of the last step, after a round without a wrong
    page where there is one.
    """
    weights = {"word": 1.0, "link": 0.2, "other": -0.2, "in": -10.0, "/in": -10.0, "out": -5.0, "/out": -5.0, "inner out": LEAST, "/inner out": LEAST}

    def features(page_tokens: list[tuple], span: tuple[int, int]) -> dict[str, int]:
        counts: dict[str, int] = {}
        block, pending, open_ = -1, [], False
        for t in page_tokens:
            if t[0] == "w" and t[1].strip():
                if not open_:
                    block, open_ = block + 1, True
                    if span[0] < block < span[1]:
                        for name in pending:
                            counts[name] = counts.get(name, 0) + 1
                    pending = []
            elif t[0] == "b":
                open_ = False
            elif t[0] == "t" and t[1].lstrip("/") not in _INLINE:
                open_ = False
                pending.append(t[1])
        return counts

    pages = [(page, gold, tokens(page)) for page, gold in labelled_pages()]
    for _ in range(rounds):
        wrong = 0
        for page, gold, own in pages:
            scored = blocks(page, weights)
            texts = [x[2] for x in scored]
            true = next((i for i in range(len(texts)) if texts[i : i + len(gold)] == gold), None)
            span = best_run(scored)
            if true is not None and span != (true, true + len(gold)):
                wrong += 1
                plus, minus = features(own, (true, true + len(gold))), features(own, span)
                for name in set(plus) | set(minus):
                    weights[name] = min(LEAST, weights.get(name, weights["other"]) + 0.5 * (plus.get(name, 0) - minus.get(name, 0)))
        if not wrong:
            break
    return tuple(sorted(weights.items()))


def extract(page: str, weights: dict[str, float]) -> str:
    """The main text of one page, a line for each block; empty if there is none."""
    if not page:
        return ""
    scored = blocks(page, weights)
    start, end = best_run(scored)
    return "\n".join(text for _, _, text in scored[start:end])


def extract_pages(pages: DataFrame, max_rows: int = 500) -> DataFrame:
    """page_id, url, text, n_chars for every row: its main text from its whole html.

    Null and empty html gives an empty text; pages without any block too.  A tie
    goes to the earlier run.  Pages of any length and nesting are scanned once.
    Rows that repeat are extracted each, an empty table gives none, extra
    columns are not read.
    """
    weights = dict(learned_weights())
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), max_rows):
                part = batch.slice(start, max_rows)
                texts = [extract(x or "", weights) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
