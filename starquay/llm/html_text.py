"""Main text of web pages by tree scoring.

A page is read into a tree of elements. Paragraphs score by their length and commas, and
pass points to their ancestors, halved at each step; a container's score is discounted
by its link density. The best container is kept, with siblings that score like it or
read like text, and the headings and short paragraphs between and right beside them.
Elements that carry no article by their kind or name never count. Names that only hint at
that discount what a part scores, and drop nothing inside the container; nor does it
lose its lists of links. A form goes with its fields, unless the page is inside it.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds of elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
NO_TEXT = frozenset(
    "script style noscript template head title nav footer aside button select option textarea input iframe "
    "object embed canvas svg math audio video dialog menu noembed noframes xmp datalist".split()
)
# Start tags that end an open paragraph, and for items the kind they end.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
ENDS_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th")}
SCOPES = frozenset("table ul ol dl body html article section main div aside nav header footer".split())
# Words of class, id and role that name a part that is no article, and that name one.
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|overlay|"
    r"newsletter|subscri\w*|signup|login|nav|navbar|navigation|menu|breadcrumbs?|sidebar|widget|footer|"
    r"masthead|topbar|toolbar|share|sharing|social|related|recommend\w*|more-stories|comments?|comment-list|disqus|replies|"
    r"respond|pagination|pager|copyright|outbrain|taboola|hidden|"
    r"complementary|contentinfo|dialog)(?=$|[\s_-])",
    re.I,
)
# Words that only hint at it.
DOUBTFUL = re.compile(
    r"(?:^|[\s_-])(?:alert|side|foot|reply|responses|tags?|legal|disclaimer|search|form)(?=$|[\s_-])", re.I
)
HEADER = re.compile(r"(?:^|[\s_-])header(?=$|[\s_-])", re.I)
# Names that tell what a container has, not what it is; and where a capital parts words.
_HAVING = re.compile(r"(?:^|(?<=\s))(?:has|with|no)[_-][\w-]+", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text|page)(?=$|[\s_-])", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*+>|<\?[^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*\"[^\"]*+\"|=\s*'[^']*+'|[^>])*+)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_SPACES = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
MIN_PARAGRAPH = 25
DOUBT = 0.2
# A form that a page is inside of: the share of the text, and the characters per field.
FORM_SHARE = 0.5
FORM_TEXT = 80
FIELDS = frozenset("button select textarea input".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BETWEEN = HEADINGS | frozenset("p pre blockquote ul ol dl figure table".split())
_SENTENCE = re.compile(r"[.!?\u2026\u3002\uff01\uff1f][\"'\u201d\u2019\u00bb)]*(?:\s|$)")


class Element:
    __slots__ = ("tag", "parent", "items", "dropped", "named", "score", "brief", "length", "linked", "commas", "chars", "block", "inside", "doubtful")

    def __init__(self, tag: str, parent: Element | None, attributes: str, by_name: bool = True):
        self.tag, self.parent = tag, parent
        self.items: list[Element | str] = []
        self.score = self.brief = 0.0
        self.length = self.linked = self.commas = self.chars = 0
        self.block = tag not in INLINE
        self.named = self.dropped = False
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        names, hidden = [], False
        if attributes:
            for key, value in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), value.strip("\"'")
                if key in ("class", "id", "role"):
                    names.append(value)
                elif key in ("hidden", "aria-hidden", "style"):
                    hidden |= key == "hidden" or key == "aria-hidden" and value.lower() == "true"
                    hidden |= key == "style" and bool(_HIDDEN.search(value))
        name = _CAMEL.sub("-", _HAVING.sub("", " ".join(names))) if names and by_name else ""
        plain = tag in ("html", "body", "main", "article", "h1")
        self.named = tag in ("article", "main") or bool(name and LIKELY.search(name))
        unlikely = not plain and bool(name) and bool(UNLIKELY.search(name))
        heads = tag == "header" or not plain and bool(name) and bool(HEADER.search(name))
        self.dropped = tag in NO_TEXT or hidden or unlikely or heads and not self.inside
        self.dropped |= tag == "article" and "comment" in name.lower()
        self.doubtful = not plain and bool(name) and bool(DOUBTFUL.search(name))


class _Open:
    """The open elements from the root on, and where those of a tag, blocks and scopes stand
    among them, so that no tag is looked for by climbing."""

    def __init__(self, root: Element):
        self.elements = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks, self.scopes = [0], [0]

    def last(self, tag: str) -> int:
        """Place of the innermost open element of a tag; 0, the root's, if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def enter(self, node: Element) -> None:
        place = len(self.elements)
        self.elements.append(node)
        self.places.setdefault(node.tag, []).append(place)
        if node.block:
            self.blocks.append(place)
        if node.tag in SCOPES:
            self.scopes.append(place)

    def cut(self, place: int) -> Element:
        """Leave the element at ``place`` and all in it; the one that is then innermost."""
        while len(self.elements) > place:
            self.places[self.elements.pop().tag].pop()
        for held in (self.blocks, self.scopes):
            while held[-1] >= place:
                held.pop()
        return self.elements[-1]

    def close(self, tags: tuple[str, ...]) -> Element:
        """Leave the nearest open element of ``tags``, if no other container is between."""
        place = max(self.last(tag) for tag in tags)
        return self.cut(place) if place > self.scopes[-1] else self.elements[-1]


def parse(page: str, by_name: bool = True) -> Element:
    """A tree in which every end tag, missing or not, closes what the HTML rules close.
    Without ``by_name`` class, id and role do not drop an element."""
    root = Element("html", None, "")
    node, at = root, 0
    size = len(page)
    stack = _Open(root)
    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            node.items.append(page[at:])
            break
        if found.start() > at:
            node.items.append(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            # An inline end tag does not close blocks, and an unknown one closes nothing.
            place = stack.last(tag)
            if place and not (tag in INLINE and stack.blocks[-1] > place):
                node = stack.cut(place)
            continue
        if tag in ENDS_P:
            node = stack.close(("p",))
        if tag in ENDS_SAME:
            node = stack.close(ENDS_SAME[tag])
        if tag in ("html", "body") and node is root:
            continue
        child = Element(tag, node, found[3], by_name)
        node.items.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
        elif tag not in VOID and not found[3].endswith("/"):
            stack.enter(child)
            node = child
    return root


def _measure(root: Element) -> list[Element]:
    """Elements in page order, with their lengths of text and of text in links, and their
    characters and commas."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in reversed(node.items) if isinstance(c, Element) and not c.dropped]
    for node in reversed(order):
        own = [t for t in node.items if isinstance(t, str)]
        node.length += sum(len(_SPACES.sub(" ", t).strip()) for t in own)
        node.chars += sum(map(len, own))
        node.commas += sum(t.count(",") for t in own)
        if node.tag == "a":
            node.linked = node.length
        if node.parent is not None:
            node.parent.length += node.length
            node.parent.linked += node.linked
            node.parent.chars += node.chars
            node.parent.commas += node.commas
    return order


def _drop_forms(root: Element) -> None:
    """Drop the forms but those that the page is inside of: one that holds an article or a
    main, or most of the text with little of it per field."""
    order, todo = [], [(root, None)]
    while todo:
        node, form = todo.pop()
        if node.dropped and node.tag not in FIELDS:
            continue
        form = node if node.tag == "form" else form
        order.append((node, form))
        todo += [(c, form) for c in reversed(node.items) if isinstance(c, Element)]
    if not any(node.tag == "form" for node, _ in order):
        return
    text = {id(node): sum(len(t.strip()) for t in node.items if isinstance(t, str)) for node, _ in order}
    fields = {id(node): int(node.tag in FIELDS) for node, _ in order}
    holds = {id(node): node.tag in ("article", "main") for node, _ in order}
    for node, _ in reversed(order):
        up = id(node.parent)
        if up in text:
            text[up] += 0 if node.dropped else text[id(node)]
            fields[up] += fields[id(node)]
            holds[up] |= holds[id(node)] and not node.dropped
    total = text[id(root)]
    for node, _ in order:
        if node.tag == "form":
            size = text[id(node)]
            most = size > FORM_SHARE * total and size >= FORM_TEXT * fields[id(node)]
            node.dropped |= not (holds[id(node)] or most)


def _link_density(node: Element) -> float:
    return node.linked / node.length if node.length else 0.0


def best_parts(root: Element) -> list[Element]:
    order = _measure(root)
    candidates = []
    for node in order:
        own = any(isinstance(c, str) and c.strip() for c in node.items)
        if not (node.tag in ("p", "pre", "blockquote", "td", "li") or node.block and own) or not node.length:
            continue
        long = node.length >= MIN_PARAGRAPH
        points = 1 + node.commas + min(node.chars / 100, 3) if long else 0.2
        points *= (1 - _link_density(node)) * (DOUBT if node.doubtful else 1)
        up, share = node.parent if node.tag != "div" or node.parent is None else node, 1.0
        while up is not None and share > 0.05:
            if not up.score:
                candidates.append(up)
                up.score += 5 if up.named else 0.01
            if long:
                up.score += points * share
            else:
                up.brief += points * share
            share *= DOUBT if up.doubtful else 1
            up, share = up.parent, share / 2
    if not candidates:
        return [root] if root.length else []
    for node in candidates:
        # Long parts count, or the short ones where these are more.
        base = 5 if node.named else 0.01
        node.score = (base + max(node.score - base, node.brief)) * (1 - _link_density(node))
    best = max(candidates, key=lambda n: n.score)
    # An article around the best part, or else a main, is the container.
    around = [best]
    while around[-1].parent is not None:
        around.append(around[-1].parent)
    for tag in ("article", "main"):
        found = [n for n in around if n.tag == tag]
        if found:
            best = found[0]
            break
    if best.parent is None:
        return [best]
    sure = best.tag in ("article", "main")
    least = max(10.0, best.score * 0.2)
    around, kept = best.parent.items, set()
    for place, other in enumerate(around):
        if not isinstance(other, Element) or other.dropped:
            continue
        # What stands beside a sure article is part of it only if it is one as well.
        reads = not sure and other.tag == "p" and other.length > 80 and _link_density(other) < 0.25
        scores = other.score >= least and _link_density(other) < 0.5 and (not sure or other.tag == best.tag)
        if other is best or not other.doubtful and (scores or reads):
            kept.add(place)
    if not sure:
        kept |= _beside(around, kept)
    return [around[place] for place in sorted(kept)]


def _beside(around: list[Element | str], kept: set[int]) -> set[int]:
    """Places of what belongs to the kept ones: text, headings, paragraphs and lists between
    them, the headings right before, and the sentences right before and after them."""

    def reads(item: Element | str, heading: bool) -> bool:
        if isinstance(item, str):
            return not item.strip()
        if item.dropped or item.doubtful:
            return False
        if item.tag in HEADINGS:
            return heading
        return item.tag == "p" and not item.linked and bool(_SENTENCE.search(_plain(item)))

    first, last = min(kept), max(kept)
    found = set()
    for place in range(first, last):
        item = around[place]
        plain = isinstance(item, str)
        if plain or item.tag in BETWEEN and not item.dropped and not item.doubtful and _link_density(item) < 0.5:
            found.add(place)
    for place in range(first - 1, -1, -1):
        if not reads(around[place], True):
            break
        found.add(place)
    for place in range(last + 1, len(around)):
        if not reads(around[place], False):
            break
        found.add(place)
    return found


def _plain(node: Element) -> str:
    """The text of a small part."""
    found, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            found.append(item)
        elif not item.dropped:
            todo += reversed(item.items)
    return html.unescape("".join(found)).strip()


def _blocks(parts: list[Element]) -> list[str]:
    """One text per block: a break or the border of a block element ends one."""
    lines: list[str] = []
    held: list[str] = []
    # Without a container the whole page is read, menus and all.
    whole = any(isinstance(part, Element) and part.tag in ("html", "body") for part in parts)

    def flush() -> None:
        line = _SPACES.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if line:
            lines.append(line)

    todo: list[Element | str | None] = list(reversed(parts))
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            held.append(item)
        elif item.tag == "br":
            held.append("\n")
        elif not item.dropped and not (whole and _is_notice(item)):
            if item.block:
                flush()
                todo.append(None)
            todo += reversed(item.items)
    flush()
    return lines


def _is_notice(node: Element) -> bool:
    """A list or box that is mostly links is a menu, whatever it is called."""
    return node.block and node.tag in ("ul", "ol", "div", "table", "section", "dl") and node.length > 0 and _link_density(node) > 0.6


def main_text(page: str | None) -> str:
    if not page or not page.strip():
        return ""
    for by_name in (True, False):  # a page whose whole text is in parts with such names
        root = parse(page, by_name)
        _drop_forms(root)
        lines = _blocks(best_parts(root))
        if lines:
            break
    return "\n".join(lines)


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) -> (page_id, url, text, n_chars), one row per row.

    Null, empty and blank pages, and pages without text, get the empty text and 0. Nulls in
    the other columns stay. Pages do not depend on one another, so there is no shuffle, and a
    lost task is read again.
    """

    def make(batches):
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(make, "page_id bigint, url string, text string, n_chars bigint")
