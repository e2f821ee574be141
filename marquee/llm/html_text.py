"""Main text of web pages by composite text density.

Each page is parsed into a whole DOM, menus and their links included.  A node's density is
its number of characters per tag, adjusted by the links in it and by the share of link text
in the body; on a page without link text it is the plain number of characters per tag.  A
node's sum is that of its children's densities, and the subtree with the largest sum is the
main text.  The threshold is the least density on the path from that subtree to the body;
while a subtree beside the path reaches it, the selection climbs, so that a heading next to
the densest part stays in.  Inside an ``article`` (or ``main``) the selection is that element,
and climbs only for articles beside it; one elsewhere in the page takes no part in the choice.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are recognised by element, role, or a whole word of the class or id.  They count in
the densities, are never chosen, and are left out of the chosen text; what is so named by
class or id (but for comments) stays if it holds the densest subtree.

Defined results: NULL, empty and text-free pages give the empty text; a page without tags is
its own text; equal pages give equal texts, and rows with one id are pages of their own.
Among equal sums the larger density wins, then the earlier node.  Text is kept whole.  Time
grows with the page: an unclosed tag, comment or quote ends at the end of the page once, and
elements nested deeper than ``MAX_DEPTH`` stand beside each other.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marquee.llm.frames import map_text

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_MARK = re.compile(r"[\"'>]")
MAX_DEPTH = 512
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WHITE = re.compile(r"\s+")

# Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
CLOSES_PARAGRAPH = BLOCK - {"body", "html", "option", "optgroup", "tbody", "td", "tfoot", "th", "thead", "tr", "legend"} | {"hr"}
LEFT_OUT = frozenset(
    "nav footer aside form script style noscript iframe svg canvas template button select textarea object embed head dialog "
    "menu title noembed noframes audio video map search".split()
)
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
LEFT_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted banner cookie cookies consent "
    "gdpr notice notices notification alert sidebar sidebars rail menu menus nav navbar navigation breadcrumb breadcrumbs footer "
    "masthead comment comments commentlist disqus respond replies share sharing social related newsletter subscribe subscription "
    "signup login popup modal overlay pagination pager toolbar widget widgets skip".split()
)
LEFT_OUT_OUTSIDE_ARTICLE = frozenset({"header"})
_SELF_CLOSING = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_COMMENT_NAMES = frozenset({"comment", "comments"})
_FRAMES = frozenset({"article", "main", "body", "html"})
_HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})


@dataclass
class Node:
    """``out``: left out by element or role; ``named``: by class or id; ``comment``: as comments."""

    tag: str
    parent: int
    in_link: bool
    in_article: bool
    begin: int
    end: int = -1
    tags: int = 0
    chars: int = 0
    links: int = 0
    link_chars: int = 0
    children: list[int] = field(default_factory=list)
    out: bool = False
    named: bool = False
    comment: bool = False


def _left_out(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element is left out in any case, by its class or id, and as reader comments."""
    if tag in LEFT_OUT or (tag in LEFT_OUT_OUTSIDE_ARTICLE and not in_article):
        return True, False, False
    if not attrs or tag in ("html", "body") or attrs.isspace():
        return False, False, False
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(attrs):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True, False, False
    if found.get("role", "").lower() in LEFT_OUT_ROLES:
        return True, False, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True, False, False
    names = set(f"{found.get('class', '')} {found.get('id', '')}".lower().split())
    comment = bool(names & _COMMENT_NAMES)
    if tag in ("article", "main"):
        return False, comment, comment
    named = bool(names & LEFT_OUT_NAMES) or ("header" in names and not in_article and tag not in ("h1", "h2", "h3"))
    return False, named, comment


class Page:
    """The DOM as a list of nodes in page order, and the events (texts and block
    edges) of each node as a range of ``events``."""

    def __init__(self, source: str):
        self.nodes = [Node("#root", -1, False, False, 0)]
        self.events: list[str | None] = []
        self.stack = [0]
        self.open_tags: dict[str, int] = {}
        self.seen_article = False
        self._parse(source)
        while self.stack:
            self._pop()

    def _text(self, raw: str) -> None:
        if not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self.events.append(text)
        n = len(_WHITE.sub(" ", text).strip())
        top = self.nodes[self.stack[-1]]
        top.chars += n
        if top.in_link:
            top.link_chars += n

    def _pop(self) -> None:
        i = self.stack.pop()
        node = self.nodes[i]
        if node.tag in BLOCK:
            self.events.append(None)
        node.end = len(self.events)
        if node.parent >= 0:
            self.open_tags[node.tag] -= 1
            up = self.nodes[node.parent]
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + 1
            up.links += node.links + (node.tag == "a")

    def _push(self, tag: str) -> Node:
        if len(self.stack) > MAX_DEPTH:
            self._pop()
        up = self.stack[-1]
        if tag in BLOCK:
            self.events.append(None)
        above = self.nodes[up]
        node = Node(tag, up, above.in_link or tag == "a", above.in_article or tag in ("article", "main"), len(self.events))
        self.nodes.append(node)
        above.children.append(len(self.nodes) - 1)
        self.stack.append(len(self.nodes) - 1)
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1
        self.seen_article |= tag in ("article", "main")
        return node

    def _is_open(self, tag: str) -> bool:
        return self.open_tags.get(tag, 0) > 0

    def _close(self, tags: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> None:
        """Close the innermost open element of ``tags``, unless one of ``stop`` is inside of it.

        Inside an element that is left out nothing but its own end, or that of the page or the
        article around it, closes what stands outside."""
        if not any(self._is_open(t) for t in tags):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            node = self.nodes[self.stack[depth]]
            if node.tag in tags:
                while len(self.stack) > depth:
                    self._pop()
                return
            if node.tag in stop or (node.out and not tags & _FRAMES):
                return

    _PARAGRAPH_ENDS = BLOCK - {"p"}

    def _open(self, tag: str) -> None:
        if tag in CLOSES_PARAGRAPH:
            self._close({"p"}, self._PARAGRAPH_ENDS)
        if tag in _SELF_CLOSING:
            self._close(*_SELF_CLOSING[tag])
        if tag in _HEADINGS and self.nodes[self.stack[-1]].tag in _HEADINGS:
            self._pop()
        if tag == "a":
            self._close({"a"}, BLOCK)
        if tag in ("article", "main", "body") and not self.seen_article:
            # What was left out before was never closed.
            for depth, i in enumerate(self.stack):
                if self.nodes[i].out:
                    while len(self.stack) > depth:
                        self._pop()
                    break

    def _end_of_tag(self, source: str, at: int, blind: int) -> tuple[int, int]:
        """Place behind the tag's ``>``, and up to where quotes are not heeded any more: before a
        quote that is never closed a tag ends at the next ``>``, quoted or not."""
        place = at
        while place >= blind and (mark := _MARK.search(source, place)) is not None:
            if mark[0] == ">":
                return mark.end(), blind
            close = source.find(mark[0], mark.end())
            if close < 0:
                blind = mark.start() + 1
                break
            place = close + 1
        return source.find(">", at) + 1, blind

    def _parse(self, source: str) -> None:
        at, size, blind = 0, len(source), 0
        last, unclosed = source.rfind(">"), set()
        text_from = 0
        while (begin := source.find("<", at)) >= 0:
            following = source[begin + 1 : begin + 2]
            if not (following.isascii() and following.isalpha()) and following not in ("/", "!", "?"):
                at = begin + 1
                continue
            if source.startswith("<!--", begin):
                self._text(source[text_from:begin])
                close = source.find("-->", begin + 4)
                at = text_from = size if close < 0 else close + 3
                continue
            if begin > last:
                # No tag ends any more: the rest is part of one.
                self._text(source[text_from:begin])
                return
            if following in ("!", "?"):
                self._text(source[text_from:begin])
                at = text_from = source.find(">", begin) + 1
                continue
            match = _TAG.match(source, begin)
            if match is None:
                at = begin + 1
                continue
            self._text(source[text_from:begin])
            at, blind = self._end_of_tag(source, match.end(), blind)
            attrs = source[match.end() : at - 1]
            tag, closing = match[2].lower(), bool(match[1])
            text_from = at
            if tag in RAW and not closing and not attrs.endswith("/") and tag not in unclosed:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                if end is None:
                    unclosed.add(tag)
                if end is None and tag in ("title", "textarea", "noscript"):
                    continue
                close = -1 if end is None else source.find(">", end.end())
                at = text_from = size if close < 0 else close + 1
                self.nodes[self.stack[-1]].tags += 1
                continue
            if tag in RAW and not closing:
                continue
            self._close_tag(tag) if closing else self._open_tag(tag, attrs)
        self._text(source[text_from:])

    def _close_tag(self, tag: str) -> None:
        if tag in ("br", "p") and (tag == "br" or not self._is_open("p")):
            self.events.append(None if tag == "p" else " ")
        elif tag in BLOCK:
            self._close({tag}, frozenset({"td", "th", "table"}) - {tag} if tag in ("p", "li", "div") else frozenset())
        else:
            self._close({tag}, BLOCK)

    def _open_tag(self, tag: str, attrs: str) -> None:
        if tag in VOID:
            if tag == "hr":
                self._open("hr")
            self.events.append(None if tag == "hr" else " " if tag == "br" else "")
            self.nodes[self.stack[-1]].tags += 1
            return
        self._open(tag)
        if tag in ("html", "body") and self._is_open(tag):
            return
        above = self.nodes[self.stack[-1]]
        out, named, comment = _left_out(tag, attrs, above.in_article)
        if out and attrs.endswith("/"):
            return
        node = self._push(tag)
        node.out, node.named, node.comment = out, named, comment

    def densities(self) -> list[float]:
        """Composite text density of every node."""
        body = next((n for n in self.nodes if n.tag == "body"), self.nodes[0])
        share = body.link_chars / max(body.chars, 1)
        return [density_of(n.chars, n.tags, n.link_chars, n.links, share) for n in self.nodes]

    def _path(self, i: int) -> list[int]:
        """From a node up to the body, or to the root where there is none."""
        path = [i]
        while self.nodes[path[-1]].parent >= 0 and self.nodes[path[-1]].tag != "body":
            path.append(self.nodes[path[-1]].parent)
        return path

    def _densest(self, sums: list[float], density: list[float], barred: list[bool]) -> int:
        """The node of the largest sum that is not inside a barred one."""
        inside = [False] * len(self.nodes)
        best = 0
        for i, n in enumerate(self.nodes):
            inside[i] = barred[i] or (n.parent >= 0 and inside[n.parent])
            if not inside[i] and (sums[i], density[i]) > (sums[best], density[best]):
                best = i
        return best

    def main_node(self) -> int:
        """The chosen node; what is left out inside of it is marked ``out``."""
        density = self.densities()
        sums = [sum(density[c] for c in n.children) for n in self.nodes]
        best = self._densest(sums, density, [n.out or n.comment for n in self.nodes])
        if any(n.named for n in self.nodes):
            kept = set(self._path(best)) if sums[best] > 0 else set()
            for i, n in enumerate(self.nodes):
                n.out |= n.named and i not in kept
            best = self._densest(sums, density, [n.out for n in self.nodes])
        if sums[best] <= 0:
            return 0
        path = self._path(best)
        threshold = min(density[i] for i in path)
        frames = [i for tag in ("article", "main") for i in reversed(path) if self.nodes[i].tag == tag]
        at = path.index(frames[0]) if frames else 0
        chosen = path[at]
        for below, up in zip(path[at:], path[at + 1 :], strict=False):
            if not frames and self.nodes[up].tag in ("body", "html", "#root") and self.nodes[chosen].tag != "p":
                break
            beside = [c for c in self.nodes[up].children if c != below and not self.nodes[c].out and self.nodes[c].chars and density[c] >= threshold]
            if any(not frames or self.nodes[c].tag in ("article", "main") for c in beside):
                chosen = up
        return chosen

    def text_of(self, i: int) -> str:
        """The text inside a node without what is left out."""
        node = self.nodes[i]
        kept: list[tuple[int, int]] = []
        begin = node.begin
        for j in range(i + 1, len(self.nodes)):
            inner = self.nodes[j]
            if inner.begin >= node.end and inner.end > node.end:
                break
            if inner.out and inner.begin >= begin:
                kept.append((begin, inner.begin))
                begin = max(begin, inner.end)
        kept.append((begin, node.end))
        parts: list[str] = []
        blocks: list[str] = []
        for event in [*(e for a, b in kept for e in self.events[a:b]), None]:
            if event is not None:
                parts.append(event)
            elif parts:
                joined = _WHITE.sub(" ", "".join(parts)).strip()
                if joined:
                    blocks.append(joined)
                parts = []
        return "\n\n".join(blocks)


def density_of(chars: int, tags: int, link_chars: int, links: int, share: float) -> float:
    """Link-adjusted characters per tag; ``share`` is that of link text in the body."""
    if not chars:
        return 0.0
    plain = chars / max(tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e)
    if base <= 1:
        return plain
    ratio = chars / max(link_chars, 1) * max(tags, 1) / max(links, 1)
    return max(plain * math.log(ratio) / math.log(base), 0.0)


def main_text(source: str | None) -> str:
    if not source:
        return ""
    page = Page(source)
    return page.text_of(page.main_node())


EXTRACTED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract_main_text(pages: DataFrame, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``, its length in code points."""

    def of(batches: Iterator[pa.Array]) -> Iterator[dict]:
        for column in batches:
            texts = [main_text(v) for v in column.to_pylist()]
            yield {"text": texts, "n_chars": np.array([len(t) for t in texts], dtype=np.int64)}

    return map_text(pages, html_column, EXTRACTED, of, keep)
