"""Densities and choice of the main text against a slow tree, and on malformed pages."""

import math
import random
import time

import pytest

from marquee.llm import html_text

BLOCKS = ("div", "section", "ul", "blockquote")


def tree(rng, depth=0, in_link=False):
    """(tag, attributes, parts): parts are texts and trees."""
    tag = rng.choice(("div", "div", "section", "p", "blockquote")) if depth < 4 else "p"
    attrs = rng.choice(("", "", "", " class='ad'", " id='x y'"))
    parts = []
    for _ in range(rng.randint(1, 4)):
        if tag == "p":
            text = " ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.choice((1, 3, 30))))
            parts.append(("a", " href='u'", [text]) if rng.random() < 0.25 else text)
        else:
            parts.append(tree(rng, depth + 1))
    if depth == 1 and rng.random() < 0.3:
        tag, attrs = rng.choice((("nav", ""), ("footer", ""), ("article", ""), ("div", " class='comments'")))
    return tag, attrs, parts


def markup(node):
    if isinstance(node, str):
        return node
    tag, attrs, parts = node
    return f"<{tag}{attrs}>{''.join(map(markup, parts))}</{tag}>"


class Slow:
    """A node whose counts are taken by walking its whole subtree each time."""

    def __init__(self, node, parent=None):
        self.tag, attrs, parts = node
        self.parent, self.comment = parent, "comments" in attrs
        self.out = self.tag in ("nav", "footer")
        self.named = "class='ad'" in attrs or self.comment
        self.parts = [p if isinstance(p, str) else Slow(p, self) for p in parts]
        self.children = [p for p in self.parts if isinstance(p, Slow)]

    def walk(self):
        yield self
        for c in self.children:
            yield from c.walk()

    def chars(self, links_only=False, inside=False):
        inside = inside or self.tag == "a"
        own = sum(len(p) for p in self.parts if isinstance(p, str)) if inside or not links_only else 0
        return own + sum(c.chars(links_only, inside) for c in self.children)

    def density(self, body):
        c, t = self.chars(), max(sum(1 for _ in self.walk()) - 1, 1)
        lc, lt = self.chars(True, any(x.tag == "a" for x in self.above())), max(sum(n.tag == "a" for n in self.walk()) - (self.tag == "a"), 1)
        share = body.chars(True) / max(body.chars(), 1)
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        if not c:
            return 0.0
        if base <= 1:
            return c / t
        return max(c / t * math.log(c / max(lc, 1) * t / lt) / math.log(base), 0.0)

    def above(self):
        return [] if self.parent is None else [self.parent, *self.parent.above()]

    def texts(self):
        if self.out:
            return []
        blocks, line = [], ""
        for p in self.parts:
            if isinstance(p, str):
                line += p
            elif p.tag == "a":
                line += "" if p.out else "".join(p.parts)
            else:
                blocks, line = [*blocks, line, *p.texts()], ""
        return [b for b in [*blocks, line] if b.strip()]


def slow_text(node):
    body = Slow(node)
    nodes = list(body.walk())
    density = {id(n): n.density(body) for n in nodes}
    sums = {id(n): sum(density[id(c)] for c in n.children) for n in nodes}

    def best(barred):
        free = [n for n in nodes if not any(barred(x) for x in [n, *n.above()])]
        top = max((sums[id(n)], density[id(n)]) for n in free)
        return next(n for n in free if (sums[id(n)], density[id(n)]) == top)

    first = best(lambda n: n.out or n.comment)
    kept = {id(n) for n in [first, *first.above()]} if sums[id(first)] > 0 else set()
    for n in nodes:
        n.out = n.out or (n.named and id(n) not in kept)
    chosen = best(lambda n: n.out)
    if sums[id(chosen)] <= 0:
        return "\n\n".join(body.texts())
    path = [chosen, *chosen.above()]
    threshold = min(density[id(n)] for n in path)
    frames = [n for n in reversed(path) if n.tag == "article"]
    at = path.index(frames[0]) if frames else 0
    chosen = path[at]
    for below, up in zip(path[at:], path[at + 1 :], strict=False):
        if not frames and up.tag == "body" and chosen.tag != "p":
            break
        beside = [c for c in up.children if c is not below and not c.out and c.chars() and density[id(c)] >= threshold]
        if any(not frames or c.tag == "article" for c in beside):
            chosen = up
    return "\n\n".join(chosen.texts())


@pytest.mark.parametrize("seed", range(8))
def test_choice_equals_a_slow_tree(seed):
    rng = random.Random(seed)
    chosen = 0
    for _ in range(60):
        node = ("body", "", [tree(rng, 1) for _ in range(rng.randint(1, 5))])
        page = f"<html>{markup(node)}</html>"
        assert html_text.main_text(page) == slow_text(node), page
        parsed = html_text.Page(page)
        chosen += parsed.nodes[parsed.main_node()].tag not in ("body", "html", "#root")
    # Density decides; the whole page is the rare case.
    assert chosen > 30


def test_densities_are_never_all_zero():
    for page in ("<body><p>no link here</p></body>", "<body><div><p>a b</p></div><p>c <a href=x>d</a></p></body>", "<p>x"):
        assert any(d > 0 for d in html_text.Page(page).densities())


@pytest.mark.parametrize("link", ["", " <a href=x>link</a>"])
def test_plain_elements_beside_the_content(link):
    rng = random.Random(5)
    long = [" ".join(f"word{rng.randrange(900)}" for _ in range(60)) for _ in range(2)]
    page = f"<div class=top><p>Win a prize in our draw</p></div><div class=content><p>{long[0]}{link}</p><p>{long[1]}</p></div><div class=x><p>All rights reserved</p></div>"
    got = html_text.main_text(page)
    assert got == f"{long[0]}{' link' if link else ''}\n\n{long[1]}"


def test_many_comments_are_not_the_main_text():
    article = "<div><p>" + "one two three four " * 20 + "<a href=x>l</a></p><p>five six</p></div>"
    comments = "<section class=comments>" + "".join(f"<div><p>{'reader says so ' * 20}</p></div>" for _ in range(9)) + "</section>"
    got = html_text.main_text(f"<body>{article}{comments}</body>")
    assert "five six" in got and "reader" not in got


@pytest.mark.parametrize(
    "source",
    [
        "<a " * 350_000,
        "<a \"x>\" " * 120_000 + "'",
        "<b><i>" * 80_000 + "</u>" * 150_000,
        "<div>" * 200_000 + "deep",
        "<title>" * 100_000,
        "<script>" * 100_000,
        "<!--" * 200_000,
        "<" * 500_000,
        "<a '" * 250_000,
        "<p class='ad'>x</p>" * 40_000,
        "</p>" * 200_000,
        "&amp" * 200_000,
    ],
    ids=lambda s: s[:8],
)
def test_malformed_long_pages_take_no_longer(source):
    begun = time.process_time()
    html_text.main_text(source)
    assert time.process_time() - begun < 5


def test_deep_pages_keep_their_text():
    page = html_text.Page("<div>" * 3000 + "<p>deep text" + "</div>" * 3000 + "<p>after")
    assert page.text_of(0) == "deep text\n\nafter"


def test_unclosed_parts_end_with_the_page():
    assert html_text.main_text("<p>one</p><a title='x") == "one"
    assert html_text.main_text("<p>one</p><!-- two") == "one"
    assert html_text.main_text("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"
    assert html_text.main_text("<nav><a href=x>menu</a><article><p>never closed nav</p></article>") == "never closed nav"


def test_repeated_rows_get_equal_texts(spark):
    rows = [(1, "u", "<p>same</p>"), (1, "u", "<p>same</p>"), (1, "v", None), (None, None, "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = html_text.extract_main_text(pages, keep=["page_id", "url"]).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, [(1, "u", "same", 4), (1, "u", "same", 4), (1, "v", "", 0), (None, None, "x", 1)]))
