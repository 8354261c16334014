"""Main text of web pages: boosted trees over DOM nodes, and decoding along the tree.

A page becomes a tree of its block elements; inline elements only mark link text.
Each node has features of its own (tag, attribute tokens, depth), of its subtree
(text, density of text to tags, share of links) and of its siblings, and those of
its ancestors. Trees learned from labelled pages give each node the log-odds of
being part of the article. Decoding then chooses kept and dropped nodes so that
the sum is largest and nothing kept lies inside something dropped.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.boosting import Trees, fit
from barloom.llm.common import by_text

#: A quote opens a value only after an equals sign; one that is never closed ends with its tag. A tag without end
#: reaches to the end of the page.
MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|[\"'][^>]*+)?)*+)(>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|aria-label|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?", re.I)
WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")
SPACE = re.compile(r"\s+")

#: Elements by how they are read.
BLOCKS = frozenset(
    "html body article main section div nav header footer aside form fieldset p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd"
    " table caption thead tbody tfoot tr td th blockquote pre address figure figcaption details summary dialog hr"
    " center head menu search hgroup legend".split()
)
SILENT = frozenset(
    "script style noscript template title textarea iframe select button option datalist noframes noembed".split()
)
CLOSING = {name: re.compile("</" + name, re.A | re.I) for name in SILENT}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"html", "body", "head", "caption", "thead", "tbody", "tfoot", "tr", "td", "th"}
#: What an opening tag ends if it is open, and where the search for it stops.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}
#: Words of attributes that speak for and against the article.
GOOD = frozenset("article body content entry main post story text prose page copy".split())
BAD = frozenset(
    "ad ads adbox advert advertisement aside author banner breadcrumb breadcrumbs byline comment comments consent cookie"
    " cookies dialog disclaimer discuss disqus foot footer form gdpr head header hidden login masthead menu meta modal nav"
    " navbar navigation newsletter notice notification overlay pager pagination popup privacy promo promoted promotion"
    " recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored"
    " subscribe tags teaser toolbar topbar trending widget widgets alert".split()
)
TAGS = (
    "article main section div nav header footer aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th"
    " blockquote pre address figure figcaption body html head"
).split()
TAG_AT = {t: i for i, t in enumerate(TAGS)}
ROLES = {"article": 1, "main": 1, "nav": -1, "header": -1, "footer": -1, "aside": -1, "form": -1, "head": -1}


class Page:
    """The tree of block elements of a page, and its stretches of text in order."""

    __slots__ = ("tag", "parent", "good", "bad", "hidden", "texts", "tags", "links")

    def __init__(self, source: str):
        self.tag, self.parent = ["#page"], [-1]
        self.good, self.bad, self.hidden = [0], [0], [0]
        self.tags, self.links = [0], [0]  # elements and characters of links directly in a node
        self.texts: list[tuple[int, str]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack, buffer, at, link = [0], [], 0, 0
        size = len(source)

        def flush() -> None:
            if buffer:
                text = SPACE.sub(" ", html.unescape("".join(buffer))).strip()
                if text:
                    if self.tag[stack[-1]] in ("#page", "html"):
                        # Text outside all blocks lies in a body, as if that had been opened.
                        links, self.links[stack[-1]] = self.links[stack[-1]], 0
                        tags, self.tags[stack[-1]] = self.tags[stack[-1]], min(self.tags[stack[-1]], len(stack) - 1)
                        self._open(stack, "body")
                        self.links[-1] += links
                        self.tags[-1] += tags - self.tags[stack[-2]]
                    self.texts.append((stack[-1], text))
                buffer.clear()

        def close(i: int) -> None:
            flush()
            del stack[i:]

        while at < size:
            found = MARKUP.search(source, at)
            if found is None:
                buffer.append(source[at:])
                break
            start, end = found.span()
            if start > at:
                buffer.append(source[at:start])
                if link:
                    self.links[stack[-1]] += start - at
            at = end
            name = found.group(2)
            if name is None or not found.group(4):
                continue
            name = name.lower()
            if name in SILENT:
                if found.group(1) or found.group(3).endswith("/"):
                    continue
                stop = CLOSING[name].search(source, at)
                if stop is None:
                    continue
                end = source.find(">", stop.start())
                at = size if end < 0 else end + 1
                self.tags[stack[-1]] += 1
                buffer.append(" ")
                continue
            if found.group(1):
                if name == "a":
                    link = 0
                elif name in BLOCKS:
                    for i in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[i]] == name:
                            close(i)
                            link = 0
                            break
                    else:
                        flush()
                continue
            if name not in BLOCKS:
                self.tags[stack[-1]] += 1
                if name == "a":
                    link = 1
                elif name in VOID:
                    buffer.append(" ")
                continue
            flush()
            link = 0
            if name == "hr":
                continue
            if name in CLOSES_P and self.tag[stack[-1]] == "p":
                close(len(stack) - 1)
            ends, borders = ENDED_BY.get(name, ((), ()))
            if ends:
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] in borders:
                        break
                    if self.tag[stack[i]] in ends:
                        close(i)
                        break
            good = bad = hidden = 0
            if found.group(3):
                for key, *values in ATTRIBUTE.findall(found.group(3)):
                    value = next(filter(None, values), "")
                    key = key.lower()
                    if key == "hidden" or key == "style" and "display:none" in value.replace(" ", ""):
                        hidden = 1
                    elif key != "style":
                        words = {w.lower() for w in WORD.findall(value)}
                        good += len(words & GOOD)
                        bad += len(words & BAD)
            self._open(stack, name, good, bad, hidden)
        flush()

    def _open(self, stack: list[int], name: str, good: int = 0, bad: int = 0, hidden: int = 0) -> None:
        stack.append(len(self.tag))
        self.tag.append(name)
        self.parent.append(stack[-2])
        self.good.append(good)
        self.bad.append(bad)
        self.hidden.append(hidden)
        self.tags.append(1)
        self.links.append(0)

    def features(self) -> np.ndarray:
        """A row for each node."""
        n = len(self.tag)
        parent = np.array(self.parent)
        chars, words, stops = np.zeros(n), np.zeros(n), np.zeros(n)
        for node, text in self.texts:
            chars[node] += len(text)
            words[node] += text.count(" ") + 1
            stops[node] += text.count(".") + text.count(",")
        own = chars.copy()
        links, tags = np.array(self.links, float), np.array(self.tags, float)
        children, depth = np.zeros(n), np.zeros(n)
        good, bad, hidden = (np.array(x, float) for x in (self.good, self.bad, self.hidden))
        role = np.array([ROLES.get(t, 0) for t in self.tag], float)
        above = np.zeros((n, 4))  # good, bad, roles for and against on the way from the root
        kind = [TAG_AT.get(t, -1) for t in self.tag]
        for i in range(1, n):
            p = parent[i]
            depth[i] = depth[p] + 1
            children[p] += 1
            above[i] = above[p] + (good[p], bad[p] + hidden[p], role[p] > 0, role[p] < 0)
        for i in range(n - 1, 0, -1):
            for x in (chars, words, stops, links, tags):
                x[parent[i]] += x[i]
        siblings = np.maximum(children[parent], 1)
        mean = np.where(parent >= 0, (chars[parent] - own[parent]) / siblings, chars)
        near = np.zeros(n)  # of the siblings before: same tag
        last: dict[int, str] = {}
        for i in range(1, n):
            near[i] = last.get(parent[i]) == self.tag[i]
            last[parent[i]] = self.tag[i]
        total = max(chars[0], 1.0)
        columns = [
            depth, np.log1p(chars), np.log1p(own), np.log1p(words), chars / total, chars / np.maximum(tags, 1),
            np.minimum(links / np.maximum(chars, 1), 1), stops / np.maximum(words, 1), children, siblings, near,
            chars / np.maximum(mean, 1), good, bad, hidden, role, *above.T,
        ]
        one = np.zeros((n, len(TAGS)))
        for i, k in enumerate(kind):
            if k >= 0:
                one[i, k] = 1
        return np.column_stack([*columns, one])

    def kept(self, margin: np.ndarray) -> np.ndarray:
        """The best choice in which no kept node has a dropped ancestor."""
        n = len(self.tag)
        margin = np.clip(margin, -8, 8)
        margin[0] = 0.0  # the page itself is neither
        gain = margin.copy()  # over dropping the whole subtree
        for i in range(n - 1, 0, -1):
            if gain[i] > 0:
                gain[self.parent[i]] += gain[i]
        keep = np.zeros(n, bool)
        keep[0] = True
        for i in range(1, n):
            keep[i] = keep[self.parent[i]] and gain[i] > 0
        return keep

    def text(self, keep: np.ndarray) -> str:
        return "\n\n".join(text for node, text in self.texts if node and keep[node])


def _sample(draw: random.Random) -> tuple[str, set[str]]:
    """A made-up page and the marks of its article's blocks (each text begins with its mark)."""
    marks: set[str] = set()
    count = iter(range(10_000))

    def words(low: int, high: int) -> str:
        made = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(draw.randint(low, high))]
        return " ".join(w + draw.choices(["", ",", "."], [12, 1, 1])[0] for w in made)

    def text(low: int, high: int, main: bool = False) -> str:
        mark = f"q{next(count)}z"
        if main:
            marks.add(mark)
        return f"{mark} {words(low, high)}"

    def link(low: int = 1, high: int = 3) -> str:
        return f'<a href="/x">{text(low, high)}</a>'

    def some(low: int, high: int, make) -> str:
        return "".join(make() for _ in range(draw.randint(low, high)))

    def named(tag: str, *names: str) -> tuple[str, str]:
        key = draw.choice(["class", "class", "id"])
        return f'<{tag} {key}="{draw.choice(names)}">', f"</{tag}>"

    def wrap(pair: tuple[str, str], inner: str) -> str:
        return pair[0] + inner + pair[1]

    def menu() -> str:
        inner = "<ul>" + some(3, 9, lambda: f"<li>{link()}</li>") + "</ul>"
        return draw.choice([f"<nav>{inner}</nav>", wrap(named("div", "menu", "nav", "navbar top", "site-navigation"), inner)])

    def advert() -> str:
        inner = draw.choice([text(3, 40), link(3, 12), f"<p>{text(3, 40)}</p>"])
        return wrap(named("div", "ad", "ads", "advert", "ad-banner", "sponsored", "promo box"), inner)

    def notice() -> str:
        inner = f"<p>{text(5, 40)}</p><button>{words(1, 2)}</button>"
        return wrap(named("div", "cookie-notice", "cookie-banner", "notice", "gdpr-consent", "newsletter signup", "alert"), inner)

    def sidebar() -> str:
        inner = f"<h3>{text(1, 4)}</h3>" + draw.choice(
            ["<ul>" + some(3, 8, lambda: f"<li>{link(2, 8)}</li>") + "</ul>", some(1, 4, lambda: f"<p>{text(4, 40)}</p>")]
        )
        return draw.choice([f"<aside>{inner}</aside>", wrap(named("div", "sidebar", "widget", "related", "right-sidebar"), inner)])

    def form() -> str:
        return f'<form action="/s"><label>{text(1, 5)}</label><input name="q"><p>{text(2, 12)}</p></form>'

    def comments() -> str:
        one = lambda: draw.choice(
            [
                f'<div class="comment"><p>{text(3, 60)}</p></div>',
                f"<article class=\"comment\"><p>{text(3, 60)}</p></article>",
                f'<li class="comment-body">{text(3, 60)}</li>',
            ]
        )
        return wrap(
            draw.choice([("<section id=\"comments\">", "</section>"), named("div", "comments", "comment-list", "disqus", "replies")]),
            f"<h2>{text(1, 3)}</h2>" + some(1, 6, one),
        )

    def footer() -> str:
        inner = draw.choice([text(4, 30), f"<p>{text(4, 30)}</p>" + link(), "<ul>" + some(2, 6, lambda: f"<li>{link()}</li>") + "</ul>"])
        return draw.choice([f"<footer>{inner}</footer>", f"<footer>{inner}</footer>", wrap(named("div", "footer", "page-footer"), inner)])

    def header() -> str:
        inner = f"<p>{text(1, 6)}</p>" + draw.choice(["", menu(), link()])
        return draw.choice([f"<header>{inner}</header>", wrap(named("div", "header", "masthead", "top-header"), inner)])

    def share() -> str:
        return wrap(named("div", "share", "social-links", "tags", "breadcrumbs", "author-meta"), some(1, 4, link))

    def paragraph() -> str:
        inner = text(1, 120, True)
        if draw.random() < 0.2:
            inner += f' <a href="/y">{words(1, 4)}</a> {words(1, 9)}'
        if draw.random() < 0.15:
            inner = f"<b>{inner}<br>"
        return f"<p>{inner}" + draw.choice(["</p>", "</p>", "</p>", ""])

    def passage() -> str:
        kind = draw.random()
        if kind < 0.8:
            return paragraph()
        if kind < 0.87:
            return f"<h{draw.randint(2, 4)}>{text(1, 8, True)}</h2>"
        if kind < 0.93:
            tag = draw.choice(["ul", "ol"])
            return f"<{tag}>" + some(1, 5, lambda: f"<li>{text(1, 20, True)}</li>") + f"</{tag}>"
        if kind < 0.96:
            return f"<blockquote>{paragraph()}</blockquote>"
        if kind < 0.98:
            return "<table>" + some(1, 3, lambda: f"<tr><td>{text(1, 6, True)}</td><td>{text(1, 6, True)}</td></tr>") + "</table>"
        return f"<pre>{text(2, 20, True)}</pre>"

    def article() -> str:
        head = f"<h1>{text(1, 14, True)}</h1>" if draw.random() < 0.9 else ""
        if head and draw.random() < 0.1:
            head = f"<div class=\"title\">{head}</div>"
        inner = [head, *(passage() for _ in range(draw.choice([1, 1, 2, 3, 5, 9, 20])))]
        for extra in (advert, share, notice, sidebar):
            if draw.random() < 0.1:
                inner.insert(draw.randint(1, len(inner)), extra())
        body = "".join(inner)
        pair = draw.choice(
            [
                ("<article>", "</article>"), ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"),
                ('<div class="content">', "</div>"), ('<div id="main-content">', "</div>"), ('<div class="post">', "</div>"),
                ('<article class="post-body">', "</article>"), ('<main><article>', "</article></main>"),
                ('<section class="article-text">', "</section>"), ("<div>", "</div>"), ('<main><div class="entry">', "</div></main>"),
            ]
        )
        return wrap(pair, body)

    before = [f() for f in (header, menu, advert, notice, share, form) if draw.random() < 0.45]
    after = [f() for f in (comments, sidebar, advert, notice, form, share) if draw.random() < 0.35]
    draw.shuffle(before)
    draw.shuffle(after)
    parts = [*before, article(), *after, *([footer()] if draw.random() < 0.85 else [])]
    if draw.random() < 0.3:
        parts = [draw.choice(["<div>", '<div id="page">', '<div class="wrapper">']), *parts, "</div>"]
    page = f"<html><head><title>{words(2, 8)}</title><style>p{{}}</style></head><body>{''.join(parts)}</body></html>"
    return (page[: draw.randint(len(page) * 9 // 10, len(page))] if draw.random() < 0.1 else page), marks


def labelled(pages: int, seed: int) -> Iterator[tuple[Page, np.ndarray]]:
    """Made-up pages with a label for each node: whether the article's text is in it or it is in such a node."""
    draw = random.Random(seed)
    for _ in range(pages):
        source, marks = _sample(draw)
        page = Page(source)
        main, other = np.zeros(len(page.tag)), np.zeros(len(page.tag))
        for node, text in page.texts:
            (main if text.split(" ", 1)[0] in marks else other)[node] += len(text)
        for i in range(len(page.tag) - 1, 0, -1):
            main[page.parent[i]] += main[i]
            other[page.parent[i]] += other[i]
        label = np.where(main > 0, 1.0, np.where(other > 0, 0.0, np.nan))
        yield page, label


@cache
def train(pages: int = 500, seed: int = 17) -> Trees:
    """Trees from so many made-up pages; nodes without text are not looked at."""
    rows = [(page.features(), label) for page, label in labelled(pages, seed)]
    x, y = np.concatenate([r[0][1:] for r in rows]), np.concatenate([r[1][1:] for r in rows])
    known = ~np.isnan(y)
    return fit(x[known], y[known])


def main_texts(sources: list[str | None], trees: Trees) -> list[str]:
    """The article of each page; nodes of all pages are scored together."""
    pages = [Page(s or "") for s in sources]
    sizes = np.cumsum([len(p.tag) for p in pages])
    if not len(sizes):
        return []
    margin = trees.margin(np.concatenate([p.features() for p in pages]))
    return [p.text(p.kept(m)) for p, m in zip(pages, np.split(margin, sizes[:-1]))]


def extract(pages: DataFrame, trees: Trees) -> DataFrame:
    """pages with the article's `text` and its length `n_chars` added, from the whole html.

    Character references are decoded, white space inside a block becomes one blank,
    blocks are joined by an empty line in page order. Text outside all blocks counts
    as text of a body; formulas, drawings and what stands in for media are text like any
    other. A null or empty page, and one without an article, has an empty text. Every row
    is kept; existing columns of the added names are replaced.
    """

    def make(sources: list[str | None]) -> pa.Array:
        return pa.array([t for at in range(0, len(sources), 64) for t in main_texts(sources[at : at + 64], trees)], pa.string())

    rest = [c for c in pages.columns if c not in ("text", "n_chars")]
    out = pages.select(*rest, by_text(make, "string")("html").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
