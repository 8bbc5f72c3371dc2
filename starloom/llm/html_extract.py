"""Main text of web pages by a tree-structured graphical model.

A page is parsed into a DOM. Each element and each run of text is a node with two states, boilerplate and content. Its features give
a unary potential, each parent-child edge a 2 x 2 potential that depends on the kind of the child (inline or block). On a tree, sum-product is exact: one pass
of messages upward, one downward, and each node's marginal probability of being content follows. Weights are trained by
maximum likelihood (expected against observed counts, with the same messages) on labelled pages.

The text of content nodes is returned: character references decoded, white space inside a block turned into one space, blocks trimmed and joined in page
order by one space. Script, style, template, head and the like are never shown, so their text never counts.

The labelled pages are made by `labelled_pages`, from layouts with varying tags, class names and positions: articles with
paragraphs, lists, quotes and tables among menus, headers, footers, sidebars, notices, adverts, forms and comments. Which elements are main text the layouts
say, not the features: an element's names may be missing or mislead. That an element is hidden by an attribute is a feature, too, and decides nothing alone.

Null or empty html, and pages without content, give an empty text; any text is parsed, however malformed, in time that grows with its length. Rows are independent:
repeated rows repeat their result, an empty table gives an empty one, other columns are not read, whatever their names. A node at even odds counts as content.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import exp

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches

# Element names of HTML by their part in parsing and layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style template head title noscript svg math object iframe textarea select option datalist canvas noembed noframes xmp audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
SIBLINGS = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
    "thead": frozenset(("tr", "td", "th", "thead", "tbody")),
    "tbody": frozenset(("tr", "td", "th", "thead", "tbody")),
    "tfoot": frozenset(("tr", "td", "th", "thead", "tbody")),
}
SCOPES = frozenset("html body table ul ol dl div section article main aside nav header footer form td th blockquote".split())
# Parts of class, id and role names that tell what an element is for.
HINTS = {
    "menu": "nav menu breadcrumb navbar toolbar pagination pager tabs skip".split(),
    "edge": "header footer masthead banner foot topbar copyright legal colophon".split(),
    "side": "sidebar aside related widget recommend trending popular toc rail".split(),
    "notice": "cookie consent notice alert modal popup overlay gdpr paywall toast subscribe newsletter".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo banner-ad dfp outbrain taboola".split(),
    "form": "form search login signup signin register".split(),
    "comment": "comment comments disqus reply replies respond discussion".split(),
    "share": "share social sharing follow tags byline meta author date".split(),
    "main": "article content main post entry story body text maincontent page-content prose".split(),
}
_HINT_OF = {w: k for k, ws in HINTS.items() for w in ws}
# Possessive, and no tag reaches past the next <: a page of unclosed tags is read in one pass.
_MARKUP = re.compile(r"""<!--|<!|<\?|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>""")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
_HIDES = re.compile(r"""(?:^|\s)hidden(?=\s|=|/|$)""", re.I)
_HIDES_BY = re.compile(r"""display\s*:\s*none|visibility\s*:\s*hidden|aria-hidden\s*=\s*["']?true""", re.I)
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Tree:
    """Nodes in document order; a text run is a node named #."""

    names: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    attrs: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    inside: list[int] = field(default_factory=list)  # first node after the subtree

    def add(self, name: str, parent: int, attrs: str = "", text: str = "") -> int:
        self.names.append(name)
        self.parents.append(parent)
        self.attrs.append(attrs)
        self.texts.append(text)
        self.hidden.append(name in HIDDEN or (parent >= 0 and self.hidden[parent]))
        return len(self.names) - 1


class _Open:
    """The open elements. Where each name and the nearest scope stand is kept, so that no tag looks through all of them."""

    def __init__(self, root: int) -> None:
        self.nodes, self.names = [root], [""]
        self.at: dict[str, list[int]] = {}
        self.scopes: list[int] = []

    def push(self, node: int, name: str) -> None:
        self.at.setdefault(name, []).append(len(self.nodes))
        if name in SCOPES:
            self.scopes.append(len(self.nodes))
        self.nodes.append(node)
        self.names.append(name)

    def last(self, name: str) -> int:
        """The nearest open element of a name, 0 if there is none."""
        found = self.at.get(name)
        return found[-1] if found else 0

    def cut(self, k: int) -> None:
        """End the elements from k on."""
        while len(self.nodes) > k:
            self.nodes.pop()
            name = self.names.pop()
            self.at[name].pop()
            if name in SCOPES:
                self.scopes.pop()

    def close(self, which: frozenset[str]) -> None:
        """End the nearest open element of these names, unless a scope stands between."""
        k = max(map(self.last, which))
        if k and k >= (self.scopes[-1] if self.scopes else 0):
            self.cut(k)


def parse(page: str) -> Tree:
    """A DOM that is good enough for text: void, raw and implied end tags; stray end tags are ignored."""
    t = Tree()
    opened = _Open(t.add("html", -1))
    stack = opened.nodes
    at, size, lower = 0, len(page), None

    def text(a: int, b: int) -> None:
        if a < b:
            t.add("#", stack[-1], "", page[a:b])

    search = _MARKUP.search
    while at < size:
        m = search(page, at)
        if m is None:
            text(at, size)
            break
        text(at, m.start())
        name = m[2]
        if name is None:
            if m[0] == "<!--":
                end = page.find("-->", m.start() + 2)
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", m.end())
                at = size if end < 0 else end + 1
            continue
        at, name = m.end(), name.lower()
        if m[1]:
            k = opened.last(name)
            if k and not (name in INLINE and opened.scopes and opened.scopes[-1] > k):
                opened.cut(k)
            continue
        if name == "html" or (name == "body" and opened.last("body")):
            continue
        if opened.last("head") and (name == "body" or (name not in HIDDEN and name not in VOID)):
            opened.cut(opened.at["head"][0])
        if name in CLOSES_P:
            opened.close(_P)
        if name in SIBLINGS:
            opened.close(SIBLINGS[name])
        node = t.add(name, stack[-1], m[3] or "")
        if name in VOID or (m[3] or "").endswith("/") and name not in RAW and name not in CLOSES_P:
            continue
        if name in RAW:
            lower = page.lower() if lower is None else lower
            if len(lower) != size:  # a few capital letters change length
                lower = "".join(c.lower() if c.isascii() else c for c in page)
            end = lower.find("</" + name, at)
            end = size if end < 0 else end
            if at < end:
                t.add("#", node, "", page[at:end])
            close = page.find(">", end)
            at = size if close < 0 else close + 1
            continue
        opened.push(node, name)
    return t


_P = frozenset(("p",))


@lru_cache(20_000)
def hints(attrs: str) -> frozenset[str]:
    out = set()
    for m in _NAMES.finditer(attrs):
        for word in re.split(r"[\s]+", m[1] or m[2] or m[3] or ""):
            parts = [x.lower() for x in _TOKEN.findall(word)]
            out.update(_HINT_OF[x] for x in (word.lower(), *parts) if x in _HINT_OF)
    return frozenset(out)


@lru_cache(20_000)
def hides(attrs: str) -> bool:
    """Whether attributes say that an element is not shown; `hidden` counts as the name of an attribute, not inside a value."""
    return bool(_HIDES_BY.search(attrs) or _HIDES.search(_QUOTED.sub('""', attrs)))


# One-hot features of an element's name; the rest of the names share one.
GROUPS = {
    **{x: x for x in "article main nav header footer aside form p pre blockquote figure figcaption table ul ol li a div section h1 button label".split()},
    **dict.fromkeys("h2 h3 h4 h5 h6".split(), "heading"),
    **dict.fromkeys("input select option textarea fieldset legend".split(), "form"),
    **dict.fromkeys("td th tr tbody thead tfoot".split(), "cell"),
    **dict.fromkeys("dl dt dd".split(), "li"),
    **dict.fromkeys("b i em strong span code q cite mark small sub sup u s".split(), "inline"),
}
FEATURES = {
    f: i
    for i, f in enumerate(
        ["bias", "#", "other", *dict.fromkeys(GROUPS.values()), *(f"hint:{h}" for h in HINTS), "in:article", "in:main", "in:edge", "in:link", "in:hint", "hides", "links>.5", "links>.8", "short", "medium", "long", "sentence", "copyright"]
    )
}
_EDGE = frozenset("nav header footer aside form button".split())
_COPY = re.compile(r"©|&copy;|\(c\)|all rights reserved", re.I)
KINDS = 3  # of edges: text runs, inline elements, blocks


def features(t: Tree) -> tuple[list[list[int]], list[int], list[bool]]:
    """Active features and edge kind of every node, and whether it has visible text beneath."""
    n, f = len(t.names), FEATURES
    size, linked, tail, copied = [0] * n, [0] * n, [0] * n, [False] * n
    for i in range(n - 1, -1, -1):
        if t.names[i] == "#" and not t.hidden[i]:
            s = t.texts[i].strip()
            size[i] += len(s)
            tail[i] += s.count(". ") + s.count(", ") + s.endswith((".", "!", "?", ":"))
            copied[i] = bool(s) and len(s) < 300 and bool(_COPY.search(s))
        if t.names[i] == "a":
            linked[i] = size[i]
        if (p := t.parents[i]) >= 0:
            size[p] += size[i]
            linked[p] += linked[i]
            tail[p] += tail[i]
            copied[p] = copied[p] or copied[i] and size[p] < 400
    out, kinds = [], []
    inside: list[frozenset[str]] = []
    for i in range(n):
        name, p = t.names[i], t.parents[i]
        above = inside[p] if p >= 0 else frozenset()
        group = "#" if name == "#" else GROUPS.get(name, "other")
        active = [f["bias"], f[group]]
        mine = hints(t.attrs[i]) if t.attrs[i] else frozenset()
        active += [f[f"hint:{h}"] for h in mine]
        if t.attrs[i] and hides(t.attrs[i]):
            active.append(f["hides"])
        active += [f[x] for x in above]
        if size[i]:
            share = linked[i] / size[i]
            if share > 0.5:
                active.append(f["links>.5"])
            if share > 0.8:
                active.append(f["links>.8"])
            active.append(f["short" if size[i] < 40 else "medium" if size[i] < 160 else "long"])
            if tail[i]:
                active.append(f["sentence"])
            if copied[i]:
                active.append(f["copyright"])
        out.append(active)
        kinds.append(0 if name == "#" else 1 if name in INLINE else 2)
        here = set(above)
        if name in ("article", "main"):
            here.add(f"in:{name}")
        if name in _EDGE:
            here.add("in:edge")
        if name == "a":
            here.add("in:link")
        if mine and mine - {"main"}:
            here.add("in:hint")
        inside.append(frozenset(here) if len(here) != len(above) else above)
    return out, kinds, [s > 0 for s in size]


@dataclass
class TreeModel:
    unary: np.ndarray  # log-odds of content, by feature
    edge: np.ndarray  # (kind, parent state, child state)

    def marginals(self, parents: list[int], active: list[list[int]], kinds: list[int]) -> tuple[list[float], list[tuple[float, float, float, float]]]:
        """P(content) of every node, and P(parent state, child state) of every edge (00, 01, 10, 11). Nodes come after their parents."""
        n, w = len(parents), self.unary.tolist()
        pot = [tuple(np.exp(self.edge[k]).ravel().tolist()) for k in range(KINDS)]
        # Belief of a node from itself and from below, as the odds' two parts, scaled to sum 1.
        b0, b1 = [0.0] * n, [0.0] * n
        up0, up1 = [0.0] * n, [0.0] * n
        for i in range(n):
            z = 0.0
            for a in active[i]:
                z += w[a]
            b1[i] = 1.0 / (1.0 + exp(-min(50.0, max(-50.0, z))))
            b0[i] = 1.0 - b1[i] or 1e-300
        for i in range(n - 1, 0, -1):
            e00, e01, e10, e11 = pot[kinds[i]]
            s = b0[i] + b1[i]
            x, y = b0[i] / s, b1[i] / s
            b0[i], b1[i] = x, y
            u, v = e00 * x + e01 * y, e10 * x + e11 * y
            s = u + v
            u, v = u / s, v / s
            up0[i], up1[i] = u, v
            p = parents[i]
            b0[p] *= u
            b1[p] *= v
            if b0[p] + b1[p] < 1e-200:
                b0[p], b1[p] = b0[p] * 1e200, b1[p] * 1e200
        s = b0[0] + b1[0]
        m0, m1 = [0.0] * n, [0.0] * n
        m0[0], m1[0] = b0[0] / s, b1[0] / s
        joint = [(0.0, 0.0, 0.0, 0.0)] * n
        for i in range(1, n):
            p = parents[i]
            e00, e01, e10, e11 = pot[kinds[i]]
            # What the parent believes without this child.
            q0, q1 = m0[p] / up0[i], m1[p] / up1[i]
            x, y = b0[i], b1[i]
            j = (q0 * e00 * x, q0 * e01 * y, q1 * e10 * x, q1 * e11 * y)
            s = j[0] + j[1] + j[2] + j[3]
            joint[i] = (j[0] / s, j[1] / s, j[2] / s, j[3] / s)
            m0[i], m1[i] = (j[0] + j[2]) / s, (j[1] + j[3]) / s
        return m1, joint


def fit(pages: list[tuple[Tree, list[bool]]], steps: int = 60, rate: float = 0.5, decay: float = 1e-3) -> TreeModel:
    """Maximum likelihood by accelerated gradient; labels: whether each node is content."""
    model = TreeModel(np.zeros(len(FEATURES)), np.zeros((KINDS, 2, 2)))
    data = [(t.parents, *features(t)[:2], label) for t, label in pages]
    total = max(1, sum(len(x[0]) for x in data))
    vu, ve = np.zeros_like(model.unary), np.zeros_like(model.edge)
    for _ in range(steps):
        gu, ge = np.zeros_like(model.unary), np.zeros_like(model.edge)
        for parents, active, kinds, label in data:
            m, joint = model.marginals(parents, active, kinds)
            for i, a in enumerate(active):
                gu[a] += label[i] - m[i]
                if i:
                    ge[kinds[i]] -= np.array(joint[i]).reshape(2, 2)
                    ge[kinds[i], int(label[parents[i]]), int(label[i])] += 1
        vu = 0.8 * vu + rate * (gu / total * 10 - decay * model.unary)
        ve = 0.8 * ve + rate * (ge / total * 10 - decay * model.edge)
        model = TreeModel(model.unary + vu, model.edge + ve)
    return model


def extract(page: str | None, model: TreeModel) -> str:
    if not page:
        return ""
    t = parse(page)
    active, kinds, filled = features(t)
    if not filled[0]:
        return ""
    content, _ = model.marginals(t.parents, active, kinds)
    blocks: list[str] = []
    run: list[str] = []
    last = -1
    owner: list[int] = []  # the nearest element that is a block
    for i, name in enumerate(t.names):
        p = t.parents[i]
        owner.append(i if p < 0 or (name != "#" and name not in INLINE) else owner[p])
        if owner[i] != last and run:
            blocks.append(" ".join(entities.unescape("".join(run)).split()))
            run = []
        last = owner[i]
        if name == "#" and content[i] >= 0.5 and not t.hidden[i]:
            run.append(t.texts[i])
    if run:
        blocks.append(" ".join(entities.unescape("".join(run)).split()))
    return " ".join(b for b in blocks if b)


# ---- labelled pages

_SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi zo an er is on ul est and ing tra pre com".split()
TRUE, FALSE = "\x01", "\x02"  # mark, in a layout, elements whose text is or is not main text


def _words(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))


def _sentences(r: random.Random, n: int) -> str:
    return " ".join(_words(r, r.randint(4, 14)).capitalize() + r.choice(".....!?") for _ in range(n))


def _element(r: random.Random, names: str, hint: str, odds: float = 0.7) -> str:
    """An opening tag, of one of the names, of something that is no main text; often with a telling class or id, sometimes hidden."""
    name, extra = r.choice(names.split()), ""
    if hint and r.random() < odds:
        extra = f' {r.choice(("class", "class", "id"))}="{r.choice(HINTS[hint])}{r.choice(("", "-wrap", " box", "_1", " clearfix"))}"'
    if r.random() < 0.08:
        extra += r.choice((" hidden", ' style="display:none"', ' aria-hidden="true"'))
    return f"<{name}{extra} {FALSE}>"


def _wrap(opened: str, inner: str) -> str:
    return f"{opened}{inner}</{re.match(r'<(\w+)', opened)[1]}>"


def _links(r: random.Random, n: int) -> str:
    parts = [f'<a href="/{_words(r, 1)}">{_words(r, r.randint(1, 4))}</a>' for _ in range(n)]
    return "<ul>" + "".join(f"<li>{x}</li>" for x in parts) + "</ul>" if r.random() < 0.7 else " | ".join(parts)


def _article(r: random.Random) -> str:
    parts = []
    # Main text may be hidden at first as well, say until a reader opens it.
    p = lambda: "<p" + (r.choice((" hidden", ' style="display: none"', ' class="lead hidden md:block"', ' aria-hidden="true"')) if r.random() < 0.06 else "") + ">"
    if r.random() < 0.8:
        parts.append(f"<h1>{_words(r, r.randint(2, 9)).capitalize()}</h1>")
    for _ in range(r.choice((0, 1, 2, 3, 5, 8, 14))):
        kind = r.random()
        text = _sentences(r, r.randint(1, 6))
        if r.random() < 0.3:
            text = text.replace(" ", r.choice((" <b>", " <em>", ' <a href="/x">', " <i>")), 1) + r.choice(("</b>", "</em>", "</a>", "</i>", ""))
        if kind < 0.6:
            parts.append(f"{p()}{text}</p>" if r.random() < 0.8 else f"{p()}{text}<br>")
        elif kind < 0.68:
            parts.append(f"<h2>{_words(r, 4)}</h2>")
        elif kind < 0.76:
            parts.append("<ul>" + "".join(f"<li>{_words(r, r.randint(1, 12))}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
        elif kind < 0.82:
            parts.append(f"<blockquote><p>{text}</p></blockquote>")
        elif kind < 0.86:
            parts.append("<table>" + "".join(f"<tr><td>{_words(r, 2)}</td><td>{r.randint(1, 999)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
        elif kind < 0.9:
            parts.append(f"<pre>{_words(r, 8)}</pre>")
        else:
            parts.append(f"<div>{text}</div>")
    if not parts:
        parts.append(f"<p>{_words(r, r.randint(1, 30))}</p>")
    return "".join(parts)


def labelled_pages(n: int = 120, seed: int = 9) -> list[tuple[Tree, list[bool]]]:
    """Seeded pages with the label of every node. Main text stands in an element whose tag carries the TRUE mark."""
    r, out = random.Random(seed), []
    for _ in range(n):
        inner = _article(r)
        if r.random() < 0.1:  # nothing but the text, in the body or without any
            t = parse(r.choice(("{}", "<body>{}</body>", "<html><head><title>x</title></head><body>{}</body></html>")).format(inner if r.random() < 0.7 else _sentences(r, 4)))
            out.append((t, [not h for h in t.hidden]))
            continue
        holder = r.choice(("article", "article", "main", "div", "section"))
        mark = f'{holder} {r.choice(("class", "id"))}="{r.choice(HINTS["main"])}" {TRUE}' if holder in ("div", "section") or r.random() < 0.4 else f"{holder} {TRUE}"
        body = f"<{mark}>{inner}</{holder}>"
        if r.random() < 0.3:
            body = f"<main>{body}</main>" if holder != "main" else f'<div id="content">{body}</div>'
        extra = [
            lambda: _wrap(_element(r, "nav nav div ul", "menu", 0.6 if r.random() < 0.8 else 1), _links(r, r.randint(2, 9))),
            lambda: _wrap(_element(r, "header header div", "edge", 0.5), f"<span>{_words(r, 3)}</span>{_links(r, r.randint(0, 4))}"),
            lambda: _wrap(_element(r, "aside aside div", "side", 0.9), f"<h3>{_words(r, 2)}</h3>{_links(r, 4)}<p>{_sentences(r, r.randint(0, 3))}</p>"),
            lambda: _wrap(_element(r, "div div section p", "notice", 1), f"{_sentences(r, r.randint(1, 4))}<button>{_words(r, 1)}</button>"),
            lambda: _wrap(_element(r, "div div aside p", "advert", 1), _sentences(r, r.randint(1, 5)) if r.random() < 0.7 else _words(r, 8)),
            lambda: _wrap(_element(r, "form", "form", 0.4), f"<label>{_words(r, 2)}</label><input><textarea>{_words(r, 2)}</textarea><button>{_words(r, 1)}</button>"),
            lambda: _wrap(_element(r, "div section ul", "share", 1), _links(r, 3)),
        ]
        after = [
            lambda: _wrap(_element(r, "footer footer div", "edge", 0.5), f"&copy; {_words(r, 2)}.example &middot; {_sentences(r, r.randint(0, 3))}"),
            lambda: _wrap(_element(r, "section div ol", "comment", 1), "".join(f'<div class="{r.choice(HINTS["comment"])}"><p>{_sentences(r, r.randint(1, 4))}</p></div>' for _ in range(r.randint(1, 4)))),
        ]
        top = [f() for f in r.sample(extra, r.randint(1, 5))]
        low = [f() for f in r.sample(extra, r.randint(0, 3))] + [f() for f in after if r.random() < 0.7]
        if r.random() < 0.3:  # something foreign inside the article
            body = body.replace("</p><p>", f"</p>{r.choice(extra[3:5])()}<p>", 1)
        page = f"<html><head><title>{_words(r, 4)}</title><style>p{{}}</style></head><body>{''.join(top)}{body}{''.join(low)}</body></html>"
        t = parse(page)
        label: list[bool] = []
        for i, p in enumerate(t.parents):
            label.append(TRUE in t.attrs[i] or (FALSE not in t.attrs[i] and p >= 0 and label[p]))
        t.attrs = [a.replace(TRUE, "").replace(FALSE, "") for a in t.attrs]
        out.append((t, label))
    return out


def main_text(model: TreeModel, pages: DataFrame, html: str = "html") -> Column:
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract(x, sent.value) for x in batch], dtype=object)

    return F.pandas_udf(run, "string").asNondeterministic()(F.col(html))


def extract_pages(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    arrow_batches(pages.sparkSession, 500)
    out = pages.select("page_id", "url", main_text(model or fit(labelled_pages()), pages).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
