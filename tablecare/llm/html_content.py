"""Main text of web pages by a tree-structured graphical model.

The nodes of the model are the block elements of a page and their runs of text. Each is content or not; a node has a log-linear
potential of what it looks like, and every parent-child pair a potential of both states. Messages passed from the leaves to the
root and back (sum-product) give each run of text the probability that it is content. Potentials are learnt from labelled pages.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>|</?[a-zA-Z][^>]*\Z|</[^a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)

# HTML element kinds.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("head script style title noscript template iframe object svg math canvas audio video map datalist select textarea option".split())
HEAD_ONLY = set("head base basefont bgsound link meta noframes noscript script style template title".split())
RAW = {"script", "style", "title", "textarea", "noscript", "iframe"}
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr input button output".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul li".split()
)
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}}

# Words in class, id and role names that tell what an element is for.
HINTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs topbar",
    "head": "header masthead banner logo branding",
    "foot": "footer foot copyright colophon legal contentinfo",
    "side": "sidebar aside side rail widget complementary related recommended more trending popular tags",
    "advert": "ad ads adv advert advertisement sponsor sponsored promo promotion adslot",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription paywall toast dialog",
    "form": "form search login signup register contact input",
    "comment": "comment comments reply replies respond discussion disqus thread feedback review reviews",
    "share": "share sharing social follow like buttons toolbar",
    "content": "content article post entry story main text blog news prose",
}
_HINT = {word: kind for kind, words in HINTS.items() for word in words.split()}

_BLANKS = " \t\n\f\r"

ELEMENTS = "body article main section div p h1 h2 h3 h4 li ul ol table td blockquote pre figure nav header footer aside form dl address".split()


@dataclass
class Page:
    """The nodes of a page in page order: parents, features, and the texts of the leaves."""

    parent: list[int] = field(default_factory=list)
    features: list[list[str]] = field(default_factory=list)
    values: list[dict[str, float]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    label: list[bool | None] = field(default_factory=list)

    def add(self, parent: int, features: list[str], text: str | None = None, label: bool | None = None) -> int:
        self.parent.append(parent)
        self.features.append(features)
        self.values.append({})
        self.text.append(text)
        self.label.append(label)
        return len(self.parent) - 1


def _hints(rest: str) -> list[str]:
    found = set()
    for _, value in _ATTRIBUTE.findall(rest):
        for word in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
            if word in _HINT:
                found.add(f"hint:{_HINT[word]}")
    return sorted(found)


def parse(source: str) -> Page:
    """The block tree of a page. Broken markup is closed as browsers do; a cut tag at the end is dropped.

    An open head ends at ``<body>`` and at the first text or tag that cannot stand in it, as ``</head>`` may be left out.

    ``data-content="1"`` or ``"0"`` labels an element and what is below it; what has no label is not content.
    """
    page = Page()
    root = page.add(-1, ["tag:body"])
    stack: list[tuple[str, int, bool | None]] = [("body", root, None)]
    run: list[str] = []
    linked: list[str] = []
    unseen, links, at = 0, 0, 0

    def flush() -> None:
        nonlocal run, linked
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            node = next(n for tag, n, _ in reversed(stack) if tag not in INLINE)
            leaf = page.add(node, ["leaf", f"in:{page.features[node][0]}"], text, stack[-1][2])
            share = min(1.0, len(" ".join("".join(linked).split())) / len(text))
            page.values[leaf] = {"length": min(1.0, math.log1p(len(text)) / 8), "links": share, "short": float(len(text) < 25), "mark": float("©" in text)}
        run, linked = [], []

    def pop() -> None:
        nonlocal unseen, links
        tag = stack.pop()[0]
        unseen -= tag in UNSEEN
        links -= tag == "a"

    for token in _TOKEN.finditer(source):
        if token.start() < at:
            continue
        if stack[-1][0] == "head" and source[at : token.start()].strip(_BLANKS):
            pop()
        if not unseen and token.start() > at:
            run.append(source[at : token.start()])
            if links:
                linked.append(run[-1])
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if not tag:
            continue
        closing = token["end"] or token["end2"]
        if stack[-1][0] == "head" and (tag in ("html", "body", "br") if closing else tag not in HEAD_ONLY and tag != "html"):
            pop()
        if closing:
            if any(tag == open_ for open_, _, _ in stack[1:]):
                if tag not in INLINE and not unseen:
                    flush()
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag == "p" or tag == "br":
                run.append(" ")
            continue
        rest = token["rest"] or token["rest2"] or ""
        if tag in ("html", "body") or tag == stack[-1][0] == "head":
            continue
        if tag in VOID:
            if tag == "hr" and not unseen:
                flush()
            run.append(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            run.append(" ")
            continue
        if tag not in INLINE and not unseen:
            flush()
        if tag in CLOSES_P and any(open_ == "p" for open_, _, _ in stack):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    while len(stack) > depth:
                        pop()
                    break
                if stack[depth][0] not in INLINE:
                    break
        for depth in range(len(stack) - 1, 0, -1) if tag in CLOSES_SAME else ():
            if stack[depth][0] in SCOPE[tag]:
                break
            if stack[depth][0] in CLOSES_SAME[tag]:
                while len(stack) > depth:
                    pop()
        label = stack[-1][2]
        if marked := re.search(r'data-content="([01])"', rest):
            label = marked[1] == "1"
        node = stack[-1][1]
        if tag not in INLINE and tag not in UNSEEN:
            shown = tag if tag in ELEMENTS else "other"
            node = page.add(node, [f"tag:{shown}", *_hints(rest)], label=label)
        stack.append((tag, node, label))
        unseen += tag in UNSEEN
        links += tag == "a"
    if stack[-1][0] == "head" and source[at:].strip(_BLANKS):
        pop()
    if not unseen and at < len(source):
        run.append(source[at:])
        if links:
            linked.append(run[-1])
    flush()
    return page


NUMBERS = ["length", "links", "short", "mark"]
NAMES = ["bias", "leaf", *[f"tag:{t}" for t in [*ELEMENTS, "other"]], *[f"in:tag:{t}" for t in [*ELEMENTS, "other"]], *[f"hint:{h}" for h in HINTS]]
_PLACE = {name: i for i, name in enumerate([*NAMES, *NUMBERS])}


@dataclass
class Forest:
    """The nodes of some pages together, so that messages of one depth are computed at once."""

    parent: np.ndarray
    depth: np.ndarray
    leaf: np.ndarray
    x: np.ndarray

    @classmethod
    def of(cls, pages: list[Page]) -> Forest:
        parent, depth, rows = [], [], []
        for page in pages:
            base = len(parent)
            for i, up in enumerate(page.parent):
                parent.append(base + up if up >= 0 else -1)
                depth.append(depth[base + up] + 1 if up >= 0 else 0)
                rows.append([(_PLACE[f], 1.0) for f in ("bias", *page.features[i])] + [(_PLACE[f], v) for f, v in page.values[i].items()])
        x = np.zeros((len(rows), len(_PLACE)))
        for i, row in enumerate(rows):
            for j, v in row:
                x[i, j] = v
        return cls(np.array(parent, np.int64), np.array(depth, np.int64), np.array([t is not None for p in pages for t in p.text], bool), x)


@dataclass
class Model:
    """``weights`` of the features of a node; ``pair[kind, parent state, child state]``, kind 1 for a run of text."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(_PLACE)))
    pair: np.ndarray = field(default_factory=lambda: np.zeros((2, 2, 2)))

    def marginals(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Probability of content of each node, and the joint one of each node with its parent (parent state, own state)."""
        n = len(forest.parent)
        own, up, message, down = np.zeros((n, 2)), np.zeros((n, 2)), np.zeros((n, 2)), np.zeros((n, 2))
        own[:, 1] = forest.x @ self.weights
        pair = self.pair[forest.leaf.astype(int)]
        levels = [np.flatnonzero(forest.depth == d) for d in range(int(forest.depth.max(initial=0)) + 1)]
        for at in levels[:0:-1]:
            message[at] = np.logaddexp.reduce(pair[at] + (own[at] + up[at])[:, None, :], axis=2)
            np.add.at(up, forest.parent[at], message[at])
        joint = np.zeros((n, 2, 2))
        for at in levels[1:]:
            above = forest.parent[at]
            rest = own[above] + up[above] + down[above] - message[at]
            both = pair[at] + rest[:, :, None]
            down[at] = np.logaddexp.reduce(both, axis=1)
            both = both + (own[at] + up[at])[:, None, :]
            joint[at] = np.exp(both - np.logaddexp.reduce(both.reshape(len(at), 4), axis=1)[:, None, None])
        belief = own + up + down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), joint


def train(labelled: Iterable[str], rounds: int = 400, rate: float = 0.3, shrink: float = 1e-5) -> Model:
    """The potentials that make the labels likely: gradient ascent, with expectations from sum-product.

    ``labelled`` are pages with ``data-content`` marks. They are held on the driver, so their number is a bound that the caller sets.
    """
    pages = [parse(p) for p in labelled]
    forest, model = Forest.of(pages), Model()
    state = np.array([bool(s) for p in pages for s in p.label], float)
    inner = forest.parent >= 0
    kind, above, own = forest.leaf[inner].astype(int), state[forest.parent[inner]].astype(int), state[inner].astype(int)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (kind, above, own), 1)
    gone_w, gone_p = np.full(len(_PLACE), 1e-8), np.full((2, 2, 2), 1e-8)
    for _ in range(rounds):
        content, joint = model.marginals(forest)
        slope_w = forest.x.T @ (state - content) / len(pages) - shrink * model.weights
        expected = np.zeros((2, 2, 2))
        np.add.at(expected, kind, joint[inner])
        slope_p = (seen - expected) / len(pages) - shrink * model.pair
        gone_w += slope_w**2
        gone_p += slope_p**2
        model.weights += rate * slope_w / np.sqrt(gone_w)
        model.pair += rate * slope_p / np.sqrt(gone_p)
    return model


def _marked(opened: str, label: int) -> str:
    """The first tag of ``opened`` with its label."""
    return re.sub(r"^<([a-z]+)", rf'<\1 data-content="{label}"', opened)


def labelled_pages(count: int = 240, seed: int = 7) -> list[str]:
    """Pages of many layouts with every text labelled, for training."""
    r = random.Random(seed)

    style = [""]

    def words(low: int, high: int) -> str:
        made = ["".join(r.choices("aeioulnrstéüñ", k=r.randint(2, 9))) + style[0] for _ in range(r.randint(low, high))]
        if style[0] == " " and r.random() < 0.5:
            made = [w for w in made for _ in range(3)]
        text = (" | " if style[0] == "," else " ").join(made)
        return text.upper() if style[0] == "!!" else text.capitalize()

    def sentences(n: int) -> str:
        return " ".join(words(5, 16) + r.choice([".", ".", ".", "?", "!"] if style[0] != " " else ["", " -", ","]) for _ in range(n))

    def named(kind: str, tag: str = "div") -> str:
        name = r.choice(HINTS[kind].split())
        return f'<{tag} {r.choice(["class", "id"])}="{r.choice(["", "site-", "x-"])}{name}{r.choice(["", "-box", " c1"])}">'

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{words(1, 4)}</a></li>' for _ in range(n)) + "</ul>"

    def noise(kind: str) -> str:
        own = {"menu": "nav", "foot": "footer", "side": "aside", "head": "header", "form": "form"}.get(kind, "section")
        tag = r.choice([own, own, "div"])
        opened = f"<{own}>" if tag == own and own != "section" and r.random() < 0.7 else named(kind, tag)
        inside = {
            "menu": lambda: links(r.randint(2, 8)),
            "head": lambda: r.choice([f"<a href='/'>{words(1, 3)}</a>", f"<h1>{words(1, 3)}</h1><p>{words(2, 6)}</p>"]) + r.choice(["", links(4)]),
            "foot": lambda: r.choice([f"&copy; {words(2, 8)}. {words(2, 6)}", f"<p>&copy; {words(3, 9)}</p>{links(3)}"]),
            "side": lambda: f"<h3>{words(1, 3)}</h3>" + r.choice([links(5), f"<p>{sentences(2)}</p>"]),
            "advert": lambda: r.choice([sentences(r.randint(1, 4)), f"<p>{sentences(2)}</p><a href='/buy'>{words(1, 3)}</a>"]),
            "notice": lambda: f"<p>{sentences(r.randint(1, 3))}</p><button>{words(1, 2)}</button>",
            "form": lambda: f"<label>{words(1, 3)}</label><input><button>{words(1, 2)}</button><p>{words(3, 9)}.</p>",
            "comment": lambda: r.choice(["", f"<h3>{words(1, 3)}</h3>"]) + r.choice([
                lambda: "".join(f"<div class='comment'><b>{words(1, 2)}</b><p>{sentences(r.randint(1, 4))}</p></div>" for _ in range(r.randint(1, 4))),
                lambda: "".join(f"<p>{sentences(r.randint(1, 5))}</p>" for _ in range(r.randint(1, 5))),
                lambda: "<ol>" + "".join(f"<li>{words(1, 2)}<p>{sentences(r.randint(1, 3))}</p></li>" for _ in range(r.randint(1, 4))) + "</ol>",
            ])(),
            "share": lambda: links(3),
        }[kind]()
        return f'{_marked(opened, 0)}{inside}</{tag}>'

    def block() -> str:
        pick = r.random()
        if pick < 0.7:
            text = sentences(r.choice([1, 2, 4, 8, 16]))
            return f"<p>{r.choice(['', '', '', '<b>', '<b>', '<a href=/y>' + words(1, 2) + '</a> '])}{text}{r.choice(['</p>', '</p>', '', '<br>'])}"
        if pick < 0.8:
            return f"<h{r.randint(2, 4)}>{words(2, 8)}</h2>" if r.random() < 0.1 else f"<h2>{words(2, 8)}</h2>"
        if pick < 0.87:
            return "<ul>" + "".join(f"<li>{sentences(1)}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
        if pick < 0.92:
            return f"<blockquote><p>{sentences(2)}</p></blockquote>"
        if pick < 0.95:
            return f"<table><tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr></table>"
        return f"<p>{words(1, 3)}.</p>"

    def page() -> str:
        style[0] = r.choice(["", "", "", "", "%%%", ",", "!!", " ", " "])
        title = f"<h1>{words(3, 12)}</h1>"
        title = r.choice([title, title, f"<header>{title}</header>", f"<div>{title}</div>"])
        inside = [noise(r.choice(["advert", "share", "side", "side", "notice", "form", "menu"])) if r.random() < 0.15 else block() for _ in range(r.choice([1, 1, 2, 4, 8, 14]))]
        if r.random() < 0.15:
            inside += [f"<p>{words(1, 3)}.</p>"] * r.randint(5, 60)
        opened = r.choice(["<article>", "<article>", "<article>", "<main>", "<main>", "<main><article>", "<section>", "<div>", named("content"), named("content"), named("content", "section"), '<div class="x1"><div class="y2">'])
        closed = "".join(f"</{t}>" for t in reversed(re.findall(r"<([a-z]+)", opened)))
        tail = noise("comment") if r.random() < 0.45 else ""
        article = f'{_marked(opened, 1)}{title}{"".join(inside)}{tail if r.random() < 0.5 else ""}{closed}{tail if r.random() < 0.5 else ""}'
        before = [noise(k) for k in ("head", "menu", "notice", "advert", "form") if r.random() < 0.5]
        after = [noise(k) for k in ("side", "advert", "comment", "form", "share", "foot", "foot") if r.random() < 0.4]
        r.shuffle(before)
        return "<html><head><title>x</title></head><body>" + "".join(before) + article + "".join(after) + "</body></html>"

    return [page() for _ in range(count)]


def texts(sources: list[str], model: Model) -> list[str]:
    """The content of each page: its runs of text that are content with more than even probability, one per line."""
    pages = [parse(s) for s in sources]
    content = model.marginals(Forest.of(pages))[0]
    found, base = [], 0
    for page in pages:
        found.append("\n".join(t for t, c in zip(page.text, content[base : base + len(page.text)]) if t is not None and c > 0.5))
        base += len(page.text)
    return found


PAGES_AT_ONCE = 64


def extract(pages: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """Per page: page_id, url, text and n_chars.

    A null or empty page, and one without content, gives an empty text. Repeated rows, null ids and null urls pass through; further
    columns do not matter. A task holds a few pages at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(first, PAGES_AT_ONCE)
                found = texts([v.as_py() or "" for v in part.column(2)], model)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema[page_id].dataType.simpleString()
    chosen = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), pages[source].alias("html"))
    return chosen.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
