"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags.  Each block is described
by its ancestor tags, their classes and ids, and by its text; the chain labels blocks as main
text or not, and the best labelling is found by Viterbi.

It is fitted on whole pages, in order of a hash of their id: at most ``SAMPLE`` of them and, after
the first, at most ``LETTERS`` characters.  Their labels come from their own semantic markup:
blocks in an article and in nothing that is never main text.  A class counts by its head word, so
``share-price`` is a price; an article's own header belongs to it.  Since other pages mark the same
parts by other tags and classes, every labelled page is also laid out anew (``LAYOUTS`` times)
with other wrappers and with comments, notices, sidebars and forms.

How it scales: each page is read, cut and labelled where it lies, in time linear in its length
however deep its tags are nested; nothing is shuffled, and the weights that are broadcast are
bounded by the sample.

Defined results: a NULL or empty page has an empty text; broken markup is read as far as it
goes, as browsers do for unclosed tags; a ``>`` in a quoted attribute ends no tag; what follows a
``<`` that no ``>`` ends is text; a page without main blocks has an empty text; repeated rows are
treated alike; without pages to learn from the built-in layouts alone are learned.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections import Counter, defaultdict
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import arrow_map

SAMPLE = 300  # pages used for fitting, at most
LETTERS = 20_000_000  # characters of all pages used for fitting, at most
LAYOUTS = 2
STEPS, RATE, RIDGE = 150, 0.1, 2e-4

_BLOCK = frozenset(
    "address article aside blockquote body br button caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset("script style title noscript template svg math iframe object textarea".split())
# Opening one of these closes an open one of the same group.
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table div section article body aside nav main form header footer".split())
# A quoted value follows a "="; other quotes are plain characters.
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORD = re.compile(r"[a-z0-9]+")
# What markup says is never main text, by tag or by a word of a class or id.
_NEVER = frozenset(
    "nav aside footer form button select label menu navigation sidebar ad ads advert advertisement banner sponsored promo cookie cookies consent notice popup newsletter subscribe comment comments respond breadcrumb breadcrumbs pagination share social related header".split()
)
_MAIN = frozenset("article main content post entry story".split())


# Words that only say what kind of box a class names; the word before them is its head.
_BOX = frozenset("area bar block body bottom box container content group inner item items left links list main nav outer right row section site text title top widget wrap wrapper".split())


class Node:
    """An open element: what it adds to its ancestors."""

    __slots__ = ("parent", "tag", "names", "fresh", "main", "never")

    def __init__(self, parent: Node | None, tag: str, classes: Iterable[str], known: Container[str]):
        self.parent, self.tag = parent, tag
        words = [_WORD.findall(c.lower()) for c in classes]
        self.names = (tag, *("." + w for c in words for w in c))
        self.fresh = tuple(n for n in dict.fromkeys(self.names) if n not in known)  # not among the ancestors' names
        main, never = (parent.main, parent.never) if parent else (False, False)
        heads = {tag, *(next((w for w in reversed(c) if w not in _BOX), c[-1]) for c in words if c)}
        if main:
            heads.discard("header")  # an article's own
        self.main = main or not _MAIN.isdisjoint({tag, *(w for c in words for w in c)})
        self.never = never or not _NEVER.isdisjoint(heads)


@dataclass
class Block:
    node: Node | None  # the innermost element
    text: str
    linked: int = 0  # characters inside links

    def nodes(self) -> Iterator[Node]:
        node = self.node
        while node is not None:
            yield node
            node = node.parent

    @property
    def path(self) -> tuple[str, ...]:
        """Tags and names of the ancestors, outermost first."""
        return tuple(x for node in reversed(list(self.nodes())) for x in node.names)


def placed(path: tuple[str, ...], text: str, linked: int = 0) -> Block:
    """A block inside elements that are given as a path."""
    node, known, i = None, set(), 0
    while i < len(path):
        j = i + 1
        while j < len(path) and path[j][0] == ".":
            j += 1
        node = Node(node, path[i], path[i + 1 : j], known)
        known |= set(node.names)
        i = j
    return Block(node, text, linked)


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order, character references decoded, white space folded."""
    page = page or ""
    out: list[Block] = []
    stack: list[Node] = []
    places: dict[str, list[int]] = defaultdict(list)  # where a tag is open
    scopes: list[int] = []
    known: Counter[str] = Counter()  # names of open elements
    parts: list[str] = []
    linked, at, last = 0, 0, page.rfind(">")

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(stack[-1] if stack else None, text, linked))
            parts.clear()
        linked = 0

    def cut(n: int) -> None:
        for node in reversed(stack[n:]):
            places[node.tag].pop()
            if node.tag in _SCOPES:
                scopes.pop()
            for name in node.fresh:
                del known[name]
        del stack[n:]

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if places["a"]:
            linked += len(text)

    while at < len(page):
        start = page.find("<", at)
        if start != at:
            add(page[at:] if start < 0 else page[at:start])
            if start < 0:
                break
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if start > last:  # nothing after this ends a tag
            add(page[start:])
            break
        m = _TAG.match(page, start)
        if m is None:
            first = page[start + 1 : start + 2]
            if first in ("!", "?") or first == "/" and not page[start + 2 : start + 3].isalpha():
                at = page.find(">", start) + 1
            elif first.isascii() and first.isalpha() or first == "/":
                add(page[start:])  # its end, if any, is inside a quoted value
                break
            else:
                add("<")
                at = start + 1
            continue
        at, tag = m.end(), m.group(2).lower()
        if tag in _BLOCK:
            flush()
        if m.group(1):
            if places[tag]:
                cut(places[tag][-1])
            continue
        if tag in _SKIPPED:
            end = _closing(tag).search(page, at)
            at = page.find(">", end.end()) + 1 if end and end.end() <= last else len(page)
            continue
        if tag in _VOID:
            continue
        # The innermost element that this tag closes, if no scope lies between.
        closed = max((places[t][-1] for t in _CLOSES.get(tag, ()) if places[t]), default=-1)
        if closed > (scopes[-1] if scopes else -1):
            cut(closed)
        classes = [c for n in _NAMES.findall(m.group(3)) for c in "".join(n).split()] if "=" in m.group(3) else []
        node = Node(stack[-1] if stack else None, tag, classes, known)
        known.update(dict.fromkeys(node.fresh, 1))
        places[tag].append(len(stack))
        if tag in _SCOPES:
            scopes.append(len(stack))
        stack.append(node)
    flush()
    return out


@functools.cache
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\b", re.I)


def own_features(block: Block, i: int, n: int) -> list[str]:
    """Features of a block besides its ancestors: shape of the text, place in the page."""
    own = block.node.tag if block.node else ""
    words = block.text.count(" ") + 1
    link = 0 if not block.linked else 1 if block.linked * 2 < len(block.text) else 2
    out = ["bias", f"own {own}", f"words {min(words.bit_length(), 8)}", f"links {link}", f"stop {block.text[-1] in '.!?…'}"]
    if block.text[0] in "©℗®":
        out.append("rights")
    if i == 0 or i == n - 1:
        out.append("first" if i == 0 else "last")
    return out


def described(block: Block, i: int, n: int) -> list[str]:
    """All features of a block: ancestors by tag and by name, and its own."""
    return sorted("in " + x for node in block.nodes() for x in node.fresh) + own_features(block, i, n)


def labels(page: list[Block]) -> list[int]:
    """Labels by semantic markup: inside main text and inside nothing that never is."""
    return [int(b.node is not None and b.node.main and not b.node.never) for b in page]


@dataclass
class Chain:
    """Weights of the label "main" against "not", and of label pairs."""

    weights: dict[str, float] = field(default_factory=dict)
    pairs: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))

    def label(self, page: list[Block]) -> list[int]:
        """The best labelling (Viterbi); ties go to "not main"."""
        if not page:
            return []
        weight, (a, b) = self.weights.get, self.pairs
        sums: dict[int, float] = {}  # of an element and its ancestors, each worked out once

        def inside(node: Node | None) -> float:
            way = []
            while node is not None and id(node) not in sums:
                way.append(node)
                node = node.parent
            total = sums[id(node)] if node is not None else 0.0
            for node in reversed(way):
                total += sum(weight("in " + x, 0.0) for x in node.fresh)
                sums[id(node)] = total
            return total

        back: list[tuple[int, int]] = []
        zero = one = 0.0
        for i, block in enumerate(page):
            e = inside(block.node) + sum(weight(f, 0.0) for f in own_features(block, i, len(page)))
            if i == 0:
                zero, one = 0.0, e
                continue
            from_zero, from_one = (0 if zero + a[0] >= one + b[0] else 1), (0 if zero + a[1] >= one + b[1] else 1)
            zero, one = (zero + a[0] if from_zero == 0 else one + b[0]), (zero + a[1] if from_one == 0 else one + b[1]) + e
            back.append((from_zero, from_one))
        out = [int(one > zero)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]


class _Group:
    """Pages of similar length, padded to the longest."""

    def __init__(self, pages: list[tuple[list[Block], list[int]]], names: dict[str, int]):
        shape = len(pages), max(len(b) for b, _ in pages)
        self.gold, self.real = np.zeros(shape), np.zeros(shape, bool)
        cell, where = [], []
        for p, (page, y) in enumerate(pages):
            for i, block in enumerate(page):
                own = [names.setdefault(f, len(names)) for f in described(block, i, len(page))]
                cell += own
                where += [p * shape[1] + i] * len(own)
                self.gold[p, i], self.real[p, i] = y[i], True
        self.cells, self.places = np.array(cell), np.array(where)
        both = self.real[:, 1:] & self.real[:, :-1]
        self.seen = np.array([((self.gold[:, :-1] == x) & (self.gold[:, 1:] == y) & both).sum() for x in (0, 1) for y in (0, 1)])

    def gradient(self, theta: np.ndarray) -> np.ndarray:
        """Expected minus observed counts, by forward and backward sums."""
        gold, real = self.gold, self.real
        e = np.bincount(self.places, weights=theta[self.cells], minlength=gold.size).reshape(gold.shape)
        t, length = theta[-4:].reshape(2, 2), gold.shape[1]
        scores = np.stack([np.zeros_like(e), e], axis=2)
        fwd = np.zeros_like(scores)
        fwd[:, 0] = scores[:, 0]
        for i in range(1, length):
            nxt = np.logaddexp(fwd[:, i - 1, 0, None] + t[0], fwd[:, i - 1, 1, None] + t[1]) + scores[:, i]
            fwd[:, i] = np.where(real[:, i, None], nxt, fwd[:, i - 1])
        z = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        bwd = np.zeros_like(scores)
        expected = np.zeros(4)
        for i in range(length - 2, -1, -1):
            ahead = scores[:, i + 1] + bwd[:, i + 1]
            nxt = np.logaddexp(t[:, 0] + ahead[:, 0, None], t[:, 1] + ahead[:, 1, None])
            bwd[:, i] = np.where(real[:, i + 1, None], nxt, 0)
            pair = np.exp(fwd[:, i, :, None] + t + ahead[:, None, :] - z[:, None, None])
            expected += pair[real[:, i + 1]].sum(axis=0).reshape(-1)
        main = np.where(real, np.exp(fwd[:, :, 1] + bwd[:, :, 1] - z[:, None]), 0)
        grad = np.empty_like(theta)
        grad[:-4] = np.bincount(self.cells, weights=(main - gold).reshape(-1)[self.places], minlength=len(theta) - 4)
        grad[-4:] = expected - self.seen
        return grad


def fit(pages: list[tuple[list[Block], list[int]]]) -> Chain:
    """Maximum likelihood with a ridge, by scaled gradient steps over all pages at once."""
    by_length: dict[int, list] = defaultdict(list)
    for b, y in pages:
        if b:
            by_length[len(b).bit_length()].append((b, y))
    names: dict[str, int] = {}
    groups = [_Group(some, names) for _, some in sorted(by_length.items())]
    total = sum(g.real.sum() for g in groups)
    theta = np.zeros(len(names) + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        grad = sum(g.gradient(theta) for g in groups) / total + RIDGE * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    t = theta[-4:].tolist()
    return Chain({f: float(theta[i]) for f, i in names.items()}, ((t[0], t[1]), (t[2], t[3])))


_WRAPPERS = {
    "main": [("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post"), ("section", ".entry", ".content"), ("div", ".article", ".body"), ("main", ".main", "div", ".story")],
    "menu": [("nav", "ul"), ("div", ".menu", "ul"), ("header", "nav", "ul"), ("ul", ".navigation"), ("div", ".breadcrumb")],
    "advert": [("div", ".ad"), ("aside", ".sponsored"), ("div", ".advert"), ("div", ".banner"), ("section", ".promo")],
    "footer": [("footer",), ("div", ".footer"), ("footer", ".site", ".footer", "div")],
    "header": [("header",), ("div", ".header"), ("header", ".site", ".header", "div")],
    "comment": [("section", ".comments"), ("div", ".comment"), ("ul", ".comments", "li", ".comment"), ("div", ".comments", "article", ".comment")],
    "notice": [("div", ".cookie", ".notice"), ("div", ".consent"), ("section", ".notice"), ("div", ".newsletter"), ("dialog", ".popup")],
    "sidebar": [("aside",), ("div", ".sidebar"), ("aside", ".sidebar", "ul"), ("div", ".related")],
    "form": [("form",), ("div", ".subscribe", "form"), ("form", ".search")],
}


def layout(page: list[Block], gold: list[int], other: list[str], draw: random.Random) -> tuple[list[Block], list[int]]:
    """A labelled page with other wrappers around its parts and with more parts."""
    out: list[Block] = []
    y: list[int] = []
    root = ("html", "body") + draw.choice([(), ("div",), ("div", ".page"), ("div", ".wrapper")])

    def add(kind: str, texts: list[str], tag: str = "p", linked: bool = False, inside: tuple[str, ...] = ()) -> None:
        path = root + inside + draw.choice(_WRAPPERS[kind])
        for t in texts:
            if t:
                out.append(placed(path + ((tag,) if tag else ()) + (("a",) if linked else ()), t, len(t) if linked else 0))
                y.append(int(kind == "main"))

    def some(k: int) -> list[str]:
        return [draw.choice(other) for _ in range(draw.randint(1, k))] if other else []

    short = [b.text for b, g in zip(page, gold, strict=True) if not g] or ["Home", "About us", "Contact"]
    if draw.random() < 0.5:
        add("header", [draw.choice(short)], draw.choice(["div", "p", "h1", "span"]))
    add("menu", short[: draw.randint(2, 8)], "li", True)
    if draw.random() < 0.6:
        add("notice", some(1), draw.choice(["p", ""]))
    if draw.random() < 0.6:
        add("advert", some(1), draw.choice(["p", ""]))
    if draw.random() < 0.4:
        add("sidebar", some(3), draw.choice(["li", "p"]), draw.random() < 0.5)
    main, inner = root + draw.choice(_WRAPPERS["main"]), draw.random() < 0.4
    texts = [b for b, g in zip(page, gold, strict=True) if g]
    for i, b in enumerate(texts):
        own = b.node.tag if b.node else "p"
        out.append(placed(main + (own if own in ("p", "h1", "h2", "h3", "li", "td", "pre") else "p",), b.text, b.linked))
        y.append(1)
        if inner and i == len(texts) // 2:
            add(draw.choice(["advert", "sidebar", "form", "notice"]), some(1), "p", inside=main[len(root) :])
    for kind in draw.sample(["comment", "comment", "sidebar", "form", "advert", "notice"], draw.randint(1, 4)):
        add(kind, some(4), draw.choice(["p", "div", "li"]))
    add("footer", [draw.choice(short)], draw.choice(["p", "div", ""]))
    return out, y


_BUILT_IN = [
    placed(("html", "body", "nav", "ul", "li", "a"), "Home", 4),
    placed(("html", "body", "article", "h1"), "A heading of the page"),
    placed(("html", "body", "article", "p"), "A paragraph of main text, with a few sentences. It ends here."),
    placed(("html", "body", "footer"), "© The owners of the page"),
]


def train(pages: DataFrame, sample: int = SAMPLE, letters: int = LETTERS) -> Chain:
    """Fit on at most ``sample`` whole pages with main text by their markup."""
    total = max(1, pages.count())
    share = min(1 << 30, int((1 << 30) * sample / total))
    place = F.pmod(F.xxhash64("page_id", F.lit(3)), F.lit(1 << 30))
    first = pages.where(place < share).select("html", F.length("html").alias("n"), place.alias("place")).orderBy("place", "n", "html").limit(sample)
    before = F.sum(F.coalesce("n", F.lit(0))).over(Window.orderBy("place", "n", "html").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # At most ``sample`` rows; the first page counts whatever its length.
    kept = first.withColumn("sum", before).where((F.col("sum") <= letters) | (F.col("sum") == F.col("n")))
    cut = [blocks(r["html"]) for r in kept.select("html").collect()]
    known = [(b, labels(b)) for b in [_BUILT_IN, *cut]]
    known = [(b, y) for b, y in known if any(y)]
    draw = random.Random(4)
    texts = [b.text for page, y in known for b, g in zip(page, y, strict=True) if g]
    more = [layout(b, y, texts, draw) for b, y in known for _ in range(LAYOUTS)]
    return fit(known + more)


def main_text(pages: DataFrame, model: Chain | None = None) -> DataFrame:
    """Per page: ``page_id``, ``url``, ``text`` and its length in code points."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train(pages))

    def make():
        chain = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = []
            for page in batch.column("html").to_pylist():
                cut = blocks(page)
                texts.append(" ".join(b.text for b, y in zip(cut, chain.label(cut), strict=True) if y))
            return pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

        return step

    return arrow_map(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), make, "page_id long, url string, text string, n_chars long")
