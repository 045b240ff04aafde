"""Main text of HTML pages by a tree-structured graphical model over the DOM.

Every element is a variable: part of the article or of the page's frame. Its own evidence (tag, words
of class and id, share of linked text, length) and the link to its parent are factors whose values
are estimated from labelled pages. One pass of sum-product messages from the leaves to the root and
one back give exact marginals; text whose nearest block has a marginal above one half is kept. Elements
that can never be article (hidden ones such as icons and buttons, forms, menus) tell nothing about the
element around them, so they send no message up.

A null or empty page, and one without article, gives an empty text. Broken markup is read leniently
(unclosed heads, paragraphs and items close as usual, unknown closing tags are ignored, a tag that never
ends is text); pages of any length and nesting take time in proportion to their length. Repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache
from html import unescape
from math import exp, log
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import map_batches

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split())
_HIDDEN = frozenset("script style noscript template head title iframe object svg canvas audio video button select textarea".split())
# What may stand in a head; any other tag, and text, ends one that is not closed.
_IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
# An opening tag closes open elements of the second kind, up to one of the third.
_CLOSES_P = _BLOCK - {"body", "html", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot"}
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "option": ({"option"}, {"select"}),
}
_P_ONLY, _P_KEEPERS = {"p"}, {"button", "table", "td", "th", "object"}
_SPACE = re.compile(r"\s+")
_NAME_WORDS = re.compile(r"[a-z]+")

# Kinds of words in class, id and role.
_KINDS = {
    kind: frozenset(words.split()) for kind, words in {
        "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner hero",
        "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip tabs sitemap",
        "header": "header masthead topbar head top logo branding",
        "footer": "footer foot copyright colophon bottom legal",
        "side": "sidebar side aside widget widgets rail related recommended popular trending teaser more",
        "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay message toast announcement disclaimer privacy paywall",
        "comment": "comment comments commentlist reply replies respond discussion disqus reader readers reviews",
        "form": "form subscribe subscription newsletter login signin signup register search contact",
        "social": "social share sharing follow tweet facebook like",
        "content": "content article post entry story main text body prose page news blog",
    }.items()
}


class Node:
    __slots__ = ("tag", "parent", "names", "mark", "own", "length", "linked", "hidden", "block")

    def __init__(self, tag: str, parent: Node | None, names: frozenset[str], mark: bool | None) -> None:
        self.tag, self.parent, self.names, self.mark = tag, parent, names, mark
        self.own = self.length = self.linked = 0
        self.hidden = tag in _HIDDEN or (parent is not None and parent.hidden)
        self.block: Node = self if parent is None or tag in _BLOCK else parent.block


# Comments, declarations, elements whose content is no markup, tags; quotes in a tag may hold ">".
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attrs2>[^>]*)>", re.S | re.I)
_RAW_END = re.compile(r"</[a-z]+\s*>\Z", re.I)
_DECLARATION = re.compile(r"<[!?]")
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


class _Tree:
    """Elements in document order, and the texts in it with the element each stands in."""

    def __init__(self) -> None:
        self.root = Node("html", None, frozenset(), None)
        self.nodes = [self.root]
        self.texts: list[tuple[Node, str]] = []
        self.open = [self.root]
        self.places = defaultdict(list, html=[0])  # where each tag is open, outermost first

    def _cut(self, i: int) -> None:
        for node in self.open[i:]:
            self.places[node.tag].pop()
        del self.open[i:]

    def _innermost(self, tags: set[str] | frozenset[str]) -> int:
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def _close(self, closing: set[str] | frozenset[str], until: set[str]) -> None:
        i = self._innermost(closing)
        if i > self._innermost(until):
            self._cut(i)

    def _add(self, tag: str, names: frozenset[str], mark: bool | None) -> Node:
        node = Node(tag, self.open[-1], names, mark)
        self.nodes.append(node)
        return node

    def start(self, tag: str, attrs: str) -> None:
        if self.places.get("head") and tag not in _IN_HEAD:
            self._close({"head"}, set())
        if tag == "br":
            self.texts.append((self.open[-1], " "))
        if tag == "html" or tag in _VOID and tag not in ("hr", "input"):
            return
        if tag == "head" and len(self.open) > 1:  # only the page itself has a head
            return
        if tag in _CLOSES_P:
            self._close(_P_ONLY, _P_KEEPERS)
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        names, mark, hidden = frozenset(), self.open[-1].mark, False
        if attrs and not attrs.isspace():
            values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attrs)}
            names = frozenset(_NAME_WORDS.findall(" ".join(values.get(k, "") for k in ("class", "id", "role")).lower()))
            mark = True if "keep" in values else False if "drop" in values else mark
            hidden = "hidden" in values
        node = self._add(tag, names, mark)
        node.hidden |= hidden
        if tag not in _VOID:
            self.places[tag].append(len(self.open))
            self.open.append(node)

    def end(self, tag: str) -> None:
        if tag != "html" and self.places.get(tag):
            self._cut(self.places[tag][-1])
            return
        if tag == "p":  # a closing tag alone makes an empty paragraph, so text before and after it is apart
            self._add("p", frozenset(), self.open[-1].mark)
            self.texts.append((self.nodes[-1], ""))

    def text(self, text: str) -> None:
        if text:
            if self.open[-1].tag == "head" and not text.isspace():
                self._cut(len(self.open) - 1)
            self.texts.append((self.open[-1], unescape(text) if "&" in text else text))


def parse(html: str) -> _Tree:
    """The tree of a page, with the lengths of text and linked text below every element."""
    tree, at = _Tree(), 0
    # No tag ends behind the last ">", so none is looked for there.
    end, unclosed = html.rfind(">") + 1, False
    for m in _TOKEN.finditer(html, 0, end):
        if m.start() > at:
            tree.text(html[at:m.start()])
        at = m.end()
        if at == end:
            unclosed = m[0].startswith("<!--") and not m[0].endswith("-->") or bool(m["raw"]) and not _RAW_END.search(m[0])
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        if m["close"] or m["close2"]:
            tree.end(tag.lower())
        else:
            tree.start(tag.lower(), m["attrs"] or m["attrs2"] or "")
    if not unclosed:
        rest = html[at:]
        opened = _DECLARATION.search(rest)
        tree.text(rest[:opened.start()] if opened else rest)
    for node, text in tree.texts:
        if not node.hidden:
            node.own += len(text.strip())
    for node in reversed(tree.nodes):  # children stand after their parents
        node.length += node.own
        if node.tag == "a":
            node.linked = node.length
        if node.parent is not None:
            node.parent.length += node.length
            node.parent.linked += node.linked
    return tree


def evidence(node: Node) -> tuple[str, ...]:
    """What the model sees of an element; every entry is one observation."""
    kinds = [kind for kind, words in _KINDS.items() if node.names & words] if node.names else ()
    linked = node.linked / node.length if node.length else 0.0
    share = "linked:" + ("none" if linked == 0 else "some" if linked < 0.35 else "most")
    length = "length:" + ("none" if not node.length else "short" if node.length < 25 else "long")
    return (f"tag:{node.tag}", share, length, *(f"kind:{k}" for k in kinds or ["none"]))


class Potentials(NamedTuple):
    """Log factors: of each observation in favour of the article, of parent and child labels."""
    unary: dict[str, float]
    pair: np.ndarray  # [parent label, child label]; label 0 is the frame, 1 the article


#: Log odds of an element that cannot be article.
_NEVER = -30.0
_FRAME_TAGS = frozenset(("html", "form", "nav", "input"))


def messages(nodes: list[Node], potentials: Potentials) -> tuple[list[float], list[float], list[float]]:
    """Sum-product on the tree, in log odds of article against frame.

    One message per element upwards, then one downwards; returned are every element's belief, what
    its subtree says of it, and what the rest of the tree says of its parent.
    """
    place = {node: i for i, node in enumerate(nodes)}
    parent = [place[n.parent] if n.parent is not None else -1 for n in nodes]
    (e00, e01), (e10, e11) = np.exp(potentials.pair).tolist()
    weights = potentials.unary.get
    never = [node.hidden or node.tag in _FRAME_TAGS for node in nodes]
    below = [_NEVER if fixed else sum(weights(e, 0.0) for e in evidence(node)) for node, fixed in zip(nodes, never)]
    up = [0.0] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):  # children stand after their parents
        if never[i]:
            continue
        odds = exp(min(max(below[i], -30.0), 30.0))
        up[i] = log((e10 + e11 * odds) / (e00 + e01 * odds))
        below[parent[i]] += up[i]
    belief, outside = list(below), [0.0] * len(nodes)
    for i in range(1, len(nodes)):
        outside[i] = min(max(belief[parent[i]] - up[i], -30.0), 30.0)
        odds = exp(outside[i])
        belief[i] = below[i] + log((e01 + e11 * odds) / (e00 + e10 * odds))
    return belief, below, outside


def train(pages: tuple[str, ...], rounds: int = 250, rate: float = 0.4, shrink: float = 0.002) -> Potentials:
    """Weights of the highest penalized likelihood of the marked pages, by gradient ascent with
    steps scaled per weight.

    The gradient of a weight is how often its observation occurs in the article less how often the
    marginals expect it there; likewise for label pairs. Elements without a mark are the skeleton.
    """
    trees = [parse(page).nodes for page in pages]
    unary: dict[str, float] = defaultdict(float)
    pair = np.array([[1.0, -1.0], [-1.0, 1.0]])
    squares: dict[str, float] = defaultdict(lambda: 1e-6)
    pair_squares = np.full((2, 2), 1e-6)
    for _ in range(rounds):
        step: dict[str, float] = defaultdict(float)
        pair_step = np.zeros((2, 2))
        for nodes in trees:
            belief, below, outside = messages(nodes, Potentials(unary, pair))
            for i, node in enumerate(nodes):
                if node.mark is None or node.hidden or node.tag in _FRAME_TAGS:
                    continue
                expected = 1.0 / (1.0 + exp(-min(max(belief[i], -30.0), 30.0)))
                for e in evidence(node):
                    step[e] += float(node.mark) - expected
                if i:
                    joint = np.exp(pair + np.array([[0.0], [outside[i]]]) + np.array([0.0, min(below[i], 30.0)]))
                    pair_step -= joint / joint.sum()
                    pair_step[int(bool(node.parent.mark)), int(node.mark)] += 1.0
        for e, g in step.items():
            g -= shrink * len(trees) * unary[e]
            squares[e] += g * g
            unary[e] += rate * g / squares[e] ** 0.5
        pair_step -= shrink * len(trees) * pair
        pair_squares += pair_step * pair_step
        pair = pair + rate * pair_step / np.sqrt(pair_squares)
    return Potentials(dict(unary), pair)


@lru_cache(1)
def default_potentials() -> Potentials:
    from .labelled_pages import PAGES

    return train(PAGES)


def marginals(nodes: list[Node], potentials: Potentials) -> dict[Node, float]:
    """Probability of each element being article."""
    return {n: 1.0 / (1.0 + exp(-min(max(b, -30.0), 30.0))) for n, b in zip(nodes, messages(nodes, potentials)[0])}


def main_text(html: str, potentials: Potentials | None = None) -> str:
    """The article's blocks in page order, joined by a blank line."""
    if not html:
        return ""
    tree = parse(html)
    belief = marginals(tree.nodes, potentials or default_potentials())
    blocks: list[str] = []
    parts: list[str] = []
    current: Node | None = None

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            blocks.append(text)
        parts.clear()
    for node, text in tree.texts:
        if node.hidden:
            continue
        block = node.block
        if block is not current:
            flush()
            current = block
        if belief[block] > 0.5 and belief[node] > 0.5:
            parts.append(text)
    flush()
    return "\n\n".join(blocks)


def extract(pages: DataFrame, potentials: Potentials | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(potentials or default_potentials())

    def read(batch: pd.DataFrame) -> pd.DataFrame:
        texts = [main_text(html, shared.value) for html in batch["html"]]
        return pd.DataFrame({
            "page_id": batch["page_id"].astype("Int64").to_numpy(dtype=object, na_value=None), "url": batch["url"],
            "text": texts, "n_chars": [len(t) for t in texts]})
    whole = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return map_batches(whole, read, "page_id long, url string, text string, n_chars long")
