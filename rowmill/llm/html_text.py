"""Main text of web pages by a tree-structured graphical model.

The block elements of a page are a tree of hidden states: 1 inside the main text, 0
outside. A node's tag, names, text length and share of link text depend on its state, and
a child's state depends on its parent's. Sum-product message passing, from the leaves up
and from the root down, gives every node's exact marginal; the text of blocks whose
marginal is at least a half is the main text.

Parameters are smoothed counts over labelled pages: examples made by rule below, and a
bounded sample of a table's own pages in which landmark elements name their roles. Tags
that by definition hold no main text are observed to be 0.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowmill.llm.common import text_slices

#: Pages of a table that are labelled by their landmarks at most.
MAX_LABELLED_PAGES = 400
#: Bounds of what one feature may add to a node's log odds: names say more than the rest.
MAX_NAME_ODDS = 12.0
MAX_LANDMARK_ODDS = 6.0
MAX_LOG_ODDS = 1.0
#: Bound of the chance that main text begins below a node outside it.
MAX_TURN = 0.02

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split()
)
BREAKS = frozenset(["br", "wbr", "hr"])
NEVER = RAW | frozenset(
    "head nav aside footer form button select option svg canvas object audio video template dialog "
    "fieldset menu math".split()
)
LANDMARKS = frozenset(["article", "main"])
#: Open elements that a start tag ends, and where the search for them stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
KEEP_PARAGRAPH = INLINE | VOID - {"hr"} | RAW | {"button", "svg", "canvas", "object", "audio", "video", "option", "select"}

BOILERPLATE_NAMES = (
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disclaimer discussion footer form gdpr header login menu nav navbar navigation newsletter notice pagination "
    "pager popup promo recommended related replies respond rss search share sharing sidebar signup social "
    "sponsor sponsored subscribe tags teaser toolbar widget"
).split()
CONTENT_NAMES = "article body content entry main page post story text".split()

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    tag: str
    parent: int
    names: tuple[str, ...] = ()
    label: int | None = None
    text: int = 0
    links: int = 0


@dataclass
class Page:
    """Block elements in page order, and the text blocks as (node, pieces)."""

    nodes: list[Node] = field(default_factory=lambda: [Node("#page", -1)])
    blocks: list[tuple[int, list[str]]] = field(default_factory=list)


def parse(source: str) -> Page:
    """The block tree of a page. Like a browser it survives missing and stray end tags."""
    page, stack, links, at, size = Page(), [0], 0, 0, len(source)
    nodes, blocks = page.nodes, page.blocks
    open_block = False

    def add(text: str) -> None:
        nonlocal open_block
        if not open_block:
            if text.isspace():
                return
            blocks.append((stack[-1], []))
            open_block = True
        blocks[-1][1].append(text)
        length = len(text.strip())
        nodes[stack[-1]].text += length
        nodes[stack[-1]].links += length if links else 0

    while at < size:
        found = TOKEN.search(source, at)
        start = found.start() if found else size
        if start > at:
            add(html.unescape(source[at:start]) if "&" in source[at:start] else source[at:start])
        if not found:
            break
        at = found.end()
        closing, tag = found[1], (found[2] or "").lower()
        if not tag:
            continue
        if tag in BREAKS:
            if open_block:
                add(" ")
            open_block = open_block and tag != "hr"
        elif tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if closing else 1)) if closing else 1
        elif tag in VOID:
            pass
        elif closing:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    del stack[depth:]
                    break
            open_block, links = False, 0
        else:
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else size
                continue
            if tag not in KEEP_PARAGRAPH and nodes[stack[-1]].tag == "p":
                stack.pop()
            if tag in ENDS:
                ended, bounds = ENDS[tag]
                for depth in range(len(stack) - 1, 0, -1):
                    if nodes[stack[depth]].tag in bounds:
                        break
                    if nodes[stack[depth]].tag in ended:
                        del stack[depth:]
                        break
            names, label = (), None
            if "=" in found[3]:
                for name, *values in ATTRIBUTE.findall(found[3]):
                    value = next((v for v in values if v), "")
                    if name.lower() == "data-main":
                        label = int(value == "1")
                    else:
                        names += tuple(w.lower() for w in NAME.findall(value))
            nodes.append(Node(tag, stack[-1], names, label))
            if not found[3].rstrip().endswith("/") or tag not in ("svg", "math"):
                stack.append(len(nodes) - 1)
            open_block, links = False, 0
    return page


def features(page: Page, number: int) -> Iterator[str]:
    node = page.nodes[number]
    yield "tag " + node.tag
    for name in set(node.names):
        yield "name " + name
    if node.text:
        yield "text " + ("1" if node.text < 25 else "2" if node.text < 100 else "3")
        yield "links " + str(int(2 * node.links > node.text))


def labels_of(page: Page) -> list[int] | None:
    """Each node's label: its own mark, else its parent's; without any mark 1 below an
    article or main element, unless the tag or an element between never holds main text.
    None if the page has neither marks nor landmarks."""
    marked = any(n.label is not None for n in page.nodes)
    if not marked and not any(n.tag in LANDMARKS for n in page.nodes):
        return None
    out: list[int] = []
    for node in page.nodes:
        above = out[node.parent] if node.parent >= 0 else 0
        if node.label is not None:
            above = node.label
        elif not marked and node.tag in LANDMARKS:
            above = int(not shut_out(page, node))
        out.append(0 if node.tag in NEVER else above)
    return out


def shut_out(page: Page, node: Node) -> bool:
    while node.parent >= 0:
        node = page.nodes[node.parent]
        if node.tag in NEVER:
            return True
    return False


def observations(page: Page, labels: list[int]) -> Iterator[tuple[str, int]]:
    """(feature, state) pairs to count. Where a node has names, they and not its tag explain
    its state."""
    for number, (node, state) in enumerate(zip(page.nodes, labels)):
        yield "node", state
        if node.parent >= 0:
            yield f"after {labels[node.parent]}", state
        for name in features(page, number):
            if not (node.names and name.startswith("tag ")):
                yield name, state


def example_pages() -> Iterator[str]:
    """Labelled pages by rule: each name once as a block beside and once inside the main
    text, and the usual shapes of main texts."""
    long, short = "word " * 40, "word word"
    shapes = ["<{t}>" + long + "</{t}>", "<{t}>" + long + "</{t}><{t}>" + long + "</{t}>"]
    wraps = ["article", "main", "div", "section"]
    for i, name in enumerate(BOILERPLATE_NAMES):
        wrap, inner = wraps[i % 4], ["p", "div", "li"][i % 3]
        junk = f'<div class="{name}" data-main="0"><{inner}>{long}</{inner}><a href="x">{short}</a></div>'
        content = f"<h1>{short}</h1><p>{long}</p><h2>{short}</h2><div>{long}</div><ul><li>{long}</li></ul>"
        main = CONTENT_NAMES[i % len(CONTENT_NAMES)]
        yield f'<body><{wrap} class="{main}" data-main="1">{content}{junk}</{wrap}></body>'
        yield f'<body>{junk}<{wrap} id="{main}" data-main="1"><p>{long}</p><p>{short}</p></{wrap}></body>'
        yield f'<body><section id="{name}" data-main="0"><article class="{name}"><p>{long}</p></article></section></body>'
    for tag in ("p", "blockquote", "pre", "td", "dd", "figcaption", "section", "header"):
        for shape in shapes:
            yield f'<body><article data-main="1"><h1>{short}</h1>{shape.format(t=tag)}<h3>{short}</h3></article></body>'
            yield f'<body><header data-main="0"><h1>{short}</h1><p>{short}</p></header><main data-main="1">{shape.format(t=tag)}</main></body>'


@dataclass(frozen=True)
class Model:
    """Log odds of a feature for state 1, and chances of a child's state after a parent's."""

    odds: dict[str, float]
    after: tuple[tuple[float, float], tuple[float, float]]

    @staticmethod
    def fitted(examples: Counter, own: Counter) -> "Model":
        """From feature counts of the example pages and of a table's own, which weigh as much
        as the examples together at most."""
        nodes = [max(1.0, c["node", 0] + c["node", 1]) for c in (examples, own)]
        weight = min(1.0, nodes[0] / nodes[1])
        found = Counter(examples)
        for name, n in own.items():
            found[name] += n * weight
        total = [found["node", s] + 1.0 for s in (0, 1)]
        odds = {}
        for name in {k for k, _ in found if k != "node" and not k.startswith("after ")}:
            bound, least = (MAX_NAME_ODDS, 1e-4) if name.startswith("name ") else (MAX_LOG_ODDS, 0.5)
            if name.removeprefix("tag ") in LANDMARKS:
                bound, least = MAX_LANDMARK_ODDS, 1e-2
            value = math.log((found[name, 1] + least) / total[1]) - math.log((found[name, 0] + least) / total[0])
            odds[name] = max(-bound, min(bound, value))
        after = []
        for parent in (0, 1):
            n = [found[f"after {parent}", s] + 1.0 for s in (0, 1)]
            turn = n[1] / sum(n)
            turn = min(turn, MAX_TURN) if parent == 0 else turn
            after.append((1 - turn, turn))
        return Model(odds, tuple(after))

    def marginals(self, page: Page) -> list[float]:
        """The chance that each node is main text, given everything on the page."""
        nodes, (to0, to1) = page.nodes, self.after
        own: list[tuple[float, float]] = []
        for number, node in enumerate(nodes):
            if node.tag in NEVER or node.parent < 0:  # seen to be 0; the page itself says nothing
                own.append((0.5, 0.5) if node.parent < 0 else (1.0, 0.0))
                continue
            odds = sum(self.odds.get(f, 0.0) for f in features(page, number))
            chance = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            own.append((1 - chance, chance))
        below = list(own)  # evidence at and below each node
        sent: list[tuple[float, float]] = [(1.0, 1.0)] * len(nodes)
        for number in range(len(nodes) - 1, 0, -1):
            a, b = below[number]
            up0, up1 = to0[0] * a + to0[1] * b, to1[0] * a + to1[1] * b
            scale = up0 + up1
            sent[number] = (up0 / scale, up1 / scale)
            x, y = below[nodes[number].parent]
            x, y = x * sent[number][0], y * sent[number][1]
            scale = x + y
            below[nodes[number].parent] = (x / scale, y / scale)
        out = [below[0][1]] + [0.0] * (len(nodes) - 1)
        for number in range(1, len(nodes)):
            parent = out[nodes[number].parent]
            # what the parent knows without this child
            p0, p1 = (1 - parent) / max(sent[number][0], 1e-300), parent / max(sent[number][1], 1e-300)
            a, b = below[number]
            c0, c1 = (p0 * to0[0] + p1 * to1[0]) * a, (p0 * to0[1] + p1 * to1[1]) * b
            out[number] = c1 / (c0 + c1)
        return out

    def main_text(self, source: str | None) -> str:
        if not source:
            return ""
        page = parse(source)
        chances = self.marginals(page)
        kept = (" ".join("".join(pieces).split()) for node, pieces in page.blocks if chances[node] >= 0.5)
        return "\n\n".join(t for t in kept if t)


def count_labelled(sources: Iterable[str | None]) -> Counter:
    counts: Counter = Counter()
    for source in sources:
        page = parse(source or "")
        if (labels := labels_of(page)) is not None:
            counts.update(observations(page, labels))
    return counts


def fit(pages: DataFrame, key: str = "page_id", text: str = "html", max_pages: int = MAX_LABELLED_PAGES) -> Model:
    """The model from the example pages and at most ``max_pages`` pages of the table, the
    first by a hash, that carry landmarks. What reaches the driver is their feature counts."""
    sample = (
        pages.select(F.col(text).cast("string").alias("html"), F.xxhash64(F.col(key), F.lit(7)).alias("place"))
        .where("html RLIKE '(?i)<(article|main)[ >]'").orderBy("place").limit(max_pages).select("html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "html"):
            found = count_labelled(part.column("html").to_pylist())
            names, states = zip(*found) if found else ((), ())
            yield pa.record_batch(
                [pa.array(names, pa.string()), pa.array(states, pa.int32()), pa.array(found.values(), pa.int64())],
                ["name", "state", "n"],
            )

    counted = sample.mapInArrow(run, "name string, state int, n long").groupBy("name", "state").agg(F.sum("n").alias("n"))
    own = Counter({(r["name"], r["state"]): r["n"] for r in counted.collect()})
    return Model.fitted(count_labelled(example_pages()), own)


def extract(
    pages: DataFrame, model: Model, key: str = "page_id", url: str = "url", text: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) of every whole page.

    Blocks have single spaces and stand in page order, two newlines apart. A null or empty
    page has an empty text; null ids stay null; repeated rows give repeated results; other
    columns are left out. No shuffle.
    """
    held = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.col(text).cast("string").alias("html"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "html"):
            texts = [held.value.main_text(h) for h in part.column("html").to_pylist()]
            yield pa.record_batch(
                [
                    part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
