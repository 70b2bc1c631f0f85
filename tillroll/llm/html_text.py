"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element and text of a page is main text or not. A node's own evidence
(tag, words of its class and id, length, share of links) and the potentials
between parents and children are estimated from labelled pages. Messages go up
from the leaves to the root and down again, which gives each node's marginal
probability given the whole page; the texts that are main text more likely than
not are put out block by block.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.labelled_pages import labelled_pages

# Elements by what HTML makes of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style textarea title xmp iframe noembed noframes head template select svg math object canvas audio video noscript datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big button cite code data del dfn em font i img input ins kbd label mark meter nobr output "
    "progress q rp rt ruby s samp select small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_ITSELF = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"),
    "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select", "optgroup"),
}
ALIKE = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<",
    re.S,
)
_BEHIND = re.compile(r"<[!?].*|(?:[^<]|<(?![!?]))+", re.S)  # without any > further on
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(\bhidden\b)""")
_NAME_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
LABEL = "data-label"
SMOOTHING = 0.05


class Page(NamedTuple):
    """Nodes in document order (a parent before its children), and texts and block borders as they come."""

    parent: list[int]
    features: list[tuple[str, ...]]
    label: list[str | None]
    events: list[tuple[int, str] | None]
    unseen: list[bool]


def _names(tag: str, attributes: str) -> tuple[list[str], str | None, bool]:
    """Features of an opening tag, its training label, and whether it is hidden."""
    found, label, hidden = [f"tag:{tag}"], None, False
    for name, value, bare in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            found += [f"name:{part}" for part in _NAME_PART.findall(_CAMEL.sub(" ", value).lower())]
        elif name == "role":
            found.append(f"role:{value.lower()}")
        elif name == LABEL:
            label = value
        elif bare or name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "").lower()):
            hidden = True
    return list(dict.fromkeys(found)), label, hidden


def parse(page: str) -> Page:
    """Read a page as browsers do in the main: raw text, void elements, implied ends and missing ones.

    Takes time in proportion to the page, however malformed: the depths of open
    elements are kept by tag, and what is behind the last `>` holds no tags.
    """
    parent, names, label, unseen, texts, links = [-1], [[]], [None], [False], [0], [0]
    tags = [""]
    events: list[tuple[int, str] | None] = []
    stack = [0]
    opened: defaultdict[str, list[int]] = defaultdict(list)
    blocks = [0]  # depths of open elements that are not inline
    in_link = 0
    at, n, last = 0, len(page), page.rfind(">")

    def close(depth: int) -> None:
        nonlocal in_link
        for node in stack[depth:]:
            in_link -= tags[node] == "a"
            opened[tags[node]].pop()
            if tags[node] not in INLINE:
                blocks.pop()
                events.append(None)
        del stack[depth:]

    while at < n:
        token = _TOKEN.match(page, at) if at <= last else _BEHIND.match(page, at)
        at = token.end()
        tag = (token[2] or token[5]) if token.re is _TOKEN else None
        if tag is None:
            text = token.group()
            if text.startswith(("<!", "<?")):
                continue
            top = stack[-1]
            text = html.unescape(text)
            size = len(text.strip())
            if size and not unseen[top]:
                parent.append(top)
                names.append(["text"])
                label.append(None)
                unseen.append(False)
                texts.append(size)
                links.append(size if in_link else 0)
                tags.append("")
                events.append((len(parent) - 1, text))
            elif not unseen[top]:
                events.append((-1, " "))
            continue
        tag = tag.lower()
        if token[1] or token[4]:
            if opened[tag]:
                close(opened[tag][-1])
            continue
        if tag == "br":
            events.append((-1, " "))
            continue
        if tag not in INLINE and tag not in VOID:
            _close_implied(tag, opened, blocks, close)
        found, marked, hidden = _names(tag, token[3] if token[2] else token[6])
        top = stack[-1]
        node = len(parent)
        parent.append(top)
        names.append(found)
        label.append(marked)
        unseen.append(unseen[top] or hidden or tag in UNSEEN)
        texts.append(0)
        links.append(0)
        tags.append(tag)
        if tag not in INLINE:
            events.append(None)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not (token.group().endswith("/>") and unseen[top]):
            opened[tag].append(len(stack))
            if tag not in INLINE:
                blocks.append(len(stack))
            stack.append(node)
            in_link += tag == "a"
    for node in range(len(parent) - 1, 0, -1):
        texts[parent[node]] += texts[node]
        links[parent[node]] += links[node]
    # Texts and inline elements go with the block they are in: only blocks bear evidence of size.
    features = [
        tuple(found)
        if not node or found[0] == "text" or tags[node] in INLINE
        else (*found, f"chars:{min(8, size.bit_length())}", f"links:{4 * linked // size if size else 'none'}")
        for node, (found, size, linked) in enumerate(zip(names, texts, links, strict=True))
    ]
    return Page(parent, features, label, events, unseen)


def _close_implied(tag: str, opened: dict[str, list[int]], blocks: list[int], close: Callable[[int], None]) -> None:
    """Ends that a start tag implies: of a paragraph, or of the item before."""

    def innermost(names: tuple[str, ...]) -> int:
        return max((opened[name][-1] for name in names if opened[name]), default=0)

    paragraph = innermost(("p",))
    if paragraph and paragraph == blocks[-1]:
        close(paragraph)
    if tag in CLOSES_ITSELF:
        before = innermost(ALIKE.get(tag, (tag,)))
        if before > innermost(CLOSES_ITSELF[tag]):
            close(before)


OUTER, MAIN, REST = 0, 1, 2
STATES = (OUTER, MAIN, REST)


class TreeModel(NamedTuple):
    """Log evidence of a feature for each state, and the potentials of (parent, child) states.

    An element holds main text, or the rest, or is outside of both and holds
    some of each; the root is outside.
    """

    evidence: dict[str, tuple[float, float, float]]
    child: tuple[tuple[float, float, float], ...]

    def marginals(self, page: Page) -> list[float]:
        """Probability of each node of being main text, by sum-product over the tree."""
        get, none = self.evidence.get, (0.0, 0.0, 0.0)
        (p00, p01, p02), (p10, p11, p12), (p20, p21, p22) = self.child
        exp, log = math.exp, math.log
        n = len(page.parent)
        # Upward: what a node and all below it say of its state, and the message to its parent.
        up0, up1, up2 = [0.0] * n, [-40.0 if k == 0 else 0.0 for k in range(n)], [-40.0 if k == 0 else 0.0 for k in range(n)]
        for node, found in enumerate(page.features):
            for feature in found:
                e0, e1, e2 = get(feature, none)
                up0[node] += e0
                up1[node] += e1
                up2[node] += e2
        message = [none] * n
        for node in range(n - 1, 0, -1):
            most = max(up0[node], up1[node], up2[node])
            x0, x1, x2 = exp(up0[node] - most), exp(up1[node] - most), exp(up2[node] - most)
            m0, m1, m2 = (
                log(p00 * x0 + p01 * x1 + p02 * x2), log(p10 * x0 + p11 * x1 + p12 * x2), log(p20 * x0 + p21 * x1 + p22 * x2)
            )
            message[node] = (m0, m1, m2)
            parent = page.parent[node]
            up0[parent] += m0
            up1[parent] += m1
            up2[parent] += m2
        # Downward: what the rest of the page says of the parent's state, without this node.
        found = [0.0] * n
        for node in range(n):
            if node:
                parent, (m0, m1, m2) = page.parent[node], message[node]
                y0, y1, y2 = up0[parent] - m0, up1[parent] - m1, up2[parent] - m2
                most = max(y0, y1, y2)
                y0, y1, y2 = exp(y0 - most), exp(y1 - most), exp(y2 - most)
                up0[node] += log(p00 * y0 + p10 * y1 + p20 * y2)
                up1[node] += log(p01 * y0 + p11 * y1 + p21 * y2)
                up2[node] += log(p02 * y0 + p12 * y1 + p22 * y2)
            most = max(up0[node], up1[node], up2[node])
            one = exp(up1[node] - most)
            found[node] = one / (exp(up0[node] - most) + one + exp(up2[node] - most))
        return found


def states(page: Page) -> list[int]:
    """The labelled states: an element takes its own label, else its parent's; the root is outside."""
    found = [OUTER] * len(page.parent)
    for node, label in enumerate(page.label):
        found[node] = {"main": MAIN, "rest": REST}.get(label or "", found[page.parent[node]] if node else OUTER)
    return found


def fit(pages: list[str], smoothing: float = SMOOTHING) -> TreeModel:
    """Count features and parent-child states on labelled pages; what is never shown does not count."""
    seen = [Counter() for _ in STATES]
    nodes = [0] * len(STATES)
    pairs = [[smoothing] * len(STATES) for _ in STATES]
    for page in map(parse, pages):
        state = states(page)
        for node, parent in enumerate(page.parent):
            if page.unseen[node]:
                continue
            seen[state[node]].update(page.features[node])
            nodes[state[node]] += 1
            if node:
                pairs[state[parent]][state[node]] += 1
    evidence = {
        f: tuple(math.log((seen[s][f] + smoothing) / (nodes[s] + 2 * smoothing)) for s in STATES)
        for f in set().union(*seen)
    }
    return TreeModel(evidence, tuple(tuple(x / sum(row) for x in row) for row in pairs))


def main_text(page: str | None, model: TreeModel) -> str:
    """The texts that are main text more likely than not: a line per block, white space as one space."""
    if not page:
        return ""
    parsed = parse(page)
    marginal = model.marginals(parsed)
    blocks, parts = [], []
    for event in [*parsed.events, None]:
        if event is None:
            if block := " ".join("".join(parts).split()):
                blocks.append(block)
            parts = []
        elif event[0] < 0 or marginal[event[0]] >= 0.5:
            parts.append(event[1])
    return "\n".join(blocks)


@functools.cache
def default_model() -> TreeModel:
    """Trained on the labelled pages of this package; the same in every process."""
    return fit(labelled_pages())


def extract(pages: DataFrame, model: TreeModel | None = None, keep: tuple[str, ...] = ("page_id", "url"), html_column: str = "html") -> DataFrame:
    """The columns in ``keep``, and ``text``: the main text of the whole page, empty if it has none.

    Null and empty pages have no text. Rows with equal ids are extracted each;
    other columns are not read. Memory follows the largest page.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(page, shared.value) for page in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(texts, pa.string())], names=[*part.schema.names[1:], "text"]
                )

    rows = pages.select(F.col(html_column).alias("_html"), *[F.col(c) for c in keep])
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, fields + "text string")
