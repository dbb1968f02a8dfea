"""Main text of web pages: blocks labelled by a minimum cut."""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Elements by role. Everything that is neither block nor skipped is inline markup.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
SKIPPED = "script|style|noscript|template|textarea|svg|iframe|object|canvas|select|button|head"
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT = frozenset("article main".split())
#: Words of class, id and role attributes that speak against and for content.
AGAINST = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs byline-links comment comments complementary consent contentinfo cookie "
    "cookies copyright disclaimer disqus feedback footer gdpr header legal login masthead menu modal nav navbar navigation newsletter "
    "notice notices overlay pager pagination popup privacy promo promoted promotion recommended recommendations related replies reply "
    "respond share sharing sidebar signup skip social sponsor sponsored subscribe tags teaser toolbar topbar tracking widget widgets".split()
)
FOR = frozenset("article articlebody body-text content entry main post story text".split())

#: First words of a class that says what a page has or is, not what the element holds (`has-sidebar`).
STATES = frozenset("has no with without is not single".split())
#: Elements that hold the page or the article whatever their classes say.
FRAMES = frozenset("html body article main".split())

TOKEN = re.compile(
    rf"<!--(?:.*?-->|.*\Z)|<({SKIPPED})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>(?:.*?</\1\s*>|.*\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[/!?]?[a-zA-Z\[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
UNIT = 100  # capacities are whole numbers of 1 / UNIT


def named_bias(attributes: str) -> float:
    """What the class, id and role words of an element say.

    The last part of a name tells what it is (`post-comments` are comments): such a word, or a whole name, counts in
    full. A word before it only hints (`comments-open`), and a name that tells a state says nothing.
    """
    full, hints = set(), set()
    for m in NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = re.split(r"[_-]+", name.strip("_-"))
            if len(parts) == 1 or parts[0] not in STATES:
                full.update((name, parts[-1]))
                hints.update(parts)
    return -6.0 if full & AGAINST else 3.0 if hints & FOR else -3.0 if hints & AGAINST else 0.0


class Box:
    """An open element."""

    __slots__ = ("bias", "depth", "inside", "link", "parent", "tag")

    def __init__(self, tag: str, parent: Box | None, attributes: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.inside = tag in CONTENT or (parent is not None and parent.inside)
        self.link = tag == "a" or (parent is not None and parent.link)
        bias = -6.0 if tag in BOILERPLATE or (tag == "header" and not self.inside) else 3.0 if tag in CONTENT else 0.0
        if tag not in FRAMES and bias == 0.0 and "=" in attributes:
            bias = named_bias(attributes)
        above = parent.bias if parent else 0.0
        self.bias = min(above, bias) if min(above, bias) < 0 else max(above, bias)


class Block:
    __slots__ = ("box", "linked", "text")

    def __init__(self, text: str, linked: int, box: Box):
        self.text, self.linked, self.box = text, linked, box


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order; character references decoded, white space in a block made one space."""
    box, out, pieces, linked, at = Box("html", None, ""), [], [], 0, 0

    def close() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, linked, home))
        pieces, linked = [], 0

    home = box  # the block element that the current pieces stand in
    for m in TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            pieces.append(piece)
            if box.link:
                linked += len(piece)
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            close()
        elif tag == "br":
            pieces.append(" ")
        if m[2]:
            found = box
            while found is not None and found.tag != tag:
                found = found.parent
            if found is not None and found.parent is not None:
                box = found.parent
        elif tag not in VOID and not m[4].endswith("/"):
            if tag in BLOCKS:
                while box.tag not in BLOCKS and box.parent is not None:  # inline markup ends with its block
                    box = box.parent
                if box.tag == "p" or (box.tag == tag and tag in SELF_CLOSING):
                    box = box.parent
            if tag in BLOCKS or tag == "a":
                box = Box(tag, box, m[4])
        home = box if box.tag in BLOCKS or box.parent is None else box.parent
    pieces.append(page[at:])
    close()
    return out


def evidence(block: Block) -> float:
    """Log odds of being content, from the block alone."""
    text, n = block.text, len(block.text)
    score = block.box.bias + max(-1.0, min(2.0, 1.5 * math.log10(n / 40)))
    score -= 4.0 * min(1.0, block.linked / n)
    if text[-1] in ".!?:…。\"'”»":
        score += 0.7
    tag = block.box.tag
    return score + (1.0 if tag == "h1" else 0.3 if tag in ("h2", "h3", "h4", "h5", "h6", "p", "blockquote", "pre") else 0.0)


def distance(a: Box, b: Box) -> int:
    """Steps between two elements in the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def minimum_cut(gain: list[int], loss: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Label nodes so that loss of the True ones, gain of the False ones and the cut edges add up to the least.

    Terminal capacities are gain (from the source) and loss (to the sink); shortest augmenting paths by levels.
    """
    n = len(gain)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def connect(u: int, v: int, there: int, back: int) -> None:
        at[u].append(len(to))
        to.append(v)
        room.append(there)
        at[v].append(len(to))
        to.append(u)
        room.append(back)

    for i in range(n):
        direct = min(gain[i], loss[i])  # flows from source to sink through i alone
        if gain[i] > direct:
            connect(source, i, gain[i] - direct, 0)
        if loss[i] > direct:
            connect(i, sink, loss[i] - direct, 0)
    for u, v, w in edges:
        connect(u, v, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in at[u]:
                if room[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(room[e] for e in path)
                cut = 0
                for i, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                for i, e in enumerate(path):
                    if room[e] == 0:
                        cut = i
                        break
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            edges_here = at[u]
            while turn[u] < len(edges_here):
                e = edges_here[turn[u]]
                if room[e] > 0 and level[to[e]] == level[u] + 1:
                    break
                turn[u] += 1
            if turn[u] < len(edges_here):
                path.append(edges_here[turn[u]])
                u = to[edges_here[turn[u]]]
            elif u == source:
                break
            else:
                turn[u] = len(edges_here)
                u = to[path.pop() ^ 1]
                turn[u] += 1


def labels(blocks: list[Block]) -> list[bool]:
    """True for content. Costs are the softplus of the evidence; neighbours and siblings in the tree attract."""
    scores = [evidence(b) for b in blocks]
    gain = [round(UNIT * math.log1p(math.exp(s))) for s in scores]
    loss = [round(UNIT * math.log1p(math.exp(-s))) for s in scores]
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, round(1.5 * UNIT / (1 + distance(blocks[i - 1].box, b.box)))))
        parent = id(b.box.parent)
        if parent in last and last[parent] != i - 1:
            edges.append((last[parent], i, UNIT // 2))
        last[parent] = i
    return minimum_cut(gain, loss, [e for e in edges if e[2] > 0])


def main_text(page: str | None) -> str:
    """The blocks labelled as content, one per line; empty for a null page or one without content."""
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, kept in zip(blocks, labels(blocks)) if kept) if blocks else ""


def extract_text(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html): page_id, url, text and n_chars (code points) of each row, independent of the others.

    Repeated rows give repeated results; null ids and urls pass through.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())
            ], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op4_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
