"""Main text of web pages by a minimum cut between content and boilerplate.

A page becomes a list of text blocks. A classifier with fixed weights gives each block its log-odds of being content,
which become capacities to the terminals; blocks that follow each other and blocks near each other in the document
tree are joined by smoothness edges. The minimum cut labels all blocks of a page at once: a doubtful block goes with its
neighbours unless its own evidence outweighs them. Each page is one row and its own task; pages never meet.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.common import small_batches, whole

#: Weights of the classifier, as log-odds for content.
WEIGHTS = {
    "base": -0.5,  # every block
    "no_main": -0.95,  # the page has no article or main element: a block needs evidence of its own, or neighbours with it
    "main": 3.0,  # inside the article or main element
    "outside_main": -3.0,  # the page has such an element and the block is not in it
    "container": -12.0,  # inside a menu, header, footer, sidebar, form and the like
    "named": -9.0,  # inside an element whose class, id or role names one of these
    "words": 0.08,  # per word, up to 60
    "sentence": 0.7,  # ends like a sentence
    "links": -4.0,  # times the share of characters inside links
    "links_in_main": -2.0,  # the same inside the main element
    "heading": 0.8,  # a heading
}
#: Capacity between siblings that follow each other, its share for each further step in the tree, and between the blocks of
#: one parent element that others stand between. Of the order of the weights, so that clear neighbours decide about a
#: block without clear evidence; two such neighbours together stay below the evidence of an element's name or kind.
ADJACENT, DECAY, RELATED = 1.5, 0.2, 0.5

# Element names by their role in a page.
HIDDEN = frozenset("script style template iframe svg head title textarea select option button audio video".split())
RAW = frozenset("script style textarea title iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("nav footer aside form menu dialog fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "pager pagination popup promo promotion related recommended respond replies reply search share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription teaser toolbar topbar widget widgets alert disclaimer responses".split()
)
#: Elements that an unclosed one of the same kind ends at.
_CLOSES = {name: frozenset({name}) for name in ("li", "option", "tr")} | {"td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "dd": frozenset({"dd", "dt"}), "dt": frozenset({"dd", "dt"})}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)|</?\Z""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: Node | None
    depth: int
    main: bool
    container: bool
    named: bool
    hidden: bool
    block: Node | None = None  # the nearest block element, itself included


@dataclass
class Block:
    node: Node
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _open(tag: str, attributes: str, up: Node) -> Node:
    named = container = False
    role = ""
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "role":
                role = value.strip().lower()
                named |= role in ROLES
            else:
                words = NAMES.intersection(_NAME.findall(_CAMEL.sub(" ", value).lower()))
                # Inside the article a header is its own, as the element is.
                named |= bool(words - {"header"} if up.main else words)
    main = up.main or tag in ("article", "main") or role in ("main", "article")
    if tag in ("html", "body", "article", "main"):
        named = False  # the name tells of the page, not of a part of it
    # A header belongs to the article it stands in; elsewhere it is the page's.
    container = tag in CONTAINERS or (tag == "header" and not up.main)
    node = Node(tag, up, up.depth + 1, main, up.container or container, up.named or named, up.hidden or tag in HIDDEN, up.block)
    if tag in BLOCKS:
        node.block = node
    return node


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in order, with references decoded and white space joined; broken markup is read leniently."""
    node = Node("", None, 0, False, False, False, False)
    node.block = node
    out: list[Block] = []
    now: Block | None = None
    links, at, end = 0, 0, len(page)
    opened: Counter[str] = Counter()  # elements open now, so that a stray end is known without a walk

    def leave() -> None:
        nonlocal node
        opened[node.tag] -= 1
        node = node.parent

    def say(text: str) -> None:
        nonlocal now
        if node.hidden or not text:
            return
        if now is None:
            now = Block(node.block, node.block.tag in HEADINGS)
            out.append(now)
        text = html.unescape(text) if "&" in text else text
        now.parts.append(text)
        if links:
            now.linked += len(text.strip())

    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        closing, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        tag = name.lower()
        if tag in BLOCKS:
            now = None
        if closing:
            if opened[tag]:
                while node.tag != tag:
                    leave()
                leave()
            if tag == "a" and links:
                links -= 1
            continue
        if tag == "br":
            say(" ")
        if tag in VOID:  # a slash at the end closes no other element
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in BLOCKS:
            if node.block.tag == "p":  # a new block ends an open paragraph
                paragraph = node.block
                while node is not paragraph:
                    leave()
                leave()
            if tag in _CLOSES and node.tag in _CLOSES[tag]:
                leave()
        links += tag == "a"
        if tag in BLOCKS:
            links = 0
        node = _open(tag, attributes, node)
        opened[tag] += 1
    for block in out:
        block.text = _SPACE.sub(" ", "".join(block.parts)).strip()
    return [block for block in out if block.text]


def log_odds(block: Block, has_main: bool) -> float:
    node, text = block.node, block.text
    total = WEIGHTS["base"] + WEIGHTS["words"] * min(60, text.count(" ") + 1)
    total += WEIGHTS["no_main" if not has_main else "main" if node.main else "outside_main"]
    total += WEIGHTS["container"] * node.container + WEIGHTS["named"] * node.named + WEIGHTS["heading"] * block.heading
    total += WEIGHTS["links_in_main" if node.main else "links"] * min(1.0, block.linked / len(text))
    return total + WEIGHTS["sentence"] * (text[-1] in ".!?…\"'”»")


def tree_distance(a: Node, b: Node) -> int:
    """Steps between two elements over their nearest common ancestor."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: neighbours in page order, and the previous block under the same parent element."""
    out = []
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            out.append((i - 1, i, ADJACENT * DECAY ** max(0, tree_distance(blocks[i - 1].node, block.node) - 2)))
        parent = id(block.node.parent)
        if parent in last and last[parent] != i - 1:
            out.append((last[parent], i, RELATED))
        last[parent] = i
    return out


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (true: content) of the least sum of cut capacities; a tie is boilerplate.

    A block whose own evidence outweighs all its edges keeps its label in every minimum cut: such blocks are settled
    first and lend their label to their neighbours. What is left is cut by augmenting along shortest paths.
    """
    own = list(odds)
    around: list[dict[int, float]] = [{} for _ in odds]
    for i, j, weight in edges:
        around[i][j] = around[i].get(j, 0.0) + weight
        around[j][i] = around[j].get(i, 0.0) + weight
    label: list[bool | None] = [None] * len(odds)
    waiting = deque(range(len(odds)))
    while waiting:
        i = waiting.popleft()
        if label[i] is None and abs(own[i]) >= sum(around[i].values()):
            label[i] = own[i] > 0
            for j, weight in around[i].items():
                own[j] += weight if label[i] else -weight
                del around[j][i]
                waiting.append(j)
            around[i] = {}
    rest = [i for i, known in enumerate(label) if known is None]
    if rest:
        content = _max_flow(rest, own, around)
        for i in rest:
            label[i] = i in content
    return [bool(x) for x in label]


def _max_flow(rest: list[int], own: list[float], around: list[dict[int, float]]) -> set[int]:
    """Nodes that residual paths still reach from the content terminal once the flow is largest."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {source: {}, sink: {}} | {i: dict(around[i]) for i in rest}
    for i in rest:
        tail, head = (source, i) if own[i] > 0 else (i, sink)
        room[tail][head] = abs(own[i])
        room[head].setdefault(tail, 0.0)
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for y, left in room[x].items():
                if left > 1e-9 and y not in level:
                    level[y] = level[x] + 1
                    queue.append(y)
        if sink not in level:
            return {x for x in level if x >= 0}
        arcs = {x: iter(list(room[x])) for x in level}
        path = [source]
        while path:
            x = path[-1]
            if x == sink:
                flow = min(room[a][b] for a, b in zip(path, path[1:], strict=False))
                for a, b in zip(path, path[1:], strict=False):
                    room[a][b] -= flow
                    room[b][a] = room[b].get(a, 0.0) + flow
                path = path[: next(k for k, (a, b) in enumerate(zip(path, path[1:], strict=False)) if room[a][b] <= 1e-9) + 1]
                arcs[path[-1]] = iter(list(room[path[-1]]))
                continue
            step = next((y for y in arcs[x] if room[x][y] > 1e-9 and level.get(y, math.inf) == level[x] + 1), None)
            if step is None:
                path.pop()
                level[x] = math.inf
            else:
                path.append(step)


def extract(page: str) -> str:
    """The content blocks of a page, one per line."""
    blocks = blocks_of(page)
    has_main = any(block.node.main for block in blocks)
    content = min_cut([log_odds(block, has_main) for block in blocks], edges_of(blocks))
    return "\n".join([block.text for block, stays in zip(blocks, content, strict=True) if stays])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([extract(page.as_py()) for page in batch.column(2)], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["page_id", "url", "text"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` for every row of ``pages``.

    A null or empty page, and one without content, has the empty text. Rows are independent: null ids and URLs and
    repeated rows stay as they are, other columns are not read.
    """
    small_batches(pages)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), whole(html_col).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    done = rows.mapInArrow(_texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return done.withColumn("n_chars", F.length("text").cast("long"))
