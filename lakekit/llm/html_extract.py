"""Main text of web pages by boosted trees over the nodes of the page.

A page is parsed into elements and blocks; a block is a run of text with inline markup
between block-level tags. Every node has features of its own and of its subtree: text and
link density, marks, depth, place among its siblings, and tokens of its tag and attributes.
Gradient-boosted trees (Spark ML) give the log-odds that a node holds main text.

Decoding chooses a label for every node so that the sum of the log-odds is greatest and no
node is kept under one that is dropped: one pass from the leaves up adds the best
choices of the children, one from the root down reads them off.

The trees are trained here, on at most ``TRAINING_PAGES`` pages, taken by a hash of the page. Their
labels come from what the markup of those pages says (an article element, and what in it
or outside is marked as something else). Each page is also used in altered copies: containers
renamed or without marks, and blocks of boilerplate put into the article, so that
the trees learn to go by density and place where marks are missing.
"""

from __future__ import annotations

import html
import random
import re
import string
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.encoding import slices, small_batches
from lakekit.session import stage

TRAINING_PAGES = 300
ALTERED_COPIES = 3
TREES, DEPTH, STEP = 16, 4, 0.3
MOST_LOG_ODDS = 4.0
# Characters of pages that are labelled together; a longer page on its own.
HELD_LETTERS = 500_000

# How elements nest, and what their names and tokens say.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSHOWN = frozenset(
    "head script style title template noscript iframe noembed noframes xmp svg math object "
    "canvas audio video select option button textarea datalist".split()
)
BLOCK = frozenset(
    "html body head address article aside blockquote center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul caption legend".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"},
}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}
MAIN_TAGS = frozenset(("article", "main"))
OTHER_TAGS = frozenset("nav aside footer form menu dialog".split())
MAIN_TOKENS = frozenset("article main content post entry story body text".split())
OTHER_TOKENS = (
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer copyright legal "
    "sidebar aside widget ad ads advert advertisement adverts sponsor sponsored promo banner "
    "cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login "
    "search form share social related recommended more trending tags pagination pager "
    "comment comments reply replies respond disqus"
).split()

# A quote opens a value only after an equals sign, and one without a partner is a character
# like any other. No part gives back what it took, so a page is read in one go.
_VALUE = r"""\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+"""
_OTHERS = r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(?=/?[a-zA-Z])"
TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE})?+)*+)>|{_OTHERS}", re.S)
# After a tag that quotes keep open to the end of the page, tags end at the next bracket.
TAG_WITHOUT_QUOTES = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|{_OTHERS}", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?+""")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for tag in RAW}
LONG_NUMBER = re.compile(r"&#0*+(\d{8,})?;?")
TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")

GROUPS = {
    "paragraph": {"p", "blockquote", "pre"},
    "heading": {"h1", "h2", "h3", "h4", "h5", "h6"},
    "list": {"ul", "ol", "li", "dl", "dd", "dt", "menu"},
    "table": {"table", "tr", "td", "th", "tbody", "thead"},
    "plain": {"div", "section", "body", "html"},
    "main": MAIN_TAGS,
    "other": OTHER_TAGS,
    "header": {"header"},
}
SHOWN = [
    "block", "depth", "letters", "page_share", "link_share", "links", "elements_per_letter", "words_per_block",
    "blocks", "marks", "stops", "capitals", "digits", "place", "siblings", "sibling_place", "like_siblings",
    "parent_share", "paragraphs", "main_token", "other_token", "above_main", "above_other", "below_main",
    "above_main_tag", "above_other_tag", "before_h1", "parent_link_share",
]
FEATURES = SHOWN + [f"tag_{name}" for name in GROUPS]


# What a node's tag and tokens say, as bits.
MAIN_TOKEN, OTHER_TOKEN, MAIN_TAG, OTHER_TAG = 1, 2, 4, 8


class Node:
    """An element, or with ``text`` a block of its parent. ``says`` is of its own tag and tokens,
    ``above_says`` of those over it."""

    __slots__ = ("above", "above_says", "below", "boiler", "depth", "links", "main", "parts", "says", "tag", "text")

    def __init__(self, tag: str, above: Node | None, says=0, main=False, boiler=False):
        self.tag, self.above, self.says = tag, above, says
        self.below: list[Node] = []
        self.text: str | None = None
        self.parts: list[str] = []
        self.links = 0
        self.main, self.boiler = main, boiler
        self.depth = above.depth + 1 if above is not None else 0
        self.above_says = above.above_says | above.says if above is not None else 0


def unescaped(raw: str) -> str:
    try:
        return html.unescape(raw)
    except ValueError:
        # A number of thousands of digits; no character has more than seven.
        return html.unescape(LONG_NUMBER.sub(lambda m: "\ufffd" if m[1] else m[0].replace("0" * 9, ""), raw))


class _Open:
    """The open elements of a page: a stack of block-level ones, and the inline ones in the
    last of these. Every step takes time for what it opens or closes only."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.inline: list[str] = []
        self.at: dict[str, list[int]] = {}
        self.inline_counts: Counter = Counter()
        self.hidden = 0

    def last(self, tags) -> int:
        """The place of the innermost block-level element with one of the tags, or 0."""
        found = [places[-1] for places in map(self.at.get, tags) if places]
        return max(found) if found else 0

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)
        self.hidden += node.tag in UNSHOWN

    def pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            tag = self.stack.pop().tag
            self.at[tag].pop()
            self.hidden -= tag in UNSHOWN
        self.leave_inline()

    def push_inline(self, tag: str) -> None:
        self.inline.append(tag)
        self.inline_counts[tag] += 1
        self.hidden += tag in UNSHOWN

    def pop_inline(self) -> str:
        tag = self.inline.pop()
        self.inline_counts[tag] -= 1
        self.hidden -= tag in UNSHOWN
        return tag

    def leave_inline(self) -> None:
        while self.inline:
            self.pop_inline()


def parse(page: str) -> Node:
    """The tree of a page, in time linear in its length. Broken markup gives a tree as well: what
    is not closed ends with its parent, an end without a beginning is passed over, and a
    tag that never ends is text."""
    root = Node("html", None)
    open_ = _Open(root)
    block: Node | None = None
    at, tags = 0, TAG

    def flush() -> None:
        nonlocal block
        if block is not None:
            text = " ".join("".join(block.parts).split())
            if text:
                block.text, block.parts = text, []
                block.above.below.append(block)
            block = None

    def add(raw: str) -> None:
        nonlocal block
        if not raw or open_.hidden:
            return
        if block is None:
            block = Node("#text", open_.stack[-1])
        text = unescaped(raw)
        block.parts.append(text)
        if open_.inline_counts["a"]:
            block.links += len(text.strip())

    while at < len(page):
        found = tags.search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            if found[0] == "<":
                at = found.start()
                if page.find(">", at) < 0:
                    add(page[at:])
                    break
                tags = TAG_WITHOUT_QUOTES
            continue
        tag = found[2].lower()
        if found[1]:
            if tag in BLOCK:
                place = open_.last((tag,))
                if place:
                    flush()
                    open_.pop_to(place)
                elif tag == "p":
                    flush()
            elif open_.inline_counts[tag]:
                while open_.pop_inline() != tag:
                    pass
            continue
        if tag == "br":
            add(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in RAW:
            # A raw element's text ends at its own end tag, whatever it holds.
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in BLOCK:
            if tag == "html":
                continue
            flush()
            # A head ends where the body begins, said or not; a paragraph before any block.
            place = open_.last(("p",)) or open_.last(("head",))
            if place:
                open_.pop_to(place)
            shut, scope = CLOSES.get(tag, ()), SCOPES.get(tag, ("table",))
            while (place := open_.last(shut)) > open_.last(scope):
                open_.pop_to(place)
            says, main, boiler = _said(tag, found[3])
            node = Node(tag, open_.stack[-1], says, main, boiler)
            open_.stack[-1].below.append(node)
            open_.leave_inline()
            open_.push(node)
        elif not found[3].rstrip().endswith("/"):
            open_.push_inline(tag)
    flush()
    return root


def _said(tag: str, attributes: str) -> tuple[int, bool, bool]:
    """What tag and tokens say, and whether a copy was marked for training."""
    says = (tag in MAIN_TAGS) * MAIN_TAG | (tag in OTHER_TAGS) * OTHER_TAG
    if "=" not in attributes:
        return says, False, False
    names, marks = _tokens_of_short(attributes) if len(attributes) <= 200 else _tokens(attributes)
    says |= (not names.isdisjoint(MAIN_TOKENS)) * MAIN_TOKEN | (not names.isdisjoint(_OTHER)) * OTHER_TOKEN
    return says, "data-main" in marks, "data-other" in marks


def _tokens(attributes: str) -> tuple[frozenset[str], frozenset[str]]:
    """Words of class, id, role and the like, and the names of data marks."""
    if not attributes or "=" not in attributes:
        return frozenset(), frozenset()
    names, marks = set(), set()
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            names.update(t.lower() for t in TOKEN.findall(value))
        elif name in ("data-main", "data-other"):
            marks.add(name)
    return frozenset(names), frozenset(marks)


_tokens_of_short = lru_cache(maxsize=20_000)(_tokens)
_OTHER = frozenset(OTHER_TOKENS)
_ASCII = bytes(range(128))
_CAPITALS, _DIGITS = string.ascii_uppercase.encode(), string.digits.encode()


def _capitals_and_digits(text: str) -> tuple[int, int]:
    """How many characters of the whole text are capitals, and digits."""
    raw = text.encode("utf-8", "surrogatepass")
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    digits = len(raw) - len(raw.translate(None, _DIGITS))
    if not text.isascii():
        rest = raw.translate(None, _ASCII).decode("utf-8", "surrogatepass")
        capitals += sum(map(str.isupper, rest))
        digits += sum(map(str.isdigit, rest))
    return capitals, digits


GROUP_BITS = {
    tag: sum(1 << k for k, group in enumerate(GROUPS.values()) if tag in group) for group in GROUPS.values() for tag in group
}


def describe(*roots: Node) -> tuple[list[Node], list[int], np.ndarray]:
    """Nodes of some pages in page order, the place of each one's parent (-1 for a page's
    first), and their features. All pages share the array work."""
    nodes: list[Node] = []
    above: list[int] = []
    firsts, first_h1 = [], []
    for root in roots:
        firsts.append(len(nodes))
        first_h1.append(-1)
        waiting = [(root, -1)]
        while waiting:
            node, parent = waiting.pop()
            at = len(nodes)
            nodes.append(node)
            above.append(parent)
            if node.tag == "h1" and first_h1[-1] < 0:
                first_h1[-1] = at
            waiting += [(child, at) for child in reversed(node.below)]
    n = len(nodes)
    features = np.zeros((n, len(FEATURES)))
    if not n:
        return nodes, above, features
    ends = list(range(1, n + 1))
    for i in range(n - 1, 0, -1):
        if above[i] >= 0 and ends[i] > ends[above[i]]:
            ends[above[i]] = ends[i]
    # Own counts: letters, link letters, blocks, elements, marks, stops, capitals, digits, words,
    # paragraphs, tags and tokens of main text.
    own = np.zeros((n, 11))
    for i, node in enumerate(nodes):
        t = node.text
        if t is not None:
            letters = len(t)
            own[i] = (
                letters, min(node.links, letters), 1, 0,
                sum(map(t.count, "|#*$%&<>»·©")), sum(map(t.count, ".!?,;")),
                *_capitals_and_digits(t), t.count(" ") + 1, 0, 0,
            )
    text = own[:, 2] > 0
    tag_of = [node.above.tag if node.text is not None else node.tag for node in nodes]
    says = np.array([node.says for node in nodes])
    over = np.array([node.above_says for node in nodes])
    own[:, 3] = ~text
    own[:, 9] = [node.tag == "p" for node in nodes]
    own[:, 10] = (says & (MAIN_TAG | MAIN_TOKEN)) > 0
    # Whole numbers, so sums over subtrees are exact differences of running sums.
    running = np.concatenate([np.zeros((1, own.shape[1])), np.cumsum(own, axis=0)])
    sums = running[ends] - running[:-1]
    letters, links, blocks, elements, marks, stops, capitals, digits, words, paragraphs, mains = sums.T
    above_at = np.array(above)
    child = above_at >= 0
    parent_at = np.where(child, above_at, np.arange(n))
    page = np.repeat(np.array(firsts), np.diff([*firsts, n]))
    total, size = np.maximum(letters[page], 1.0), np.maximum(letters, 1.0)
    parent = size[parent_at]
    columns = {
        "block": text,
        "depth": [node.depth for node in nodes],
        "letters": np.log1p(letters),
        "page_share": letters / total,
        "link_share": links / size,
        "links": np.log1p(links),
        "elements_per_letter": elements / (size / 100 + 1),
        "words_per_block": words / np.maximum(blocks, 1),
        "blocks": np.log1p(blocks),
        "marks": marks / size,
        "stops": stops / size,
        "capitals": capitals / size,
        "digits": digits / size,
        "place": (running[:-1, 0] - running[page, 0]) / total,
        "parent_share": letters / np.where(child, parent, total),
        "paragraphs": np.log1p(paragraphs),
        "main_token": says & MAIN_TOKEN > 0,
        "other_token": says & OTHER_TOKEN > 0,
        "above_main": over & MAIN_TOKEN > 0,
        "above_other": over & OTHER_TOKEN > 0,
        "below_main": mains - own[:, 10] > 0,
        "above_main_tag": over & MAIN_TAG > 0,
        "above_other_tag": over & OTHER_TAG > 0,
        "before_h1": np.arange(n) < np.repeat(np.array(first_h1), np.diff([*firsts, n])),
        "parent_link_share": np.where(child, links[parent_at] / parent, 0),
    }
    # Siblings: rows with one parent, in page order.
    rows = np.flatnonzero(child)
    rows = rows[np.argsort(above_at[rows], kind="stable")]
    numbers: dict[str, int] = {}
    tags = np.array([numbers.setdefault(node.tag, len(numbers)) for node in nodes])
    _, starts, times = np.unique(above_at[rows], return_index=True, return_counts=True)
    alike = np.unique(above_at[rows] * len(numbers) + tags[rows], return_inverse=True, return_counts=True)
    count = np.repeat(times, times)
    for name, values in (
        ("siblings", np.log1p(count)),
        ("sibling_place", (np.arange(len(rows)) - np.repeat(starts, times)) / count),
        ("like_siblings", alike[2][alike[1]] / count),
    ):
        columns[name] = np.zeros(n)
        columns[name][rows] = values
    for k, name in enumerate(SHOWN):
        features[:, k] = columns[name]
    bits = np.array([GROUP_BITS.get(tag, 0) for tag in tag_of])
    features[:, len(SHOWN) :] = bits[:, None] >> np.arange(len(GROUPS)) & 1
    return nodes, above, features


def taught(nodes: list[Node], above: list[int]) -> np.ndarray:
    """1 for nodes that hold main text, as the markup says: blocks inside an article, and not
    inside anything marked as something else; and what stands above these."""
    n = len(nodes)
    inside, other = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    label = np.zeros(n)
    for i, node in enumerate(nodes):
        p = above[i]
        inside[i] = (p >= 0 and inside[p]) or node.main or node.says & MAIN_TAG
        says = node.says & (OTHER_TAG | OTHER_TOKEN) or (node.tag == "header" and not inside[i])
        other[i] = (p >= 0 and other[p]) or node.boiler or (says and not node.main and not node.says & MAIN_TAG)
        label[i] = node.text is not None and inside[i] and not other[i]
    for i in range(n - 1, 0, -1):
        label[above[i]] = max(label[above[i]], label[i])
    return label


def decode(above: list[int], log_odds: np.ndarray) -> np.ndarray:
    """The best labels without a kept node below a dropped one."""
    n = len(above)
    keep = np.asarray(log_odds, dtype=float).tolist()
    drop = [-x for x in keep]
    for i in range(n - 1, 0, -1):
        p = above[i]
        if p >= 0:
            keep[p] += max(keep[i], drop[i])
            drop[p] += drop[i]
    kept = [False] * n
    for i, p in enumerate(above):
        kept[i] = keep[i] > drop[i] and (p < 0 or kept[p])
    return np.array(kept, dtype=bool)


# --- training -------------------------------------------------------------------


def altered(page: str, seed: int) -> str:
    """A copy of a page under other names, with blocks that do not belong to the article."""
    draw = random.Random(seed)
    main = draw.choice(["article", "main", 'div class="content"', 'div class="post-body"', "section", "div"])
    page = re.sub(r"<(?:article|main)\b[^>]*>", f"<{main} data-main='1'>", page)
    page = re.sub(r"</(?:article|main)>", f"</{main.split()[0]}>", page)
    if draw.random() < 0.5:
        # Marks outside are gone as well; what they marked is still known here.
        page = re.sub(r"<(nav|footer|aside)\b[^>]*>", "<div data-other='1'>", page)
        page = re.sub(r"</(nav|footer|aside)>", "</div>", page)
    sentences = re.findall(r"[^<>.]{15,200}\.", re.sub(r"<(script|style).*?</\1>", "", page, flags=re.S)) or ["More."]
    for _ in range(draw.randint(1, 4)):
        token = draw.choice(OTHER_TOKENS)
        tag = draw.choice(["div", "div", "section", "aside", "ul", "form", "footer", "header"])
        piece = "li" if tag == "ul" else draw.choice(["p", "span", "p", "label"])
        linked = draw.random() < 0.4
        texts = [draw.choice(sentences) for _ in range(draw.randint(1, 5))]
        if linked:
            texts = [f"<a href='/x'>{t[:40]}</a>" for t in texts]
        inner = "".join(f"<{piece}>{t}</{piece}>" for t in texts)
        mark = draw.choice([f'class="{token}"', f'id="{token}"', f'class="box {token}-list"'])
        block = f"<{tag} {mark} data-other='1'>{inner}</{tag}>"
        gaps = [m.end() for m in re.finditer(r"</p>|</h1>|<body[^>]*>|</nav>|</article>|</main>", page)]
        at = draw.choice(gaps) if gaps else len(page)
        page = page[:at] + block + page[at:]
    return page


def training_rows(pages: DataFrame, most: int = TRAINING_PAGES, copies: int = ALTERED_COPIES) -> DataFrame:
    """``label, features`` of the nodes of at most ``most`` pages and their altered copies."""
    chosen = pages.select("page_id", "html").filter("html IS NOT NULL")
    chosen = chosen.orderBy(F.xxhash64("page_id", "html"), "page_id").limit(most)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, features = [], []
            for page in batch.column("html").to_pylist():
                for k in range(copies + 1):
                    nodes, above, x = describe(parse(altered(page, k + len(page)) if k else page))
                    labels += taught(nodes, above).tolist()
                    features += x.tolist()
            yield pa.RecordBatch.from_pydict(
                {"label": pa.array(labels, pa.float64()), "x": pa.array(features, pa.list_(pa.float64()))}
            )

    found = chosen.repartition(8).mapInArrow(rows, "label double, x array<double>")
    return found.select("label", array_to_vector("x").alias("features"))


class Trees:
    """Boosted trees as arrays."""

    def __init__(self, texts: list[str], weights: list[float]):
        self._trees = [_read_tree(text) for text in texts]
        self._weights = weights

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        flat, base = x.ravel(), np.arange(len(x)) * x.shape[1]
        for (feature, limit, left, right, value), weight in zip(self._trees, self._weights, strict=True):
            # A leaf leads to itself.
            leaf = feature < 0
            ways = np.column_stack([left, right])
            ways[leaf] = np.flatnonzero(leaf)[:, None]
            ways, column = ways.ravel(), np.where(leaf, 0, feature).astype(np.int64)
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = ways[2 * at + (flat[base + column[at]] > limit[at])]
            total += weight * value[at]
        return np.clip(2 * total, -MOST_LOG_ODDS, MOST_LOG_ODDS)


_IF = re.compile(r"^\s*If \(feature (\d+) <= (\S+)\)")
_PREDICT = re.compile(r"^\s*Predict: (\S+)")


def _read_tree(text: str) -> tuple[np.ndarray, ...]:
    """A tree from Spark's description: conditions, then what holds if they do, or else."""
    lines = [line for line in text.splitlines() if _IF.match(line) or _PREDICT.match(line)]
    rows: list[list[float]] = []

    def read(at: int) -> int:
        own = len(rows)
        found = _IF.match(lines[at])
        if found is None:
            rows.append([-1, 0.0, 0, 0, float(_PREDICT.match(lines[at])[1])])
            return at + 1
        rows.append([int(found[1]), float(found[2]), len(rows) + 1, 0, 0.0])
        at = read(at + 1)
        rows[own][3] = len(rows)
        return read(at)

    read(0)
    feature, limit, left, right, value = zip(*rows, strict=True)
    return (*(np.array(c) for c in (feature, limit)), *(np.array(c, dtype=np.int64) for c in (left, right)), np.array(value))


def train(pages: DataFrame, most: int = TRAINING_PAGES) -> Trees:
    """The model for these pages; without a page with both kinds of node, one that goes
    by what the markup says."""
    rows = stage(training_rows(pages, most), "page_nodes")
    kinds = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(kinds) < 2:
        # Kept below a main element unless something else is said on the way.
        inside, other = FEATURES.index("above_main_tag"), FEATURES.index("above_other")
        text = f"If (feature {other} <= 0.5)\nIf (feature {inside} <= 0.5)\nPredict: 0.1\nPredict: 1.0\nPredict: -1.0"
        return Trees([text], [1.0])
    learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7)
    model = learner.fit(rows)
    return Trees([t.toDebugString for t in model.trees], list(model.treeWeights))


# --- extraction -------------------------------------------------------------------


def extract_pages(pages: Iterable[str], trees: Trees) -> list[str]:
    """The main text of each page. Pages are described and labelled some thousand nodes at a time."""
    texts: list[str] = []
    held: list[Node] = []
    length = 0
    for page in pages:
        held.append(parse(page))
        length += len(page)
        if length >= HELD_LETTERS:
            texts += _labelled(held, trees)
            held, length = [], 0
    return texts + _labelled(held, trees)


def _labelled(roots: list[Node], trees: Trees) -> list[str]:
    nodes, above, x = describe(*roots)
    kept = decode(above, trees.log_odds(x))
    texts: list[list[str]] = []
    for node, parent, k in zip(nodes, above, kept, strict=True):
        if parent < 0:
            texts.append([])
        if k and node.text is not None:
            texts[-1].append(node.text)
    return ["\n".join(t) for t in texts]


def extract(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; ``trees`` are trained on the pages if not
    given. A null or empty page has an empty text; repeated rows are extracted alike; other
    columns are ignored. Pages are parsed whole, and no text is cut."""
    trees = train(pages) if trees is None else trees
    small_batches(pages.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "html")):
            texts = extract_pages((page or "" for page in batch.column("html").to_pylist()), trees)
            text = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), text, pc.utf8_length(text).cast(pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return narrow.mapInArrow(rows, "page_id long, url string, text string, n_chars long")
