"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page is a tree of block elements with text runs as leaves. Gradient-boosted trees give
each node the log odds that it holds main text, from its tag, attribute tokens, depth,
siblings and the density of its subtree. The decoder picks the set of nodes with the
largest total that holds the parent of each of its nodes, so a run is kept only along with
all that is around it, and a dropped element drops all that is inside it.

No table holds the main text of pages, so the trees are trained on pages laid out by a
small generator of known main text.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.shared import written

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"<>]*"[^>"']*|'[^'<>]*'[^>"']*)*)>""")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTE = re.compile("[>\"']")
_NUMBER = re.compile(r"&#(?:([0-9]+)|[xX]([0-9a-fA-F]+));?")
_ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_LABEL = re.compile(r"""data-main\s*=\s*"(\d)\"""")
_WORD = re.compile(r"[A-Za-z]+")
_SPLIT = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements of plain characters up to their end tag.
RAW = frozenset("script style textarea title".split())
#: Elements that are dropped along with all inside, once their end tag is found.
DROP = frozenset("noscript iframe template select button svg object video audio canvas math".split())
#: Start tags that may stand in a head; any other, and text, ends it.
HEAD = frozenset("base basefont bgsound head link meta noscript script style template title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img input".split())
#: A start tag in the first set closes an open one of the second, up to the third.
CLOSES = {
    **{t: ({"p"}, {"article", "section", "div", "td", "th", "li", "body", "blockquote", "form", "aside", "main", "table"}) for t in "p h1 h2 h3 h4 h5 h6 div ul ol dl table form section article aside header footer nav main blockquote pre figure fieldset address details hr".split()},
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
GROUPS = (
    ("article", "main"),
    ("nav", "menu"),
    ("header",),
    ("footer",),
    ("aside",),
    ("form", "fieldset"),
    ("p", "blockquote", "pre"),
    ("h1", "h2", "h3", "h4", "h5", "h6"),
    ("ul", "ol", "li", "dl", "dt", "dd"),
    ("table", "thead", "tbody", "tr", "td", "th"),
    ("div", "section"),
    ("body", "html"),
)
#: Attribute tokens that sites use for parts of a page.
TOKENS = (
    frozenset("article articlebody content main post entry story text body maincontent prose".split()),
    frozenset("nav navigation menu navbar breadcrumb breadcrumbs topnav toc pagination pager".split()),
    frozenset("header masthead topbar branding hero logo".split()),
    frozenset("footer foot bottom copyright colophon legal".split()),
    frozenset("sidebar side aside rail widget widgets related recommended trending popular more".split()),
    frozenset("ad ads advert adverts advertisement sponsor sponsored promo promotion banner adslot".split()),
    frozenset("notice cookie cookies consent gdpr alert popup modal overlay banner newsletter subscribe paywall toast".split()),
    frozenset("comment comments reply replies disqus discussion respond feedback".split()),
    frozenset("form login search signup register share social toolbar".split()),
)
_GROUP_OF = {t: i for i, g in enumerate(GROUPS) for t in g}
N_FEATURES = 2 * (len(GROUPS) + 1) + 2 * len(TOKENS) + 14


class Node:
    __slots__ = ("chars", "children", "depth", "hits", "label", "links", "parent", "parts", "paragraphs", "tag", "tags", "text", "ways", "words")

    def __init__(self, tag: str, parent: Node | None, hits: tuple[int, ...] = (0,) * len(TOKENS), label: int | None = None):
        self.tag, self.parent, self.hits, self.children = tag, parent, hits, []
        self.depth = parent.depth + 1 if parent else 0
        self.label = label if label is not None else (parent.label if parent else 0)
        self.parts: list[str] = []
        self.links, self.text = 0, ""
        self.ways: dict[str, Node] | None = None  # where the way up from here ended, by start tag
        if parent:
            parent.children.append(self)


_NO_HITS = (0,) * len(TOKENS)


def _hits(attributes: str) -> tuple[int, ...]:
    if "=" not in attributes:
        return _NO_HITS
    found = _ATTR.findall(attributes)
    if not found:
        return _NO_HITS
    tokens = {w.lower() for _, *v in found for x in v for y in _SPLIT.split(x) for w in _WORD.findall(y)}
    return tuple(int(not tokens.isdisjoint(s)) for s in TOKENS)


#: At once after "<!--" one or two dashes less end it.
_COMMENT_END = re.compile(r"(?<=<!--)-?>|--!?>")


class Tags:
    """Finds the tags of a page, each by a scan that goes on where the last one ended.

    A ">" within quotes ends no tag, unless one of the quotes after it is never closed.
    """

    def __init__(self, page: str):
        self.page, self.last, self.open_quote = page, page.rfind(">"), 0

    def after(self, pos: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, "/" or "", name, attributes) of the next one; a comment or declaration has no name."""
        page = self.page
        while 0 <= (start := page.find("<", pos)) < len(page) - 1:
            if page.startswith("<!--", start):
                end = _COMMENT_END.search(page, start + 4)
                return start, end.end() if end else len(page), "", "", ""
            if start > self.last:
                return None
            if start >= self.open_quote and (m := _TAG.match(page, start)):
                return start, m.end(), m[1], m[2].lower(), m[3]
            if m := _NAME.match(page, start):
                end = self.close(m.end()) if start >= self.open_quote else 0
                end = end or page.find(">", m.end()) + 1
                return start, end, m[1], m[2].lower(), page[m.end() : end - 1]
            if page[start + 1] in "!?/":
                return start, page.find(">", start) + 1, "", "", ""
            pos = start + 1
        return None

    def close(self, at: int) -> int:
        """The place after the first ">" outside of quotes; 0 if a quote is never closed."""
        while q := _QUOTE.search(self.page, at):
            if q[0] == ">":
                return q.end()
            at = self.page.find(q[0], q.end()) + 1
            if not at:
                self.open_quote = q.end()
                break
        return 0


def parse(page: str) -> Node:
    """The tree of block elements and text runs ("#text") of a page, however ill-formed.

    Of a head ("#head") and of elements in DROP nothing is kept; one of the latter that is
    never closed is an element like any other. Time follows the page's length.
    """
    root = Node("#root", None)
    at, run, linked = root, None, 0
    drops: list[tuple[Node, Node | None, int]] = []  # opened, with the run and link around them
    opened: Counter[str] = Counter()  # elements that are open, by tag

    def enter(node: Node) -> None:
        nonlocal at
        at = node
        opened[node.tag] += 1

    def leave(up: Node) -> None:
        """Closes all that is open inside up."""
        nonlocal at
        while at is not up:
            opened[at.tag] -= 1
            at = at.parent

    def inner(tag: str) -> Node:
        """The innermost open element of this tag."""
        up = at
        while up.tag != tag:
            up = up.parent
        return up

    def text(s: str) -> None:
        nonlocal run
        if not s:
            return
        if run is None:
            if s.isspace():
                return
            while at.tag == "#head":
                leave(at.parent)
            run = Node("#text", at)
        run.parts.append(s)
        if linked:
            run.links += len(s.strip())

    tags, pos, n = Tags(page), 0, len(page)
    while pos < n:
        found = tags.after(pos)
        if found is None:
            text(page[pos:])
            break
        start, end, closing, tag, attributes = found
        if start > pos:
            text(page[pos:start])
        pos = end
        if not tag:
            continue
        if not closing:
            if tag == "body" and opened["#head"]:  # ends a head around open elements too
                leave(inner("#head"))
            while at.tag == "#head" and tag not in HEAD:
                leave(at.parent)
        if tag in RAW:
            # A slash makes the element empty unless its own end tag is the next one of its name.
            own = not attributes.endswith("/") or (m := re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, pos)) and m[1]
            if not closing and own:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, pos, tags.last + 1)
                pos = stop.end() if stop else n
            continue
        if tag in DROP:
            if closing:
                if opened[tag]:
                    up = inner(tag)
                    while drops[-1][0] is not up:
                        drops.pop()
                    _, run, linked = drops.pop()
                    leave(up.parent)
                    at.children.pop()
            elif not attributes.endswith("/"):
                node = Node(tag, at)
                drops.append((node, run, linked))
                enter(node)
                run, linked = None, 0
            continue
        if tag in INLINE:
            if tag == "a":
                linked = 0 if closing else 1
            elif tag == "br":
                text(" ") if run is not None else None
            continue
        run = None
        if tag in VOID:
            continue
        if tag == "head":
            tag = "#head"
        if closing:
            if opened[tag]:
                leave(inner(tag).parent)
            linked = 0
            continue
        if tag in CLOSES:
            shut, stop = CLOSES[tag]
            if any(opened[t] for t in shut):
                up = at
                while up is not root and up.tag not in shut and up.tag not in stop and up.tag not in DROP:
                    # The way up from a node never changes, so it is gone once.
                    up = up.ways[tag] if up.ways and tag in up.ways else up.parent
                at.ways = (at.ways or {}) | {tag: up}
                if up.tag in shut:
                    leave(up.parent)
        label = _LABEL.search(attributes) if "data-main" in attributes else None
        node = Node(tag, at, _hits(attributes), int(label[1]) if label else None)
        if not attributes.endswith("/"):
            enter(node)
    while at is not root:  # a head that reaches to the end of the page was no head
        if at.tag == "#head":
            at.tag = "head"
        at = at.parent
    return root


def _reference(m: re.Match) -> str:
    """A numeric reference without leading zeros; one beyond all characters stands for a character that is none."""
    digits = (m[1] or m[2]).lstrip("0")
    return "&#xFFFD;" if len(digits) > 7 else f"&#{'' if m[1] else 'x'}{digits or 0};"


def decoded(s: str) -> str:
    """s with its character references decoded."""
    return entities.unescape(_NUMBER.sub(_reference, s) if "&#" in s else s)


def measure(root: Node) -> list[Node]:
    """All nodes, parents first, with sums over their subtrees."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(reversed(node.children))
    for node in order:
        node.chars = node.words = node.tags = node.paragraphs = 0
        if node.tag == "#text":
            node.text = " ".join(decoded("".join(node.parts)).split())
            node.chars = len(node.text)
            node.words = node.text.count(" ") + 1 if node.text else 0
            node.paragraphs = int(node.chars > 80)
    for node in reversed(order):
        if (up := node.parent) is not None:
            up.chars += node.chars
            up.words += node.words
            up.links += node.links
            up.tags += node.tags + (node.tag != "#text")
            up.paragraphs += node.paragraphs
    return order


def node_features(order: list[Node]) -> np.ndarray:
    """One row of N_FEATURES per node."""
    out = np.zeros((len(order), N_FEATURES), dtype=np.float64)
    total = max(1, order[0].chars)
    seen = 0
    base = 2 * (len(GROUPS) + 1)
    above: dict[int, np.ndarray] = {}
    place: dict[int, int] = {}
    for i, node in enumerate(order):
        row = out[i]
        parent = node.parent
        g = _GROUP_OF.get(node.tag, len(GROUPS))
        if node.tag != "#text":
            row[g] = 1
        inherited = above.get(id(parent))
        if inherited is not None:
            row[len(GROUPS) + 1 : base] = inherited[: len(GROUPS) + 1]
            row[base + len(TOKENS) : base + 2 * len(TOKENS)] = inherited[len(GROUPS) + 1 :]
        row[base : base + len(TOKENS)] = node.hits
        own = np.concatenate((row[len(GROUPS) + 1 : base], row[base + len(TOKENS) : base + 2 * len(TOKENS)]))
        if node.tag != "#text":
            own = own.copy()
            own[g] = 1
            own[len(GROUPS) + 1 :] = np.maximum(own[len(GROUPS) + 1 :], node.hits)
            above[id(node)] = own
        k = place.get(id(parent), 0)
        place[id(parent)] = k + 1
        n = len(parent.children) if parent is not None else 1
        up = max(1, parent.chars) if parent is not None else total
        row[base + 2 * len(TOKENS) :] = (
            node.depth, node.tag == "#text", node.chars, node.words, node.chars / (node.tags + 1), node.links / (node.chars + 1),
            node.chars / total, node.chars / up, k, n, k / n, node.paragraphs, seen / total, node.tags,
        )
        if node.tag == "#text":
            seen += node.chars
    return out


def decode(order: list[Node], odds: np.ndarray) -> list[bool]:
    """Whether each node is kept: the best set that holds the parent of each of its nodes."""
    at = {id(n): i for i, n in enumerate(order)}
    up = [at[id(n.parent)] if n.parent is not None else -1 for n in order]
    gain = odds.astype(float).copy()
    for i in range(len(order) - 1, 0, -1):
        if order[i].tag == "#head":
            gain[i] = 0.0
        if gain[i] > 0:
            gain[up[i]] += gain[i]
    kept = [False] * len(order)
    for i in range(len(order)):
        kept[i] = gain[i] > 0 and (i == 0 or kept[up[i]])
    return kept


class Trees:
    """Boosted trees as arrays: a row of features goes left where its value is at most the threshold."""

    def __init__(self, trees: list[dict], weights: list[float]):
        self.trees, self.weights = trees, weights

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        rows = np.arange(len(x))
        for tree, weight in zip(self.trees, self.weights, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(tree["depth"]):
                f = tree["feature"][node]
                left = x[rows, np.maximum(f, 0)] <= tree["threshold"][node]
                node = np.where(f < 0, node, np.where(left, tree["left"][node], tree["right"][node]))
            out += weight * tree["value"][node]
        return 2 * out

    @classmethod
    def of(cls, model) -> Trees:
        """From a fitted GBTClassificationModel, node by node."""
        trees = []
        for member in model.trees:
            flat = {k: [] for k in ("feature", "threshold", "left", "right", "value")}

            def walk(node, flat=flat) -> int:
                i = len(flat["value"])
                inner = node.subtreeDepth() > 0
                flat["value"].append(node.prediction())
                flat["feature"].append(node.split().featureIndex() if inner else -1)
                flat["threshold"].append(node.split().threshold() if inner else 0.0)
                flat["left"].append(i)
                flat["right"].append(i)
                if inner:
                    flat["left"][i] = walk(node.leftChild())
                    flat["right"][i] = walk(node.rightChild())
                return i

            walk(member._java_obj.rootNode())
            trees.append({k: np.array(v) for k, v in flat.items()} | {"depth": member.depth})
        return cls(trees, list(model.treeWeights))


def training_page(rng: random.Random) -> str:
    """A page of made-up words in a random layout; data-main marks what holds main text."""

    def words(a: int, b: int) -> str:
        return " ".join("".join(rng.choice("aeioulnrst bcdmp".replace(" ", "")) for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(a, b)))

    def named(tag: str, names: str, inside: str, main: int = 0) -> str:
        style = rng.random()
        if style < 0.45 and tag != "div":
            return f'<{tag} data-main="{main}">{inside}</{tag}>'
        name = rng.choice(names.split())
        return f'<{"div" if style < 0.8 else "section"} {rng.choice(("class", "id"))}="{rng.choice(("", "site-", "page ", "x1 "))}{name}" data-main="{main}">{inside}</{"div" if style < 0.8 else "section"}>'

    def links(a: int, b: int) -> str:
        items = [f'<a href="/{i}">{words(1, 3)}</a>' for i in range(rng.randint(a, b))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if rng.random() < 0.7 else " | ".join(items)

    def paragraph() -> str:
        kind = rng.random()
        body = words(1, 8) if kind < 0.25 else words(8, 60)
        if rng.random() < 0.2:
            body = f"<b>{body}</b>" if rng.random() < 0.5 else f'{body} <a href="/x">{words(1, 3)}</a> {words(1, 9)}'
        if kind > 0.9:
            return "<ul>" + "".join(f"<li>{words(2, 14)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>"
        if kind > 0.86:
            return f"<blockquote>{body}</blockquote>"
        if kind > 0.83:
            return "<table>" + "".join(f"<tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr>" for _ in range(rng.randint(2, 5))) + "</table>"
        return f"<p>{body}</p>" if rng.random() < 0.9 else f"<p>{body}<br>"

    def aside(main: int = 0) -> str:
        kind = rng.randrange(6)
        if kind == 0:
            return named("aside", "sidebar side-rail widget related recommended", f"<h3>{words(1, 4)}</h3>{links(2, 8)}")
        if kind == 1:
            return named("div", "ad ads advert sponsored promo banner-ad", words(2, 20))
        if kind == 2:
            return named("div", "notice cookie-notice consent alert newsletter popup", f"<p>{words(5, 30)}</p>" + ("<button>ok</button>" if rng.random() < 0.5 else ""))
        if kind == 3:
            return f'<form data-main="0"><label>{words(1, 3)}</label><input name="q">{words(1, 4)}</form>'
        if kind == 4:
            return named("div", "share social toolbar breadcrumb", links(2, 5))
        return named("aside", "sidebar aside more popular", "".join(f"<p>{words(4, 25)}</p>" for _ in range(rng.randint(1, 3))))

    def comments() -> str:
        each = "".join(f'<div class="{rng.choice(("comment", "reply", "comment-body"))}"><p>{words(1, 3)}</p><p>{words(3, 40)}</p></div>' for _ in range(rng.randint(1, 5)))
        return named("section", "comments comment-list discussion disqus replies", f"<h3>{words(1, 3)}</h3>{each}")

    blocks = [paragraph() for _ in range(rng.choice((1, 2, 3, 5, 8, 14)))]
    for _ in range(rng.choice((0, 0, 0, 1, 2))):
        blocks.insert(rng.randint(0, len(blocks)), aside())
    title = f"<h1>{words(2, 12)}</h1>" if rng.random() < 0.85 else ""
    main = named("article", "article content main-content post entry-content story article-body" if rng.random() < 0.8 else "c1 wrap box inner", title + "".join(blocks), 1)
    if rng.random() < 0.35:
        main = named("main", "main wrapper container layout content", main + "".join(aside() for _ in range(rng.choice((0, 1, 2)))))
    before = [named("nav", "nav menu navbar navigation", links(3, 9))]
    if rng.random() < 0.5:
        before.append(named("header", "header masthead topbar", f"<h2>{words(1, 4)}</h2>" + (f"<p>{words(2, 9)}</p>" if rng.random() < 0.5 else "")))
    before += [aside() for _ in range(rng.choice((0, 1, 1, 2)))]
    rng.shuffle(before)
    after = [aside() for _ in range(rng.choice((0, 0, 1, 2)))]
    if rng.random() < 0.45:
        after.insert(0, comments())
    after.append(named("footer", "footer bottom colophon copyright", f"&copy; {words(1, 3)} &middot; {words(2, 18)}" if rng.random() < 0.6 else f"<p>{words(2, 18)}</p>{links(2, 5)}"))
    if rng.random() < 0.1:
        before = []
    return f"<html><head><title>{words(2, 6)}</title></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def training_rows(seed: int) -> tuple[list[int], np.ndarray]:
    """(labels, features) of one training page; a node that holds main text has label 1."""
    order = measure(parse(training_page(random.Random(seed))))
    at = {id(n): i for i, n in enumerate(order)}
    y = [int(n.tag == "#text" and n.label == 1) for n in order]
    for i in range(len(order) - 1, 0, -1):
        if y[i]:
            y[at[id(order[i].parent)]] = 1
    return y, node_features(order)


def train(spark: SparkSession, pages: int = 500, iterations: int = 20, depth: int = 4, seed: int = 7) -> Trees:
    """Trees fitted with Spark ML on the nodes of generated pages."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                y, x = training_rows(i)
                yield pa.RecordBatch.from_arrays([pa.array(y, pa.float64()), pa.array(x.tolist(), pa.list_(pa.float64()))], ["label", "x"])

    nodes = written(spark.range(0, pages, 1, 8).mapInArrow(rows, "label double, x array<double>"), "page-nodes")
    data = nodes.select("label", array_to_vector("x").alias("features"))
    return Trees.of(GBTClassifier(maxIter=iterations, maxDepth=depth, stepSize=0.3, seed=seed, cacheNodeIds=False).fit(data))


def extract(page: str, trees: Trees) -> str:
    """The main text of one page, blocks on lines of their own."""
    order = measure(parse(page))
    kept = decode(order, trees.log_odds(node_features(order)))
    return "\n".join(n.text for n, k in zip(order, kept, strict=True) if k and n.text)


def _extracted(trees) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [measure(parse(x.as_py() or "")) for x in batch.column(2)]
            texts = []
            for a in range(0, len(pages), 200):  # some hundred pages share one pass through the trees
                some = pages[a : a + 200]
                odds = trees.value.log_odds(np.concatenate([node_features(p) for p in some]))
                cut = np.cumsum([0, *map(len, some)])
                for i, order in enumerate(some):
                    kept = decode(order, odds[cut[i] : cut[i + 1]])
                    texts.append("\n".join(n.text for n, k in zip(order, kept, strict=True) if k and n.text))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """One row per row of pages (page_id, url, html): page_id, url, text, n_chars.

    Character references are decoded, white space within a block becomes one space, blocks
    stand in page order, one per line. Null and empty pages, and those without main text,
    give "". Pages are read whole; null or repeated ids and urls pass as they are; an empty
    table gives an empty one. Other columns play no part.
    """
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(trees or train(spark))
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extracted(shared), f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {"op4_main_text": op4_main_text}
ORACLE: dict[str, str] = {}
