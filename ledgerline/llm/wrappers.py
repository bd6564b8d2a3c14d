"""Main text of web pages by wrapper induction.

The pages of a host are aligned with one page of it, the one with the smallest id, by simple tree
matching: the pairing of two DOM trees that keeps parents and order and pairs most nodes. All other
pages vote whether a node of that page has a constant text; how sure that is, is the lower end
of the 95 % interval of its rate, so few pages say little and no least number of pages is needed.
Nodes known to be constant form the host's template; all others are slots.

Slots choose the content: the smallest element that holds all slots of a page is its content root, and
text outside of it is template. Tags only break ties: an ``article`` (else ``main``) around that root,
or articles in it with at least half of the slots' text, stand for it. Inside the root, nodes that are constant with
confidence go, and so do elements that are by their name, role or class a menu, header, footer, sidebar,
notice, advert, form, comment section, script or style. A class drops neither the only article if that holds
most of the slots, nor what is around it, nor an element that holds all slots.

Votes are counted over all pages of all hosts with map-side sums; a host with most of the
pages is split by adaptive execution, as every page only meets its host's one reference.

Defined cases: NULL or empty html gives the empty text; a NULL url counts as a host of its
own; ties for the reference page are broken by its html; copies of the reference page have no vote, so a host of
copies has slots only; repeated rows are extracted each. Elements may nest to any depth; lists of
children of any length are matched alike, by rows of one table of which a bounded part is kept, and very long pages are read whole. Broken markup is read as
browsers do in simple cases: an open paragraph ends at the next block, end tags without a start are ignored.
"""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import stored, without

#: A template node has one text on this share of the pages, and on ``SURE`` of them with 95 % confidence.
CONSTANT, SURE = 0.9, 2 / 3
#: Constancy above which a text is no slot when the content root is chosen: one vote is enough.
HINT = 0.1
#: Cells of the matching table that are kept at a time.
TABLE = 250_000
#: Bytes of the reference pages' trees that a task keeps, and about what an element takes besides its text.
KEPT, NODE = 32 << 20, 400
#: Nodes whose votes a task sums before it hands them on.
VOTES = 50_000
# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo cite code data dfn em font i kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = set("nav footer aside form script style noscript template head title button select textarea dialog svg iframe object canvas menu".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
MARKED = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs cookie cookies consent notice notices popup modal newsletter subscribe subscription signup comment comments reply replies respond "
    "disqus share sharing social footer header masthead related recommended widget toolbar pagination".split()
)
#: Elements of running text, which hold content but are not its root.
RUNNING = set("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre address figure figcaption caption table thead tbody tfoot tr td th details summary".split())
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "index", "parent", "size")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.index = self.size = 0


class Tree(HTMLParser):
    """A small DOM; ``nodes`` are its elements in page order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {}, None)
        self.nodes = [self.root]
        self.feed(html)
        self.close()
        for n in reversed(self.nodes):
            n.size = 1 + sum(c.size for c in n.children if isinstance(c, Node))

    def release(self) -> None:
        """Cuts the links between elements, so that the tree goes at once and not when cycles are looked for."""
        for n in self.nodes:
            n.parent, n.children = None, []

    def _inside(self, tags: set[str], stop: set[str]) -> Node | None:
        n = self.open
        while n is not None and n.tag not in stop:
            if n.tag in tags:
                return n
            n = n.parent
        return None

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P and (p := self._inside({"p"}, {"article", "section", "div", "td", "li", "main", "body", "blockquote"})):
            self.open = p.parent
        elif tag in SIBLINGS and (p := self._inside(SIBLINGS[tag], {"ul", "ol", "dl", "table", "select"})):
            self.open = p.parent
        node = Node(tag, dict(attrs), self.open)
        node.index = len(self.nodes)
        self.nodes.append(node)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        n = self.open
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.open = n.parent

    def handle_data(self, data):
        if data:
            self.open.children.append(data)


def own_text(node: Node) -> str:
    """Text of a node and the inline elements in it, white space as one space."""
    parts: list[str] = []
    todo: list = list(reversed(node.children))
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            parts.append(c)
        elif c.tag in INLINE:
            todo.extend(reversed(c.children))
        else:
            parts.append(" ")
    return " ".join("".join(parts).split())


def matched(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching of two trees with equal root names: pairs of nodes."""
    pairs, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        left = [c for c in x.children if isinstance(c, Node) and c.tag not in INLINE]
        right = [c for c in y.children if isinstance(c, Node) and c.tag not in INLINE]
        # Equal starts and ends are paired at once; the table is only needed between them.
        start, end, shorter = 0, 0, min(len(left), len(right))
        while start < shorter and _alike(left[start], right[start]):
            start += 1
        while end < shorter - start and _alike(left[-1 - end], right[-1 - end]):
            end += 1
        todo.extend(zip(left[:start], right[:start]))
        todo.extend((left[-1 - k], right[-1 - k]) for k in range(end))
        left, right = left[start : len(left) - end], right[start : len(right) - end]
        if left and right:
            todo.extend((left[i], right[j]) for i, j in _aligned(left, right))
    return pairs


def _aligned(left: list[Node], right: list[Node]) -> list[tuple[int, int]]:
    """Places in two lists whose pairs keep the order, are alike, and have the largest sum of smaller sizes.

    A row of the table holds for each place of ``right`` the best sum from there on, and follows from the row
    below it. Rows are kept for ``TABLE`` cells only: above a longer part the middle row is found first, and each half
    is filled once more when the path gets there, so the path is that of the whole table at any length.
    """
    kinds: dict[tuple, int] = {}
    kind = [np.array([kinds.setdefault((n.tag, n.attrs.get("class")), len(kinds)) for n in side]) for side in (left, right)]
    size = [np.array([n.size for n in side], np.int64) for side in (left, right)]
    shared = np.isin(kind[0], kind[1])

    def above(row: np.ndarray, i: int, j: int) -> np.ndarray:
        """The row of place ``i`` of ``left`` over places of ``right`` from ``j``, by the row below."""
        if not shared[i]:
            return row
        best = row.copy()
        both = row[1:] + np.minimum(size[0][i], size[1][j:])
        np.maximum(best[:-1], both, out=best[:-1], where=kind[1][j:] == kind[0][i])
        return np.maximum.accumulate(best[::-1])[::-1]

    out: list[tuple[int, int]] = []
    parts = [(0, len(left), np.zeros(len(right) + 1, np.int64))]
    j = 0
    while parts and j < len(right):
        first, last, row = parts.pop()
        row = row[len(row) - 1 - (len(right) - j) :]
        if last - first > 1 and (last - first) * len(row) > TABLE:
            middle, half = (first + last) // 2, row
            for i in range(last - 1, middle - 1, -1):
                half = above(half, i, j)
            parts += [(middle, last, row), (first, middle, half)]
            continue
        rows, from_ = [row], j
        for i in range(last - 1, first - 1, -1):
            rows.append(above(rows[-1], i, from_))
        i = first
        while i < last and j < len(right):
            here, below, at = rows[last - i], rows[last - i - 1], j - from_
            if here[at] == below[at]:
                i += 1
            elif here[at] == here[at + 1]:
                j += 1
            else:
                out.append((i, j))
                i, j = i + 1, j + 1
    return out


def _alike(a: Node, b: Node) -> bool:
    return a.tag == b.tag and a.attrs.get("class") == b.attrs.get("class")


def is_dropped(n: Node, in_article: bool) -> bool:
    """Is the element no content by its name, role or visibility?"""
    if n.tag in DROPPED or (n.tag == "header" and not in_article):
        return True
    if n.tag in ("html", "body", "main", ""):
        return False
    a = n.attrs
    if "hidden" in a or a.get("aria-hidden") == "true" or (a.get("role") or "").lower() in ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", (a.get("style") or "").lower()))


def is_marked(n: Node) -> bool:
    """Does a class or id name the element as something beside the content? Names of states
    (``has-sidebar``) do not, nor do words in the middle of a long id (``story-share-economy``)."""
    if n.tag in ("html", "body", "main", "") or not ("class" in n.attrs or "id" in n.attrs):
        return False
    for kind in ("class", "id"):
        for name in (n.attrs.get(kind) or "").lower().split():
            words = [w for w in re.split(r"[^a-z]+", name) if w]
            if words and words[0] not in ("has", "is", "with", "without", "no"):
                if not MARKED.isdisjoint(words if kind == "class" or len(words) < 3 else (words[0], words[-1])):
                    return True
    return False


def content(tree: Tree, constant: dict[int, float]) -> tuple[list[Node], list[bool]]:
    """The content roots of a page, and for each of its nodes whether it is dropped. ``constant`` tells for
    nodes with the text of the host's reference page how sure it is that the text never changes."""
    nodes = tree.nodes
    gone, inside, slot = [False] * len(nodes), [False] * len(nodes), [True] * len(nodes)
    for i, x in enumerate(nodes[1:], 1):
        up = x.parent.index
        inside[i] = inside[up] or x.tag == "article"
        gone[i] = gone[up] or is_dropped(x, inside[up])
        slot[i] = slot[up] if x.tag in INLINE else constant.get(i, 0.0) < HINT
    own = [sum(len(c.strip()) for c in x.children if isinstance(c, str)) if slot[i] and not gone[i] else 0 for i, x in enumerate(nodes)]

    def sums() -> list[int]:
        total = [0 if g else n for n, g in zip(own, gone)]
        for i in range(len(nodes) - 1, 0, -1):
            total[nodes[i].parent.index] += total[i]
        return total

    total = sums()
    marked = [not gone[i] and is_marked(x) for i, x in enumerate(nodes)]
    if any(marked):
        safe = {i for i in range(len(nodes)) if total[i] == total[0] > 0}
        for tag in ("article", "main"):
            one = [x for x in nodes if x.tag == tag]
            if len(one) == 1 and 2 * total[one[0].index] >= total[0]:
                x = one[0]
                while x is not None:
                    safe.add(x.index)
                    x = x.parent
        for i, x in enumerate(nodes[1:], 1):
            gone[i] = gone[i] or gone[x.parent.index] or (marked[i] and i not in safe)
        total = sums()

    # The smallest element with all slots: go down while one block holds them all.
    root = tree.root
    while total[0]:
        whole = [c for c in root.children if isinstance(c, Node) and total[c.index] == total[0] and c.tag not in INLINE]
        if not whole:
            break
        root = whole[0]
    path = [root]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    for tag in ("article", "main"):
        if around := [x for x in path if x.tag == tag]:
            return around[-1:], gone
        tops, todo = [], [root]
        while todo:
            x = todo.pop()
            if x.tag == tag:
                tops.append(x)
            else:
                todo.extend(c for c in reversed(x.children) if isinstance(c, Node) and not gone[c.index])
        if tops and 2 * sum(total[x.index] for x in tops) >= total[0]:
            return tops, gone
    return [next((x for x in path if x.tag not in RUNNING), tree.root)], gone


def main_text(tree: Tree, constant: dict[int, float], template: set[int]) -> str:
    """Text in page order; ``template`` holds the indexes of this page's nodes known to be constant."""
    roots, gone = content(tree, constant)
    parts: list[str] = []
    for root in roots:
        parts.append(" ")
        todo: list = [root]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                parts.append(item)
                continue
            if gone[item.index]:
                parts.append(" ")
                continue
            skip = item.index in template
            edge = item.tag not in INLINE
            parts.append(" " if edge else "")
            if edge:
                todo.append(" ")
            todo.extend(c for c in reversed(item.children) if not (skip and (isinstance(c, str) or c.tag in INLINE)))
    return " ".join("".join(parts).split())


def host_of(url_col: str = "url"):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1)), F.lit(""))


def _references(pages: DataFrame) -> DataFrame:
    """One page of each host, by the smallest id."""
    given = pages.where(F.length("html") > 0)
    return given.groupBy("host").agg(F.min(F.struct(F.col("id").isNull(), "id", "html")).alias("r")).select("host", F.col("r.html").alias("reference"))


class _Trees:
    """Trees of reference pages; the one that was longest not asked for goes first."""

    def __init__(self):
        self.trees: OrderedDict[str, tuple[Tree, int]] = OrderedDict()
        self.kept = 0

    def __getitem__(self, html: str) -> Tree:
        if html in self.trees:
            self.trees.move_to_end(html)
            return self.trees[html][0]
        tree = Tree(html)
        size = len(html) + NODE * len(tree.nodes)
        while self.trees and self.kept + size > KEPT:
            old, gone = self.trees.popitem(last=False)[1]
            self.kept -= gone
            old.release()
        self.trees[html] = tree, size
        self.kept += size
        return tree


def _values(batch: pa.RecordBatch, *columns: int) -> Iterator[tuple]:
    """The values of a few columns row by row: a batch repeats its host's page and nodes in each row, so they are not read all at once."""
    return zip(*((v.as_py() for v in batch.column(k)) for k in columns))


def _votes(pages: DataFrame) -> DataFrame:
    """``host``, ``node`` of the reference, ``n`` pages with that node and ``same`` of them with the same text."""

    def summed(votes: dict[tuple, list[int]]) -> pa.RecordBatch:
        cols = [[k[0] for k in votes], [k[1] for k in votes], [v[0] for v in votes.values()], [v[1] for v in votes.values()]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["host", "node", "n", "same"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _Trees()
        for b in batches:
            votes: dict[tuple, list[int]] = {}
            for host, html, reference in _values(b, 0, 1, 2):
                if html == reference:
                    continue
                ref, tree = trees[reference], Tree(html)
                for x, y in matched(ref.root, tree.root):
                    text = own_text(x)
                    if text:
                        v = votes.setdefault((host, x.index), [0, 0])
                        v[0] += 1
                        v[1] += text == own_text(y)
                tree.release()
                if len(votes) > VOTES:
                    yield summed(votes)
                    votes = {}
            yield summed(votes)

    each = pages.mapInArrow(run, "host string, node long, n long, same long")
    return each.groupBy("host", "node").agg(F.sum("n").alias("n"), F.sum("same").alias("same"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """All rows and columns but the html, with ``text`` and ``n_chars``."""
    base = without(pages, "text", "n_chars", "_host")
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    slim = base.select(F.col(id_col).alias("id"), host_of(url_col).alias("host"), html.alias("html"))
    refs = stored(_references(slim), "wrapper-references")
    votes = _votes(slim.where(F.length("html") > 0).join(refs, "host").select("host", "html", "reference"))
    rate, n, z2 = F.col("same") / F.col("n"), F.col("n"), 3.8416
    lowest = (rate + z2 / (2 * n) - F.sqrt(z2 * (rate * (1 - rate) / n + z2 / (4 * n * n)))) / (1 + z2 / n)
    sure = votes.where("same > 0").select("host", "node", lowest.alias("constant"), ((rate >= CONSTANT) & (lowest >= SURE)).alias("template")).where(F.col("constant") >= HINT)
    nodes = sure.groupBy("host").agg(F.collect_list(F.struct("node", "constant", "template")).alias("nodes"))
    wrappers = refs.join(nodes, "host").select(F.col("host").alias("_host"), "reference", "nodes")
    wrappers = stored(wrappers, "wrappers")
    keep = [f for f in base.schema.fields if f.name.lower() != html_col.lower()]
    # Own names inside, so that no input column can clash.
    rows = base.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(keep)], html.alias("_html"), host_of(url_col).alias("_h"))
    rows = rows.join(wrappers, F.col("_h") == F.col("_host"), "left").drop("_h", "_host")
    schema = T.StructType([*keep, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _Trees()
        for b in batches:
            n = b.num_columns
            texts = []
            for (source, reference), nodes in zip(_values(b, n - 3, n - 2), b.column(n - 1)):
                if not source:
                    texts.append("")
                    continue
                tree, known, template = Tree(source), {}, set()
                if nodes.is_valid:
                    node, constant, fixed = (v.to_pylist() for v in nodes.values.flatten())
                    voted = dict(zip(node, zip(constant, fixed)))
                    for x, y in matched(trees[reference].root, tree.root):
                        if (v := voted.get(x.index)) and own_text(x) == own_text(y):
                            known[y.index] = v[0]
                            if v[1]:
                                template.add(y.index)
                texts.append(main_text(tree, known, template))
                tree.release()
            yield pa.RecordBatch.from_arrays([*b.columns[: n - 3], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)
