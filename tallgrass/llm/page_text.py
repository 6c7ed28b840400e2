"""Main text of web pages by wrapper induction over the pages of a host.

Each page becomes a tree of its block elements; siblings with the same label count as one repeated
node. The trees of a host are merged into its wrapper by simple tree matching (the heaviest common
subsequence of equally labelled children, level by level), and each page's tree is aligned with the
wrapper the same way. A text that unrelated pages of the host repeat in the same node of the wrapper
is template; what varies is content. Menus, adverts and the like that vary from page to page are told
by their element, role, class or id.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import arrays
from tallgrass.llm.graph import drop, keep

DEPTH = 256  # elements nested deeper become siblings at this depth
TREES = 500  # distinct trees of a host that one task folds
NODES, RARE = 20_000, 0.01  # a larger wrapper loses nodes that fewer pages hold; they are told by their labels from the root
CONTEXTS = 4  # unrelated pages that must repeat a text before it can be template
REGION = 0.6  # share of the text that the region of an unmarked page holds

# fixed values: elements as browsers treat them
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style title textarea iframe noscript noembed noframes xmp template svg canvas object audio video select button".split()
CLOSES = {  # an opening element ends an open one of these, up to the barrier
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
    "th": ("td th", "tr table"), "tbody": ("tbody thead tfoot tr td th", "table"), "thead": ("tbody thead tfoot tr td th", "table"),
    "tfoot": ("tbody thead tfoot tr td th", "table"), "option": ("option", "optgroup"),
}
CLOSES = {tag: (frozenset(ends.split()), frozenset(barrier.split())) for tag, (ends, barrier) in CLOSES.items()}
KEEPS_P = frozenset("html body caption option optgroup legend tbody thead tfoot tr td th".split())
BARRIER = frozenset("td th caption table".split())
# what is not part of an article, by element, by role and by the words of class and id
ASIDE = frozenset("nav footer aside form dialog menu search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion banner menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead sidebar aside widget widgets cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments "
    "disqus reply replies respond discussion related recommended recommendations pagination pager toolbar search copyright disclaimer".split()
)
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search for tag in RAW}
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NEGATED = re.compile(r"\b(?:has|with|no|without)[-_]\w+")
_ALL, _HEADER = 1, 2  # an element outside the article; one of which only headings stay


@dataclass
class Page:
    """Block elements in page order, and the text blocks between their tags."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    labels: list[str] = field(default_factory=list)
    roles: list[int] = field(default_factory=list)
    marks: list[str] = field(default_factory=list)  # "article", "main" or ""
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters inside links


def _describe(tag: str, text: str) -> tuple[str, int, str]:
    """Label, role and mark of an element from its attributes."""
    role, mark, words = (_ALL if tag in ASIDE else _HEADER if tag == "header" else 0), (tag if tag in ("article", "main") else ""), []
    if text.strip(" /\t\n\r\f"):
        for name, *values in _ATTRIBUTE.findall(text):
            value, name = html.unescape("".join(values)), name.lower()
            if name in ("class", "id"):
                words += [w.lower() for w in _NAME.findall(_NEGATED.sub(" ", value))]
            elif name == "role":
                told = value.strip().lower()
                role = _ALL if told in ROLES else role
                mark = told if told in ("article", "main") else mark
            elif name == "itemprop" and value.strip().lower() == "articlebody":
                mark = "article"
            elif name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and "display:none" in value.lower().replace(" ", "")):
                role = _ALL
        if tag not in ("html", "body") and mark == "":
            if not WORDS.isdisjoint(words):
                role = _ALL
            elif "header" in words:
                role = role or _HEADER
    return ".".join([tag, *words]), role, mark


def parse(source: str) -> Page:
    """Tree of a page; unclosed, misnested and cut off markup is read the way browsers do."""
    page = Page()
    page.tags.append("html")
    page.parents.append(-1)
    page.labels.append("html")
    page.roles.append(0)
    page.marks.append("")
    stack, held, in_link, linked = [0], [], False, 0
    at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(held).split())
        if text:
            page.blocks.append((stack[-1], text, min(linked, len(text))))
        held.clear()
        linked = 0

    def close(depth: int) -> None:
        flush()
        del stack[depth:]

    def opened(names: frozenset, barrier: frozenset) -> int:
        """Depth of the outermost open element of ``names`` inside the barrier, else 0."""
        found = 0
        for depth in range(len(stack) - 1, 0, -1):
            tag = page.tags[stack[depth]]
            if tag in names:
                found = depth
            elif tag in barrier:
                break
        return found

    def say(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            held.append(text)
            if in_link:
                linked += len(text.strip())

    while True:
        m = _TAG.search(source, at)
        if m is None:
            say(source[at:])
            break
        say(source[at : m.start()])
        at = m.end()
        closing, name, attributes, end = m.groups()
        if name is None or end == "":
            continue  # comments, declarations, and a tag cut off by the end of the page
        tag = name.lower()
        if tag in _RAW_END:
            if not closing:
                stop = _RAW_END[tag](source, at)
                at = len(source) if stop is None else stop.start()
            continue
        if tag == "br":
            held.append(" ")
        elif tag == "a":
            in_link = not closing
        elif closing:
            if tag in HEADINGS:
                names = HEADINGS
            else:
                names = frozenset((tag,))
            if tag in ("html", "body"):
                continue
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = page.tags[stack[depth]]
                if open_tag in names:
                    close(depth)
                    break
                if tag not in BLOCKS and open_tag in BLOCKS or open_tag in BARRIER and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                    break
        else:
            block = tag in BLOCKS
            if tag in VOID and not block:
                continue
            label, role, mark = _describe(tag, attributes) if attributes or tag in ASIDE or tag in ("header", "article", "main") else (tag, 0, "")
            if not block and not role:
                continue
            flush()
            if tag in ("html", "body"):
                continue
            if block:
                if tag not in KEEPS_P:
                    depth = opened(frozenset(("p",)), BARRIER)
                    if depth:
                        close(depth)
                if tag in HEADINGS and page.tags[stack[-1]] in HEADINGS:
                    close(len(stack) - 1)
                if tag in CLOSES:
                    depth = opened(*CLOSES[tag])
                    if depth:
                        close(depth)
            if tag == "hr":
                continue
            page.tags.append(tag)
            page.parents.append(stack[-1])
            page.labels.append(label)
            page.roles.append(role)
            page.marks.append(mark)
            if len(stack) < DEPTH:
                stack.append(len(page.tags) - 1)
    flush()
    return page


def candidates(page: Page) -> tuple[list[int], int]:
    """Blocks that can be main text by their elements, and the node of the article (0 if it is not marked)."""
    count = len(page.tags)
    size = [0] * count
    for node, text, _ in page.blocks:
        size[node] += len(text)
    aside = [False] * count  # inside something that is no article, forms and headers apart: they may wrap the page
    for n in range(1, count):
        aside[n] = aside[page.parents[n]] or (page.roles[n] == _ALL and page.tags[n] != "form")
    inside = size[:]
    for n in range(count - 1, 0, -1):
        if not page.roles[n]:
            inside[page.parents[n]] += inside[n]
    head = 0
    for mark in ("article", "main"):
        marked = [n for n in range(1, count) if page.marks[n] == mark and not aside[n]]
        if marked:
            head = max(marked, key=lambda n: (inside[n], -n))
            break
    wraps, n = {0}, head
    while n > 0:
        wraps.add(n)
        n = page.parents[n]
    within = [n == head for n in range(count)]
    role = [0] * count
    for n in range(1, count):
        parent = page.parents[n]
        within[n] = within[n] or within[parent]
        role[n] = 0 if n in wraps else _ALL if page.roles[n] == _ALL or role[parent] == _ALL else max(page.roles[n], role[parent])
        if page.roles[n] == _HEADER and not (head and within[n]):
            role[n] = 0 if n in wraps else _ALL
    found = [
        k for k, (node, _, _) in enumerate(page.blocks)
        if within[node] and (role[node] == 0 or role[node] == _HEADER and page.tags[node] in HEADINGS)
    ]
    return found, head


def main_blocks(page: Page, template: set[tuple[int, int]]) -> list[str]:
    """Texts of the article's blocks; ``template`` holds condensed nodes with texts that are not its own."""
    found, head = candidates(page)
    places = condense(page)[1]
    own = [k for k in found if not template or (places[page.blocks[k][0]], text_name(page.blocks[k][1])) not in template]
    sizes = {k: len(page.blocks[k][1]) for k in found}
    if 2 * sum(sizes[k] for k in own) < sum(sizes.values()):
        own = found  # a page that is mostly like others is a copy, not template
    if head:
        return [page.blocks[k][1] for k in own]
    own = [k for k in own if 2 * page.blocks[k][2] <= sizes[k]]
    inside = [0] * len(page.tags)
    for k in own:
        inside[page.blocks[k][0]] += sizes[k]
    for n in range(len(page.tags) - 1, 0, -1):
        inside[page.parents[n]] += inside[n]
    region = max((n for n in range(len(page.tags)) if inside[n] >= REGION * inside[0]), default=0)
    while region and page.tags[region] in ("p", "li", "td", "th", "dd", "dt", *HEADINGS):
        region = page.parents[region]
    within = [n == region for n in range(len(page.tags))]
    for n in range(1, len(page.tags)):
        within[n] = within[n] or within[page.parents[n]]
    chosen = [k for k in own if within[page.blocks[k][0]]]
    titles = [k for k in own if page.tags[page.blocks[k][0]] == "h1"]
    if chosen and titles and not any(within[page.blocks[k][0]] for k in titles):
        chosen = [k for k in titles if k < chosen[0]][-1:] + chosen
    return [page.blocks[k][1] for k in chosen]


def text_name(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


# --- trees and wrappers: labels and parents of nodes, parents first, siblings in order


def condense(page: Page) -> tuple[str, list[int]]:
    """The tree with equally labelled siblings as one node, as text, and its node for each of the page."""
    index: dict[tuple[int, str], int] = {}
    lines, places = [], []
    for label, parent in zip(page.labels, page.parents, strict=True):
        up = places[parent] if parent >= 0 else -1
        at = index.get((up, label))
        if at is None:
            at = index[up, label] = len(lines)
            lines.append(f"{up} {label}")
        places.append(at)
    return "\n".join(lines), places


@dataclass
class Node:
    """A node of a wrapper: how many pages hold it, and its place in the text it was read from."""

    label: str
    pages: int
    place: int
    children: list[Node] = field(default_factory=list)


def read_tree(text: str, pages: int | None = None) -> Node:
    """From lines ``parent label`` (all held by ``pages``) or ``parent pages label``."""
    nodes: list[Node] = []
    for place, line in enumerate(text.split("\n")):
        if pages is None:
            parent, held, label = line.split(" ", 2)
        else:
            (parent, label), held = line.split(" ", 1), pages
        node = Node(label, int(held), place)
        if nodes:
            nodes[int(parent)].children.append(node)
        nodes.append(node)
    return nodes[0]


def write_tree(root: Node) -> str:
    lines, queue = [f"-1 {root.pages} {root.label}"], [(root, 0)]
    for node, place in queue:  # grows while it is read: parents first
        for child in node.children:
            queue.append((child, len(lines)))
            lines.append(f"{place} {child.pages} {child.label}")
    return "\n".join(lines)


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching of two nodes of equal label: size of the best match and its pairs of children.

    Children match in order. As only equal labels match, the best choice is the heaviest rising chain
    of pairs of equally labelled children.
    """
    at: dict[str, list[int]] = {}
    for j, child in enumerate(b.children):
        at.setdefault(child.label, []).append(j)
    ends: list[int] = []  # chains: last place in b, rising, with total weights, rising too
    chains: list[tuple[int, tuple | None]] = []
    for child in a.children:
        fresh = []
        for j in at.get(child.label, ()):
            weight = match(child, b.children[j])[0]
            k = bisect_left(ends, j)
            total, before = chains[k - 1] if k else (0, None)
            fresh.append((j, total + weight, (child, b.children[j], before)))
        for j, total, link in fresh:
            k = bisect_left(ends, j)
            if k and chains[k - 1][0] >= total:
                continue
            stop = k
            while stop < len(ends) and chains[stop][0] <= total:
                stop += 1
            ends[k:stop], chains[k:stop] = [j], [(total, link)]
    total, link = chains[-1] if chains else (0, None)
    pairs = []
    while link is not None:
        pairs.append((link[0], link[1]))
        link = link[2]
    return total + 1, pairs[::-1]


def merge(wrapper: Node, tree: Node) -> None:
    """Fold a tree into the wrapper: matched nodes add their pages up, others come in beside their neighbours."""
    todo = [(wrapper, tree)]
    while todo:
        into, node = todo.pop()
        into.pages += node.pages
        _, pairs = match(into, node)
        partner = {id(b): a for a, b in pairs}
        position = {id(a): i for i, a in enumerate(into.children)}
        todo += pairs
        after: dict[int, list[Node]] = {}
        last = -1
        for child in node.children:
            a = partner.get(id(child))
            if a is not None:
                last = position[id(a)]
            else:
                after.setdefault(last, []).append(child)
        if after:
            children = after.get(-1, [])
            for i, child in enumerate(into.children):
                children = [*children, child, *after[i]] if i in after else [*children, child]
            into.children = children


def prune(wrapper: Node) -> None:
    """Drop nodes that few pages hold, where the wrapper has become large; :func:`slots` places them without it."""
    queue = [wrapper]
    for node in queue:
        queue += node.children
    if len(queue) > NODES:
        for node in queue:
            node.children = [c for c in node.children if c.pages >= RARE * wrapper.pages]


def aligned(wrapper: Node, tree: Node, size: int) -> list[int]:
    """The wrapper's place for each place of the tree, -1 where there is none."""
    places = [-1] * size
    todo = [(wrapper, tree)]
    while todo:
        a, b = todo.pop()
        places[b.place] = a.place
        todo += match(a, b)[1]
    return places


def slots(places: list[int], tree: str) -> list[int]:
    """Places in the wrapper; for a node without one a negative number, the same wherever its labels from the root are."""
    paths: list[int] = []
    found = []
    for place, line in zip(places, tree.split("\n"), strict=True):
        parent, label = line.split(" ", 1)
        paths.append(xxhash.xxh64_intdigest(label, paths[int(parent)] if paths else 0))
        found.append(place if place >= 0 else -1 - (paths[-1] >> 1))
    return found


# --- Spark


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tree, blocks and context of every page."""
    schema = pa.schema([("name", pa.int64()), ("host", pa.string()), ("tree", pa.string()), ("nodes", pa.list_(pa.int32())), ("texts", pa.list_(pa.int64())), ("context", pa.int64())])
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            rows, own = [], []
            for name, host, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                page = parse(source.as_py())
                tree, places = condense(page)
                found = [page.blocks[k] for k in candidates(page)[0]]
                told = {(places[node], text_name(text)) for node, text, _ in found}
                rows.append({"name": name, "host": host, "tree": tree, "nodes": [n for n, _ in told], "texts": [t for _, t in told]})
                own.append(" ".join(text for _, text, _ in found))
            for at, offsets, data in arrays.slices(pa.array(own, pa.large_string())):
                hashes, text = arrays.shingle_sets(data, offsets, 3)
                heads = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else np.empty(0, dtype=np.int64)
                for k, h in zip(text[heads].tolist(), hashes[heads].view(np.int64).tolist(), strict=True):
                    rows[at + k]["context"] = h  # the smallest: near copies share it, other texts do not
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrapper of each run of rows of one host and part; rows are read one by one."""
    key, wrapper = None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"host": pa.array([key[0]], pa.string()), "part": pa.array([key[1]], pa.int64()), "tree": pa.array([write_tree(wrapper)], pa.string())})

    for batch in batches:
        for host, part, tree, pages in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            if key != (host, part):
                if key is not None:
                    yield told()
                key, wrapper = (host, part), read_tree(tree, pages)
            else:
                merge(wrapper, read_tree(tree, pages))
                prune(wrapper)
    if key is not None:
        yield told()


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots of the nodes of each tree; the wrapper of a part comes before its trees (``pages`` is null)."""
    wrapper = None
    for batch in batches:
        hosts, names, found = [], [], []
        for host, name, tree, pages in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            if pages is None:
                wrapper = read_tree(tree)
            else:
                hosts.append(host)
                names.append(name)
                places = aligned(wrapper, read_tree(tree, pages), tree.count("\n") + 1)
                found.append(slots(places, tree) if min(places) < 0 else places)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(names, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["host", "tree_name", "places"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, template in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
            known = {(t["node"], t["text"]) for t in template or ()}
            texts.append("\n\n".join(main_blocks(parse(source.as_py() or ""), known)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )


def _template(spark: SparkSession, facts: DataFrame) -> DataFrame:
    """``(name, template)``: for pages that hold template texts, the condensed nodes and texts."""
    trees = facts.groupBy("host", "tree").agg(F.count("*").alias("pages")).withColumn("tree_name", F.xxhash64("tree"))
    trees = keep(spark, trees, "trees")
    many = trees.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > TREES)
    parted = trees.join(many, "host", "left").withColumn("part", F.pmod("tree_name", 1 + F.floor(F.coalesce("n", F.lit(0)) / TREES)))
    parted = parted.select("host", "part", "tree", "pages", "tree_name")
    shape = "host string, part long, tree string"
    partial = parted.repartition("host", "part").sortWithinPartitions("host", "part", F.desc("pages"), "tree").select("host", "part", "tree", "pages").mapInArrow(_fold, shape)
    partial = keep(spark, partial, "partial")
    whole = partial.select("host", F.lit(0).cast("long").alias("part"), "tree", F.lit(None).cast("long").alias("pages"), F.col("part").alias("turn"))
    wrappers = whole.repartition("host").sortWithinPartitions("host", "turn").select("host", "part", "tree", "pages").mapInArrow(_fold, shape)
    heads = partial.select("host", "part").join(wrappers.select("host", "tree"), "host")
    both = parted.unionByName(heads.withColumn("pages", F.lit(None).cast("long")), allowMissingColumns=True)
    sorted_ = both.repartition("host", "part").sortWithinPartitions("host", "part", F.col("pages").asc_nulls_first())
    places = keep(spark, sorted_.select("host", "tree_name", "tree", "pages").mapInArrow(_align, "host string, tree_name long, places array<long>"), "places")

    placed = facts.select("name", "host", F.xxhash64("tree").alias("tree_name"), "nodes", "texts", "context").join(places, ["host", "tree_name"])
    cells = placed.select("name", "host", "context", "places", F.explode(F.arrays_zip("nodes", "texts")).alias("cell"))
    cells = cells.select("name", "host", "context", F.col("cell.nodes").alias("node"), F.get("places", F.col("cell.nodes")).alias("slot"), F.col("cell.texts").alias("text"))
    cells = keep(spark, cells.where("slot is not null and context is not null"), "cells")
    texts = cells.groupBy("host", "slot", "text").agg(F.count_distinct("context").alias("n")).where(F.col("n") >= CONTEXTS)
    slots = cells.groupBy("host", "slot").agg(F.count_distinct("context").alias("all"))
    fixed = keep(spark, texts.join(slots, ["host", "slot"]).where("2 * n > all").select("host", "slot", "text"), "fixed")
    found = cells.join(fixed, ["host", "slot", "text"], "left_semi").groupBy("name").agg(F.collect_set(F.struct("node", "text")).alias("template"))
    found = keep(spark, found, "template")
    drop(spark, trees, partial, places, cells, fixed)
    return found


def page_texts(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages(page_id, url, html, ...)``.

    ``text`` holds the blocks of the page's article, joined by an empty line, white space inside a block
    as one space and character references decoded. The article is the marked one with the most text
    (``article`` before ``main``), else the smallest region that holds most of the text that varies from
    page to page and is no list of links. Texts that at least four unrelated pages and over half of those
    of the host repeat in the same node of its wrapper are left out, unless they make up more than half
    of a page: then the page is a copy of others. A page without others of its host is judged alone.

    Null and empty pages give an empty text. Pages with a null url, or without a host in it, are taken
    as of one host. Null ids and repeated rows are kept as they are; repeated pages count once for
    the wrapper; other columns are ignored; empty in, empty out. Pages are read whole, one at a time,
    however long.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    own = own.withColumn("name", F.xxhash64(host, "html"))
    facts = own.where("html is not null").select("name", host.alias("host"), "html")
    facts = keep(spark, facts.mapInArrow(_facts, "name long, host string, tree string, nodes array<int>, texts array<long>, context long"), "facts")
    template = _template(spark, facts)
    done = own.join(template, "name", "left").select("page_id", "url", "html", "template")
    found = keep(spark, done.mapInArrow(_extract, "page_id long, url string, text string, n_chars long"), "texts")
    drop(spark, facts, template)
    return found
