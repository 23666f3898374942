"""Element trees of HTML as rows: a node table with structural numbers, selectors as joins on them.

A node covers the text between two offsets of its document's text and the nodes numbered from pre + 1 to last, so what is
inside what is a comparison of numbers: a running maximum over the document, no comparison of nodes with nodes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hustings.sources.shared import bounded_batches

#: Fixed values of HTML: elements without content, elements whose content is text, and what a start tag closes if it is open.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
BLOCKS = "address article aside blockquote center div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
CLOSES = {b: {"p"} for b in BLOCKS} | {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th", "p"}, "body": {"head"}}
#: Elements that such closings don't reach beyond.
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}} | dict.fromkeys(("tr", "td", "th", "tbody"), {"table"})
LIMITS = frozenset("table td th caption button object".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Character references that end with a semicolon; browsers read some without one too.
CLOSED = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);")
NODE = "pre int, last int, post int, parent int, level int, place int, tag string, attrs map<string, string>, start int, end int"


#: Rows that a task hands on at a time, but for a page's own.
HANDED_ON = 10_000


class Builder:
    """One document's nodes, from its tokens in order. Node 0 is the document."""

    def __init__(self) -> None:
        self.nodes: list[list] = [[0, 0, 0, None, 0, 0, "#document", {}, 0, 0]]
        self.children, self.open, self.parts, self.at, self.closed = [0], [0], [], 0, 0

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            self.at += len(raw)

    def close(self, depth: int) -> None:
        """Closes elements until so many are open."""
        while len(self.open) > depth:
            node = self.nodes[self.open.pop()]
            node[1], node[2], node[9] = len(self.nodes) - 1, self.closed, self.at
            self.closed += 1

    def end(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.nodes[self.open[depth]][6] == tag:
                return self.close(depth)

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        ends, scope, found = CLOSES.get(tag, ()), SCOPES.get(tag, LIMITS), None
        for depth in range(len(self.open) - 1, 0, -1) if ends else ():
            held = self.nodes[self.open[depth]][6]
            if held in scope:
                break
            found = depth if held in ends else found
        if found is not None:
            self.close(found)
        parent, pre = self.open[-1], len(self.nodes)
        self.nodes.append([pre, pre, 0, parent, len(self.open), self.children[parent], tag, attrs, self.at, self.at])
        self.children[parent] += 1
        self.children.append(0)
        self.open.append(pre)
        if tag in VOID:
            self.close(len(self.open) - 1)


def only_closed(raw: str) -> str:
    """A text with the character references that end with a semicolon as characters; others stay as they stand."""
    return CLOSED.sub(lambda m: unescape(m[0]), raw)


def built(html: str, unescape: Callable[[str], str] = unescape) -> tuple[str, list[list]]:
    """The text of a document and its nodes, as NODE has them; unescape turns character references into characters."""
    tree, at = Builder(), 0
    while at < len(html):
        token = TOKEN.search(html, at)
        if token is None:
            break
        tree.text(unescape(html[at : token.start()]))
        at = token.end()
        if token[1]:
            tree.end(token[1].lower())
        elif token[2]:
            tag, rest = token[2].lower(), token[3]
            attrs: dict[str, str] = {}
            for name, *values in ATTRIBUTE.findall(rest):
                attrs.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
            tree.start(tag, attrs)
            if tag in RAW:
                stop = re.compile(f"</{tag}", re.I).search(html, at)
                raw = html[at : stop.start() if stop else len(html)]
                tree.text(unescape(raw) if tag in ("title", "textarea") else raw)
                at = stop.start() if stop else len(html)
    tree.text(unescape(html[at:]))
    tree.close(0)
    return "".join(tree.parts), tree.nodes


def parsed(pages: DataFrame, key: str, html: str, closed: bool = False) -> DataFrame:
    """(key, pre, last, post, parent, level, place, tag, attrs, start, end, text): the nodes of every page.

    pre numbers a page's nodes as they open, post as they close; nodes from pre + 1 to last are inside. place counts the
    elements before it with the same parent. Node 0 is the document; it alone has text, that of the whole page, of which a
    node has the characters from start to end. Unclosed and stray tags are mended as browsers do it for paragraphs, lists
    and tables. A missing page is a document without text; names of tags and attributes are in lower case. Character
    references are read as browsers do it, or with closed only where they end with a semicolon.
    """
    reader = only_closed if closed else unescape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, nodes, texts = [], [], []

            def made() -> pa.RecordBatch:
                columns = dict(zip(NAMES, zip(*nodes, strict=True), strict=True))  # noqa: B023
                pairs = [a for attrs in columns["attrs"] for a in attrs.items()]
                ends = pa.array(accumulate(map(len, columns["attrs"]), initial=0), pa.int32())
                columns["attrs"] = pa.MapArray.from_arrays(ends, pa.array([k for k, _ in pairs], pa.string()), pa.array([v for _, v in pairs], pa.string()))
                arrays = [c if n == "attrs" else pa.array(c, pa.string() if n == "tag" else pa.int32()) for n, c in columns.items()]
                return pa.RecordBatch.from_arrays([*arrays, batch.column("key").take(pa.array(rows, pa.int64())), pa.array(texts, pa.string())], [*NAMES, "key", "text"])  # noqa: B023

            for row, page in enumerate(batch.column("html").to_pylist()):
                whole, own = built(page or "", reader)
                rows += [row] * len(own)
                nodes += own
                texts += [whole, *[None] * (len(own) - 1)]
                if len(nodes) >= HANDED_ON:
                    yield made()
                    rows, nodes, texts = [], [], []
            if nodes:
                yield made()

    kind = pages.schema[key].dataType
    bounded_batches(pages.sparkSession)
    schema = T.StructType([*T._parse_datatype_string(NODE), T.StructField("key", kind), T.StructField("text", T.StringType())])
    found = pages.select(F.col(key).alias("key"), F.col(html).cast("string").alias("html")).mapInArrow(run, schema)
    return found.select(F.col("key").alias(key), *NAMES, "text")


NAMES = [c.split()[0] for c in NODE.replace("map<string, string>", "map").split(", ")]


def select(nodes: DataFrame, key: str, *steps: tuple[str, Column]) -> DataFrame:
    """The nodes that a selector names. A step is an axis and a condition on a node's columns; the axis tells where the node
    stands to one that the step before names (the document before the first): descendant, child, next (the sibling right
    after it) or after (any later sibling)."""
    page = Window.partitionBy(key).orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    siblings = Window.partitionBy(key, "parent").orderBy("place")
    found = nodes.withColumn("_met", F.col("pre") == 0)
    for axis, condition in steps:
        if axis == "descendant":
            there = F.max(F.when(F.col("_met"), F.col("last"))).over(page) >= F.col("pre")
        elif axis == "next":
            there = F.lag("_met").over(siblings)
        elif axis == "after":
            there = F.max("_met").over(siblings.rowsBetween(Window.unboundedPreceding, -1))
        elif axis == "child":
            above = found.filter("_met").select(key, F.col("pre").alias("parent"), F.lit(True).alias("_above"))
            found, there = found.join(above, [key, "parent"], "left"), F.col("_above")
        else:
            raise ValueError(f"no such axis: {axis}")
        found = found.withColumn("_met", F.coalesce(there, F.lit(False)) & F.coalesce(condition, F.lit(False)) & (F.col("pre") > 0)).drop("_above")
    return found.filter("_met").drop("_met")


def has_class(name: str) -> Column:
    return F.array_contains(F.split(F.coalesce(F.col("attrs")["class"], F.lit("")), r"\s+"), name)


def with_text(found: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """found with content, the text inside each node."""
    whole = nodes.filter("pre = 0").select(key, F.col("text").alias("_whole"))
    cut = F.substring(F.col("_whole"), F.col("start") + 1, F.col("end") - F.col("start"))
    return found.join(whole, key).withColumn("content", cut).drop("_whole")


def trimmed(s) -> Column:
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def enclosing(outer: DataFrame, inner: DataFrame, key: str) -> DataFrame:
    """inner with at, the pre of the node of outer that it stands in; others go. Nodes of outer must not hold each other, so
    it is the last one that opened before."""
    marks = outer.select(key, "pre", F.col("pre").alias("at"), F.col("last").alias("_last"), F.lit(0).alias("_own"))
    every = marks.unionByName(inner.withColumn("_own", F.lit(1)), allowMissingColumns=True)
    order = Window.partitionBy(key).orderBy("pre", "_own")
    held = every.withColumn("at", F.last("at", True).over(order)).withColumn("_last", F.last("_last", True).over(order))
    return held.filter("_own = 1 and pre <= _last").drop("_own", "_last")


def speeches(pages: DataFrame, key: str, html: str, people: DataFrame | None = None) -> DataFrame:
    """(key, seq, kind, url, speaker, person, content): speeches and other paragraphs of archived debates, in order.

    A speech is a div with class member_contribution: cite.member names who speaks (its link the person, as people (path,
    person_id) has it), the blockquote what. Other paragraphs are procedural; those without a class that follow one belong
    to it. url is that of the permanent link inside.
    """
    nodes = parsed(pages, key, html)
    tag = lambda name: F.col("tag") == name
    contribution = tag("div") & has_class("member_contribution")
    cite = (("descendant", contribution), ("descendant", tag("cite") & has_class("member")))
    speaker = with_text(select(nodes, key, *cite), nodes, key).select(key, "pre", trimmed("content").alias("speaker"))
    path = select(nodes, key, *cite, ("descendant", tag("a"))).select(key, "pre", F.regexp_extract(F.col("attrs")["href"], "([^/]+)/?$", 1).alias("path"))
    said = with_text(select(nodes, key, ("descendant", contribution), ("descendant", tag("blockquote"))), nodes, key).select(key, "pre", "content")
    permanent = select(nodes, key, ("descendant", tag("a") & (has_class("speech-permalink") | has_class("permalink")))).select(key, "pre", F.col("attrs")["href"].alias("url"))
    parts = speaker
    for more in (path, said, permanent):
        parts = parts.unionByName(more, allowMissingColumns=True)
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("pre"))).alias(c)
    spoken = enclosing(select(nodes, key, ("descendant", contribution)), parts, key).groupBy(key, "at").agg(*(first(c) for c in ("url", "speaker", "path", "content"))).withColumn("kind", F.lit("speech"))
    before = Window.partitionBy(key).orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    outside = F.coalesce(F.max(F.when(contribution, F.col("last"))).over(before) < F.col("pre"), F.lit(True))
    paras = nodes.withColumn("_outside", outside).filter(F.col("_outside") & tag("p"))
    follows = (F.col("place") - F.lag("place").over(Window.partitionBy(key, "parent").orderBy("place")) == 1) & ~F.map_contains_key("attrs", F.lit("class"))
    headed = with_text(paras.withColumn("_head", ~F.coalesce(follows, F.lit(False))), nodes, key)
    grouped = headed.withColumn("at", F.max(F.when(F.col("_head"), F.col("pre"))).over(Window.partitionBy(key).orderBy("pre")))
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pre", trimmed("content").alias("c")))), lambda x: x["c"]), "\n")
    told = grouped.groupBy(key, "at").agg(lines.alias("content"))
    at = enclosing(paras, permanent, key).select(key, F.col("at").alias("pre"), "url").join(grouped.select(key, "pre", "at"), [key, "pre"]).groupBy(key, "at").agg(F.min_by("url", "pre").alias("url"))
    linked = told.join(at, [key, "at"], "left")
    rows = spoken.unionByName(linked.withColumn("kind", F.lit("procedural")), allowMissingColumns=True)
    if people is not None:
        rows = rows.join(people.select("path", F.col("person_id").alias("person")), "path", "left")
    else:
        rows = rows.withColumn("person", F.lit(None).cast("string"))
    return rows.filter(trimmed(F.coalesce("content", F.lit(""))) != "").select(key, F.col("at").alias("seq"), "kind", "url", "speaker", "person", trimmed("content").alias("content"))
