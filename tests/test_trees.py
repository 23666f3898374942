"""Element trees against a parser of these tests' own, built on Python's tokenizer of HTML."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from hustings.plans import trees


class Plain(HTMLParser):
    """Nodes as nested lists [tag, attrs, children], text as strings, with the same mends."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = ["#document", {}, []]
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        ends = trees.CLOSES.get(tag, set())
        barrier = trees.SCOPES.get(tag, trees.LIMITS)
        depths = []
        for node in reversed(self.stack[1:]):
            if node[0] in barrier:
                break
            if node[0] in ends:
                depths.append(self.stack.index(node))
        if depths:
            del self.stack[min(depths) :]
        node = [tag, {k: v or "" for k, v in reversed(attrs)}, []]
        self.stack[-1][2].append(node)
        if tag not in trees.VOID:
            self.stack.append(node)

    def handle_endtag(self, tag):
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth][0] == tag:
                del self.stack[depth:]
                return

    def handle_data(self, data):
        self.stack[-1][2].append(data)


def plain(page):
    parser = Plain()
    parser.feed(page or "")
    parser.close()
    return parser.root


def content(node):
    return "".join(c if isinstance(c, str) else content(c) for c in node[2])


def walk(node):
    for c in node[2]:
        if not isinstance(c, str):
            yield c
            yield from walk(c)


def pages(rng, n):
    tags = ["p", "div", "ul", "li", "table", "tr", "td", "b", "a", "br", "i", "span", "h1", "blockquote"]
    out = []
    for _ in range(n):
        parts, opened = [], []
        for _ in range(rng.randrange(60)):
            kind = rng.random()
            if kind < 0.45:
                t = rng.choice(tags)
                parts.append(f"<{t}{rng.choice(['', ' class=\"x y\"', ' id=k', ' DATA-v=\'1 > 0\'', ' class=y href=\"/a?b&amp;c\"'])}>")
                opened.append(t)
            elif kind < 0.7 and opened:
                parts.append(f"</{opened.pop(rng.randrange(len(opened)))}>")
            elif kind < 0.75:
                parts.append(rng.choice(["<!-- <p> -->", "</nope>", "<script>if (a < b) '<p>';</script>", "<!DOCTYPE html>"]))
            else:
                parts.append(rng.choice(["word ", "a &amp; b ", "&copy;", " \n", "\u00e9 "]))
        out.append("".join(parts))
    return [*out, None, "", "no tags", "<p>one<p>two<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>1<td>2<tr><td>3</table>"]


def test_trees_and_selectors_equal_a_plain_parser(spark):
    rows = list(enumerate(pages(random.Random(3), 60)))
    nodes = trees.parsed(spark.createDataFrame(rows, "id long, html string").repartition(3), "id", "html").cache()
    got = {}
    for r in trees.with_text(nodes.filter("pre > 0"), nodes, "id").orderBy("id", "pre").collect():
        got.setdefault(r["id"], []).append((r["tag"], dict(r["attrs"]), r["content"]))
    for i, page in rows:
        assert got.get(i, []) == [(n[0], n[1], content(n)) for n in walk(plain(page))], page

    def brute(root, steps):
        """Each step from all nodes that the last one named."""
        parent = {id(root): None}
        for n in [root, *walk(root)]:
            for c in n[2]:
                if not isinstance(c, str):
                    parent[id(c)] = n
        met = [root]
        for axis, test in steps:
            new = []
            for n in walk(root):
                above, up = [], parent[id(n)]
                while up is not None:
                    above.append(up)
                    up = parent[id(up)]
                kin = [c for c in parent[id(n)][2] if not isinstance(c, str)]
                place = next(k for k, c in enumerate(kin) if c is n)
                near = {"descendant": above, "child": above[:1], "next": kin[max(0, place - 1) : place], "after": kin[:place]}[axis]
                if test(n) and any(m is x for m in met for x in near):
                    new.append(n)
            met = new
        return met

    tag = lambda name: (F.col("tag") == name, lambda n: n[0] == name)
    cls = lambda name: (trees.has_class(name), lambda n: name in n[1].get("class", "").split())
    anything = (F.lit(True), lambda n: True)
    for steps in (
        [("descendant", tag("div")), ("descendant", tag("b"))], [("descendant", tag("p")), ("child", anything)], [("descendant", tag("li")), ("next", tag("li"))],
        [("descendant", cls("x")), ("after", anything), ("descendant", cls("y"))], [("child", tag("p")), ("after", tag("p")), ("child", tag("a"))],
    ):
        found = trees.select(nodes, "id", *((axis, c) for axis, (c, _) in steps))
        counts = {r["id"]: r["count"] for r in found.groupBy("id").count().collect()}
        for i, page in rows:
            assert counts.get(i, 0) == len(brute(plain(page), [(axis, f) for axis, (_, f) in steps])), (steps, page)


def test_references_without_semicolon_stay_where_asked(spark):
    page = "<title>a &amp; b&amp</title><p class='&lt;&gt'>&#65;&#65 &eacute;&eacute"
    pages = spark.createDataFrame([(1, page)], "id long, html string")
    whole = lambda closed: [(r["text"], r["attrs"].get("class")) for r in trees.parsed(pages, "id", "html", closed).orderBy("pre").collect() if r["text"] or r["attrs"]]
    assert whole(True) == [("a & b&ampA&#65 \u00e9&eacute", None), (None, "<&gt")]
    assert whole(False) == [("a & b&AA \u00e9\u00e9", None), (None, "<>")]


def test_archived_debates(spark):
    page = """<h2>COAL</h2><p class="procedural" id="S1"><a class="permalink" href="/x#S1">\u00a7</a>House met<p>at two<p class="procedural">Prayers
    <div class="hentry member_contribution"><a name="c2"></a><cite class="member"><a href="/historic/people/mr-bee/">Mr Bee</a></cite><blockquote><p>I beg to move</p><p>this.</p></blockquote><a class="speech-permalink" href="/x#c2">link</a></div>
    <div class="member_contribution"><cite class="member">Hon. Members</cite><blockquote>Aye</blockquote></div><p class="procedural">Adjourned</p>"""
    people = spark.createDataFrame([("mr-bee", "p1")], "path string, person_id string")
    rows = trees.speeches(spark.createDataFrame([(1, page), (2, None)], "id long, html string"), "id", "html", people).orderBy("seq").collect()
    told = [(r["kind"], r["url"], r["speaker"], r["person"], r["content"].replace("\n", "|")) for r in rows]
    assert told == [
        ("procedural", "/x#S1", None, None, "\u00a7House met|at two"), ("procedural", None, None, None, "Prayers"),
        ("speech", "/x#c2", "Mr Bee", "p1", "I beg to movethis."), ("speech", None, "Hon. Members", None, "Aye"), ("procedural", None, None, None, "Adjourned"),
    ]


def test_nodes_of_pages_come_in_large_batches(spark):
    # A DataFrame for each page cost more time than its parsing.
    pages = [(1, "<p class='x y' id=a>One<br>two</p>"), (2, None), (None, ""), (4, "<ul><li>a<li>b</ul>")]
    found = trees.parsed(spark.createDataFrame(pages, "id int, html string"), "id", "html")
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    got = sorted(((r.id or 0, r.pre, r.last, r.parent, r.tag, r.attrs, r.start, r.end, r.text) for r in found.collect()), key=lambda r: r[:2])
    assert got == [
        (0, 0, 0, None, "#document", {}, 0, 0, ""), (1, 0, 2, None, "#document", {}, 0, 6, "Onetwo"), (1, 1, 2, 0, "p", {"class": "x y", "id": "a"}, 0, 6, None), (1, 2, 2, 1, "br", {}, 3, 3, None),
        (2, 0, 0, None, "#document", {}, 0, 0, ""), (4, 0, 3, None, "#document", {}, 0, 2, "ab"), (4, 1, 3, 0, "ul", {}, 0, 2, None), (4, 2, 2, 1, "li", {}, 0, 1, None), (4, 3, 3, 1, "li", {}, 1, 2, None),
    ]
