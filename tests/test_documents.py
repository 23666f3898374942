"""Patches, markup folds, deep registers and the document writer against plain versions."""

import json
import random
import re
import xml.etree.ElementTree as ET
from difflib import unified_diff

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hustings.functions import blocks, patches
from hustings.plans import registers
from hustings.sources import documents


def test_patches_apply_and_come_off_again():
    rng = random.Random(4)
    for _ in range(300):
        old = [rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 30))]
        new = [x for x in old if rng.random() > 0.1]
        for _ in range(rng.randrange(4)):
            new.insert(rng.randrange(len(new) + 1), f"new{rng.randrange(99)}")
        a, b = "\n".join(old), "\n".join(new)
        patch = "\n".join(unified_diff(a.split("\n"), b.split("\n"), lineterm=""))
        n = patch.count("\n@@ ")
        assert patches.applied(a, patch) == (b, n, [])
        assert patches.applied(b, patch, reverse=True) == (a, n, [])


def test_patches_find_moved_places_and_reject_others():
    patch = "@@ -2,3 +2,3 @@\n two\n-three\n+THREE\n four\n@@ -9 +9 @@\n-nine\n+NINE\n"
    moved = "\n".join(["x", "y", "one", "two", "three", "four", "z", "nine"])
    assert patches.applied(moved, patch) == ("x\ny\none\ntwo\nTHREE\nfour\nz\nNINE", 2, [])
    assert patches.applied("two\nthree\nfive\nnine", patch) == ("two\nthree\nfive\nNINE", 1, [0])
    assert patches.applied("", patch) == ("", 0, [0, 1])
    # Hunks go in order: what stands before the last one is not looked at.
    assert patches.applied("b\na", "@@ -1 +1 @@\n-a\n+A\n@@ -2 +2 @@\n-b\n+B\n") == ("b\nA", 1, [1])
    assert patches.applied("a\nb", "@@ -1,0 +2,2 @@\n+x\n+y\n") == ("a\nx\ny\nb", 1, [])


def test_patched_tables_and_their_rejects(spark):
    docs = spark.createDataFrame([(1, "a\nb"), (2, "a"), (3, None), (4, "c")], "id int, text string")
    diffs = spark.createDataFrame([(1, "1.patch", "@@ -1 +1 @@\n-a\n+A\n"), (1, "2.patch", "@@ -1 +1 @@\n-A\n+AA\n@@ -2 +2 @@\n-z\n+Z\n"), (2, "1.patch", "@@ -1 +1 @@\n-b\n+B\n"), (3, "1.patch", "@@ -1 +1 @@\n-b\n+B\n")], "id int, name string, patch string")
    done, rejects = patches.with_patches(docs, diffs, "id")
    assert sorted(tuple(r) for r in done.collect()) == [(1, "AA\nb"), (2, "a"), (3, None), (4, "c")]
    assert sorted(tuple(r) for r in rejects.collect()) == [(1, "2.patch", 1), (2, "1.patch", 0), (3, "1.patch", 0)]


def nests(html):
    open_ = []
    for close, name in re.findall(r"<(/?)(\w+)", html):
        if close:
            if not open_ or open_.pop() != name:
                return False
        else:
            open_.append(name)
    return not open_


def test_inline_tags_are_balanced(spark):
    rng = random.Random(2)
    for _ in range(500):
        html = "".join(rng.choice(["<i>", "</i>", "<B>", "</b>", '<a class="x" href="/y?a&amp;b">', "</a>", "<sup>", "</sup>", "<font size=2>", "</font>", "word ", "&amp;"]) for _ in range(rng.randrange(15)))
        got = blocks.balanced(html)
        assert nests(got) and re.sub("<[^>]*>", "", got) == re.sub("<[^>]*>", "", html) and blocks.balanced(got) == got
        if nests(html.lower()) and "font" not in html:
            assert got == html.replace("<B>", "<b>").replace(' class="x"', "")
    assert blocks.balanced("<i>a<b>c</i>d</b>") == "<i>a<b>c</b></i>d" and blocks.balanced("<A HREF=x>y") == '<a href="x">y</a>'
    rows = spark.createDataFrame([("<i>x",), (None,), ("plain",)], "s string").select(blocks.straightened(F.col("s")).alias("s")).collect()
    assert [r["s"] for r in rows] == ["<i>x</i>", None, "plain"]


def test_paragraphs_have_depths():
    html = "One<p>two <i>three</i><ul><li>a<ul><li>b</ul>c</ul><p style='margin-left: 20px;'>far</p>near<p><i>All so</i>.<p> &nbsp; <table><tr><td>1</table>last<ul><i>deep</i></ul></ul></ul>end"
    assert blocks.parted(html) == [
        ("para", 0, 0, "One"), ("para", 0, 0, "two <i>three</i>"), ("para", 1, 1, "a"), ("para", 2, 1, "b"), ("para", 1, 1, "c"), ("para", 0, 1, "far"), ("para", 0, 0, "near"),
        ("para", 0, 2, "All so"), ("table", 0, 0, "<table><tr><td>1</table>"), ("para", 0, 0, "last"), ("para", 1, 3, "deep"), ("para", 0, 0, "end"),
    ]


NODES = T.StructType([T.StructField("doc", T.StringType()), T.StructField("id", T.StringType()), T.StructField("parent", T.StringType()), T.StructField("slot", T.StringType()), T.StructField("place", T.IntegerType()), T.StructField("body", T.MapType(T.StringType(), T.StringType()))])


def test_registers_of_any_depth(spark):
    rng, rows, want = random.Random(6), [], {}
    for d in range(8):
        made = {"r": {"name": f"<{d}> \"q\" é"}}
        want[f"d{d}"] = made["r"]
        rows.append((f"d{d}", "r", None, None, 0, dict(made["r"])))
        for n in range(rng.randrange(40)):
            parent, slot = rng.choice(sorted(made)), rng.choice(registers.SLOTS)
            body = rng.choice([{}, {"id": str(n)}, {"id": str(n), "text": "a,[b]{c}"}])
            node = dict(body)
            kin = made[parent].setdefault(slot, [])
            rows.append((f"d{d}", f"n{n}", parent, slot, len(kin), body))
            kin.append(node)
            made[f"n{n}"] = node
    nodes = spark.createDataFrame(rows, NODES).repartition(3)
    made = registers.nested_documents(nodes, "doc").checkpoint()
    assert {r["doc"]: json.loads(r["document"]) for r in made.collect()} == want
    flat = registers.flat_documents(made, "doc").collect()
    assert len(flat) == len(rows)
    again = spark.createDataFrame([(r["doc"], r["path"], r["above"], r["slot"], r["place"], r["body"]) for r in flat], NODES)
    assert {r["doc"]: json.loads(r["document"]) for r in registers.nested_documents(again, "doc").collect()} == want
    assert registers.nested_documents(nodes.limit(0), "doc").count() == 0
    ring = spark.createDataFrame([("d", "a", "b", "items", 0, {}), ("d", "b", "a", "items", 0, {})], NODES)
    with pytest.raises(ValueError, match="ring"):
        registers.nested_documents(ring, "doc")


def test_registers_are_taken_apart_where_they_lie(spark):
    documents_ = [("a", '{"value": "[not a list]", "n": 1.50, "o": {"details": [1]}, "details": [ {"x": null} , 7, {"items":[{}]}]} '), ("b", "no JSON"), ("c", None)]
    flat = registers.flat_documents(spark.createDataFrame(documents_, "doc string, document string"), "doc")
    assert "Exchange" not in flat._jdf.queryExecution().executedPlan().toString()
    got = {(r["doc"], r["path"]): (r["above"], r["slot"], r["place"], r["level"], r["body"]) for r in flat.collect()}
    assert got == {
        ("a", "0"): (None, None, 0, 0, {"value": "[not a list]", "n": "1.5", "o": '{"details":[1]}'}), ("a", "0.details:0"): ("0", "details", 0, 1, {"x": None}), ("a", "0.details:1"): ("0", "details", 1, 1, None),
        ("a", "0.details:2"): ("0", "details", 2, 1, {}), ("a", "0.details:2.items:0"): ("0.details:2", "items", 0, 2, {}), ("b", "0"): (None, None, 0, 0, None), ("c", "0"): (None, None, 0, 0, None),
    }


def test_documents_of_families_keep_their_columns(spark):
    nodes = spark.createDataFrame([("d", "a", None, None, 0, {"n": "1"}), ("d", "b", "gone", "items", 0, {}), ("d", "c", "a", "items", 1, None), ("d", "e", "a", "items", 0, {"m": "2"}), (None, "a", "a", "items", 0, {})], NODES)
    made = registers.documents_of(registers.gathered(nodes, "doc").withColumn("many", F.size("nodes")), "doc")
    assert "Exchange hashpartitioning(doc" in made._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, made.collect()), key=str) == [("d", "a", '{"n":"1","items":[{"m":"2"}]}', 4), ("d", "b", "{}", 4), (None, "a", "{}", 1)]
    with pytest.raises(ValueError, match="share"):
        registers.nested_documents(nodes.union(nodes), "doc")


def rows_of(spark):
    rows = [("2024-01-01", 2, "speech", {"id": "b", "a": "x\"<&"}, "two <i>x</i>"), ("2024-01-01", 1, "speech", {"id": "a", "none": None}, None), ("a/b é", 1, "p", None, "x"), (None, 1, "p", None, "lost")]
    return spark.createDataFrame(rows, documents.COLUMNS)


def test_documents_are_written_and_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    for _ in range(2):
        documents.write_documents(rows_of(spark), path, root="day", entities=True, mode="overwrite")
    found = {f.name: f.read_text() for f in (tmp_path / "out").rglob("*.xml")}
    assert sorted(found) == ["2024-01-01.xml", "a%2f_b%20_%e9_.xml"]
    assert found["2024-01-01.xml"].endswith('<day>\n<speech id="a"/>\n<speech a="x&quot;&lt;&amp;" id="b">two <i>x</i></speech>\n</day>\n')
    assert ET.fromstring(found["2024-01-01.xml"].replace("two", "two &nbsp;"))[1].text == "two \xa0 "
    assert not (tmp_path / "out" / documents.STAGING).exists()


def test_a_task_that_dies_leaves_nothing(spark, tmp_path):
    writer = documents.DocumentWriter({"path": str(tmp_path)}, False)
    rows = documents.ordered(rows_of(spark)).collect()

    def dies():
        yield from rows[:2]
        raise OSError("executor lost")

    with pytest.raises(OSError):
        writer.write(dies())
    writer.commit([writer.write(iter(rows)), writer.write(iter([])), None])
    assert len(list(tmp_path.rglob("*.xml"))) == 2 and len(list(tmp_path.glob("part-*"))) == 1
    other = documents.DocumentWriter({"path": str(tmp_path)}, True)
    other.abort([other.write(iter(rows))])
    assert len(list(tmp_path.rglob("*.xml"))) == 2
