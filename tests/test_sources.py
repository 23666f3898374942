"""Readers and writers on small files of each format."""

import json
import zipfile

from pyspark.sql import functions as F

from hustings.sources import files, pages, records, shared


def test_people_document(spark, tmp_path):
    doc = {"persons": [{"id": "p1", "other_names": [{"note": "Main", "family_name": "Other", "given_name": "Ann"}]}, {"id": "p2", "redirect": "p1"}], "memberships": [{"id": "m1", "person_id": "p1", "start_date": "1997-05-01", "end_date": "2001"}], "organizations": []}
    (tmp_path / "people.json").write_text(json.dumps(doc, indent=2))
    got = records.people(spark, str(tmp_path / "people.json"))
    assert [r.id for r in got["persons"].filter("redirect is null").collect()] == ["p1"] and got["memberships"].first().end_date == "2001"
    assert got["posts"].count() == 0 and got["organizations"].count() == 0


def test_json_items_and_maps(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data": {"rows": [{"id": 1, "t": "x"}, {"id": 2}]}}')
    (tmp_path / "b.json").write_text('[{"id": 3, "t": "y"}]')
    got = records.json_items(spark, str(tmp_path / "*.json"), "struct<id: int, t: string>", "data.rows")
    assert sorted((r.id, r.t) for r in got.collect()) == [(1, "x"), (2, None), (3, "y")]
    (tmp_path / "m.txt").write_text('{"k": "v", "l": "w"}')
    assert {r.key: r.value for r in records.json_map(spark, str(tmp_path / "m.txt")).collect()} == {"k": "v", "l": "w"}


def test_xml_sidecars(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes('<?xml version="1.0" encoding="ISO-8859-1"?><people><personinfo id="p1" wiki="É"/><personinfo id="p2"/></people>'.encode("latin-1"))
    (tmp_path / "b.xml").write_text('<people><personinfo id="p2" wiki="B" blog="C"/></people>')
    a, b = records.person_info(spark, str(tmp_path / "a.xml"), ["wiki"]), records.person_info(spark, str(tmp_path / "b.xml"), ["wiki", "blog"])
    people = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "id string")
    assert sorted(map(tuple, records.sidecar(people, [a, b]).collect())) == [("p1", "É", None), ("p2", "B", "C"), ("p3", None, None)]


def test_delimited_with_short_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"A, b"\n2\n3,\n')
    assert [tuple(r) for r in records.delimited(spark, str(tmp_path / "a.csv"), "id int, name string").collect()] == [(1, "A, b"), (2, None), (3, None)]


def test_dump(spark, tmp_path):
    (tmp_path / "d.sql").write_text("CREATE TABLE page (a int);\nINSERT INTO `page` VALUES (1,'It''s (a) \\'t\\', x',NULL),(2,'b',3.5);\nINSERT INTO other VALUES (9,'z',0);\n")
    assert [tuple(r) for r in records.dump_rows(spark, str(tmp_path / "d.sql"), "page", ["a", "b", "c"]).collect()] == [("1", "It's (a) 't', x", None), ("2", "b", "3.5")]


def test_dated_files_and_revisions(spark, tmp_path):
    for name in ("debates2024-03-05.xml", "debates2024-03-05b.xml", "debates2024-03-05a.xml", "wms2024-03-06.xml", "wms2024-13-06.xml", "notes.txt"):
        (tmp_path / name).write_text("x")
    found = files.dated_files(spark, str(tmp_path))
    assert found.count() == 4
    assert sorted(r.path.rsplit("/", 1)[1] for r in files.latest_revisions(found).collect()) == ["debates2024-03-05b.xml", "wms2024-03-06.xml"]


def test_stale_inputs(spark):
    table = lambda rows: spark.createDataFrame(rows, "path string, modified int")
    stem = F.regexp_extract("path", r"([^/.]+)\.\w+$", 1)
    got = files.stale(table([("i/a.html", 5), ("i/b.html", 5), ("i/c.html", 5), ("i/d.html", 1)]), table([("o/a.xml", 9), ("o/b.xml", 3), ("o/d.xml", 2)]), stem, table([("p/d.patch", 7)]))
    assert sorted(r.stem for r in got.collect()) == ["b", "c", "d"]


def test_nested_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "inner.bin", "w") as z:
        z.writestr("deep.xml", "<b/>")
    with zipfile.ZipFile(tmp_path / "outer.zip", "w") as z:
        z.writestr("a.xml", "<a/>")
        z.write(tmp_path / "inner.bin", "inner.zip")
        z.writestr("skip.txt", "")
    assert sorted((r.name, r.content) for r in files.unzipped(spark, str(tmp_path)).collect()) == [("a.xml", "<a/>"), ("deep.xml", "<b/>")]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, k string, v string")
    files.write_new_partitions(df, str(tmp_path / "parts"), "k")
    files.write_new_partitions(df.withColumn("v", F.lit("changed")).union(spark.createDataFrame([(3, "c", "z")], df.schema)), str(tmp_path / "parts"), "k")
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "parts")).collect()) == ["x", "y", "z"]
    files.write_sorted(df, str(tmp_path / "sorted"), "id")
    assert spark.read.parquet(str(tmp_path / "sorted")).count() == 2
    files.write_json_lines(df, str(tmp_path / "json"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "json")).collect())[0] == '{"id":1,"k":"a","v":"x"}'
    files.write_xml(df, str(tmp_path / "xml"), "row", "rows")
    assert spark.read.format("xml").option("rowTag", "row").load(str(tmp_path / "xml")).count() == 2
    two = files.both_languages(spark.createDataFrame([(1, "hello", ""), (2, "yes", "ie")], "id int, e string, c string"), {"text": {"en": "e", "cy": "c"}})
    assert sorted((r.id, r.lang, r.text, r.fell_back) for r in two.collect()) == [(1, "cy", "hello", True), (1, "en", "hello", False), (2, "cy", "ie", False), (2, "en", "yes", False)]


def test_html_tables(spark):
    html = "<table><tr><th>A<th>B<tr><td>1<td>2 <table><tr><td>in</table></table><p>x<table><tr><td>z</td></tr></table>"
    got = pages.html_tables(spark.createDataFrame([(7, html), (8, None)], "id int, html string"), "id", "html").collect()
    assert [(r.table_no, r.row_no, r.column_no, r.value) for r in got] == [(0, 0, 0, "A"), (0, 0, 1, "B"), (0, 1, 0, "1"), (0, 1, 1, "2 in"), (1, 0, 0, "z")]


def test_pages_are_fetched_in_stretches(spark):
    fetch = lambda skip, take: [(i,) for i in range(skip, min(skip + take, 1000))]
    for size, most, tasks in ((1, 256, 250), (3, 4, 4), (400, 256, 3)):
        df = pages.paged_source(spark, fetch, "id int", total=1000, page_size=size, partitions=most)
        assert df.rdd.getNumPartitions() == tasks and sorted(r.id for r in df.collect()) == list(range(1000))


def test_paged_source(spark):
    def fetch(skip, take):
        return [(i, f"row {i}") for i in range(skip, min(skip + take, 25))]

    assert sorted(r.id for r in pages.paged_source(spark, fetch, "id int, name string", total=25, page_size=10).collect()) == list(range(25))


def test_shared_folder_is_the_clusters(spark):
    assert shared.shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_pages_until_an_empty_one_and_by_cursor(spark):
    from hustings.sources import pages

    by_skip = pages.walked_source(spark, pages.until_empty(lambda skip, take: [(i,) for i in range(skip, min(skip + take, 23))], 5), "n long", 0)
    assert sorted(r.n for r in by_skip.collect()) == list(range(23))
    book = {"": ([(1,), (2,)], "x"), "x": ([(3,)], "y"), "y": ([], None)}
    assert sorted(r.n for r in pages.walked_source(spark, lambda cursor: book[cursor], "n long").collect()) == [1, 2, 3]
