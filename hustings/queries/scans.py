"""Scans of documents in the formats that sources reads, made from whole tables and read back."""

from pyspark.sql import functions as F

from hustings.queries import query
from hustings.sources import documents, files, pages, records
from hustings.sources.shared import shared_folder


def texts(t, df, by, lines, begin="", end="", sep="\n"):
    """Files at a new path, one text for each value of by (so none holds the whole table), of lines in order."""
    path = f"{shared_folder(t.spark)}/texts"
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(lines.alias("x")))), lambda r: r["x"]), sep)
    whole = df.groupBy(by.alias("_by")).agg(F.concat(F.lit(begin), body, F.lit(end)).alias("value"))
    whole.repartition("_by").write.partitionBy("_by").option("lineSep", "\n").text(path)
    return path


def block():
    return F.col("c_custkey") % 50


@query("""SELECT 'membership' AS kind, 'm' || c_custkey AS id, 'p' || c_custkey AS person, CAST(c_nationkey AS VARCHAR) AS detail FROM customer UNION ALL SELECT 'person', 'p' || c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'p1' END, c_name FROM customer""")
def people_documents(t):
    """Documents of several collections: people with names and redirects, and their memberships."""
    k = F.col("c_custkey").cast("string")
    person = F.to_json(F.struct(F.concat(F.lit("p"), k).alias("id"), F.when(F.col("c_custkey") % 10 == 0, "p1").alias("redirect"), F.array(F.struct(F.lit("Main").alias("note"), F.col("c_name").alias("name"))).alias("other_names")))
    member = F.to_json(F.struct(F.concat(F.lit("m"), k).alias("id"), F.concat(F.lit("p"), k).alias("person_id"), F.col("c_nationkey").cast("string").alias("post_id")))
    one = F.concat(F.lit('{"persons": ['), person, F.lit('], "memberships": ['), member, F.lit("]}"))
    path = f"{shared_folder(t.spark)}/people"
    t("customer").select(one.alias("value")).repartition(8).write.option("lineSep", "\n").text(path)
    found = {n: t.spark.read.schema(", ".join(f"{c} array<{kind}>" for c, kind in records.PEOPLE.items())).json(path).select(F.inline(n)) for n in ("persons", "memberships")}
    names = found["persons"].select(F.lit("person").alias("kind"), "id", F.col("redirect").alias("person"), F.get("other_names", F.lit(0))["name"].alias("detail"))
    return found["memberships"].select(F.lit("membership").alias("kind"), "id", F.col("person_id").alias("person"), F.col("post_id").alias("detail")).union(names)


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def json_arrays(t):
    """Files that hold an array under an envelope, read against a contract."""
    item = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")))
    path = texts(t, t("customer"), block(), item, '{"total": 1, "items": [', "]}", ",")
    return records.json_items(t.spark, path, "struct<id: long, name: string, balance: double>", "items")


@query("SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment AS value FROM customer")
def json_maps(t):
    """Objects of strings as rows of keys and values."""
    pair = F.concat(F.lit('"'), F.col("c_custkey").cast("string"), F.lit('": "'), "c_mktsegment", F.lit('"'))
    return records.json_map(t.spark, texts(t, t("customer"), block(), pair, "{", "}", ","))


@query("SELECT 'p' || c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS party, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS site FROM customer")
def person_sidecars(t):
    """Sidecar elements with attributes of people, those that lack one null."""
    attribute = lambda n, keep, c: F.when(keep, F.concat(F.lit(f' {n}="'), c, F.lit('"'))).otherwise("")
    k = F.col("c_custkey")
    element = F.concat(F.lit('<personinfo id="p'), k.cast("string"), F.lit('"'), attribute("party", k % 2 == 0, F.col("c_mktsegment")), attribute("site", k % 3 == 0, F.col("c_name")), F.lit("/>"))
    return records.person_info(t.spark, texts(t, t("customer"), block(), element, "<publicwhip>\n", "\n</publicwhip>"), ["party", "site"])


@query("SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'speech' WHEN o_orderkey % 3 = 1 THEN 'question' ELSE 'answer' END AS tag, o_orderkey AS id, o_orderpriority AS body FROM orders")
def xml_elements(t):
    """Elements of three names, read into one table."""
    k = F.col("o_orderkey")
    tag = F.when(k % 3 == 0, "speech").when(k % 3 == 1, "question").otherwise("answer")
    element = F.concat(F.lit("<"), tag, F.lit(' id="'), k.cast("string"), F.lit('"><body>'), "o_orderpriority", F.lit("</body></"), tag, F.lit(">"))
    path = texts(t, t("orders"), F.col("o_custkey") % 40, element, "<day>\n", "\n</day>")
    return records.xml_rows(t.spark, path, ["speech", "question", "answer"], "_id long, body string").select("tag", F.col("_id").alias("id"), "body")


@query("SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS seat FROM customer")
def delimited_rows(t):
    """TSV rows, blanks null, read with a given schema."""
    k = F.col("c_custkey")
    line = F.concat_ws("\t", k.cast("string"), "c_name", F.when(k % 4 != 0, F.col("c_nationkey").cast("string")).otherwise(""))
    return records.delimited(t.spark, texts(t, t("customer"), block(), line), "id long, name string, seat int", "\t", header=False).select("id", "name", "seat")


@query("SELECT CAST(c_custkey AS VARCHAR) AS page_id, 'It''s (' || c_name || '), ok' AS title, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS latest FROM customer")
def dump_inserts(t):
    """Rows of a SQL dump's inserts, with quotes and brackets in strings."""
    k = F.col("c_custkey")
    values = F.concat(F.lit("("), k.cast("string"), F.lit(", 'It''s ("), "c_name", F.lit("), ok', "), F.when(k % 5 != 0, F.col("c_nationkey").cast("string")).otherwise("NULL"), F.lit(")"))
    path = texts(t, t("customer"), block(), values, "INSERT INTO `page` VALUES ", ";", ",")
    return records.dump_rows(t.spark, path, "page", ["page_id", "title", "latest"])


@query("SELECT p_partkey AS page, 0 AS table_no, CAST(i AS INTEGER) AS row_no, CAST(j AS INTEGER) AS column_no, CASE WHEN i = 0 THEN CASE j WHEN 0 THEN 'Name' ELSE 'Size' END WHEN j = 0 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS value FROM part, (VALUES (0), (1)) AS a(i), (VALUES (0), (1)) AS b(j)")
def html_cells(t):
    """Cells of tables in pages with unclosed tags."""
    page = F.concat(F.lit("<p>x<table><tr><th>Name<th>Size<tr><td>"), "p_name", F.lit("<td><b>"), F.col("p_size").cast("string"), F.lit("</b></table>"))
    return pages.html_tables(t("part").select(F.col("p_partkey").alias("page"), page.alias("html")), "page", "html")


@query("SELECT p_partkey AS n FROM part WHERE p_partkey < (SELECT count(*) FROM part)")
def paged_rows(t):
    """Pages of an interface, as many as its total says, fetched in stretches."""
    total = t("part").count()
    every = pages.paged_source(t.spark, lambda skip, take: [(i,) for i in range(skip, min(skip + take, total))], "n long", total, 64)
    return every.join(t("part").select(F.col("p_partkey").alias("n")), "n", "left_semi")


@query("SELECT 'debates' AS kind, CAST(o_orderdate AS VARCHAR)[1:10] AS day, max(CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE chr(96 + CAST(o_orderkey % 4 AS INTEGER)) END) AS revision, arg_max(n, r) AS n FROM (SELECT *, o_orderkey % 4 AS r, count(*) OVER (PARTITION BY CAST(o_orderdate AS VARCHAR)[1:10], o_orderkey % 4) AS n FROM orders) GROUP BY 2")
def latest_files(t):
    """Of files named by day and revision, written from all orders, the last of each day, and how many orders it holds."""
    path, r = f"{shared_folder(t.spark)}/days", (F.col("o_orderkey") % 4).cast("int")
    name = F.concat(F.lit("debates"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(r == 0, "").otherwise(F.char(r + 96)))
    rows = t("orders").select(name.alias("key"), F.col("o_orderkey").alias("seq"), F.lit("order").alias("element"), F.create_map(F.lit("id"), F.col("o_orderkey").cast("string")).alias("attrs"), F.lit(None).cast("string").alias("content"))
    documents.write_documents(rows, path, root="day")
    last = files.latest_revisions(files.dated_files(t.spark, path))
    held = t.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.size(F.regexp_extract_all(F.decode("content", "UTF-8"), F.lit("<order "), F.lit(0))).cast("long").alias("n"))
    return last.join(held, "path").select("kind", F.col("day").cast("string"), "revision", "n")
