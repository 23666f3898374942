"""Keyed tables: lookups, cascades, pivots, upserts, versions, sets, ranks, checks."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from hustings.operators import sequences, tables
from hustings.queries import query


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'")
def broadcast_lookup(t):
    return t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).filter("r_name <> 'ASIA'").select("n_name", "r_name")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def semi_join(t):
    return t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def anti_join(t):
    urgent = t("orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return t("customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right' ELSE 'left' END AS only_in FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') a
FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'A') b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def symmetric_difference(t):
    side = lambda flag: t("lineitem").filter(F.col("l_returnflag") == flag).select(F.col("l_orderkey").alias("k"))
    return tables.symmetric_difference(side("R"), side("A"), "k")


@query("SELECT c_custkey, coalesce(max(o_orderkey), c_custkey) AS target FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def redirect_coalesce(t):
    last = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("m"))
    return t("customer").join(last, "c_custkey", "left").select("c_custkey", F.coalesce("m", "c_custkey").alias("target"))


@query("""WITH RECURSIVE hop AS (SELECT p_partkey AS k, p_partkey AS place FROM part UNION ALL SELECT k, CAST(place / 2 AS BIGINT) FROM hop WHERE place % 2 = 0 AND place > 0) SELECT k AS p_partkey, min(place) AS target FROM hop GROUP BY k""")
def redirect_chase(t):
    """Even keys are merged into their half, again and again, until an odd one is reached."""
    parts = t("part").select("p_partkey")
    moves = parts.filter("p_partkey % 2 = 0 and p_partkey > 0").select(F.col("p_partkey").alias("source"), F.expr("p_partkey div 2").alias("target"))
    return tables.redirected(parts.withColumn("at", F.col("p_partkey")), moves, "at").select("p_partkey", F.col("at").alias("target"))


PROBES = "probes AS (SELECT p_partkey + 1000000 AS id, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE 'Brand#99' END AS brand, p_type AS kind, CASE WHEN p_partkey % 5 = 0 THEN 'none such' ELSE p_name END AS called FROM part)"


def probes(t):
    c = F.col
    return t("part").select((c("p_partkey") + 1000000).alias("id"), c("p_name").alias("name"), F.when(c("p_partkey") % 3 == 0, c("p_brand")).otherwise("Brand#99").alias("brand"), c("p_type").alias("kind"), F.when(c("p_partkey") % 5 == 0, "none such").otherwise(c("p_name")).alias("called"))


CLASSES = f"""WITH {PROBES}, f AS (SELECT p_name, p_brand, min(p_partkey) AS class_id, count(*) AS n FROM part GROUP BY 1, 2), n AS (SELECT p_name, min(p_partkey) AS class_id, count(*) AS n FROM part GROUP BY 1),
k AS (SELECT p_type, min(p_partkey) AS class_id, count(*) AS n FROM part GROUP BY 1),
c AS (SELECT id, 1 AS priority, class_id, n FROM probes JOIN f ON called = p_name AND brand = p_brand UNION ALL SELECT id, 2, class_id, n FROM probes JOIN n ON called = p_name UNION ALL SELECT id, 3, class_id, n FROM probes JOIN k ON kind = p_type),
best AS (SELECT * FROM c WHERE (id, priority) IN (SELECT id, min(priority) FROM c GROUP BY id))"""


def alias_classes(t):
    """For each rule of the cascade its columns and (those, class_id, n): all parts that bear an alias are one class, named
    by its smallest key."""
    every = [["p_name", "p_brand"], ["p_name"], ["p_type"]]
    return [(c, t("part").groupBy(*c).agg(F.min("p_partkey").alias("class_id"), F.count("*").alias("n"))) for c in every]


def classes_by_rules(t):
    (_, full), (_, name), (_, kind) = alias_classes(t)
    c = F.col
    held = lambda df: df.select("*", F.struct("class_id", "n").alias("found")).drop("class_id", "n")
    rules = [(held(full), (c("called") == c("p_name")) & (c("brand") == c("p_brand"))), (held(name), c("called") == c("p_name")), (held(kind), c("kind") == c("p_type"))]
    return tables.cascade(probes(t), "id", rules, "found").select("id", "priority", "found.*")


@query(CLASSES + " SELECT id, priority, class_id FROM best")
def cascade_join(t):
    """Parts found by name and brand, else by name, else by type: the class of all that a probe finds; alias_members has who
    is in it, so no candidate is left out and no pairs are made."""
    return classes_by_rules(t).select("id", "priority", "class_id")


@query("""SELECT 1 AS priority, min(p_partkey) OVER (PARTITION BY p_name, p_brand) AS class_id, p_partkey AS found FROM part UNION ALL SELECT 2, min(p_partkey) OVER (PARTITION BY p_name), p_partkey FROM part
UNION ALL SELECT 3, min(p_partkey) OVER (PARTITION BY p_type), p_partkey FROM part""")
def alias_members(t):
    """The parts of each class of cascade_join, three rows a part."""
    every = None
    for i, (columns, classes) in enumerate(alias_classes(t)):
        part = t("part").join(classes, columns).select(F.lit(i + 1).alias("priority"), "class_id", F.col("p_partkey").alias("found"))
        every = part if every is None else every.union(part)
    return every


@query(CLASSES + """ SELECT p.id, coalesce(n, 0) AS n_candidates, CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'match' ELSE 'multiple' END AS status, CASE WHEN n = 1 THEN class_id END AS match FROM probes p LEFT JOIN best ON best.id = p.id""")
def match_status(t):
    """How many parts match, from the classes' sizes; no pairs are made."""
    joined = probes(t).select("id").join(classes_by_rules(t), "id", "left")
    status = F.when(F.col("n").isNull(), "none").when(F.col("n") == 1, "match").otherwise("multiple")
    return joined.select("id", F.coalesce("n", F.lit(0)).cast("long").alias("n_candidates"), status.alias("status"), F.when(F.col("n") == 1, F.col("class_id")).alias("match"))


@query("""WITH c AS (SELECT l_orderkey AS id, l_partkey AS part, l_suppkey AS found FROM lineitem WHERE l_linenumber = 1), p AS (SELECT DISTINCT l_partkey AS part, l_suppkey AS found FROM lineitem), s AS (SELECT DISTINCT l_orderkey AS id, l_suppkey AS found FROM lineitem)
SELECT DISTINCT c.id, s.found FROM c JOIN p ON p.part = c.part JOIN s ON s.id = c.id AND s.found = p.found""")
def candidate_intersect(t):
    """Suppliers of an order that also supply the part of its first line: two clues, both with candidates."""
    line = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    first = line.filter("l_linenumber = 1").select(F.col("l_orderkey").alias("id"), "l_partkey")
    by_part = first.join(line.select("l_partkey", F.col("l_suppkey").alias("found")).distinct(), "l_partkey").select("id", "found")
    by_order = line.select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("found")).join(first.select("id"), "id", "left_semi")
    return tables.candidate_intersection([by_part, by_order], "id", "found")


@query("""WITH k AS (SELECT p_partkey, lower(translate(p_name, ',- ', '')) AS key FROM part), d AS (SELECT key, count(*) AS n, min(p_partkey) AS least FROM k GROUP BY key)
SELECT p_partkey, least, n FROM k JOIN d USING (key)""")
def normalized_key_join(t):
    from hustings.functions.text import strip_punctuation

    k = t("part").select("p_partkey", strip_punctuation(F.col("p_name")).alias("key"))
    return k.join(k.groupBy("key").agg(F.count("*").alias("n"), F.min("p_partkey").alias("least")), "key").select("p_partkey", "least", "n")


@query("SELECT user_id, " + ", ".join(f"max(CASE WHEN event_type = '{k}' THEN value END) AS {k}" for k in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY user_id")
def eav_pivot(t):
    return tables.eav_pivot(t("events"), "user_id", "event_type", "value", ["click", "error", "purchase", "signup", "view"])


@query("SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def latest_per_key(t):
    orders = t("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return tables.latest_per_key(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


@query("SELECT o_orderkey, o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey) AS is_latest FROM orders")
def is_latest_flag(t):
    return tables.flag_latest(t("orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate").select("o_orderkey", "is_latest")


@query("SELECT md5(text) AS digest, max(doc_id) AS newest, count(*) AS n_revisions FROM documents GROUP BY text")
def latest_revision(t):
    return t("documents").groupBy(F.md5("text").alias("digest")).agg(F.max("doc_id").alias("newest"), F.count("*").alias("n_revisions"))


@query("SELECT max(doc_id) AS doc_id FROM documents GROUP BY text")
def dedup_keep_latest(t):
    """The document with the highest doc_id of each text, by a hash of the text so that texts aren't shuffled."""
    return t("documents").groupBy(F.sha2("text", 256).alias("h")).agg(F.max("doc_id").alias("doc_id")).select("doc_id")


@query("SELECT doc_id, doc_id > min(doc_id) OVER (PARTITION BY text) AS is_duplicate FROM documents")
def flag_duplicates(t):
    docs = t("documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return tables.flag_duplicates(docs, F.col("h"), "doc_id").select("doc_id", "is_duplicate")


@query("SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(t):
    return tables.duplicate_keys(t("part"), ["p_name", "p_brand"])


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1")
def tally_by_choice(t):
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"))


@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 5")
def having_limit(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")).filter("n > 5")


@query("SELECT user_id, count(*) AS n, round(sum(value) / count(value), 6) AS rate FROM events GROUP BY 1")
def rate_per_key(t):
    return t("events").groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.try_divide(F.sum("value"), F.count("value")), 6).alias("rate"))


@query("SELECT o_custkey, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_day, min(o_totalprice) AS least, max(o_totalprice) AS most FROM orders GROUP BY 1")
def extents(t):
    day = lambda c: F.to_date(c).cast("string")
    return t("orders").groupBy("o_custkey").agg(day(F.min("o_orderdate")).alias("first_day"), day(F.max("o_orderdate")).alias("last_day"), F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"))


@query("SELECT l_suppkey, max_by(l_orderkey, (l_extendedprice, l_orderkey, l_linenumber)) AS l_orderkey, max(l_extendedprice) AS most FROM lineitem GROUP BY 1")
def arg_max(t):
    return t("lineitem").groupBy("l_suppkey").agg(F.max_by("l_orderkey", F.struct("l_extendedprice", "l_orderkey", "l_linenumber")).alias("l_orderkey"), F.max("l_extendedprice").alias("most"))


@query("SELECT r_name, string_agg(n_name, '; ' ORDER BY n_name) AS nations, bool_or(n_name LIKE 'A%') AS any_a, bool_and(n_nationkey >= 0) AS all_known FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def string_agg(t):
    joined = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(F.array_join(F.sort_array(F.collect_list("n_name")), "; ").alias("nations"), F.bool_or(F.col("n_name").like("A%")).alias("any_a"), F.bool_and(F.col("n_nationkey") >= 0).alias("all_known"))


@query("""SELECT o_custkey, count(DISTINCT o_orderkey) AS n_children, count(*) AS n_leaves, min(o_orderkey) AS first_child, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def nested_regroup(t):
    """Customers with their orders with their lines, nested; shown by what the nesting holds."""
    rows = t("orders").select("o_custkey", "o_orderkey").join(t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), F.col("o_orderkey") == F.col("l_orderkey"))
    tree = tables.nested(rows, ["o_custkey"], ["o_orderkey"], F.struct("l_linenumber", "l_quantity"))
    total = F.aggregate("children", F.lit(0.0), lambda n, c: n + F.aggregate(c["items"], F.lit(0.0), lambda m, i: m + i["l_quantity"]))
    leaves = F.aggregate("children", F.lit(0), lambda n, c: n + F.size(c["items"]))
    return tree.select("o_custkey", F.size("children").cast("long").alias("n_children"), leaves.cast("long").alias("n_leaves"), F.get("children", F.lit(0))["o_orderkey"].alias("first_child"), total.cast("long").alias("quantity"))


@query("""WITH p AS (SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_linenumber > 1 THEN l_orderkey * 10 + l_linenumber - l_linenumber % 2 END AS parent FROM lineitem)
SELECT c.parent, count(*) AS n_children, min(c.id) AS first_child, max(c.id) AS last_child, count(k.id) > 0 AS known FROM p c LEFT JOIN (SELECT DISTINCT id FROM p) k ON k.id = c.parent WHERE c.parent IS NOT NULL GROUP BY 1""")
def parent_children(t):
    n = F.col("l_linenumber")
    rows = t("lineitem").select((F.col("l_orderkey") * 10 + n).alias("id"), F.when(n > 1, F.col("l_orderkey") * 10 + n - n % 2).alias("parent"))
    return tables.parent_children(rows, "id", "parent")


@query("SELECT l_orderkey, l_linenumber, slug, value FROM lineitem UNPIVOT (value FOR slug IN (l_discount, l_tax))")
def unpivot_details(t):
    return tables.unpivot(t("lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax"), ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"])


def versions(t):
    o = t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    old = o.filter("o_orderdate < TIMESTAMP_NTZ'1999-01-01'")
    new = o.filter("o_orderdate >= TIMESTAMP_NTZ'1998-07-01'").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus")))
    return old.drop("o_orderdate"), new.drop("o_orderdate")


OLD_NEW = """old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
new AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01')"""


@query(f"WITH {OLD_NEW} SELECT * FROM new UNION ALL SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)")
def upsert_snapshot(t):
    return tables.upsert(*versions(t), ["o_orderkey"])


@query(f"""WITH {OLD_NEW} SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'rescinded'
WHEN o.o_orderstatus IS NOT DISTINCT FROM n.o_orderstatus AND o.o_totalprice IS NOT DISTINCT FROM n.o_totalprice THEN 'unchanged' ELSE 'update' END AS action FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey""")
def merge_actions(t):
    return tables.merge_actions(*versions(t), "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("""WITH h AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 3 <> 0), w AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'OTHER' ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 4 <> 0)
SELECT coalesce(h.k, w.k) AS k, w.v, CASE WHEN w.v IS NULL THEN 'clear' WHEN h.v IS NULL THEN 'set' WHEN h.v = w.v THEN 'keep' ELSE 'change' END AS action FROM h FULL JOIN w ON h.k = w.k""")
def attribute_sync(t):
    c = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    return tables.attribute_sync(c.filter("k % 3 <> 0"), c.filter("k % 4 <> 0").withColumn("v", F.when(F.col("k") % 5 == 0, "OTHER").otherwise(F.col("v"))), "k", "v")


@query("SELECT c_custkey, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY c_custkey) AS o_orderkey FROM customer")
def mint_ids(t):
    return tables.mint_ids(t("orders"), t("customer").select("c_custkey"), "o_orderkey", ["c_custkey"]).select("c_custkey", "o_orderkey")


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'SAME' WHEN 1 THEN 'EXTENSION' ELSE CASE WHEN length(text) = 0 THEN 'SAME' ELSE 'DIFFERENT' END END AS class FROM documents""")
def version_classify(t):
    """Each document against a new version: the same, with more at its end, or changed at its beginning."""
    text, k = F.col("text"), F.col("doc_id") % 3
    new = F.when(k == 0, text).when(k == 1, F.concat(text, F.lit(" more"))).otherwise(F.reverse(F.concat(F.reverse(F.substring(text, 2, 1 << 30)), F.when(text == "", "").otherwise("¤"))))
    return t("documents").select("doc_id", tables.version_class(text, new).alias("class"))


@query("SELECT doc_id FROM documents WHERE doc_id % 7 = 0 OR doc_id % 10 = 9")
def changed_documents(t):
    """What must be written anew: documents whose content changed, and those that the old table lacked."""
    docs = t("documents").select("doc_id", "text")
    new = docs.withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return tables.changed(docs.filter("doc_id % 10 <> 9"), new, "doc_id", "text").select("doc_id")


@query("SELECT doc_id, md5(text) AS digest, sha256(text) AS sha FROM documents")
def content_hash(t):
    return t("documents").select("doc_id", F.md5("text").alias("digest"), F.sha2("text", 256).alias("sha"))


@query("SELECT o_custkey AS k FROM orders UNION SELECT user_id FROM events")
def union_distinct(t):
    return t("orders").select(F.col("o_custkey").alias("k")).union(t("events").select("user_id")).distinct()


@query("SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events")
def set_intersect(t):
    return t("orders").select(F.col("o_custkey").alias("k")).intersect(t("events").select("user_id"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT user_id FROM events")
def set_except(t):
    return t("customer").select(F.col("c_custkey").alias("k")).subtract(t("events").select("user_id"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(t):
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("SELECT c_name, CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT) AS number FROM customer ORDER BY number")
def natural_sort(t):
    """Names in the order of the number that they end in."""
    return t("customer").select("c_name", F.regexp_extract("c_name", "([0-9]+)$", 1).cast("long").alias("number")).orderBy("number")


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)licen[cs]ed under')")
def regex_filter(t):
    return t("documents").filter(F.col("text").rlike("(?i)licen[cs]ed under")).select("doc_id")


@query("""SELECT o_orderkey FROM orders o JOIN (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS m FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey WHERE m > (CAST(o_orderdate AS DATE) + INTERVAL 60 DAY)::DATE""")
def stale_outputs(t):
    """Outputs (orders) that some input (a line) is newer than, by sixty days' grace."""
    newest = t("lineitem").groupBy("l_orderkey").agg(F.to_date(F.max("l_shipdate")).alias("m"))
    joined = t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("d")).join(newest, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.filter(F.col("m") > F.date_add("d", 60)).select("o_orderkey")


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' ELSE o_orderpriority END AS label FROM orders")
def vocab_map(t):
    words = F.create_map(*map(F.lit, ("1-URGENT", "now", "2-HIGH", "soon")))
    return t("orders").select("o_orderkey", F.coalesce(F.try_element_at(words, F.col("o_orderpriority")), "o_orderpriority").alias("label"))


@query("SELECT doc_id, CASE WHEN lang = 'de' THEN md5(text) ELSE md5('en') END AS shown, lang <> 'de' AS fell_back FROM documents")
def lang_fallback(t):
    own = F.when(F.col("lang") == "de", F.col("text"))
    return t("documents").select("doc_id", F.md5(F.coalesce(F.nullif(own, F.lit("")), F.lit("en"))).alias("shown"), own.isNull().alias("fell_back"))


@query("SELECT l_orderkey, l_linenumber, l_suppkey = first_value(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS is_primary FROM lineitem")
def signature_primary_flag(t):
    """Whether a line's supplier is that of the order's first line."""
    line = t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    first = line.groupBy("l_orderkey").agg(F.min_by("l_suppkey", F.struct("l_linenumber", "l_suppkey")).alias("_s"))
    return line.join(first, "l_orderkey").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") == F.col("_s")).alias("is_primary"))


@query("""SELECT o_custkey, place, a.o_orderkey AS urgent, b.o_orderkey AS low FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM orders WHERE o_orderpriority = '1-URGENT') a
FULL JOIN (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM orders WHERE o_orderpriority = '5-LOW') b USING (o_custkey, place)""")
def positional_join(t):
    side = lambda p, name: t("orders").filter(F.col("o_orderpriority") == p).select("o_custkey", F.col("o_orderkey").alias(name))
    a, b = side("1-URGENT", "urgent"), side("5-LOW", "low")
    ordered = lambda df, c: df.withColumn("_by", F.col(c))
    both = tables.positional(ordered(a, "urgent"), ordered(b, "low"), ["o_custkey"], "_by")
    return both.select("o_custkey", F.col("place").cast("long"), "urgent", "low")


@query("""SELECT 'doc_id is unique' AS rule, count(*) AS n_faulty, count(*) = 0 AS passed FROM (SELECT doc_id FROM documents GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'line has an order', count(*), count(*) = 0 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'n_chars is right', count(*), count(*) = 0 FROM documents WHERE length(text) <> n_chars
UNION ALL SELECT 'ships after order', count(*), count(*) = 0 FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate < o_orderdate
UNION ALL SELECT 'text is once', count(*), count(*) = 0 FROM (SELECT text FROM documents GROUP BY 1 HAVING count(*) > 1)""")
def quality_report(t):
    docs, line, orders = t("documents"), t("lineitem"), t("orders")
    joined = line.select("l_orderkey", "l_shipdate").join(orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return tables.report({
        "doc_id is unique": tables.duplicate_keys(docs, ["doc_id"]), "line has an order": line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti"),
        "n_chars is right": docs.filter(F.length("text") != F.col("n_chars")), "ships after order": joined.filter("l_shipdate < o_orderdate"), "text is once": docs.groupBy(F.sha2("text", 256)).count().filter("count > 1"),
    })


@query("SELECT event_type, list_sort(list(DISTINCT user_id % 10))::VARCHAR AS digits, count(*) AS n FROM events GROUP BY 1")
def collect_sets(t):
    digits = F.sort_array(F.collect_set(F.col("user_id") % 10))
    return t("events").groupBy("event_type").agg(F.concat(F.lit("["), F.array_join(digits.cast("array<string>"), ", "), F.lit("]")).alias("digits"), F.count("*").alias("n"))


@query("""SELECT l_suppkey, l_returnflag, n, place FROM (SELECT l_suppkey, l_returnflag, count(*) AS n, row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_suppkey) AS place FROM lineitem GROUP BY 1, 2) WHERE place <= 3""")
def top_per_group(t):
    n = t("lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
    return n.withColumn("place", F.row_number().over(Window.partitionBy("l_returnflag").orderBy(F.desc("n"), "l_suppkey")).cast("long")).filter("place <= 3")


@query("""WITH e AS (SELECT o_custkey, min(o_orderkey) AS first_seen, o_orderpriority FROM orders GROUP BY 1, 3) SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY first_seen) AS priorities FROM e GROUP BY 1""")
def ordered_multimap(t):
    """Groups in the order in which each was first seen."""
    seen = t("orders").groupBy("o_custkey", "o_orderpriority").agg(F.min("o_orderkey").alias("s"))
    pairs = F.sort_array(F.collect_list(F.struct("s", "o_orderpriority")))
    return seen.groupBy("o_custkey").agg(F.array_join(F.transform(pairs, lambda x: x["o_orderpriority"]), ",").alias("priorities"))
