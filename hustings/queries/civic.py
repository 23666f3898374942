"""Plans for people, registers, answers and transcripts, over people and papers that the driver's tables stand for:
customers are people, nations seats, orders terms or papers, line items entries, events contributions."""

from pyspark.sql import functions as F

from hustings.functions import dates, markup, names, text
from hustings.operators import tables, temporal
from hustings.plans import linking, people, registers, resolution, transcripts
from hustings.queries import query
from hustings.sources import files
from hustings.sources.shared import shared_folder

DAY = "CAST(o_orderdate AS DATE)"


def day_of(c="o_orderdate"):
    return F.to_date(c)


@query("""SELECT c_custkey AS person_id, c_custkey % 3 = 0 AND c_nationkey < 10 AS ended_now, CASE WHEN c_custkey % 3 = 0 AND c_nationkey < 10 THEN '2020-01-31' WHEN c_custkey % 3 = 1 THEN '2019-12-31' END AS end_date FROM customer""")
def end_memberships(t):
    """All current members of some bodies end on a day, others stay as they are."""
    k = F.col("c_custkey")
    m = t("customer").select(k.alias("id"), k.alias("person_id"), "c_nationkey", F.when(k % 3 == 1, F.lit("2019-12-31").cast("date")).alias("end_date"), F.lit(None).cast("string").alias("end_reason"), (k % 3 == 0).alias("chosen"))
    done = people.end_memberships(m, F.col("chosen") & (F.col("c_nationkey") < 10), "2020-01-31", "dissolved")
    return done.select("person_id", F.col("end_reason").isNotNull().alias("ended_now"), F.col("end_date").cast("string"))


@query("""WITH m AS (SELECT c_custkey AS id, c_custkey AS person_id, c_mktsegment AS party, DATE '2015-05-07' AS s, CASE WHEN c_custkey % 4 = 0 THEN DATE '2019-01-01' END AS e FROM customer),
turned AS (SELECT * FROM m WHERE person_id % 3 = 0 AND e IS NULL AND party <> 'NEW')
SELECT m.id, m.person_id, m.party, CAST(s AS VARCHAR) AS start_date, CASE WHEN t.id IS NOT NULL THEN '2019-02-28' ELSE CAST(m.e AS VARCHAR) END AS end_date FROM m LEFT JOIN (SELECT id FROM turned) t ON t.id = m.id
UNION ALL SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY person_id), person_id, 'NEW', '2019-03-01', NULL FROM turned""")
def change_party(t):
    """Current memberships of those who change party end the day before; new ones get the next ids."""
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    m = t("customer").select(k.alias("id"), k.alias("person_id"), F.col("c_mktsegment").alias("party"), F.lit("2015-05-07").cast("date").alias("start_date"), F.when(k % 4 == 0, F.lit("2019-01-01").cast("date")).alias("end_date"), none.alias("start_reason"), none.alias("end_reason"))
    changes = t("customer").filter("c_custkey % 3 = 0").select(k.alias("person_id"), F.lit("NEW").alias("party"), F.lit("2019-03-01").cast("date").alias("day"))
    return people.change_party(m, changes).select("id", "person_id", "party", F.col("start_date").cast("string"), F.col("end_date").cast("string"))


@query("""WITH w AS (SELECT c_nationkey AS organization_id, count(*) AS n_members FROM customer WHERE c_custkey % 3 <> 0 GROUP BY 1) SELECT organization_id, n_members FROM w WHERE n_members > 5 + organization_id % 2""")
def over_full_bodies(t):
    """Bodies with more current members than seats."""
    m = t("customer").select(F.col("c_nationkey").alias("organization_id"), F.when(F.col("c_custkey") % 3 == 0, F.lit("2020-01-01")).alias("end_date"))
    seats = t("nation").select(F.col("n_nationkey").alias("organization_id"), (F.lit(5) + F.col("n_nationkey") % 2).alias("seats"))
    return people.over_full(m, seats).select("organization_id", "n_members")


@query("""SELECT c_custkey AS person_id, CASE c_custkey % 3 WHEN 0 THEN 'Lord ' || c_mktsegment || ' of ' || c_nationkey ELSE c_mktsegment || ' ' || c_name END AS shown FROM customer WHERE c_custkey % 5 <> 0""")
def name_on_date(t):
    """The name by which a person is known on a day: the main one that holds then, in a peer's style for peers."""
    k, c = F.col("c_custkey"), F.col
    peer = k % 3 == 0
    start, end = F.when(k % 5 == 0, "2012-01-01").otherwise("2001-01-01").cast("date"), F.lit(None).cast("date")
    main = t("customer").select(k.alias("person_id"), F.lit("Main").alias("note"), F.when(~peer, c("c_mktsegment")).alias("given_name"), F.when(~peer, c("c_name")).alias("family_name"), F.when(peer, "Lord").alias("honorific_prefix"), F.when(peer, c("c_mktsegment")).alias("lordname"), F.when(peer, c("c_nationkey").cast("string")).alias("lordofname"), start.alias("start_date"), end.alias("end_date"))
    other = main.withColumn("note", F.lit("Alternate"))
    return people.name_on(main.union(other), "2010-06-01")


@query("""WITH r AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN p_partkey // 7 END AS target FROM part WHERE p_partkey > 0)
SELECT id, CASE WHEN target IS NOT NULL THEN TRUE ELSE FALSE END AS merged, NULL::VARCHAR IS NULL AS ok FROM r""")
def merged_people(t):
    """People merged into others: each merged one is a redirect."""
    k = F.col("p_partkey")
    persons = t("part").filter("p_partkey > 0").select(k.alias("id"), F.array("p_name").alias("names"), F.array("p_brand").alias("identifiers"))
    merges = persons.filter("id % 7 = 0").select(F.col("id").alias("source"), F.expr("id div 7").alias("target"))
    memberships = t("part").select(k.alias("person_id"), "p_size")
    done, _ = people.merge_people(persons, memberships, merges)
    return done.select("id", F.col("redirect").isNotNull().alias("merged"), (F.col("redirect").isNotNull() | (F.size("names") > 0)).alias("ok"))


@query("""WITH a AS (SELECT c_custkey AS person_id, c_name AS name, 1900 + c_custkey % 50 AS f, 1950 + c_custkey % 40 AS l FROM customer), u AS (SELECT c_name AS name, 1900 + c_custkey % 50 AS f, 1950 + c_custkey % 40 AS l, 'https://example.org/' || c_custkey AS url FROM customer WHERE c_custkey % 3 <> 0)
SELECT a.person_id, u.url FROM a JOIN u USING (name, f, l)""")
def historic_matches(t):
    """People and pages by name and the years of their first and last terms."""
    k = F.col("c_custkey")
    a = t("customer").select(k.alias("person_id"), F.col("c_name").alias("name"), (k % 50 + 1900).alias("first_year"), (k % 40 + 1950).alias("last_year"))
    u = a.filter("person_id % 3 <> 0").select("name", "first_year", "last_year", F.concat(F.lit("https://example.org/"), F.col("person_id").cast("string")).alias("url"))
    return people.historic_matches(a, u)


@query("""SELECT c_custkey AS person_id, CASE WHEN c_custkey % 2 = 0 THEN 'https://a.example/' || c_custkey || '/view' END AS a, 'https://b.example/?id=' || c_nationkey AS b FROM customer""")
def profile_urls(t):
    """Addresses of official pages by identifier scheme."""
    k = F.col("c_custkey")
    one = t("customer").filter("c_custkey % 2 = 0").select(k.alias("person_id"), F.lit("a").alias("scheme"), k.cast("string").alias("identifier"))
    two = t("customer").select(k.alias("person_id"), F.lit("b").alias("scheme"), F.col("c_nationkey").cast("string").alias("identifier"))
    return people.profile_urls(one.union(two), {"a": "https://a.example/{}/view", "b": "https://b.example/?id={}"})


@query("""SELECT 'committee-on-' || lower(replace(n_name, ' ', '-')) AS slug, count(DISTINCT CASE WHEN c_custkey % 6 = 0 THEN c_name END) AS n_chairs, count(DISTINCT c_name) AS n_members, CAST(sum(CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_external FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def committee_groups(t):
    """Committees as groups: slug, chairs, members, those from outside."""
    m = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = m.select(F.concat(F.lit("Committee on "), "n_name").alias("committee"), F.col("c_name").alias("person"), F.when(F.col("c_custkey") % 6 == 0, "Chairman").otherwise("Member").alias("role"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("person_id"))
    return people.committees(rows).select("slug", F.size("chairs").cast("long").alias("n_chairs"), F.size("members").cast("long").alias("n_members"), "n_external")


@query("""SELECT c_custkey AS person_id, c_mktsegment AS ours, CASE WHEN c_custkey % 4 = 0 THEN 'Other' ELSE c_mktsegment END AS theirs FROM customer WHERE c_custkey % 4 = 0""")
def party_disagreements(t):
    """People whose party two sources name differently once aliases are resolved."""
    k = F.col("c_custkey")
    ours = t("customer").select(k.alias("person_id"), F.col("c_mktsegment").alias("party"))
    theirs = t("customer").select(k.alias("person_id"), F.when(k % 4 == 0, "Other").when(F.col("c_mktsegment") == "BUILDING", "Builders").otherwise(F.col("c_mktsegment")).alias("party"))
    return people.party_disagreements(ours, theirs, {"Builders": "BUILDING"})


TERMS = f"t AS (SELECT o_orderkey, o_custkey AS person, {DAY} AS s, coalesce(lead({DAY}) OVER (PARTITION BY o_custkey ORDER BY {DAY}, o_orderkey) - INTERVAL 1 DAY, DATE '9999-12-31')::DATE AS e FROM orders)"


def terms(t):
    held = temporal.derive_ends(t("orders").select("o_orderkey", F.col("o_custkey").alias("person"), day_of().alias("start_date")), ["person"], "start_date", "o_orderkey")
    return held.select("person", "start_date", "end_date")


@query(f"""WITH {TERMS}, p AS (SELECT event_id, user_id % (SELECT max(c_custkey) FROM customer) AS who, DATE '1995-01-01' + CAST(event_id % 1200 AS INTEGER) AS day FROM events),
f AS (SELECT p.event_id, count(DISTINCT t.person) AS n, min(t.person) AS m FROM p JOIN t ON t.person = p.who AND p.day BETWEEN t.s AND t.e GROUP BY 1)
SELECT p.event_id, coalesce(n, 0) AS n_candidates, CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'match' ELSE 'multiple' END AS status, CASE WHEN n = 1 THEN m END AS match FROM p LEFT JOIN f ON f.event_id = p.event_id""")
def resolve_identifiers(t):
    """Who holds an identifier on a day."""
    most = t("customer").agg(F.max("c_custkey").alias("most"))
    probes = t("events").crossJoin(F.broadcast(most)).select("event_id", F.lit("mnis").alias("scheme"), (F.col("user_id") % F.col("most")).cast("string").alias("identifier"), F.date_add(F.lit("1995-01-01").cast("date"), (F.col("event_id") % 1200).cast("int")).alias("day"))
    ids = t("customer").select(F.lit("mnis").alias("scheme"), F.col("c_custkey").cast("string").alias("identifier"), F.col("c_custkey").alias("person"))
    return resolution.by_identifier(probes, ids, terms(t), "event_id")


@query(f"""WITH {TERMS}, o AS (SELECT 'Minister ' || (person % 40) AS title, person, s, CASE WHEN e < DATE '9999-01-01' THEN e END AS e FROM t), p AS (SELECT event_id, 'Minister ' || (user_id % 40) AS office, DATE '1995-01-01' + CAST(event_id % 1200 AS INTEGER) AS day FROM events),
f AS (SELECT p.event_id, count(DISTINCT o.person) AS n, min(o.person) AS m FROM p JOIN o ON o.title = p.office AND p.day >= o.s AND p.day < o.e GROUP BY 1)
SELECT p.event_id, coalesce(n, 0) AS n_candidates, CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'match' ELSE 'multiple' END AS status, CASE WHEN n = 1 THEN m END AS match FROM p LEFT JOIN f ON f.event_id = p.event_id""")
def resolve_offices(t):
    """Who is meant by an office on a day."""
    title = lambda c: F.concat(F.lit("Minister "), (F.col(c) % 40).cast("string"))
    offices = terms(t).select(title("person").alias("title"), "person", "start_date", F.when(F.col("end_date") < F.lit("9999-01-01").cast("date"), F.col("end_date")).alias("end_date"))
    probes = t("events").select("event_id", title("user_id").alias("office"), F.date_add(F.lit("1995-01-01").cast("date"), (F.col("event_id") % 1200).cast("int")).alias("day"))
    return resolution.office_holders(probes, offices, "event_id")


@query(f"""WITH {TERMS}, n AS (SELECT c_custkey AS person, c_name AS name, DATE '1990-01-01' AS ns, DATE '1996-06-30' AS ne FROM customer UNION ALL SELECT c_custkey, upper(c_name), DATE '1996-07-01', DATE '9999-12-31' FROM customer)
SELECT t.person, name, CAST(greatest(ns, s) AS VARCHAR) AS start_date, CAST(least(ne, e) AS VARCHAR) AS end_date FROM n JOIN t ON t.person = n.person AND ns <= e AND ne >= s""")
def name_ranges(t):
    """Terms of people whose name changed, cut where it did."""
    d = lambda x: F.lit(x).cast("date")
    c = t("customer").select(F.col("c_custkey").alias("person"), F.inline(F.array(F.struct(F.col("c_name").alias("name"), d("1990-01-01").alias("name_start"), d("1996-06-30").alias("name_end")), F.struct(F.upper("c_name").alias("name"), d("1996-07-01").alias("name_start"), d("9999-12-31").alias("name_end")))))
    return resolution.name_ranges(c, terms(t).withColumn("seat", F.lit("x"))).select("person", "name", F.col("start_date").cast("string"), F.col("end_date").cast("string"))


@query("""WITH r AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag AS category, CASE WHEN CAST(l_quantity AS INTEGER) % 5 <> 0 THEN CAST(l_quantity AS INTEGER) END AS q FROM lineitem)
SELECT l_orderkey AS person_id, category, CAST(l_linenumber AS VARCHAR) AS interest_id, 'amount' AS slug, CAST(q AS VARCHAR) AS value FROM r WHERE q IS NOT NULL
UNION ALL SELECT l_orderkey, category, CAST(l_linenumber AS VARCHAR), 'flag', category FROM r""")
def register_round_trip(t):
    """Register entries with typed details, nested to a document for each person and flattened again."""
    rows = t("lineitem").select(F.col("l_orderkey").alias("person_id"), F.col("l_returnflag").alias("category"), F.col("l_linenumber").cast("string").alias("interest_id"), F.when(F.col("l_quantity").cast("int") % 5 != 0, F.col("l_quantity").cast("int")).alias("amount"), F.col("l_returnflag").alias("flag")).distinct()
    documents = registers.nested(registers.details(rows, ["person_id", "category", "interest_id"], ["amount", "flag"]))
    return registers.flattened(documents).select("person_id", "category", "interest_id", "slug", "value")


@query("""WITH i AS (SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey // 3 * 3 + CASE WHEN p_partkey % 11 = 0 THEN 9000000 ELSE 0 END AS VARCHAR) END AS parent FROM part),
k AS (SELECT parent, count(*) AS n FROM i WHERE parent IS NOT NULL GROUP BY 1)
SELECT i.id AS interest_id, i.parent IS NOT NULL AS orphaned, coalesce(k.n, 0) AS n_children FROM i LEFT JOIN k ON k.parent = i.id LEFT JOIN i AS own ON own.id = i.parent WHERE i.parent IS NULL OR own.id IS NULL""")
def register_parents(t):
    """Interests under their parents; those whose parent is not in the register are flagged."""
    k = F.col("p_partkey")
    parent = F.when(k % 3 != 0, (F.expr("p_partkey div 3") * 3 + F.when(k % 11 == 0, 9000000).otherwise(0)).cast("string"))
    rows = t("part").select(k.cast("string").alias("interest_id"), parent.alias("parent_id"), F.lit(1).alias("person_id"), F.lit("c").alias("category"))
    return registers.with_parents(rows).select("interest_id", "orphaned", F.size("children").cast("long").alias("n_children"))


@query("""WITH e AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS reg, CASE WHEN o_orderkey % 3 = 0 THEN (CAST(o_orderdate AS DATE) + INTERVAL 100 DAY)::DATE END AS ended FROM orders), d AS (SELECT DISTINCT make_date(y, 6, 1) AS pub FROM unnest(range(1993, 2000)) AS r(y))
SELECT id, CAST(pub AS VARCHAR) AS published, pub = DATE '1999-06-01' AS is_latest FROM e JOIN d ON reg <= pub AND (ended IS NULL OR ended >= pub - INTERVAL 365 DAY)""")
def register_snapshots(t):
    """The register as of each day of publication."""
    entries = t("orders").select(F.col("o_orderkey").alias("id"), day_of().alias("registered"), F.when(F.col("o_orderkey") % 3 == 0, F.date_add(day_of(), 100)).alias("ended"))
    days = t.spark.range(1993, 2000).select(F.make_date(F.col("id").cast("int"), F.lit(6), F.lit(1)).alias("published"))
    return registers.snapshots(entries, days).select("id", F.col("published").cast("string"), "is_latest")


@query("""SELECT max(l_orderkey * 10 + l_linenumber) AS interest_id, l_partkey, l_suppkey FROM lineitem GROUP BY l_partkey, l_suppkey""")
def register_repeats(t):
    """Of interests alike in content the one with the highest id."""
    rows = t("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("interest_id"), "l_partkey", "l_suppkey").distinct()
    return registers.without_repeats(rows, ["l_partkey", "l_suppkey"])


@query("""SELECT c_custkey AS person_id, md5('<h3>' || c_mktsegment || '</h3><ul><li>name: ' || c_name || '</li></ul>') AS digest FROM customer""")
def register_html(t):
    """Documents of the register as lists in lists."""
    rows = t("customer").select(F.col("c_custkey").alias("person_id"), F.col("c_mktsegment").alias("category"), F.lit("1").alias("interest_id"), F.col("c_name").alias("name"))
    html = registers.to_html(registers.nested(registers.details(rows, ["person_id", "category", "interest_id"], ["name"])))
    return html.select("person_id", F.md5("html").alias("digest"))


@query("""SELECT l_orderkey AS id, l_suppkey AS member_id, CAST(l_linenumber AS INTEGER) AS "order", l_returnflag = 'R' AS withdrawn, l_suppkey = p AS is_primary FROM lineitem JOIN (SELECT l_orderkey AS k, min(l_suppkey) AS p FROM lineitem GROUP BY 1) ON k = l_orderkey""")
def motion_signatures(t):
    """Motions with their sponsors as a flat table of signatures."""
    sponsor = F.struct(F.col("l_suppkey").alias("member_id"), F.col("l_linenumber").alias("order"), F.when(F.col("l_returnflag") == "R", True).alias("withdrawn"))
    items = t("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.min("l_suppkey").alias("primary_sponsor"), F.collect_list(sponsor).alias("sponsors")).withColumn("title", F.lit("m"))
    return registers.proposals(items)[1].select("id", "member_id", F.col("order").cast("int"), "withdrawn", "is_primary")


@query("""WITH r AS (SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d FROM orders), k AS (SELECT o_custkey AS person_id, CASE o_orderstatus WHEN 'F' THEN 'government' WHEN 'O' THEN 'opposition' ELSE 'committee' END AS kind, CAST(d AS VARCHAR) AS start_date FROM r)
SELECT person_id, kind, start_date, CAST(row_number() OVER (PARTITION BY person_id, kind ORDER BY start_date) AS INTEGER) AS occurrence FROM k""")
def member_positions(t):
    """Posts of each kind as rows, numbered where a person holds one again."""
    post = F.struct(F.lit("post").alias("title"), day_of().cast("string").alias("start_date"), F.lit(None).cast("string").alias("end_date"))
    of = lambda s: F.collect_list(F.when(F.col("o_orderstatus") == s, post))
    members = t("orders").groupBy(F.col("o_custkey").alias("person_id")).agg(of("F").alias("government"), of("O").alias("opposition"), of("P").alias("committee")).withColumn("parliamentary", F.array().cast("array<struct<title:string,start_date:string,end_date:string>>"))
    return registers.positions(members).select("person_id", "kind", "start_date", "occurrence")


@query("""WITH i AS (SELECT CAST(o_orderkey AS VARCHAR) AS uin, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 3 = 0 THEN 'g' || (o_custkey % 50) END AS grp FROM orders), n AS (SELECT *, coalesce(grp, uin) AS gid FROM i),
l AS (SELECT *, min(uin) OVER (PARTITION BY gid) AS lead, row_number() OVER (PARTITION BY gid ORDER BY uin) - 1 AS place FROM n)
SELECT gid AS group_id, uin, role, CAST(day AS VARCHAR) || '.' || lead || '.' || role AS gid FROM (SELECT gid, uin, day, lead, 'q' || place AS role FROM l UNION ALL SELECT gid, uin, day, lead, 'h' FROM l WHERE uin = lead UNION ALL SELECT gid, uin, day, lead, 'r0' FROM l WHERE uin = lead)""")
def written_answers(t):
    """Written questions in groups: one of each has the heading and the reply."""
    k = F.col("o_orderkey")
    items = t("orders").select(k.cast("string").alias("uin"), day_of().alias("day"), F.lit("Dept").alias("department"), F.when(k % 3 == 0, F.concat(F.lit("g"), (F.col("o_custkey") % 50).cast("string"))).alias("group"), F.lit("q?").alias("question"), F.lit("a.").alias("answer"))
    return transcripts.written_answers(items).select("group_id", "uin", "role", "gid")


@query("""WITH c AS (SELECT user_id % 97 AS sitting, event_id AS seq, CASE event_id % 5 WHEN 0 THEN 'heading' WHEN 1 THEN 'time' WHEN 2 THEN 'speaker' ELSE 'text' END AS kind, CASE event_id % 5 WHEN 1 THEN (event_id % 9 + 1) || '.15 pm' WHEN 2 THEN 'Member ' || (event_id % 13) || ':' ELSE 'words ' || event_id END AS body FROM events),
s AS (SELECT *, last_value(CASE WHEN kind = 'time' THEN lpad(CAST(seq % 9 + 13 AS VARCHAR), 2, '0') || ':15:00' END IGNORE NULLS) OVER w AS tm, last_value(CASE WHEN kind = 'speaker' THEN 'Member ' || (seq % 13) WHEN kind = 'heading' THEN '' END IGNORE NULLS) OVER w AS who FROM c WINDOW w AS (PARTITION BY sitting ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
shown AS (SELECT *, CASE WHEN kind = 'heading' AND lag(kind) OVER (PARTITION BY sitting ORDER BY seq) = 'heading' THEN 0 ELSE 1 END AS fresh FROM s WHERE kind IN ('heading', 'text')),
b AS (SELECT *, sum(fresh) OVER (PARTITION BY sitting ORDER BY seq) AS block FROM shown),
m AS (SELECT sitting, block, kind, min(seq) AS seq, first(tm ORDER BY seq) AS tm, first(who ORDER BY seq) AS who, string_agg(body, ' ' ORDER BY seq) AS body FROM b GROUP BY 1, 2, 3),
n AS (SELECT *, sum(CASE WHEN kind = 'heading' THEN 1 ELSE 0 END) OVER (PARTITION BY sitting ORDER BY seq) AS major FROM m),
p AS (SELECT *, row_number() OVER (PARTITION BY sitting, major ORDER BY seq) - CASE WHEN major > 0 THEN 1 ELSE 0 END AS minor FROM n)
SELECT sitting, 'x/2024-01-01.' || major || '.' || minor AS gid, kind, nullif(who, '') AS speaker, tm AS time, body AS text FROM p""")
def component_stream(t):
    """Sittings from streams of components: headings that join, speakers and times that carry on."""
    k = F.col("event_id")
    kind = F.when(k % 5 == 0, "heading").when(k % 5 == 1, "time").when(k % 5 == 2, "speaker").otherwise("text")
    body = F.when(k % 5 == 1, F.concat((k % 9 + 1).cast("string"), F.lit(".15 pm"))).when(k % 5 == 2, F.concat(F.lit("Member "), (k % 13).cast("string"), F.lit(":"))).otherwise(F.concat(F.lit("words "), k.cast("string")))
    rows = t("events").select((F.col("user_id") % 97).alias("sitting"), F.lit("2024-01-01").alias("day"), k.alias("seq"), kind.alias("kind"), body.alias("text"))
    return transcripts.from_components(rows, "x/").select("sitting", "gid", "kind", "speaker", "time", "text")


@query("""WITH l AS (SELECT l_orderkey AS division_id, CASE l_returnflag WHEN 'A' THEN 'aye' WHEN 'R' THEN 'no' ELSE 'abstain' END AS vote, l_linenumber % 4 = 0 AS teller, l_suppkey FROM lineitem)
SELECT division_id, vote, 'Family' || l_suppkey AS family, 'Given' AS given, 'Seat' AS seat, 'Con' AS party, teller, CASE WHEN l_suppkey % 3 = 0 AND NOT teller THEN 'Ms Proxy' END AS proxy FROM l""")
def division_lists(t):
    """Lines of division lists: names, seats, parties, tellers, proxies."""
    who = F.concat(F.lit("Family"), F.col("l_suppkey").cast("string"), F.lit(", Given (Seat) (Con)"))
    tail = F.when(F.col("l_linenumber") % 4 == 0, " (Teller)").when(F.col("l_suppkey") % 3 == 0, " (Proxy vote cast by Ms Proxy)").otherwise("")
    vote = F.when(F.col("l_returnflag") == "A", "aye").when(F.col("l_returnflag") == "R", "no").otherwise("abstain")
    lists = t("lineitem").groupBy(F.col("l_orderkey").alias("division_id"), vote.alias("vote")).agg(F.collect_list(F.concat(who, tail)).alias("lines"))
    return transcripts.divisions(lists)


@query("""WITH v AS (SELECT l_orderkey AS division_id, l_returnflag, l_linenumber % 4 = 0 AS teller FROM lineitem), c AS (SELECT division_id, count(*) FILTER (l_returnflag = 'A') AS aye, count(*) FILTER (l_returnflag = 'R') AS no, count(*) FILTER (l_returnflag = 'N') AS abstain FROM v WHERE NOT teller GROUP BY 1)
SELECT *, CASE WHEN aye > no THEN 'agreed' WHEN aye < no THEN 'negatived' ELSE 'tied' END AS outcome FROM c""")
def division_tallies(t):
    vote = F.when(F.col("l_returnflag") == "A", "aye").when(F.col("l_returnflag") == "R", "no").otherwise("abstain")
    return transcripts.tallies(t("lineitem").select(F.col("l_orderkey").alias("division_id"), vote.alias("vote"), (F.col("l_linenumber") % 4 == 0).alias("teller")))


@query("""SELECT o_orderkey, md5(lower(replace(replace(replace(o_orderpriority, ',', ''), '-', ''), ' ', ''))) AS key, CASE WHEN o_orderkey % 2 = 0 THEN 'McDonald-Smith' ELSE 'O''Neil' END AS family, 'foo Bar HTML Page' AS words FROM orders""")
def name_forms(t):
    """Keys for names, family names out of capitals, camel case as words."""
    shouted = F.when(F.col("o_orderkey") % 2 == 0, "MCDONALD-SMITH").otherwise("O'NEIL")
    words = text.title_words(F.concat(F.lit("fooBarHTMLPage")))
    return t("orders").select("o_orderkey", F.md5(text.strip_punctuation(F.col("o_orderpriority"))).alias("key"), names.family_case(shouted).alias("family"), F.concat(F.lit("f"), F.substring(words, 2, 100)).alias("words"))


@query("""SELECT c_custkey, c_name AS speaker, c_mktsegment AS office, n_name AS seat, 'Given' AS given, 'van Family' || c_custkey AS family FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def speaker_parts(t):
    """A speaker's name, office and seat out of one string, and given and family names with particles."""
    j = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    parts = names.brackets(F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(") ("), "n_name", F.lit(")")))
    whole = names.split_name(F.concat(F.lit("Given van Family"), F.col("c_custkey").cast("string")))
    return j.select("c_custkey", parts["outside"].alias("speaker"), F.get(parts["inside"], F.lit(0)).alias("office"), F.get(parts["inside"], F.lit(1)).alias("seat"), whole["given"].alias("given"), whole["family"].alias("family"))


@query(f"""SELECT o_orderkey, CAST({DAY} AS VARCHAR) AS day, strftime({DAY} - INTERVAL 28 DAY, '%Y-%m-%d') AS polled_from, CAST(year({DAY}) AS VARCHAR) || '-' || lpad(CAST((year({DAY}) + 1) % 100 AS VARCHAR), 2, '0') AS session FROM orders""")
def file_dates(t):
    """Days out of file names, the start of a trailing window, and sessions as years."""
    day = dates.date_in(F.concat(F.lit("debates"), day_of().cast("string"), F.lit("a.xml")))
    year = F.year(day)
    return t("orders").select("o_orderkey", day.cast("string").alias("day"), F.date_sub(day, 28).cast("string").alias("polled_from"), F.concat_ws("-", year.cast("string"), F.lpad(((year + 1) % 100).cast("string"), 2, "0")).alias("session"))


@query("""SELECT page_id, CAST(len(list_distinct(list_filter(regexp_extract_all(html, '&([A-Za-z0-9_]+);', 1), lambda e: e NOT IN ('amp', 'lt', 'gt', 'quot', 'nbsp', 'pound', 'eacute')))) AS INTEGER) AS n_unknown FROM pages""")
def unknown_entities(t):
    """Entities of pages that no rule knows."""
    return t("pages").select("page_id", F.size(markup.unknown_entities(F.col("html"))).alias("n_unknown"))


@query("""SELECT doc_id, upper(lang) AS language, count(*) OVER (PARTITION BY source) AS n_votes FROM documents""")
def counted_contributions(t):
    """How many rows hang on each contribution, by a join with their counts."""
    d = t("documents")
    return d.select("doc_id", "source", F.upper("lang").alias("language")).join(d.groupBy("source").agg(F.count("*").alias("n_votes")), "source").select("doc_id", "language", "n_votes")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'SAME' WHEN o_orderkey % 3 = 1 THEN 'EXTENSION' ELSE 'DIFFERENT' END AS class FROM orders""")
def version_classes(t):
    """Whether a new version is the same, goes on from the old one or differs."""
    old = F.concat(F.lit("text "), F.col("o_orderkey").cast("string"))
    new = F.when(F.col("o_orderkey") % 3 == 0, old).when(F.col("o_orderkey") % 3 == 1, F.concat(old, F.lit(" more"))).otherwise("none")
    return t("orders").select("o_orderkey", tables.version_class(old, new).alias("class"))


@query("""WITH m AS (SELECT doc_id, regexp_extract_all(text, '([A-Z][a-z]+ [A-Z][a-z]+)', 1) AS k FROM documents) SELECT doc_id, CAST(len(list_distinct(k)) AS INTEGER) AS n FROM m WHERE len(k) > 0""")
def phrases_once_a_speech(t):
    """Different phrases of each document: links are made once for each speech."""
    found = linking.mentions(t("documents").select("doc_id", "text"), "doc_id", "text", r"([A-Z][a-z]+ [A-Z][a-z]+)")
    return found.select("doc_id", "phrase").distinct().groupBy("doc_id").agg(F.count("*").cast("int").alias("n"))


@query("""SELECT c_custkey, c_name || ' "x"' AS plain, c_mktsegment || CASE WHEN c_custkey % 3 = 2 THEN 's' ELSE '' END AS owner FROM customer""")
def quote_forms(t):
    """Curly quotes made straight, possessives taken off."""
    k = F.col("c_custkey")
    owner = F.concat("c_mktsegment", F.when(k % 3 == 0, "\u2019s").when(k % 3 == 1, "").otherwise("s\u2019"))
    return t("customer").select("c_custkey", text.plain_quotes(F.concat("c_name", F.lit(" \u201cx\u201d"))).alias("plain"), text.without_possessive(owner).alias("owner"))


@query("""WITH c AS (SELECT o_orderkey, o_orderkey % 4 AS k, CASE WHEN o_orderkey % 4 = 3 THEN o_orderkey + 1005 ELSE o_orderkey + 1000 END AS a,
  CASE o_orderkey % 4 WHEN 1 THEN '9' WHEN 2 THEN CAST(o_orderkey + 1005 AS VARCHAR) WHEN 3 THEN CAST(o_orderkey + 1000 AS VARCHAR) END AS e FROM orders),
d AS (SELECT o_orderkey, a, CASE WHEN e IS NULL THEN a WHEN len(e) > len(CAST(a AS VARCHAR)) THEN CAST(e AS BIGINT)
  WHEN CAST(right(CAST(a AS VARCHAR), len(e)) AS BIGINT) < CAST(e AS BIGINT) THEN CAST(left(CAST(a AS VARCHAR), len(CAST(a AS VARCHAR)) - len(e)) || e AS BIGINT) END AS b FROM c)
SELECT o_orderkey, CASE WHEN b IS NOT NULL THEN a END AS first, b AS last FROM d""")
def column_ranges(t):
    """Columns as cited, with short ends; ranges whose end does not follow are refused."""
    k, n = F.col("o_orderkey"), (F.col("o_orderkey") + 1000)
    cited = F.when(k % 4 == 0, n.cast("string")).when(k % 4 == 1, F.concat(n.cast("string"), F.lit("-9"))).when(k % 4 == 2, F.concat(n.cast("string"), F.lit("-"), (n + 5).cast("string"))).otherwise(F.concat((n + 5).cast("string"), F.lit("-"), n.cast("string")))
    return t("orders").select("o_orderkey", text.column_range(cited).alias("r")).select("o_orderkey", "r.first", "r.last")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN 'no' ELSE 'yes' END AS fine FROM customer""")
def well_formed_documents(t):
    """Whether documents may be published: XML that parses."""
    k = F.col("c_custkey")
    xml = F.concat(F.lit("<d><p>"), "c_name", F.when(k % 3 == 1, "</d>").otherwise("</p></d>"))
    return t("customer").select("c_custkey", F.when(markup.well_formed(xml), "yes").otherwise("no").alias("fine"))


@query("""SELECT l_orderkey, count(DISTINCT l_returnflag) AS n_values FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1""")
def divided_groups(t):
    """Groups that have several values where one is due."""
    return tables.divided(t("lineitem"), ["l_orderkey"], "l_returnflag")


@query("""SELECT p_partkey FROM part WHERE NOT (p_partkey % 5 = 0 AND date_diff('day', DATE '2024-01-01' + CAST(p_partkey % 60 AS INTEGER), DATE '2024-03-01') < 30)""")
def negative_cache(t):
    """What is to be fetched: not what was found missing in the last thirty days."""
    missing = t("part").filter("p_partkey % 5 = 0").select("p_partkey", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 60).cast("int")).alias("found_on"))
    return tables.not_known_missing(t("part").select("p_partkey"), missing, "p_partkey", F.lit("2024-03-01").cast("date"), 30)


@query("""WITH s AS (SELECT o_custkey AS sitting, o_orderkey AS seq, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 7 END AS chair, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 11 END AS person, o_orderkey % 3 = 1 AS called FROM orders)
SELECT sitting, seq, coalesce(person, CASE WHEN called THEN last_value(chair IGNORE NULLS) OVER (PARTITION BY sitting ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END) AS person FROM s""")
def chair_fallback(t):
    """Speakers only called by the chair's title are the ones who took the chair last."""
    k = F.col("o_orderkey")
    s = t("orders").select(F.col("o_custkey").alias("sitting"), k.alias("seq"), F.when(k % 5 == 0, k % 7).alias("chair"), F.when(k % 3 == 0, k % 11).alias("person"), F.when(k % 3 == 1, "The Chairman").otherwise("x").alias("speaker"))
    return resolution.with_chair(s).select("sitting", "seq", "person")


@query("""SELECT c_custkey, c_name FROM customer""")
def sorted_parquet(t):
    """Parquet in order of its key with Bloom filters, read back."""
    path = f"{shared_folder(t.spark)}/sorted"
    files.write_sorted(t("customer").select("c_custkey", "c_name"), path, "c_custkey")
    return t.spark.read.parquet(path)


@query("""SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer""")
def json_lines(t):
    """JSON documents with sorted keys, missing values kept, read back."""
    path = f"{shared_folder(t.spark)}/lines"
    rows = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("segment"))
    files.write_json_lines(rows, path)
    return t.spark.read.schema("id long, name string, segment string").json(path)


@query("""SELECT n_nationkey AS id, n_name || ' & co' AS name FROM nation""")
def xml_round_trip(t):
    """Rows as XML elements, read back by their tag."""
    path = f"{shared_folder(t.spark)}/xml"
    files.write_xml(t("nation").select(F.col("n_nationkey").alias("id"), F.concat("n_name", F.lit(" & co")).alias("name")), path, "nation", "nations")
    return t.spark.read.schema("id int, name string").option("rowTag", "nation").format("xml").load(path)


@query("""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 ELSE 2 END AS written FROM orders""")
def new_partitions_only(t):
    """A second write adds the keys that aren't there yet and leaves the others as they are."""
    path = f"{shared_folder(t.spark)}/parts"
    rows = t("orders").select("o_orderkey", "o_orderstatus")
    files.write_new_partitions(rows.filter("o_orderstatus in ('F', 'O')").withColumn("written", F.lit(1)), path, "o_orderstatus")
    files.write_new_partitions(rows.withColumn("written", F.lit(2)), path, "o_orderstatus")
    return t.spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "written")


@query("""SELECT doc_id, lang_, text_, fell_back FROM (SELECT doc_id, 'en' AS lang_, md5(coalesce(CASE WHEN doc_id % 3 <> 0 THEN text END, upper(source))) AS text_, doc_id % 3 = 0 OR trim(text) = '' AS fell_back FROM documents
UNION ALL SELECT doc_id, 'cy', md5(upper(source)), FALSE FROM documents)""")
def bilingual_pair(t):
    """Every row in two languages, missing text taken from the other."""
    rows = t("documents").select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("text_en"), F.upper("source").alias("text_cy"))
    both = files.both_languages(rows, {"body": {"en": "text_en", "cy": "text_cy"}})
    return both.select("doc_id", F.col("lang").alias("lang_"), F.md5("body").alias("text_"), "fell_back")
