"""Parsers of proceedings over documents that are made of whole tables: each customer's orders are a day's business."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from hustings.functions import names
from hustings.plans import proceedings
from hustings.queries import query

KEYS = ["day", "revision"]


def documents(df, key, order, parts, revision="a"):
    """A document for each key: the parts of its rows, strings, in order."""
    pieces = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, F.concat(*parts).alias("x")))), lambda r: r["x"]), "\n")
    return df.groupBy(F.col(key).cast("string").alias("day")).agg(F.concat(F.lit("<System>"), pieces, F.lit("</System>")).alias("xml")).withColumn("revision", F.lit(revision))


def business(t):
    return t("orders").withColumn("o_clerk", F.concat(F.lit("Clerk "), (F.col("o_orderkey") % 17).cast("string")))


def mod(k, n):
    return F.col(k) % n


ITEMS = """items AS (SELECT o_custkey, o_orderkey AS k, row_number() OVER w AS rn,
  last_value(CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS timed,
  last_value(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS col,
  ('Clerk ' || (o_orderkey % 17)) AS o_clerk FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
rows_ AS (SELECT o_custkey, k, 0 AS part, 'minor-heading' AS kind, NULL AS speaker, 'Matter ' || k AS text, timed, col FROM items WHERE k % 4 = 0
  UNION ALL SELECT o_custkey, k, 1, 'speech', CASE WHEN k % 3 <> 2 THEN o_clerk END, 'Before ' || k || CASE WHEN k % 2 = 0 THEN ' after' ELSE '' END || ' & on', timed, col FROM items),
fresh AS (SELECT *, CASE WHEN kind <> 'speech' OR speaker IS NOT NULL OR coalesce(lag(kind) OVER (PARTITION BY o_custkey ORDER BY k, part), '') <> 'speech' THEN 1 ELSE 0 END AS f FROM rows_),
speeches AS (SELECT *, sum(f) OVER (PARTITION BY o_custkey ORDER BY k, part) AS sp FROM fresh),
whole AS (SELECT o_custkey, sp, arg_min(kind, (k, part)) AS kind, arg_min(speaker, (k, part)) AS speaker, first(col ORDER BY k, part) AS col, first(timed ORDER BY k, part) AS timed, first(speaker ORDER BY k, part) AS who, min((k, part)) AS begun, string_agg(text, chr(10) ORDER BY k, part) AS text FROM speeches GROUP BY 1, 2)"""


def days(t):
    k = "o_orderkey"
    text = lambda c: F.col(c).cast("string")
    timeline = F.when(mod(k, 5) == 0, F.concat(F.lit("<hs_Timeline>"), (mod(k, 11) + 1).cast("string"), F.lit("."), F.lpad((mod(k, 60)).cast("string"), 2, "0"), F.lit(" pm</hs_Timeline>\n"))).otherwise("")
    heading = F.when(mod(k, 4) == 0, F.concat(F.lit("<ns:hs_8Question url='u'>Matter "), text(k), F.lit("</ns:hs_8Question>\n"))).otherwise("")
    member = F.when(mod(k, 3) != 2, F.concat(F.lit("<Member><B>"), "o_clerk", F.lit(":</B></Member> "))).otherwise("")
    column = F.when(mod(k, 2) == 0, F.concat(F.lit("<?notus-xml column="), text(k), F.lit("?> after"))).otherwise("")
    return documents(business(t), "o_custkey", k, [timeline, heading, F.lit("<hs_Para>"), member, F.lit("Before "), text(k), column, F.lit(" &amp; on</hs_Para>")])


@query(f"""WITH {ITEMS} SELECT CAST(o_custkey AS VARCHAR) AS day, 'uk/' || o_custkey || 'a.' || coalesce(CAST(col AS VARCHAR), '0') || '.' || (row_number() OVER (PARTITION BY o_custkey, col ORDER BY begun) - 1) AS gid, kind, who AS speaker, CAST(col AS VARCHAR) AS "column",
CASE WHEN timed IS NOT NULL THEN lpad(CAST((CASE WHEN timed % 11 + 1 < 12 THEN timed % 11 + 13 ELSE 12 END) AS VARCHAR), 2, '0') || ':' || lpad(CAST(timed % 60 AS VARCHAR), 2, '0') || ':00' END AS time, text FROM whole""")
def day_rows(t):
    """Day documents with column marks inside speeches, entities, times, headings and paragraphs that go on."""
    return proceedings.day_rows(days(t), KEYS, "uk/").select("day", "gid", "kind", "speaker", "column", "time", "text")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS day, o_orderkey AS number, CAST(900000 + o_orderkey AS VARCHAR) AS qnum, ('Clerk ' || (o_orderkey % 17)) || ' (' || o_orderpriority || ') (Con)' AS member, CASE WHEN o_orderkey % 2 = 0 THEN 'Will the Minister act?' ELSE 'Is the Secretary of State aware of ' || o_orderkey || '?' END AS text FROM orders""")
def oral_questions(t):
    """Questions with number and [uin], whose text stands in its element or after it, time codes in between."""
    k = F.col("o_orderkey").cast("string")
    asked = F.when(mod("o_orderkey", 2) == 0, F.lit("<QuestionText>Will the Minister act?</QuestionText>")).otherwise(F.concat(F.lit("<QuestionText></QuestionText>Is <hs_TimeCode time='x'></hs_TimeCode>the Secretary of State aware of "), k, F.lit("?")))
    parts = [F.lit("<Question><hs_Para><Number>"), k, F.lit("</Number>. <Uin>["), (F.col("o_orderkey") + 900000).cast("string"), F.lit("]</Uin><Member><B>"), "o_clerk", F.lit("</B> ("), "o_orderpriority", F.lit(") (Con):</Member>"), asked, F.lit("</hs_Para></Question>")]
    found = proceedings.oral_questions(documents(business(t), "o_custkey", "o_orderkey", parts), KEYS)
    return found.select("day", F.col("number").cast("long"), "qnum", "member", "text")


@query("""WITH r AS (SELECT CAST(c_nationkey AS VARCHAR) AS day, c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'chair' WHEN 1 THEN 'clerk' WHEN 2 THEN 'witness' ELSE 'member' END AS role, c_name, c_mktsegment, c_custkey % 7 < 3 AS here FROM customer),
x AS (SELECT day, c_custkey, 0 AS i, role, CASE WHEN role = 'clerk' THEN c_name ELSE c_name END AS name, CASE WHEN role = 'member' THEN c_mktsegment END AS seat, CASE WHEN role IN ('chair', 'member') THEN here END AS attending FROM r UNION ALL SELECT day, c_custkey, 1, role, 'Second ' || c_custkey, NULL, NULL FROM r WHERE role = 'clerk')
SELECT day, CAST(row_number() OVER (PARTITION BY day ORDER BY c_custkey, i) AS INTEGER) AS place, role, name, seat, CAST(attending AS VARCHAR) AS attending FROM x""")
def committee_members(t):
    """Chairs, members, clerks and witnesses of committees, one for each nation."""
    k = "c_custkey"
    dagger = F.when(mod(k, 7) < 3, "†").otherwise("")
    chair = F.concat(F.lit("<hs_CLChairman>"), dagger, F.lit("<Member>"), "c_name", F.lit("</Member></hs_CLChairman>"))
    clerks = F.concat(F.lit("<hs_CLClerks>"), "c_name", F.lit(", Second "), F.col(k).cast("string"), F.lit("</hs_CLClerks>"))
    witness = F.concat(F.lit("<hs_CLPara>"), "c_name", F.lit("</hs_CLPara>"))
    member = F.concat(F.lit("<hs_CLMember>"), dagger, F.lit("<Member>"), "c_name", F.lit(" <I>("), "c_mktsegment", F.lit(")</I></Member></hs_CLMember>"))
    part = F.when(mod(k, 5) == 0, chair).when(mod(k, 5) == 1, clerks).when(mod(k, 5) == 2, witness).otherwise(member)
    return proceedings.committee(documents(t("customer"), "c_nationkey", k, [part]), KEYS).drop("revision").withColumn("attending", F.col("attending").cast("string"))


@query("""SELECT CAST(c_nationkey AS VARCHAR) AS day, c_name AS chair FROM customer WHERE c_custkey % 3 = 0""")
def committee_chairs(t):
    """Who is in the chair: entries among other paragraphs."""
    part = F.when(mod("c_custkey", 3) == 0, F.concat(F.lit("<hs_76fChair>[<I>"), "c_name", F.lit("</I> in the Chair]</hs_76fChair>"))).otherwise(F.lit("<hs_Para>Something.</hs_Para>"))
    return proceedings.chairs(documents(t("customer"), "c_nationkey", "c_custkey", [part]), KEYS).select("day", "chair")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS day, 'Heading & ' || o_orderkey AS heading, CASE WHEN o_orderkey % 2 = 0 THEN 'Question' ELSE 'Motion' END AS debate_type, CASE WHEN o_orderkey % 2 = 0 THEN ('Clerk ' || (o_orderkey % 17)) END AS member, CASE WHEN o_orderkey % 2 = 1 THEN 'Tabled by ' || ('Clerk ' || (o_orderkey % 17)) END AS text,
lpad(CAST(o_orderkey % 11 + 13 - CASE WHEN o_orderkey % 11 = 11 THEN 12 ELSE 0 END AS VARCHAR), 2, '0') || ':05:00' AS time FROM orders""")
def lords_debates(t):
    """Debates of the upper house: heading, kind, time, and who opens or tabled them."""
    k = F.col("o_orderkey").cast("string")
    question = mod("o_orderkey", 2) == 0
    kind = F.when(question, "Question").otherwise("Motion")
    body = F.when(question, F.concat(F.lit("<hs_Question><Member><B>"), "o_clerk", F.lit(":</B></Member> To ask.</hs_Question>"))).otherwise(F.concat(F.lit("<hs_TabledBy>Tabled by <Member>"), "o_clerk", F.lit("</Member></hs_TabledBy>")))
    parts = [F.lit("<NewDebate BusinessType='"), kind, F.lit("'><hs_time>"), (mod("o_orderkey", 11) + 1).cast("string"), F.lit(".05 pm</hs_time><hs_DebateHeading>Heading &amp; "), k, F.lit("</hs_DebateHeading><hs_DebateType>"), kind, F.lit("</hs_DebateType>"), body, F.lit("</NewDebate>")]
    return proceedings.lords_debates(documents(business(t), "o_custkey", "o_orderkey", parts), KEYS).select("day", "heading", "debate_type", "member", "text", "time")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS day, o_orderkey AS number, o_orderkey % 300 AS ayes, o_orderkey % 200 AS noes FROM orders""")
def document_divisions(t):
    """Divisions with their counts, of both houses' forms."""
    k, n = F.col("o_orderkey").cast("string"), lambda m: (F.col("o_orderkey") % m).cast("string")
    commons = F.concat(F.lit("<hs_Para><AyesNumber>"), n(300), F.lit("</AyesNumber><NoesNumber>"), n(200), F.lit("</NoesNumber></hs_Para>"))
    lords = F.concat(F.lit("<ContentsNumber>"), n(300), F.lit("</ContentsNumber>;<NotContentsNumber>"), n(200), F.lit("</NotContentsNumber>"))
    parts = [F.lit("<Division><hs_Para>Division No. <Number>"), k, F.lit("</Number></hs_Para>"), F.when(mod("o_orderkey", 2) == 0, commons).otherwise(lords), F.lit("</Division>")]
    return proceedings.divisions(documents(business(t), "o_custkey", "o_orderkey", parts), KEYS).select("day", "number", "ayes", "noes")


@query("""SELECT CAST(c_nationkey AS VARCHAR) AS day, 'hs_New' || (c_custkey % 3) AS tag, count(*) AS n FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1, 2""")
def unknown_elements(t):
    """Elements that the vocabulary lacks, to stop a run with."""
    part = F.when(mod("c_custkey", 2) == 0, F.concat(F.lit("<hs_New"), mod("c_custkey", 3).cast("string"), F.lit(">x</hs_New"), mod("c_custkey", 3).cast("string"), F.lit(">"))).otherwise(F.lit("<hs_Para>y</hs_Para>"))
    return proceedings.unknown(documents(t("customer"), "c_nationkey", "c_custkey", [part]), KEYS).select("day", "tag", "n")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Lord ' WHEN 1 THEN 'Baroness ' WHEN 2 THEN 'Archbishop ' ELSE 'Viscount ' END || replace(c_name, '.', '') || CASE WHEN c_custkey % 3 = 0 THEN ' of ' || n_name ELSE '' END AS style,
CASE c_custkey % 4 WHEN 0 THEN 'lord ' WHEN 1 THEN 'baroness ' WHEN 2 THEN 'archbishop ' ELSE 'viscount ' END || lower(replace(c_name, '.', '')) || CASE WHEN c_custkey % 3 = 0 THEN ' of ' || lower(n_name) ELSE '' END AS key
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def reversed_peers(t):
    """Names of division lists ('X of Y, L.') as full styles and as keys for comparing."""
    joined = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    rank = F.element_at(F.array(*map(F.lit, ("L.", "B", "Abp.", "V."))), (mod("c_custkey", 4) + 1).cast("int"))
    listed = F.concat("c_name", F.when(mod("c_custkey", 3) == 0, F.concat(F.lit(" of "), "n_name")).otherwise(""), F.lit(", "), rank)
    return joined.select("c_custkey", names.reversed_peer(listed).alias("style")).select("c_custkey", "style", names.canonical_peer(F.concat(F.lit("The "), "style")).alias("key"))


@query("""WITH s AS (SELECT o_custkey AS sitting, o_orderkey AS seq, CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey % 3 END AS person FROM orders),
c AS (SELECT sitting, seq, p FROM s, unnest([0, 1, 2]) AS x(p) WHERE person IS NULL AND p <> seq % 5),
last AS (SELECT sitting, seq, last_value(person IGNORE NULLS) OVER (PARTITION BY sitting ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lp FROM s),
met AS (SELECT c.sitting, c.seq, arg_max(c.p, k.seq) AS found FROM c JOIN last l ON l.sitting = c.sitting AND l.seq = c.seq AND l.lp IS DISTINCT FROM c.p JOIN s k ON k.sitting = c.sitting AND k.person = c.p AND k.seq < c.seq GROUP BY 1, 2)
SELECT s.sitting, s.seq, coalesce(s.person, m.found) AS person, CASE WHEN s.person IS NOT NULL THEN 'given' WHEN m.found IS NOT NULL THEN 'history' ELSE 'unknown' END AS source FROM s LEFT JOIN met m ON m.sitting = s.sitting AND m.seq = s.seq""")
def speaker_history(t):
    """Ambiguous speakers settled by who spoke earlier, the last speaker left out."""
    from hustings.plans import resolution

    s = t("orders").select(F.col("o_custkey").alias("sitting"), F.col("o_orderkey").alias("seq"), F.when(mod("o_orderkey", 4) < 2, mod("o_orderkey", 3)).alias("person"))
    found = s.filter("person is null").select("sitting", "seq", F.explode(F.array(*(F.lit(i).cast("long") for i in range(3)))).alias("person")).filter("person <> seq % 5")
    return resolution.by_history(s, found)


@query("""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS para, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS seq FROM documents)
SELECT doc_id, seq, CASE WHEN seq % 2 = 0 THEN 'perfectmatch' WHEN seq % 3 = 0 THEN 'missing' ELSE 'changes' END AS kind, CASE WHEN seq % 2 = 0 OR seq % 3 <> 0 THEN seq END AS target FROM p""")
def gid_redirects(t):
    """A second version of every document led to the first: of numbered paragraphs each second has a word put in before it,
    some of those other words altogether."""
    from hustings.plans import alignment

    split = F.split("text", "\n")
    old = F.transform(split, lambda p, i: F.concat_ws(" ", F.concat(F.lit("line"), i.cast("string")), F.lit("says that"), p))
    new = F.transform(old, lambda p, i: F.when(i % 2 == 0, p).when(i % 3 == 0, F.concat(F.lit("~"), i.cast("string"), F.lit("~"))).otherwise(F.concat(F.lit("~new~ "), p)))
    version = lambda n, paras: F.struct(F.lit(n).alias("n"), F.array_join(paras, "\n").alias("text"))
    docs = t("documents").filter("text is not null").select("doc_id", F.inline(F.array(version(1, old), version(2, new)))).withColumn("version", F.concat_ws("-", "doc_id", "n"))
    found = alignment.redirects(docs, "doc_id", "version", "text")
    return found.select(F.split("version", "-")[0].cast("long").alias("doc_id"), F.col("seq").cast("long"), "kind", F.col("target").cast("long"))
