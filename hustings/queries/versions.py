"""Versions of documents: what became of each paragraph, and the old version rewritten."""

from pyspark.sql import functions as F

from hustings.plans import questions, versions
from hustings.queries import query


def two_versions(t):
    """All documents as numbered paragraphs, and a second version: of six paragraphs one has a word put in, one is gone, one is
    split, one has a word after it, two stay. All begin and end with words of their own, as texts repeat paragraphs."""
    docs = t("documents").filter("text is not null").select("doc_id", F.split("text", "\n").alias("paras"))
    old = F.transform("paras", lambda p, i: F.concat_ws(" ", F.concat(F.lit("line"), i.cast("string")), F.lit("says that"), p, F.concat(F.lit("end"), i.cast("string"))))
    first, last = lambda i: F.concat(F.lit("line"), i.cast("string"), F.lit(" says")), lambda p, i: F.concat(F.lit("that "), p, F.lit(" end"), i.cast("string"))
    new = F.flatten(F.transform("paras", lambda p, i: F.when(i % 6 == 1, F.array(F.concat(first(i), F.lit(" ~new~ "), last(p, i)))).when(i % 6 == 2, F.array().cast("array<string>")).when(i % 6 == 3, F.array(first(i), F.concat(F.lit("~more~ "), last(p, i))))
        .when(i % 6 == 5, F.array(F.concat(first(i), F.lit(" "), last(p, i), F.lit(" ~after~")))).otherwise(F.array(F.concat(first(i), F.lit(" "), last(p, i))))))
    return (versions.chunks(docs.select("doc_id", F.array_join(paras, "\n").alias("text")), ["doc_id"], "text") for paras in (old, new))


PARAGRAPHS = """WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS para, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents WHERE text IS NOT NULL),
r AS (SELECT doc_id, i AS seq, para, 0 AS nth, CASE i % 6 WHEN 1 THEN 'changes' WHEN 2 THEN 'missing' WHEN 3 THEN 'multiplecover' ELSE 'perfectmatch' END AS kind,
  CASE WHEN i % 6 = 2 THEN i - 1 - (i + 2) // 6 + (i + 1) // 6 ELSE i - (i + 3) // 6 + (i + 2) // 6 END AS target FROM p
  UNION ALL SELECT doc_id, i, para, 1, 'multiplecover', i - (i + 3) // 6 + (i + 2) // 6 + 1 FROM p WHERE i % 6 = 3)"""


@query(f"{PARAGRAPHS} SELECT doc_id, seq, kind, target FROM r")
def version_redirects(t):
    """What became of each paragraph in a second version, word by word."""
    old, new = two_versions(t)
    return versions.redirects(old, new, ["doc_id"])


AMP = "replace(replace(replace(regexp_replace({0}, '&(amp;)?', '&amp;', 'g'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


@query(f"""{PARAGRAPHS}, l AS (SELECT doc_id, seq, nth, kind, '<gidredirect oldgid="' || seq || '" newgid="' || target || '" matchtype="' || kind || '"/>' || chr(10)
  || CASE WHEN kind = 'perfectmatch' OR (kind = 'multiplecover' AND nth = 0) THEN '' ELSE '<p id="' || seq || '">' || {AMP.format("'line' || seq || ' says that ' || para || ' end' || seq")} || '</p>' || chr(10) END AS line FROM r)
SELECT doc_id, md5('<document scrapeversion="version-' || doc_id || '" latest="no">' || chr(10) || string_agg(line, '' ORDER BY seq, nth) || '</document>' || chr(10)) AS digest FROM l GROUP BY doc_id""")
def rewritten_versions(t):
    """Old versions as they are kept: redirects to the new one, and the paragraphs that changed."""
    old, new = two_versions(t)
    found = versions.redirects(old, new, ["doc_id"])
    kept = versions.rewritten(old, found, new, ["doc_id"], F.concat(F.lit("version-"), "doc_id"))
    return kept.select("doc_id", F.md5("document").alias("digest"))


@query("""WITH e AS (SELECT conv_id, turn, 'q' || turn || ' ' || coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations WHERE role = 'user'),
n AS (SELECT *, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS words, lpad(CAST(turn AS VARCHAR), 6, '0') AS gid, conv_id % 6 AS fate FROM e)
SELECT conv_id AS work, gid, CASE WHEN fate = 5 OR (fate = 3 AND words < 3) THEN 'removed' WHEN fate IN (0, 2) THEN 'perfectmatch' WHEN fate = 4 AND count(*) OVER (PARTITION BY conv_id) = 1 THEN 'perfectmatch' ELSE 'changes' END AS kind,
CASE WHEN fate = 5 THEN 'index' WHEN fate = 4 OR (fate = 3 AND words < 3) THEN first_value('n' || gid) OVER (PARTITION BY conv_id ORDER BY turn) ELSE 'n' || gid END AS target,
CASE WHEN fate = 5 OR (fate = 3 AND words < 3) THEN 'none' WHEN fate IN (2, 3) THEN 'likeness' ELSE 'number' END AS by FROM n""")
def question_redirects(t):
    """Questions of all conversations led to a second version, in which those of a conversation are the same, longer, without
    their numbers, longer without numbers, one block, or gone."""
    asked = t("conversations").filter("role = 'user'").select(F.col("conv_id").alias("work"), F.col("turn").alias("seq"), F.lpad(F.col("turn").cast("string"), 6, "0").alias("gid"), F.concat(F.lit("t"), "turn").alias("number"), F.concat_ws(" ", F.concat(F.lit("q"), "turn"), F.coalesce("text", F.lit(""))).alias("text"))
    old = asked.select("work", "seq", "gid", F.array("number").alias("numbers"), "text")
    fate = F.col("work") % 6
    numbers = F.when(fate.isin(2, 3), F.array(F.lit(questions.NO_NUMBER))).otherwise(F.array("number"))
    text = F.when(fate.isin(1, 3), F.concat("text", F.lit(" more"))).otherwise(F.col("text"))
    new = asked.filter(fate < 4).select("work", "seq", F.concat(F.lit("n"), "gid").alias("gid"), numbers.alias("numbers"), text.alias("text"))
    merged = asked.filter(fate == 4).groupBy("work").agg(F.sort_array(F.collect_list(F.struct("seq", "gid", "number", "text"))).alias("all"))
    merged = merged.select("work", F.col("all")[0]["seq"].alias("seq"), F.concat(F.lit("n"), F.col("all")[0]["gid"]).alias("gid"), F.col("all.number").alias("numbers"), F.array_join("all.text", " ").alias("text"))
    gone = asked.filter(fate == 5).select("work").distinct().select("work", F.lit(0).cast("long").alias("seq"), F.lit("index").alias("gid"), F.array(F.lit("x")).alias("numbers"), F.lit("Index").alias("text"))
    return questions.redirects(old, new.unionByName(merged).unionByName(gone))
