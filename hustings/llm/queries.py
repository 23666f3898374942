"""The queries of this subpackage, each over its whole tables, and their DuckDB equivalents where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.llm import conversation_repair, decontamination, fingerprint, language_id, license_scan, packing, ranked_search, simhash, substring_dedup, token_files, toxicity, url_filter, vector_graph
from hustings.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), columns=["doc_id"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), columns=["doc_id"])


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, fetched on a day that their page_id tells, against a list whose entries come from the pages' hosts.

    An entry's kind, dates and fate follow from the MD5 of its value, so the list grows with the pages' hosts and URLs.
    """
    pages = table(spark, sf_dir, "pages")
    shots = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int")).alias("fetched"))
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host")).distinct().filter("host <> ''")
    site = F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    values = hosts.select(F.lit("domain").alias("kind"), site.alias("value")).filter("value <> ''").distinct()
    values = values.union(hosts.select(F.lit("host"), "host")).union(hosts.select(F.lit("prefix"), F.concat("host", F.lit("/en/"))))
    urls = pages.filter("url is not null").select(F.concat(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))).alias("value")).distinct()
    values = values.union(urls.filter("substring(md5(value), 1, 1) = '0'").select(F.lit("url"), "value"))
    marked = values.withColumn("m", F.md5("value")).withColumn("list", F.when(F.col("m").substr(2, 1).isin(list("0123")), "allow").otherwise("block"))
    marked = marked.withColumn("category", F.when(F.col("m").substr(3, 1) < "8", "ads").otherwise("adult"))
    dates = [("add", "2024-02-01", "m < 'c'"), ("remove", "2024-06-01", "m < '8'"), ("add", "2024-09-01", "m < '4'")]
    entries = [marked.filter(w).select("kind", "value", "list", F.lit(a).alias("action"), F.lit(d).cast("date").alias("dated"), "category") for a, d, w in dates]
    return url_filter.evaluate(shots, entries[0].union(entries[1]).union(entries[2])).withColumn("fetched", F.col("fetched").cast("string"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.report(decontamination.occurrences(docs, table(spark, sf_dir, "benchmark"), columns=["doc_id"]))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"])
    joined = {n: F.array_join(n, ",") for n in ("base_labels", "labels")}
    return found.withColumns(joined).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.cut(docs, columns=["doc_id"]).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprint.edited_neighbours(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.as_text(F.col("sketch")).alias("fingerprint"), fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprint.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), fingerprint.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return packing.by_bucket(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"))
    return token_files.read_token_files(manifest, token_files.ids_crc32, "ids_crc32 long").drop("shard")


def op11_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).links


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damaged(conversations), conversations)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, f in globals().items() if n.startswith("op") and callable(f)}


OP4_SQL = """
WITH shots AS (
  SELECT DISTINCT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched,
    rtrim(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
    coalesce(nullif(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), ''), '/') AS path FROM pages),
hosts AS (SELECT DISTINCT host FROM shots WHERE host <> ''),
vals AS (
  SELECT DISTINCT 'domain' AS kind, regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1) AS value FROM hosts WHERE regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1) <> ''
  UNION ALL SELECT 'host', host FROM hosts
  UNION ALL SELECT 'prefix', host || '/en/' FROM hosts
  UNION ALL SELECT DISTINCT 'url', host || path FROM shots WHERE url IS NOT NULL AND md5(host || path)[1] = '0'),
marked AS (
  SELECT kind, value, md5(value) AS m, CASE WHEN md5(value)[2] IN ('0', '1', '2', '3') THEN 'allow' ELSE 'block' END AS list,
    CASE WHEN md5(value)[3] < '8' THEN 'ads' ELSE 'adult' END AS category FROM vals),
spans AS (
  SELECT *, DATE '2024-02-01' AS since, CASE WHEN m < '8' THEN DATE '2024-06-01' END AS until FROM marked WHERE m < 'c'
  UNION ALL SELECT *, DATE '2024-09-01', NULL FROM marked WHERE m < '4'),
met AS (
  SELECT s.page_id, s.url, s.fetched, e.kind, e.value, e.list, e.category,
    CASE e.kind WHEN 'url' THEN 4 WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END AS exact,
    CASE e.kind WHEN 'prefix' THEN len(e.value) - len(replace(e.value, '/', '')) WHEN 'domain' THEN 1 + len(e.value) - len(replace(e.value, '.', '')) ELSE 0 END AS depth
  FROM shots s JOIN spans e ON s.fetched >= e.since AND (e.until IS NULL OR s.fetched < e.until) AND s.host <> '' AND CASE e.kind
    WHEN 'domain' THEN s.host = e.value OR ends_with(s.host, '.' || e.value) WHEN 'host' THEN s.host = e.value
    WHEN 'prefix' THEN starts_with(s.host || s.path, e.value) ELSE s.host || s.path = e.value END),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY page_id, url, fetched) AS n_active,
    row_number() OVER (PARTITION BY page_id, url, fetched ORDER BY exact DESC, depth DESC, CASE list WHEN 'block' THEN 0 ELSE 1 END, category) AS place FROM met)
SELECT s.page_id, s.url, CAST(s.fetched AS VARCHAR) AS fetched, coalesce(r.n_active, 0) AS n_active, r.kind, r.value, r.list, r.category, coalesce(r.list = 'block', FALSE) AS blocked
FROM shots s LEFT JOIN ranked r ON r.place = 1 AND r.page_id IS NOT DISTINCT FROM s.page_id AND r.url IS NOT DISTINCT FROM s.url AND r.fetched IS NOT DISTINCT FROM s.fetched
"""

OP5_SQL = """
WITH words AS (
  SELECT 0 AS side, doc_id AS id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 1, item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') FROM benchmark),
windows AS (
  SELECT DISTINCT id AS item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE side = 1 AND len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT id AS doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM words, sizes, unnest(range(1, len(w) - size + 2)) AS t(i) WHERE side = 0),
hits AS (SELECT p.doc_id, p.size, p.i, x.item_id FROM places p JOIN windows x ON p.win = x.win AND p.size = x.size),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, size)) AS t(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.id AS doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items, sha256(coalesce(m.joined, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN covered c ON c.doc_id = d.id LEFT JOIN items m ON m.doc_id = d.id WHERE d.side = 0
"""

OP7_SQL = """
WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS win FROM words, unnest(range(1, len(w) - 48)) AS t(i)),
firsts AS (SELECT win, min(doc_id) AS earliest FROM windows GROUP BY win HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, list(DISTINCT i + k) AS cut_at FROM windows JOIN firsts USING (win), unnest(range(0, 50)) AS t(k) WHERE doc_id > earliest GROUP BY doc_id),
kept AS (SELECT doc_id, w, coalesce(len(cut_at), 0) AS n_removed, list_filter(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN list_contains(cut_at, i) THEN NULL ELSE w[i] END), lambda x: x IS NOT NULL) AS left_words FROM words LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(array_to_string(CASE WHEN n_removed = 0 THEN w ELSE left_words END, ' ')) AS kept_sha256 FROM kept
"""


OP12_SQL = """
WITH words AS (
  SELECT 0 AS side, doc_id AS id, unnest(list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS term FROM documents
  UNION ALL
  SELECT 1, item_id, unnest(list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) FROM benchmark),
tfs AS (SELECT side, id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT id AS doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs WHERE side = 0 GROUP BY 1),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, whole WHERE side = 0 GROUP BY term, docs),
parts AS (SELECT t.id AS doc_id, t.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // terms)))) AS part FROM tfs t JOIN weights USING (term) JOIN sizes s ON s.doc_id = t.id, whole WHERE side = 0),
scores AS (SELECT i.id AS item_id, p.doc_id, CAST(sum(i.tf * p.part) AS BIGINT) AS score FROM tfs i JOIN parts p USING (term) WHERE i.side = 1 GROUP BY 1, 2 HAVING sum(i.tf * p.part) > 0),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filter": OP4_SQL, "op5_decontamination": OP5_SQL, "op7_substring_dedup": OP7_SQL, "op12_ranked_search": OP12_SQL}
