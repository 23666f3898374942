"""Scalar functions over names, documents and pages."""

from pyspark.sql import functions as F

from hustings.functions import dates, markup, names, text
from hustings.queries import query


@query("SELECT p_partkey, replace(upper(n[1]) || n[2:], ' ', '_') AS title FROM (SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(trim(p_name), '^(?i)the +', ''), '\\s+', ' ', 'g'), ' ?: ?', ':', 'g') AS n FROM part)".replace("'^(?i)the +'", "'(?i)^the +'"))
def wiki_title(t):
    return t("part").select("p_partkey", text.wiki_title(F.col("p_name")).alias("title"))


@query("SELECT doc_id, md5(replace(trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9_\\s-]', '', 'g'), '[-\\s]+', ' ', 'g')), ' ', '-')) AS digest FROM documents")
def slugify_ascii(t):
    """Slugs of whole texts of all documents, letters folded to ASCII."""
    return t("documents").select("doc_id", F.md5(text.slugify(F.col("text"))).alias("digest"))


@query("""WITH n AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Mr. ' WHEN 1 THEN 'Rt. Hon. Sir ' WHEN 2 THEN '' ELSE 'Dr ' END || c_name || CASE WHEN c_custkey % 3 = 0 THEN ', MP' ELSE '' END AS s FROM customer)
SELECT c_custkey, replace(c_name_plain, '#', '#') AS name, CASE c_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 0 ELSE 1 END AS n_titles FROM (SELECT c_custkey, regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(s, '[.,]', ' ', 'g'), '\\s+', ' ', 'g')), '^((Mr|Rt|Hon|Sir|Dr) )*', ''), ' MP$', '') AS c_name_plain FROM n)""")
def strip_titles(t):
    k = F.col("c_custkey")
    title = F.when(k % 4 == 0, "Mr. ").when(k % 4 == 1, "Rt. Hon. Sir ").when(k % 4 == 2, "").otherwise("Dr ")
    got = names.strip_titles(F.concat(title, "c_name", F.when(k % 3 == 0, ", MP").otherwise("")))
    return t("customer").select("c_custkey", got["name"].alias("name"), got["n_titles"].alias("n_titles"))


@query("SELECT n_nationkey, regexp_replace(n_name || ', ' || r_name, '^([^,]*), *(.*)$', '\\2 \\1') AS name FROM nation JOIN region ON n_regionkey = r_regionkey")
def name_reorder(t):
    joined = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_nationkey", names.reorder(F.concat_ws(", ", "n_name", "r_name")).alias("name"))


@query("SELECT doc_id, md5(trim(regexp_replace(regexp_replace(':' || text, '^\\s*:', ''), '[\\s\\x{00A0}\\x{2000}-\\x{200A}\\x{202F}\\x{3000}]+', ' ', 'g'))) AS digest FROM documents")
def tidy_text(t):
    return t("documents").select("doc_id", F.md5(text.tidy(F.concat(F.lit(":"), "text"))).alias("digest"))


@query("SELECT doc_id, CAST(len(regexp_split_to_array(text, '\\s+')) AS INTEGER) AS n FROM documents")
def word_count(t):
    return t("documents").select("doc_id", text.word_count(F.col("text")).alias("n"))


@query("SELECT page_id, CAST(len(k) AS INTEGER) AS n, md5(array_to_string(k, ' ')) AS digest FROM (SELECT page_id, regexp_extract_all(html, '(<[^>]*>|&[A-Za-z0-9_]+;|[^<>\\s]+)', 1) AS k FROM pages)")
def markup_tokens(t):
    tokens = text.markup_tokens(F.col("html"))
    return t("pages").select("page_id", tokens.alias("k")).select("page_id", F.size("k").alias("n"), F.md5(F.array_join("k", " ")).alias("digest"))


@query("SELECT doc_id, CAST(len(k) AS INTEGER) AS n, coalesce(k[1], '') AS head FROM (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[.] '), lambda x: trim(x, ' ')), lambda x: len(string_split(x, ' ')) >= 3 AND NOT contains(lower(x), 'licensed under')) AS k FROM documents)")
def sentence_filter(t):
    kept = text.sentences(F.col("text"), 3, ("licensed under",))
    return t("documents").select("doc_id", kept.alias("k")).select("doc_id", F.size("k").alias("n"), F.coalesce(F.get("k", F.lit(0)), F.lit("")).alias("head"))


@query("""WITH w AS (SELECT doc_id, unnest(string_split_regex(text, '[.,\\n]+ *')) AS p FROM documents), f AS (
SELECT doc_id, CASE WHEN p IN ('Government', 'The Minister') THEN 'banned' WHEN regexp_matches(p, '^\\s*\\S+\\s*$') AND NOT (regexp_matches(p, '\\p{Lu}') AND NOT regexp_matches(p, '\\p{Ll}')) THEN 'single word' WHEN regexp_matches(p, '^[A-Z][a-zA-Z]{0,5}$') AND NOT regexp_matches(p, '^[A-Z]{2,6}$') THEN 'short word' END AS fault FROM w WHERE p <> '')
SELECT doc_id, fault, count(*) AS n FROM f GROUP BY 1, 2""")
def phrase_quality(t):
    """What is wrong with the phrases between the marks of all texts, counted for each document."""
    phrases = t("documents").select("doc_id", F.explode(F.split("text", r"[.,\n]+ *")).alias("p")).filter("p <> ''")
    return phrases.select("doc_id", text.phrase_fault(F.col("p"), ("Government", "The Minister")).alias("fault")).groupBy("doc_id", "fault").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def month_translate(t):
    """Dates written in Welsh, put into English and parsed."""
    months = F.array(*map(F.lit, dates.WELSH_MONTHS))
    welsh = F.concat_ws(" ", F.dayofmonth("o_orderdate").cast("string"), F.element_at(months, F.month("o_orderdate")), F.year("o_orderdate").cast("string"))
    return t("orders").select("o_orderkey", dates.parse_date(dates.english_months(welsh)).cast("string").alias("day"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def parse_dates(t):
    """Dates in four written forms."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    written = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "d MMMM yyyy")).when(k == 2, F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "EEEE, d MMMM yyyy"))
    return t("orders").select("o_orderkey", dates.parse_date(written).cast("string").alias("day"))


@query("SELECT p_partkey, (p_partkey % 26 + 1) * 30 + p_partkey // 26 % 26 + 1 AS ordinal FROM part")
def alpha_order(t):
    """Two revision letters made from a part's key, as a number."""
    letter = lambda k: F.char(k % 26 + 97)
    k = F.col("p_partkey")
    return t("part").select("p_partkey", text.alpha_order(F.concat(letter(k), letter(F.expr("p_partkey div 26")))).alias("ordinal"))


@query("""SELECT event_id, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minutes FROM events""")
def clock_times(t):
    """Times as spoken of ('2.05 pm') turned into minutes of the day."""
    spoken = F.concat(F.date_format("ts", "h"), F.lit("."), F.date_format("ts", "mm"), F.lit(" "), F.lower(F.date_format("ts", "a")))
    return t("events").select("event_id", dates.minutes_of_day(dates.clock(spoken)).alias("minutes"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages""")
def url_parts(t):
    part = lambda *a: F.try_parse_url(F.col("url"), *(F.lit(x) for x in a))
    return t("pages").select("page_id", part("PROTOCOL").alias("scheme"), part("HOST").alias("host"), part("PATH").alias("path"), part("QUERY", "page").alias("page"))


@query("SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM pages")
def page_title(t):
    return t("pages").select("page_id", markup.title(F.col("html")).alias("title"))


@query("SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS link FROM pages")
def page_links(t):
    return t("pages").select("page_id", F.explode(markup.links(F.col("html"))).alias("link"))


@query("""SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<script\\b.*?</script>', '', 'g'), '(?is)<style\\b.*?</style>', '', 'g'), '(?i)</?a\\b[^>]*>', '', 'g'), '\\r', '', 'g'), '\\s+', ' ', 'g'))) AS digest FROM pages""")
def html_clean(t):
    return t("pages").select("page_id", F.md5(markup.clean(F.col("html"))).alias("digest"))


@query("SELECT c_custkey, md5(replace(replace(replace('<' || c_name || '> & \"' || c_mktsegment || '\"', '&', '&amp;'), '<', '&lt;'), '>', '&gt;').replace('\"', '&quot;')) AS digest FROM customer")
def escape_markup(t):
    raw = F.concat(F.lit("<"), "c_name", F.lit('> & "'), "c_mktsegment", F.lit('"'))
    return t("customer").select("c_custkey", F.md5(markup.escape(raw)).alias("digest"))


@query("SELECT c_custkey, lower(translate(c_name, ',- ', '')) AS key, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS padded, round(c_acctbal / 1024, 1) + 0 AS kb FROM customer")
def key_formats(t):
    return t("customer").select("c_custkey", text.strip_punctuation(F.col("c_name")).alias("key"), F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded"), (F.round(F.col("c_acctbal") / 1024, 1) + 0).alias("kb"))
