"""Transcripts: streams of components, XML days and HTML reports to ordered rows with ids, times and speakers.

A sitting's rows are few, so windows over one sitting stay small however many sittings there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hustings.functions import dates, markup, names
from hustings.operators import sequences

ORDER = ["seq"]


def from_components(components: DataFrame, prefix: str) -> DataFrame:
    """Rows of a sitting from a stream of components (sitting, day, seq, kind, text).

    Kinds: header and time only move the state; heading and subheading open parts (neighbours of one kind are one);
    speaker names who speaks the text and quote rows after it. Gives (sitting, gid, major, minor, kind, speaker, time,
    text). A major heading begins a part, all other rows count on within it.
    """
    state = sequences.carry_forward(components, ["sitting"], ORDER, F.when(F.col("kind") == "time", dates.clock(F.col("text"))), "time")
    state = sequences.carry_forward(state, ["sitting"], ORDER, F.when(F.col("kind") == "speaker", F.regexp_replace("text", r":\s*$", "")).when(F.col("kind").isin("heading", "subheading"), F.lit("")), "speaker")
    shown = state.filter(F.col("kind").isin("heading", "subheading", "text", "quote", "question"))
    by = Window.partitionBy("sitting").orderBy("seq")
    joins = F.col("kind").isin("heading", "subheading") & F.col("kind").eqNullSafe(F.lag("kind").over(by))
    grouped = shown.withColumn("_fresh", ~F.coalesce(joins, F.lit(False))).withColumn("_block", F.sum(F.col("_fresh").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    merged = grouped.groupBy("sitting", "day", "_block", "kind").agg(F.min("seq").alias("seq"), F.min_by("time", "seq").alias("time"), F.min_by("speaker", "seq").alias("speaker"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ").alias("text"))
    numbered = sequences.hierarchical_ids(merged, ["sitting"], ORDER, F.col("kind") == "heading")
    gid = F.concat(F.lit(prefix), F.col("day").cast("string"), F.lit("."), F.col("major").cast("string"), F.lit("."), F.col("minor").cast("string"))
    return numbered.select("sitting", gid.alias("gid"), "major", "minor", "seq", "kind", F.nullif("speaker", F.lit("")).alias("speaker"), "time", "text")


def from_xml(days: DataFrame, prefix: str) -> DataFrame:
    """Rows of day documents (day, revision, xml): headings, speeches, timelines and column marks, in order.

    Elements: <heading>, <time>, <column n=''/>, <speech name='' [office='']>paragraphs<p>; all others are passed over.
    Ids are day, revision, column and a number that begins anew in each column; paragraphs are numbered in a speech.
    """
    pattern = r"(?s)<(heading|time|column|speech)\b([^>]*?)(?:/>|>(.*?)</\1>)"
    found = F.regexp_extract_all("xml", F.lit(pattern), F.lit(0))
    rows = days.select("day", "revision", F.posexplode(found).alias("seq", "e"))
    part = lambda i: F.regexp_extract("e", pattern, i)
    attribute = lambda n: F.nullif(F.regexp_extract(part(2), rf"\b{n}=['\"]([^'\"]*)['\"]", 1), F.lit(""))
    typed = rows.select("day", "revision", "seq", part(1).alias("kind"), attribute("n").alias("n"), attribute("name").alias("name"), attribute("office").alias("office"), part(3).alias("body"))
    keys = ["day", "revision"]
    typed = sequences.carry_forward(typed, keys, ORDER, F.when(F.col("kind") == "column", F.col("n")), "column")
    typed = sequences.carry_forward(typed, keys, ORDER, F.when(F.col("kind") == "time", dates.clock(markup.text_of(F.col("body")))), "time")
    typed = sequences.carry_forward(typed, keys, ORDER, F.when(F.col("kind") == "heading", F.trim(markup.text_of(F.col("body")))), "heading")
    shown = typed.filter("kind in ('heading', 'speech')")
    number = F.row_number().over(Window.partitionBy(*keys, "column").orderBy("seq")) - 1
    gid = F.concat(F.lit(prefix), F.col("day").cast("string"), "revision", F.lit("."), F.coalesce("column", F.lit("0")), F.lit("."), F.col("number").cast("string"))
    paras = F.filter(F.transform(F.split("body", r"(?i)</?p\b[^>]*>"), lambda p: F.trim(markup.text_of(p))), lambda p: p != "")
    return shown.withColumn("number", number).select("day", "revision", "seq", gid.alias("gid"), "kind", "name", "office", "heading", "time", "column", paras.alias("paras"))


def paragraph_ids(rows: DataFrame) -> DataFrame:
    """(gid, pid, text): a row for each paragraph, numbered from 1 within its speech."""
    return rows.select("gid", F.posexplode("paras").alias("_i", "text")).select("gid", F.concat_ws("/", "gid", (F.col("_i") + 1).cast("string")).alias("pid"), "text")


def from_report(pages: DataFrame) -> DataFrame:
    """Speeches of HTML reports (page_id, html) whose speakers stand in <strong>Name:</strong> before their words.

    Text before the first speaker has none; blocks after a speaker are theirs until the next. Gives (page_id, turn,
    speaker, office, text).
    """
    blocks = pages.select("page_id", F.posexplode(markup.paragraphs(F.regexp_replace("html", r"(?is)<strong>\s*([^<:]{2,80}):\s*</strong>", "<p>\u0002$1\u0003"))).alias("seq", "b"))
    marked = blocks.select("page_id", "seq", F.col("b.text").alias("text"), F.nullif(F.regexp_extract("b.text", "\u0002([^\u0003]*)\u0003", 1), F.lit("")).alias("named"))
    turned = sequences.running_count(marked, ["page_id"], ORDER, F.col("named").isNotNull(), "turn")
    texts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", F.trim(F.regexp_replace("text", "\u0002[^\u0003]*\u0003", "")).alias("t")))), lambda x: x["t"]), "\n")
    spoken = turned.groupBy("page_id", "turn").agg(F.max("named").alias("_n"), texts.alias("text"))
    who = names.brackets(F.col("_n"))
    return spoken.select("page_id", "turn", who["outside"].alias("speaker"), F.get(who["inside"], F.lit(0)).alias("office"), F.trim("text").alias("text"))


def divisions(lists: DataFrame) -> DataFrame:
    """(division_id, vote, family, given, seat, party, teller, proxy) from division lists (division_id, vote, lines).

    A line may end in 'Teller' or tell that a proxy cast the vote.
    """
    rows = lists.select("division_id", "vote", F.explode("lines").alias("line"))
    proxy = F.nullif(F.regexp_extract("line", r"\(Proxy vote cast by (.*?)\)", 1), F.lit(""))
    plain = F.trim(F.regexp_replace("line", r"\s*(\(Proxy vote cast by .*?\)|\(?Teller\)?)\s*$", ""))
    parsed = names.vote_line(plain)
    return rows.select("division_id", "vote", parsed["family"].alias("family"), parsed["given"].alias("given"), parsed["seat"].alias("seat"), parsed["party"].alias("party"), F.col("line").rlike(r"Teller\)?$").alias("teller"), proxy.alias("proxy"))


def tallies(votes: DataFrame) -> DataFrame:
    """Counts of each division by vote, tellers left out, and which is larger."""
    counted = votes.filter("not teller").groupBy("division_id").agg(*(F.count_if(F.col("vote") == v).alias(v) for v in ("aye", "no", "abstain")))
    return counted.withColumn("outcome", F.when(F.col("aye") > F.col("no"), "agreed").when(F.col("aye") < F.col("no"), "negatived").otherwise("tied"))


def written_answers(items: DataFrame) -> DataFrame:
    """Grouped written questions: (department, group_id, gid, uin, role, text).

    items: (uin, day, department, group, question, answer), group null for a question by itself. The smallest uin of a
    group stands for it and has the heading and the reply; later corrections of one uin give way to the first.
    """
    first = items.groupBy("uin").agg(F.min_by(F.struct(*items.columns), F.col("day")).alias("r")).select("r.*")
    named = first.withColumn("group_id", F.coalesce("group", "uin"))
    lead = named.groupBy("group_id").agg(F.min("uin").alias("lead"))
    rows = named.join(lead, "group_id").withColumn("place", F.row_number().over(Window.partitionBy("group_id").orderBy("uin")) - 1)
    base = F.concat_ws(".", F.col("day").cast("string"), "lead")
    parts = F.array(
        F.when(F.col("uin") == F.col("lead"), F.struct(F.lit("h").alias("role"), F.col("department").alias("text"))),
        F.struct(F.concat(F.lit("q"), F.col("place").cast("string")).alias("role"), F.col("question").alias("text")),
        F.when(F.col("uin") == F.col("lead"), F.struct(F.lit("r0").alias("role"), F.col("answer").alias("text"))),
    )
    return rows.select("department", "group_id", base.alias("_b"), "uin", F.inline(F.filter(parts, lambda p: p.isNotNull()))).select("department", "group_id", F.concat_ws(".", "_b", "role").alias("gid"), "uin", "role", "text")


def bilingual(contributions: DataFrame, votes: DataFrame) -> DataFrame:
    """Contributions (id, seq, text_en, text_cy) in both languages, missing text taken from the other, with the number
    of votes (contribution_id, ...) that hang on each."""
    from hustings.sources.files import both_languages

    counted = votes.groupBy(F.col("contribution_id").alias("id")).agg(F.count("*").alias("n_votes"))
    return both_languages(contributions.join(counted, "id", "left").withColumn("n_votes", F.coalesce("n_votes", F.lit(0))), {"text": {"en": "text_en", "cy": "text_cy"}})


def stretches(marks: DataFrame) -> DataFrame:
    """(sitting, speaker, minutes, words, words_per_minute) from rows (sitting, seq, time, speaker, text): time runs
    between marks in which just one person speaks."""
    timed = marks.withColumn("minute", dates.minutes_of_day(F.col("time")))
    ends = timed.select("sitting", "minute").distinct().withColumn("until", F.lead("minute").over(Window.partitionBy("sitting").orderBy("minute")))
    sole = timed.groupBy("sitting", "minute").agg(F.count_distinct("speaker").alias("n"), F.min("speaker").alias("speaker"), F.sum(F.size(F.split("text", r"\s+"))).alias("words")).filter("n = 1")
    total = sole.join(ends.filter("until > minute"), ["sitting", "minute"]).groupBy("speaker").agg(F.sum(F.col("until") - F.col("minute")).alias("minutes"), F.sum("words").alias("words"))
    return total.withColumn("words_per_minute", F.round(F.try_divide("words", "minutes"), 2))
