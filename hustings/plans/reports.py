"""Official reports of a chamber, from pages to speeches, headings and divisions, over the pages' element trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.functions.text import tidy
from hustings.plans import trees

#: Headings of the lists of a division, and ways to misspell one.
WAYS, MISSPELT = ("FOR", "AGAINST", "ABSTENTIONS", "SPOILED VOTES"), ("ABSTENTION", "ABSENTIONS")
#: What may follow a speaker as part of the speech, and headings of vote lists in it.
SPOKEN = ("p", "ul", "ol", "table", "blockquote", "dl", "div", "i", "b", "em", "u", "sup", "sub")
VOTES = ("For", "Against", "Abstentions")


def division_way(s: Column) -> Column:
    """struct<way, target>: how a heading tells that votes follow, and for what (a candidate, an option, an oath); null if it
    doesn't."""
    plain = F.regexp_replace(F.upper(tidy(s)), r"(?U)^\W*(.*?)\W*$", "$1")
    candidate = F.coalesce(F.nullif(F.regexp_extract(plain, "^VOTES? FOR ([A-Z -]+)$", 1), F.lit("")), F.nullif(F.regexp_extract(plain, r"^FOR ((?:[A-Z]+\s*){2,4})$", 1), F.lit("")))
    # Long texts that begin with FOR are no headings.
    candidate = F.when(F.size(F.split(plain, r"\s+")) < 128, candidate)
    option = F.nullif(F.regexp_extract(plain, r"FOR OPTION (\d+)$", 1), F.lit(""))
    oath = plain.rlike(r"^THE FOLLOWING MEMBERS? TOOK THE OATH( AND REPEATED IT IN .*)?:?$")
    affirmation = plain.rlike(r"^THE FOLLOWING MEMBERS? MADE A SOLEMN AFFIRMATION( AND REPEATED IT IN .*)?:?$")
    told = lambda way, target: F.struct(way.alias("way"), target.cast("string").alias("target"))
    none = F.lit(None)
    return (
        F.when(plain.isin(*WAYS), told(plain, none)).when(plain.isin(*MISSPELT), told(F.lit("ABSTENTIONS"), none)).when(oath, told(F.lit("FOR"), F.lit("oath"))).when(affirmation, told(F.lit("FOR"), F.lit("affirmation")))
        .when(candidate.isNotNull(), told(F.lit("FOR"), F.initcap(F.trim(candidate)))).when(option.isNotNull(), told(F.lit("FOR"), F.concat(F.lit("Option "), option)))
    )


def voter(s: Column) -> Column:
    """struct<name, seat, party> of a line 'Family, Given (Seat) (Party)' or 'Given Family (Seat) (Party)', titles left in the
    given name; null for what is no such line. A party may lack; a seat is words, so numbers and clauses are no votes."""
    plain = tidy(s)
    seat, party = r"\(([\p{L}][\p{L} ,.'&-]*)\)", r"(?:\s*\(([\p{L}][\p{L} &-]*)\))?"
    turned, straight = rf"^([\p{{L}}'’ -]+), ([\p{{L}}'’. -]+?)\s*{seat}{party}\s*$", rf"^((?:[\p{{Lu}}][\p{{L}}'’.-]*)(?: [\p{{Lu}}][\p{{L}}'’.-]*)+)\s*{seat}{party}\s*$"
    part = lambda pattern, k: F.nullif(F.regexp_extract(plain, pattern, k), F.lit(""))
    return F.when(plain.rlike(turned), F.struct(F.concat_ws(" ", part(turned, 2), part(turned, 1)).alias("name"), part(turned, 3).alias("seat"), part(turned, 4).alias("party"))).when(
        plain.rlike(straight), F.struct(part(straight, 1).alias("name"), part(straight, 2).alias("seat"), part(straight, 3).alias("party"))
    )


def report(pages: DataFrame, key: str, html: str) -> tuple[DataFrame, DataFrame]:
    """Speeches and votes of every page's report.

    Speeches: (key, seq, kind, speaker, href, member, text, anchor), a row for each speech, heading and division in order.
    A strong with a link begins a speech (member is the link's name, 0 for outside speakers), so does a bold name at the
    head of a contribution; blocks that follow are part of it until the next speaker or heading, a p of class lead. A p
    that says For, Against or Abstentions makes of the p after it a list of votes: the speech ends there, lists after one
    another are a division, and what follows is a speech of the same speaker. Blocks before any speaker, or after a heading
    until the next one, have none.
    Votes: (key, seq, number, vote, name), seq that of their division, number its count within the page.
    """
    nodes = trees.parsed(pages, key, html).checkpoint()
    tag, page = (lambda name: F.col("tag") == name), Window.partitionBy(key).orderBy("pre")
    strong = trees.with_text(trees.select(nodes, key, ("descendant", tag("strong"))), nodes, key).select(key, "pre", "last", F.trim("content").alias("said"))
    links = trees.enclosing(strong, nodes.filter(tag("a")).select(key, "pre", F.col("attrs")["href"].alias("href"), F.col("attrs")["name"].alias("member")), key)
    named = links.filter("href <> '' or member = '0'").groupBy(key, F.col("at").alias("pre")).agg(F.min_by("href", "pre").alias("href"), F.min_by("member", "pre").alias("member"))
    speakers = strong.join(named, [key, "pre"]).select(key, "pre", "last", F.col("said").alias("speaker"), "href", "member")
    bold = trees.with_text(trees.select(nodes, key, ("descendant", tag("p") & trees.has_class("or-contribution-box")), ("descendant", trees.has_class("or-bill-section-bold"))), nodes, key)
    bold = bold.filter(~F.trim("content").isin(*VOTES) & (F.trim("content") != "")).select(key, "pre", "last", F.trim("content").alias("speaker"), F.lit(None).cast("string").alias("href"), F.lit(None).cast("string").alias("member"))
    marks = speakers.unionByName(bold)
    # Blocks: elements that hold text of a speech and stand in no other such element; divs only hold others.
    held = F.max(F.when(F.col("tag").isin(*(t for t in SPOKEN if t not in ("div", "blockquote"))), F.col("last"))).over(page.rowsBetween(Window.unboundedPreceding, -1))
    outer = nodes.withColumn("_held", F.coalesce(held, F.lit(-1))).filter(F.col("tag").isin(*(t for t in SPOKEN if t not in ("div", "blockquote"))) & (F.col("_held") < F.col("pre")))
    whole = trees.with_text(outer, nodes, key)
    # A speaker's name at the head of a block is not part of what is said.
    inside = trees.enclosing(outer, marks.select(key, "pre", "speaker"), key).groupBy(key, F.col("at").alias("pre")).agg(F.min_by("speaker", "pre").alias("_name"))
    said = whole.join(inside, [key, "pre"], "left").withColumn("text", F.trim(F.regexp_replace("content", r"\s+", " ")))
    said = said.withColumn("text", F.when(F.col("_name").isNotNull() & F.col("text").startswith(F.col("_name")), F.trim(F.expr("substring(text, length(_name) + 1)"))).otherwise(F.col("text")))
    lead = tag("p") & trees.has_class("lead")
    after = F.lag("text").over(Window.partitionBy(key).orderBy("pre"))
    kind = F.when(lead, "heading").when(tag("p") & F.col("text").isin(*VOTES), "way").when(tag("p") & after.isin(*VOTES), "votes").otherwise("said")
    blocks = said.withColumn("kind", kind).withColumn("vote", F.when(F.col("kind") == "votes", F.lower(after)))
    rows = blocks.select(key, F.col("pre"), "last", "kind", "vote", "text", F.col("attrs")["id"].alias("anchor"), F.lit(1).alias("_own"))
    rows = rows.unionByName(marks.withColumn("kind", F.lit("speaker")).withColumn("_own", F.lit(0)), allowMissingColumns=True)
    # A name inside a block stands before the block's words.
    starts = trees.enclosing(outer, marks.select(key, "pre"), key).select(key, "pre", "at")
    rows = rows.join(starts, [key, "pre"], "left").withColumn("place", F.coalesce(F.when(F.col("_own") == 0, F.col("at")), F.col("pre"))).filter("kind <> 'way'")
    order = Window.partitionBy(key).orderBy("place", "_own", "pre")
    speech = F.last(F.when(F.col("kind").isin("speaker", "heading"), F.struct("kind", "speaker", "href", "member")), True).over(order)
    listed, before = F.col("kind") == "votes", F.lag("kind").over(order)
    turn = F.col("kind").isin("speaker", "heading") | (listed & ~F.coalesce(before == "votes", F.lit(False))) | (~listed & (before == "votes")) | (before == "heading")
    numbered = rows.withColumn("_of", speech).withColumn("seq", F.sum(F.coalesce(turn, F.lit(False)).cast("int")).over(order)).filter((F.col("kind") == "speaker") | (F.col("text") != ""))
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("kind").isin("said", "heading"), F.struct("place", "text")))), lambda x: x["text"]), "\n")
    of = lambda c: F.first(F.when(F.col("_of.kind") == "speaker", F.col(f"_of.{c}")), True).alias(c)
    kinds = F.when(F.max(F.col("kind") == "votes"), "division").when(F.max(F.col("kind") == "heading"), "heading").otherwise("speech")
    speeches = numbered.groupBy(key, "seq").agg(kinds.alias("kind"), *(of(c) for c in ("speaker", "href", "member")), lines.alias("text"), F.min_by("anchor", "place").alias("anchor"))
    divided = numbered.filter("kind = 'votes'").withColumn("number", F.dense_rank().over(Window.partitionBy(key).orderBy("seq")))
    # Voters stand between line breaks, which start where the next one's text does.
    breaks = trees.enclosing(divided.select(key, "pre", "last"), nodes.filter(tag("br")).select(key, "pre", "start"), key).groupBy(key, F.col("at").alias("pre")).agg(F.sort_array(F.collect_list("start")).alias("breaks"))
    ends = nodes.select(key, "pre", "start", "end")
    cut = divided.select(key, "seq", "number", "vote", "pre").join(ends, [key, "pre"]).join(breaks, [key, "pre"], "left").join(nodes.filter("pre = 0").select(key, F.col("text").alias("_whole")), key)
    edges = F.concat(F.array("start"), F.coalesce("breaks", F.array().cast("array<int>")), F.array("end"))
    pieces = F.transform(F.sequence(F.lit(1), F.size("edges") - 1), lambda i: F.trim(F.substring(F.col("_whole"), F.element_at("edges", i) + 1, F.element_at("edges", i + 1) - F.element_at("edges", i))))
    names = cut.withColumn("edges", edges).select(key, "seq", "number", "vote", F.explode(F.filter(pieces, lambda x: x != "")).alias("name"))
    return speeches, names


def counts(votes: DataFrame, key: str) -> DataFrame:
    """(key, number, for, against, abstentions) of report()'s votes."""
    return votes.groupBy(key, "number").agg(*(F.count_if(F.col("vote") == v.lower()).alias(v.lower()) for v in VOTES))
