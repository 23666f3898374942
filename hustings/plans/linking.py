"""Entity links: phrases that a text mentions, checked and led to page titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.functions.text import phrase_fault, wiki_title
from hustings.operators import tables, temporal

#: Runs of capitalised words stand in for a tagger of names.
CAPITALISED = r"\b([A-Z][\w'-]+(?: (?:of |the |and )*[A-Z][\w'-]+)*)"


def mentions(docs: DataFrame, key: str, text: str, pattern: str = CAPITALISED) -> DataFrame:
    """(key, place, phrase) of every phrase that the pattern's first group finds."""
    return docs.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))).alias("place", "phrase"))


def final_titles(pages: DataFrame, redirects: DataFrame, key: str) -> DataFrame:
    """(key, final, ambiguous): a page's title and flag, or those of the page that it redirects to.

    pages: (key, title, ambiguous); redirects: (key, target). A redirect to a page that isn't there is passed over.
    """
    goal = pages.select(F.col(key).alias("target"), F.col("title").alias("_title"), F.col("ambiguous").alias("_ambiguous"))
    led = pages.join(redirects, key, "left").join(goal, "target", "left")
    return led.select(key, F.coalesce("_title", "title").alias("final"), F.coalesce("_ambiguous", "ambiguous").alias("ambiguous"))


def page_properties(pages: DataFrame, properties: DataFrame, key: str, names: list[str], keep_bare: bool = False) -> DataFrame:
    """pages with their named properties as columns; pages without any property go, unless kept."""
    return pages.join(tables.eav_pivot(properties, key, "name", "value", names), key, "left" if keep_bare else "inner")


def link(found: DataFrame, titles: DataFrame, key: str, people: DataFrame | None = None, banned: tuple[str, ...] = ()) -> DataFrame:
    """Every mention with title, discarded and reason; nothing is removed.

    found: (key, place, phrase, day); titles: (requested, final, ambiguous). Reasons, the last that holds: the phrase is
    poor; no such page, or an ambiguous one; a person of people (name, start_date, end_date) of that day has the name;
    the text has linked the page before.
    """
    asked = found.withColumn("requested", wiki_title(F.col("phrase")))
    rows = asked.join(titles, "requested", "left").withColumn("reason", phrase_fault(F.col("phrase"), banned))
    rows = rows.withColumn("reason", F.when(F.col("final").isNull(), "no page").when(F.col("ambiguous"), "ambiguous").otherwise(F.col("reason")))
    if people is not None:
        sitting = people.select(F.col("name").alias("phrase"), "start_date", "end_date")
        members = found.select(key, "place", "phrase", "day").join(sitting, "phrase").filter(temporal.valid_on(F.col("day"), F.col("start_date"), F.col("end_date"))).select(key, "place").distinct().withColumn("_member", F.lit(True))
        rows = rows.join(members, [key, "place"], "left").withColumn("reason", F.when(F.col("_member"), "person").otherwise(F.col("reason"))).drop("_member")
    first = rows.filter("reason is null").groupBy(key, "final").agg(F.min("place").alias("_first"))
    rows = rows.join(first, [key, "final"], "left").withColumn("reason", F.when(F.col("reason").isNull() & (F.col("place") > F.col("_first")), "repeated").otherwise(F.col("reason")))
    return rows.withColumn("discarded", F.col("reason").isNotNull()).select(key, "place", "phrase", F.col("final").alias("title"), "discarded", "reason")


def allow_list(linked: DataFrame) -> DataFrame:
    """Phrases that were linked somewhere and nowhere discarded."""
    return linked.filter("not discarded").select("phrase").distinct().subtract(linked.filter("discarded").select("phrase"))
