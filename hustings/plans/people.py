"""Upkeep of people, their names and memberships: tables in, tables out, a day as parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.functions.text import slugify
from hustings.operators import tables, temporal


def add_memberships(memberships: DataFrame, fresh: DataFrame, order: list[str]) -> DataFrame:
    """memberships (id, person_id, ...) with fresh ones, which get the ids after the greatest."""
    minted = tables.mint_ids(memberships, fresh.drop("id"), "id", order)
    return memberships.unionByName(minted, allowMissingColumns=True)


def end_memberships(memberships: DataFrame, which: Column, day: str, reason: str | None = None) -> DataFrame:
    """Those of the current memberships that fit end on a day, all of a body's or one person's; the rest stay."""
    now = which & F.col("end_date").isNull()
    out = memberships.withColumn("_now", F.coalesce(now, F.lit(False)))
    out = out.withColumn("end_date", F.when(F.col("_now"), F.lit(day).cast("date")).otherwise(F.col("end_date")))
    if reason is not None:
        out = out.withColumn("end_reason", F.when(F.col("_now"), reason).otherwise(F.col("end_reason")))
    return out.drop("_now")


def change_party(memberships: DataFrame, changes: DataFrame) -> DataFrame:
    """Current memberships of those in changes (person_id, party, day) end the day before, and new ones begin.

    New rows keep the seat and get the ids after the greatest; reasons tell the change on both.
    """
    c = changes.select("person_id", F.col("party").alias("_party"), F.col("day").alias("_day"))
    joined = memberships.join(c, "person_id", "left")
    turned = F.col("end_date").isNull() & F.col("_day").isNotNull() & ~F.col("party").eqNullSafe(F.col("_party"))
    ended = joined.withColumn("end_reason", F.when(turned, "changed_party").otherwise(F.col("end_reason"))).withColumn("end_date", F.when(turned, F.date_sub("_day", 1)).otherwise(F.col("end_date")))
    begun = joined.filter(turned).withColumn("start_date", F.col("_day")).withColumn("party", F.col("_party")).withColumn("start_reason", F.lit("changed_party"))
    return add_memberships(ended.select(*memberships.columns), begun.select(*memberships.columns), ["person_id"])


def party_chains(memberships: DataFrame) -> DataFrame:
    """(person_id, chain, start_date, end_date, parties): memberships that follow one another without a day between."""
    m = memberships.withColumn("_end", F.coalesce("end_date", F.lit(temporal.FOREVER).cast("date")))
    by = Window.partitionBy("person_id").orderBy("start_date", "id")
    joined = F.date_add(F.lag("_end").over(by), 1) == F.col("start_date")
    numbered = m.withColumn("_new", F.when(joined, 0).otherwise(1)).withColumn("chain", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    parties = F.transform(F.sort_array(F.collect_list(F.struct("start_date", "party"))), lambda x: x["party"])
    return numbered.groupBy("person_id", "chain").agg(F.min("start_date").alias("start_date"), F.nullif(F.max("_end"), F.lit(temporal.FOREVER).cast("date")).alias("end_date"), parties.alias("parties"))


def merge_people(persons: DataFrame, memberships: DataFrame, merges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """persons (id, names, identifiers) and memberships after merges (source, target): a merged person becomes a redirect,
    its names and identifiers go to the one that is left, and so do its memberships."""
    lead = tables.redirected(persons.select("id").withColumn("_to", F.col("id")), merges, "_to")
    gathered = persons.join(lead, "id").groupBy("_to").agg(F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"), F.array_distinct(F.flatten(F.collect_list("identifiers"))).alias("identifiers"))
    kept = gathered.select(F.col("_to").alias("id"), F.lit(None).cast(persons.schema["id"].dataType).alias("redirect"), F.array_sort("names").alias("names"), F.array_sort("identifiers").alias("identifiers"))
    gone = lead.filter("id <> _to").select("id", F.col("_to").alias("redirect"), F.lit(None).cast(persons.schema["names"].dataType).alias("names"), F.lit(None).cast(persons.schema["identifiers"].dataType).alias("identifiers"))
    return kept.union(gone), tables.redirected(memberships, merges, "person_id")


def name_on(names: DataFrame, day: str) -> DataFrame:
    """(person_id, shown): the main name valid on a day: given and family name of commoners, the style of peers."""
    valid = names.filter(F.col("note") == "Main").filter(temporal.valid_on(F.lit(day).cast("date"), F.col("start_date"), F.col("end_date")))
    first = valid.groupBy("person_id").agg(F.min_by(F.struct("given_name", "family_name", "honorific_prefix", "lordname", "lordofname"), F.coalesce("start_date", F.lit(temporal.BEGINNING).cast("date"))).alias("n"))
    peer = F.concat_ws(" ", "n.honorific_prefix", "n.lordname", F.when(F.col("n.lordofname").isNotNull(), F.concat(F.lit("of "), F.col("n.lordofname"))))
    is_peer = F.col("n.lordname").isNotNull() | F.col("n.lordofname").isNotNull()
    return first.select("person_id", F.when(is_peer, peer).otherwise(F.concat_ws(" ", "n.given_name", "n.family_name")).alias("shown"))


def over_full(memberships: DataFrame, seats: DataFrame) -> DataFrame:
    """Bodies with more current members than seats (organization_id, seats)."""
    now = memberships.filter("end_date is null").groupBy("organization_id").agg(F.count("*").alias("n_members"))
    return now.join(seats, "organization_id").filter("n_members > seats")


def misplaced(memberships: DataFrame, posts: DataFrame) -> DataFrame:
    """Memberships that lie in no, or in several, versions of their post (area, start_date, end_date)."""
    bounds = posts.select("area", F.col("start_date").alias("post_start"), F.coalesce("end_date", F.lit(temporal.FOREVER).cast("date")).alias("post_end"))
    ended = memberships.withColumn("end_date", F.coalesce("end_date", F.lit(temporal.FOREVER).cast("date")))
    return temporal.containment(ended, bounds, "area", "start_date", "end_date", "post_start", "post_end").filter("n_containers <> 1")


def historic_matches(people: DataFrame, urls: DataFrame) -> DataFrame:
    """(person_id, url) by name and the years of the first and last term, only where neither side has another."""
    both = people.join(urls, ["name", "first_year", "last_year"])
    sole = lambda k: both.groupBy(k).agg(F.count("*").alias("_n")).filter("_n = 1").select(k)
    return both.join(sole("person_id"), "person_id", "left_semi").join(sole("url"), "url", "left_semi").select("person_id", "url")


def profile_urls(identifiers: DataFrame, templates: dict[str, str]) -> DataFrame:
    """A row for each person with the address that each scheme's template, with {} for the identifier, gives."""
    addresses = [F.max(F.when(F.col("scheme") == s, F.replace(F.lit(t), F.lit("{}"), F.col("identifier")))).alias(s) for s, t in templates.items()]
    return identifiers.groupBy("person_id").agg(*addresses)


def committees(members: DataFrame) -> DataFrame:
    """(slug, name, chairs, members, n_external) from rows (committee, person, role, person_id)."""
    rows = members.withColumn("slug", slugify(F.col("committee")))
    chairs = F.sort_array(F.collect_set(F.when(F.lower("role").contains("chair"), F.col("person"))))
    return rows.groupBy("slug").agg(F.min("committee").alias("name"), chairs.alias("chairs"), F.sort_array(F.collect_set("person")).alias("members"), F.count_if(F.col("person_id").isNull()).alias("n_external"))


def party_disagreements(ours: DataFrame, theirs: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """(person_id, ours, theirs) where two sources name different parties after aliases are resolved."""
    names = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair)) if aliases else F.create_map().cast("map<string,string>")
    plain = lambda c: F.coalesce(F.try_element_at(names, c), c)
    both = ours.select("person_id", plain(F.col("party")).alias("ours")).join(theirs.select("person_id", plain(F.col("party")).alias("theirs")), "person_id")
    return both.filter(~F.col("ours").eqNullSafe(F.col("theirs")))
