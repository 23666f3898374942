"""Who is meant: names, seats, offices and identifiers, on a day, to people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.functions import names
from hustings.functions.text import strip_punctuation
from hustings.operators import tables, temporal


def key(s: Column) -> Column:
    return strip_punctuation(F.trim(s))


def aliases(terms: DataFrame) -> DataFrame:
    """The table that all rules look in: (person, kind, key, seat, start_date, end_date).

    terms: (person, name, seat, start_date, end_date). Each gives its full name, its family name and its seat.
    """
    full = key(F.col("name"))
    family = key(names.split_name(F.col("name"))["family"])
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("key")) for k, v in (("full", full), ("family", family), ("seat", key(F.col("seat"))))))
    return terms.select("person", key(F.col("seat")).alias("seat"), "start_date", "end_date", F.inline(kinds)).filter("key is not null")


def name_ranges(people_names: DataFrame, memberships: DataFrame) -> DataFrame:
    """Terms of people whose names changed: name ranges met with membership ranges, the days in common.

    people_names: (person, name, name_start, name_end); memberships: (person, seat, start_date, end_date).
    """
    both = people_names.alias("n").join(memberships.alias("m"), F.col("n.person") == F.col("m.person")).filter(temporal.overlaps(F.col("name_start"), F.col("name_end"), F.col("start_date"), F.col("end_date")))
    return both.select(F.col("n.person").alias("person"), "name", "seat", F.greatest("name_start", "start_date").alias("start_date"), F.least("name_end", "end_date").alias("end_date"))


def candidates(probes: DataFrame, alias: DataFrame, probe_id: str) -> DataFrame:
    """(probe_id, priority, person) by the first rule that finds anyone.

    probes: (probe_id, name, seat, day). Rules: the full name without titles; the family name, only if a title stood
    before it; the seat alone if there is no name. A given seat must be the candidate's; a missing day matches any term.
    """
    stripped = names.strip_titles(F.col("name"))
    p = probes.select(probe_id, "day", key(F.col("seat")).alias("p_seat"), key(stripped["name"]).alias("p_key"), stripped["n_titles"].alias("n_titles"))
    a = alias.select(F.col("person"), "kind", "key", "seat", "start_date", "end_date")
    then = temporal.valid_on(F.col("day"), F.col("start_date"), F.col("end_date"))
    there = F.col("p_seat").isNull() | (F.col("p_seat") == F.col("seat"))
    rules = [
        (a.filter("kind = 'full'"), (F.col("p_key") == F.col("key")) & then & there),
        (a.filter("kind = 'family'"), (F.col("p_key") == F.col("key")) & (F.col("n_titles") > 0) & then & there),
        (a.filter("kind = 'seat'"), F.col("p_key").isNull() & (F.col("p_seat") == F.col("key")) & then),
    ]
    return tables.cascade(p, probe_id, rules, "person")


def resolve(probes: DataFrame, alias: DataFrame, probe_id: str) -> DataFrame:
    """(probe_id, n_candidates, status, match); status is none, match or multiple, never a silent first."""
    return tables.match_status(probes, candidates(probes, alias, probe_id), probe_id, "person")


def by_identifier(probes: DataFrame, identifiers: DataFrame, terms: DataFrame, probe_id: str) -> DataFrame:
    """People by an identifier (scheme, identifier) and the day: probes (probe_id, scheme, identifier, day)."""
    found = probes.join(identifiers, ["scheme", "identifier"]).join(terms.select("person", "start_date", "end_date"), "person")
    valid = found.filter(temporal.valid_on(F.col("day"), F.col("start_date"), F.col("end_date")))
    return tables.match_status(probes, valid.select(probe_id, "person"), probe_id, "person")


def office_holders(probes: DataFrame, offices: DataFrame, probe_id: str) -> DataFrame:
    """People by an office on a day: (probe_id, n_candidates, status, match), a row for each of probes (probe_id, office, day).
    Offices end before their end date, and one without an end is not known on a day; a missing day matches any term.

    No probe meets a term: a sweep over each office's days tells how many people hold it from a day on, and a hash summed
    over them names the one where there is one only. Probes then meet that table by office and day.
    """
    held = offices.select(key(F.col("title")).alias("_office"), F.col("person").alias("_person"), F.col("start_date").cast("date").alias("_from"), F.col("end_date").cast("date").alias("_to")).filter("_office is not null and _person is not null").withColumn("_sign", F.xxhash64("_person").cast("decimal(20,0)"))
    # A person's terms in one office that overlap or touch are one.
    spans = temporal.contiguous(held.filter("_from < _to").withColumn("_to", F.date_sub("_to", 1)), ["_office", "_person", "_sign"], "_from", "_to")
    mark = lambda day, n: F.struct(day.alias("_day"), F.lit(n).alias("_n"), (F.col("_sign") * n).alias("_who"))
    marks = spans.select("_office", F.inline(F.array(mark(F.col("_from"), 1), mark(F.date_add("_to", 1), -1))))
    daily = marks.groupBy("_office", "_day").agg(F.sum("_n").alias("_n"), F.sum("_who").alias("_who"))
    asked = probes.select(probe_id, key(F.col("office")).alias("_office"), F.col("day").cast("date").alias("_day"))
    days = asked.filter("_office is not null and _day is not null").select("_office", "_day").distinct()
    # Marks of a day count on it, so they come before the probes of the day.
    sides = daily.withColumn("_asked", F.lit(0)).unionByName(days.withColumn("_asked", F.lit(1)), allowMissingColumns=True)
    so_far = Window.partitionBy("_office").orderBy("_day", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    then = sides.select("_office", "_day", "_asked", F.sum("_n").over(so_far).alias("_n"), F.sum("_who").over(so_far).alias("_who")).filter("_asked = 1 and _n > 0").drop("_asked")
    people = held.groupBy("_office", "_sign").agg(F.min("_person").alias("_person"))
    named = then.join(people.withColumnRenamed("_sign", "_who"), ["_office", "_who"], "left").select("_office", "_day", "_n", F.when(F.col("_n") == 1, F.col("_person")).alias("_person"))
    ever = held.groupBy("_office").agg(F.count_distinct("_person").alias("_n"), F.min("_person").alias("_person")).select("_office", F.lit(None).cast("date").alias("_day"), "_n", F.when(F.col("_n") == 1, F.col("_person")).alias("_person"))
    told = named.unionByName(ever)
    on = (asked["_office"] == told["_office"]) & asked["_day"].eqNullSafe(told["_day"])
    joined = asked.join(told, on, "left").select(probe_id, F.coalesce("_n", F.lit(0)).cast("long").alias("n_candidates"), "_person")
    status = F.when(F.col("n_candidates") == 0, "none").when(F.col("n_candidates") == 1, "match").otherwise("multiple")
    return joined.select(probe_id, "n_candidates", status.alias("status"), F.col("_person").alias("match"))


def by_history(speeches: DataFrame, found: DataFrame, order: str = "seq") -> DataFrame:
    """Ambiguous speakers settled by who spoke before: the latest earlier speaker in the same sitting who is among the
    candidates, the last one to speak before them left out, whatever rows (headings, say) stand between.

    speeches: (sitting, seq, person) with null where ambiguous; found: (sitting, seq, person), their candidates.
    Returns (sitting, seq, person, source): source is given, history or unknown.
    """
    asked = found.alias("c").join(speeches.filter("person is null").select("sitting", order).alias("s"), ["sitting", order])
    by = Window.partitionBy("sitting").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    last = speeches.withColumn("_last", F.last("person", ignorenulls=True).over(by)).select("sitting", order, "_last")
    spoken = speeches.filter("person is not null").select("sitting", order, "person", F.col(order).alias("_at"))
    # Candidates and known speakers in one sequence for each sitting and person, so no pairs are formed.
    latest = temporal.as_of(asked.select("sitting", order, "person"), spoken, ["sitting", "person"], order, [], "_at")
    usable = latest.join(last, ["sitting", order]).filter(F.col("latest__at").isNotNull() & ~F.col("person").eqNullSafe(F.col("_last")))
    best = usable.groupBy("sitting", order).agg(F.max_by("person", "latest__at").alias("_found"))
    joined = speeches.join(best, ["sitting", order], "left")
    source = F.when(F.col("person").isNotNull(), "given").when(F.col("_found").isNotNull(), "history").otherwise("unknown")
    return joined.select("sitting", order, F.coalesce("person", "_found").alias("person"), source.alias("source"))


def with_chair(speeches: DataFrame, order: str = "seq", chairs: tuple[str, ...] = ("The Chairman", "The Chair", "Mr Deputy Speaker")) -> DataFrame:
    """speeches (sitting, seq, speaker, chair, person) with person filled in where the speaker is only called by the chair's
    title: the one who took the chair last, by a row of the same sitting that has chair. Nobody yet leaves it null."""
    by = Window.partitionBy("sitting").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    held = F.last("chair", ignorenulls=True).over(by)
    return speeches.withColumn("_held", held).withColumn("person", F.coalesce("person", F.when(F.col("speaker").isin(*chairs), F.col("_held")))).drop("_held")


def redirect_people(df: DataFrame, persons: DataFrame, column: str = "person") -> DataFrame:
    """df with merged people led to the person that is left; persons: (id, redirect)."""
    return tables.redirected(df, persons.filter("redirect is not null").select(F.col("id").alias("source"), F.col("redirect").alias("target")), column)
