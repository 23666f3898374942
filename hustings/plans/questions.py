"""Blocks of questions and answers led from an old version to a new one: by number, then by likeness of their words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.functions.text import SPACE, similarity_to

#: The number of a question whose number is missing.
NO_NUMBER = "0"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def likely_pairs(old: DataFrame, new: DataFrame, least: tuple[int, int] = (4, 5)) -> DataFrame:
    """(work, old_gid, new_gid): every pair of blocks (work, gid, words) of a work whose words may match to the fraction
    `least`, twice the words in common over all words; none that can is left out.

    Of two such blocks each has at least num / (2 den - num) of the other's words, so they share num / (2 den - num) of the
    longer one's, and one of them is among the rarest that are left when so many are taken away. Those alone are joined, the
    n-th occurrence of a word with the n-th; blocks without words meet each other.
    """
    num, den = least
    sides = []
    for rows in (old, new):
        each = rows.select("work", "gid", F.size("words").alias("n"), F.posexplode_outer("words").alias("at", "word"))
        sides.append(each.withColumn("nth", F.row_number().over(Window.partitionBy("work", "gid", "word").orderBy("at"))).withColumn("word", F.coalesce("word", F.lit(""))))
    counts = sides[0].select("work", "word", "nth").unionByName(sides[1].select("work", "word", "nth")).groupBy("work", "word", "nth").agg(F.count("*").alias("held"))
    rare = []
    for rows in sides:
        ranked = rows.join(counts, ["work", "word", "nth"]).withColumn("rank", F.row_number().over(Window.partitionBy("work", "gid").orderBy("held", "word", "nth")))
        rare.append(ranked.filter(F.col("rank") <= F.col("n") - F.expr(f"(n * {num} + {2 * den - num - 1}) div {2 * den - num}") + 1))
    a = rare[0].select("work", "word", "nth", F.col("gid").alias("old_gid"), F.col("n").alias("old_n"))
    b = rare[1].select("work", "word", "nth", F.col("gid").alias("new_gid"), F.col("n").alias("new_n"))
    met = a.join(b, ["work", "word", "nth"])
    fits = F.least("old_n", "new_n") * (2 * den - num) >= F.greatest("old_n", "new_n") * num
    return met.filter(fits).select("work", "old_gid", "new_gid").distinct()


def mutual(pairs: DataFrame) -> DataFrame:
    """(work, old_gid, new_gid, alike): pairs (work, old_gid, new_gid, alike) such that no block is in two.

    In rounds, those that are each other's best stay and leave the table with all that either is in; ties go to the lower
    gid. The best pair of a work is always mutual, so rounds end.
    """
    left, done = pairs.checkpoint(), None
    while not left.isEmpty():
        order = lambda other: [F.desc("alike"), F.col(other)]
        for_old = F.row_number().over(Window.partitionBy("work", "old_gid").orderBy(*order("new_gid")))
        for_new = F.row_number().over(Window.partitionBy("work", "new_gid").orderBy(*order("old_gid")))
        agreed = left.withColumn("_a", for_old).withColumn("_b", for_new).filter("_a = 1 and _b = 1").drop("_a", "_b").checkpoint()
        done = agreed if done is None else done.unionByName(agreed)
        for side in ("old_gid", "new_gid"):
            left = left.join(agreed.select("work", side), ["work", side], "left_anti")
        left = left.select(*pairs.columns).checkpoint()
    return pairs.limit(0) if done is None else done


def redirects(old: DataFrame, new: DataFrame, least: float = 0.8) -> DataFrame:
    """(work, gid, kind, target, by): where each block of old (work, seq, gid, numbers, text) went in new (likewise).

    numbers are those of a block's questions. The first of them that a block of new has decides (by number); blocks of which
    none is there are led to one of the work's blocks without a number (none or "0") whose words are more than `least`
    alike, each to one of its own (by likeness). kind is perfectmatch if the words are the same, else changes. What is left
    is removed; its target is the work's first new block, null if there is none. by is divided where a block's numbers are in
    several new blocks. Missing texts count as empty; a number in several new blocks stands for the lowest gid.
    """
    a, b = (rows.select("work", "seq", "gid", "numbers", _words(F.col("text")).alias("words"), F.coalesce("text", F.lit("")).alias("text")).checkpoint() for rows in (old, new))
    asked = a.select("work", "gid", F.posexplode("numbers").alias("place", "number")).filter(F.col("number") != NO_NUMBER)
    held = b.select("work", F.col("gid").alias("target"), F.explode("numbers").alias("number")).filter(F.col("number") != NO_NUMBER).groupBy("work", "number").agg(F.min("target").alias("target"))
    numbered = asked.join(held, ["work", "number"]).groupBy("work", "gid").agg(F.min_by("target", "place").alias("target"), (F.count_distinct("target") > 1).alias("divided"))
    by_number = numbered.select("work", "gid", "target", F.when(F.col("divided"), "divided").otherwise("number").alias("by")).checkpoint()
    rest = a.join(by_number, ["work", "gid"], "left_anti").checkpoint()
    nameless = b.filter(F.forall(F.coalesce("numbers", F.array().cast("array<string>")), lambda n: n == NO_NUMBER))
    share = int(round(least * 1000))
    pairs = likely_pairs(rest.select("work", "gid", "words"), nameless.select("work", "gid", "words"), (share, 1000))
    texts = pairs.join(rest.select("work", F.col("gid").alias("old_gid"), F.array_join("words", " ").alias("x")), ["work", "old_gid"]).join(nameless.select("work", F.col("gid").alias("new_gid"), F.array_join("words", " ").alias("y")), ["work", "new_gid"])
    rated = texts.select("work", "old_gid", "new_gid", similarity_to()(F.col("x"), F.col("y")).alias("alike")).filter(F.col("alike") > least)
    by_likeness = mutual(rated).select("work", F.col("old_gid").alias("gid"), F.col("new_gid").alias("target"), F.lit("likeness").alias("by"))
    led = by_number.unionByName(by_likeness)
    firsts = b.groupBy("work").agg(F.min_by("gid", "seq").alias("head"))
    every = a.join(led, ["work", "gid"], "left").join(b.select("work", F.col("gid").alias("target"), F.col("words").alias("new_words")), ["work", "target"], "left").join(firsts, "work", "left")
    kind = F.when(F.col("target").isNull(), "removed").when(F.col("words") == F.col("new_words"), "perfectmatch").otherwise("changes")
    return every.select("work", "gid", kind.alias("kind"), F.coalesce("target", "head").alias("target"), F.coalesce("by", F.lit("none")).alias("by"))


def parts_led(old: DataFrame, new: DataFrame, led: DataFrame, parts: str) -> DataFrame:
    """(work, gid, kind, target): the ids in the array `parts` (questions, answers) of old's blocks led to those of the blocks
    that redirects() found, the first to the first and so on; with kind missing where the new block has fewer."""
    rows = led.filter("kind <> 'removed'").select("work", F.col("gid").alias("_old"), F.col("target").alias("_new"), "kind")
    met = rows.join(old.select("work", F.col("gid").alias("_old"), F.posexplode(parts).alias("at", "gid")), ["work", "_old"])
    there = new.select("work", F.col("gid").alias("_new"), F.posexplode(parts).alias("at", "target"))
    return met.join(there, ["work", "_new", "at"], "left").select("work", "gid", F.when(F.col("target").isNull(), "missing").otherwise(F.col("kind")).alias("kind"), "target")


def headings_led(old: DataFrame, new: DataFrame) -> DataFrame:
    """(work, gid, kind, target): headings (work, seq, gid, text) led to headings with the same words, the n-th to the n-th;
    others are removed, with the work's first heading as target."""
    key = F.trim(F.coalesce("text", F.lit("")))
    nth = F.row_number().over(Window.partitionBy("work", "key").orderBy("seq"))
    a, b = (rows.withColumn("key", key).withColumn("nth", nth) for rows in (old, new))
    met = a.select("work", "gid", "key", "nth").join(b.select("work", "key", "nth", F.col("gid").alias("target")), ["work", "key", "nth"], "left")
    firsts = new.groupBy("work").agg(F.min_by("gid", "seq").alias("head"))
    return met.join(firsts, "work", "left").select("work", "gid", F.when(F.col("target").isNull(), "removed").otherwise("perfectmatch").alias("kind"), F.coalesce("target", "head").alias("target"))
