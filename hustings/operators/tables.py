"""Operators over keyed tables: latest rows, duplicates, upserts, merges, versions, nesting, candidates, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.sources.shared import with_checkpoints


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that is greatest by order. An aggregate, so each task passes on one row for each key."""
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
    return kept.select("_row.*")


def flag_latest(df: DataFrame, keys: list[str], at: str, name: str = "is_latest") -> DataFrame:
    """df with whether at is the greatest of its key; keys' greatest values are joined, so a hot key stays spread."""
    best = df.groupBy(*keys).agg(F.max(at).alias("_best"))
    return df.join(best, keys, "left").withColumn(name, F.col(at) == F.col("_best")).drop("_best")


def flag_duplicates(df: DataFrame, key: Column, row_id: str, name: str = "is_duplicate") -> DataFrame:
    """df with whether a row with a smaller row_id has the same key; nothing is removed."""
    keyed = df.withColumn("_key", key)
    first = keyed.groupBy("_key").agg(F.min(row_id).alias("_first"))
    return keyed.join(first, keyed["_key"].eqNullSafe(first["_key"]), "left").withColumn(name, F.col(row_id) > F.col("_first")).drop("_key", "_first")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def divided(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys that have several values where one is due, with how many: a check's faulty rows."""
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("n_values")).filter("n_values > 1")


def not_known_missing(wanted: DataFrame, missing: DataFrame, key: str, day: Column, again_after: int) -> DataFrame:
    """wanted without what was found missing (key, found_on) in the days before; older finds are tried again."""
    fresh = missing.filter(F.date_diff(day, F.col("found_on")) < again_after).select(key)
    return wanted.join(fresh, key, "left_anti")


def eav_pivot(df: DataFrame, key: str, attribute: str, value: str, names: list[str]) -> DataFrame:
    """One row for each key with the greatest value of each named attribute."""
    return df.groupBy(key).agg(*(F.max(F.when(F.col(attribute) == n, F.col(value))).alias(n) for n in names))


def unpivot(df: DataFrame, ids: list[str], values: list[str], slug: str = "slug", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, slug, value)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new, and the rows of old whose key new lacks."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def merge_actions(old: DataFrame, new: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """key and action: insert, unchanged, update, or rescinded where new lacks the key."""
    o, n = old.alias("o"), new.alias("n")
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    action = F.when(F.col(f"o.{key}").isNull(), "insert").when(F.col(f"n.{key}").isNull(), "rescinded").when(same, "unchanged").otherwise("update")
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), action.alias("action"))


def attribute_sync(held: DataFrame, wanted: DataFrame, key: str, value: str) -> DataFrame:
    """key, value and action for sparse attributes: set, clear, change or keep; value is the one to hold after."""
    h, w = held.alias("h"), wanted.alias("w")
    hv, wv = F.col(f"h.{value}"), F.col(f"w.{value}")
    action = F.when(wv.isNull(), "clear").when(hv.isNull(), "set").when(hv == wv, "keep").otherwise("change")
    return h.filter(F.col(value).isNotNull()).alias("h").join(w.filter(F.col(value).isNotNull()).alias("w"), F.col(f"h.{key}") == F.col(f"w.{key}"), "full_outer").select(F.coalesce(f"h.{key}", f"w.{key}").alias(key), wv.alias(value), action.alias("action"))


def mint_ids(existing: DataFrame, fresh: DataFrame, id_column: str, order: list[str]) -> DataFrame:
    """fresh with new ids that follow the greatest of existing, in order."""
    from hustings.operators.sequences import global_rank

    greatest = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("_most"))
    ranked = global_rank(fresh, [F.col(c) for c in order], "_place")
    return ranked.crossJoin(F.broadcast(greatest)).withColumn(id_column, F.col("_most") + F.col("_place")).drop("_most", "_place")


def append_missing(values: Column, extra: Column) -> Column:
    """An array with the elements of another that it lacks at its end."""
    return F.concat(F.coalesce(values, F.array()), F.array_except(F.coalesce(extra, F.array()), F.coalesce(values, F.array())))


def version_class(old: Column, new: Column) -> Column:
    """SAME, EXTENSION (new begins with all of old) or DIFFERENT."""
    return F.when(old == new, "SAME").when(new.startswith(old), "EXTENSION").otherwise("DIFFERENT")


def changed(old: DataFrame, new: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of new whose content differs from that of old or that old lacks, by a hash of it. Missing text is content
    too."""
    digest = F.sha2(F.coalesce(F.col(text), F.lit("\0")), 256).alias("_h")
    return new.withColumn("_h", digest).join(old.select(key, digest), [key, "_h"], "left_anti").drop("_h")


def nested(df: DataFrame, outer: list[str], inner: list[str], leaf: Column, leaves: str = "items", children: str = "children") -> DataFrame:
    """Rows of outer keys with an array of inner groups, each with an array of leaves, all in sorted order."""
    one = df.groupBy(*outer, *inner).agg(F.sort_array(F.collect_list(leaf)).alias(leaves))
    return one.groupBy(*outer).agg(F.sort_array(F.collect_list(F.struct(*inner, leaves))).alias(children))


def parent_children(df: DataFrame, row_id: str, parent: str) -> DataFrame:
    """(parent, n_children, first_child, last_child, known): known tells whether the parent is a row itself."""
    kids = df.filter(F.col(parent).isNotNull()).groupBy(F.col(parent).alias("_p")).agg(F.count("*").alias("n_children"), F.min(row_id).alias("first_child"), F.max(row_id).alias("last_child"))
    own = df.select(F.col(row_id).alias("_id")).distinct()
    return kids.join(own, F.col("_p") == F.col("_id"), "left").select(F.col("_p").alias("parent"), "n_children", "first_child", "last_child", F.col("_id").isNotNull().alias("known"))


def cascade(probes: DataFrame, probe_id: str, rules: list[tuple[DataFrame, Column]], found: str) -> DataFrame:
    """Candidates by the first rule that gives any: (probe_id, priority, found).

    rules: (table with a column found, join condition) in order of priority, from 1. A rule sees only the probes that
    none before it has settled; what those found is written once each, as the rules after them ask for it too.
    """
    with_checkpoints(probes.sparkSession)
    open_probes, every = probes, None
    for i, (t, on) in enumerate(rules):
        part = open_probes.join(t, on).select(probe_id, F.lit(i + 1).alias("priority"), F.col(found)).distinct()
        if i < len(rules) - 1:
            part = part.checkpoint()
            open_probes = open_probes.join(part.select(F.col(probe_id).alias("_settled")).distinct(), F.col(probe_id) == F.col("_settled"), "left_anti")
        every = part if every is None else every.union(part)
    return every


def match_status(probes: DataFrame, candidates: DataFrame, probe_id: str, found: str) -> DataFrame:
    """(probe_id, n_candidates, status, match): none, match or multiple, and the candidate if there is just one."""
    counted = candidates.groupBy(probe_id).agg(F.count_distinct(found).alias("n"), F.min(found).alias("_m"))
    joined = probes.select(probe_id).join(counted, probe_id, "left").withColumn("n_candidates", F.coalesce("n", F.lit(0)).cast("long"))
    status = F.when(F.col("n_candidates") == 0, "none").when(F.col("n_candidates") == 1, "match").otherwise("multiple")
    return joined.select(probe_id, "n_candidates", status.alias("status"), F.when(F.col("n_candidates") == 1, F.col("_m")).alias("match"))


def candidate_intersection(clues: list[DataFrame], probe_id: str, found: str) -> DataFrame:
    """Candidates that every clue which has any for the probe agrees on."""
    every = None
    for i, c in enumerate(clues):
        part = c.select(probe_id, found, F.lit(1 << i).cast("long").alias("_clue"))
        every = part if every is None else every.union(part)
    # A bit for each clue: those that name the candidate, and those that have any for the probe.
    got = every.filter(F.col(probe_id).isNotNull()).groupBy(probe_id, found).agg(F.bit_or("_clue").alias("_got"))
    return got.withColumn("_needed", F.bit_or("_got").over(Window.partitionBy(probe_id))).filter("_got = _needed").select(probe_id, found)


def symmetric_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that one side lacks, and the side that has them."""
    l, r = left.select(key).distinct().withColumn("_l", F.lit(1)), right.select(key).distinct().withColumn("_r", F.lit(1))
    return l.join(r, key, "full_outer").filter("_l is null or _r is null").select(key, F.when(F.col("_l").isNull(), "right").otherwise("left").alias("only_in"))


def positional(left: DataFrame, right: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of both sides paired by their place within keys; the longer side's rest has nulls."""
    number = lambda df: df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    return number(left).join(number(right), [*keys, "place"], "full_outer")


def redirected(df: DataFrame, redirects: DataFrame, column: str) -> DataFrame:
    """df with column led on by redirects (source, target) until none applies; in a loop it ends on some member. Of a
    source's targets the least counts.

    Chains are followed by pointing each at its target's target, so a chain of n needs about log n joins of the
    redirects; each round is checkpointed.
    """
    with_checkpoints(df.sparkSession)
    now = redirects.filter("source <> target").groupBy("source").agg(F.min("target").alias("target"))
    for _ in range(now.count().bit_length() + 1):
        a, b = now.alias("a"), now.alias("b")
        step = a.join(b, F.col("a.target") == F.col("b.source"), "left").select("a.source", F.when(F.col("b.target").isNull() | (F.col("b.target") == F.col("a.source")), F.col("a.target")).otherwise(F.col("b.target")).alias("target"), (F.col("b.target").isNotNull() & (F.col("b.target") != F.col("a.source"))).alias("moved")).checkpoint()
        now = step.select("source", "target")
        if step.filter("moved").isEmpty():
            break
    return df.join(now.select(F.col("source").alias(column), "target"), column, "left").withColumn(column, F.coalesce("target", column)).drop("target")


def report(checks: dict[str, DataFrame]) -> DataFrame:
    """Data-quality results: for each named table of faulty rows how many there are, and whether it passed."""
    out = None
    for name, faulty in sorted(checks.items()):
        one = faulty.agg(F.count("*").alias("n_faulty")).select(F.lit(name).alias("rule"), "n_faulty", (F.col("n_faulty") == 0).alias("passed"))
        out = one if out is None else out.union(one)
    return out
