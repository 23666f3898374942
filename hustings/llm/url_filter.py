"""URL filters by a temporal list join: dated list entries become validity intervals, met as of each fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of list entries, the most specific last.
KINDS = ("domain", "host", "prefix", "url")


def host_of(url: Column) -> Column:
    """The lower-case host of an absolute URL, without user and port; '' if it has none."""
    host = F.lower(F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def path_of(url: Column) -> Column:
    """The path of an absolute URL, at least '/', without query and fragment."""
    path = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.when(F.coalesce(path, F.lit("")) == "", F.lit("/")).otherwise(path)


def validity(entries: DataFrame) -> DataFrame:
    """(kind, value, list, category, valid_from, valid_to) from dated entries (kind, value, list, action, dated, category).

    An entry with action 'add' is active from its date until the next dated entry of the same (kind, value, list), or
    without end (null). 'remove' only ends. Of entries of one date, a removal counts as the earlier, and the last add by
    category holds; entries with a missing date, kind, value or list are void. Values are compared in lower case but for
    prefix and url, whose paths keep theirs.
    """
    usable = entries.filter("dated is not null and value is not null and list is not null and action in ('add', 'remove')").filter(F.col("kind").isin(*KINDS))
    usable = usable.withColumn("value", F.when(F.col("kind").isin("domain", "host"), F.lower("value")).otherwise(F.col("value")))
    by = Window.partitionBy("kind", "value", "list").orderBy("dated", F.desc("action"), "category")
    ended = usable.withColumn("valid_to", F.lead("dated").over(by))
    return ended.filter("action = 'add' and (valid_to is null or valid_to > dated)").select("kind", "value", "list", "category", F.col("dated").alias("valid_from"), "valid_to")


def lookup_keys(url: Column) -> Column:
    """array<struct<kind, value, depth>>: every entry that could name this URL; depth orders them by how exact they are.

    Domains are the host's endings of two labels or more, prefixes the host with each of the path's folders.
    """
    host, path = host_of(url), path_of(url)
    labels, folders = F.split(host, r"\."), F.split(path, "/")
    count = F.size(labels)
    domains = F.transform(F.sequence(F.lit(2), F.greatest(count, F.lit(2))), lambda n: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, F.greatest(count - n + 1, F.lit(1)), n), ".").alias("value"), n.alias("depth")))
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(folders) - 1, F.lit(1))), lambda n: F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.array_join(F.slice(folders, F.lit(1), n), "/"), F.lit("/")).alias("value"), n.alias("depth")))
    exact = F.array(F.struct(F.lit("host").alias("kind"), host.alias("value"), F.lit(0).alias("depth")), F.struct(F.lit("url").alias("kind"), F.concat(host, path).alias("value"), F.lit(0).alias("depth")))
    return F.when(host == "", F.array().cast("array<struct<kind:string,value:string,depth:int>>")).otherwise(F.array_distinct(F.concat(exact, domains, prefixes)))


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every capture (page_id, url, fetched; others are left out) against the entries active when it was fetched.

    Returns page_id, url, fetched, n_active (entries met), kind, value, list, category of the entry that decides, and
    blocked. The most exact entry decides: url over prefix over host over domain, a longer one over a shorter; of entries
    as exact a block outweighs an allow, then the first category counts. A capture that meets none has 0 and nulls, and
    is not blocked; so have those with a missing or relative URL or no fetch time. Repeated captures come back once.

    Keys of the captures, with all kinds and values, meet the intervals in one equi-join, whose time condition is checked
    in the join. The interval side is as small as the list; a host with many captures is a hot key on the other side only,
    which Spark splits. The list may be of any size: nothing is broadcast but by Spark's own check of its size.
    """
    shots = captures.select("page_id", "url", "fetched").distinct()
    keys = shots.withColumn("key", F.explode(lookup_keys(F.col("url")))).select("page_id", "url", "fetched", "key.kind", "key.value", "key.depth")
    spans = validity(entries)
    as_of = (keys.kind == spans.kind) & (keys.value == spans.value) & (keys.fetched >= spans.valid_from) & (spans.valid_to.isNull() | (keys.fetched < spans.valid_to))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), keys.kind)
    met = keys.join(spans, as_of).select(
        "page_id", "url", "fetched",
        F.struct((-rank).alias("rank"), (-keys.depth).alias("depth"), (spans["list"] != "block").alias("allow"), spans.category, keys.kind, keys.value, spans["list"]).alias("entry"),
    )
    best = met.groupBy("page_id", "url", "fetched").agg(F.count("*").alias("n_active"), F.min("entry").alias("entry"))
    a, b = shots.alias("a"), best.alias("b")
    same = F.col("a.page_id").eqNullSafe(F.col("b.page_id")) & F.col("a.url").eqNullSafe(F.col("b.url")) & F.col("a.fetched").eqNullSafe(F.col("b.fetched"))
    return a.join(b, same, "left").select(
        "a.page_id", "a.url", "a.fetched", F.coalesce("b.n_active", F.lit(0).cast("long")).alias("n_active"),
        "b.entry.kind", "b.entry.value", "b.entry.list", "b.entry.category", (F.coalesce(F.col("b.entry.list"), F.lit("")) == "block").alias("blocked"),
    )
