"""Validity intervals: closed date ranges, their joins, splits, unions and chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stand for a missing start and a missing end.
BEGINNING, FOREVER = "0001-01-01", "9999-12-31"


def pad_date(text: Column, end: bool = False) -> Column:
    """A date from text that may be a year or a year and month only: its first day, or its last if end is set.

    Null and '0000-00-00' are the open ends. Anything else that is no date gives null.
    """
    whole = F.when(F.length(text) == 4, F.concat(text, F.lit("-12-31" if end else "-01-01")))
    month = F.concat(text, F.lit("-01")).try_cast("date")
    whole = whole.when(F.length(text) == 7, (F.last_day(month) if end else month).cast("string")).otherwise(text)
    blank = text.isNull() | (text == "") | (text == "0000-00-00")
    return F.when(blank, F.lit(FOREVER if end else BEGINNING).cast("date")).otherwise(whole.try_cast("date"))


def valid_on(day: Column, start: Column, end: Column) -> Column:
    """Whether a closed range holds a day; a missing day matches any range, a missing bound is open."""
    return day.isNull() | day.between(F.coalesce(start, F.lit(BEGINNING).cast("date")), F.coalesce(end, F.lit(FOREVER).cast("date")))


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start <= b_end) & (a_end >= b_start)


def derive_ends(df: DataFrame, keys: list[str], start: str, tie: str, end: str = "end_date") -> DataFrame:
    """Each row lasts until the day before the next one of its key; the last one has no end in sight.

    Of rows with one start the earlier by tie gets an end before its start, so it holds no day.
    """
    following = F.lead(start).over(Window.partitionBy(*keys).orderBy(start, tie))
    return df.withColumn(end, F.coalesce(F.date_sub(following, 1), F.lit(FOREVER).cast("date")))


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], day: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Rows of both that share keys where right's range holds left's day. The range is a condition of the hash or merge
    join on keys, so nothing is compared across keys."""
    l, r = left.alias("l"), right.alias("r")
    on = F.col(f"l.{day}").between(F.col(f"r.{start}"), F.col(f"r.{end}"))
    for k in keys:
        on = (F.col(f"l.{k}") == F.col(f"r.{k}")) & on
    return l.join(r, on, how).select("l.*", *(F.col(f"r.{c}") for c in right.columns if c not in keys))


def range_join(points: DataFrame, ranges: DataFrame, point: str, start: str, end: str, width: int) -> DataFrame:
    """Points (long) in closed ranges where no equal key helps: both are cut into buckets of width, which become the key.

    A range goes to each bucket that it touches, so width should be about a usual range's length.
    """
    p = points.withColumn("_bucket", F.floor(F.col(point) / width))
    r = ranges.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    return p.join(r, "_bucket").filter(F.col(point).between(F.col(start), F.col(end))).drop("_bucket")


def overlap_conflicts(df: DataFrame, keys: list[str], start: str, end: str, row_id: str) -> DataFrame:
    """Pairs of rows of one key whose ranges overlap, each pair once: first_id < second_id. Rows without a start or
    an end meet nobody.

    A sweep in order of the starts cuts each key where no range before reaches; only rows of one such stretch are
    compared, so a key that is long but has few overlaps costs a sort.
    """
    order = Window.partitionBy(*keys).orderBy(start)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    swept = df.select(*keys, row_id, start, end).filter(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("_cut", F.coalesce(F.col(start) > reach, F.lit(False)))
    swept = swept.withColumn("_stretch", F.count_if("_cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # Rows of a stretch by themselves meet nobody.
    held = swept.withColumn("_many", F.count("*").over(Window.partitionBy(*keys, "_stretch"))).filter("_many > 1")
    a, b = held.alias("a"), held.alias("b")
    on = (F.col("a._stretch") == F.col("b._stretch")) & (F.col(f"a.{row_id}") < F.col(f"b.{row_id}")) & overlaps(F.col(f"a.{start}"), F.col(f"a.{end}"), F.col(f"b.{start}"), F.col(f"b.{end}"))
    for k in keys:
        on = (F.col(f"a.{k}") == F.col(f"b.{k}")) & on
    return a.join(b, on).select(*(F.col(f"a.{k}") for k in keys), F.col(f"a.{row_id}").alias("first_id"), F.col(f"b.{row_id}").alias("second_id"))


def containment(inner: DataFrame, outer: DataFrame, key: str, start: str, end: str, outer_start: str, outer_end: str, outer_key: str | None = None) -> DataFrame:
    """inner with n_containers: how many ranges of outer with its key hold its range whole; 1 is in order. Rows of inner
    that are alike in all columns are looked up once and come back as often."""
    i, o = inner.groupBy(*inner.columns).agg(F.count("*").alias("_times")).withColumn("_row", F.struct(*inner.columns, "_times")), outer.select(F.col(outer_key or key).alias("_k"), F.col(outer_start).alias("_s"), F.col(outer_end).alias("_e"))
    on = (F.col(key) == F.col("_k")) & (F.col("_s") <= F.col(start)) & (F.col(end) <= F.col("_e"))
    met = i.join(o, on, "left").groupBy("_row").agg(F.count("_k").alias("n_containers"))
    return met.select("_row.*", "n_containers").withColumn("_times", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")


def intersection(left: DataFrame, right: DataFrame, on: Column, left_range: tuple[str, str], right_range: tuple[str, str]) -> DataFrame:
    """Joined rows whose ranges have days in common, with those as start and end."""
    ls, le, rs, re = (F.col(c) for c in (*left_range, *right_range))
    joined = left.join(right, on & overlaps(ls, le, rs, re))
    return joined.withColumn("both_start", F.greatest(ls, rs)).withColumn("both_end", F.least(le, re))


def split_at_years(df: DataFrame, start: str, end: str) -> DataFrame:
    """Each range cut at new year: a row for each calendar year that it touches, with piece_start and piece_end."""
    years = df.withColumn("year", F.explode(F.sequence(F.year(start), F.year(end))))
    return years.withColumn("piece_start", F.greatest(F.col(start), F.make_date("year", F.lit(1), F.lit(1)))).withColumn("piece_end", F.least(F.col(end), F.make_date("year", F.lit(12), F.lit(31))))


def carve(positions: DataFrame, inner: DataFrame, key: str) -> DataFrame:
    """Positions (key, start_date, end_date) split where inner ranges of the same key begin and end.

    Gives key, start_date, end_date, inside: the stretches of each position, and whether an inner range holds them.
    """
    # How many inner ranges are open from each day on that one begins or ends: a row for a key and day, however many do.
    marks = F.array(F.struct(F.col("start_date").alias("day"), F.lit(1).alias("d")), F.struct(F.date_add("end_date", 1).alias("day"), F.lit(-1).alias("d")))
    daily = inner.filter("start_date <= end_date").select(key, F.inline(marks)).groupBy(key, "day").agg(F.sum("d").alias("d"))
    level = daily.withColumn("_open", F.sum("d").over(Window.partitionBy(key).orderBy("day"))).select(F.col(key).alias("_k"), "day", "_open")
    own = positions.select(key, "start_date", "end_date").distinct()
    inside = own.join(level, (F.col(key) == F.col("_k")) & F.col("day").between(F.col("start_date"), F.col("end_date"))).select(key, "start_date", "end_date", "day", "_open")
    # What is open when a position starts: the last mark before it, or on its first day, in one sequence of both.
    sides = level.select(F.col("_k").alias(key), "day", "_open", F.lit(0).alias("_side")).unionByName(own.withColumn("day", F.col("start_date")).withColumn("_side", F.lit(1)), allowMissingColumns=True)
    latest = F.last("_open", True).over(Window.partitionBy(key).orderBy("day", "_side"))
    before = sides.withColumn("_open", F.coalesce(latest, F.lit(0))).filter("_side = 1").select(key, "start_date", "end_date", "_open")
    points = before.withColumn("day", F.col("start_date")).unionByName(inside.filter("day > start_date"))
    following = F.lead("day").over(Window.partitionBy(key, "start_date", "end_date").orderBy("day"))
    pieces = points.withColumn("_to", F.coalesce(F.date_sub(following, 1), F.col("end_date")))
    return pieces.select(key, F.col("day").alias("start_date"), F.col("_to").alias("end_date"), (F.col("_open") > 0).alias("inside"))


def contiguous(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Ranges of a key that overlap or touch (the next begins the day after at most) made one; n_merged counts them."""
    by = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col(start) > F.date_add(reach, 1)), 1).otherwise(0)
    island = F.sum("_fresh").over(by.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_fresh", fresh).withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n_merged")).drop("_island")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, order: list[str], value: str, skip: int = 0) -> DataFrame:
    """left with the latest earlier value of right by keys; skip passes over that many of right's latest rows.

    Both sides are laid in one sequence, so a key is sorted once and no pair of rows is formed.
    """
    if skip:
        right = right.withColumn(value, F.lag(value, skip).over(Window.partitionBy(*keys).orderBy(at, *order)))
    marked = left.withColumn("_left", F.lit(True)).withColumn("_v", F.lit(None).cast(right.schema[value].dataType))
    sides = marked.unionByName(right.select(*keys, *dict.fromkeys([at, *order]), F.col(value).alias("_v")).withColumn("_left", F.lit(False)), allowMissingColumns=True)
    before = Window.partitionBy(*keys).orderBy(at, *order).rowsBetween(Window.unboundedPreceding, -1)
    return sides.withColumn(f"latest_{value}", F.last("_v", ignorenulls=True).over(before)).filter("_left").drop("_left", "_v")


def date_spine(start: str, end: str, spark, name: str = "day", step: str = "1 day") -> DataFrame:
    return spark.range(1).select(F.explode(F.expr(f"sequence(DATE'{start}', DATE'{end}', INTERVAL {step})")).alias(name))


def cumulative_snapshots(df: DataFrame, day: str, keys: list[str], value: Column) -> DataFrame:
    """For each day that df has, value summed over that day and all before it, for each key.

    Days are first summed up, so the running window holds a row per key and day, however many rows df has.
    """
    daily = df.groupBy(*keys, day).agg(F.sum(value).alias("_v"))
    by = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("total", F.sum("_v").over(by)).drop("_v")


def snapshot_as_of(df: DataFrame, day: str, ended: str, updated: str, reviewed: str, grace: int = 365) -> DataFrame:
    """Rows as they stood on a day: not ended by then, updated by then and reviewed in the grace period before it."""
    d = F.lit(day).cast("date")
    return df.filter((F.col(ended).isNull() | (F.col(ended) >= d)) & (F.col(updated) <= d) & (F.col(reviewed) >= F.date_sub(d, grace)))
