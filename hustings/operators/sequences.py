"""Operators over ordered rows: runs, carried values, counters with resets, gaps.

A key may hold a large share of all rows. Operators that need a key's whole past therefore work on chunks: a window
runs within (key, chunk), one row for each chunk passes on what earlier chunks left, and a join brings it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.sources.shared import with_checkpoints


def collapse_runs(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Neighbouring rows of equal value made one: keys, run (from 1), value, n, and the first and last of order[0]."""
    by = Window.partitionBy(*keys).orderBy(*order)
    turned = F.when(F.col(value).eqNullSafe(F.lag(value).over(by)) & (F.row_number().over(by) > 1), 0).otherwise(1)
    run = F.sum("_turn").over(by.rowsBetween(Window.unboundedPreceding, 0))
    at = order[0]
    return df.withColumn("_turn", turned).withColumn("run", run).groupBy(*keys, "run", value).agg(F.count("*").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))


def _from_before(df: DataFrame, keys: list[str], chunk: str, left: Column, running: Column) -> DataFrame:
    """(keys, chunk, _before): running over what earlier chunks left, one row for each chunk."""
    ends = df.groupBy(*keys, chunk).agg(left.alias("_left"))
    by = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return ends.withColumn("_before", running.over(by)).drop("_left")


def carry_forward(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, chunk: Column | None = None) -> DataFrame:
    """df with the last value that wasn't null so far, the row's own included; chunk must not fall as order rises."""
    df = df.withColumn("_value", value)
    if chunk is None:
        by = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.last("_value", ignorenulls=True).over(by)).drop("_value")
    df = df.withColumn("_chunk", chunk)
    known = F.when(F.col("_value").isNotNull(), F.struct(*order))
    before = _from_before(df, keys, "_chunk", F.max_by("_value", known), F.last("_left", ignorenulls=True))
    by = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = df.withColumn("_own", F.last("_value", ignorenulls=True).over(by))
    return own.join(before, [*keys, "_chunk"]).withColumn(name, F.coalesce("_own", "_before")).drop("_own", "_before", "_chunk", "_value")


def running_count(df: DataFrame, keys: list[str], order: list[str], mark: Column, name: str, chunk: Column | None = None) -> DataFrame:
    """df with the number of rows so far, the row's own included, for which mark holds."""
    df = df.withColumn("_one", F.when(mark, 1).otherwise(0))
    if chunk is None:
        return df.withColumn(name, F.sum("_one").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).drop("_one")
    df = df.withColumn("_chunk", chunk)
    before = _from_before(df, keys, "_chunk", F.sum("_one"), F.sum("_left"))
    own = df.withColumn("_own", F.sum("_one").over(Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    return own.join(before, [*keys, "_chunk"]).withColumn(name, F.col("_own") + F.coalesce("_before", F.lit(0))).drop("_own", "_before", "_chunk", "_one")


def hierarchical_ids(df: DataFrame, keys: list[str], order: list[str], major: Column, chunk: Column | None = None) -> DataFrame:
    """df with major, a counter of headings, and minor, a counter of the rows since the heading (which has 0)."""
    counted = running_count(df, keys, order, major, "major", chunk)
    if chunk is None:
        place = F.row_number().over(Window.partitionBy(*keys, "major").orderBy(*order))
        return counted.withColumn("minor", place - F.when(F.col("major") > 0, 1).otherwise(0))
    # Rows since the heading: those of this chunk by a window, those of the chunks before it by their counts.
    parts = counted.withColumn("_c", chunk)
    sizes = parts.groupBy(*keys, "major", "_c").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*keys, "major").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    own = parts.withColumn("_own", F.row_number().over(Window.partitionBy(*keys, "major", "_c").orderBy(*order)))
    placed = own.join(before, [*keys, "major", "_c"]).withColumn("minor", (F.col("_own") + F.col("_before") - F.when(F.col("major") > 0, 1).otherwise(0)).cast("int"))
    return placed.drop("_c", "_own", "_before")


def merge_adjacent(df: DataFrame, keys: list[str], order: list[str], kind: str, text: str) -> DataFrame:
    """Rows that a row of the same kind follows take over its text; the followers of a merged pair go.

    Within a run of one kind, the first takes the second, the third the fourth, and so on.
    """
    by = Window.partitionBy(*keys).orderBy(*order)
    turned = F.when(F.col(kind).eqNullSafe(F.lag(kind).over(by)), 0).otherwise(1)
    place = df.withColumn("_turn", turned).withColumn("_run", F.sum("_turn").over(by)).withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_run").orderBy(*order)))
    after = Window.partitionBy(*keys, "_run").orderBy(*order)
    return place.withColumn("merged", F.concat_ws(" ", text, F.lead(text).over(after))).filter("_n % 2 = 1").drop("_turn", "_run", "_n")


def gaps(df: DataFrame, keys: list[str], order: list[str], at: str, name: str = "gap_seconds") -> DataFrame:
    """df with the seconds since the row before."""
    earlier = F.lag(at).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, F.unix_timestamp(F.col(at).cast("timestamp")) - F.unix_timestamp(earlier.cast("timestamp")))


def event_pairs(df: DataFrame, keys: list[str], order: list[str], kind: str, row_id: str, second: str) -> DataFrame:
    """Rows whose very next row is of kind second, with that row's id."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("next_id", F.lead(row_id).over(by)).withColumn("next_kind", F.lead(kind).over(by)).filter(F.col("next_kind") == second).drop("next_kind")


def occurrence(df: DataFrame, keys: list[str], order: list[str], name: str = "occurrence") -> DataFrame:
    """df with the number of earlier rows of its keys."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def global_rank(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """df with its place, from 1, in one order over all rows, without bringing them to one task.

    Rows are dealt out by ranges of the order; each partition counts its rows, a running sum over partitions gives where
    each begins. Equal rows of the order get places in any order, so it should name a row.
    """
    with_checkpoints(df.sparkSession)
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    held = dealt.checkpoint()
    sizes = held.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    begun = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return held.join(F.broadcast(begun.select("_part", "_first", "_start")), "_part").withColumn(name, F.col("_start") + F.col("_row") - F.col("_first") + 1).drop("_part", "_row", "_first", "_start")
