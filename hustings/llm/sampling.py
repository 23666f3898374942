"""Bounded samples of labelled documents for training on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.llm.common import written

#: Labels that a sample has rows of, the most frequent ones, so that a sample is bounded whatever the labels.
MAX_LABELS = 300


def held_out(doc_id="doc_id"):
    """Whether a document is kept from training: the CRC-32 of its doc_id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def sample_ids(labelled: DataFrame, label: str, per_label: int) -> DataFrame:
    """(doc_id, label, weight): at most per_label rows of each label, those whose doc_id hashes lowest.

    weight tells how many rows of its label each stands for. The sample takes the same rows at any partitioning; of a
    doc_id with several labels the smallest counts, repeated rows count once, rows without doc_id or label not at all.
    Labels are the MAX_LABELS most frequent ones, of equally frequent ones the smaller. Their totals, one row for each, come
    to the driver and are sent around: a frequent label's rows are thinned where they are instead of meeting in one task.
    """
    keyed = labelled.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias(label)).withColumn("_h", F.xxhash64("doc_id"))
    totals = keyed.groupBy(label).agg(F.count("*").alias("_n"))
    held = totals.orderBy(F.desc("_n"), label).limit(MAX_LABELS).collect()
    few = labelled.sparkSession.createDataFrame(held, totals.schema)
    # Hashes are even, so this share of them holds the lowest per_label; no task then ranks more than about twice those.
    share = (F.lit(2.0 * per_label) + 100) / F.col("_n")
    near = keyed.join(F.broadcast(few), label).filter(F.col("_h") / F.lit(2.0**64) + F.lit(0.5) < share)
    ranked = near.withColumn("_r", F.row_number().over(Window.partitionBy(label).orderBy("_h", "doc_id"))).filter(F.col("_r") <= per_label)
    return ranked.select("doc_id", label, (F.col("_n") / F.least(F.col("_n"), F.lit(per_label))).alias("weight"))


def sampled(docs: DataFrame, ids: DataFrame, label: str, value: Column) -> list[tuple]:
    """(value, label, weight) of the documents that ids names, in a fixed order; those whose value is null are left out.

    ids has a bounded number of rows, so it is broadcast. Of rows that share a doc_id the least value counts, so what
    comes to the driver is one value for each row of ids at most.
    """
    some = docs.select("doc_id", value.alias("_value")).filter(F.col("_value").isNotNull()).join(F.broadcast(written(ids)), "doc_id")
    one = some.groupBy("doc_id", label, "weight").agg(F.min("_value").alias("_value"))
    return [(r["_value"], r[label], r["weight"]) for r in one.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
