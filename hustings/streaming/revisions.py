"""Revisions of documents applied in their order, in whatever order and batches their files come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hustings.sources.shared import shared_folder
from hustings.streaming.ingest import finished, run


def _log(spark: SparkSession, folder: str, name: str, before: int, schema) -> DataFrame:
    """What batches before this one have written; each is a folder that was finished whole."""
    done = [n for n in finished(spark, folder, f"{name}-") if n < before]
    return spark.read.schema(schema).parquet(*(f"{folder}/{name}-{n}" for n in done)) if done else spark.createDataFrame([], schema)


def _due(waiting: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Of waiting rows (key, revision, digest) those that follow on from held (key, revision, digest, the last applied one of
    each key) without a gap, with kind: new for the first one, same or change against the one before."""
    rows = waiting.join(held.select(key, F.col("revision").alias("_at"), F.col("digest").alias("_held")), key, "left").filter(F.col("revision") > F.coalesce("_at", F.lit(0)))
    order = Window.partitionBy(key).orderBy("revision")
    ready = rows.withColumn("_n", F.row_number().over(order)).filter(F.col("revision") == F.coalesce("_at", F.lit(0)) + F.col("_n"))
    before = F.coalesce(F.lag("digest").over(order), F.col("_held"))
    kind = F.when((F.col("revision") == 1), "new").when(before.eqNullSafe(F.col("digest")), "same").otherwise("change")
    return ready.select(key, "revision", "digest", kind.alias("kind"))


def apply(stream: DataFrame, key: str, folder: str | None = None) -> DataFrame:
    """(key, revision, text, kind): every revision of a stream (key, revision, text) that could be applied, revisions being
    numbered from 1; one whose predecessors haven't come waits for them.

    Of rows with one key and revision the one whose text hashes lowest in the first batch that has it counts; rows without key
    or revision are left out. A batch writes its rows as they come, without a shuffle; what is due is told by revisions and
    SHA-256 digests of texts alone, of the batch's own keys, and may come again after a failure and be written the same.
    Texts are shuffled once, when the result is read. With a folder (below the shared one) what waits and what was applied
    outlive the run.
    """
    spark, folder = stream.sparkSession, folder or shared_folder(stream.sparkSession)
    plain = stream.select(key, F.col("revision").cast("int").alias("revision"), F.col("text").cast("string").alias("text"))
    own = [plain.schema[key], plain.schema["revision"]]
    # digest is null for a missing text; of rows with one key and revision the least (batch, hash) counts.
    told = T.StructType([*own, T.StructField("digest", T.BinaryType()), T.StructField("batch", T.LongType()), T.StructField("hash", T.LongType())])
    whole, kinds = T.StructType([*told, plain.schema["text"]]), T.StructType([*own, T.StructField("digest", T.BinaryType()), T.StructField("kind", T.StringType())])

    def sink(batch: DataFrame, number: int) -> None:
        rows = batch.filter(F.col(key).isNotNull() & (F.col("revision") > 0))
        rows.select(key, "revision", F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(number).cast("long").alias("batch"), F.xxhash64("text").alias("hash"), "text").write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/received-{number}")
        received = _log(spark, folder, "received", number + 1, told)
        keys = received.filter(F.col("batch") == number).select(key).distinct()
        first = received.join(keys, key, "left_semi").groupBy(key, "revision").agg(F.min_by("digest", F.struct("batch", "hash")).alias("digest"))
        held = _log(spark, folder, "applied", number, kinds).join(keys, key, "left_semi").groupBy(key).agg(F.max_by("digest", "revision").alias("digest"), F.max("revision").alias("revision"))
        _due(first, held, key).write.mode("overwrite").parquet(f"{folder}/applied-{number}")

    run(plain, sink, f"{folder}/checkpoint")
    texts = _log(spark, folder, "received", 1 << 62, whole).select(key, "revision", "text", F.struct("batch", "hash").alias("_at"))
    both = texts.unionByName(_log(spark, folder, "applied", 1 << 62, kinds).select(key, "revision", "kind"), allowMissingColumns=True)
    # By key alone, so that what asks for a key's last revision finds all of them there.
    applied = both.repartition(key).groupBy(key, "revision").agg(F.min_by("text", "_at").alias("text"), F.max("kind").alias("kind"))
    return applied.filter("kind is not null")


def current(applied: DataFrame, key: str) -> DataFrame:
    """(key, revision, text): the last applied revision of each document; those that changed nothing don't count."""
    return applied.filter("kind <> 'same'").groupBy(key).agg(F.max("revision").alias("revision"), F.max_by("text", "revision").alias("text"))
