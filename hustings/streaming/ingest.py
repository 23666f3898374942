"""Files taken in once each, counted, merged and kept in state. All run with availableNow: a run takes in what has come
since the last one and ends, as a scheduled job would."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.sources.shared import shared_folder


def file_stream(spark: SparkSession, path: str, per_batch: int = 64) -> DataFrame:
    """A stream over the Parquet files at path; its checkpoint remembers which were taken in."""
    schema = spark.read.parquet(path).schema
    # As a pattern the path may be a folder or a single file.
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(f"{path[:-1]}[{path[-1]}]")


def run(stream: DataFrame, sink, checkpoint: str, mode: str = "append") -> None:
    """Hands each batch to sink(batch, number) until all files are read. A batch may come again after a failure, so
    sinks write under its number."""
    query = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def finished(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the batches whose tables, named and numbered so, were written whole in folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(f.getPath().getParent().getName().removeprefix(name)) for f in found or [])


def drain(stream: DataFrame, mode: str = "append", folder: str | None = None) -> DataFrame:
    """The result of a stream after all files: of every batch, or of the last one in complete mode.

    With a folder (below the shared one) what was taken in and what came of it outlive the run: a later run with the same
    folder takes in only new files and returns the result of all. Without, each call begins anew.
    """
    spark, folder = stream.sparkSession, folder or shared_folder(stream.sparkSession)

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    run(stream, sink, f"{folder}/checkpoint", mode)
    done = finished(spark, f"{folder}/out", "batch=")
    if not done:
        return spark.createDataFrame([], stream.schema)
    return spark.read.parquet(f"{folder}/out/batch={done[-1]}") if mode == "complete" else spark.read.parquet(f"{folder}/out").drop("batch")


def timed(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def daily_counts(events: DataFrame, late: str = "28 days") -> DataFrame:
    """Events by day and type; rows up to `late` behind the newest still count."""
    counted = timed(events).withWatermark("ts", late).groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"))
    return counted.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "6 hours") -> DataFrame:
    """A user's events not further apart than gap. There is no watermark: Spark drops rows behind one from session windows
    even in complete mode, so which rows count would hang on how files fall into batches."""
    counted = timed(events).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return counted.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("started"), "n")


def without_repeats(events: DataFrame, keys: list[str], late: str = "28 days") -> DataFrame:
    """Each key once within the watermark: a re-polled window's repeats go."""
    return timed(events).withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def first_seen(stream: DataFrame, keys: list[str], row_id: str, folder: str | None = None) -> DataFrame:
    """The least row_id of each key; each batch writes only the keys that it brings or lowers.

    What it writes is a folder by its number, so a batch that comes again reads what came before it and writes the same.
    With a folder the table outlives the run, as drain() has it.
    """
    spark, folder = stream.sparkSession, folder or shared_folder(stream.sparkSession)

    def sink(batch: DataFrame, number: int) -> None:
        new = batch.groupBy(*keys).agg(F.min(row_id).alias(row_id))
        before = [n for n in finished(spark, folder, "held-") if n < number]
        if before:
            same = [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in keys]
            held = spark.read.parquet(*(f"{folder}/held-{n}" for n in before))
            later = F.col(f"old.{row_id}") <= F.col(f"new.{row_id}")
            new = new.alias("new").join(held.alias("old"), [*same, later], "left_anti")
        new.write.mode("overwrite").parquet(f"{folder}/held-{number}")

    run(stream, sink, f"{folder}/checkpoint")
    done = finished(spark, folder, "held-")
    if not done:
        return spark.createDataFrame([], stream.select(*keys, row_id).schema)
    return spark.read.parquet(*(f"{folder}/held-{n}" for n in done)).groupBy(*keys).agg(F.min(row_id).alias(row_id))


def user_states(events: DataFrame, folder: str | None = None) -> DataFrame:
    """How far each user is: events, errors and the last event, kept as the stream's state from batch to batch."""
    states = events.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("n_errors"), F.max("event_id").alias("last_event"))
    return drain(states, "complete", folder)


def new_files(spark: SparkSession, path: str, seen: str, read) -> DataFrame | None:
    """Rows of files that no earlier run with the folder seen has taken in, read by read(paths); None if there are none."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime")
    try:
        listed = listed.join(spark.read.parquet(seen), ["path", "modificationTime"], "left_anti")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
    fresh = listed.checkpoint()
    if fresh.isEmpty():
        return None
    fresh.write.mode("append").parquet(seen)
    return read(fresh)
