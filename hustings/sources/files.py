"""Folders of dated files: their listing, revisions and staleness, archives, and writers that can be run again."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.functions.text import alpha_order

#: A dated file's name: kind, day, letters of the revision.
DATED = r"([a-z]+)(\d{4}-\d{2}-\d{2})([a-z]*)\.\w+$"


def dated_files(spark: SparkSession, path: str, pattern: str = DATED, glob: str | None = None) -> DataFrame:
    """(path, modified, size, kind, day, revision) of files whose names fit; a name that holds no day is left out."""
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        scan = scan.option("pathGlobFilter", glob)
    part = lambda i: F.regexp_extract("path", pattern, i)
    listed = scan.load(path).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"), part(1).alias("kind"), part(2).try_cast("date").alias("day"), part(3).alias("revision"))
    return listed.filter("day is not null")


def latest_revisions(files: DataFrame) -> DataFrame:
    """The file of the last revision of each kind and day: '' before a to z, those before aa."""
    best = files.groupBy("kind", "day").agg(F.max_by(F.struct(*files.columns), alpha_order(F.col("revision"))).alias("f"))
    return best.select("f.*")


def stale(inputs: DataFrame, outputs: DataFrame, stem: Column, patches: DataFrame | None = None) -> DataFrame:
    """Inputs whose output is missing, or older than they or their patch are. All have path and modified."""
    i = inputs.withColumn("stem", stem)
    o = outputs.groupBy(stem.alias("stem")).agg(F.max("modified").alias("made"))
    joined = i.join(o, "stem", "left")
    if patches is not None:
        joined = joined.join(patches.groupBy(stem.alias("stem")).agg(F.max("modified").alias("patched")), "stem", "left")
    newest = F.greatest("modified", "patched") if patches is not None else F.col("modified")
    return joined.filter(F.col("made").isNull() | (newest > F.col("made")))


def unzipped(spark: SparkSession, path: str, suffix: str = ".xml", depth: int = 4) -> DataFrame:
    """(archive, name, content) of the files with a suffix in ZIP archives, and in archives within them."""

    def inner(data: bytes, left: int) -> Iterator[tuple[str, bytes]]:
        with zipfile.ZipFile(io.BytesIO(data)) as archive:
            for info in archive.infolist():
                if info.filename.lower().endswith(".zip") and left:
                    yield from inner(archive.read(info), left - 1)
                elif info.filename.endswith(suffix):
                    yield info.filename, archive.read(info)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for name, content in inner(data, depth):
                    yield pa.RecordBatch.from_pydict({"archive": [where], "name": [name], "content": [content.decode("utf-8", "replace")]})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content").mapInArrow(run, "archive string, name string, content string")


def write_new_partitions(df: DataFrame, path: str, key: str, force: bool = False) -> None:
    """Write df as Parquet with a folder for each key; keys that are there already stay, unless forced."""
    spark = df.sparkSession
    if not force:
        try:
            df = df.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
        df.write.mode("append").partitionBy(key).parquet(path)
    else:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def write_sorted(df: DataFrame, path: str, key: str, bloom: bool = True) -> None:
    """Parquet in the order of key, so that a look-up reads few row groups; with Bloom filters for equal keys."""
    out = df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite")
    if bloom:
        out = out.option(f"parquet.bloom.filter.enabled#{key}", "true")
    out.parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON document a line, its keys in order."""
    df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_xml(df: DataFrame, path: str, row: str, root: str) -> None:
    df.write.mode("overwrite").format("xml").option("rowTag", row).option("rootTag", root).save(path)


def both_languages(df: DataFrame, columns: dict[str, dict[str, str]]) -> DataFrame:
    """A row for each language: columns names, for each new column, the source column of each language. A text that is
    missing in one is taken from the other, and flagged in fell_back."""
    languages = sorted({lang for c in columns.values() for lang in c})
    out = None
    for lang in languages:
        one = df
        flags = F.lit(False)
        for name, by in columns.items():
            own = F.nullif(F.trim(F.col(by[lang])), F.lit(""))
            other = [F.col(c) for k, c in sorted(by.items()) if k != lang]
            one, flags = one.withColumn(name, F.coalesce(own, *other)), flags | own.isNull()
        one = one.withColumn("lang", F.lit(lang)).withColumn("fell_back", flags)
        out = one if out is None else out.union(one)
    return out
