"""Scans of JSON, XML, CSV and dump files into tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAME = "struct<note: string, given_name: string, family_name: string, name: string, honorific_prefix: string, lordname: string, lordofname: string, start_date: string, end_date: string>"
IDENTIFIER = "struct<scheme: string, identifier: string>"
#: Collections of a people document and their rows.
PEOPLE = {
    "persons": f"struct<id: string, redirect: string, other_names: array<{NAME}>, identifiers: array<{IDENTIFIER}>>",
    "memberships": f"struct<id: string, person_id: string, post_id: string, organization_id: string, on_behalf_of_id: string, start_date: string, end_date: string, start_reason: string, end_reason: string, identifiers: array<{IDENTIFIER}>>",
    "posts": "struct<id: string, organization_id: string, start_date: string, end_date: string, area: struct<name: string, other_names: array<string>>>",
    "organizations": "struct<id: string, name: string, classification: string>",
}


def people(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The four tables of a people document: persons, memberships, posts, organizations.

    The document is one JSON object with an array for each; one that lacks a collection gives no rows of it.
    """
    schema = ", ".join(f"{n}: array<{kind}>" for n, kind in PEOPLE.items())
    whole = spark.read.schema(schema.replace(": array", " array")).option("multiLine", True).json(path)
    return {n: whole.select(F.inline(n)) for n in PEOPLE}


def json_items(spark: SparkSession, path: str, item: str, envelope: str | None = None) -> DataFrame:
    """Rows of type item (struct<...>) from files that are an array, or an object with the array under envelope.

    Rows that don't fit the type fail the scan: the type is a contract.
    """
    text = spark.read.text(path, wholetext=True)
    body = F.coalesce(F.get_json_object("value", f"$.{envelope}"), F.col("value")) if envelope else F.col("value")
    return text.select(F.inline(F.from_json(body, f"array<{item}>", {"mode": "FAILFAST"})))


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of files that are one JSON object of strings."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")))


def xml_rows(spark: SparkSession, path: str, tags: list[str], schema: str, charset: str = "UTF-8") -> DataFrame:
    """Rows of elements of any of the tags; schema names attributes with a leading underscore."""
    rows = None
    for tag in tags:
        one = spark.read.format("xml").schema(schema).option("rowTag", tag).option("charset", charset).load(path).withColumn("tag", F.lit(tag))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def person_info(spark: SparkSession, path: str, attributes: list[str], tag: str = "personinfo", charset: str = "ISO-8859-1") -> DataFrame:
    """Sidecar files with one element of attributes for each person: id and the named ones; those that lack them, null."""
    rows = xml_rows(spark, path, [tag], ", ".join(f"_{a} string" for a in ["id", *attributes]), charset)
    return rows.select(F.col("_id").alias("id"), *(F.col(f"_{a}").alias(a) for a in attributes))


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True) -> DataFrame:
    """CSV or TSV with a given schema; rows that end early have nulls, blanks are null."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("enforceSchema", True).csv(path, sep=sep, header=header, nullValue="", ignoreTrailingWhiteSpace=True)


def dump_rows(spark: SparkSession, path: str, table: str, columns: list[str]) -> DataFrame:
    """String columns of the rows that a SQL dump inserts into a table. Strings may hold quotes, brackets and escapes."""
    start, value = re.compile(rf"INSERT INTO [`\"]?{re.escape(table)}[`\"]?[^(]*VALUES\s*", re.I), re.compile(r"'((?:[^'\\]|\\.|'')*)'|([^,()\s]+)|([(),;])")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.string()) for c in columns])
        for batch in batches:
            rows: list[list] = []
            for line in batch.column(0).to_pylist():
                if m := start.match(line or ""):
                    for v in value.finditer(line, m.end()):
                        text, bare, mark = v.groups()
                        if mark == "(":
                            rows.append([])
                        elif mark is None:
                            rows[-1].append(re.sub(r"\\(.)|''", lambda x: x[1] or "'", text) if text is not None else None if bare.upper() == "NULL" else bare)
            yield pa.RecordBatch.from_pylist([dict(zip(columns, r, strict=False)) for r in rows], schema)

    return spark.read.text(path).mapInArrow(run, ", ".join(f"`{c}` string" for c in columns))


def sidecar(df: DataFrame, others: list[DataFrame], key: str = "id") -> DataFrame:
    """df with what sidecar tables know of each key; where several name a column the first that knows it counts. Of rows of
    one sidecar that share a key the least counts."""
    for other in others:
        fresh = [c for c in other.columns if c != key]
        one = other.groupBy(key).agg(F.min(F.struct(*fresh)).alias("_one")).select(key, "_one.*") if fresh else other.select(key).distinct()
        renamed = one.select(key, *(F.col(c).alias(f"_new_{c}") for c in fresh))
        df = df.join(renamed, key, "left")
        for c in fresh:
            df = df.withColumn(c, F.coalesce(F.col(c), F.col(f"_new_{c}")) if c in df.columns else F.col(f"_new_{c}")).drop(f"_new_{c}")
    return df
