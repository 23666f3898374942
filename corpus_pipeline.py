"""The pipeline from raw documents to packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns the documents that stay, with the
columns they came with (whatever their names), but for the last, which returns packed pieces. Missing texts go with the
first stage; rows that share a doc_id are judged one by one; an empty table gives an empty result. A stage's result is
written and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.llm import decontamination, language_id, near_copies, packing, substring_dedup
from hustings.llm.common import table, written


def guarded(docs: DataFrame, *needed: str):
    """docs with the columns that aren't needed under names that no operator uses, and a function that undoes it."""
    names = {c: c if c in needed else f"_own_{i}" for i, c in enumerate(docs.columns)}
    return docs.withColumnsRenamed(names), lambda df: df.select(*(F.col(n).alias(c) for c, n in names.items()))


#: Languages whose documents stay (None: every language that is learned), and the least score of the prediction.
LANGUAGES: tuple[str, ...] | None = None
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose predicted language is one of LANGUAGES with a score of at least LEAST_SCORE.

    Missing texts and texts without a letter go. Where no document has a language to learn from, nothing is predicted, so
    every other text stays.
    """
    plain, back = guarded(docs, "doc_id", "text", "lang")
    if language_id.learned_from(plain).isEmpty():
        return back(plain.filter(F.col("text").rlike(r"\p{L}")))
    told, spoken = language_id.identify(plain), F.col("lang_pred") != "und"
    if LANGUAGES is not None:
        spoken &= F.col("lang_pred").isin(*LANGUAGES)
    return back(told.filter(spoken & (F.col("score") >= LEAST_SCORE)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-copies, texts that links of a Jaccard similarity of 0.8 or more over
    five-word shingles join: the one with the smallest doc_id."""
    plain, back = guarded(docs, "doc_id", "text")
    return back(near_copies.one_of_each(plain))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out passages that an earlier document has; texts without any stay as they are, emptied ones go."""
    plain, back = guarded(docs, "doc_id", "text", "n_chars")
    cut = substring_dedup.cut(plain)
    changed = F.col("n_removed") > 0
    kept = cut.filter("n_removed = 0 or n_removed < n_words").withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return back(kept)


def no_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    plain, back = guarded(docs, "doc_id", "text")
    return back(decontamination.occurrences(plain, table(spark, sf_dir, "benchmark")).filter(F.size("spans") == 0))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths, equal lengths side by side."""
    pieces = packing.pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
    return packing.by_bucket(pieces)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", no_benchmarks),
    ("packing", packed),
]
#: No SQL expresses a trained network, XXH64 or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
