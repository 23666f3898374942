"""Substring deduplication: passages that an earlier document has too are located by Aho-Corasick automata and cut out."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm.common import bounded_batches, mixed, sieve, slices, spare, utf8, word_hashes, written

#: Words of a phrase that stands for the windows around it.
PHRASE = 8
#: Bytes of text that one automaton serves.
SHARD_BYTES = 1 << 19
#: Odd multipliers of the two rolling hashes.
PHRASE_BASE, WINDOW_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def compiled(passages: list[str]) -> ahocorasick.Automaton:
    """An automaton that finds the passages as whole words."""
    automaton = ahocorasick.Automaton()
    for passage in passages:
        automaton.add_word(f" {passage} ", 0)
    if len(automaton):
        automaton.make_automaton()
    return automaton


class Slice:
    """Some documents' words in one row, with the phrase that each window of them chose.

    A window is `window` consecutive words of one document. It chooses, of the phrases of PHRASE words in it, the first
    with the least hash; so wherever the same words stand, in whatever document, they choose the same phrase. Windows
    that choose the same phrase at the same place follow one another; such a stretch is called a block.
    """

    def __init__(self, texts: list[bytes], window: int):
        self.window, self.words = window, [t.split() for t in texts]
        self.phrase = min(PHRASE, window)
        counts = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        n = int(self.starts[-1])
        self.hash = word_hashes(chain.from_iterable(self.words))
        room = n - window + 1
        self.chosen = np.empty(0, np.int64)
        if room <= 0:
            self.first_window = self.chosen
            return
        value = np.zeros(n - self.phrase + 1, np.uint64)
        for k in range(self.phrase):
            value = value * np.uint64(PHRASE_BASE) + self.hash[k : n - self.phrase + 1 + k]
        self.value = value = mixed(value)
        least, reach, width = np.arange(len(value)), 1, window - self.phrase + 1
        while reach < width:
            step = min(reach, width - reach)
            left, right = least[: len(least) - step], least[step:]
            least = np.where(value[left] <= value[right], left, right)
            reach += step
        doc = np.repeat(np.arange(len(counts)), counts)
        inside = np.flatnonzero(doc[:room] == doc[window - 1 :])
        self.first_window, self.chosen = inside, least[inside]

    def blocks(self, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase place, first window, number of windows) of every block, or of those whose place is marked in among."""
        if not len(self.chosen):
            return (np.empty(0, np.int64),) * 3
        cut = np.flatnonzero((np.diff(self.chosen) != 0) | (np.diff(self.first_window) != 1)) + 1
        at = np.concatenate([[0], cut])
        count = np.diff(np.append(at, len(self.chosen)))
        place, first = self.chosen[at], self.first_window[at]
        if among is not None:
            keep = among[place]
            place, first, count = place[keep], first[keep], count[keep]
        return place, first, count

    def docs_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, side="right") - 1

    def passages(self, hashes: np.ndarray) -> list[str]:
        """The words of the phrases that have these hashes, each once, from wherever in the slice one stands."""
        if not len(self.chosen):
            return []
        every, first = np.unique(self.value[np.unique(self.chosen)], return_index=True)
        place = np.unique(self.chosen)[first[np.isin(every, hashes.view(np.uint64), assume_unique=True)]]
        owner = self.docs_of(place)
        at = (place - self.starts[owner]).tolist()
        return [b" ".join(self.words[d][p : p + self.phrase]).decode("latin-1") for d, p in zip(owner.tolist(), at, strict=True)]

    def occurrences(self, passages: list[str]) -> np.ndarray:
        """Marks every place of the slice where one of the passages stands: an automaton of them streams all its words."""
        marks = np.zeros(len(self.hash), bool)
        automaton = compiled(passages)
        for d, words in enumerate(self.words if len(automaton) else ()):
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            found = np.fromiter((e for e, _ in automaton.iter(f" {b' '.join(words).decode('latin-1')} ")), np.int64)
            marks[self.starts[d] + np.searchsorted(ends, found) - self.phrase + 1] = True
        return marks

    def window_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums from which hash_of() gets the hash of any stretch of words."""
        n = len(self.hash)
        up = powers(WINDOW_BASE, n)
        down = powers(pow(WINDOW_BASE, -1, 1 << 64), n)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(self.hash ^ np.uint64(WINDOW_BASE)) * up[:n], dtype=np.uint64)])
        return total, down


def hash_of(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total, down = sums
    return mixed((total[end] - total[start]) * down[start])


def candidate_phrases(docs: DataFrame, window: int) -> DataFrame:
    """(phrase, doc_id): the hashes of the phrases that each document's windows chose."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 * SHARD_BYTES):
            s = Slice(utf8(batch.column("text")), window)
            place, _, _ = s.blocks()
            if len(place):
                yield pa.RecordBatch.from_pydict({"phrase": s.value[place].view(np.int64), "doc_id": batch.column("doc_id").take(pa.array(s.docs_of(place)))})

    return docs.filter("doc_id is not null").mapInArrow(run, "phrase long, doc_id long")


def recurring_blocks(docs: DataFrame, phrases: DataFrame, window: int) -> DataFrame:
    """Blocks of all documents whose phrases recur.

    phrases: (doc_id, hashes) of those, which says what may occur in a document, not where. A shard is a slice of
    documents of bounded size: the recurring phrases that may occur in it are compiled into its automaton, all its
    documents' words are streamed through that, and what stands around every occurrence is hashed: (phrase, block, doc_id,
    twin, first, count, windows). twin tells rows of one doc_id apart, block is the hash of the block's words and windows
    holds the 64-bit hashes of its windows. What an automaton doesn't find is in no block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES):
            s = Slice(utf8(batch.column("text")), window)
            if not len(s.chosen):
                continue
            likely = np.unique(batch.column("hashes").flatten().to_numpy())
            place, first, count = s.blocks(s.occurrences(s.passages(likely)))
            if not len(place):
                continue
            sums, doc = s.window_hashes(), s.docs_of(place)
            block = hash_of(sums, first, first + count + window - 1) ^ (place - first).astype(np.uint64) * np.uint64(PHRASE_BASE)
            every = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
            hashes = hash_of(sums, every, every + window).astype("<u8").tobytes()
            ends = (np.cumsum(count) * 8).tolist()
            yield pa.RecordBatch.from_pydict({
                "phrase": s.value[place].view(np.int64), "block": block.view(np.int64), "doc_id": batch.column("doc_id").take(pa.array(doc)), "twin": batch.column("twin").take(pa.array(doc)),
                "first": (first - s.starts[doc]).astype(np.int32), "count": count.astype(np.int32), "windows": pa.array([hashes[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], pa.binary()),
            })

    # Merged, not broadcast, when few: docs come from a sieve, and its task would need a second Python worker for run().
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("twin")).join(phrases.hint("merge"), "doc_id")
    return keyed.mapInArrow(run, "phrase long, block long, doc_id long, twin long, first int, count int, windows binary")


def repeated_spans(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, twin, spans) of documents of which windows also start in a document with a smaller doc_id.

    spans: start and end, in words, of stretches to remove; they may overlap. twin is xxhash64(text). Phrases that stand
    for windows are counted first, so only windows around a recurring one are looked at. Blocks alike in all their words
    are settled by their smallest doc_id. Only where a phrase has different blocks are their windows compared, each
    different block once.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = written(candidate_phrases(texts, window))
    recurring = found.groupBy("phrase").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("phrase")
    recurring = written(recurring)
    likely = found.filter(sieve(recurring, "phrase")(F.col("phrase")))
    held = written(likely.join(recurring, "phrase").groupBy("doc_id").agg(F.collect_set("phrase").alias("hashes")))
    blocks = written(recurring_blocks(texts.filter(sieve(held, "doc_id")(F.col("doc_id"))), held, window))
    kinds = written(blocks.groupBy("phrase", "block").agg(F.min("doc_id").alias("owner")))
    mixed_phrases = written(kinds.groupBy("phrase").agg(F.count("*").alias("n")).filter("n > 1").select("phrase"))
    several = blocks.filter(sieve(mixed_phrases, "phrase")(F.col("phrase")))
    rows = several.groupBy("phrase", "block").agg(F.min("doc_id").alias("owner"), F.min_by("windows", "doc_id").alias("windows")).join(mixed_phrases, "phrase", "left_semi")
    windows = rows.mapInArrow(_unpacked, "phrase long, block long, owner long, at int, hash long")
    seen = windows.groupBy("phrase", "hash").agg(F.min("owner").alias("earliest"), F.max("owner").alias("latest")).filter("earliest < latest").drop("latest")
    partly = windows.join(written(seen), ["phrase", "hash"]).filter("earliest < owner").groupBy("phrase", "block").agg(F.collect_list("at").alias("at"))
    # Written, so that the join with all blocks has a plain exchange on both sides and Spark can split hot ones.
    judged = written(kinds.join(partly, ["phrase", "block"], "left"))
    whole = F.array(F.struct(F.col("first").alias("start"), (F.col("first") + F.col("count") + F.lit(window - 1)).alias("end")))
    some = F.transform("at", lambda i: F.struct((F.col("first") + i).alias("start"), (F.col("first") + i + F.lit(window)).alias("end")))
    spans = blocks.drop("windows").join(judged, ["phrase", "block"]).filter("doc_id > owner or at is not null")
    spans = spans.withColumn("spans", F.when(F.col("doc_id") > F.col("owner"), whole).otherwise(some))
    return spans.groupBy("doc_id", "twin").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = [np.frombuffer(w, "<i8") for w in batch.column("windows").to_pylist()]
        if not data:
            continue
        size = np.array([len(d) for d in data])
        row = pa.array(np.repeat(np.arange(len(data)), size))
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        yield pa.RecordBatch.from_pydict({n: batch.column(n).take(row) for n in ("phrase", "block", "owner")} | {"at": at.astype(np.int32), "hash": np.concatenate(data)})


def cut(docs: DataFrame, window: int = 50, columns: list[str] | None = None) -> DataFrame:
    """Every row of docs with the named columns (all by default), and n_words, n_removed, kept_text: its words (parted by
    white space) that no repeated window covers, joined by single spaces.

    A window is `window` consecutive words of one document; each word covered by a window whose words also start in a
    document with a smaller doc_id goes. All windows are judged on the input. Missing texts have no words. Rows without
    doc_id are neither earlier nor later than any other, so they stay whole and mark nothing; rows that share a doc_id
    do not mark each other. Long texts are taken whole. Columns named as the new ones give way to them. An empty table
    gives an empty result. Only rows that may have spans are shuffled, with their other columns; only their texts go to Python.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    back = names if columns is None else columns
    bounded_batches(spark)
    twin, stretches, inner = (spare(docs, n) for n in ("_twin", "_spans", "_told"))
    rows = docs.select(*names, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias(twin))
    spans = written(repeated_spans(docs, window))
    touched = sieve(spans, "doc_id")(F.col("doc_id").cast("long"))
    some = rows.filter(touched)
    # Merged, so that the sieve and keep() are not in one task either.
    joined = some.join(spans.hint("merge"), (some["doc_id"] == spans["doc_id"]) & (some[twin] == spans["twin"]), "left").select(*(some[n] for n in names), spans["spans"].alias(stretches))
    # Rows without spans are done by Spark's functions alone, so no task needs two Python workers at a time.
    words = F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[ \x09-\x0D]+"), lambda w: w != "")
    whole = rows.filter(~touched).select(*back, words.alias(inner)).select(*back, F.size(inner).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.array_join(inner, " ").alias("kept_text"))

    @F.arrow_udf("n_words bigint, n_removed bigint, kept_text string")
    def keep(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, marked in texts:
            parts = [_kept(utf8(part.column(0)), part.column(1)) for part in slices([pa.RecordBatch.from_arrays([text, marked], ["text", "spans"])], "text", 2 * SHARD_BYTES)]
            yield pa.concat_arrays(parts)

    told = joined.withColumn(inner, keep.asNondeterministic()(F.col("text").cast("string"), F.col(stretches)))
    return told.select(*back, *(F.col(inner)[c].alias(c) for c in ("n_words", "n_removed", "kept_text"))).union(whole)


def _kept(texts: list[bytes], spans: pa.Array) -> pa.Array:
    n_words, n_removed, kept = [], [], []
    sizes = pc.fill_null(pc.list_value_length(spans), 0).to_pylist()
    begin, end = (x.to_numpy(zero_copy_only=False) for x in spans.flatten().flatten())
    at = 0
    for text, n in zip(texts, sizes, strict=True):
        words = text.split()
        mark = np.zeros(len(words) + 1, np.int64)
        np.add.at(mark, begin[at : at + n], 1)
        np.add.at(mark, end[at : at + n], -1)
        gone = np.cumsum(mark)[:-1] > 0
        at += n
        n_words.append(len(words))
        n_removed.append(int(gone.sum()))
        kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if n else words))
    return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "n_removed", "kept_text"])
