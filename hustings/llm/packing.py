"""Packing by power-of-two decomposition: no sequence crosses documents, and none needs padding."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm.common import bounded_batches, release, slices
from hustings.llm.tokens import WordEncoder, encoder, vocabulary

#: Bytes of text that are encoded in one go.
SLICE_BYTES = 1 << 20
#: Sequence ids: the bucket, then the partition (up to 2 ** 24 of them), then a count below 2 ** 32.
BUCKET_SHIFT, PARTITION_SHIFT = 56, 32
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, bucket int"


def binary_lengths(n: int, most: int) -> list[int]:
    """n as a sum of powers of two, the largest first: most as often as it fits, then each set bit of the rest."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, max_tokens: int = 4096, vocab: str | None = None, end_id: int = 2) -> DataFrame:
    """Cut every document of docs (doc_id, text; others are left out) into sequences whose lengths are powers of two.

    A document is its text's ids and end_id; missing text counts as empty, so it gives the one piece [end_id]. Pieces
    are max_tokens (a power of two) long as often as they fit, then one for each set bit of what is left, so each is a
    sequence of its own without padding: sequence_id is unique, offset is 0, bucket is the length's logarithm to base
    two. ids holds little-endian unsigned 32-bit integers. Documents with equal or missing doc_id are cut one by one,
    long ones whole; an empty table gives an empty result.

    Sequences are numbered bucket by bucket: all of one length have the ids from bucket << BUCKET_SHIFT on, in which each
    partition owns a range. So nothing is shuffled, and a range of sequence_id is a bucket of equal lengths; by_bucket()
    and write_buckets() lay it together.
    """
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary(vocab))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _cut(batches, held.value, end_id, max_tokens, TaskContext.get().partitionId() << PARTITION_SHIFT)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


def _cut(batches: Iterator[pa.RecordBatch], vocab: str, end_id: int, max_tokens: int, base: int) -> Iterator[pa.RecordBatch]:
    """The pieces of a task's documents. The encoder goes when the task ends: more workers than tasks take turns, as other
    stages need several for a task, and each would keep one of its own while it waits."""
    made = np.zeros(64, np.int64)  # sequences so far, for each bucket
    for batch in slices(batches, "text", SLICE_BYTES, keep="tokens"):
        pieces = _pieces(batch, encoder(vocab, end_id), max_tokens, base, made)
        del batch
        yield pieces
        del pieces
    release()


def _pieces(batch: pa.RecordBatch, enc: WordEncoder, max_tokens: int, base: int, made: np.ndarray) -> pa.RecordBatch:
    ids, at = enc.flat(pc.fill_null(batch.column("text"), ""))
    sizes = np.diff(at)
    lengths = [binary_lengths(n, max_tokens) for n in sizes.tolist()]
    each = np.fromiter(map(len, lengths), np.int64)
    length = np.fromiter(chain.from_iterable(lengths), np.int64)
    ends = np.cumsum(length)
    start = ends - length - np.repeat(at[:-1], each)
    ids = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(4 * np.concatenate([[0], ends])), pa.py_buffer(ids.astype("<u4"))]).cast(pa.binary())
    bucket = np.log2(length).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket, minlength=64)
    rank = np.empty(len(length), np.int64)
    rank[order] = np.arange(len(length)) - np.repeat(np.cumsum(counts) - counts, counts)
    sequence = (bucket << BUCKET_SHIFT) + base + made[bucket] + rank
    made += counts
    doc_id = batch.column("doc_id").take(pa.array(np.repeat(np.arange(batch.num_rows), each)))
    return pa.RecordBatch.from_pydict({"doc_id": doc_id, "start": start, "length": length, "ids": ids, "doc_tokens": np.repeat(sizes, each), "sequence_id": sequence, "offset": np.zeros(len(length), np.int64), "bucket": bucket.astype(np.int32)})


def by_bucket(pieces: DataFrame) -> DataFrame:
    """Pieces with equal lengths side by side in every partition, without a shuffle."""
    return pieces.sortWithinPartitions("bucket", "sequence_id")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write pieces as Parquet with a folder for each length, so that a batch of one bucket needs no padding."""
    by_bucket(pieces).write.partitionBy("bucket").parquet(path)
