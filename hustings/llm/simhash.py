"""SimHash near-duplicates: fingerprints, and links between them found by bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm.common import bounded_batches, slices, utf8, written
from hustings.llm.components import connected_components

#: Rows that one comparison takes at most, and rows of small buckets that are compared together.
BUCKET, TILE = 4096, 512
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes, shingle: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of a text's word shingles, repeats included; none if it has no word.

    Words are parted by white space after lower-casing A-Z; a text of fewer words is one shingle.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[shingle - 1 :].tolist() or [len(line)]
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], 42) for a, b in zip(first, last, strict=True)], np.uint64)


def folded(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes: a bit is set if it is set in over half of them; 0 for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def simhash(text: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a text's word shingles, repeats included; 0 if it has no word."""
    return folded(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) for every row of docs; fp is the fingerprint as a signed long. Missing text counts as empty."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp = np.array([simhash(t, shingle) for t in utf8(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": fp.view(np.int64)})

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(make, "doc_id long, fp long")


def close_pairs(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions i < j of fp (uint64) that differ in at most radius bits.

    Bit planes are stored vertically, 64 fingerprints to a word. For each query, planes are compared three at a time: a
    carry-save adder turns them into a sum and a carry bit, which go into bitwise counters that hold 64 distances at
    once. The counters start so that passing the radius overflows into a bit that stays; blocks of 64 in which all have
    passed it are given up.
    """
    n, width = len(fp), radius.bit_length()
    words = -(-n // 64)
    bits = np.unpackbits(fp.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    padded = np.zeros((words * 64, 64), np.uint8)
    padded[:n] = bits
    planes = np.packbits(padded.T.copy(), axis=1, bitorder="little").view(np.uint64)
    flips = np.where(bits.T == 1, ONES, np.uint64(0))
    query, block = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(words), indexing="ij"))
    keep = block >= query // 64
    query, block = query[keep], block[keep]
    start = (1 << width) - 1 - radius
    counters = [np.full(len(query), ONES if start >> k & 1 else 0, np.uint64) for k in range(width)]
    over = np.zeros(len(query), np.uint64)

    def add(bit: np.ndarray, weight: int) -> None:
        for k in range(weight, width):
            counters[k], bit = counters[k] ^ bit, counters[k] & bit
        np.bitwise_or(over, bit, out=over)

    for plane in range(0, 64, 3):
        x = [planes[p][block] ^ flips[p][query] for p in range(plane, min(plane + 3, 64))]
        if len(x) < 3:
            for bit in x:
                add(bit, 0)
        else:
            half = x[0] ^ x[1]
            add(half ^ x[2], 0)
            add((x[0] & x[1]) | (half & x[2]), 1)
        if plane >= 9 and plane % 6 == 3:
            alive = over != ONES
            if not alive.all():
                query, block, over = query[alive], block[alive], over[alive]
                counters = [c[alive] for c in counters]
    left = ~over
    found = np.flatnonzero(left)
    hit = np.unpackbits(left[found].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(hit)
    i, j = query[found][row], block[found][row] * 64 + bit
    good = (j < n) & (i < j)
    return i[good], j[good]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n nodes and edges (i, j) the smallest node of each one's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def links(prints: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(a, b): edges between the distinct values of prints.fp that connect all within radius bits of each other.

    Two such values agree on one of radius + 1 parts of their bits at least, so rows are bucketed by each part. A bucket
    of over `bucket` rows is dealt out anew by the parts of the bits that are left, and so on until so few bits are left
    that no bucket of different values can be larger; nothing is dropped. Buckets are compared all against all, and
    each gives the edges of a spanning forest instead of its pairs. A later step joins the forests.
    """
    rows = prints.select("fp", F.col("fp").alias("rest"), F.lit(0).cast("long").alias("key"))
    bits, found, parts = 64, None, radius + 1
    while True:
        sizes = [bits // parts + (k < bits % parts) for k in range(parts)]
        options, low = [], 0
        for k, size in enumerate(sizes):
            rest, mask = F.col("rest"), (1 << size) - 1
            value = F.shiftrightunsigned(rest, low).bitwiseAND(F.lit(mask))
            above = F.shiftleft(F.shiftrightunsigned(rest, low + size), low) if low + size < 64 else F.lit(0).cast("long")
            options.append(F.struct(F.xxhash64("key", F.lit(k), value).alias("key"), above.bitwiseOR(rest.bitwiseAND(F.lit((1 << low) - 1))).alias("rest")))
            low += size
        rows = rows.select("fp", F.explode(F.array(*options)).alias("x")).select("fp", "x.key", "x.rest")
        bits -= min(sizes)
        hot = None
        if bits > bucket.bit_length() - 1:
            hot = written(rows.groupBy("key").count().filter(F.col("count") > bucket).select("key"))
            if hot.isEmpty():
                hot = None
        cold = rows if hot is None else rows.join(hot, "key", "left_anti")
        edges = cold.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(_compare(radius), "a long, b long")
        found = edges if found is None else found.union(edges)
        if hot is None:
            return found
        rows = written(rows.join(hot, "key", "left_semi").select("fp", "rest", "key"))


def _compare(radius: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; whole buckets are taken together until they fill a tile."""

        def edges(fp: np.ndarray) -> pa.RecordBatch:
            fp = np.unique(fp)
            root = forest(len(fp), *close_pairs(fp.view(np.uint64), radius)) if len(fp) > 1 else np.zeros(len(fp), np.int64)
            own = np.flatnonzero(root != np.arange(len(fp)))
            return pa.RecordBatch.from_pydict({"a": fp[own], "b": fp[root[own]]})

        keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            keys, fps = (np.concatenate([x, batch.column(n).to_numpy()]) for n, x in (("key", keys), ("fp", fps)))
            ends = np.flatnonzero(np.diff(keys)) + 1
            at = 0
            while len(ends):
                k = max(1, int(np.searchsorted(ends, at + TILE, side="right")))
                if k == len(ends) and ends[-1] - at < TILE:
                    break
                yield edges(fps[at : ends[k - 1]])
                at, ends = int(ends[k - 1]), ends[k:]
            keys, fps = keys[at:], fps[at:]
        # The tail is whole buckets too: a tile's worth of small ones and the last one.
        while len(fps):
            ends = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys))
            end = int(ends[max(0, int(np.searchsorted(ends, TILE, side="right")) - 1)])
            yield edges(fps[:end])
            keys, fps = keys[end:], fps[end:]

    return compare


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs (doc_id, text; others are left out).

    Documents are linked if their fingerprints differ in at most radius bits; component_id is the smallest doc_id that a
    document reaches, itself included. Texts without words, or missing, have fingerprint 0 and link like any other; long
    ones are taken whole.
    Repeated rows come back as often; a missing doc_id never names a component unless all members lack one. An empty
    table gives an empty result.
    """
    prints = written(fingerprints(docs, shingle))
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = written(connected_components(links(distinct.select("fp"), radius)))
    member = written(roots.join(distinct, roots.node == distinct.fp).select("fp", "root", "least"))
    # Both written, so that a giant component's root, one key, is joined by plain exchanges that Spark can split.
    heads = written(member.groupBy("root").agg(F.min("least").alias("joined")))
    joined = member.join(heads, "root").select("fp", "joined")
    # Written, so that the join with all documents has a plain exchange on both sides and Spark can split hot ones.
    classes = written(distinct.join(joined, "fp", "left").select("fp", F.coalesce("joined", "least").alias("component_id")))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")
