"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm.common import alnum_words, of_text, spare, written

#: Bytes of benchmark text whose tables a task holds at once (up to about 100 MB of them); a larger benchmark is searched part by
#: part.
SHARD_BYTES = 2 << 20
#: Columns that occurrences() adds.
NEW = ("n_words", "spans", "items")


class WuManber:
    """Search for sequences of words of one length by blocks of two words (one word for sequences of one).

    Words have numbers; a block's two numbers are hashed to a place of the shift table, which tells how far the next
    possible end of a sequence is, the least of what the blocks at one place allow. Words that no sequence has allow the
    longest step. Where a shift is zero, the sequences whose last block has that place, the place's bucket, are compared
    as text. Sequences are kept as stretches of one text; tables are arrays of a few bytes for each.
    """

    def __init__(self, line: bytes, number: dict[bytes, int], ids: np.ndarray, at: np.ndarray, word_start: np.ndarray, owner: np.ndarray, length: int, n_words: int):
        """line: words joined by spaces, with a last space; ids: their numbers; at: where sequences start, in words;
        word_start: where words start, in bytes; owner: for each sequence the place of its item; n_words: words
        of these items, which the size of the tables follows."""
        self.line, self.number, self.length = line, number, length
        self.block = min(2, length)
        self.far = length - self.block + 1
        # Equal sequences become one, with all their owners.
        windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(ids, length)[at])
        _, first, same = np.unique(windows.view(np.dtype((np.void, windows.dtype.itemsize * length))).ravel(), return_index=True, return_inverse=True)
        pairs = np.unique(np.stack([same, owner], axis=1), axis=0)
        self.owner_end = np.searchsorted(pairs[:, 0], np.arange(len(first)), side="right").tolist()
        self.owners = pairs[:, 1].astype(np.int32)
        self.bits = max(8, (4 * n_words).bit_length())
        shift = np.full(1 << self.bits, self.far, np.uint8)
        for end in range(self.block, length + 1):
            np.minimum.at(shift, self.places(windows[first], end), np.uint8(length - end))
        self.shift = shift.tobytes()
        last = self.places(windows[first], length)
        self.order = np.argsort(last, kind="stable").tolist()
        self.bucket = memoryview(np.searchsorted(np.sort(last), np.arange((1 << self.bits) + 1)).astype(np.int32))
        start = at[first]
        # What comes after a sequence where it stands first, in the same item.
        goes_on = np.flatnonzero((np.diff(at) == 1) & (owner[1:] == owner[:-1]))
        follow = np.full(len(first), -1, np.int64)
        held = goes_on[first[same[goes_on]] == goes_on]
        follow[same[held]] = same[held + 1]
        self.follow = follow.tolist()
        self.begin, self.stop = word_start[start].tolist(), (word_start[start + length] - 1).tolist()
        self.after = (word_start[np.minimum(start + length + 1, len(word_start) - 1)] - 1).tolist()

    def places(self, windows: np.ndarray, end: int) -> np.ndarray:
        """The shift table's places of the blocks that end at a place of windows."""
        one = windows[:, end - 1].astype(np.int64)
        return (windows[:, end - 2].astype(np.int64) * 1_000_003 + one if self.block == 2 else one) & ((1 << self.bits) - 1)

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """The stretches of words that sequences cover, in order and parted, and the sequences that occur.

        At a place at most one sequence occurs, as they differ. Where it goes on in its item as the words do, the next
        one is known without a look at the tables.
        """
        end, n, length, far, shift, number = self.length, len(words), self.length, self.far, self.shift, self.number.get
        mask, two, order, bucket, line, begin, stop, after, follow = (1 << self.bits) - 1, self.block == 2, self.order, self.bucket, self.line, self.begin, self.stop, self.after, self.follow
        spans: list[tuple[int, int]] = []
        met: set[int] = set()
        while end <= n:
            if (one := number(words[end - 1])) is None:
                end += length
                continue
            if two:
                if (before := number(words[end - 2])) is None:
                    end += far
                    continue
                one += before * 1_000_003
            one &= mask
            if step := shift[one]:
                end += step
                continue
            text = b" ".join(words[end - length : end])
            for k in order[bucket[one] : bucket[one + 1]]:
                if line[begin[k] : stop[k]] == text:
                    break
            else:
                end += 1
                continue
            start = end - length
            met.add(k)
            while end < n and (then := follow[k]) >= 0 and line[stop[k] + 1 : after[k]] == words[end]:
                k = then
                met.add(k)
                end += 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
            end += 1
        return spans, met

    def owned(self, k: int) -> list[int]:
        """Places of the items that have sequence k."""
        return self.owners[self.owner_end[k - 1] if k else 0 : self.owner_end[k]].tolist()


class Tables:
    """Search tables for the windows of all items, one for each window length: short items are one window each."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.items = [i for i, _ in items]
        words = [alnum_words((text or "").encode()) for _, text in items]
        line = b"".join(w + b" " for ws in words for w in ws)
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int32)
        size = np.array([len(w) for w in words], np.int64)
        word_start = np.concatenate([[0], np.cumsum(np.fromiter((len(w) + 1 for ws in words for w in ws), np.int64))])
        first = np.cumsum(size) - size
        self.by_length = []
        for length in sorted({min(window, int(n)) for n in size if n}):
            which = np.flatnonzero(size >= window if length == window else size == length)
            counts = size[which] - length + 1
            at = np.repeat(first[which] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
            self.by_length.append(WuManber(line, number, ids, at, word_start, np.repeat(which, counts), length, int(size[which].sum())))

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """The stretches of words, parted and in order, that occurrences cover, and the items that occur."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        for t in self.by_length:
            own, met = t.find(words)
            spans += own
            items.update(self.items[i] for k in met for i in t.owned(k))
        return (spans if len(self.by_length) == 1 else merged(spans)), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def benchmark_shards(benchmark: DataFrame, shard_bytes: int) -> list[DataFrame]:
    """Parts of benchmark of about shard_bytes of text each: the only data that the driver gathers, one at a time."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // shard_bytes)
    items = benchmark.select("item_id", "text").filter("text is not null")
    return [items] if n <= 1 else [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = 10, columns: list[str] | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per row of docs: the named columns (all by default), and n_words, spans (start and end, in words, of the
    stretches that occurrences of benchmark windows cover) and items (the item_ids that occur).

    A window is `window` consecutive words of an item; an item of fewer, but not none, is one window. Missing texts have
    no words, so they hold nothing and nothing is found in them; long texts take time in proportion to their length. An
    empty benchmark finds nothing; repeated items count once by item_id; items without item_id mark words but are not
    listed. Repeated rows come back as often. Columns of docs named as the new ones give way to them. A benchmark of over
    shard_bytes is searched in parts, one after the other: each pass is written before the next one begins, so no task
    and no driver holds more of it at once (an item is in one part whole).
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in NEW]
    kind = "string" if dict(benchmark.dtypes)["item_id"] == "string" else "bigint"
    keep = names if columns is None else columns
    shards = benchmark_shards(benchmark, shard_bytes)
    inner, more, found = spare(docs, "_hits"), spare(docs, "_more"), None
    for k, shard in enumerate(shards):
        tables = spark.sparkContext.broadcast([(r[0], r[1]) for r in shard.toLocalIterator()])
        hits = _hits(spark, tables, window, kind)
        if k == 0:
            base = docs.select(*(dict.fromkeys(keep) if len(shards) == 1 else names), hits.alias(inner))
        else:
            base = found.withColumn(more, hits).withColumn(inner, _joined(F.col(inner), F.col(more))).drop(more)
        found = base if k == len(shards) - 1 else written(base)
    return found.select(*keep, *(F.col(inner)[c].alias(c) for c in NEW))


def _hits(spark, held, window: int, kind: str) -> Column:
    def setup():
        tables = Tables(held.value, window)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

        def look(texts: list[bytes]) -> pa.Array:
            counts, spans, items = [], [], []
            for text in texts:
                words = alnum_words(text)
                s, i = tables.search(words)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in s])
                items.append(sorted(i - {None}))
            return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string() if kind == "string" else pa.int64()))], list(NEW))

        return look

    return of_text(spark, F.col("text"), f"n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<{kind}>", setup)


def _joined(hits: Column, more: Column) -> Column:
    """Two searches of one text as one: stretches that touch are merged, items listed once."""
    both = F.array_sort(F.concat(hits["spans"], more["spans"]))
    merge = lambda done, s: F.when(
        (F.size(done) > 0) & (s["start"] <= F.element_at(done, -1)["end"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(done, F.array(s)))
    spans = F.aggregate(both, F.array().cast("array<struct<start:bigint,end:bigint>>"), merge)
    return F.struct(hits["n_words"].alias("n_words"), spans.alias("spans"), F.array_sort(F.array_union(hits["items"], more["items"])).alias("items"))


def report(found: DataFrame) -> DataFrame:
    """What occurrences() found, as counts and a digest per document."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
