"""Ranked lexical search: item bundles pass from term owner to term owner and gather scores of documents on the way."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hustings.llm.common import KEPT_WORDS, SIEVE_BITS, alnum_words, bounded_batches, shared_folder, slices, utf8, written

#: Documents that an item gets.
TOP = 10
#: Term owners: the first holds terms in at most this share of the documents, and so on; the last holds the rest. So
#: bundles stay sparse until the last owner, which doesn't send them on.
SHARES = (1 / 64, 1 / 16, 1 / 4)
#: Items of a bundle, about: what a task holds is scores of that many items for one block of documents.
BUNDLE = 256


class Wanted(dict):
    """Whether a word may be an item's term, by a bitmap of one size; remembers some words."""

    def __init__(self, bits: np.ndarray):
        super().__init__()
        self.bits = bits

    def __missing__(self, word: bytes) -> bool:
        if len(self) >= KEPT_WORDS:
            self.clear()
        at = place(word)
        self[word] = found = bool(self.bits[at >> 3] >> (at & 7) & 1)
        return found


def place(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) % SIEVE_BITS


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, reps, place): the terms of items (item_id, text) and how often each occurs. Rows that share an
    item_id are one item; repeated rows count once."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [(i, w, n, place(w)) for i, t in enumerate(utf8(batch.column("text"))) for w, n in Counter(alnum_words(t)).items()]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(at), *(pa.array([r[k] for r in rows], kind) for k, kind in ((1, pa.binary()), (2, pa.int64()), (3, pa.int64())))], names=["item_id", "term", "reps", "place"])

    bounded_batches(items.sparkSession)
    plain = items.select(F.col("item_id"), F.col("text").cast("string").alias("text")).distinct()
    kind = items.schema["item_id"].dataType.simpleString()
    found = plain.mapInArrow(make, f"item_id {kind}, term binary, reps long, place long")
    return found.groupBy("item_id", "term").agg(F.sum("reps").alias("reps"), F.first("place").alias("place"))


def bitmap(places: DataFrame) -> np.ndarray:
    """SIEVE_BITS bits, 8 MB, with those of places.place set."""
    spots = places.groupBy(F.bitmap_bucket_number(F.col("place") + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits"))
    bits = np.zeros(SIEVE_BITS // 8, np.uint8)
    for row in spots.collect():  # 2,048 rows of 4 KB at most
        at = (row["bucket"] - 1) * 4096
        bits[at : at + len(row["bits"])] |= np.frombuffer(row["bits"], np.uint8)
    return bits


def inverted(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(block, term, docs, tfs, ns, doc_ids): documents in blocks as they are read, and each block's lists.

    A block is at most 4 MB of text (or one document) and is numbered by its task. Its documents are numbered from 0 by
    ascending doc_id, the missing last. One row has doc_ids and ns, the numbers of all terms, for all of its documents and
    no term; the others have a term that the bitmap wants, its documents, how often it occurs, and their ns.
    """
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, task, count = Wanted(held.value), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            batch = batch.take(pc.sort_indices(batch.column("doc_id"), null_placement="at_end"))
            lists: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
            ns = np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(utf8(batch.column("text"))):
                words = alnum_words(text)
                ns[i] = len(words)
                for word, tf in Counter(words).items():
                    if wanted[word]:
                        lists[word].append((i, tf))
            terms = list(lists)
            flat = np.array([x for t in terms for x in lists[t]], np.int64).reshape(-1, 2)
            ends = np.cumsum([0, 0, *(len(lists[t]) for t in terms)]).astype(np.int32)
            array = lambda values, offsets=ends: pa.ListArray.from_arrays(offsets, pa.array(values))
            n = len(terms) + 1
            whole = np.concatenate([[0, batch.num_rows], batch.num_rows + ends[2:]]).astype(np.int32)
            ids = np.full(n + 1, batch.num_rows, np.int32)
            ids[0] = 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, (task << 32) + count)), pa.array([None, *terms], pa.binary()), array(flat[:, 0].astype(np.int32)), array(flat[:, 1].astype(np.int32)),
                 pa.ListArray.from_arrays(whole, pa.array(np.concatenate([ns, ns[flat[:, 0]]]))), pa.ListArray.from_arrays(ids, batch.column("doc_id"))],
                names=["block", "term", "docs", "tfs", "ns", "doc_ids"],
            )
            count += 1

    bounded_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(make, "block long, term binary, docs array<int>, tfs array<int>, ns array<long>, doc_ids array<long>")


def parts(tfs: np.ndarray, ns: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to documents' scores, before its weight; 64-bit integers, division rounds down."""
    m = 100 - 75 + 75 * ns * n_docs // n_terms
    return 1_000_000_000 * tfs // (1000 * tfs + 8 * m)


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): for each of items (item_id, text) its `top` documents (doc_id, text) with the
    highest scores above 0, equal ones by ascending doc_id, a missing one last. Other columns are left out.

    Terms are runs of ASCII letters, digits and any characters above ASCII, A-Z lower-cased. Rows without text have none
    and count for nothing; rows of documents that repeat are documents of their own; rows of items that share an item_id
    are one item. Empty tables give an empty result.

    Terms are dealt to owners by how many documents hold them. A bundle, some items with what they have gathered for one
    block of documents, passes from the rarest terms' owner to the commonest terms' one; each adds what its lists say.
    The last picks each block's best, of which the best of all are picked. Blocks and bundles are of bounded size, so hot
    terms and items are spread over as many tasks as there are blocks.
    """
    session = docs.sparkSession
    terms = written(item_terms(items))
    lists = written(inverted(docs, bitmap(terms)))
    totals = lists.filter("term is null").select(
        F.aggregate("ns", F.lit(0).cast("long"), lambda a, n: a + (n > 0).cast("long")).alias("docs"), F.aggregate("ns", F.lit(0).cast("long"), lambda a, n: a + n).alias("terms")
    ).agg(F.sum("docs"), F.sum("terms"), F.count("*")).first()
    n_docs, n_terms = totals[0] or 0, totals[1] or 0
    counts = lists.filter("term is not null").groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    owner = sum(((F.col("df") > F.lit(share * n_docs)).cast("int") for share in SHARES), F.lit(0))
    bundles = -(-terms.select("item_id").distinct().count() // BUNDLE) or 1
    carried = terms.join(counts, "term").filter(weight > 0).groupBy("term", F.pmod(F.xxhash64("item_id"), F.lit(bundles)).cast("long").alias("bundle"))
    asked = carried.agg(F.first(weight).alias("weight"), F.first(owner).alias("owner"), F.collect_list(F.struct("item_id", "reps")).alias("asking"))
    asked = asked.select("term", "bundle", "weight", "owner", F.col("asking.item_id").alias("items"), F.col("asking.reps").alias("reps"))
    path = f"{shared_folder(session)}/lists"
    met = lists.filter("term is not null").join(written(asked), "term").select("owner", "block", "bundle", "weight", "docs", "tfs", "ns", "items", "reps")
    met.write.option("compression", "zstd").partitionBy("owner").parquet(path)
    # Partition values are inferred as int, as owner is.
    owned = session.read.schema(met.schema).parquet(path)
    blocks = lists.filter("term is null").select("block", "doc_ids", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bundles - 1).cast("long"))).alias("bundle"))
    item_type = items.schema["item_id"].dataType.simpleString()
    last = len(SHARES)

    def gather(final: bool):
        def add(bundle: pa.Table, postings: pa.Table) -> pa.Table:
            ids = next((x for x in (postings.column("doc_ids").to_pylist() if final else ()) if x is not None), [])
            scores: dict = {}
            size = _size(bundle, postings)
            for item, docs_, own in zip(bundle.column("item_id").to_pylist(), _arrays(bundle.column("docs")), _arrays(bundle.column("scores")), strict=True):
                scores[item] = acc = np.zeros(size, np.int64)
                acc[docs_] = own
            columns = [_arrays(postings.column(c)) for c in ("docs", "tfs", "ns")]
            for docs_, tfs, ns, w, its, reps in zip(*columns, *(postings.column(c).to_pylist() for c in ("weight", "items", "reps")), strict=True):
                if w is None:
                    continue
                part = w * parts(tfs.astype(np.int64), ns, n_docs, n_terms)
                for item, n in zip(its, reps, strict=True):
                    if (acc := scores.get(item)) is None:
                        scores[item] = acc = np.zeros(size, np.int64)
                    acc[docs_] += n * part
            found = [(item, np.flatnonzero(acc)) for item, acc in scores.items()]
            if not final:
                rows = [(item, at, scores[item][at]) for item, at in found if len(at)]
                if not rows:
                    return bundle.slice(0, 0)
                key = {c: (bundle if bundle.num_rows else postings).column(c)[0].as_py() for c in ("block", "bundle")}
                ends = np.cumsum([0, *(len(at) for _, at, _ in rows)]).astype(np.int32)
                gathered = {"docs": np.concatenate([r[1] for r in rows]).astype(np.int32), "scores": np.concatenate([r[2] for r in rows])}
                return pa.table(
                    {c: pa.array([v] * len(rows), pa.int64()) for c, v in key.items()}
                    | {"item_id": pa.array([r[0] for r in rows], bundle.schema.field("item_id").type)}
                    | {c: pa.ListArray.from_arrays(ends, pa.array(v)) for c, v in gathered.items()}
                )
            best = []
            for item, at in found:
                own = scores[item][at]
                best += [(item, ids[at[k]], int(own[k])) for k in np.lexsort((at, -own))[:top]]
            return pa.table({"item_id": pa.array([b[0] for b in best], bundle.schema.field("item_id").type), "doc_id": pa.array([b[1] for b in best], pa.int64()), "score": pa.array([b[2] for b in best], pa.int64())})

        return add

    carry = f"block long, bundle long, item_id {item_type}, docs array<int>, scores array<long>"
    state = session.createDataFrame([], carry)
    for k in range(last):
        mine = owned.filter(F.col("owner") == k).drop("owner")
        state = state.groupBy("block", "bundle").cogroup(mine.groupBy("block", "bundle")).applyInArrow(gather(False), carry)
    mine = owned.filter(F.col("owner") == last).drop("owner").unionByName(blocks, allowMissingColumns=True)
    picked = state.groupBy("block", "bundle").cogroup(mine.groupBy("block", "bundle")).applyInArrow(gather(True), f"item_id {item_type}, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return picked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """A list column as numpy arrays; null is empty."""
    out = []
    for chunk in column.chunks:
        ends = np.cumsum(pc.fill_null(chunk.value_lengths(), 0).to_numpy(zero_copy_only=False))
        out += np.split(chunk.flatten().to_numpy(zero_copy_only=False), ends[:-1]) if len(chunk) else []
    return out


def _size(*tables: pa.Table) -> int:
    """One more than the greatest document number of the tables' docs."""
    return 1 + max((int(x.max()) for t in tables for x in _arrays(t.column("docs")) if len(x)), default=-1)
