"""Token-ID / binary output: flat files of unsigned integers with 64-bit document offsets, read back memory-mapped."""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hustings.llm.common import bounded_batches, shared_folder, slices, utf8
from hustings.llm.tokens import encoder, vocabulary

#: Bytes of text that are encoded in one go.
SLICE_BYTES = 1 << 19
READ = "shard long, doc_id long, start long, n_tokens long"


def _folder(uri: str) -> tuple[pafs.FileSystem, str]:
    store, path = pafs.FileSystem.from_uri(uri)
    store.create_dir(path, recursive=True)
    return store, path


def write_token_files(docs: DataFrame, folder: str | None = None, vocab: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the ids of every text of docs (doc_id, text; others are left out) in ascending doc_id order.

    Each shard, a range of doc_ids, gets three files in folder (a URI that driver and executors share; by default one
    below spark.checkpoint.dir): shard.bin holds the ids, unsigned 16 bits wide where the vocabulary allows and else
    32, shard.off the 64-bit offset of each document and the total, shard.ids the doc_ids. A retried task writes the
    same files anew under a name of its own and then renames them, so none is ever half written.

    Returns the manifest, one row per shard that has documents: shard, folder, width, n_docs, n_null (its first documents,
    which have no doc_id), n_tokens, base (ids in all shards before it). Long texts are written whole. Missing text counts as empty; each document ends in end_id. Equal doc_ids keep the order of
    their texts; missing doc_ids come first. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/tokens"
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(vocabulary(vocab))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard, enc, store, at = task.partitionId(), None, None, ""
        lengths, ids, n_null = [], [], 0
        out = None
        for batch in slices(batches, "text", SLICE_BYTES, keep="tokens"):
            if out is None:
                enc = encoder(held.value, end_id)
                store, path = _folder(folder)
                at = f"{path}/{shard:08d}"
                temporary = f"{at}.{task.taskAttemptId()}.tmp"
                out = store.open_output_stream(temporary)
            for packed in enc.encode(utf8(batch.column("text"))):
                out.write(packed)
                lengths.append(len(packed))
            ids.append(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            n_null += batch.column("doc_id").null_count
        if out is None:
            return
        out.close()
        width = np.dtype(enc.width).itemsize
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8") // width
        for name, data in (("off", offsets), ("ids", np.concatenate(ids))):
            with store.open_output_stream(f"{temporary}.{name}") as file:
                file.write(data.tobytes())
            store.move(f"{temporary}.{name}", f"{at}.{name}")
        store.move(temporary, f"{at}.bin")
        yield pa.RecordBatch.from_pydict({"shard": [shard], "folder": [folder], "width": [width], "n_docs": [len(lengths)], "n_null": [n_null], "n_tokens": [int(offsets[-1])]}, pa.schema([("shard", pa.int64()), ("folder", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_tokens", pa.int64())]))

    shards = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    manifest = f"{folder}-manifest"
    shards.mapInArrow(write, "shard long, folder string, width int, n_docs long, n_null long, n_tokens long").write.parquet(manifest)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.parquet(manifest).withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, derive: Callable[[np.ndarray], dict] | None = None, schema: str = "") -> DataFrame:
    """One row per document of the files that manifest lists: shard, doc_id, start (ids before it) and n_tokens.

    derive gets a document's ids, a view of the memory-mapped file, and returns further columns, named in schema; by
    default there are none. Files of a remote store are copied to the task's own temporary folder first.
    """
    names = [x.split()[0] for x in schema.split(",") if x.strip()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = pafs.FileSystem.from_uri(row["folder"])
                at = f"{path}/{row['shard']:08d}"
                offsets, ids = (np.frombuffer(store.open_input_file(f"{at}.{name}").read(), "<i8") for name in ("off", "ids"))
                with tempfile.TemporaryDirectory() as own:
                    local = f"{at}.bin"
                    if not isinstance(store, pafs.LocalFileSystem):
                        pafs.copy_files(local, local := f"{own}/bin", source_filesystem=store, destination_filesystem=pafs.LocalFileSystem())
                    tokens = np.memmap(local, f"<u{row['width']}", "r")
                    for first in range(0, len(ids), 5_000):
                        some = slice(first, min(first + 5_000, len(ids)))
                        starts, ends = offsets[:-1][some], offsets[1:][some]
                        more = [derive(tokens[a:b]) for a, b in zip(starts, ends, strict=True)] if derive else []
                        yield pa.RecordBatch.from_pydict(
                            {"shard": pa.array([row["shard"]] * len(starts), pa.int64()), "doc_id": pa.array(ids[some], pa.int64(), mask=np.arange(some.start, some.stop) < row["n_null"]), "start": pa.array(starts + row["base"]), "n_tokens": pa.array(ends - starts)}
                            | {n: pa.array([m[n] for m in more]) for n in names}
                        )
                    del tokens

    # A count of its own keeps small manifest rows from being gathered into one task that reads all files.
    tasks = min(max(1, manifest.count()), 20_000)
    spread = manifest.select("shard", "folder", "width", "n_null", "base").repartition(tasks, "shard")
    return spread.mapInArrow(read, READ + (f", {schema}" if schema else ""))


def ids_crc32(ids: np.ndarray) -> dict:
    """The CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}
