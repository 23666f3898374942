"""Helpers that several operators of this subpackage share: shared folders, Arrow slices, word splitting."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.sources.shared import discard, shared_folder

__all__ = ["Sieve", "alnum_words", "bounded_batches", "discard", "mixed", "of_text", "release", "shared_folder", "sieve", "slices", "spare", "table", "utf8", "word_hashes", "written"]

#: Bytes of text that an operator handles in one go inside a task.
CHUNK_BYTES = 4 << 20
#: Bytes that Spark puts into one Arrow batch for a task, however long its texts are (one row at least).
BATCH_BYTES = 8 << 20
#: Distinct words whose hashes a task keeps.
KEPT_WORDS = 100_000
#: A-Z to a-z and every ASCII byte that is neither a letter nor a digit to a space; other bytes stay.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df, computed once and kept as Parquet in the shared folder, so that a lost executor loses none of it."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the size of the session's Arrow batches to BATCH_BYTES where it allows more."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = int(str(spark.conf.get(name)).rstrip("b"))
    if held > BATCH_BYTES or held <= 0:
        spark.conf.set(name, str(BATCH_BYTES))


#: What a worker process keeps from task to task, by name, and how it is let go.
kept: dict[str, Callable[[], None]] = {}


def release(*but: str) -> None:
    """Lets go what other operators' tasks left in this worker process, as the next stage uses it again, and gives the
    memory that earlier tasks freed back to the system, which the allocators otherwise keep."""
    for name in set(kept).difference(but):
        kept.pop(name)()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES, keep: str = "") -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a slice holds at most limit bytes of text (or one row). keep names what this operator's
    tasks hand on to one another in a worker."""
    release(keep)
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end
        del batch
    release(keep)


def of_text(spark: SparkSession, text: Column, schema: str, setup: Callable[[], Callable[[list[bytes]], pa.Array]]) -> Column:
    """A struct column of the given schema, made from a text column (null is empty) by Arrow batches; other columns of the
    row stay in the JVM.

    setup() runs once in each task and returns the function from texts, CHUNK_BYTES of them at a time, to the struct array
    of as many rows.
    """
    bounded_batches(spark)

    @F.arrow_udf(schema)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        make = setup()
        for batch in batches:
            parts = [make(utf8(part.column(0))) for part in slices([pa.RecordBatch.from_arrays([batch], ["text"])], "text")]
            yield pa.concat_arrays(parts or [make([])])

    return run.asNondeterministic()(text.cast("string"))


def spare(docs: DataFrame, name: str) -> str:
    """A column name that docs has not: name, with underscores after it where need be."""
    held = {c.lower() for c in docs.columns}
    while name.lower() in held:
        name += "_"
    return name


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = WordHashes()


def word_hashes(words: Iterable[bytes]) -> np.ndarray:
    kept["hashes"] = _hashes.clear
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """x with its high bits mixed into the low ones and back, so that order by value is as good as random."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def alnum_words(data: bytes) -> list[bytes]:
    """Words of the pattern [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z."""
    return data.translate(ALNUM).split()


#: Bits of a sieve; 8 MB whatever it was made from.
SIEVE_BITS = 1 << 26


def sieve(keys: DataFrame, column: str) -> Sieve:
    """A test of a long column that is true for every value of keys.column, and false for most others.

    It is a bitmap of SIEVE_BITS hashed values, so what is sent around has one size however many keys there are; the
    more there are, the more other rows pass. It thins out rows before a shuffle; the join after it decides.
    """
    place = F.pmod(F.xxhash64(column), F.lit(SIEVE_BITS))
    spots = keys.filter(F.col(column).isNotNull()).select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    bits = np.zeros(SIEVE_BITS // 8 + 8192, np.uint8)
    for row in spots.collect():  # 2,048 rows of 4 KB at most
        at = (row["bucket"] - 1) * 4096 if row["bucket"] > 0 else len(bits) - 4096
        bits[at : at + len(row["bits"])] |= np.frombuffer(row["bits"], np.uint8)
    held = keys.sparkSession.sparkContext.broadcast(bits)

    def test(bucket: pa.Array, position: pa.Array) -> pa.Array:
        bucket, position = bucket.to_numpy(zero_copy_only=False), position.to_numpy(zero_copy_only=False)
        at = np.where(bucket > 0, (bucket - 1) * 4096, len(held.value) - 4096) + position // 8
        return pa.array((held.value[at] >> (position % 8).astype(np.uint8) & 1).astype(bool))

    return Sieve(test)


class Sieve:
    """The test that sieve() makes: called with a long column it is a condition; where a Python step follows in the same
    tasks, that step takes the columns of places() and calls test itself, so that no task needs two Python workers."""

    def __init__(self, test: Callable[[pa.Array, pa.Array], pa.Array]):
        self.test = test

    @staticmethod
    def places(c: Column) -> tuple[Column, Column]:
        place = F.pmod(F.xxhash64(c), F.lit(SIEVE_BITS))
        return F.bitmap_bucket_number(place), F.bitmap_bit_position(place)

    def __call__(self, c: Column) -> Column:
        test = self.test

        @F.arrow_udf("boolean")
        def held(bucket: pa.Array, position: pa.Array) -> pa.Array:
            return test(bucket, position)

        return c.isNotNull() & held(*self.places(c))
