"""Document fingerprints: bottom-k sketches of shingle hashes, made and compared by SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, SHINGLE = 128, 5
#: Rows of a window group that neighbours() aims at.
GROUP_ROWS = 1000


def let(value: Column, body) -> Column:
    """body(value), with value worked out once for each row although body uses it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Hashes of all shingles of consecutive words, repeats included: XXH64 chained over the words.

    A text of fewer words is one shingle, one without words has none; missing text counts as empty.
    """

    def hashed(w: Column) -> Column:
        every = F.transform(w, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, shingle))))
        return F.slice(every, 1, F.greatest(F.size(w) - (shingle - 1), F.least(F.size(w), F.lit(1))))

    return let(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \x09-\x0D]+"), lambda x: x != ""), hashed)


def sketch(hashes: Column, k: int = K) -> Column:
    """The k smallest different values, ascending. Sketches of parts merge into that of the whole."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of the Jaccard similarity: the share of the merged sketch that both have; 1 for two empty ones."""
    shared = lambda m: F.size(F.array_intersect(m, F.array_intersect(a, b))) / F.size(m)
    return let(merge(a, b, k), lambda m: F.when(F.size(m) == 0, F.lit(1.0)).otherwise(shared(m)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimate of the number of different shingles: exact below k, else from how low the k-th smallest hash is."""
    share = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of the share of a's shingles that b has too; 1 if a is empty."""
    j, union = resemblance(a, b, k), distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j * union / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as a string: its values in 16 hexadecimal digits each."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def fingerprint(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """docs with a column sketch (array<long>) of its text, and n_shingles, the estimate of how many it has."""
    sketched = docs.withColumn("sketch", sketch(shingle_hashes(F.col("text").cast("string"), shingle), k))
    return sketched.withColumn("n_shingles", distinct_shingles(F.col("sketch"), k))


def with_next(docs: DataFrame, made: dict[str, Column], following: dict[str, str]) -> DataFrame:
    """docs (doc_id, text) with the columns made, and for each name in following that column of the next row.

    Next is by (doc_id, text), after the last row the first; missing doc_ids come first. Rows are dealt out by ranges of
    doc_id whose bounds, taken from approximate quantiles, are doc_ids themselves; the first rows of a range also go to
    the range before it, where they are only looked at. So no task sees all rows, and texts are shuffled once; made is
    worked out after that.
    """
    low = -(1 << 63)
    keyed = docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(low)))
    total, first = keyed.agg(F.count("*"), F.min("_key")).first()
    n = max(1, min(10_000, -(-total // GROUP_ROWS)))
    cuts = keyed.agg(F.percentile_approx("_key", [i / n for i in range(1, n)], 20 * n)).first()[0] if n > 1 else []
    bounds = sorted({low if first is None else first, *cuts})
    starts = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(len(bounds).bit_length()))))
    # The last bound that is not above the key, by halving steps.
    own = F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= len(bounds)) & (F.get(starts, at + s - 1) <= F.col("_key")), at + s).otherwise(at))
    ranged = keyed.withColumn("_own", own)
    before = F.when(F.col("_own") == 1, F.lit(len(bounds))).otherwise(F.col("_own") - 1)
    place = lambda to, ghost: F.struct(to.alias("range"), F.lit(ghost).alias("ghost"))
    both = F.array(place(F.col("_own"), False), place(before, True))
    dealt = ranged.withColumn("_to", F.explode(F.when(F.get(starts, F.col("_own") - 1) == F.col("_key"), both).otherwise(F.slice(both, 1, 1))))
    rows = dealt.select(*docs.columns, "_key", F.col("_to.range").alias("_range"), F.col("_to.ghost").alias("_ghost")).repartition("_range").withColumns(made)
    window = Window.partitionBy("_range").orderBy("_ghost", "_key", "text")
    return rows.withColumns({name: F.lead(column).over(window) for name, column in following.items()}).filter("not _ghost").drop("_key", "_range", "_ghost")


def edited_neighbours(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Each text beside its edited text and the next document's.

    Returns doc_id, n_chars (code points), edited (the text with its last quarter, rounded down, replaced by the first
    as many code points of the next document, or all it has), sketch, edited_sketch, next_sketch. Next is the row with
    the next doc_id, ties ordered by text, after the last the first. Missing texts count as empty, missing doc_ids come
    first. A single row is its own next; an empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    made = {"sketch": sketch(shingle_hashes(F.col("text"), shingle), k), "n_chars": F.length("text").cast("long")}
    rows = with_next(texts, made, {"next_text": "text", "next_sketch": "sketch"})
    size = F.floor(F.col("n_chars") / 4).cast("int")
    edited = rows.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - size), F.left("next_text", size)))
    return edited.select("doc_id", "n_chars", "edited", "sketch", "next_sketch", sketch(shingle_hashes(F.col("edited"), shingle), k).alias("edited_sketch"))
