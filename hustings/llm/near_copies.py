"""Near-copies by word shingles: SimHash fingerprints of five-word shingles, compared bit-sliced within min-hash buckets,
each pair that comes of it checked on its shingles, and what they miss found by shared rare shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm import simhash
from hustings.llm.common import Sieve, bounded_batches, mixed, release, sieve, slices, utf8, word_hashes, written
from hustings.llm.components import connected_components

#: Words of a shingle, and the least Jaccard similarity of a link, as a fraction.
SHINGLE, LEAST = 5, (4, 5)
#: Buckets that each text goes to, and min-hashes that a bucket's key is made of. Two texts of similarity 0.8 miss each
#: other in all 24 with a chance of (1 - 0.8 ** 4) ** 24, three in a million.
BANDS, ROWS = 24, 4
#: Bits in which fingerprints may differ. They are made of different shingles, as the similarity is; each bit of two texts
#: of similarity 0.8 differs with a chance of 0.15 (many shingles) to 0.19 (four of five), so they differ in over 28 of 64
#: with a chance of one in ten million at most.
RADIUS = 28
#: One text of so many is asked which shingles are common; those seen in COMMON_TEXTS of them are, COMMON of them at most.
#: That settles only in what order a text's shingles are taken, never which texts are compared.
ASKED, COMMON_TEXTS, COMMON = 32, 3, 1 << 20
#: Rows of a bucket that one comparison takes, and their shingles; larger buckets are compared part by part.
TILE, TILE_SHINGLES = 4096, 1 << 21
_SEEDS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: bytes, size: int = SHINGLE) -> set[bytes]:
    words = text.lower().split()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of a text's shingles, repeats included: hashes of its words, rolled into one."""
    value = word_hashes(text.lower().split())
    n = max(1, len(value) - size + 1) if len(value) else 0
    rolled = np.zeros(n, np.uint64)
    for k in range(min(size, len(value))):
        rolled = rolled * np.uint64(0xC2B2AE3D27D4EB4F) + value[k : k + n]
    return mixed(rolled)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """BANDS keys, each of ROWS min-hashes. A text without shingles has keys that only such texts have."""
    least = np.zeros(len(_SEEDS), np.uint64)
    for at in range(0, len(hashes), 2048):
        some = (hashes[at : at + 2048, None] * _SEEDS[None, :]).min(axis=0)
        least = some if at == 0 else np.minimum(least, some)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        key = mixed(key * np.uint64(0xC2B2AE3D27D4EB4F) + row)
    return key


def keyed(docs: DataFrame) -> DataFrame:
    """docs with sig, a hash of the text that stands for it; a missing text counts as empty."""
    return docs.withColumn("sig", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def common_shingles(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the most common shingles of docs (sig, text), ascending, and in how many of the texts asked each is."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [np.unique(shingle_hashes(t, size)) for t in utf8(batch.column("text"))]
            value, texts = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(texts)], names=["token", "texts"])

    bounded_batches(docs.sparkSession)
    asked = docs.filter(F.pmod(F.xxhash64("sig"), F.lit(ASKED)) == 0).select("text").mapInArrow(make, "token long, texts long")
    most = asked.groupBy("token").agg(F.sum("texts").alias("texts")).filter(F.col("texts") >= COMMON_TEXTS).orderBy(F.desc("texts"), "token").limit(COMMON).toArrow()
    value, texts = most.column("token").to_numpy().view(np.uint64), most.column("texts").to_numpy()
    order = np.argsort(value)
    return value[order], texts[order]


def first_shingles(own: np.ndarray, least: tuple[int, int], common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """So many of a set's n hashes (own, ascending) that two sets as alike as `least` share one of theirs: n less
    ceil(n * least) and one, in one order for all sets, common ones last."""
    (num, den), (value, texts) = least, common
    if not len(own):
        return own
    count = len(own) - -(-num * len(own) // den) + 1
    at = np.minimum(np.searchsorted(value, own), max(0, len(value) - 1))
    known = value[at] == own if len(value) else np.zeros(len(own), bool)
    rare = own[~known][:count]
    if len(rare) == count:
        return rare
    often = own[known]
    return np.concatenate([rare, often[np.lexsort((often, texts[at[known]]))][: count - len(rare)]])


def sketches(docs: DataFrame, size: int, first: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """docs (doc_id, sig, text) with fp, the text's fingerprint, n, how many different shingles it has, keys, those of its
    buckets, and tokens, the hashes that first picks of its shingles' (none without it), instead of the text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp, n, keys, tokens = [], [], [], [np.empty(0, np.uint64)]
            for text in utf8(batch.column("text")):
                every = shingle_hashes(text, size)
                own = np.unique(every)
                fp.append(simhash.folded(own))
                n.append(len(own))
                keys.append(band_keys(own).view(np.int64))
                tokens.append(first(own) if first else own[:0])
            flat = pa.array(np.concatenate(keys))
            picked = pa.ListArray.from_arrays(np.cumsum([len(t) for t in tokens]).astype(np.int32), pa.array(np.concatenate(tokens).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("sig"), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(n, pa.int32()), pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32), flat), picked],
                names=["doc_id", "sig", "fp", "n", "keys", "tokens"],
            )

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "sig", F.col("text").cast("string").alias("text")).mapInArrow(make, "doc_id long, sig long, fp long, n int, keys array<long>, tokens array<long>")


def alike(pairs: DataFrame, texts: DataFrame, size: int, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of sigs whose texts (sig, text) have sets of shingles so similar."""
    num, den = least

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, set[bytes]] = (0, set())
        for batch in batches:
            good = []
            for a, x, y in zip(batch.column("a").to_pylist(), utf8(batch.column("x")), utf8(batch.column("y")), strict=True):
                if a != last[0] or not last[1]:
                    last = (a, shingles(x, size))
                mine, other = last[1], shingles(y, size)
                shared = len(mine & other)
                good.append(den * shared >= num * (len(mine) + len(other) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
        release()

    side = lambda key, text: texts.select(F.col("sig").alias(key), F.col("text").alias(text))
    return pairs.join(side("b", "y"), "b").join(side("a", "x"), "a").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def within(pairs: DataFrame, prints: DataFrame, radius: int) -> DataFrame:
    """The pairs (a, b) of sigs whose fingerprints (prints: sig, fp) differ in at most radius bits."""
    side = lambda key, fp: prints.select(F.col("sig").alias(key), F.col("fp").alias(fp))
    return pairs.join(side("a", "_x"), "a").join(side("b", "_y"), "b").filter(F.bit_count(F.col("_x").bitwiseXOR(F.col("_y"))) <= radius).select("a", "b")


def shingle_sets(texts: DataFrame, size: int, only: Sieve) -> DataFrame:
    """(sig, hashes): the hashes of each text's different shingles, ascending, as bytes, of the texts whose sig only lets
    pass. texts: (sig, text)."""
    test = only.test

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices((b.filter(test(b.column("bucket"), b.column("position"))) for b in batches), "text"):
            sets = [np.unique(shingle_hashes(t, size)).astype("<u8").tobytes() for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(sets, pa.binary())], names=["sig", "hashes"])

    bucket, position = only.places(F.col("sig"))
    return texts.select("sig", "text", bucket.alias("bucket"), position.alias("position")).mapInArrow(make, "sig long, hashes binary")


def dealt(placed: DataFrame) -> DataFrame:
    """(cell, side, ...): placed (key, band, keys, sig, fp, n, part) of buckets with several parts, dealt into comparisons.

    A bucket that one comparison can take is one cell. In a larger one the rows of its largest part are dealt into lots of
    their own, since they need no comparison with each other: a cell is two lots, of which one at least is of the other
    rows, or one lot of those. side tells a cell's two lots apart; it is 0 where all are compared with all.
    """
    sizes = placed.groupBy("key", "part").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    buckets = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"), F.max(F.struct("rows", "shingles", "part")).alias("major")).filter("parts > 1")
    lots = lambda rows, shingles: F.ceil(F.greatest(rows / F.lit(TILE), shingles / F.lit(TILE_SHINGLES))).cast("int")
    one = lots(F.col("rows"), F.col("shingles")) <= 1
    held = buckets.select(
        "key", F.when(~one, F.col("major.part")).alias("major"), F.when(one, 0).otherwise(lots(F.col("major.rows"), F.col("major.shingles"))).alias("major_lots"),
        F.when(one, 1).otherwise(lots(F.col("rows") - F.col("major.rows"), F.col("shingles") - F.col("major.shingles"))).alias("minor_lots"),
    )
    rows = placed.join(written(held), "key").withColumn("is_major", F.coalesce(F.col("part") == F.col("major"), F.lit(False)))
    lot = F.pmod(F.xxhash64("sig", "key"), F.when(F.col("is_major"), F.col("major_lots")).otherwise(F.col("minor_lots"))).cast("int")
    upto = lambda n: F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: i < n)
    with_minor = lambda other: F.struct(F.lit("m").alias("kind"), F.least("lot", other).alias("i"), F.greatest("lot", other).alias("j"), ((F.col("lot") != other) & (F.col("lot") > other)).cast("int").alias("side"), (F.col("lot") != other).alias("across"))
    across = lambda i, j, side: F.struct(F.lit("M").alias("kind"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"), F.lit(True).alias("across"))
    as_major = F.transform(upto(F.col("minor_lots")), lambda o: across(F.col("lot"), o, 1))
    as_minor = F.concat(F.transform(upto(F.col("minor_lots")), with_minor), F.transform(upto(F.col("major_lots")), lambda o: across(o, F.col("lot"), 0)))
    cells = rows.withColumn("lot", lot).withColumn("c", F.explode(F.when(F.col("is_major"), as_major).otherwise(as_minor)))
    return cells.select(F.xxhash64("key", "c.kind", "c.i", "c.j").alias("cell"), F.col("c.side").alias("side"), F.col("c.across").cast("int").alias("across"), "sig", "fp", "n", "part", "band", "keys", "hashes")


def linked_in_buckets(placed: DataFrame, least: tuple[int, int], radius: int = RADIUS) -> DataFrame:
    """(a, b): pairs of sigs that connect what is linked across the parts of each bucket.

    placed: (key, band, keys, sig, fp, n, part, hashes), each sig once for each key; keys are those of all its bands, so a
    pair is compared in the first bucket that it shares alone. Within a comparison fingerprints are compared bit-sliced;
    pairs within radius bits whose sizes allow the similarity `least` are compared by their sets of shingle hashes, unless
    what was found connects them already. So what leaves a task are edges of a spanning forest, never the pairs.
    """
    num, den = least
    names = ("cell", "sig", "fp", "n", "part", "band", "side", "across")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; whole cells are compared together until they fill a tile."""
        held, blobs = {c: np.empty(0, np.int64) for c in names} | {"keys": np.empty((0, BANDS), np.int64)}, []

        def edges(end: int) -> pa.RecordBatch:
            cell, sig, fp, n, part, band, side, across = (held[c][:end] for c in names)
            i, j = simhash.close_pairs(fp.view(np.uint64), radius) if end > 1 else (np.empty(0, np.int64),) * 2
            keep = (cell[i] == cell[j]) & (part[i] != part[j]) & ((across[i] == 0) | (side[i] != side[j])) & (np.minimum(n[i], n[j]) * den >= np.maximum(n[i], n[j]) * num)
            i, j = i[keep], j[keep]
            keys = held["keys"][:end]
            met = np.concatenate([np.empty(0, bool), *(((keys[i[k : k + 65536]] == keys[j[k : k + 65536]]) & (np.arange(BANDS) < band[i[k : k + 65536]][:, None])).any(axis=1) for k in range(0, len(i), 65536))])  # in an earlier band
            root: dict[int, int] = {}

            def find(x: int) -> int:
                while (up := root.get(x, x)) != x:
                    root[x] = root.get(up, up)
                    x = up
                return x

            sets: dict[int, np.ndarray] = {}
            out: list[tuple[int, int]] = []
            for x, y in zip(i[~met].tolist(), j[~met].tolist(), strict=True):
                a, b = find(int(part[x])), find(int(part[y]))
                if a == b:
                    continue
                for k in (x, y):
                    if k not in sets:
                        sets[k] = np.frombuffer(blobs[k], "<u8")
                shared = len(sets[x]) + len(sets[y]) - len(np.union1d(sets[x], sets[y]))
                if den * shared >= num * (len(sets[x]) + len(sets[y]) - shared):
                    root[a] = b
                    out.append((int(sig[x]), int(sig[y])))
            return pa.RecordBatch.from_pydict({"a": pa.array([min(p) for p in out], pa.int64()), "b": pa.array([max(p) for p in out], pa.int64())})

        def whole(ends: np.ndarray) -> int:
            return int(ends[max(0, int(np.searchsorted(ends, simhash.TILE, side="right")) - 1)])

        for batch in batches:
            fresh = {c: batch.column(c).cast(pa.int64()).to_numpy() for c in names} | {"keys": batch.column("keys").flatten().to_numpy().reshape(-1, BANDS)}
            held = {c: np.concatenate([v, fresh[c]]) for c, v in held.items()}
            blobs += batch.column("hashes").to_pylist()
            ends = np.flatnonzero(np.diff(held["cell"])) + 1
            while len(ends) and (ends[-1] >= simhash.TILE or sum(map(len, blobs)) > 16 * TILE_SHINGLES):
                yield edges(end := whole(ends))
                held, blobs, ends = {c: v[end:] for c, v in held.items()}, blobs[end:], ends[ends > end] - end
        while len(held["cell"]):
            yield edges(end := whole(np.append(np.flatnonzero(np.diff(held["cell"])) + 1, len(held["cell"]))))
            held, blobs = {c: v[end:] for c, v in held.items()}, blobs[end:]
        release()

    bounded_batches(placed.sparkSession)
    return dealt(placed).repartition("cell").sortWithinPartitions("cell").select(*names, "keys", "hashes").mapInArrow(compare, "a long, b long")


def left_over(rows: DataFrame, roots: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(a, b): the pairs of sigs of different components that can be as alike as `least`, and few others.

    rows: (sig, n, tokens), tokens as first_shingles() picks them; roots: (node, root), sigs that are no node stand alone.
    Two sets that are so alike share a token, and more the closer their sizes are: what they share beyond the tokens of
    the set whose tokens end first is at most what else that set has.
    """
    num, den = least
    entries = rows.select("sig", "n", F.explode("tokens").alias("token"))
    tokens = written(entries.groupBy("token").agg(F.min("sig").alias("a"), F.max("sig").alias("b")).filter("a != b").select("token"))
    shared = written(entries.filter(sieve(tokens, "token")(F.col("token"))).join(tokens, "token").groupBy("token", "sig").agg(F.first("n").alias("n")))
    placed = written(shared.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("part", F.coalesce("root", "sig")).drop("root"))
    # Rows of a token's largest part need no comparison with each other.
    parts = placed.groupBy("token", "part").agg(F.count("*").alias("k"))
    major = written(parts.groupBy("token").agg(F.count("*").alias("parts"), F.max(F.struct("k", "part")).alias("most")).filter("parts > 1").select("token", F.col("most.part").alias("major")))
    every = written(placed.join(major, "token"))
    minor = every.filter("part != major").select("token", F.col("sig").alias("x"), F.col("n").alias("nx"), F.col("part").alias("px"))
    fits = F.least("n", "nx") * den >= F.greatest("n", "nx") * num
    pairs = minor.join(every, "token").filter((F.col("px") != F.col("part")) & ((F.col("part") == F.col("major")) | (F.col("x") < F.col("sig"))) & fits)
    met = pairs.groupBy(F.least("x", "sig").alias("a"), F.greatest("x", "sig").alias("b")).agg(F.count("*").alias("k"), F.first(F.col("n").cast("long") + F.col("nx")).alias("both"), F.first(F.greatest("n", "nx")).alias("larger"))
    return met.filter(F.ceil(num * F.col("both") / (num + den)) <= F.col("k") + F.ceil(num * F.col("larger") / den) - 1).select("a", "b")


def classes(docs: DataFrame, size: int = SHINGLE, least: tuple[int, int] = LEAST, radius: int | None = None) -> DataFrame:
    """(sig, n_rows, component_id, stays): one row for each different text of docs (doc_id, sig, text).

    Texts are linked if the Jaccard similarity of their sets of word shingles is at least the fraction `least`; a class is
    what links join. component_id is the smallest doc_id of a class, null only if none of its rows has one; stays tells
    the text of that row (of texts that share it, one). Texts without words are alike. n_rows counts a text's rows.

    Texts meet in buckets by min-hashes. First each is compared with the text of its bucket with the least sig, at most one
    pair for each text and bucket; those within RADIUS bits are checked on their shingles, and the links join most of a
    large class. Then those in one bucket that aren't joined yet are compared, all with all: fingerprints bit-sliced, and
    pairs within RADIUS by 64-bit hashes of their shingles. Links that no bucket or no fingerprint shows are found last, by
    the rare shingles that texts of different classes share, so none is lost. With a radius only the links are made that
    buckets show and whose fingerprints differ in so many bits at most.
    """
    num, den = least
    exact, radius = radius is None, RADIUS if radius is None else radius
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, size)) if exact else None
    rows = written(sketches(docs, size, (lambda own: first_shingles(own, least, common.value)) if exact else None))
    nodes = written(rows.groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_rows"), *(F.first(c).alias(c) for c in ("fp", "n", "keys"))))
    entries = nodes.select("sig", "n", F.posexplode("keys").alias("band", "key"))
    leads = written(entries.groupBy("key").agg(F.min(F.struct("sig", "n")).alias("lead"), F.count("*").alias("k")).filter("k > 1").select("key", "lead"))
    # Keys that one text alone has stay where they are.
    shared = written(entries.filter(sieve(leads, "key")(F.col("key"))).join(leads, "key"))
    fits = F.least("n", "lead.n") * den >= F.greatest("n", "lead.n") * num
    tried = written(shared.filter(fits & (F.col("sig") != F.col("lead.sig"))).select(F.col("lead.sig").alias("a"), F.col("sig").alias("b")).distinct())
    tried = written(within(tried, nodes, radius))
    texts = written(docs.select("sig", "text").filter(sieve(shared, "sig")(F.col("sig"))).groupBy("sig").agg(F.first("text").alias("text")))
    edges = written(alike(tried, texts, size, least))

    joined = written(connected_components(edges))
    placed = shared.join(joined.withColumnRenamed("node", "sig"), "sig", "left").select("key", "band", "sig", "n", F.coalesce("root", "sig").alias("part"))
    several = written(placed.groupBy("key").agg((F.min("part") != F.max("part")).alias("several")).filter("several").select("key"))
    apart = written(placed.join(several, "key", "left_semi"))
    # What a comparison needs of a text is fetched for those alone that meet in such a bucket.
    sets = shingle_sets(texts, size, sieve(apart, "sig"))
    details = written(sets.join(nodes.select("sig", "fp", "keys"), "sig"))
    found = written(linked_in_buckets(apart.join(details, "sig"), least, radius))
    roots = joined if found.isEmpty() else written(connected_components(edges.union(found)))
    if exact:
        rest = written(left_over(rows, roots, least))
        either = rest.select(F.explode(F.array("a", "b")).alias("sig"))
        more = rest if rest.isEmpty() else written(alike(rest, docs.select("sig", "text").filter(sieve(either, "sig")(F.col("sig"))).groupBy("sig").agg(F.first("text").alias("text")), size, least))
        roots = roots if more.isEmpty() else written(connected_components(edges.union(found).union(more)))
    member = written(nodes.select("sig", "doc_id", "n_rows").join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig")))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sig")
    heads = written(member.groupBy("root").agg(F.min(first).alias("head")))
    return member.join(heads, "root").select("sig", "n_rows", F.col("head.doc_id").alias("component_id"), (F.col("sig") == F.col("head.sig")).alias("stays"))


def near_copies(docs: DataFrame, size: int = SHINGLE, least: tuple[int, int] = LEAST) -> DataFrame:
    """(doc_id, component_id) for every row of docs (doc_id, text; others are left out), as classes() has it.

    Repeated rows come back as often; an empty table gives an empty result; texts of any length are taken whole.
    """
    plain = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = written(classes(plain, size, least))
    return plain.select("doc_id", "sig").join(found, "sig").select("doc_id", "component_id")


def one_of_each(docs: DataFrame, size: int = SHINGLE, least: tuple[int, int] = LEAST) -> DataFrame:
    """docs (doc_id, text and others, of any names) with one row of each class: the one with the smallest doc_id, a missing
    one only if all are. Of rows alike in doc_id and text the one whose columns hash lowest stays.

    Only rows that may have to go are shuffled: a bitmap of bounded size finds the others where they are.
    """
    hashable = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map" not in f.dataType.simpleString()]
    rows = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct("*").alias("row"), F.xxhash64(*hashable).alias("order")))
    judged = written(classes(rows.select("doc_id", "sig", "text"), size, least).filter("n_rows > 1 or not stays").withColumnRenamed("sig", "judged"))
    maybe = sieve(judged, "judged")(F.col("sig"))
    met = rows.filter(maybe).join(judged, F.col("sig") == F.col("judged"), "left")
    alone = met.filter(F.col("judged").isNull()).select("row.*")
    heads = met.filter("stays and doc_id <=> component_id")
    one = heads.groupBy("sig").agg(F.min_by("row", "order").alias("row")).select("row.*")
    return rows.filter(~maybe).select("row.*").union(alone).union(one)
