"""The pipeline's near-dedup stage against all pairs by brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from hustings.llm import common, near_copies, simhash, substring_dedup
from hustings.llm.near_copies import shingles


def edited(words, rng, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def kept_by_brute_force(texts):
    sets = [shingles(t.encode()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [i for i in range(len(texts)) if find(i) == i]


def test_all_pairs_at_four_fifths_meet(spark):
    rng = random.Random(5)
    line = " ".join(f"common{i}" for i in range(12))
    texts = []
    for _ in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([5, 30, 200, 400]))]
        texts.append(" ".join(words))
        texts += [edited(words, rng, max(1, len(words) * k // 100)) for k in (1, 2, 2, 3, 4)]
        texts.append(f"{line} {' '.join(words)}")
    chain = [f"c{i}" for i in range(300)]
    for i in range(60):
        chain[5 * i : 5 * i + 2] = [f"n{i}", f"m{i}"]
        texts.append(" ".join(chain))
    texts += ["", " ", "one word", "One  WORD"]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert got == kept_by_brute_force(texts)


def test_a_near_copy_beyond_three_bits_goes(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    copy = edited(words, rng, 8)
    assert (simhash.simhash(" ".join(words).encode()) ^ simhash.simhash(copy.encode())).bit_count() > 3
    docs = spark.createDataFrame([(1, " ".join(words)), (2, copy)], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()] == [1]


def test_one_row_of_each_class_stays(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(5000)}" for _ in range(300)]
    text, close = " ".join(words), edited(words, rng, 4)
    rows = [(5, text, "a"), (5, text, "a"), (5, text, "b"), (3, close, "c"), (None, text, "d"), (9, "alone", "e"), (None, "x y", "f"), (None, "x  y", "g"), (None, None, "h"), (4, "", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sig string").repartition(3)
    got = sorted(((r.doc_id, r.sig) for r in near_copies.one_of_each(docs.withColumnRenamed("sig", "other")).withColumnRenamed("other", "sig").collect()), key=str)
    assert [i for i, _ in got if i is not None] == [3, 4, 9] and len(got) == 4 and got[-1][1] in ("f", "g")
    assert near_copies.one_of_each(docs.drop("sig").limit(0)).count() == 0
    ids = sorted(((r.doc_id, r.component_id) for r in near_copies.near_copies(docs).collect()), key=str)
    assert ids == sorted([(5, 3), (5, 3), (5, 3), (3, 3), (None, 3), (9, 9), (None, None), (None, None), (None, 4), (4, 4)], key=str)


def awkward(rng):
    """Lines that repeat, texts of four and five shingles, and others that lead buckets without being alike."""
    texts = []
    for k in range(12):
        words = [f"r{k}x{rng.randrange(4000)}" for _ in range(300)]
        line = " ".join(f"line{k}x{i}" for i in range(12))
        texts += [f"{' '.join(words)} {line}", f"{' '.join(words)} {' '.join([line] * 60)}"]
    for k in range(60):
        words = [f"s{k}x{i}" for i in range(9)]
        texts += [" ".join(words), " ".join(words[:8])]
    base = [f"b{i}" for i in range(300)]
    for _ in range(150):
        texts.append(edited(base, rng, rng.choice([8, 10, 12])))
    texts += [" ".join(base), edited(base, rng, 2), edited(base, rng, 3)]
    rng.shuffle(texts)
    return texts


def test_repeated_lines_short_texts_and_leaders(spark, monkeypatch):
    texts = awkward(random.Random(9))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = kept_by_brute_force(texts)
    assert sorted(r.doc_id for r in near_copies.one_of_each(docs).collect()) == want
    # Buckets of over eight rows are dealt into lots.
    monkeypatch.setattr(near_copies, "TILE", 8)
    assert sorted(r.doc_id for r in near_copies.one_of_each(docs).collect()) == want


def test_any_other_columns(spark):
    names = ["sig", "judged", "row", "order", "_sig", "n_rows", "stays", "component_id", "a b"]
    docs = spark.createDataFrame([(i, "same text of five words" if i < 3 else f"other {i}", *(f"{n}{i}" for n in names)) for i in range(5)], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    rows = near_copies.one_of_each(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == [0, 3, 4] and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)


def test_fingerprints_of_similar_sets_are_close():
    """What RADIUS rests on: bits differ with a chance of under a fifth, of sets of any size."""
    rng = np.random.default_rng(7)
    for shared, a, b in ((4, 1, 0), (4, 0, 1), (8, 1, 1), (8, 2, 0), (40, 5, 5), (400, 50, 50), (400, 100, 0)):
        apart = []
        for _ in range(400):
            s, x, y = (rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, k, dtype=np.uint64) for k in (shared, a, b))
            apart.append((simhash.folded(np.concatenate([s, x])) ^ simhash.folded(np.concatenate([s, y]))).bit_count())
        assert np.mean(apart) < 64 / 5 and max(apart) <= near_copies.RADIUS


def test_min_hash_keys_meet_for_similar_sets():
    rng = np.random.default_rng(5)
    missed = 0
    for _ in range(300):
        both = rng.integers(0, 2**63, 80, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, 10, dtype=np.uint64)])) for _ in range(2))
        missed += not (near_copies.band_keys(a) == near_copies.band_keys(b)).any()
    assert missed == 0


def test_no_link_goes_past_the_fingerprints(spark):
    words = [f"w{i}" for i in range(300)]
    near, same = " ".join([*words[:150], "other", *words[151:]]), " ".join(words)
    docs = spark.createDataFrame([(1, same), (2, near), (3, same)], "doc_id long, text string")
    prints = {r.sig: r.fp for r in near_copies.sketches(near_copies.keyed(docs), near_copies.SHINGLE).collect()}
    assert len(set(prints.values())) == 2
    found = lambda radius: sorted(r.component_id for r in near_copies.classes(near_copies.keyed(docs), radius=radius).collect())
    assert found(near_copies.RADIUS) == [1, 1] and found(0) == [1, 2]


def test_no_task_needs_two_python_workers(spark):
    """A sieve and the Python step that its rows go to are not in one task, however few rows there are."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    docs = spark.range(4).select(F.col("id").alias("doc_id"), F.concat(F.lit("w x y " * 30), F.col("id")).alias("text"))
    texts = docs.withColumnRenamed("doc_id", "sig")
    sets = near_copies.shingle_sets(texts, 5, common.sieve(texts.filter("sig % 2 = 0"), "sig"))
    assert sorted(r.sig for r in sets.collect()) == [0, 2] and "ArrowEvalPython" not in plan(sets)
    phrases = spark.range(4).select(F.col("id").alias("doc_id"), F.array(F.lit(1).cast("long")).alias("hashes"))
    assert "BroadcastHashJoin" not in plan(substring_dedup.recurring_blocks(docs, phrases, 50))
    cut = substring_dedup.cut(docs)
    assert [r.n_removed > 0 for r in cut.orderBy("doc_id").collect()] == [False, True, True, True] and "BroadcastHashJoin" not in plan(cut)


def far_copy(rng, n=100):
    """Texts of similarity 0.8 whose fingerprints are far apart: each word put after the first is the one, of some tried,
    whose shingle draws most bits to the other side."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(n + 4)]
    own = np.unique(near_copies.shingle_hashes(" ".join(words).encode()))
    before = np.array([simhash.folded(own) >> b & 1 for b in range(64)])
    longer = list(words)
    for _ in range(n // 4):
        tried = [f"x{rng.randrange(10**9)}" for _ in range(300)]
        last = [near_copies.shingle_hashes(" ".join([*longer[-4:], t]).encode())[0] for t in tried]
        bits = (np.array(last, np.uint64)[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(int)
        longer.append(tried[int((bits != before).sum(axis=1).argmax())])
    return " ".join(words), " ".join(longer)


def test_links_beyond_the_fingerprints_are_found(spark):
    rng = random.Random(3)
    pairs = [far_copy(rng) for _ in range(2)]
    for a, b in pairs:
        x, y = (shingles(t.encode()) for t in (a, b))
        assert 5 * len(x & y) == 4 * len(x | y)
        assert (simhash.folded(np.unique(near_copies.shingle_hashes(a.encode()))) ^ simhash.folded(np.unique(near_copies.shingle_hashes(b.encode())))).bit_count() > near_copies.RADIUS
    texts = [t for pair in pairs for t in pair] + [pairs[0][1] + " y" * 3, "other words stand here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.one_of_each(docs).collect()) == kept_by_brute_force(texts) == [0, 2, 5]
    assert sorted((r.doc_id, r.component_id) for r in near_copies.near_copies(docs).collect()) == [(0, 0), (1, 0), (2, 2), (3, 2), (4, 0), (5, 5)]


def test_links_that_no_bucket_shows_are_left_over(spark, monkeypatch):
    """All links of texts that nothing has joined yet are among the pairs left over, with common shingles and without."""
    texts = awkward(random.Random(11)) + [f"{' '.join(f'common{i}' for i in range(30))} t{k}" for k in range(40)]
    docs = near_copies.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    monkeypatch.setattr(near_copies, "ASKED", 1)
    common = near_copies.common_shingles(docs, near_copies.SHINGLE)
    assert len(common[0]) > 0 and (np.diff(common[0].astype(object)) > 0).all()
    ids = {r.sig: r.doc_id for r in docs.select("sig", "doc_id").collect()}
    sets = [shingles(t.encode()) for t in texts]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    halves = spark.createDataFrame([(s, 1) for s, i in ids.items() if i % 2], "node long, root long")
    for order in (common, (np.empty(0, np.uint64), np.empty(0, np.int64))):
        rows = near_copies.sketches(docs, near_copies.SHINGLE, lambda own: near_copies.first_shingles(own, near_copies.LEAST, order))  # noqa: B023
        pairs = lambda roots: [tuple(sorted((ids[r.a], ids[r.b]))) for r in near_copies.left_over(rows, roots, near_copies.LEAST).collect()]  # noqa: B023, E731
        alone = pairs(halves.limit(0))
        assert want <= set(alone) and len(alone) == len(set(alone)) < len(texts) ** 2 / 8
        some = pairs(halves)
        assert {(i, j) for i, j in want if i % 2 == 0 or j % 2 == 0} <= set(some) and not any(i % 2 and j % 2 for i, j in some)
