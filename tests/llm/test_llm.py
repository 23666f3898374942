"""The operators for training data against brute force, on small and awkward tables."""

import hashlib
import random
import re
import weakref
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import types as T

from hustings.llm import common, components, decontamination, fingerprint, language_id, license_scan, packing, sampling, simhash, substring_dedup, token_files, tokens, toxicity, url_filter

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("score", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("spans", T.StringType())])


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def corpus(seed=3, n=60):
    """Random texts with exact and near copies, shared passages, empty, missing and long ones, ties and clashing columns."""
    rng = random.Random(seed)
    vocabulary = ["alpha", "béta", "Gamma,", "delta.", "eps", "Zeta\t", "eta\n", "θήτα", "x1", "MIT", "License", "the", "of", "and", "a"]
    passage = " ".join(rng.choices(vocabulary, k=70))
    texts = []
    for i in range(n):
        body = " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 40, 55, 120])))
        kind = rng.random()
        if texts and kind < 0.15:
            body = rng.choice(texts)
        elif texts and kind < 0.3:
            other = (rng.choice(texts) or "").split(" ")
            other[len(other) // 2] = "changed"
            body = " ".join(other)
        elif kind < 0.5:
            body = f"{body} {passage} {body[:20]}"
        texts.append(body)
    texts += [None, "", " \n\t", "word " * 6000, passage, "a b c"]
    ids = [7 * i % 101 for i in range(len(texts))]
    ids[5] = None
    ids[9] = ids[8]
    rows = list(zip(ids, texts, strict=True))
    rows.append(rows[3])
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "extra", 1, "clash") for i, t in rows], DOCS).repartition(3)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def slow_simhash(text):
    w = (text or "").encode().lower().decode().encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def test_simhash_against_all_pairs(spark, rows, docs, empty):
    got = simhash.near_duplicates(docs).collect()
    prints = [(i, slow_simhash(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(prints):
        if i is not None:
            least[find(a)].append(i)
    want = sorted(((i, p, min(least[find(a)])) if least[find(a)] else (i, p, None) for a, (i, p) in enumerate(prints)), key=str)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 3, 4])
def test_close_pairs(radius):
    rng = np.random.default_rng(radius)
    fp = rng.integers(0, 2**63, 90, dtype=np.uint64)
    fp = np.unique(np.concatenate([fp, fp ^ (np.uint64(1) << rng.integers(0, 64, 90, dtype=np.uint64)), fp ^ np.uint64(0b1111), fp ^ np.uint64(0b10101)]))
    i, j = simhash.close_pairs(fp, radius)
    want = np.nonzero(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius, 1))
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(want[0].tolist(), want[1].tolist(), strict=True))


def test_hot_buckets_are_split_without_loss(spark):
    rng = np.random.default_rng(1)
    center = rng.integers(0, 2**63, dtype=np.uint64)
    near = {int(center ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b))) for a in range(0, 64, 2) for b in range(1, 64, 5)}
    far = {int(x) for x in rng.integers(0, 2**63, 300, dtype=np.uint64)}
    values = [v - 2**64 if v >= 2**63 else v for v in near | far]
    table = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = simhash.links(table, 3, bucket=64)
    roots = {r.node: r.root for r in components.connected_components(edges).collect()}
    u = np.array(sorted(values), np.int64).view(np.uint64)
    want = simhash.forest(len(u), *np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= 3))
    got = [roots.get(int(v), int(v)) for v in u.view(np.int64)]
    assert len(set(got)) == len(set(want.tolist()))
    assert len(set(zip(got, want.tolist(), strict=True))) == len(set(got))


def test_components_of_a_long_path(spark):
    n = 300
    order = random.Random(2).sample(range(n), n)
    edges = spark.createDataFrame([(a, b) for a, b in zip(order, order[1:], strict=False)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components.connected_components(edges).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}
    assert components.connected_components(edges.limit(0)).count() == 0


def test_substring_dedup_against_all_windows(spark, rows, docs, empty):
    first = {}
    for i, t in rows:
        w = words_of(t)
        for a in range(len(w) - 49):
            if i is not None:
                key = tuple(w[a : a + 50])
                first[key] = min(first.get(key, i), i)
    want = []
    for i, t in rows:
        w = words_of(t)
        gone = {p for a in range(len(w) - 49) if i is not None and first[tuple(w[a : a + 50])] < i for p in range(a, a + 50)}
        want.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.cut(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(x[2] for x in want) > 500
    assert substring_dedup.cut(empty).count() == 0


def test_substring_dedup_rests_on_its_automata(spark, docs, monkeypatch):
    searched = substring_dedup.recurring_blocks
    less = lambda texts, held, window: searched(texts, held.withColumn("hashes", common.F.slice("hashes", 1, 1)), window)
    whole = sum(r.n_removed for r in substring_dedup.cut(docs).collect())
    monkeypatch.setattr(substring_dedup, "recurring_blocks", less)
    some = sum(r.n_removed for r in substring_dedup.cut(docs).collect())
    none = lambda texts, held, window: searched(texts, held.withColumn("hashes", common.F.slice("hashes", 1, 0)), window)
    monkeypatch.setattr(substring_dedup, "recurring_blocks", none)
    assert whole > some and sum(r.n_removed for r in substring_dedup.cut(docs).collect()) == 0


def test_automata_find_every_place_of_their_passages():
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["a", "bb", "c", "a1"], k=300)).encode() for _ in range(4)]
    s = substring_dedup.Slice(texts, 50)
    passages = [" ".join(texts[0].decode().split()[i : i + 8]) for i in (0, 17, 292)]
    marks = s.occurrences(passages)
    for d, t in enumerate(texts):
        w = t.decode().split()
        want = [i for i in range(len(w)) if " ".join(w[i : i + 8]) in passages and i + 8 <= len(w)]
        assert np.flatnonzero(marks[s.starts[d] : s.starts[d + 1]]).tolist() == want
    assert not s.occurrences([]).any()


def test_substring_dedup_cuts_only_shared_windows(spark):
    rng = random.Random(5)
    w = [f"w{i}" for i in range(400)]
    a = w[:200]
    b = [f"p{rng.random()}" for _ in range(30)] + w[60:149] + ["mid"] + w[0:49] + ["end"]
    c = w[100:180] + w[10:70]
    table = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c)), (0, " ".join(w[300:340]))], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.cut(table).collect()}
    assert got == {0: 0, 1: 0, 2: 89, 3: 140}


def test_decontamination_against_every_position(spark, rows, docs, empty):
    long = max((t or "" for _, t in rows[:40]), key=len)
    items = [(1, " ".join(words_of(long)[5:25])), (2, "Gamma, delta"), (3, ""), (4, None), (5, "never there at all"), (2, "eps"), (None, "changed"), (11, " ".join(words_of(long)[30:40]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = set()
    for i, t in items:
        w = alnum_of(t)
        size = min(10, len(w))
        windows |= {(tuple(w[a : a + size]), i) for a in range(len(w) - size + 1 if size else 0)}
    want = []
    for i, t in rows:
        w, hit, found = alnum_of(t), set(), set()
        for pattern, owner in windows:
            for a in range(len(w) - len(pattern) + 1):
                if tuple(w[a : a + len(pattern)]) == pattern:
                    hit |= set(range(a, a + len(pattern)))
                    found |= {owner} - {None}
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    for size in (decontamination.SHARD_BYTES, 40):
        got = decontamination.report(decontamination.occurrences(docs, bench, shard_bytes=size))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert decontamination.report(decontamination.occurrences(empty, bench)).count() == 0
    assert {r.contaminated for r in decontamination.report(decontamination.occurrences(docs, bench.limit(0))).collect()} == {False}


def test_decontamination_of_long_texts_and_benchmarks():
    import time
    import tracemalloc

    rng = random.Random(1)
    vocabulary = [f"w{i}x" for i in range(20_000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=150))) for i in range(1_500)]
    assert sum(len(t) for _, t in items) < decontamination.SHARD_BYTES
    tracemalloc.start()
    tables = decontamination.Tables(items, 10)
    assert tracemalloc.get_traced_memory()[1] < 250 << 20
    tracemalloc.stop()
    dense = " ".join(t for _, t in items) * 3
    words = decontamination.alnum_words(dense.encode())
    began = time.process_time()
    spans, found = tables.search(words)
    # Words of neighbouring copies run together where one ends and the next begins, all are covered all the same.
    assert time.process_time() - began < 12 and spans[0][0] == 0 and spans[-1][1] == len(words) and len(found) == len(items)
    same = decontamination.Tables([(i, "mit license " * 40) for i in range(300)], 10)
    assert same.search([b"x", *[b"mit", b"license"] * 100_000, b"x"]) == ([(1, 200_001)], set(range(300)))


def test_decontamination_of_random_sequences_against_every_position():
    rng = random.Random(4)
    for _ in range(60):
        letters = "abc" if rng.random() < 0.5 else "abcdefgh"
        items = [(i, " ".join(rng.choices(letters, k=rng.choice([1, 2, 5, 9, 10, 14, 30])))) for i in range(rng.choice([1, 4, 9]))]
        words = rng.choices(letters, k=80)
        window = rng.choice([1, 2, 3, 10])
        hit, found = set(), set()
        for i, t in items:
            w = t.split()
            size = min(window, len(w))
            for a in range(len(w) - size + 1):
                for b in range(len(words) - size + 1):
                    if words[b : b + size] == w[a : a + size]:
                        hit |= set(range(b, b + size))
                        found.add(i)
        spans, got = decontamination.Tables(items, window).search([w.encode() for w in words])
        assert {p for a, b in spans for p in range(a, b)} == hit and got == found


def test_license_scan_against_every_position(spark, rows, docs, empty):
    more = rows + [(500, "X the MIT License. MIT LICENSE, cc-by cc by 4.0"), (501, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0 WITH Classpath-exception-2.0\nend")]
    got = {(r.doc_id, r.n_words): r for r in license_scan.scan_licenses(frame(spark, more)).collect()}
    for i, t in more:
        w = alnum_of(t)
        starts = [(a, label) for phrase, label in license_scan.BASE_PHRASES.items() for a in range(len(w)) if w[a : a + phrase.count(" ") + 1] == phrase.split()]
        r = got[i, len(w)]
        assert (r.n_base, r.first_word, r.last_word) == (len(starts), min((a for a, _ in starts), default=None), max((a for a, _ in starts), default=None))
        assert r.base_labels == sorted({label for _, label in starts}) and set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1
    assert got[501, len(alnum_of(more[-1][1]))].labels == ["apache-2.0", "gpl-2.0", "mit"]
    assert license_scan.scan_licenses(empty).count() == 0


def test_license_scan_of_a_long_text_takes_no_more_than_its_share_of_time():
    import time

    scanner = license_scan.Scanner()
    for first, piece, n in ((b"", b"mit license ", 2), (b"", b"SPDX-License-Identifier: MIT\t", 0), (b"SPDX-License-Identifier: ", b"MIT OR ", 0)):
        seconds = []
        for size in (500_000, 4_000_000):
            text = first + piece * (size // len(piece))
            began = time.process_time()
            found = scanner.scan(text)
            seconds.append(time.process_time() - began)
            assert found["n_base"] == (size // len(piece) if n else 0) and found["labels"] == ["mit"]
        assert seconds[1] < 8 * 3 * max(seconds[0], 0.02)


def test_license_labels_and_scores(spark):
    texts = ["MIT license, Apache license", "bsd license", "SPDX-License-Identifier: ISC", "none", None, "cc by sa 4.0", "redistribution and use in source and binary forms"]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(7)] == [["apache", "mit"], ["bsd"], ["isc"], [], [], ["cc-by", "cc-by-sa"], ["bsd"]]
    assert [got[i].base_labels for i in range(7)] == [["apache", "mit"], [], [], [], [], ["cc-by"], []]
    assert [got[i].score for i in range(7)] == [0.75, 0.25, 0.75, 0.0, 0.0, 0.5, 0.25]


def test_license_expressions():
    parse = license_scan.parse_expression
    assert parse("MIT or Apache-2.0 and BSD-3-Clause") == ["mit", "apache-2.0", "bsd-3-clause", "and", "or"]
    assert parse(" GPL-2.0 WITH Classpath OR MIT */") == ["gpl-2.0", "classpath", "with", "mit", "or"]
    assert parse("(MIT OR ISC") == [] and parse("MIT AND") == ["mit"] and parse("AND MIT") == [] and parse("") == [] and parse("MIT) x") == ["mit"]
    assert license_scan.permits(parse("(MIT OR X) AND Y"), {"x", "y"}) and not license_scan.permits(parse("MIT AND Y"), {"mit"})


def test_encoder_keeps_marks_with_words_where_the_tokenizer_does():
    from tokenizers import Tokenizer, models, pre_tokenizers

    plain = Tokenizer(models.WordLevel({"[UNK]": 0, "a": 1, "end,": 2, "end": 3, ",": 4, "three": 5}, unk_token="[UNK]"))
    plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    encoder = tokens.WordEncoder(plain.to_str(), 9)
    assert encoder.by_chunk and not encoder.by_mark
    assert np.frombuffer(encoder.encode([b"a end, end , x!"])[0], encoder.width).tolist() == [1, 2, 3, 4, 0, 9]
    assert tokens.WordEncoder(tokens.vocabulary(), 2).by_mark


def test_which_tokenizers_part_at_blanks():
    import json

    own = json.loads(tokens.vocabulary())
    assert tokens.parts_at_blanks(own)
    assert not tokens.parts_at_blanks(own | {"pre_tokenizer": None}) and not tokens.parts_at_blanks(own | {"pre_tokenizer": {"type": "Metaspace", "add_prefix_space": True}})
    spaced = {"type": "Split", "pattern": {"Regex": r" ?\p{L}+|\S+"}, "behavior": "Removed", "invert": True}
    assert not tokens.parts_at_blanks(own | {"pre_tokenizer": spaced}) and tokens.parts_at_blanks(own | {"pre_tokenizer": {"type": "WhitespaceSplit"}})
    assert not tokens.parts_at_blanks(own | {"normalizer": {"type": "Prepend", "prepend": "_"}})


def test_token_files_keep_every_id(spark):
    ids = [-(2**63), 2**63 - 1, 0, None, None]
    docs = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")
    assert sorted((r.doc_id for r in token_files.read_token_files(token_files.write_token_files(docs)).collect()), key=str) == sorted(ids, key=str)


def test_tokens_are_the_whole_texts(rows):
    encoder = tokens.WordEncoder(tokens.vocabulary(), 2)
    odd = ["Ａ ́x don't I'LL ſtrasse ΑΣ Σ b\x1cq\xa0z\u0085y 12３", "<|endoftext|> a<|endoftext|>b, İI.", "ﬁ. é́ 가각 가. it's,  ‘q’. ..., a.b. ﻿z", "x" * 5000]
    texts = [t or "" for _, t in rows] + odd
    for _ in range(2):
        for packed, text in zip(encoder.encode([t.encode() for t in texts]), texts, strict=True):
            assert np.frombuffer(packed, encoder.width).tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_tokens_of_lowered_words_and_runs_of_marks_are_the_whole_texts():
    """A-Z is lowered first, words of a-z go to the model alone, runs of marks are parted: where that changes nothing."""
    import json

    encoder = tokens.WordEncoder(tokens.vocabulary(), 2)
    assert encoder.lowers and encoder.bare is not None
    texts = ["The THE the the*** The*** the.*** x%", "H\u0331 h\u0331 E\u0301 T\u0344 \u0130 \u212a", "<|ENDOFTEXT|> a<|endoftext|> A<|endoftext|>.", "", " \n", "it'S a's. \u00c9t\u00e9*** \x1c9.\x0b\u00a0B"]
    for text in texts:
        assert np.frombuffer(encoder.encode([text.encode()])[0], encoder.width).tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert b"the" in encoder.known and b"The" not in encoder.known and encoder.runs[b"***"]
    cased = json.loads(tokens.vocabulary())
    cased["normalizer"]["normalizers"].pop()
    encoder = tokens.WordEncoder(json.dumps(cased), 2)
    assert not encoder.lowers
    for text in texts:
        assert np.frombuffer(encoder.encode([text.encode()])[0], encoder.width).tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_packing_round_trip(spark, rows, docs, empty, tmp_path):
    encoder = tokens.WordEncoder(tokens.vocabulary(), 2)
    want = sorted(((i, np.frombuffer(encoder.encode([(t or "").encode()])[0], "<u2").tolist()) for i, t in rows), key=str)
    pieces = packing.pack(docs, max_tokens=64).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces) and all(p.length & (p.length - 1) == 0 and p.length <= 64 and p.offset == 0 and 1 << p.bucket == p.length for p in pieces)
    # Pieces of a row follow one another in what collect() returns; a row's pieces begin at 0.
    got, current = [], None
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length
        if p.start == 0:
            current = (p.doc_id, [])
            got.append(current)
        assert current[0] == p.doc_id and len(current[1]) == p.start
        current[1].extend(ids)
    assert sorted(got, key=str) == want
    assert {p.sequence_id >> packing.BUCKET_SHIFT for p in pieces} == {p.bucket for p in pieces} and all(p.sequence_id >> packing.BUCKET_SHIFT == p.bucket for p in pieces)
    side_by_side = packing.by_bucket(packing.pack(docs.coalesce(1), max_tokens=64)).select("bucket").collect()
    assert [r.bucket for r in side_by_side] == sorted(p.bucket for p in pieces)
    packing.write_buckets(packing.pack(docs, max_tokens=64), str(tmp_path / "packed"))
    for r in spark.read.parquet(str(tmp_path / "packed")).groupBy("bucket").agg({"length": "min", "*": "count"}).join(packing.pack(docs, max_tokens=64).groupBy("bucket").agg({"length": "max"}), "bucket").collect():
        assert r["min(length)"] == r["max(length)"] == 1 << r.bucket and r["count(1)"] == sum(p.bucket == r.bucket for p in pieces)
    assert packing.pack(empty).count() == 0
    assert packing.binary_lengths(4096 * 2 + 5, 4096) == [4096, 4096, 4, 1]


def test_packing_leaves_nothing_in_its_worker():
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3]), "text": ["a b", None, "c d e"]})
    common.word_hashes([b"a", b"b"])
    vocab = tokens.vocabulary()
    made = packing._cut(iter([batch]), vocab, 2, 64, 0)
    first = next(made)
    encoder = weakref.ref(tokens.encoder(vocab, 2))
    assert encoder() is not None and not common._hashes and first.column("length").to_pylist() == [2, 1, 1, 4]
    assert list(made) == [] and encoder() is None and not common.kept


def test_token_files_round_trip(spark, rows, docs, empty):
    encoder = tokens.WordEncoder(tokens.vocabulary(), 2)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for i, t in ordered:
        ids = np.frombuffer(encoder.encode([(t or "").encode()])[0], "<u2")
        want.append((i, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
        start += len(ids)
    got = token_files.read_token_files(token_files.write_token_files(docs), token_files.ids_crc32, "ids_crc32 long").drop("shard")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    assert token_files.read_token_files(token_files.write_token_files(empty)).count() == 0


def exact_jaccard(a, b):
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [words_of(t)] for i in range(max(1, len(w) - 4) if w else 0)}
    x, y = shingles(a), shingles(b)
    return 1.0 if not x | y else len(x & y) / len(x | y)


def test_fingerprints_of_neighbours(spark, rows, docs, empty, monkeypatch):
    monkeypatch.setattr(fingerprint, "GROUP_ROWS", 7)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = {(r.doc_id, r.n_chars, r.edited): r for r in fingerprint.edited_neighbours(docs).withColumn("near", fingerprint.resemblance(common.F.col("sketch"), common.F.col("edited_sketch"))).withColumn("next", fingerprint.resemblance(common.F.col("sketch"), common.F.col("next_sketch"))).collect()}
    assert len(got) >= len(rows) - 2
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        t, after = t or "", after or ""
        q = len(t) // 4
        edited = t[: len(t) - q] + after[:q]
        r = got[i, len(t), edited]
        assert abs(r.near - exact_jaccard(t, edited)) < 0.16 and abs(r.next - exact_jaccard(t, after)) < 0.16
        assert list(r.sketch) == sorted(set(r.sketch)) and len(r.sketch) <= fingerprint.K
    assert fingerprint.edited_neighbours(empty).count() == 0


def test_sketches_merge_and_estimate(spark):
    from pyspark.sql import functions as F

    a, b = " ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(1500, 4500))
    df = fingerprint.fingerprint(spark.createDataFrame([(1, a, b)], "doc_id long, text string, other string")).withColumn("o", fingerprint.sketch(fingerprint.shingle_hashes(F.col("other"))))
    r = df.select("n_shingles", fingerprint.containment(F.col("sketch"), F.col("o")).alias("c"), fingerprint.resemblance(F.col("sketch"), F.col("o")).alias("j"), (fingerprint.merge(F.col("sketch"), F.col("o")) == fingerprint.sketch(F.concat(fingerprint.shingle_hashes(F.col("text")), fingerprint.shingle_hashes(F.col("other"))))).alias("same")).first()
    assert abs(r.n_shingles / 2996 - 1) < 0.3 and abs(r.j - 1 / 3) < 0.13 and abs(r.c - 0.5) < 0.2 and r.same


def test_url_filter_as_of(spark):
    captures = [(1, "http://a.x.example.com/en/1?q=1", "2024-03-01"), (2, "http://a.x.example.com/en/1", "2024-06-01"), (3, "http://a.x.example.com/en/1", "2024-07-01"), (4, "HTTP://User@A.X.example.COM:80/EN/1#z", "2024-03-01"), (5, None, "2024-03-01"), (6, "/relative", "2024-03-01"), (7, "http://other.org", None), (None, "http://other.org", "2024-03-01"), (8, "http://other.org", "2024-03-01"), (8, "http://other.org", "2024-03-01")]
    entries = [("domain", "example.com", "block", "add", "2024-01-01", "ads"), ("domain", "example.com", "block", "remove", "2024-06-01", None), ("prefix", "a.x.example.com/en/", "allow", "add", "2024-02-01", "news"), ("prefix", "a.x.example.com/en/", "allow", "remove", "2024-02-20", "news"), ("host", "a.x.example.com", "allow", "add", "2024-06-30", "news"), ("host", "a.x.example.com", "block", "add", "2024-06-30", "ads"), ("host", None, "block", "add", "2024-01-01", None), ("url", "other.org/", "block", "add", None, "x"), ("host", "other.org", "block", "remove", "2024-01-01", None)]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched string").withColumn("fetched", common.F.col("fetched").cast("date"))
    e = spark.createDataFrame(entries, "kind string, value string, list string, action string, dated string, category string").withColumn("dated", common.F.col("dated").cast("date"))
    got = {r.page_id: (r.n_active, r.kind, r.list, r.blocked) for r in url_filter.evaluate(c, e).collect()}
    none = (0, None, None, False)
    assert got == {1: (1, "domain", "block", True), 2: none, 3: (2, "host", "block", True), 4: (1, "domain", "block", True), 5: none, 6: none, 7: none, None: none, 8: none}
    assert url_filter.evaluate(c.limit(0), e).count() == 0 and url_filter.evaluate(c, e.limit(0)).count() == 9


def synthetic(kind, n=400):
    rng = random.Random(9)
    syllables = {"xx": ["ka", "ro", "mi", "té"], "yy": ["sch", "ung", "ber", "ö"]}
    out = []
    for i in range(n):
        lang = "xx" if i % 3 else "yy"
        body = ". ".join(" ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(9)) for _ in range(5))
        toxic = int(i % 4 == 1)
        if toxic:
            body += f". you {rng.choice(['grublin', 'snarfle'])} roka. Kami"
        out.append((i, body, lang, toxic))
    return out


def test_toxicity_learns_words_and_finds_sentences(spark):
    rows = synthetic("toxic")
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _, _ in rows] + [(9000, None, "x", 1), (9001, "", "x", 1)], "doc_id long, text string, score string, held_out int")
    labels = spark.createDataFrame([(i, y) for i, _, _, y in rows] + [(None, 1), (77777, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    held = [(got[i].score >= 0.3, bool(y)) for i, _, _, y in rows if got[i].held_out]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.97
    assert got[9000].score < 0.05 and got[9001].score < 0.05
    assert [x.sentence for x in got[1].offending] == [5] and any(w in got[1].offending[0].text for w in ("grublin", "snarfle"))
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows)
    assert toxicity.score_toxicity(docs, labels.limit(0)).count() == len(rows) + 2 and toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_language_id_learns(spark):
    rows = synthetic("lang")
    docs = spark.createDataFrame([(i, t, lang, 0.5) for i, t, lang, _ in rows] + [(9000, None, "xx", 0.1), (9001, "12 + 3", "yy", 0.1), (9002, "", None, 0.1), (9003, "té karo", None, 0.1)], "doc_id long, text string, lang string, score double")
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang, _ in rows if got[i].held_out]) > 0.97
    assert [got[i].lang_pred for i in (9000, 9001, 9002)] == ["und"] * 3 and got[9003].lang_pred == "xx"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language_id.identify(docs.limit(0)).count() == 0


def slow_toxicity(text, by_feature, bias):
    quiet = 1.0
    for sentence in re.split(r"[.!?\n]", text or ""):
        words = alnum_of(sentence)
        for at in range(0, len(words), toxicity.SENTENCE_WORDS):
            z = bias + sum(by_feature.get(f, 0.0) for w in words[at : at + toxicity.SENTENCE_WORDS] for f in toxicity.features(w.encode()))
            quiet *= 1 - 1 / (1 + np.exp(-min(max(z, -30), 30)))
    return 1 - quiet


def test_toxicity_scores_against_a_plain_loop(spark, monkeypatch):
    rows = [(i, t, y) for i, t, _, y in synthetic("toxic", 200)] + [(900, "grublin " * 5000, 0), (901, None, 0), (901, "Grublin! roka", 1), (901, "Grublin! roka", 1)]
    docs, labels = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    held = []
    learn = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda sample: held.append(learn(sample)) or held[-1])
    got = sorted(((r.doc_id, r.score) for r in toxicity.score_toxicity(docs, labels).collect()))
    by_feature, bias = held[0]
    assert by_feature and np.allclose([s for _, s in got], [s for _, s in sorted((i, slow_toxicity(t, by_feature, bias)) for i, t, _ in rows)], atol=1e-9)


def slow_language(text, model):
    if not text or not any(map(str.isalpha, text)):
        return "und", 0.0
    data = text.encode()
    total, weights = np.zeros(len(model.languages)), 0.0
    for at in range(0, len(data), language_id.WINDOW):
        x = language_id.SYMBOL[np.frombuffer(data[at : at + language_id.WINDOW].ljust(language_id.WINDOW), np.uint8)]
        peak = [max(sum(f[k, x[p + k], n] for k in range(len(f))) for p in range(len(x) - len(f) + 1)) for f in model.filters for n in range(language_id.FILTERS)]
        z = np.maximum(np.array(peak) + model.shift, 0) @ model.dense + model.bias
        p = np.exp(z - z.max())
        weight = (x > 1).sum() + 1e-3
        total, weights = total + weight * p / p.sum(), weights + weight
    return model.languages[int(total.argmax())], float((total / weights).max())


def test_languages_against_loops_over_windows_and_filters(spark, monkeypatch):
    rows = [(i, t, lang) for i, t, lang, _ in synthetic("lang", 60)] + [(900, None, "xx"), (901, "", "yy"), (902, "1 2", "xx"), (903, "karomi té " * 300, None), (904, "ö", "yy"), (904, "ö", "yy")]
    held = []
    learn = language_id.train
    monkeypatch.setattr(language_id, "train", lambda sample: held.append(learn(sample)) or held[-1])
    monkeypatch.setattr(language_id, "PART", 2 * language_id.WINDOW)
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect())
    want = sorted((i, *slow_language(t, held[0])) for i, t, _ in rows)
    assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want], atol=1e-4)


def test_languages_of_short_or_unlabelled_texts(spark):
    short = spark.createDataFrame([(i, "ab" if i % 3 else "öü", "xx" if i % 3 else "yy") for i in range(80)], "doc_id long, text string, lang string")
    assert all(r.lang_pred == r.lang for r in language_id.identify(short).collect())
    blank = spark.createDataFrame([(i, "12", "xx") for i in range(40)] + [(99, "ab", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language_id.identify(blank).filter("doc_id = 99").collect()] == ["xx"]
    none = short.withColumn("lang", common.F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language_id.identify(none).collect()} == {("und", 0.0)}


def test_the_most_frequent_labels_are_sampled(spark):
    labels = spark.range(3000).selectExpr("id doc_id", f"id % {sampling.MAX_LABELS} lang")
    assert sampling.sample_ids(labels, "lang", 2).count() == 2 * sampling.MAX_LABELS
    many = labels.selectExpr("doc_id", f"doc_id % {sampling.MAX_LABELS + 7} lang")
    n = [len(range(k, 3000, sampling.MAX_LABELS + 7)) for k in range(sampling.MAX_LABELS + 7)]
    kept = sorted(range(len(n)), key=lambda k: (-n[k], k))[: sampling.MAX_LABELS]
    assert sorted(r["lang"] for r in sampling.sample_ids(many, "lang", 1).collect()) == sorted(kept)


def test_long_texts_are_learned_from_in_parts(spark):
    """Toxic texts that are all long: labels are learned, and samples stay within their bound."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(6000)) if i % 2 else ". ".join("vile slur" if k % 3 else "calm word" for k in range(3000))) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 - doc_id % 2 toxic")
    cut = [r[0] for r in docs.select(toxicity.sample_text(common.F.col("text"))).collect()]
    assert all(0 < len(t.encode()) <= toxicity.SAMPLE_BYTES + toxicity.SAMPLE_PARTS for t in cut)
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    assert all((s > 0.5) == (i % 2 == 0) for i, s in scored.items())


def test_inner_names_as_columns(spark):
    """Operators given tables whose columns are named as their own inner ones."""
    names = ["_told", "_told_", "_hits", "_more", "_found", "_words", "_twin", "_spans", "spans", "twin", "sig", "judged", "row", "order", "_sig", "node", "block"]
    docs = spark.createDataFrame([(i, f"alpha beta {i} mit license " * 20, "en", *(f"{n}{i}" for n in names)) for i in range(6)], "doc_id long, text string, lang string, " + ", ".join(f"{n} string" for n in names))
    labels = docs.selectExpr("doc_id", "doc_id % 2 toxic")
    items = spark.createDataFrame([(1, "alpha beta 3 mit")], "item_id long, text string")
    for found in (
        toxicity.score_toxicity(docs, labels), language_id.identify(docs), decontamination.occurrences(docs, items), license_scan.scan_licenses(docs),
        substring_dedup.cut(docs), decontamination.occurrences(docs, items.union(items.selectExpr("item_id + 1", "'mit license alpha'")), shard_bytes=10),
    ):
        rows = found.collect()
        assert len(rows) == 6
        kept = [n for n in names if n in docs.columns and n in found.columns]
        assert set(names) - set(kept) <= {"spans"} and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in kept if n != "spans")


def test_a_doc_id_of_many_rows_is_sampled_once(spark):
    docs = spark.range(100_000).selectExpr("7L doc_id", "concat('t', id) text").union(spark.createDataFrame([(8, "u")], "doc_id long, text string"))
    ids = sampling.sample_ids(spark.createDataFrame([(7, 1), (7, 1), (8, 0)], "doc_id long, toxic int"), "toxic", 5)
    assert sorted(sampling.sampled(docs, ids, "toxic", common.F.col("text"))) == [("t0", 1, 1.0), ("u", 0, 1.0)]


def test_windows_are_cut_where_the_texts_are(spark):
    texts = ["", "a", "b" * 256, "c" * 257, "dé" * 400, "x" * 256 * 9]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(language_id.sample_windows(common.F.col("text")).alias("w")).collect()
    for t, r in zip(texts, got, strict=True):
        n = max(1, -(-len(t.encode()) // 256))
        assert [bytes(w) for w in r.w] == [t.encode()[256 * i : 256 * i + 256] for i in sorted({0, (n - 1) // 2, n - 1})]


def test_samples_are_bounded(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    ids = sampling.sample_ids(labels, "toxic", 15).toPandas()
    assert ids.groupby("toxic").size().tolist() == [15, 15] and np.allclose(ids.weight, 100 / 15)


def test_samples_take_the_lowest_hashes_of_uneven_labels(spark):
    rows = [(i, 0 if i % 100 else 1) for i in range(4000)] + [(7, 1), (8, 0), (None, 1), (9, None)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int").repartition(5)
    ids = sampling.sample_ids(labels, "toxic", 50).toPandas()
    hashed = {r.id: r.h for r in spark.range(4000).selectExpr("id", "xxhash64(id) h").collect()}
    zeros = sorted((i for i in range(4000) if i % 100), key=hashed.get)[:50]
    assert sorted(ids[ids.toxic == 0].doc_id) == sorted(zeros) and sorted(ids[ids.toxic == 1].doc_id) == list(range(0, 4000, 100))
    assert set(ids[ids.toxic == 1].weight) == {1.0} and np.allclose(ids[ids.toxic == 0].weight, 3960 / 50)


def test_sieve_keeps_every_key(spark):
    keys = spark.range(0, 5000, 7).withColumnRenamed("id", "k")
    kept = {r.id for r in spark.range(0, 5000).filter(common.sieve(keys, "k")(common.F.col("id"))).collect()}
    assert set(range(0, 5000, 7)) <= kept and len(kept) < 800


def test_slices_are_bounded():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["ab", None, "c" * 10, "d"]})
    assert [s.num_rows for s in common.slices([batch], "text", 3)] == [2, 1, 1]


def test_sketches_are_the_least_hashes(spark):
    """Sketches and their likeness against XXH64 chained over words, in Python."""
    rng = random.Random(21)

    def hashes(text):
        words = words_of(text)
        out = set()
        for i in range(max(1, len(words) - 4) if words else 0):
            seed = 42
            for w in words[i : i + 5]:
                seed = xxhash.xxh64_intdigest(w.encode(), seed)
            out.add(seed - (1 << 64) if seed >> 63 else seed)
        return out

    texts = [None, "", "one", "one two", "one two three four five", "ça\tva  bien ici là bas et plus"] + [" ".join(f"w{rng.randrange(400)}" for _ in range(n)) for n in (6, 100, 131, 132, 133, 600, 3000)]
    texts += [f"{texts[-1]} more words at the end", texts[-2] + " " + texts[-3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: list(r["sketch"]) for r in fingerprint.fingerprint(docs).collect()}
    want = {i: sorted(hashes(t))[: fingerprint.K] for i, t in enumerate(texts)}
    assert got == want
    pairs = [(a, b) for a in range(len(texts)) for b in range(len(texts)) if (a + b) % 3 == 0]
    rows = spark.createDataFrame([(a, b, want[a], want[b]) for a, b in pairs], "a long, b long, x array<long>, y array<long>")
    for r in rows.select("a", "b", fingerprint.resemblance(common.F.col("x"), common.F.col("y")).alias("j")).collect():
        least = sorted(hashes(texts[r["a"]]) | hashes(texts[r["b"]]))[: fingerprint.K]
        both = hashes(texts[r["a"]]) & hashes(texts[r["b"]])
        assert r["j"] == (sum(h in both for h in least) / len(least) if least else 1.0)
