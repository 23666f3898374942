"""Ranked search and conversation repair against brute force, on small and awkward tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import types as T

from hustings.llm import conversation_repair as repair
from hustings.llm import ranked_search

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("audit", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("tag", T.LongType())])


def slow_cheapest(turns, costs, most_inserts=2):
    """Every way to edit, by trying all of them."""
    options = []
    for initial, must, cut in turns:
        extra = costs.truncated if cut else 0
        own = [("D", "", costs.delete)]
        if not must:
            own += [("K", initial if initial in ("s", "u", "a") else "!", costs.keep + extra), ("R", "u", costs.rerole + extra), ("R", "a", costs.rerole + extra)]
        options.append(own)
    best = None
    for chosen in itertools.product(*options):
        for k in range(most_inserts + 1):
            for places in itertools.combinations_with_replacement(range(len(turns) + 1), k):
                for put in itertools.product("ua", repeat=k):
                    letters, roles, cost = "", "", 0
                    for i in range(len(turns) + 1):
                        for p, r in zip(places, put, strict=True):
                            if p == i:
                                letters, roles, cost = letters + "I", roles + r, cost + costs.insert
                        if i < len(turns):
                            e, r, c = chosen[i]
                            letters, roles, cost = letters + e, roles + r, cost + c
                    if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, letters) < best):
                        best = (cost, letters)
    return best


@pytest.mark.parametrize("costs", [repair.Costs(), repair.Costs(insert=1), repair.Costs(rerole=3, insert=2, truncated=1), repair.Costs(delete=9, insert=3, truncated=0)])
def test_cheapest_equals_every_way_tried(costs):
    rng = random.Random(7)
    for _ in range(60):
        turns = [(rng.choice("suaux "), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(4))]
        assert repair.cheapest(turns, costs) == slow_cheapest(turns, costs, 3 if len(turns) < 3 else 2), turns


def test_long_conversations_are_decided():
    turns = [("u" if i % 2 == 0 else "a", False, False) for i in range(4000)]
    assert repair.cheapest(turns) == (0, "K" * 4000)
    turns[1001] = ("a", True, False)  # gone, so its neighbour goes too
    assert repair.cheapest(turns)[0] == 4


def slow_report(rows, costs=repair.Costs()):
    """What the contract says, conversation by conversation."""
    damaged, out = {}, {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        own = damaged.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        own += [(turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    for conv, own in damaged.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults, steps = set(), Counter(), []
        for _, role, text in own:
            inked = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not inked else "duplicate" if (role, text) in seen else "truncated" if inked[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            steps.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(steps))
        numbers = {t for t, _, _ in own if t is not None}
        cost, audit = repair.cheapest(steps, costs)
        lines, at, state = [], 0, 0
        for letter in audit:
            wanted = "assistant" if state == 2 else "user"
            role, text = (None, "") if letter == "I" else own[at][1:]
            at += letter != "I"
            if letter == "D":
                continue
            role = role if letter == "K" else wanted
            lines.append(f"{role}:{text}")
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.mark.parametrize("costs", [repair.Costs(), repair.Costs(delete=7, insert=1)])
def test_report_equals_the_contract(spark, costs):
    rng = random.Random(5)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", None, "Ça va. \n", "x" * 70000 + ".", "a.b", "né"]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randrange(1, 9)):
            row = (conv, rng.choice([turn, turn + 1, None, turn]), rng.choice(["user", "assistant", "system", "user", "assistant", None, "tool", ""]), rng.choice(texts))
            rows += [row] * rng.choice([1, 1, 1, 2])
    rng.shuffle(rows)
    table = spark.createDataFrame([(*r, "clash", 5, 6) for r in rows], TURNS).repartition(3)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.report(repair.damaged(table), table, costs).collect()}
    assert got == slow_report(rows, costs)


def test_conversations_without_turns(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(dropped, 0, "user", "Hello.", "", 0, 0)], TURNS)
    rows = repair.report(repair.damaged(table), table).collect()
    assert [tuple(r) for r in rows] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    none = spark.createDataFrame([], TURNS)
    assert repair.report(repair.damaged(none), none).count() == 0


def test_one_hot_conversation_and_its_repaired_turns(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"turn {i}.") for i in range(3000)] + [(2, 0, "user", "Hi.")]
    table = spark.createDataFrame([(*r, "", 0, 0) for r in rows], TURNS).repartition(4)
    plans = repair.plan(table)
    kept = [r for r in repair.repaired(table, plans).orderBy("conv_id", "seq").collect() if r["conv_id"] == 1]
    assert [r["seq"] for r in kept] == list(range(len(kept)))
    assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in kept)) and len(kept) > 2000


DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("term", T.StringType()), T.StructField("block", T.LongType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])


def terms_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def slow_rank(docs, items, top=10):
    counted = [(d, Counter(terms_of(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    asked = {}
    for item, text in dict.fromkeys(items):
        asked.setdefault(item, Counter()).update(terms_of(text))
    for item, wanted in asked.items():
        scores = []
        for doc, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(reps * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, reps in wanted.items() if t in c)
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, k, doc, -s) for k, (s, _, doc) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=str)


def corpus(rng, n):
    words = ["the", "of", "Ärger", "naïve", "x1", "alpha", "BETA", "gamma", "ß", "δέλτα", "rare1", "rare2", "rare3"]
    texts = [" ".join(rng.choices(words[:-3], weights=[40, 30, 3, 2, 4, 5, 3, 2, 1, 1], k=rng.choice([0, 1, 3, 30, 80]))) for _ in range(n)]
    for i in range(0, n, 7):
        texts[i] += f"; {rng.choice(words)}, {words[-1 - i % 3]}."
    return texts


@pytest.mark.parametrize("bundle", [1, 256])
def test_rank_equals_brute_force(spark, monkeypatch, bundle):
    monkeypatch.setattr(ranked_search, "BUNDLE", bundle)
    rng = random.Random(11)
    texts = corpus(rng, 150)
    docs = [(i * 13 % 151, t) for i, t in enumerate(texts)] + [(500, None), (501, ""), (None, texts[3]), (502, "the " * 40000 + "rare1"), (503, texts[3])]
    docs += docs[5:7]
    items = [(i, " ".join(corpus(rng, 2))) for i in range(12)] + [(50, None), (51, "..."), (52, "unknownword"), (None, "rare1 the"), (53, "of"), (53, "of"), (53, "alpha"), (54, "rare2 " * 30)]
    table = spark.createDataFrame([(*d, "clash", 1) for d in docs], DOCS).repartition(5)
    asked = spark.createDataFrame([(*i, "clash") for i in items], ITEMS).repartition(3)
    got = sorted((tuple(r) for r in ranked_search.rank(table, asked).collect()), key=str)
    assert got == slow_rank(docs, items)


def test_rank_of_nothing(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "alpha beta", "", 0)], DOCS)
    asked = spark.createDataFrame([(1, "alpha", "")], ITEMS)
    assert ranked_search.rank(none, asked).count() == 0
    assert ranked_search.rank(some, spark.createDataFrame([], ITEMS)).count() == 0
    assert [r["doc_id"] for r in ranked_search.rank(some, asked).collect()] == [1]
