"""Blocks of questions led to a new version, against all pairs compared."""

import random

from hustings.functions.text import common_words
from hustings.plans import questions

SCHEMA = "work string, seq long, gid string, numbers array<string>, text string"


def ratio(x, y):
    x, y = (x or "").split(), (y or "").split()
    return 2 * common_words(x, y) / (len(x) + len(y)) if x or y else 1.0


def slow(old, new, least=0.8):
    out = {}
    for work in {r[0] for r in old}:
        a, b = ([r for r in rows if r[0] == work] for rows in (old, new))
        left = []
        for _, _, gid, numbers, text in a:
            hits = [min(c[2] for c in b if n in (c[3] or [])) for n in numbers or [] if n != "0" and any(n in (c[3] or []) for c in b)]
            if hits:
                out[work, gid] = (hits[0], "divided" if len(set(hits)) > 1 else "number")
            else:
                left.append((gid, text))
        free = [(c[2], c[4]) for c in b if all(n == "0" for n in c[3] or [])]
        pairs = {(g, h): ratio(x, y) for g, x in left for h, y in free if ratio(x, y) > least}
        while pairs:
            best_old = {g: min((-s, h) for (k, h), s in pairs.items() if k == g)[1] for g, _ in pairs}
            best_new = {h: min((-s, g) for (g, k), s in pairs.items() if k == h)[1] for _, h in pairs}
            taken = [(g, h) for g, h in pairs if best_old[g] == h and best_new[h] == g]
            out |= {(work, g): (h, "likeness") for g, h in taken}
            pairs = {(g, h): s for (g, h), s in pairs.items() if all(g != x and h != y for x, y in taken)}
        text_of = {c[2]: (c[4] or "").split() for c in b}
        head = min(((c[1], c[2]) for c in b), default=(None, None))[1]
        for _, _, gid, _, text in a:
            target, by = out.get((work, gid), (None, "none"))
            kind = "removed" if target is None else "perfectmatch" if text_of[target] == (text or "").split() else "changes"
            out[work, gid] = (kind, head if target is None else target, by)
    return out


def test_redirects_equal_all_pairs(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    old, new = [], []
    for w in range(12):
        for i in range(rng.randrange(1, 9)):
            text = " ".join(rng.choices(words, k=rng.choice([0, 1, 4, 12, 25]))) or rng.choice([None, ""])
            numbers = rng.choice([[str(i)], [str(i), "77"], ["0"], [], None])
            old.append((f"work{w}", i, f"g{i}", numbers, text))
            own = (text or "").split()
            for _ in range(rng.choice([0, 1, 1, 1, 2])):
                changed = [x for x in own if rng.random() > 0.06] + rng.choices(words, k=rng.choice([0, 0, 1]))
                new.append((f"work{w}", len(new), f"n{len(new):04}", rng.choice([numbers, ["0"], None, [str(i)]]), " ".join(changed)))
    old.append(("empty", 0, "g0", ["1"], "a b"))
    found = questions.redirects(spark.createDataFrame(old, SCHEMA).repartition(3), spark.createDataFrame(new, SCHEMA).repartition(3))
    assert {(r["work"], r["gid"]): (r["kind"], r["target"], r["by"]) for r in found.collect()} == slow(old, new)


def test_parts_and_headings(spark):
    blocks = "work string, gid string, answers array<string>"
    led = spark.createDataFrame([("w", "a", "changes", "x", "number"), ("w", "b", "removed", "x", "none")], "work string, gid string, kind string, target string, by string")
    parts = questions.parts_led(spark.createDataFrame([("w", "a", ["a1", "a2"]), ("w", "b", ["b1"])], blocks), spark.createDataFrame([("w", "x", ["x1"])], blocks), led, "answers")
    assert sorted(tuple(r) for r in parts.collect()) == [("w", "a1", "changes", "x1"), ("w", "a2", "missing", None)]
    schema = "work string, seq int, gid string, text string"
    old = spark.createDataFrame([("w", 0, "h0", "Health"), ("w", 1, "h1", "Health "), ("w", 2, "h2", "Wales"), ("v", 0, "v0", None)], schema)
    new = spark.createDataFrame([("w", 0, "n0", "Defence"), ("w", 1, "n1", "Health")], schema)
    assert sorted(tuple(r) for r in questions.headings_led(old, new).collect()) == [("v", "v0", "removed", None), ("w", "h0", "perfectmatch", "n1"), ("w", "h1", "removed", "n0"), ("w", "h2", "removed", "n0")]
