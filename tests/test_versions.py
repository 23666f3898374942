"""Alignment of versions against a plain sequence matcher."""

import difflib
import random

from hustings.plans import versions


def slow_heaviest(at):
    """The weight of the heaviest chain, by trying all predecessors; runs must not overlap."""
    at, best = sorted(at), []
    for k, (old, new, n) in enumerate(at):
        best.append(n + max((best[j] for j in range(k) if at[j][0] + at[j][2] <= old and at[j][1] + at[j][2] <= new), default=0))
    return max(best, default=0)


def test_heaviest_chain():
    rng = random.Random(2)
    for _ in range(300):
        olds, news = rng.sample(range(60), 12), rng.sample(range(60), 12)
        at = [(3 * o, 3 * n, rng.randrange(1, 4)) for o, n in zip(olds, news, strict=True)]
        chain = versions.heaviest(at)
        assert all(a[0] + a[2] <= b[0] and a[1] + a[2] <= b[1] for a, b in zip(chain, chain[1:]))
        assert sum(r[2] for r in chain) == slow_heaviest(at)
    assert versions.heaviest([]) == []
    assert versions.heaviest([(0, 5, 3), (1, 6, 3), (2, 7, 3)]) == [(0, 5, 5)]


def plain(old, new):
    """The rules over the blocks of a plain sequence matcher."""
    def laid(chunks):
        words, starts = [], []
        for lead, text in chunks:
            starts.append(len(words))
            words += [lead, *text.split()]
        return words, [*starts, len(words)]

    (a, ends), (b, new_ends) = laid(old), laid(new)
    chunk_at = lambda pos: max(k for k in range(len(new)) if new_ends[k] <= pos)
    blocks = [x for x in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if x.size]
    out, last = [], None
    for k in range(len(old)):
        low, high = ends[k], ends[k + 1]
        pieces = [(max(low, x.a) - x.a + x.b, min(high, x.a + x.size) - x.a + x.b) for x in blocks if x.a < high and x.a + x.size > low]
        if not pieces:
            out.append((k, "missing", last))
            continue
        targets = [chunk_at(pieces[0][0])]
        whole = len(pieces) == 1 and pieces[0][1] - pieces[0][0] == high - low
        if not whole:
            targets = sorted({chunk_at(p) for x, y in pieces for p in (x, y - 1)})
        kind = "perfectmatch" if whole else "changes" if len(targets) == 1 else "multiplecover"
        out += [(k, kind, t) for t in targets]
        last = targets[-1]
    return out


def edited(rng, chunks, words):
    out = []
    for lead, text in chunks:
        own, fate = text.split(), rng.random()
        if fate < 0.1:
            continue
        if fate < 0.3 and own:
            own[rng.randrange(len(own))] = rng.choice(words)
        elif fate < 0.4:
            own.insert(rng.randrange(len(own) + 1), rng.choice(words))
        elif fate < 0.5 and len(own) > 9:
            out.append((lead, " ".join(own[: len(own) // 2])))
            own = own[len(own) // 2 :]
        out.append((lead, " ".join(own)))
        if fate > 0.9:
            out.append(("new", " ".join(rng.choices(words, k=8))))
    return out


def frames(spark, works):
    schema = "work string, seq long, gid string, lead string, text string"
    return (spark.createDataFrame([(w, i, f"{w}.{i}", lead, text) for w, pair in works.items() for i, (lead, text) in enumerate(pair[side])], schema).repartition(3) for side in (0, 1))


def test_redirects_equal_the_plain_matcher(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(4000)]
    works = {}
    for w in range(25):
        old = [(rng.choice(["HEADING", "speech"]) + str(i), " ".join(rng.choices(words, k=rng.choice([1, 5, 12, 30])))) for i in range(rng.randrange(1, 12))]
        works[f"work{w}"] = (old, edited(rng, old, words))
    works["same"] = ([("P", "a b c")], [("P", "a b c")])
    works["gone"] = ([("P", "a b c")], [])
    works["fresh"] = ([], [("P", "x")])
    works["long"] = ([("L", "la " * 3000), ("M", "<b>a</b> &amp; b")], [("L", "la " * 3000), ("M", "<b>a</b> &amp; b c")])
    old, new = frames(spark, works)
    got = {}
    for r in versions.redirects(old, new, ["work"]).collect():
        got.setdefault(r["work"], []).append((r["seq"], r["kind"], r["target"]))
    for name, (a, b) in works.items():
        want = [(0, "perfectmatch", 0), (1, "perfectmatch", 1)] if name == "long" else plain(a, b)
        assert sorted(got.get(name, []), key=str) == sorted(want, key=str), (name, a, b)


def test_old_versions_are_rewritten(spark):
    works = {"w": ([("P", "one two three"), ("P", "four five & six"), ("P", "gone away")], [("P", "one two three"), ("P", "four five & 6 six")])}
    old, new = frames(spark, works)
    from pyspark.sql import functions as F

    found = versions.redirects(old, new, ["work"])
    text = versions.rewritten(old, found, new, ["work"], F.lit("a.xml")).first()["document"]
    assert text == (
        '<document scrapeversion="a.xml" latest="no">\n<gidredirect oldgid="w.0" newgid="w.0" matchtype="perfectmatch"/>\n<gidredirect oldgid="w.1" newgid="w.1" matchtype="changes"/>\n'
        '<p id="w.1">four five &amp; six</p>\n<gidredirect oldgid="w.2" newgid="w.1" matchtype="missing"/>\n<p id="w.2">gone away</p>\n</document>\n'
    )


def test_versions_meet_in_one_shuffle(spark):
    old, new = frames(spark, {"w": ([("P", "one two three"), ("P", "four")], [("P", "four"), ("P", "one two and three")])})
    found = versions.redirects(old, new, ["work"])
    # The frames themselves are dealt out by one exchange each.
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(work") == 1
    assert sorted(tuple(r) for r in found.collect()) == [("w", 0, "missing", None), ("w", 1, "perfectmatch", 0)]
