"""Versions of a document aligned word by word: where each chunk of the old version went in the new one.

Spark brings the two versions of each work together. Chunks that both hold once meet; what is left is cut into gaps between
them. Within a gap, runs of words that each side holds once meet, long runs first; the heaviest chain of runs that rises on
both sides is kept and cuts the gap into smaller ones. Runs are looked up, so no words are compared all with all.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hustings.functions.markup import escape
from hustings.functions.text import markup_tokens
from hustings.sources.shared import bounded_batches

#: Words of the runs that meet, one round for each; in the last rounds a run's n-th occurrence meets the n-th.
ROUNDS = ((6, False), (2, False), (6, True), (1, True))
#: Rows that a task hands on at a time.
HANDED_ON = 10_000


def chunks(docs: DataFrame, by: list[str], text: str) -> DataFrame:
    """(by, seq, gid, lead, text): paragraphs of docs, numbered from 0 with blank lines left out; gid is their number,
    and they have no lead."""
    rows = docs.select(*by, F.posexplode(F.filter(F.split(text, "\n"), lambda p: F.trim(p) != "")).alias("seq", "text"))
    return rows.select(*by, "seq", F.col("seq").cast("string").alias("gid"), F.lit(None).cast("string").alias("lead"), "text")


def heaviest(at: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of runs (old start, new start, length) the chain that rises on both sides and holds most words; runs that overlap
    their predecessor lose their beginning. Time grows with n log n."""
    joined: list[list[int]] = []
    for old, new, length in sorted(at):
        last = joined[-1] if joined else None
        if last and old - new == last[0] - last[1] and old <= last[0] + last[2]:
            last[2] = max(last[2], old + length - last[0])
        else:
            joined.append([old, new, length])
    # The frontier: new starts, rising, of chains whose weights rise with them; before[k] is the run before run k.
    starts: list[int] = []
    weights: list[int] = []
    ends: list[int] = []
    before = []
    for k, (_, new, length) in enumerate(joined):
        place = bisect_left(starts, new)
        weight = length + (weights[place - 1] if place else 0)
        before.append(ends[place - 1] if place else -1)
        if place < len(starts) and weights[place] >= weight and starts[place] == new:
            continue
        drop = place
        while drop < len(starts) and weights[drop] <= weight:
            drop += 1
        starts[place:drop], weights[place:drop], ends[place:drop] = [new], [weight], [k]
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(joined[k])
        k = before[k]
    out, old_end, new_end = [], -1, -1
    for old, new, length in reversed(chain):
        skip = max(0, old_end - old, new_end - new)
        if length > skip:
            out.append((old + skip, new + skip, length - skip))
            old_end, new_end = old + length, new + length
    return out


def _anchors(a: list[int], b: list[int], gaps: list[tuple[int, int, int, int]], length: int, nth: bool) -> Iterator[tuple[int, int, int]]:
    """(old start, new start, length) of runs of words that both sides of a gap hold once, or with nth of a run's n-th
    occurrence on both sides."""
    for a0, a1, b0, b1 in gaps:
        sides: list[dict[tuple, list[int]]] = []
        for words, start, end in ((a, a0, a1), (b, b0, b1)):
            places: dict[tuple, list[int]] = {}
            for at, run in enumerate(zip(*(words[start + k : end - length + 1 + k] for k in range(length)), strict=True) if end - start >= length else (), start):
                places.setdefault(run, []).append(at)
            sides.append(places)
        for run, olds in sides[0].items():
            news = sides[1].get(run)
            if news and (nth or len(olds) == len(news) == 1):
                yield from ((o, n, length) for o, n in zip(olds, news, strict=False))


def _aligned(a: list[int], b: list[int], gaps: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Positions of words that correspond within gaps (old start and end, new start and end), rising on both sides."""
    found: list[tuple[int, int]] = []
    for length, nth in ROUNDS:
        met = [(o + k, n + k) for o, n, many in heaviest(list(_anchors(a, b, gaps, length, nth))) for k in range(many)]
        found += met
        smaller, at = [], 0
        for a0, a1, b0, b1 in gaps:
            while at < len(met) and met[at][0] < a1:
                o, n = met[at]
                smaller.append((a0, o, b0, n))
                a0, b0, at = o + 1, n + 1, at + 1
            smaller.append((a0, a1, b0, b1))
        gaps = [g for g in smaller if g[0] < g[1] and g[2] < g[3]]
    return sorted(found)


def _led(old: list[tuple[int, list[int]]], new: list[tuple[int, list[int]]]) -> Iterator[tuple[int, str, int | None]]:
    """(seq, kind, target) for each chunk of a work's old version, both versions being (seq, words) in order."""
    digests: list[dict[tuple, list[int]]] = []
    for chunks_ in (old, new):
        places: dict[tuple, list[int]] = {}
        for seq, words in chunks_:
            places.setdefault(tuple(words), []).append(seq)
        digests.append(places)
    once = [(own[0], digests[1][words][0], 1) for words, own in digests[0].items() if len(own) == 1 and len(digests[1].get(words, ())) == 1]
    same = {o + k: n + k for o, n, many in heaviest(once) for k in range(many)}
    flat, starts, bounds = [], [], []
    for chunks_, taken in ((old, same.keys()), (new, set(same.values()))):
        words, begun, cuts = [], [], [0]
        for seq, own in chunks_:
            begun.append(len(words))
            if seq in taken:
                cuts += [len(words), len(words) + len(own)]
            words += own
        flat.append(words)
        starts.append(begun)
        bounds.append([*cuts, len(words)])
    gaps = [(a0, a1, b0, b1) for a0, a1, b0, b1 in zip(bounds[0][::2], bounds[0][1::2], bounds[1][::2], bounds[1][1::2], strict=True) if a0 < a1 and b0 < b1]
    met, at, held = _aligned(*flat, gaps), 0, None
    for (seq, own), start in zip(old, starts[0], strict=True):
        # A piece: words that correspond to words one after another, in old and new.
        pieces: list[list[int]] = []
        while at < len(met) and met[at][0] < start + len(own):
            o, n = met[at]
            if pieces and pieces[-1][:2] == [o - 1, n - 1]:
                pieces[-1][:2] = o, n
            else:
                pieces.append([o, n, n])
            at += 1
        ends = [(new[bisect_right(starts[1], first) - 1][0], new[bisect_right(starts[1], last) - 1][0]) for _, last, first in pieces]
        if seq in same:
            kind, targets = "perfectmatch", [same[seq]]
        elif len(pieces) == 1 and pieces[0][1] - pieces[0][2] + 1 == len(own):
            kind, targets = "perfectmatch", [ends[0][0]]
        else:
            targets = sorted({x for pair in ends for x in pair})
            kind = "missing" if not targets else "multiplecover" if len(targets) > 1 else "changes"
        yield from ((seq, kind, t) for t in targets or [held])
        held = max(targets) if targets else held


def redirects(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """(by, seq, kind, target): for each chunk of old the chunks of new (both: by, seq, lead, text) that it went to.

    kind is perfectmatch where all its words stand in new in one piece (target holds the first), changes where some do or in
    several pieces, all in one chunk, multiplecover where they are in several, one row for each, the first and the last that
    a piece touches; missing where none is, with the target of the chunk before it, null if there is none. Words are those of
    the text, tags and entities, after the chunk's lead (its kind and speaker, say) if it has
    one. Missing texts count as empty. Works
    that new lacks are missing whole; works that only new has give no row. No work is compared with another.

    Texts are shuffled once, to bring a work's versions together; its words, as hashes, are aligned where they lie, in time
    that grows with its length. Of words that repeat in a gap the first pairs with the first, and so on.
    """
    whole = lambda n: F.collect_list(F.when(F.col("_side") == n, F.struct("seq", "lead", "text")))
    side = lambda rows, n: rows.select(*by, F.lit(n).alias("_side"), F.col("seq").cast("long").alias("seq"), F.col("lead").cast("string").alias("lead"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    both = side(old, 0).unionByName(side(new, 1)).groupBy(*by).agg(whole(0).alias("_old"), whole(1).alias("_new")).filter(F.size("_old") > 0)
    hashes = lambda c: F.transform(F.concat(F.array_compact(F.array(c["lead"])), markup_tokens(c["text"])), lambda w: F.xxhash64(w))
    worded = lambda rows: F.transform(F.sort_array(rows), lambda c: F.struct(c["seq"].alias("seq"), hashes(c).alias("words")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            versions_ = []
            for name in ("_old", "_new"):
                ends, parts = batch.column(name).offsets.to_pylist(), batch.column(name).values
                seqs, cuts, words = parts.field("seq").to_pylist(), parts.field("words").offsets.to_pylist(), parts.field("words").values.to_numpy(zero_copy_only=False)
                versions_.append((ends, seqs, cuts, words))
            rows, out = [], []

            def made() -> pa.RecordBatch:
                columns = list(zip(*out, strict=True)) or [(), (), ()]  # noqa: B023
                kinds = (pa.int64(), pa.string(), pa.int64())
                return pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(rows, pa.int64())) for c in by), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [*by, "seq", "kind", "target"])  # noqa: B023

            for row in range(batch.num_rows):
                own = [[(seqs[k], words[cuts[k] : cuts[k + 1]].tolist()) for k in range(ends[row], ends[row + 1])] for ends, seqs, cuts, words in versions_]
                led = list(_led(*own))
                rows += [row] * len(led)
                out += led
                if len(out) >= HANDED_ON:
                    yield made()
                    rows, out = [], []
            yield made()

    bounded_batches(old.sparkSession)
    schema = T.StructType([*(old.schema[c] for c in by), *T._parse_datatype_string("seq long, kind string, target long")])
    return both.select(*by, worded(F.col("_old")).alias("_old"), worded(F.col("_new")).alias("_new")).mapInArrow(run, schema)


def rewritten(old: DataFrame, redirected: DataFrame, new: DataFrame, by: list[str], source: Column, root: str = "document", element: str = "p") -> DataFrame:
    """(by, document): the old version as it is kept after a new one came: a line for each redirect from an old gid to a
    new one, and the old chunk itself where it is no perfectmatch. source tells where the old version came from.

    Texts join last, once a chunk's redirects are one row, and are shuffled twice."""
    named = redirected.join(new.select(*by, F.col("seq").cast("long").alias("target"), F.col("gid").alias("newgid")), [*by, "target"], "left")
    led = named.groupBy(*by, "seq").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("target", F.lit(-1)).alias("target"), "newgid"))).alias("all"), F.first("kind").alias("kind"))
    lines = led.join(old.select(*by, F.col("seq").cast("long").alias("seq"), "gid", "text"), [*by, "seq"])
    redirect = lambda x: F.coalesce(F.concat(F.lit('<gidredirect oldgid="'), escape(F.col("gid")), F.lit('" newgid="'), escape(x["newgid"]), F.lit('" matchtype="'), "kind", F.lit('"/>\n')), F.lit(""))
    kept = F.concat(F.lit(f'<{element} id="'), escape(F.col("gid")), F.lit('">'), escape(F.coalesce("text", F.lit(""))), F.lit(f"</{element}>\n"))
    text = F.concat(F.array_join(F.transform("all", redirect), ""), F.when(F.col("kind") == "perfectmatch", "").otherwise(kept))
    body = lines.select(*by, "seq", text.alias("part")).groupBy(*by).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "part"))), lambda x: x["part"]), "").alias("body"))
    return body.select(*by, F.concat(F.lit(f'<{root} scrapeversion="'), escape(source), F.lit('" latest="no">\n'), "body", F.lit(f"</{root}>\n")).alias("document"))
