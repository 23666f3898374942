"""Paragraphs of a new version led to those of the old one."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hustings.functions.text import common_words
from hustings.sources.shared import bounded_batches

#: Rows that a task hands on at a time.
HANDED_ON = 10_000


def _paragraphs(texts: list[str]) -> list[tuple[int, str]]:
    """(seq, paragraph) of a version, without empty ones."""
    return sorted((seq, para) for text in texts for seq, para in enumerate(text.split("\n")) if para)


def _nth(paras: list[tuple[int, str]]) -> Iterator[tuple[int, str, tuple[str, int]]]:
    """Paragraphs with the words and how many times they came."""
    seen: Counter[str] = Counter()
    for seq, para in paras:
        seen[para] += 1
        yield seq, para, (para, seen[para])


def _likeness(x: list[str], y: list[str], least: float) -> float:
    """Twice the length of the longest common sequence of words over the number of words; 0 where it can't be least, as
    the lengths or the words that both hold tell."""
    if not x and not y:
        return 1.0
    many = len(x) + len(y)
    if 2 * min(len(x), len(y)) / many < least or 2 * (Counter(x) & Counter(y)).total() / many < least:
        return 0.0
    return 2 * common_words(x, y) / many


def _led(old: list[tuple[int, str]], new: list[tuple[int, str]], least: float, reach: int) -> Iterator[tuple[int, str, int | None]]:
    """(seq, kind, target) of a later version's paragraphs; see redirects()."""
    places = {key: seq for seq, _, key in _nth(old)}
    rows = [(seq, para, places.get(key)) for seq, para, key in _nth(new)]
    used = {target for _, _, target in rows if target is not None}
    words = {seq: para.split() for seq, para in old if seq not in used}
    end = old[-1][0] if old else -1
    following: list[int | None] = [None] * len(rows)
    for k in range(len(rows) - 1, -1, -1):
        following[k] = rows[k][2] if rows[k][2] is not None else following[k + 1] if k + 1 < len(rows) else None
    before, claims = -1, {}
    told: list[tuple[int, int | None]] = []
    for (seq, para, target), after in zip(rows, following, strict=True):
        if target is not None:
            before = target
            yield seq, "perfectmatch", target
            continue
        after = max(end, before) + 1 if after is None else after
        own, best = para.split(), (0.0, 0)
        for place in {*range(min(before, after), max(before, after) + 1), *range(seq - reach, seq + reach + 1)} & words.keys():
            best = max(best, (_likeness(own, words[place], least), -place))
        at = -best[1] if best[0] >= least else None
        told.append((seq, at))
        if at is not None:
            claims[at] = min(claims.get(at, (0.0, seq)), (-best[0], seq))
    for seq, at in told:
        yield seq, "missing" if at is None else "changes" if claims[at][1] == seq else "multiplecover", at


def redirects(docs: DataFrame, work: str, version: str, text: str, least: float = 0.8, reach: int = 2) -> DataFrame:
    """(version, seq, kind, target): each paragraph of a later version and the paragraph of the work's first version
    that it comes from.

    kind is perfectmatch where the n-th paragraph of these words meets the n-th, changes where an unmatched paragraph in
    the same gap between perfect matches, or at most reach places off, is at least so similar, missing otherwise. An old
    paragraph is the change of one new one only, the most similar; others that come from it too are multiplecover.
    Texts are shuffled once, to bring a work's versions together; they are matched where they lie, by a lookup, and only what
    is left is compared, with what was left in its gap or stands near.
    """
    kind = docs.schema[version].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, parts = batch.column("versions").offsets.to_pylist(), batch.column("versions").values
            names, texts, rows, out = parts.field("version"), parts.field("text"), [], []

            def made() -> pa.RecordBatch:
                columns = list(zip(*out, strict=True)) or [(), (), ()]  # noqa: B023
                kinds = (pa.int32(), pa.string(), pa.int32())
                return pa.RecordBatch.from_arrays([names.take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [version, "seq", "kind", "target"])  # noqa: B023

            for start, end in zip(ends, ends[1:], strict=False):
                own = zip(range(start, end), names.slice(start, end - start).to_pylist(), texts.slice(start, end - start).to_pylist(), strict=True)
                held = [(same[0][0], _paragraphs([t for _, _, t in same])) for same in (list(g) for _, g in groupby(own, key=lambda x: x[1]))]
                for k, paras in held[1:]:
                    led = list(_led(held[0][1], paras, least, reach))
                    rows += [k] * len(led)
                    out += led
                    if len(out) >= HANDED_ON:
                        yield made()
                        rows, out = [], []
            yield made()

    bounded_batches(docs.sparkSession)
    every = docs.filter(F.col(work).isNotNull() & F.col(version).isNotNull()).groupBy(work).agg(F.sort_array(F.collect_list(F.struct(F.col(version).alias("version"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")))).alias("versions"))
    schema = T.StructType([T.StructField(version, kind), *T._parse_datatype_string("seq int, kind string, target int")])
    return every.select("versions").mapInArrow(run, schema)
