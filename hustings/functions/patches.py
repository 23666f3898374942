"""Patches, unified differences, applied to texts before they are parsed."""

from __future__ import annotations

import re
from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.sources.shared import bounded_batches

HUNK = re.compile(r"^@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@")
RESULT = "text string, applied int, rejected array<int>"


def hunks(patch: str) -> list[tuple[int, list[str], int, list[str]]]:
    """(old start, old lines, new start, new lines) of each hunk; starts count from 0. Lines outside of hunks are skipped."""
    out: list[tuple[int, list[str], int, list[str]]] = []
    left = right = 0
    for line in patch.split("\n"):
        if m := HUNK.match(line):
            left, right = int(m[2] or 1), int(m[4] or 1)
            # A side without lines names the line before it.
            out.append((int(m[1]) - (left > 0), [], int(m[3]) - (right > 0), []))
        elif out and (left > 0 or right > 0) and line[:1] in ("", " ", "-", "+"):
            # An empty line stands for an empty line of context.
            sign, rest = line[:1] or " ", line[1:]
            if sign in " -" and left > 0:
                out[-1][1].append(rest)
                left -= 1
            if sign in " +" and right > 0:
                out[-1][3].append(rest)
                right -= 1
    return out


def applied(text: str, patch: str, reverse: bool = False) -> tuple[str, int, list[int]]:
    """The patched text, how many hunks were applied and the numbers, from 0, of those that were not.

    A hunk goes where its old lines stand: where it says, moved as far as the hunk before it was, or else the nearest place
    after that hunk (of two as near the later one). One whose lines are nowhere is rejected. Places are looked up by the
    line of a hunk that the text has least often.
    """
    lines, places = text.split("\n"), {}
    for n, line in enumerate(lines):
        places.setdefault(line, []).append(n)
    out, end, moved, rejected, count = [], 0, 0, [], 0
    for k, (old_start, old, new_start, new) in enumerate(hunks(patch)):
        if reverse:
            old_start, old, new_start, new = new_start, new, old_start, old
        wanted = old_start + moved
        if old:
            rare = min(range(len(old)), key=lambda i: len(places.get(old[i], ())))
            starts = [p - rare for p in places.get(old[rare], ()) if p - rare >= end and lines[p - rare : p - rare + len(old)] == old]
        else:
            starts = [min(max(wanted, end), len(lines))]
        if not starts:
            rejected.append(k)
            continue
        near = bisect_left(starts, wanted)
        at = min(starts[max(0, near - 1) : near + 1], key=lambda p: (abs(p - wanted), -p))
        out += [*lines[end:at], *new]
        end, moved, count = at + len(old), at - old_start, count + 1
    return "\n".join(out + lines[end:]), count, rejected


def patched(text: Column, patch: Column, reverse: bool = False) -> Column:
    """struct<text, applied, rejected> of texts and their patches, as applied() has it; a missing patch changes nothing, a
    missing text stays so and rejects every hunk. Texts go to Python in batches of bounded size."""

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series, diffs: pd.Series) -> pd.DataFrame:
        rows = [(t, 0, []) if not d else (None, 0, list(range(len(hunks(d))))) if t is None else applied(t, d, reverse) for t, d in zip(texts, diffs, strict=True)]
        return pd.DataFrame(rows, columns=["text", "applied", "rejected"])

    bounded_batches(SparkSession.active())
    return run(text, patch)


def with_patches(docs: DataFrame, patches: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """docs with the patches (key, name, patch) that name them applied to the column text, in order of their names; and the
    rejects (key, name, hunk). A patch sees what those before it made of the text."""
    named = patches.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("name", "patch"))).alias("_patches"))
    joined = docs.join(named, key, "left")
    most = named.agg(F.max(F.size("_patches"))).first()[0] or 0
    joined = joined.withColumn("_rejects", F.array().cast("array<struct<name: string, hunk: int>>"))
    for n in range(most):
        own = F.get("_patches", F.lit(n))
        joined = joined.withColumn("_done", patched(F.col(text), own["patch"])).withColumn(text, F.col("_done.text"))
        told = F.transform("_done.rejected", lambda h: F.struct(own["name"].alias("name"), h.alias("hunk")))  # noqa: B023
        joined = joined.withColumn("_rejects", F.concat("_rejects", F.coalesce(told, F.array().cast("array<struct<name: string, hunk: int>>"))))
    joined = joined.drop("_done") if most else joined
    return joined.drop("_patches", "_rejects"), joined.select(key, F.inline("_rejects"))
