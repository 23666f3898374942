"""Repair of conversations: what is wrong with their turns, and the cheapest edits that give a lawful order of roles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hustings.llm.common import bounded_batches

#: Lawful orders of role initials, (s?(ua)+)?, as an automaton: start, after s, after u, after a. The first and the last
#: may end a conversation.
STEPS: tuple[dict[str, int], ...] = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
#: What an edit may make of a turn, by initial.
ROLES = {"u": "user", "a": "assistant"}
LAWFUL = frozenset(("su", "ua", "au"))
#: Octal digits of the edits, in ASCII order of their letters; 0 pads the end.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = str.maketrans("1234", "DIKR")
#: White space, for Java patterns.
BLANK = r"\x20\x09-\x0D"
#: Rows that a task hands on at a time.
ROWS = 1024


@dataclass(frozen=True)
class Costs:
    """What edits cost; insert must be above 0. truncated is added for each truncated turn that isn't deleted."""

    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def cheapest(turns: list[tuple[str, bool, bool]], costs: Costs = Costs()) -> tuple[int, str]:
    """The least cost and the letters of its edits, the ASCII-least of those that cost as little.

    turns are (role initial, must be deleted, is truncated). A path through the graph of (turn, state of the automaton) has
    one integer as its weight: its cost, followed by a fixed number of octal digits, its letters from the first on, zeros
    at the end. Putting an edit before a path adds its cost, moves the digits by one and puts its own in front, which keeps
    the order of integers; so the least integer of each node, from the last turn to the first, decides cost and letters.
    """
    n = len(turns)
    width = 3 * (n + (costs.delete * n + 2 * costs.insert) // costs.insert + 3)
    low = (1 << width) - 1

    def before(cost: int, letter: str, path: int) -> int:
        return (((path >> width) + cost) << width) | (DIGITS[letter] << (width - 3)) | ((path & low) >> 3)

    def inserted(own: list[int | None]) -> list[int | None]:
        """Each state's least weight if turns may be inserted first: two at most, a third would come back to a state."""
        out = list(own)
        for state in range(len(STEPS)):
            there, held = state, ()
            for _ in range(2):
                there = STEPS[there]["a" if "a" in STEPS[there] else "u"]
                held += (costs.insert,)
                if (path := own[there]) is not None:
                    for cost in held:
                        path = before(cost, "I", path)
                    out[state] = path if out[state] is None else min(out[state], path)
        return out

    least = inserted([0 if s in ENDS else None for s in range(len(STEPS))])
    for initial, must, cut in reversed(turns):
        extra, own = costs.truncated if cut else 0, []
        for state, steps in enumerate(STEPS):
            options = [] if least[state] is None else [before(costs.delete, "D", least[state])]
            if not must:
                if initial in steps and (path := least[steps[initial]]) is not None:
                    options.append(before(costs.keep + extra, "K", path))
                options += [before(costs.rerole + extra, "R", least[steps[r]]) for r in ROLES if r in steps and least[steps[r]] is not None]
            own.append(min(options, default=None))
        least = inserted(own)
    return least[0] >> width, oct(least[0] & low)[2:].zfill(width // 3).rstrip("0").translate(LETTERS)


def _ordered(turns: DataFrame) -> tuple[DataFrame, list[Column]]:
    """turns with a tag, a digest of the text, and their order: by turn, the missing first, ties by role and tag."""
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")
    ).withColumn("tag", F.md5("text"))
    return rows, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("tag")]


def plan(turns: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): one row for each conversation of turns (conv_id,
    turn, role, text; others are left out).

    Turns go by their number, missing ones first, ties by role and then by the text's MD5; a missing role or text is one
    space; a missing conv_id is a conversation like any other. Each turn counts for its first fault: blank (nothing but
    white space), duplicate (role and text seen earlier), truncated (does not end with [.!?]). gaps counts turn numbers
    that are missing between the least and the greatest, illegal adjacent roles that no lawful order has. audit has one
    letter for each edit: Keep, Rerole, Delete, Insert. Repeated rows are duplicates, an empty table gives an empty result.

    Only a digest of each text is shuffled and sorted here. A conversation is read in one task, turn by turn, as its order
    demands; what is held is some bytes for each of its turns. Time grows with the square of its length divided by that of
    a machine word: 10,000 turns take about a second.
    """
    rows, order = _ordered(turns)
    last = rf"[.!?][{BLANK}]*\z"
    light = rows.select("conv_id", "turn", "role", "tag", (~F.col("text").rlike(f"[^{BLANK}]")).alias("blank"), (~F.col("text").rlike(last)).alias("cut"))
    key = T.StructType([turns.schema["conv_id"]])
    schema = T.StructType([*key, *(T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), T.StructField("audit", T.StringType())])
    names = ["conv_id", "turn", "role", "tag", "blank", "cut"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True))
        out, kind = [], pa.schema([pa.field("conv_id", key_type[0])] + [(f.name, pa.int64()) for f in schema.fields[1:-1]] + [("audit", pa.string())])
        for conv, own in groupby(stream, itemgetter(0)):
            seen, steps, faults, illegal = set(), [], [0, 0, 0], 0
            first = latest = before = None
            numbers = 0
            for _, turn, role, tag, blank, cut in own:
                if turn is not None:
                    numbers += turn != latest
                    first, latest = turn if first is None else first, turn
                again = (role, tag) in seen
                seen.add((role, tag))
                fault = 0 if blank else 1 if again else 2 if cut else None
                if fault is not None:
                    faults[fault] += 1
                illegal += before is not None and before + role[:1] not in LAWFUL
                before = role[:1]
                steps.append((before, fault in (0, 1), fault == 2))
            cost, audit = cheapest(steps, costs)
            out.append((conv, latest - first + 1 - numbers if numbers else 0, *faults, illegal, cost, audit))
            if len(out) >= ROWS:
                yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r, strict=True)) for r in out], kind)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r, strict=True)) for r in out], kind)

    key_type = _arrow(key)
    return light.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(judge, schema)


def _arrow(schema: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema).types


def repaired(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, seq, role, text, edit): the turns that stay or are put in, numbered from 0, as plan()'s audits say.

    A conversation's audit comes before its turns, which are read one by one; no conversation is held whole. Rows of one
    conversation come in order and in one partition.
    """
    rows, order = _ordered(turns)
    every = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(plans.select("conv_id", "audit"), allowMissingColumns=True)
    schema = T.StructType([turns.schema["conv_id"], T.StructField("seq", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("role", "text", "edit"))])
    key_type = _arrow(T.StructType([turns.schema["conv_id"]]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("conv_id", key_type[0]), ("seq", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
        out, audit, at, state, seq, conv = [], "", 0, 0, 0, None

        def put(initial: str, role: str, text: str, edit: str) -> None:
            nonlocal state, seq
            out.append({"conv_id": conv, "seq": seq, "role": role, "text": text, "edit": edit})
            state, seq = STEPS[state][initial], seq + 1

        def put_in() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                at += 1
                initial = "a" if "a" in STEPS[state] else "u"
                put(initial, ROLES[initial], "", "I")

        for batch in batches:
            for key, role, text, letters in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit")), strict=True):
                if letters is not None:
                    conv, audit, at, state, seq = key, letters, 0, 0, 0
                    put_in()
                    continue
                edit, at = audit[at], at + 1
                if edit == "K":
                    put(role[:1], role, text, "K")
                elif edit == "R":
                    initial = "a" if "a" in STEPS[state] else "u"
                    put(initial, ROLES[initial], text, "R")
                put_in()
            if out:
                yield pa.RecordBatch.from_pylist(out, kind)
                out.clear()

    bounded_batches(turns.sparkSession)
    first = F.col("audit").isNull()
    return every.repartition("conv_id").sortWithinPartitions("conv_id", first, *order).select("conv_id", "role", "text", "audit").mapInArrow(apply, schema)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of repaired()'s turns as they come: the SHA-256 of `role:text`, joined by new lines."""
    schema = T.StructType([turns.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    key_type = _arrow(T.StructType([turns.schema["conv_id"]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("conv_id", key_type[0]), ("repaired_sha256", pa.string())])
        conv, state, out = None, None, []
        for batch in batches:
            for key, seq, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seq", "role", "text")), strict=True):
                if seq == 0:
                    if state is not None:
                        out.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
                    conv, state = key, hashlib.sha256()
                state.update(f"{chr(10) if seq else ''}{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, kind)
                out = []
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], kind)

    return turns.mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): conversations with faults put in by the CRC-32 of `conv_id:turn`, divided by 20: what
    leaves 0 is dropped, 1 emptied, 2 loses its [.!?], 3 is repeated, 4 becomes the user's. Missing values count as one
    space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    copies = F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)
    rows = conversations.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)))
    return rows.select("conv_id", "turn", "role", "text")


def report(turns: DataFrame, conv_ids: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """plan() and digests() of turns for every conv_id of conv_ids, zeros and empty texts where there is no turn."""
    from hustings.llm.common import written

    plans = written(plan(turns, costs))
    sums = digests(repaired(turns, plans))
    every = conv_ids.select("conv_id").distinct()
    met = every.join(plans.withColumnRenamed("conv_id", "_p"), F.col("conv_id").eqNullSafe(F.col("_p")), "left").join(sums.withColumnRenamed("conv_id", "_s"), F.col("conv_id").eqNullSafe(F.col("_s")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return met.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
