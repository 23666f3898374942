"""Speakers of a sitting, resolved one after another: who spoke before and who held which office decide what names leave open."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Offices that are also called by a shorter name, and those that pass to whoever is named with them last.
LONGER = {"The Advocate-General": "The Advocate-General for Scotland"} | {o: f"{o} of Ways and Means" for o in ("The First Deputy Chairman", "The Second Deputy Chairman", "The Chairman")}
PASSED_ON = frozenset(("The Temporary Chair", "Madam Deputy Speaker"))
#: Rows that a task hands on at a time.
HANDED_ON = 5_000


class Sitting:
    """What a sitting has shown so far: its speakers in order, and whom offices were named with."""

    def __init__(self) -> None:
        self.count, self.latest = 0, None
        self.earlier: dict[str, int] = {}
        self.offices: dict[str, set[str]] = {}

    def spoke(self, person: str | None) -> None:
        if self.latest is not None:
            self.earlier[self.latest] = self.count
        self.count, self.latest = self.count + 1, person

    def speaker(self, name: str, bracket: str | None, named: set[str], bracketed: set[str], hall: bool) -> tuple[str | None, str]:
        """The speaker and how they were found. Several candidates are settled by who of them spoke latest, the last speaker
        left out (but in the second hall taken if there is no other)."""
        found, source = set(named), "name"
        if bracketed:
            found = set(bracketed) if not found or (len(bracketed) == 1 and "speaker" in name.lower()) else found & bracketed
        if len(found) > 1:
            if known := [p for p in found if p in self.earlier]:
                found, source = {max(known, key=self.earlier.__getitem__)}, "history"
            elif hall and self.latest in found:
                found, source = {self.latest}, "history"
        if not found and (held := self.offices.get(LONGER.get(name, name))):
            found, source = set(held), "office"
        if bracketed:
            if name in PASSED_ON:
                self.offices[name] = set(found)
            else:
                self.offices.setdefault(name, set()).update(found)
        person = next(iter(found)) if len(found) == 1 else None
        self.spoke(person)
        return person, source if person is not None else "multiple" if found else "none"


def speakers(rows: DataFrame) -> DataFrame:
    """(sitting, seq, person, source): who speaks in each of rows (sitting, seq, name, bracket, named, bracketed, hall).

    named are the people that the name may mean on that day, bracketed those that the text in brackets after it may mean
    (of an office, who holds it); hall marks sittings of the second hall. source is name, history, office, multiple or none.
    A sitting's rows go by seq through one task, which keeps a number for each speaker and the offices named; missing lists
    are empty, rows without a sitting are one.
    """
    keep = [rows.schema["sitting"], rows.schema["seq"]]
    schema = T.StructType([*keep, T.StructField("person", T.StringType()), T.StructField("source", T.StringType())])
    columns = ["sitting", "seq", "name", "bracket", "named", "bracketed", "hall"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stream = (r for batch in batches for r in zip(*(batch[c].tolist() for c in columns), strict=True))
        out = []
        for _, own in groupby(stream, itemgetter(0)):
            state = Sitting()
            for sitting, seq, name, bracket, named, bracketed, hall in own:
                out.append((sitting, seq, *state.speaker(name, bracket, set(named), set(bracketed), bool(hall))))
                if len(out) >= HANDED_ON:
                    yield pd.DataFrame(out, columns=schema.names)
                    out = []
        if out:
            yield pd.DataFrame(out, columns=schema.names)

    lists = {c: F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("named", "bracketed")}
    plain = rows.select("sitting", "seq", F.coalesce("name", F.lit("")).alias("name"), "bracket", *(v.alias(c) for c, v in lists.items()), F.coalesce("hall", F.lit(False)).alias("hall"))
    return plain.repartition("sitting").sortWithinPartitions("sitting", "seq").mapInPandas(run, schema)
