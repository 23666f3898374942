"""Licence scans: Aho-Corasick finds notice phrases and identifier tags, a shunting-yard parser reads the tags' expressions."""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm.common import alnum_words, of_text, spare

# Phrases that count as base places, and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Phrases that only add labels.
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "public domain": "public-domain",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
TAGS = ("spdx-license-identifier:", "spdx-licence-identifier:")
#: Strength of each operator; higher binds closer.
STRENGTH = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[ \t]*([A-Za-z0-9][A-Za-z0-9.+-]*|[()])")


def parse_expression(text: str, at: int = 0) -> list[str]:
    """The longest licence expression that begins at a place of text, in postfix order; [] if there is none.

    Operators are and, or, with (any case); with binds closest, or least, each from left to right; brackets group.
    Identifiers come back in lower case. Reading stops at the first token that can't follow; an operator without a
    second operand, or a bracket that isn't closed, is left out.
    """
    output: list[str] = []
    stack: list[str] = []
    best: tuple[int, list[str]] = (0, [])  # how much of output an expression has, and the operators that are open then
    brackets, operand_next = 0, True
    while m := TOKEN.match(text, at):
        token, low = m[1], m[1].lower()
        if operand_next:
            if token == "(":
                stack.append(token)
                brackets += 1
            elif token == ")" or low in STRENGTH:
                break
            else:
                output.append(low)
                operand_next = False
        elif token == ")":
            while stack and stack[-1] != "(":
                output.append(stack.pop())
            if not stack:
                break
            stack.pop()
            brackets -= 1
        elif low in STRENGTH:
            while stack and STRENGTH.get(stack[-1], 0) >= STRENGTH[low]:
                output.append(stack.pop())
            stack.append(low)
            operand_next = True
        else:
            break
        at = m.end()
        if not operand_next and not brackets:
            best = (len(output), stack[::-1])  # three operators at most, each stronger than the one below
    return output[: best[0]] + best[1]


def identifiers(postfix: list[str]) -> list[str]:
    """Licences that an expression names; what follows with is an exception, not a licence."""
    stack: list[list[str]] = []
    for token in postfix:
        if token in STRENGTH:
            right, left = stack.pop(), stack.pop()
            if token != "with":
                left += right
            stack.append(left)
        else:
            stack.append([token])
    return stack[0] if stack else []


def permits(postfix: list[str], accepted: set[str]) -> bool:
    """Whether the licences in accepted are enough: all of an and, one of an or, the licence before a with."""
    stack: list[bool] = []
    for token in postfix:
        if token in STRENGTH:
            right, left = stack.pop(), stack.pop()
            stack.append(left if token == "with" else left and right if token == "and" else left or right)
        else:
            stack.append(token in accepted)
    return bool(stack and stack[0])


class Scanner:
    def __init__(self):
        self.phrases, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        for group, base in ((MORE_PHRASES, False), (BASE_PHRASES, True)):
            for phrase, label in group.items():
                self.phrases.add_word(f" {phrase} ", (phrase.count(" ") + 1, label, base))
        for tag in TAGS:
            self.tags.add_word(tag, len(tag))
        self.phrases.make_automaton()
        self.tags.make_automaton()

    def scan(self, text: bytes) -> dict:
        words = alnum_words(text)
        line = f" {b' '.join(words).decode('latin-1')} "
        starts, base, labels = [], set(), set()
        spaces, counted = 0, 0  # blanks of the line up to a place that only moves on
        for end, (size, label, counts) in self.phrases.iter(line):
            labels.add(label)
            if counts:
                spaces, counted = spaces + line.count(" ", counted, end), end
                starts.append(spaces - size)
                base.add(label)
        expressions = []
        plain = text.decode("latin-1") if b":" in text else ""
        for end, _ in self.tags.iter(text.lower().decode("latin-1")) if plain else ():
            if postfix := parse_expression(plain, end + 1):  # tokens don't cross the end of a line
                expressions.append(" ".join(postfix))
                labels.update(identifiers(postfix))
        # Each place halves the doubt that is left, each parsed tag quarters it.
        doubt = 0.5 ** (len(starts) + 2 * len(expressions)) * (1.0 if starts or expressions or not labels else 0.75)
        return {"n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None), "base_labels": sorted(base), "labels": sorted(labels), "expressions": expressions, "score": 1.0 - doubt}


FOUND = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("expressions", pa.list_(pa.string())), ("score", pa.float64())])
FOUND_SQL = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, labels array<string>, expressions array<string>, score double"


def scan_licenses(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per row of docs: the named columns (all by default), and what a scan of the whole text finds.

    n_words: words of letters and digits; n_base: places where a base phrase's words stand one after the other;
    first_word, last_word: the least and greatest of their first words, counted from 0, else null; base_labels: their
    labels; labels: those, the labels of further phrases and the licences that SPDX tags name; expressions: the tags'
    expressions in postfix order; score: 0 where nothing was found, nearer to 1 the more was.

    Missing and empty texts hold nothing; time is in proportion to a text's length, however many places it has. Columns
    of docs named as the new ones give way to them. Repeated rows come back as often; an empty table gives an empty result.
    """
    back = [c for c in docs.columns if c not in FOUND.names] if columns is None else columns

    def setup():
        scanner = Scanner()

        def look(texts: list[bytes]) -> pa.Array:
            return pa.array([scanner.scan(t) for t in texts], pa.struct(list(FOUND)))

        return look

    inner = spare(docs.select(*back), "_found")
    found = docs.select(*back, of_text(docs.sparkSession, F.col("text"), FOUND_SQL, setup).alias(inner))
    return found.select(*back, *(F.col(inner)[n].alias(n) for n in FOUND.names))
