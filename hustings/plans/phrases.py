"""Texts cut into typed tokens by ordered recognisers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A private-use character that marks cuts; it is taken out of texts first.
CUT = ""
#: Recognisers in order: what an earlier one has taken, a later one does not see.
RECOGNISERS = (
    ("date", r"\b\d{1,2} (?:January|February|March|April|May|June|July|August|September|October|November|December)(?: \d{4})?\b"),
    ("time", r"\b\d{1,2}[.:]\d{2}(?: ?[ap]\.?m\b\.?|\b)"),
    ("money", r"£\d[\d,]*(?:\.\d+)?(?: (?:million|billion))?"),
    ("reference", r"\b(?:Cm|HC|HL|Official Report)[,.]? ?\d[\d/.-]*"),
    ("email", r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"),
    ("honorific", r"\b(?:hon\.|right hon\.|noble|learned) (?:Friend|Member|Gentleman|Lady|Lord|Baroness)\b"),
    ("number", r"\b\d[\d,]*(?:\.\d+)?%?"),
)


def _cutter(kind: str, pattern: str):
    """A function of a piece: an unclaimed one is cut at the pattern's matches, a claimed one stays whole."""

    def cut(s):
        parts = F.split(F.regexp_replace(s["token"], pattern, f"{CUT}$0{CUT}"), CUT)
        named = F.transform(parts, lambda x, i: F.struct(F.when(i % 2 == 1, kind).otherwise("text").alias("kind"), x.alias("token")))
        return F.when(s["kind"] == "text", named).otherwise(F.array(s))

    return cut


def tokenize(docs: DataFrame, key: str, text: str, recognisers=RECOGNISERS) -> DataFrame:
    """(key, seq, kind, token) of all texts; tokens joined in order give the text again.

    Each recogniser cuts the pieces that none before it has claimed. Texts that are null or empty have no tokens.
    """
    whole = F.struct(F.lit("text").alias("kind"), F.replace(F.col(text), F.lit(CUT)).alias("token"))
    pieces = F.array(whole)
    for kind, pattern in recognisers:
        pieces = F.flatten(F.transform(pieces, _cutter(kind, pattern)))
    made = docs.filter(F.col(text).isNotNull()).select(key, F.posexplode(F.filter(pieces, lambda s: s["token"] != "")).alias("seq", "_t"))
    return made.select(key, "seq", "_t.kind", "_t.token")
