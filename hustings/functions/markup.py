"""HTML and XML text: entities, tags, titles, links."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_of(s: Column) -> Column:
    """Without tags; line breaks become blanks."""
    return F.translate(F.regexp_replace(s, "<[^>]*>", ""), "\r\n", "  ")


def clean(s: Column) -> Column:
    """Without comments, scripts, styles and the anchors' tags; white space collapsed."""
    for pattern in (r"(?s)<!--.*?-->", r"(?is)<(script|style)\b.*?</\1>", r"(?i)</?a\b[^>]*>", r"\r"):
        s = F.regexp_replace(s, pattern, "")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def escape(s: Column) -> Column:
    """Ampersands, angle brackets and quotes as entities; entities of ampersands stay."""
    s = F.regexp_replace(s, "&(?!amp;)", "&amp;")
    for char, entity in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        s = F.replace(s, F.lit(char), F.lit(entity))
    return s


def unescape_basic(s: Column) -> Column:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        s = F.replace(s, F.lit(entity), F.lit(char))
    return s


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    """All named and numbered entities as characters."""
    return s.map(lambda x: None if x is None else html.unescape(x))


def unknown_entities(s: Column, known: tuple[str, ...] = ("amp", "lt", "gt", "quot", "nbsp", "pound", "eacute")) -> Column:
    return F.array_distinct(F.filter(F.regexp_extract_all(s, F.lit(r"&(\w+);"), F.lit(1)), lambda e: ~e.isin(*known)))


def escape_unknown_tags(s: Column, known: tuple[str, ...]) -> Column:
    """Tags that aren't known as text: their brackets become entities."""
    return F.regexp_replace(s, rf"(?i)<(/?(?!(?:{'|'.join(known)})\b)[a-z][^>]*)>", "&lt;$1&gt;")


def straighten_inline(s: Column) -> Column:
    """Bold, italic and small text reduced to b and i; empty ones go."""
    s = F.regexp_replace(F.regexp_replace(s, r"(?i)<(/?)strong\b[^>]*>", "<$1b>"), r"(?i)<(/?)em\b[^>]*>", "<$1i>")
    return F.regexp_replace(F.regexp_replace(s, r"(?i)</?(small|font|span)\b[^>]*>", ""), r"<([bi])>\s*</\1>", "")


def well_formed(s: Column) -> Column:
    """Whether a text is one well-formed XML element, by Spark's own XML parser; null is not."""
    read = F.from_xml(s, "_none string, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    return s.isNotNull() & read["_broken"].isNull()


def title(s: Column) -> Column:
    return F.trim(F.regexp_extract(s, r"(?is)<title[^>]*>(.*?)</title>", 1))


def links(s: Column) -> Column:
    """Addresses of all links, in order."""
    return F.regexp_extract_all(s, F.lit(r'href="([^"]*)"'), F.lit(1))


def paragraphs(s: Column) -> Column:
    """array<struct<kind, indent, text>>: tables whole, list items indented, other blocks as paragraphs."""
    marked = F.regexp_replace(s, r"(?is)(<table\b.*?</table>)", "\u0001$1\u0001")
    blocks = F.flatten(F.transform(F.split(marked, "\u0001"), lambda b: F.when(F.lower(F.substring(b, 1, 6)) == "<table", F.array(b)).otherwise(F.split(b, r"(?i)(?=<(?:p|li|h[1-6])\b)"))))
    kind = lambda b: F.when(b.rlike(r"(?i)^<table\b"), "table").when(b.rlike(r"(?i)^<li\b"), "item").when(b.rlike(r"(?i)^<h[1-6]\b"), "heading").otherwise("para")
    made = F.transform(blocks, lambda b: F.struct(kind(b).alias("kind"), F.when(b.rlike(r"(?i)^<li\b"), 1).otherwise(0).alias("indent"), F.trim(F.regexp_replace(text_of(b), r"\s+", " ")).alias("text")))
    return F.filter(made, lambda x: x["text"] != "")
