"""Markup folded token by token: inline tags balanced, paragraphs parted with their depth in lists."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Inline tags that are kept.
INLINE = frozenset(("a", "i", "b", "s", "small", "sup", "sub"))
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)\b([^>]*)>")
HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
BREAKS = re.compile(r"(<table\b(?:(?!<table\b).)*?</table>|</?(?:p|ul|ol|li|br|font|div|h[1-6])\b[^>]*>)", re.I | re.S)
ITALIC = re.compile(r"<i>(.*?)</i>[.:]?$", re.S)
MARGIN = re.compile(r"margin-left: ?[23]0px")


def balanced(html: str) -> str:
    """Inline tags of INLINE nested as they open, a's with their address alone; others go and leave their text. What closes
    an outer tag closes those inside it, what closes nothing goes, what is open at the end is closed."""
    out, open_, at = [], [], 0
    for tag in TAG.finditer(html):
        out.append(html[at : tag.start()])
        at = tag.end()
        name = tag[2].lower()
        if name not in INLINE:
            continue
        if not tag[1]:
            href = HREF.search(tag[3]) if name == "a" else None
            address = next((v for v in href.groups() if v is not None), "") if href else ""
            out.append(f'<a href="{address}">' if name == "a" else f"<{name}>")
            open_.append(name)
        elif name in open_:
            while True:
                out.append(f"</{(last := open_.pop())}>")
                if last == name:
                    break
    return "".join([*out, html[at:], *(f"</{n}>" for n in reversed(open_))])


def parted(html: str) -> list[tuple[str, int, int, str]]:
    """(kind, depth, indent, text) of a text's paragraphs in order; tables are whole, others have balanced inline tags.

    depth counts the lists that a paragraph is in. indent is 1 in a list or a paragraph with a margin, else 0, and 2 more
    where a paragraph is all in italics, which are then taken off. White space is collapsed; what has no text goes.
    """
    out, depth, margin = [], 0, False
    for part in BREAKS.split(html):
        tag = TAG.match(part)
        name = tag[2].lower() if tag else ""
        if name == "table" and BREAKS.fullmatch(part):
            out.append(("table", depth, min(depth, 1), part))
        elif tag and BREAKS.fullmatch(part):
            if name in ("ul", "ol"):
                depth = max(0, depth + (-1 if tag[1] else 1))
            elif name == "p":
                margin = not tag[1] and bool(MARGIN.search(tag[3]))
        else:
            text = re.sub(r"\s+", " ", balanced(part)).strip()
            if re.sub(r"<[^>]*>|&nbsp;|\s", "", text):
                italic = ITALIC.match(text)
                whole = italic is not None and "</i>" not in italic[1]
                out.append(("para", depth, int(depth > 0 or margin) + 2 * whole, italic[1] if whole else text))
    return out


@F.pandas_udf(T.StringType())
def _balanced(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else balanced(x))


PARAGRAPH = T.StructType([T.StructField("kind", T.StringType()), T.StructField("depth", T.IntegerType()), T.StructField("indent", T.IntegerType()), T.StructField("text", T.StringType())])


@F.pandas_udf(T.ArrayType(PARAGRAPH))
def _parted(s: pd.Series) -> pd.Series:
    return s.map(lambda x: [dict(zip(("kind", "depth", "indent", "text"), p, strict=True)) for p in parted(x or "")])


def straightened(s: Column) -> Column:
    """Texts with balanced() inline tags; null stays."""
    return F.when(s.contains("<"), _balanced(s)).otherwise(s)


def paragraphs(s: Column) -> Column:
    """array<struct<kind, depth, indent, text>> of parted(); a missing text has none."""
    return _parted(s)
