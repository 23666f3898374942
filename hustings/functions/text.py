"""Text functions. All but those named so are built from Spark's own expressions; where Spark lacks Unicode folding or
sequence matching, pandas functions take whole Arrow batches."""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hustings.sources.shared import bounded_batches

#: Unicode white space, for Java patterns.
SPACE = r"[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}]"


def strip_punctuation(s: Column) -> Column:
    """Lower case without commas, hyphens and spaces: the key for loose name joins."""
    return F.lower(F.translate(s, ",- ", ""))


def tidy(s: Column) -> Column:
    """Without a leading colon, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(s, rf"^{SPACE}*:", ""), f"{SPACE}+", " "))


def plain_quotes(s: Column) -> Column:
    """Curly quotes and primes as straight ones."""
    return F.translate(F.translate(s, "\u2018\u2019\u201a\u2032", "'" * 4), "\u201c\u201d\u201e\u2033", '"' * 4)


def without_possessive(s: Column) -> Column:
    """A name without the possessive at its end: "Smith's" and "James'" lose it."""
    return F.regexp_replace(plain_quotes(s), "(?:'s|(?<=s)')$", "")


def column_range(s: Column) -> Column:
    """struct<first, last> of columns as cited, '1234' or '1234-6'; null if it is neither or its end does not follow.

    A short end has the start's leading digits, and follows if it is greater than as many of the start's last digits:
    '10000-9995' ends at 19995, '1234-4', '1234-1' and '1234-1234' are refused.
    """
    first, end = F.regexp_extract(F.trim(s), r"^(\d+)(?:\s*[-\u2013]\s*(\d+))?$", 1), F.regexp_extract(F.trim(s), r"^(\d+)(?:\s*[-\u2013]\s*(\d+))?$", 2)
    whole = F.when(F.length(end) < F.length(first), F.concat(F.left(first, F.length(first) - F.length(end)), end)).otherwise(end)
    a, b = first.try_cast("long"), F.when(end == "", first).otherwise(whole).try_cast("long")
    return F.when(a.isNotNull() & ((end == "") | (a < b)), F.struct(a.alias("first"), b.alias("last")))


def word_count(s: Column) -> Column:
    """Pieces between white space; blanks at either end count as an empty piece."""
    return F.size(F.split(s, r"\s+"))


#: Fixed value: what counts as a token when versions are compared.
MARKUP_TOKEN = r"(<[^>]*>|&\w+;|[^<>\s]+)"


def markup_tokens(s: Column) -> Column:
    """Tags, entities and words, in order."""
    return F.regexp_extract_all(s, F.lit(MARKUP_TOKEN), F.lit(1))


def sentences(s: Column, least: int = 3, banned: tuple[str, ...] = ()) -> Column:
    """Sentences between '. ' of at least so many words, without those that hold a banned phrase."""
    parts = F.transform(F.split(s, r"\. "), lambda x: F.trim(x))
    keep = lambda x: F.size(F.split(x, " ")) >= least
    kept = F.filter(parts, keep)
    clean = lambda x: ~reduce(or_, (F.contains(F.lower(x), F.lit(b.lower())) for b in banned))
    return F.filter(kept, clean) if banned else kept


#: Fixed value: a capital with up to five letters after it, unless it is two to six capitals. Written as two patterns, since
#: SQL engines that check it have no lookahead.
SHORT_WORD, SHORT_CAPITALS = "^[A-Z][a-zA-Z]{0,5}$", "^[A-Z]{2,6}$"


def phrase_fault(s: Column, banned: tuple[str, ...] = ()) -> Column:
    """Why a phrase makes a poor link, or null: a short word, a single word that isn't all capitals, a banned phrase. Of
    several reasons the later test's name holds."""
    capitals = s.rlike(r"\p{Lu}") & ~s.rlike(r"\p{Ll}")
    fault = F.lit(None).cast("string")
    for test, reason in (
        (s.rlike(SHORT_WORD) & ~s.rlike(SHORT_CAPITALS), "short word"),
        (s.rlike(r"^\s*\S+\s*$") & ~capitals, "single word"),
        (s.isin(*banned) if banned else F.lit(False), "banned"),
    ):
        fault = F.when(test, reason).otherwise(fault)
    return fault


@F.pandas_udf(T.StringType())
def _folded(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


@F.pandas_udf(T.StringType())
def _composed(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def fold_ascii(s: Column) -> Column:
    """Letters without their marks; what has no ASCII form is dropped. ASCII texts never leave the JVM's hands; Spark runs
    Python for all rows, so it gets nulls in their place. Others go in batches of bounded size."""
    bounded_batches(SparkSession.active())
    plain = s.rlike(r"^[\x00-\x7F]*$")
    return F.when(plain, s).otherwise(_folded(F.when(~plain, s)))


def slugify(s: Column, fold: bool = True, gap: str = "-") -> Column:
    """Lower-case words of letters and digits joined by gap."""
    plain = F.lower(fold_ascii(s) if fold else s)
    return F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(plain, r"[^\w\s-]", ""), r"[-\s]+", " ")), " ", gap)


def title_words(s: Column) -> Column:
    """Camel or Pascal case as words with a capital first: 'fooBarHTML' gives 'Foo Bar HTML'. A word is a capital with the
    small letters after it, or a run of capitals up to the next such word; other characters stay with what is before."""
    words = F.regexp_extract_all(s, F.lit(r"(\p{Lu}?[^\p{Lu}]+|\p{Lu}+(?!\P{Lu})|\p{Lu})"), F.lit(1))
    joined = F.array_join(words, " ")
    return F.concat(F.upper(F.substring(joined, 1, 1)), F.substring(joined, 2, 1 << 30))


def snake_case(name: str) -> str:
    """A column name in camel or Pascal case as snake case."""
    out = ""
    for i, c in enumerate(name):
        if c.isupper() and i and (not name[i - 1].isupper() or name[i + 1 : i + 2].islower()):
            out += "_"
        out += c.lower()
    return out


def camel_case(name: str, pascal: bool = False) -> str:
    first, *rest = name.split("_")
    upper = lambda w: "ID" if pascal and w == "id" else w[:1].upper() + w[1:]
    return (upper(first) if pascal else first) + "".join(map(upper, rest))


def wiki_title(s: Column, compose: bool = True) -> Column:
    """An encyclopedia's page title for a phrase: no leading 'the', composed letters, single spaces, a capital first,
    underscores for spaces and no blank after a colon."""
    t = F.regexp_replace(F.trim(s), "(?i)^the +", "")
    if compose:
        t = F.when(t.rlike(r"^[\x00-\x7F]*$"), t).otherwise(_composed(t))
    t = F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r" ?: ?", ":")
    return F.translate(F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30)), " ", "_")


def alpha_order(s: Column) -> Column:
    """The order of revision letters a..z, aa..: digits to base 30."""
    return F.aggregate(F.split(s, ""), F.lit(0).cast("long"), lambda n, c: F.when(c == "", n).otherwise(n * 30 + F.ascii(c) - 96))


def next_alpha(s: Column) -> Column:
    """The revision letters that follow: a to b, z to aa, az to ba."""
    stem = F.regexp_extract(s, "^(.*?)z*$", 1)
    turned = F.repeat(F.lit("a"), F.length(s) - F.length(stem))
    last = F.right(stem, F.lit(1))
    more = F.concat(F.left(stem, F.length(stem) - 1), F.char(F.ascii(last) + 1), turned)
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit("a")).when(stem == "", F.concat(F.lit("a"), turned)).otherwise(more)


def common_words(a: list[str], b: list[str]) -> int:
    """Length of the longest sequence of words that both hold in order. Rows of the usual table are bits of one number,
    so a word of b costs one addition as long as a."""
    places: dict[str, int] = defaultdict(int)
    for i, word in enumerate(a):
        places[word] |= 1 << i
    whole = (1 << len(a)) - 1
    row = whole
    for word in b:
        met = row & places.get(word, 0)
        row = ((row + met) | (row - met)) & whole
    return len(a) - row.bit_count()


def similarity_to():
    """A pandas function of two texts: twice the length of the longest common sequence of their words, over the number of
    their words; from 0 to 1, and 1 for two texts without words. One measure at all lengths."""

    @F.pandas_udf(T.DoubleType())
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x, y):
            if x is None or y is None:
                return None
            x, y = x.split(), y.split()
            return 2 * common_words(x, y) / (len(x) + len(y)) if x or y else 1.0

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return ratio


def bits_to_int(s: Column, most: int = (1 << 63) - 1) -> Column:
    """A string of 0 and 1 as a number, at most `most`."""
    significant = F.regexp_replace(s, "^0+", "")
    return F.when(F.length(significant) > 63, F.lit(most)).otherwise(F.least(F.coalesce(F.conv(F.when(significant == "", "0").otherwise(significant), 2, 10).cast("long"), F.lit(0)), F.lit(most)))
