"""Names of people: titles, order of parts, letter case, offices in brackets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Titles before a name and honours after it.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Sir", "Dame", "Lord", "Lady", "Baroness", "Professor", "Rev", "Hon", "Rt")
HONOURS = ("MP", "QC", "KC", "OBE", "MBE", "CBE", "MSP", "MLA", "AM", "MS")


def strip_titles(s: Column) -> Column:
    """struct<name, n_titles>: dots and commas become blanks, then all titles in front and honours behind go."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(s, "[.,]", " "), r"\s+", " "))
    front = rf"^((?:(?:{'|'.join(TITLES)}) )*)"
    rest = F.regexp_replace(plain, front, "")
    name = F.regexp_replace(rest, rf"( (?:{'|'.join(HONOURS)}))+$", "")
    titles = F.regexp_extract(plain, front, 1)
    return F.struct(name.alias("name"), (F.length(titles) - F.length(F.replace(titles, F.lit(" ")))).alias("n_titles"))


def reorder(s: Column) -> Column:
    """'Last, First' as 'First Last'; a name without a comma stays."""
    return F.regexp_replace(s, r"^([^,]*), *(.*)$", "$2 $1")


def split_name(s: Column, particles: tuple[str, ...] = ("de", "van", "von", "ap", "ab")) -> Column:
    """struct<given, family>: the last word is the family name, with the particles that stand before it."""
    family = F.regexp_extract(F.trim(s), rf"((?:\b(?:{'|'.join(particles)}) )*\S+)$", 1)
    return F.struct(F.trim(F.left(F.trim(s), F.length(F.trim(s)) - F.length(family))).alias("given"), family.alias("family"))


def family_case(s: Column) -> Column:
    """A family name in capitals as usually written: MCDONALD, O'NEIL and CLIFTON-BROWN get their inner capitals."""
    part = lambda w: F.when(w.startswith("MC") & (F.length(w) > 3), F.concat(F.lit("Mc"), F.initcap(F.substring(w, 3, 1 << 30)))).otherwise(F.initcap(w))
    by_mark = lambda w, mark: F.array_join(F.transform(F.split(w, mark), part), mark)
    hyphened = lambda w: F.array_join(F.transform(F.split(w, "-"), lambda x: by_mark(x, "'")), "-")
    return F.array_join(F.transform(F.split(s, " "), hyphened), " ")


def brackets(s: Column) -> Column:
    """struct<outside, inside>: a speaker's text and what its brackets hold, in order (office, seat, party)."""
    return F.struct(F.trim(F.regexp_replace(s, r"\s*\([^)]*\)", "")).alias("outside"), F.regexp_extract_all(s, F.lit(r"\(([^)]*)\)"), F.lit(1)).alias("inside"))


def peer(s: Column) -> Column:
    """struct<the, prefix, name, lordof> of a peer's style: 'The Lord Bishop of X', 'Baroness Y of Z'."""
    pattern = r"^(?i)(the )?((?:lord bishop|lord|lady|baroness|viscount|viscountess|earl|countess|duke|marquess|archbishop|bishop))(?: ([^ ].*?))??(?: of (.+))?$"
    pattern = "(?i)" + pattern.replace("(?i)", "")
    g = lambda i: F.nullif(F.regexp_extract(F.trim(s), pattern, i), F.lit(""))
    return F.struct(g(1).isNotNull().alias("the"), F.initcap(g(2)).alias("prefix"), g(3).alias("name"), g(4).alias("lordof"))


# How division lists shorten the ranks of peers.
RANKS = {"L.": "Lord", "B.": "Baroness", "Abp.": "Archbishop", "Bp.": "Bishop", "V.": "Viscount", "E.": "Earl", "D.": "Duke", "M.": "Marquess", "C.": "Countess", "Ly.": "Lady"}


def reversed_peer(s: Column) -> Column:
    """A peer's full style from a division list's 'Name, L.' or 'Name of Place, Bp.'; null where no rank is known."""
    rank = F.regexp_replace(F.regexp_extract(F.trim(s), r",\s{0,3}([A-Z][a-z]{0,2})\.?$", 1), "$", ".")
    known = F.create_map(*(F.lit(x) for pair in RANKS.items() for x in pair))
    style = F.translate(F.regexp_replace(F.trim(s), r",[^,]*$", ""), ".\u2019", "\u0000'")
    style = F.regexp_replace(F.replace(style, F.lit("\u0000")), "^De ", "de ")
    title = F.try_element_at(known, rank)
    return F.when(title.isNotNull(), F.concat_ws(" ", title, style))


def canonical_peer(s: Column) -> Column:
    """A peer's style for comparing: without 'The', dots, apostrophes of any kind and doubled blanks, in lower case; 'Lord
    Bishop of' and 'Bishop of' are one."""
    plain = F.lower(F.regexp_replace(F.translate(F.trim(s), ".'\u2019", ""), r"\s+", " "))
    return F.regexp_replace(F.regexp_replace(plain, "^the ", ""), "^(?:right reverend the )?(?:lord )?(arch)?bishop of ", "$1bishop of ")


def vote_line(s: Column) -> Column:
    """struct<family, given, seat, party> of a line of a division list, by the first of three forms that fits:
    'Family, Given (Seat) (Party)', 'Given Family (Party)', 'Family, Given'."""
    full, short, bare = r"^([^,(]+), ([^(]+?) \(([^)]+)\) \(([^)]+)\)$", r"^(\S+(?: \S+)*?) (\S+) \(([^)]+)\)$", r"^([^,(]+), ([^(]+)$"
    g = lambda p, i: F.nullif(F.regexp_extract(F.trim(s), p, i), F.lit(""))
    return F.struct(
        F.coalesce(g(full, 1), g(short, 2), g(bare, 1)).alias("family"), F.coalesce(g(full, 2), g(short, 1), g(bare, 2)).alias("given"), g(full, 3).alias("seat"), F.coalesce(g(full, 4), g(short, 3)).alias("party"),
    )


def strip_patterns(s: Column, patterns: list[str]) -> Column:
    """s without anything that the patterns match in front, as often as they do."""
    return F.trim(F.regexp_replace(F.trim(s), rf"^(?:(?:{'|'.join(patterns)})\s*)+", ""))
