"""Marked-up proceedings: day and committee documents in the parliamentary XML vocabulary, as ordered rows.

A document is cut into its blocks where it lies, in one pass over its tags and texts that follows which element each text
stands in and carries column and time. So marks count wherever they stand, inside a speech too.
Windows run over one document's blocks; documents are many and each is some megabytes at most.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hustings.functions import dates, markup
from hustings.sources.shared import bounded_batches

# Names of elements by what they are for.
ORAL_HEADINGS = ("hs_3OralAnswers",)
MAJOR_HEADINGS = (
    "hs_6bDepartment", "hs_6bBigBoldHdg", "hs_2cBillTitle", "hs_2cUrgentQuestion", "hs_3cMainHdg", "hs_2BusinessWODebate", "hs_2cStatement", "hs_2BillTitle", "hs_6bBillTitle", "hs_6bBusinessB4Questions",
    "hs_6bPrivateBusiness", "hs_6bRoyalAssent", "hs_6bMember", "hs_6bBillsPresented", "hs_6fCntrItalHdg", "hs_2cSO24Application", "hs_6bFormalmotion", "hs_2cDeferredDiv", "hs_3cPetitions",
    "hs_3cOppositionDay", "hs_2DebBill", "hs_8Petition",
)
MINOR_HEADINGS = ("hs_8Question", "hs_8GenericHdg", "hs_8Clause", "hs_7SmCapsHdg", "hs_7PrivateBusinessHdg", "hs_7Bill", "hs_6bcBigBoldHdg", "hs_6bCorrection", "hs_2DebatedMotion", "hs_2cDebatedMotion", "hs_2cGenericHdg", "hs_2GenericHdg", "hs_2cWestHallDebate", "hs_2WestHallDebate", "DebateHeading")
CHAIR_HEADINGS = ("hs_76fChair",)
PARAGRAPHS = ("hs_Para", "hs_AmendmentLevel1", "hs_AmendmentLevel2", "hs_AmendmentLevel3", "hs_AmendmentLevel4", "hs_AmendmentHeading", "hs_newline10", "hs_newline12", "hs_Question", "hs_6CntrCapsHdg")
INDENTS = ("hs_quote", "hs_QuoteAllIndent", "hs_ParaIndent", "hs_AmendmentLevel0", "hs_IndentOne", "hs_IndentTwo", "hs_brev", "hs_brevIndent", "hs_quotefo")
#: What a top-level element becomes. Elements named nowhere here are passed over if they only hold others; unknown() lists
#: them.
KINDS = {
    **dict.fromkeys(ORAL_HEADINGS, "oral-heading"), **dict.fromkeys(MAJOR_HEADINGS, "major-heading"), **dict.fromkeys(MINOR_HEADINGS, "minor-heading"), **dict.fromkeys(CHAIR_HEADINGS, "chair"),
    **dict.fromkeys(PARAGRAPHS, "para"), **dict.fromkeys(INDENTS, "indent"), "Question": "question", "NewDebate": "debate", "Division": "division", "TableWrapper": "table", "hs_Timeline": "time", "hs_6fDate": "date",
    "hs_CLChairman": "chairman", "hs_CLMember": "member", "hs_CLClerks": "clerks", "hs_CLPara": "witness",
}
#: Elements inside those whose text has a part of its own.
PARTS = ("Member", "B", "Number", "Uin", "QuestionText", "AyesNumber", "NoesNumber", "ContentsNumber", "NotContentsNumber", "hs_time", "hs_DebateHeading", "hs_DebateType", "hs_TabledBy", "Witness", "I")
#: Elements whose depth is followed.
DEEP = frozenset((*PARTS, "hs_Timeline", "hs_time"))
PASSED = ("hs_TimeCode", "hs_6bPetitions", "hs_3MainHdg", "hs_3cWestHall", "hs_Venue", "hs_CLHeading", "hs_CLAttended", "StartProcedure", "EndProcedure", "System", "Fragment", "Body", "House", "Sitting", "Cover", "England", "EnglandWales", "hs_DivListHeader", "TwoColumn", "NamesAyes", "NamesNoes", "row", "entry", "column", "hs_Procedure", "hs_TableHeading", "hs_para")


def tokens(documents: DataFrame, keys: list[str], xml: str = "xml") -> DataFrame:
    """(keys, seq, tag, turn, attributes, text): turn is 1 where an element opens, -1 where it closes, 0 for texts, empty
    elements and processing instructions. Names come without prefix, texts with entities as characters."""
    found = F.regexp_extract_all(F.regexp_replace(xml, r"(?s)<!--.*?-->", ""), F.lit(r"(?s)(<[^>]*>|[^<]+)"), F.lit(1))
    rows = documents.select(*keys, F.posexplode(found).alias("seq", "e"))
    tag = F.nullif(F.regexp_extract("e", r"^<[/?]?(?:[\w-]+:)?([\w-]+)", 1), F.lit(""))
    turn = F.when(tag.isNull() | F.col("e").startswith("<?") | F.col("e").endswith("/>"), 0).when(F.col("e").startswith("</"), -1).otherwise(1)
    return rows.select(*keys, "seq", tag.alias("tag"), turn.alias("turn"), F.when(tag.isNotNull(), F.col("e")).alias("attributes"), F.when(tag.isNull(), markup.unescape_basic(F.col("e"))).alias("text"))


def attribute(name: str) -> Column:
    return F.nullif(F.regexp_extract("attributes", rf"\b{name}=['\"]?([^'\"\s>?]*)", 1), F.lit(""))


BLOCK = T.StructType(
    [T.StructField("block", T.LongType()), T.StructField("seq", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in ("kind", "tag", "attributes", "column", "time", "member", *(p for p in PARTS if p not in ("Member", "B")), "rest", "after", "whole", "last_column")]
)
COMMENT, TOKEN = re.compile(r"<!--.*?-->", re.S), re.compile(r"<[^>]*>|[^<]+")
NAME, BLANKS = re.compile(r"<[/?]?(?:[\w-]+:)?([\w-]+)", re.A), re.compile(r"\s+", re.A)
MARKS = {n: re.compile(rf"\b{n}=['\"]?([^'\"\s>?]*)", re.A) for n in ("column", "n", "number")}
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def _mark(element: str, *names: str) -> str | None:
    return next((m[1] for n in names if (m := MARKS[n].search(element)) and m[1]), None)


def _joined(texts: list[str]) -> str | None:
    """Texts as one, white space collapsed; None if nothing is left."""
    return BLANKS.sub(" ", "".join(texts)).strip(" ") or None


@lru_cache(4096)
def _element(element: str) -> tuple[str, int, bool] | None:
    """Name, turn (as in tokens()) and whether it is a processing instruction; None for what has no name."""
    name = NAME.match(element)
    if name is None:
        return None
    processing = element.startswith("<?")
    return name[1], 0 if processing or element.endswith("/>") else -1 if element.startswith("</") else 1, processing


def _into(depth: dict[str, int], asked: bool) -> list[str]:
    """The parts of a block that a text belongs to."""
    inside = [p for p in PARTS if depth.get(p, 0) > 0]
    member = ["member"] if "Member" in inside or "B" in inside else []
    return ["whole", *(p for p in inside if p not in ("Member", "B")), *member, *(["rest"] if inside in ([], ["I"]) else []), *(["after"] if asked else [])]


def _blocks_of(xml: str) -> list[dict]:
    """The blocks of one document, in one pass over its tokens, in time that grows with its length."""
    found, level, column, time, asked, timed = [], 0, None, None, False, False
    depth: dict[str, int] = {}
    into, own, texts = None, None, {}  # where a text goes (None: to be told anew), the last block and its texts
    for seq, element in enumerate(TOKEN.findall(COMMENT.sub("", xml))):
        known = _element(element) if element[0] == "<" else None
        if known is not None:
            tag, turn, processing = known
            if tag in DEEP:
                depth[tag] = depth.get(tag, 0) + turn
                asked |= tag == "QuestionText" and turn != 1
                timed = depth.get("hs_Timeline", 0) + depth.get("hs_time", 0) > 0
                into = None
            if processing or tag in ("column", "hs_column"):
                names = ("column", "n", "number") if tag in ("column", "hs_column") else ("column",)
                column = _mark(element, *names) or column
            kind = KINDS.get(tag)
            if kind is not None:
                level += turn
                if turn >= 0 and level == turn:
                    texts, asked, into = {}, False, None
                    own = {"block": len(found) + 1, "seq": seq, "kind": kind, "tag": tag, "attributes": element, "column": column, "time": time, "texts": texts}
                    found.append(own)
            if own is not None and (level > 0 or kind is not None):
                own["last_column"] = column
            continue
        if level <= 0 and not timed:
            continue
        if "&" in element:
            for entity, char in ENTITIES:
                element = element.replace(entity, char)
        if level > 0:
            own["last_column"] = column
            if into is None:
                into = _into(depth, asked)
            for part in into:
                if part in texts:
                    texts[part].append(element)
                else:
                    texts[part] = [element]
        if timed:
            time = dates.clock_of(element) or time
    for block in found:
        block.update((part, _joined(parts)) for part, parts in block.pop("texts").items())
    return found


def cut(documents: DataFrame, keys: list[str], xml: str = "xml") -> DataFrame:
    """(keys, blocks): the blocks of each document, an array in their order; see blocks()."""
    bounded_batches(documents.sparkSession)
    arrow = to_arrow_type(T.ArrayType(BLOCK))

    @F.arrow_udf(T.ArrayType(BLOCK))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((None if x is None else _blocks_of(x) for x in batch.to_pylist()), arrow)

    return documents.select(*keys, run.asNondeterministic()(F.col(xml).cast("string")).alias("blocks"))


def blocks(documents: DataFrame, keys: list[str], xml: str = "xml") -> DataFrame:
    """One row for each outermost element of KINDS: keys, block (from 1), seq, kind, tag, attributes, column, time, and the
    text of its parts by name, of everything, and of what stands in no part (rest) or after the question's own element
    (after).

    column and time are those in force where the element begins; marks of either inside it hold from the next one on. A
    document is cut where it lies, so nothing is shuffled or sorted.
    """
    return cut(documents, keys, xml).select(*keys, F.inline("blocks"))


def unknown(documents: DataFrame, keys: list[str], xml: str = "xml") -> DataFrame:
    """(keys, tag, n): elements that the vocabulary lacks, so that a run can stop with them instead of losing text."""
    known = [*KINDS, *PARTS, *PASSED, "hs_column"]
    return tokens(documents, keys, xml).filter((F.col("turn") >= 0) & F.col("tag").isNotNull() & ~F.col("tag").isin(*known) & ~F.col("attributes").startswith("<?")).groupBy(*keys, "tag").agg(F.count("*").alias("n"))


def day_rows(documents: DataFrame, keys: list[str], prefix: str, day: str = "day", revision: str = "revision") -> DataFrame:
    """Speeches, headings and divisions of day documents: (keys, gid, kind, speaker, column, time, heading, number, text).

    A paragraph that names a member begins a speech, one that names none goes on with the one before; a heading, a chair's
    entry or a division ends it. Texts are the paragraphs, indented ones with a tab before them, joined by line feeds. Ids
    are day, revision, column and a number that begins anew in each column.
    """
    body = F.when(F.col("kind") == "question", F.coalesce("QuestionText", "after")).when(F.col("kind").isin("para", "indent"), F.coalesce("rest", F.lit(""))).otherwise(F.col("whole"))
    body = F.concat(F.when(F.col("kind") == "indent", "\t").otherwise(""), F.coalesce(body, F.lit("")))
    heading = F.when(F.col("kind").isin("oral-heading", "major-heading", "debate"), F.coalesce("hs_DebateHeading", "whole"))
    # Only what a speech is made of is sorted, each text once.
    found = blocks(documents, keys).filter("kind not in ('time', 'date', 'chairman', 'member', 'clerks')").select(*keys, "seq", "kind", "member", "Witness", "column", "time", "Number", heading.alias("heading"), body.alias("body"))
    by = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    going_on = F.col("kind").isin("para", "indent", "table") & F.lag("kind").over(Window.partitionBy(*keys).orderBy("seq")).isin("para", "indent", "table", "question")
    fresh = ~F.coalesce(going_on, F.lit(False)) | F.col("member").isNotNull() | F.col("Witness").isNotNull()
    rows = found.withColumn("_speech", F.sum(fresh.cast("int")).over(by)).withColumn("heading", F.last("heading", True).over(by))
    speech = rows.groupBy(*keys, "_speech").agg(
        F.min("seq").alias("seq"), F.min_by(F.when(F.col("kind").isin("para", "indent", "table", "question"), "speech").otherwise(F.col("kind")), "seq").alias("kind"),
        F.min_by(F.rtrim(F.regexp_replace(F.coalesce("member", "Witness"), r":\s*$", "")), "seq").alias("speaker"), *(F.min_by(c, "seq").alias(c) for c in ("column", "time", "heading", "Number")),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", F.col("body").alias("t")))), lambda x: x["t"]), "\n").alias("text"),
    )
    number = F.row_number().over(Window.partitionBy(*keys, "column").orderBy("seq")) - 1
    gid = F.concat(F.lit(prefix), F.col(day).cast("string"), F.col(revision), F.lit("."), F.coalesce("column", F.lit("0")), F.lit("."), number.cast("string"))
    return speech.select(*keys, gid.alias("gid"), "seq", "kind", "speaker", "column", "time", "heading", F.col("Number").alias("number"), "text")


def oral_questions(documents: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, block, number, qnum, member, column, text) of <Question> elements: number as printed, qnum from [digits] in its
    Uin; the text is that of QuestionText or, where that is empty, all that stands after it."""
    asked = blocks(documents, keys).filter("kind = 'question'")
    qnum = F.nullif(F.regexp_extract("Uin", r"^\[\s*(\d+)\s*\]", 1), F.lit(""))
    return asked.select(*keys, "block", F.col("Number").alias("number"), qnum.alias("qnum"), F.regexp_replace("member", r":\s*$", "").alias("member"), "column", F.coalesce("QuestionText", "after").alias("text"))


def committee(documents: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, place, role, name, seat, attending) of a committee's sitting: chairs and members, a dagger before a name
    telling that they attended, clerks parted by commas, and witnesses."""
    found = blocks(documents, keys)
    seat = F.nullif(F.regexp_replace("I", "[()]", ""), F.lit(""))
    plain = F.trim(F.regexp_replace("member", r"\s*\([^)]*\)", ""))
    named = found.filter("kind in ('chairman', 'member')").select(*keys, "seq", F.lit(0).alias("_i"), F.when(F.col("kind") == "chairman", "chair").otherwise("member").alias("role"), plain.alias("name"), F.when(F.col("kind") == "member", seat).alias("seat"), F.coalesce(F.col("whole").startswith("†"), F.lit(False)).alias("attending"))
    clerks = found.filter("kind = 'clerks'").select(*keys, "seq", F.posexplode(F.split("whole", ",")).alias("_i", "n")).select(*keys, "seq", "_i", F.lit("clerk").alias("role"), F.trim("n").alias("name"), F.lit(None).cast("string").alias("seat"), F.lit(None).cast("boolean").alias("attending"))
    heard = found.filter("kind = 'witness'").select(*keys, "seq", F.lit(0).alias("_i"), F.lit("witness").alias("role"), F.col("whole").alias("name"), F.lit(None).cast("string").alias("seat"), F.lit(None).cast("boolean").alias("attending"))
    every = named.unionByName(clerks).unionByName(heard)
    return every.select(*keys, F.row_number().over(Window.partitionBy(*keys).orderBy("seq", "_i")).alias("place"), "role", "name", "seat", "attending")


def chairs(documents: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, seq, chair): who is in the chair from an entry '[Name in the Chair]' on."""
    name = F.nullif(F.regexp_extract("whole", r"(?i)^\s*\[\s*(.*?)\s+in\s+the\s+chair\s*\]", 1), F.lit(""))
    return blocks(documents, keys).filter("kind = 'chair'").select(*keys, "seq", name.alias("chair"))


def divisions(documents: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, block, number, ayes, noes, column, time) of <Division> elements."""
    found = blocks(documents, keys).filter("kind = 'division'")
    count = lambda c: F.nullif(F.regexp_replace(c, r"\D", ""), F.lit("")).cast("long")
    return found.select(*keys, "block", count("Number").alias("number"), F.coalesce(count("AyesNumber"), count("ContentsNumber")).alias("ayes"), F.coalesce(count("NoesNumber"), count("NotContentsNumber")).alias("noes"), "column", "time")


def lords_debates(documents: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, block, heading, debate_type, business, time, member, text) of <NewDebate> elements; a question or a general
    debate has the member who opens it, other business what was tabled."""
    found = blocks(documents, keys).filter("kind = 'debate'").withColumn("business", attribute("BusinessType"))
    opened = F.col("business").isin("Question", "GeneralDebate")
    return found.select(
        *keys, "block", F.col("hs_DebateHeading").alias("heading"), F.col("hs_DebateType").alias("debate_type"), "business", F.coalesce(dates.clock(F.col("hs_time")), F.col("time")).alias("time"),
        F.when(opened, F.regexp_replace("member", r":\s*$", "")).alias("member"), F.when(~opened, F.col("hs_TabledBy")).alias("text"),
    )
