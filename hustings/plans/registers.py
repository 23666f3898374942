"""Registers of interests: rows to nested documents and back, snapshots, pruning of repeats."""

from __future__ import annotations

import json
from collections.abc import Iterator
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hustings.functions import markup
from hustings.operators import tables
from hustings.sources.shared import bounded_batches


def details(entries: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """entries with details: an array of (slug, value, type) of the named fields that are not null."""
    made = F.array(*(F.struct(F.lit(f).alias("slug"), F.col(f).cast("string").alias("value"), F.lit(entries.schema[f].dataType.simpleString()).alias("type")) for f in fields))
    return entries.select(*keys, F.filter(made, lambda d: d["value"].isNotNull()).alias("details"))


def with_parents(interests: DataFrame) -> DataFrame:
    """(interest_id, children): interests without a parent with those that name them as parent, in order of id.

    One whose parent is not in the register stays by itself and is flagged orphaned.
    """
    kids = interests.filter("parent_id is not null").groupBy(F.col("parent_id").alias("interest_id")).agg(F.sort_array(F.collect_list("interest_id")).alias("children"))
    own = interests.select(F.col("interest_id").alias("parent_id")).distinct().withColumn("_known", F.lit(True))
    tops = interests.join(own, "parent_id", "left").filter("parent_id is null or _known is null").withColumn("orphaned", F.col("parent_id").isNotNull())
    return tops.join(kids, "interest_id", "left").select("interest_id", "person_id", "category", "orphaned", F.coalesce("children", F.array().cast("array<string>")).alias("children"))


def without_repeats(interests: DataFrame, content: list[str]) -> DataFrame:
    """interests without repeats by content: of rows alike the one with the highest interest_id stays."""
    best = interests.groupBy(*content).agg(F.max("interest_id").alias("_keep"))
    on = [interests[c].eqNullSafe(best[c]) for c in content] + [interests["interest_id"] == best["_keep"]]
    return interests.join(best, on, "left_semi")


def nested(entries: DataFrame) -> DataFrame:
    """A document for each person: categories with their entries, in order."""
    return tables.nested(entries, ["person_id"], ["category"], F.struct("interest_id", "details"), "entries", "categories")


def flattened(documents: DataFrame) -> DataFrame:
    """nested() undone: a row for each detail."""
    by_category = documents.select("person_id", F.explode("categories").alias("c")).select("person_id", "c.category", F.explode("c.entries").alias("e"))
    return by_category.select("person_id", "category", "e.interest_id", F.inline("e.details"))


def snapshots(entries: DataFrame, days: DataFrame) -> DataFrame:
    """The register as of each of days (published): entries registered by then, not ended before, with is_latest.

    Days fall into years; an entry goes to each year from its start to a year after its end (or the last day there is),
    and year is the key of the join, so no entry is compared with days far from it.
    """
    last = days.agg(F.max("published").alias("_last"))  # one row
    dated = days.withColumn("_year", F.year("published")).crossJoin(F.broadcast(last))
    until = F.least(F.coalesce(F.date_add("ended", 365), F.col("_last")), F.col("_last"))
    spread = entries.crossJoin(F.broadcast(last)).withColumn("_until", until).filter(F.col("registered") <= F.col("_until"))
    spread = spread.withColumn("_year", F.explode(F.sequence(F.year("registered"), F.year("_until")))).drop("_last")
    met = spread.join(dated, "_year").filter(F.col("published").between(F.col("registered"), F.col("_until")))
    return met.withColumn("is_latest", F.col("published") == F.col("_last")).drop("_last", "_until", "_year")


def to_html(documents: DataFrame) -> DataFrame:
    """(person_id, html) of nested(): lists in lists, all values escaped."""
    from hustings.functions.markup import escape

    detail = lambda d: F.concat(F.lit("<li>"), escape(d["slug"]), F.lit(": "), escape(F.coalesce(d["value"], F.lit(""))), F.lit("</li>"))
    entry = lambda e: F.concat(F.lit("<ul>"), F.array_join(F.transform(e["details"], detail), ""), F.lit("</ul>"))
    category = lambda c: F.concat(F.lit("<h3>"), escape(c["category"]), F.lit("</h3>"), F.array_join(F.transform(c["entries"], entry), ""))
    return documents.select("person_id", F.array_join(F.transform("categories", category), "").alias("html"))


def proposals(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Motions as two flat tables, proposals and signatures; a signature is primary if its member moved the motion.

    items: (id, title, primary_sponsor, sponsors array<struct<member_id, order, withdrawn>>).
    """
    heads = items.select("id", "title", "primary_sponsor", F.size(F.filter("sponsors", lambda s: ~F.coalesce(s["withdrawn"], F.lit(False)))).alias("n_signatures"))
    signatures = items.select("id", "primary_sponsor", F.inline("sponsors")).select("id", "member_id", "order", F.col("withdrawn").isNotNull().alias("withdrawn"), (F.col("member_id") == F.col("primary_sponsor")).alias("is_primary"))
    return heads, signatures


def positions(members: DataFrame) -> DataFrame:
    """(person_id, place, kind, title, start_date, end_date, occurrence) from members with arrays of posts of each kind."""
    kinds = ["government", "opposition", "parliamentary", "committee"]
    tagged_as = lambda k: lambda p: F.struct(F.lit(k).alias("kind"), p["title"].alias("title"), p["start_date"].alias("start_date"), p["end_date"].alias("end_date"))
    tagged = F.flatten(F.array(*(F.transform(F.coalesce(F.col(k), F.array()), tagged_as(k)) for k in kinds)))
    rows = members.select("person_id", F.posexplode(tagged).alias("place", "p")).select("person_id", "place", "p.*")
    return rows.withColumn("occurrence", F.row_number().over(Window.partitionBy("person_id", "kind", "title").orderBy("start_date", "place")))


#: Arrays of a register's documents that hold nodes: entries hold details and entries, a container's value holds groups, a
#: group its details.
SLOTS = ("details", "sub_entries", "value", "items")


#: Characters and rows of documents that a task hands on at a time.
HANDED_ON = (1 << 23, 50_000)


def gathered(nodes: DataFrame, key: str) -> DataFrame:
    """(key, nodes): the nodes (key, id, parent, slot, place, body) of each key in one array."""
    return nodes.groupBy(key).agg(F.collect_list(F.struct("id", "parent", "slot", "place", "body")).alias("nodes"))


def _family(ids: list, parents: list, known: bool) -> tuple[list[int | None], list[int]]:
    """The place of each node's parent among them, None for roots, and the nodes so that parents stand before theirs."""
    at = {x: n for n, x in enumerate(ids) if x is not None} if known else {}
    above = [at.get(p) if p is not None else None for p in parents]
    kids: dict[int, list[int]] = {}
    for n, up in enumerate(above):
        if up is not None:
            kids.setdefault(up, []).append(n)
    order = [n for n, up in enumerate(above) if up is None]
    for n in order:
        order += kids.get(n, ())
    return above, order


def _written(above: list[int | None], order: list[int], slots: list, places: list, own: list) -> list[tuple[int, str | None]]:
    """(place, document) of each root; own is what each node has for itself, as JSON."""
    held: list[dict[str, list]] = [{} for _ in own]
    roots = []
    for n in reversed(order):
        made = own[n]
        if made is not None and held[n]:
            lists = sorted(f'"{slot}":[{",".join(d for _, _, there, d in sorted(docs) if there)}]' for slot, docs in held[n].items())
            made = f"{made[:-1]}{'' if made == '{}' else ','}{','.join(lists)}}}"
        held[n] = {}
        if above[n] is None:
            roots.append((n, made))
        elif slots[n] is not None:
            held[above[n]].setdefault(slots[n], []).append((places[n] is not None, places[n] if places[n] is not None else 0, made is not None, made or ""))
    return roots[::-1]


def _groups(batches: Iterator[pa.RecordBatch], fields: tuple[str, ...]) -> Iterator[tuple]:
    """(batch, row, fields' values of its nodes) for each row of batches with an array of nodes."""
    for batch in batches:
        array = batch.column("nodes")
        ends, flat = array.offsets.to_pylist(), array.values
        columns = [flat.field(f).to_pylist() for f in fields]
        for row, (start, end) in enumerate(zip(ends, ends[1:], strict=False)):
            yield batch, row, [c[start:end] for c in columns]


def documents_of(families: DataFrame, key: str) -> DataFrame:
    """(key, id, document, ...): each root of the nodes of families (key, nodes, ...), as gathered() has them, as JSON, at any
    depth, with what other columns families has.

    body is a node's own fields, a map of strings; slot names the array of the parent that it stands in, at its place. A
    node whose parent is not there is a root. A key's nodes lie in one row, as its documents do in one cell each, so depth
    costs no round and no shuffle. Nodes that share an id or hold each other in a ring are an error.
    """
    others = [c for c in families.columns if c not in (key, "nodes")]

    def faults(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = rings = 0
        keys: tuple[pa.RecordBatch | None, list] = (None, [])
        for batch, row, (ids, parents) in _groups(batches, ("id", "parent")):
            if keys[0] is not batch:
                keys = (batch, batch.column("key").to_pylist())
            shared += len(set(ids)) < len(ids)
            rings += len(_family(ids, parents, keys[1][row] is not None)[1]) < len(ids)
        yield pa.RecordBatch.from_pydict({"shared": pa.array([shared], pa.int64()), "rings": pa.array([rings], pa.int64())})

    ids = families.select(F.col(key).alias("key"), F.transform("nodes", lambda n: F.struct(n["id"].alias("id"), n["parent"].alias("parent"))).alias("nodes"))
    found = ids.mapInArrow(faults, "shared long, rings long").agg(F.sum("shared"), F.sum("rings")).first()
    if found[0]:
        raise ValueError("nodes share an id")
    if found[1]:
        raise ValueError("nodes hold each other in a ring")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key).to_pylist()
            rows, documents, at, size = [], [], [], 0
            starts = batch.column("nodes").offsets.to_pylist()

            def out() -> pa.RecordBatch:
                kept = [batch.column(c).take(pa.array(rows, pa.int64())) for c in (key, *others)]  # noqa: B023
                id_ = batch.column("nodes").values.field("id").take(pa.array(at, pa.int64()))  # noqa: B023
                return pa.RecordBatch.from_arrays([kept[0], id_, pa.array(documents, pa.string()), *kept[1:]], [key, "id", "document", *others])  # noqa: B023

            for _, row, (own_ids, parents, slots, places, own) in _groups(iter([batch]), ("id", "parent", "slot", "place", "own")):
                for n, document in _written(*_family(own_ids, parents, keys[row] is not None), slots, places, own):
                    rows.append(row)
                    at.append(starts[row] + n)
                    documents.append(document)
                    size += len(document or "")
                if size > HANDED_ON[0]:
                    yield out()
                    rows, documents, at, size = [], [], [], 0
            yield out()

    bounded_batches(families.sparkSession)
    node = families.schema["nodes"].dataType.elementType
    schema = T.StructType([families.schema[key], T.StructField("id", node["id"].dataType), T.StructField("document", T.StringType()), *(families.schema[c] for c in others)])
    own = F.transform("nodes", lambda n: F.struct(n["id"].alias("id"), n["parent"].alias("parent"), n["slot"].alias("slot"), n["place"].alias("place"), F.to_json(n["body"]).alias("own")))
    return families.select(key, own.alias("nodes"), *others).mapInArrow(make, schema)


def nested_documents(nodes: DataFrame, key: str) -> DataFrame:
    """(key, id, document): each root of nodes (key, id, parent, slot, place, body) as JSON, as documents_of() has it."""
    return documents_of(gathered(nodes, key), key)


def _taken_apart(text: str | None, slots: frozenset[str]) -> list[tuple]:
    """(path, above, slot, place, level, own) of each node of a document, in order; own is the JSON of its own fields, None
    for what is no object. A text that is no JSON is one such node."""
    found: list[list] = [["0", None, None, 0, 0, None]]
    # Open objects: their number, the texts of their own fields, and the array that is being read with its next place.
    stack: list[list] = []

    def skip(i: int) -> int:
        while text[i] in " \t\n\r":
            i += 1
        return i

    try:
        i = skip(0)
        if text[i] != "{":
            return [tuple(found[0])]
        stack.append([0, [], None, 0])
        i = skip(i + 1)
        while stack:
            top = stack[-1]
            number, own, slot, place = top
            if slot is None and text[i] == "}":
                found[number][5] = "{" + ",".join(own) + "}"
                stack.pop()
                if not stack:
                    break
                i = skip(i + 1)
                if text[i] not in ",]":
                    raise ValueError
                i = skip(i + 1) if text[i] == "," else i
            elif slot is None:
                if text[i] != '"':
                    raise ValueError
                name, j = scanstring(text, i + 1, False)
                j = skip(j)
                if text[j] != ":":
                    raise ValueError
                j = skip(j + 1)
                if name in slots and text[j] == "[":
                    top[2], top[3], i = name, 0, skip(j + 1)
                    continue
                end = SCAN(text, j)[1]
                own.append(text[i:end])
                i = skip(end)
                if text[i] not in ",}":
                    raise ValueError
                i = skip(i + 1) if text[i] == "," else i
            elif text[i] == "]":
                top[2] = None
                i = skip(i + 1)
                if text[i] not in ",}":
                    raise ValueError
                i = skip(i + 1) if text[i] == "," else i
            else:
                above = found[number]
                found.append([f"{above[0]}.{slot}:{place}", above[0], slot, place, above[4] + 1, None])
                top[3] += 1
                if text[i] == "{":
                    stack.append([len(found) - 1, [], None, 0])
                    i = skip(i + 1)
                else:
                    i = skip(SCAN(text, i)[1])
                    if text[i] not in ",]":
                        raise ValueError
                    i = skip(i + 1) if text[i] == "," else i
    except (ValueError, IndexError, StopIteration, TypeError):
        return [("0", None, None, 0, 0, None)]
    return [tuple(f) for f in found]


SCAN = json.JSONDecoder(strict=False).scan_once


def flat_documents(documents: DataFrame, key: str, document: str = "document", slots: tuple[str, ...] = SLOTS) -> DataFrame:
    """nested_documents() undone: (key, path, above, slot, place, level, body): a node of each document (JSON) a row, body
    being its own fields. path tells nodes of a document apart: places from the root down; above is the parent's.

    A document is taken apart where it lies, in one pass whatever its depth; nothing is shuffled or written.
    """
    names, kinds = ("path", "above", "slot", "place", "level", "own"), (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = frozenset(slots)
        for batch in batches:
            rows: list[int] = []
            out: list[tuple] = []
            size = 0
            made = lambda: pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], ["key", *names])  # noqa: B023, E731
            for row, text in enumerate(batch.column("json").to_pylist()):
                nodes = _taken_apart(text, wanted)
                out += nodes
                rows += [row] * len(nodes)
                size += len(text or "")
                if size > HANDED_ON[0] or len(out) > HANDED_ON[1]:
                    yield made()
                    rows, out, size = [], [], 0
            if out:
                yield made()

    bounded_batches(documents.sparkSession)
    schema = T.StructType([T.StructField("key", documents.schema[key].dataType), *T._parse_datatype_string("path string, above string, slot string, place int, level int, own string")])
    found = documents.select(F.col(key).alias("key"), F.col(document).alias("json")).mapInArrow(run, schema)
    return found.select(F.col("key").alias(key), *names[:5], F.from_json("own", "map<string, string>").alias("body"))


def legacy_xml(entries: DataFrame) -> DataFrame:
    """(person_id, xml): a person's entries (person_id, name, published, category, category_name, place, content) in the older
    XML form: categories in order of their ids, a record and an item for each entry, whose content is markup as it is."""
    item = F.concat(F.lit('<record><item class="interest">'), F.coalesce("content", F.lit("")), F.lit("</item></record>"))
    by_category = entries.groupBy("person_id", "category").agg(*(F.first(c).alias(c) for c in ("name", "published", "category_name")), F.sort_array(F.collect_list(F.struct("place", item.alias("item")))).alias("items"))
    opened = F.concat(F.lit('<category type="'), markup.escape(F.col("category")), F.lit('" name="'), markup.escape(F.coalesce("category_name", F.lit(""))), F.lit('">'))
    part = F.concat(opened, F.array_join(F.transform("items", lambda i: i["item"]), ""), F.lit("</category>"))
    people = by_category.groupBy("person_id").agg(F.first("name").alias("name"), F.first("published").alias("published"), F.sort_array(F.collect_list(F.struct("category", part.alias("part")))).alias("parts"))
    head = F.concat(*(x for c in ("person_id", "name", "published") for x in (F.lit(f' {LEGACY[c]}="'), markup.escape(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit('"'))))
    return people.select("person_id", F.concat(F.lit("<regmem"), head, F.lit(">"), F.array_join(F.transform("parts", lambda p: p["part"]), ""), F.lit("</regmem>")).alias("xml"))


#: Names of attributes in the older form.
LEGACY = {"person_id": "personid", "name": "membername", "published": "date"}


def from_legacy_xml(documents: DataFrame) -> DataFrame:
    """legacy_xml() undone, from documents (xml)."""
    attribute = lambda s, name: markup.unescape_basic(F.regexp_extract(s, rf'\s{name}="([^"]*)"', 1))
    head = F.regexp_extract("xml", r"(?s)^\s*<regmem\b([^>]*)>", 1)
    whole = documents.select(*(attribute(head, a).alias(c) for c, a in LEGACY.items()), F.explode(F.regexp_extract_all("xml", F.lit(r"(?s)(<category\b.*?</category>)"), F.lit(1))).alias("part"))
    top = F.regexp_extract("part", r"^<category\b([^>]*)>", 1)
    items = whole.select("person_id", "name", "published", attribute(top, "type").alias("category"), attribute(top, "name").alias("category_name"), F.posexplode(F.regexp_extract_all("part", F.lit(r'(?s)<item class="interest">(.*?)</item></record>'), F.lit(1))).alias("place", "content"))
    return items.select("person_id", "name", "published", "category", "category_name", "place", "content")
