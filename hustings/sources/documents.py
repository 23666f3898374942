"""A data source that writes one XML document for each key: header, entity table, elements with sorted attributes.

    spark.dataSource.register(XmlDocuments)
    rows.repartition("day").sortWithinPartitions("day", "seq").write.format("xml_documents").option("path", p)...save()

Rows of a document must come one after another in one partition, as ordered() sees to. Each task writes into a folder of
its own; when all are done each folder gets its place by one renaming, and what failed attempts left is deleted.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from xml.sax.saxutils import escape

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

#: Columns of a row: the document's key, the element's name, its attributes and its content, markup as it is.
COLUMNS = "key string, seq long, element string, attrs map<string, string>, content string"
#: Characters that documents may name, as they are declared where a document has an entity table.
ENTITIES = {"nbsp": 160, "pound": 163, "copy": 169, "eacute": 233, "ndash": 8211, "mdash": 8212, "lsquo": 8216, "rsquo": 8217, "ldquo": 8220, "rdquo": 8221, "euro": 8364}
STAGING = "_staging"


def attribute(value: str) -> str:
    return escape(value, {'"': "&quot;", "\n": "&#10;", "\t": "&#9;", "\r": "&#13;"})


def element(name: str, attrs: dict[str, str] | None, content: str | None) -> str:
    """An element with its attributes in order of their names; those without a value are left out."""
    told = "".join(f' {k}="{attribute(v)}"' for k, v in sorted((attrs or {}).items()) if v is not None)
    return f"<{name}{told}>{content}</{name}>\n" if content else f"<{name}{told}/>\n"


def header(root: str, entities: bool) -> str:
    table = "".join(f'<!ENTITY {n} "&#{c};">\n' for n, c in sorted(ENTITIES.items()))
    return '<?xml version="1.0" encoding="UTF-8"?>\n' + (f"<!DOCTYPE {root} [\n{table}]>\n" if entities else "")


def ordered(rows: DataFrame) -> DataFrame:
    """rows with the columns of COLUMNS as the writer wants them; those without a key are left out."""
    plain = rows.select("key", F.col("seq").cast("long").alias("seq"), "element", "attrs", "content").filter("key is not null")
    return plain.repartition("key").sortWithinPartitions("key", "seq", "element", "content")


@dataclass
class Written(WriterCommitMessage):
    folder: str
    documents: int


class DocumentWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.root, self.overwrite = options["path"].rstrip("/"), options.get("root", "document"), overwrite
        self.entities, self.attempt = options.get("entities", "false").lower() == "true", uuid.uuid4().hex

    def _at(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def write(self, iterator: Iterator[Row]) -> Written:
        store, base = self._at()
        name = f"part-{uuid.uuid4().hex}"
        folder, n = posixpath.join(base, STAGING, self.attempt, name), 0
        store.create_dir(folder, recursive=True)
        for key, rows in groupby(iterator, lambda r: r["key"]):
            with store.open_output_stream(posixpath.join(folder, f"{file_name(key)}.xml")) as out:
                out.write(f"{header(self.root, self.entities)}<{self.root}>\n".encode())
                for row in rows:
                    out.write(element(row["element"], row["attrs"], row["content"]).encode())
                out.write(f"</{self.root}>\n".encode())
            n += 1
        return Written(name, n)

    def commit(self, messages: list[Written | None]) -> None:
        """Only folders of tasks that were committed get a place; a name for each task comes to the driver, none for a document."""
        store, base = self._at()
        staging = posixpath.join(base, STAGING)
        kept = {m.folder for m in messages if m is not None and m.documents}
        if self.overwrite:
            for info in store.get_file_info(fs.FileSelector(base)):
                if info.type == fs.FileType.Directory and info.base_name.startswith("part-"):
                    store.delete_dir(info.path)
        for name in sorted(kept):
            store.move(posixpath.join(staging, self.attempt, name), posixpath.join(base, name))
        store.delete_dir(staging)

    def abort(self, messages: list[Written | None]) -> None:
        store, base = self._at()
        if store.get_file_info(own := posixpath.join(base, STAGING, self.attempt)).type == fs.FileType.Directory:
            store.delete_dir(own)


def file_name(key: str) -> str:
    """A key as a file name: what is not a letter, digit, dot, dash or underscore is written as its code."""
    return "".join(c if c.isascii() and (c.isalnum() or c in ".-_") else f"%{ord(c):x}_" for c in key) or "%"


class XmlDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xml_documents"

    def schema(self) -> str:
        return COLUMNS

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return DocumentWriter(dict(self.options), overwrite)


def write_documents(rows: DataFrame, path: str, root: str = "document", entities: bool = False, mode: str = "append") -> None:
    """One document at path/part-*/<key>.xml for each key of rows (key, seq, element, attrs, content), its elements in order of
    seq. Attributes are sorted by name, as documents are compared as text; content is markup. mode overwrite replaces all."""
    rows.sparkSession.dataSource.register(XmlDocuments)
    ordered(rows).write.format("xml_documents").option("path", path).option("root", root).option("entities", str(entities)).mode(mode).save()
