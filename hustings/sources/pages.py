"""HTML tables, and paged interfaces as a data source."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _Tables(HTMLParser):
    """Cells of all tables of a page, inner tables' text with their outer cell's."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.cells: list[tuple[int, int, int, str]] = []
        self.table = self.row = self.column = -1
        self.depth, self.text = 0, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.table, self.row = self.table + 1, -1
        elif tag == "tr" and self.depth == 1:
            self.close_cell()
            self.row, self.column = self.row + 1, -1
        elif tag in ("td", "th") and self.depth == 1:
            self.close_cell()
            self.column, self.text = self.column + 1, ""

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table") and self.depth == 1:
            self.close_cell()
        if tag == "table":
            self.depth = max(0, self.depth - 1)

    def handle_data(self, data):
        if self.text is not None:
            self.text += data

    def close_cell(self):
        if self.text is not None:
            self.cells.append((self.table, max(self.row, 0), self.column, " ".join(self.text.split())))
            self.text = None


def html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table_no, row_no, column_no, value) of every cell of every table; broken markup is read as browsers do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, cells = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                parser = _Tables()
                parser.feed(text or "")
                parser.close_cell()
                keys += [i] * len(parser.cells)
                cells += parser.cells
            columns = list(zip(*cells, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int64())), *(pa.array(c, pa.int32()) for c in columns[:3]), pa.array(columns[3], pa.string())], [key, "table_no", "row_no", "column_no", "value"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, F.col(html).cast("string")).mapInArrow(run, f"`{key}` {kind}, table_no int, row_no int, column_no int, value string")


class PagedSource(DataSource):
    """format("paged"): rows of an interface that gives them page by page; a partition is a stretch of pages.

    Options: total, page_size and the most partitions. The fetch function is set by paged_source(), as options are only strings.
    """

    fetch: Callable[[int, int], list[tuple]] | None = None
    rows: str = ""

    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        return type(self).rows

    def reader(self, schema):
        return _PagedReader(type(self).fetch, int(self.options["total"]), int(self.options.get("page_size", 100)), int(self.options.get("partitions", 256)))


class _PagedReader(DataSourceReader):
    def __init__(self, fetch, total, size, most):
        self.fetch, self.total, self.size, self.most = fetch, total, size, most

    def partitions(self):
        pages = -(-self.total // self.size)
        step = max(1, -(-pages // self.most)) * self.size
        return [InputPartition((at, min(at + step, self.total))) for at in range(0, self.total, step)]

    def read(self, partition):
        start, end = partition.value
        for at in range(start, end, self.size):
            rows = self.fetch(at, self.size)
            want = min(self.size, self.total - at)
            if len(rows) != want:
                raise ValueError(f"page at {at}: {len(rows)} rows, not {want}")
            yield from rows


def paged_source(spark: SparkSession, fetch: Callable[[int, int], list[tuple]], schema: str, total: int, page_size: int = 100, partitions: int = 256) -> DataFrame:
    """All rows of a paged interface: fetch(skip, take) gives a page's. A page that falls short of the total fails. Pages are
    fetched by as many tasks as there are pages, but for `partitions` at most, each of which takes a stretch of them."""
    source = type("PagedRows", (PagedSource,), {"fetch": staticmethod(fetch), "rows": schema})
    spark.dataSource.register(source)
    return spark.read.format("paged").option("total", total).option("page_size", page_size).option("partitions", partitions).load()


class _Walk(DataSourceReader):
    def __init__(self, fetch, start):
        self.fetch, self.start = fetch, start

    def partitions(self):
        return [InputPartition(None)]

    def read(self, partition):
        at = self.start
        while at is not None:
            rows, at = self.fetch(at)
            yield from rows


def walked_source(spark: SparkSession, fetch: Callable[[object], tuple[list[tuple], object]], schema: str, start: object = "") -> DataFrame:
    """All rows of an interface whose next page is only known from the one before: fetch(cursor) gives a page's rows and the
    next cursor, None at the end. Pages follow one another, so one task reads them all, row by row."""
    source = type("WalkedRows", (PagedSource,), {"name": classmethod(lambda cls: "walked"), "rows": schema, "reader": lambda self, schema: _Walk(fetch, start)})
    spark.dataSource.register(source)
    return spark.read.format("walked").load()


def until_empty(fetch: Callable[[int, int], list[tuple]], page_size: int = 100) -> Callable[[int], tuple[list[tuple], int | None]]:
    """fetch(skip, take) as a function for walked_source(start=0): pages until an empty one."""

    def step(skip: int) -> tuple[list[tuple], int | None]:
        rows = fetch(skip, page_size)
        return rows, skip + len(rows) if rows else None

    return step
