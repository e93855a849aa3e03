"""HTML documents to table rows.

Files are listed and read by Spark; the only Python on the executors is the extraction of
the cells of the first table of each document. Typing and filtering are column expressions.
"""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.columns import number

#: Rows that a task gathers before it hands them on.
BUFFER_ROWS = 4096

_QUOTED = rb"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
#: What a page consists of before its text is known: comments, elements whose content is no markup, tags.
_MARKUP = re.compile(
    rb"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|title|textarea)\b" + _QUOTED + rb">.*?(?:</(?P=raw)|\Z)"
    rb"|<meta(?P<meta>[\s/]" + _QUOTED + rb")>|</?[a-z]" + _QUOTED + rb">",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(rb"""([^\s/>"'=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")
_IN_CONTENT = re.compile(rb"charset\s*=\s*[\"']?([^\s\"';]+)", re.IGNORECASE)
_MARKS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))


def _span(text: str | None) -> int:
    """A declared span; anything but ASCII digits counts as one cell."""
    text = (text or "").strip()
    return max(int(text), 1) if text.isascii() and text.isdecimal() else 1


class _TableRead(Exception):
    """The first table of the document is complete."""


class _FirstTable(HTMLParser):
    """Cells of the first table; nested tables count as text of their cell."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[tuple[str, int, int]]] = []
        self.depth, self.hidden = 0, 0
        self.cell: list[str] | None = None
        self.span = (1, 1)

    def _end_cell(self) -> None:
        if self.cell is not None:
            text = " ".join("".join(self.cell).split())
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append((text, *self.span))
            self.cell = None

    def handle_starttag(self, tag, attrs) -> None:
        if tag == "table":
            self.depth += 1
        if tag in ("script", "style"):
            self.hidden += 1
        if self.depth != 1:
            return
        if tag == "tr":
            self._end_cell()
            self.rows.append([])
        elif tag in ("td", "th"):
            self._end_cell()
            sizes = dict(attrs)
            self.span = (_span(sizes.get("colspan")), _span(sizes.get("rowspan")))
            self.cell = []
        elif tag == "br" and self.cell is not None:
            self.cell.append(" ")

    def handle_endtag(self, tag) -> None:
        if tag in ("script", "style"):
            self.hidden = max(self.hidden - 1, 0)
        if self.depth == 1 and tag in ("td", "th", "tr"):
            self._end_cell()
        if tag == "table" and self.depth:
            self.depth -= 1
            if self.depth == 0:
                self._end_cell()
                raise _TableRead

    def handle_data(self, data) -> None:
        if self.cell is not None and not self.hidden:
            self.cell.append(data)


def declared_charset(content: bytes) -> str | None:
    """The encoding that a page declares: its byte-order mark, else the first meta tag with ``charset`` or
    with ``http-equiv`` content type, wherever it stands. Text, comments, scripts and the attributes of
    other tags declare nothing."""
    for mark, encoding in _MARKS:
        if content.startswith(mark):
            return encoding
    for tag in _MARKUP.finditer(content):
        if tag["meta"] is None:
            continue
        found = {a[1].lower(): a[2] or a[3] or a[4] or b"" for a in _ATTRIBUTE.finditer(tag["meta"])}
        name = found.get(b"charset")
        if name is None and found.get(b"http-equiv", b"").strip().lower() == b"content-type":
            inside = _IN_CONTENT.search(found.get(b"content", b""))
            name = inside and inside[1]
        if name:
            return name.strip().decode("latin-1")
    return None


def _decode(content: bytes) -> str:
    declared = declared_charset(content)
    for encoding in ([declared] if declared else []) + ["utf-8"]:
        try:
            return content.decode(encoding)
        except (LookupError, UnicodeDecodeError):
            continue
    return content.decode("cp1252", "replace")


def table_rows(content: bytes | str, width: int | None = None) -> list[list[str | None]]:
    """Rows of the first table with spans filled in; an empty cell is None.

    With a ``width`` no row may be wider: a small page cannot expand without bound.
    """
    parser = _FirstTable()
    with contextlib.suppress(_TableRead):
        parser.feed(content if isinstance(content, str) else _decode(content))
        parser.close()
    parser._end_cell()
    grid: list[list[str | None]] = []
    pending: dict[int, tuple[int, str]] = {}
    for cells in parser.rows:
        row: list[str] = []
        waiting = list(cells)
        carried: dict[int, tuple[int, str]] = {}
        while waiting or len(row) in pending:
            if len(row) in pending:
                left, text = pending.pop(len(row))
                if left > 1:
                    carried[len(row)] = (left - 1, text)
                row.append(text)
                continue
            text, wide, tall = waiting.pop(0)
            if width is not None and len(row) + wide > width:
                raise ValueError(f"a row spans more than {width} columns")
            for _ in range(wide):
                if tall > 1:
                    carried[len(row)] = (tall - 1, text)
                row.append(text)
        pending = {**pending, **carried}
        if row:
            grid.append([c or None for c in row])
    return grid


def html_tables(
    documents: DataFrame,
    columns: Sequence[str],
    skip_rows: int,
    keys: Sequence[str] = ("path",),
    content: str = "content",
) -> DataFrame:
    """Text cells of the first table of every document, one row per table row.

    ``keys`` are the columns of a document that its rows keep; the first one names it. A page
    without a table or with another number of columns fails the job with that name.
    """
    names, keys, width = list(columns), list(keys), len(columns)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, name = batch.column(len(keys)), batch.column(0)
            owner: list[int] = []
            number: list[int] = []
            cells: list[list[str | None]] = [[] for _ in names]
            for k in range(batch.num_rows):
                data = pages[k].as_py() or ""
                try:
                    rows = table_rows(data, width)
                except ValueError as error:
                    raise ValueError(f"{name[k].as_py()}: {error}") from error
                if max((len(r) for r in rows), default=0) != width:
                    raise ValueError(f"{name[k].as_py()}: expected a table of {width} columns")
                for i, row in enumerate(rows[skip_rows:], 1):
                    owner.append(k), number.append(i)
                    for c, column in enumerate(cells):
                        column.append(row[c] if c < len(row) else None)
                if len(owner) >= BUFFER_ROWS or k == batch.num_rows - 1:
                    taken = [batch.column(c).take(pa.array(np.array(owner, np.int64))) for c in range(len(keys))]
                    texts = [pa.array(c, pa.string()) for c in cells]
                    columns = [*taken, pa.array(number, pa.int32()), *texts]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keys, "fila", *names])
                    owner, number, cells = [], [], [[] for _ in names]

    schema = T.StructType(
        [documents.schema[k] for k in keys]
        + [T.StructField("fila", T.IntegerType())]
        + [T.StructField(n, T.StringType()) for n in names]
    )
    return documents.select(*keys, content).mapInArrow(extract, schema)


def typed(
    rows: DataFrame, numbers: Sequence[str], decimal: str = ".", thousands: str = ","
) -> DataFrame:
    """Number columns typed; text that is not a number becomes NULL."""
    return rows.withColumns({n: number(n, decimal, thousands) for n in numbers})


def read_pages(spark: SparkSession, folder: str, glob: str, pattern: str) -> DataFrame:
    """Files whose name matches, with their bytes and the groups of the name as an array.

    ``pattern`` is applied to the whole name; other files of the folder are ignored.
    """
    pages = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    groups = [F.regexp_extract("fichero", pattern, i) for i in range(1, re.compile(pattern).groups + 1)]
    return (
        pages.select("path", "modificationTime", "content", name.alias("fichero"))
        .filter(F.col("fichero").rlike(f"^{pattern}$"))
        .withColumn("partes", F.array(*groups))
    )
