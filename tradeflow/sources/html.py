"""Tables of HTML pages held in a text column."""

from __future__ import annotations

import bisect
import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

# The page reader travels to the executors inside the job, so that they need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CHUNK = 5000
_REPEATS = 1_000_000  # columns that a cell may be repeated in

_Run = tuple[int, int, str, int]  # from, to, text, rows that it still goes on


class _Table:
    def __init__(self, shown: bool):
        self.shown = shown
        self.rows: list[_Row] = []
        self.has_text = False
        self.in_head = False


class _Row:
    def __init__(self, in_head: bool):
        self.in_head = in_head
        self.cells: list[_Cell] = []


class _Cell:
    def __init__(self, header: bool, attrs: dict[str, str | None]):
        self.header = header
        self.parts: list[str] = []
        self.cols = _span(attrs.get("colspan"))
        self.rows = _span(attrs.get("rowspan"))

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _span(value: str | None) -> int:
    digits = (value or "").strip()
    return max(1, int(digits[:18])) if digits.isdecimal() else 1


class _TableReader(HTMLParser):
    """Collects the tables of one page in document order. The rows of a nested
    table are its own; its text also counts for the cell around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[_Table] = []
        self.open: list[tuple[_Table, list[_Cell]]] = []
        self.muted = 0

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag in ("script", "style"):
            self.muted += 1
        elif tag == "table":
            style = (attrs.get("style") or "").replace(" ", "").lower()
            self.tables.append(_Table("display:none" not in style))
            self.open.append((self.tables[-1], []))
        elif self.open:
            table, cell = self.open[-1]
            if tag == "thead":
                table.in_head = True
            elif tag in ("tbody", "tfoot"):
                table.in_head = False
            elif tag == "tr":
                cell.clear()
                table.rows.append(_Row(table.in_head))
            elif tag in ("td", "th"):
                if not table.rows:
                    table.rows.append(_Row(table.in_head))
                cell[:] = [_Cell(tag == "th", attrs)]
                table.rows[-1].cells.append(cell[0])

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.muted = max(0, self.muted - 1)
        elif self.open:
            table, cell = self.open[-1]
            if tag == "table":
                self.open.pop()
            elif tag == "thead":
                table.in_head = False
            elif tag in ("td", "th", "tr"):
                cell.clear()

    def handle_data(self, data):
        if self.muted:
            return
        for table, cell in self.open:
            table.has_text = table.has_text or not data.isspace()
            if cell:
                cell[0].parts.append(data)


def _put(runs: list[_Run], new: _Run) -> None:
    """Adds a run to ordered ones that do not overlap; it replaces what it covers."""
    start, end = new[:2]
    low = bisect.bisect_right(runs, start, key=lambda r: r[1])
    high = bisect.bisect_left(runs, end, key=lambda r: r[0])
    cut = []
    for a, b, text, rows in runs[low:high]:
        cut += [(a, start, text, rows)] if a < start else []
        cut += [(end, b, text, rows)] if b > end else []
    runs[low:high] = sorted([*cut, new])


def _grid(rows: list[_Row]) -> Iterator[list[_Run]]:
    """Row texts as runs of columns: a cell that spans columns is one run, whatever
    its width, and one that spans rows goes on in the rows below."""
    carried: list[_Run] = []
    for row in rows:
        runs, at = list(carried), 0
        carried = [(a, b, text, n - 1) for a, b, text, n in carried if n > 1]
        for cell in row.cells:
            k = bisect.bisect_right(runs, at, key=lambda r: r[1])
            while k < len(runs) and runs[k][0] <= at:
                at, k = runs[k][1], k + 1
            end, text = at + cell.cols, cell.text()
            _put(runs, (at, end, text, 0))
            if cell.rows > 1:
                _put(carried, (at, end, text, cell.rows - 1))
            at = end
        yield runs


def _columns(runs: list[_Run], named: dict[int, str]) -> Iterator[tuple[int, str]]:
    """Column and text of the runs; one of great width counts for its first column and
    for those that a header names."""
    for start, end, text, _ in runs:
        if end - start <= _REPEATS:
            yield from ((c, text) for c in range(start, end))
        else:
            yield from ((c, text) for c in sorted({start, *(c for c in named if start < c < end)}))


def _header_length(rows: list[_Row]) -> int:
    marked = sum(1 for r in rows if r.in_head)
    if marked:
        return marked
    n = 0
    while n < len(rows) and rows[n].cells and all(c.header for c in rows[n].cells):
        n += 1
    return n


def _names(header: list[_Run]) -> dict[int, str]:
    """Header texts by column, made distinct by a running number."""
    seen: dict[str, int] = {}
    names, at = {}, 0
    for start, end, text, _ in header:
        texts = [(c, "") for c in range(at, min(start, at + _REPEATS))]
        for c, t in [*texts, *_columns([(start, end, text, 0)], {})]:
            n = seen.get(t, 0)
            seen[t] = n + 1
            names[c] = f"{t}.{n}" if n else t
        at = end
    return names


def _rows(page: str, index: int | None, columns: tuple[str, ...]) -> Iterator[dict[str, str]]:
    reader = _TableReader()
    reader.feed(page)
    reader.close()
    tables = [t for t in reader.tables if t.shown and t.has_text]
    for table in tables if index is None else tables[index : index + 1]:
        # Rows marked as head come first, wherever they stand in the source.
        rows = sorted((r for r in table.rows if r.cells), key=lambda r: not r.in_head)
        grid = list(_grid(rows))
        head = _header_length(rows)
        names = _names(grid[head - 1]) if head else {}
        if index is None and not set(columns) <= set(names.values()):
            continue
        for runs in grid[head:]:
            yield {names.get(c, str(c)): t for c, t in _columns(runs, names) if t}
        return


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages ``(page_id, index, html)`` from files below ``path/index=<name>/``."""
    files = spark.read.text(path, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("page_id"),
        F.col("index").cast("string").alias("index"),
        F.col("value").alias("html"),
    )


def html_table(
    pages: DataFrame,
    html_column: str,
    id_column: str,
    index: int | None = 0,
    columns: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of one table per page: ``id_column, row_no, cells``.

    ``index`` counts the visible tables with text; with ``None`` the first table
    whose header has all ``columns`` is taken. ``cells`` maps header text to cell
    text, without the empty cells. A page is parsed whole where it lies; there
    is no shuffle, and output leaves in chunks.
    """
    schema = T.StructType(
        [
            pages.schema[id_column],
            T.StructField("row_no", T.IntegerType()),
            T.StructField("cells", T.MapType(T.StringType(), T.StringType())),
        ]
    )

    def frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=[id_column, "row_no", "cells"])

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for batch in batches:
            for page_id, page in zip(batch[id_column], batch[html_column]):
                for row_no, cells in enumerate(_rows(page or "", index, columns)):
                    out.append((page_id, row_no, cells))
                    if len(out) == _CHUNK:
                        yield frame(out)
                        out = []
        if out:
            yield frame(out)

    return pages.select(id_column, html_column).mapInPandas(extract, schema)


def cell_columns(rows: DataFrame, *names: str) -> DataFrame:
    """Named cells as string columns; null where a row has none."""
    return rows.select(*[F.col("cells")[name].alias(name) for name in names])
