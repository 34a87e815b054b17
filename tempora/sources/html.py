"""HTML table extraction as a Spark job (A5).

Pages are rows of a DataFrame and every page is read where it lies, whole,
in one pass over its tags.  Of the first ``<table>`` carrying the CSS class
the rows and cells are taken as a browser sees them: the end tags of cells
and rows may be missing, a table inside a cell is text of that cell, and
``rowspan`` and ``colspan`` repeat a cell over the grid.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the largest spans that HTML allows
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534
_SILENT = {"script", "style"}


def _span(attrs: dict, name: str, most: int) -> int:
    """A span as HTML reads it: 1 where it is no positive number; rowspan 0, to the end of the table, is -1."""
    text = (attrs.get(name) or "").strip()
    if not text.isascii() or not text.isdigit():
        return 1
    n = int(text)
    if n == 0:
        return -1 if name == "rowspan" else 1
    return min(n, most)


class _Table(HTMLParser):
    """The rows of the first table of a class: cells as (text, colspan, rowspan)."""

    def __init__(self, css_class: str):
        super().__init__(convert_charrefs=True)
        self.wanted = set(css_class.split())
        self.rows: list[list[tuple[str, int, int]]] = []
        # tables open from the wanted one on
        self.depth, self.done, self.silent = 0, False, 0
        self.text: list[str] | None = None
        self.span = (1, 1)
        self.in_row = False

    def _end_cell(self):
        if self.text is not None:
            self.rows[-1].append((" ".join("".join(self.text).split()), *self.span))
            self.text = None

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        attrs = dict(attrs)
        if tag in _SILENT:
            self.silent += 1
        if tag == "table" and (self.depth or self.wanted <= set((attrs.get("class") or "").split())):
            self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self._end_cell()
            self.rows.append([])
            self.in_row = True
        elif self.depth == 1 and tag in ("td", "th"):
            self._end_cell()
            if not self.in_row:
                self.rows.append([])
                self.in_row = True
            self.text = []
            self.span = (max(1, _span(attrs, "colspan", MAX_COLSPAN)), _span(attrs, "rowspan", MAX_ROWSPAN))
        elif self.depth == 1 and tag in ("thead", "tbody", "tfoot"):
            self._end_cell()
            self.in_row = False
        elif self.text is not None and tag in ("br", "p", "div", "li", "tr", "td", "th"):
            self.text.append(" ")

    def handle_endtag(self, tag):
        if self.done:
            return
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        if not self.depth:
            return
        if tag == "table":
            self.depth -= 1
            if not self.depth:
                self._end_cell()
                self.done = True
        elif self.depth == 1 and tag in ("td", "th"):
            self._end_cell()
        elif self.depth == 1 and tag in ("tr", "thead", "tbody", "tfoot"):
            self._end_cell()
            self.in_row = False

    def handle_data(self, data):
        if self.text is not None and not self.silent and not self.done:
            self.text.append(data)


def _grid(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """Rows of cells with every span written out; ``held`` are the cells that reach down, by column."""
    out, held = [], {}
    for row in rows:
        line: list[str] = []
        cells = iter(row)
        while True:
            at = len(line)
            if at in held:
                text, left = held[at]
                line.append(text)
                if left == 1:
                    del held[at]
                else:
                    held[at] = (text, left - 1)
                continue
            cell = next(cells, None)
            if cell is None:
                # cells from above may lie further right
                if not held or max(held) < at:
                    break
                line.append("")
                continue
            text, across, down = cell
            for _ in range(across):
                if len(line) in held:
                    break
                if down != 1:
                    held[len(line)] = (text, down - 1 if down > 0 else -1)
                line.append(text)
        out.append(line)
    return out


def table_rows(html: str | None, css_class: str) -> list[list[str]]:
    """The cell texts of the first table of the class, row by row; none without such a table."""
    parser = _Table(css_class)
    parser.feed(html or "")
    parser.close()
    parser._end_cell()
    return _grid(parser.rows)


def extract_html_tables(pages: DataFrame, html: str, css_class: str,
                        ids: Sequence[str]) -> DataFrame:
    """One output row per table row: (ids..., row_no, cells) where
    ``row_no`` counts from 0 (the header row when the table has one) and
    ``cells`` holds the cell texts, white space as single blanks."""
    ids = list(ids)
    found = T.StructField("_rows", T.ArrayType(T.ArrayType(T.StringType())))

    def read(batches):
        for b in batches:
            rows = pa.array([table_rows(x, css_class) for x in b.column(len(ids)).to_pylist()],
                            pa.list_(pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(ids))), rows], [*ids, "_rows"])
    wanted = pages.select(*ids, html)
    schema = T.StructType([*wanted.schema.fields[:-1], found])
    return wanted.mapInArrow(read, schema).select(*ids, F.posexplode("_rows").alias("row_no", "cells"))


def rows_to_frame(rows: DataFrame, ids: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Data rows (header dropped) as columns named ``names``."""
    data = rows.filter(F.col("row_no") > 0)
    return data.select(*ids, *[F.try_element_at("cells", F.lit(i + 1)).alias(n)
                               for i, n in enumerate(names)])
