"""Auction exports that are HTML under a workbook's name: their largest table, its header, and what stands above it."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of a header cell, rows that are searched for them, and the places of the sale's name and date (row, label, value) with the labels' beginnings.
HEADER_WORDS, HEADER_ROWS = ("nº lote", "nºlote", "numero de lote"), 15
NAME, DATE = (1, 1, 2, "nombre de subasta"), (4, 4, 5, "fecha")


class _Tables(HTMLParser):
    """Cells of all tables; a table inside another one is a table of its own."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self.open, self.cell = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
            self.open.append(self.tables[-1])
            self.cell = 0
        elif tag == "tr" and self.open:
            self.open[-1].append([])
            self.cell = 0
        elif tag in ("td", "th") and self.open:
            if not self.open[-1]:
                self.open[-1].append([])
            self.open[-1][-1].append("")
            self.cell = 1
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag == "table" and self.open:
            self.open.pop()
            self.cell = 0
        elif tag in ("td", "th", "tr"):
            self.cell = 0

    def handle_data(self, data):
        if self.cell and self.open and self.open[-1] and self.open[-1][-1]:
            self.open[-1][-1][-1] += data


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            parser = _Tables()
            try:
                parser.feed((content or b"").decode("utf-8"))
            except UnicodeDecodeError:
                parser = _Tables()
                parser.feed(content.decode("latin-1"))
            rows = max(parser.tables, key=len, default=[])
            cells = [[" ".join(c.split()) or None for c in r] for r in rows]
            if cells:
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(cells)), pa.array(range(len(cells)), pa.int32()), pa.array(cells, pa.list_(pa.string()))], names=["path", "row", "cells"])


def html_exports(spark: SparkSession, folder: str, pattern: str = "*.{xls,xlsx,html,htm}") -> DataFrame:
    """(path, row, cells, nombre_subasta, fecha_subasta) of the lots in all HTML exports below a folder.

    Of each file the table with most rows counts. ``cells`` is a map from the header's words to the row's; the header
    is the first of the first HEADER_ROWS rows with a cell that holds one of HEADER_WORDS, and rows after it are lots. Without
    one all rows are, under their places ("0", "1", ...). Of equal header words the last one's cell stays, cells beyond the
    header drop out, missing ones are null. Name and date of the sale stand at fixed places above. Files without a
    table, and true workbooks, give no rows. A file is read by one task, and its rows are joined to its header alone.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    rows = files.where(~F.startswith(F.substring("content", 1, 2).cast("string"), F.lit("PK"))).select("path", "content").mapInArrow(_rows, "path string, row int, cells array<string>")

    def at(place: tuple[int, int, int, str]):
        row, label, value, begins = place
        return F.max(F.when((F.col("row") == row) & F.startswith(F.lower(F.get("cells", F.lit(label))), F.lit(begins)), F.get("cells", F.lit(value))))

    word = F.exists("cells", lambda c: F.coalesce(F.exists(F.array(*map(F.lit, HEADER_WORDS)), lambda w: F.contains(F.lower(c), w)), F.lit(False)))
    head = F.min(F.when(word & (F.col("row") < HEADER_ROWS), F.struct("row", "cells")))
    heads = rows.groupBy("path").agg(head.alias("head"), F.max(F.size("cells")).alias("width"), at(NAME).alias("nombre_subasta"), at(DATE).alias("fecha_subasta"))
    places = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: i.cast("string"))
    found = rows.join(heads, "path").where(F.col("head").isNull() | (F.col("row") > F.col("head.row"))).where(F.exists("cells", lambda c: c.isNotNull()))
    names = F.transform(F.coalesce("head.cells", places), lambda c, i: F.coalesce(c, i.cast("string")))
    pairs = F.transform(names, lambda n, i: F.struct(n.alias("k"), F.get("cells", i).alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return found.select("path", "row", F.map_from_entries(last).alias("cells"), "nombre_subasta", "fecha_subasta")
