"""S3: read the first sheet of many .xlsx workbooks as one DataFrame.

Spark has no spreadsheet source, so each workbook is one ``binaryFile``
record and ``mapInPandas`` parses it inside the executors with the standard
library (a workbook is a zip of XML parts). Cells are returned as text and
typed afterwards with built-in expressions: a date column accepts an Excel
day serial or ISO text. Columns are bound by position after the header row
(the source job does the same); a blank text cell is NULL (ledger Q14) and a
row with no value at all is skipped.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}
EXCEL_EPOCH = "1899-12-30"     # day 0 of the 1900 date system (after the leap-year quirk)
_REF = re.compile(r"([A-Z]+)")


def _col_index(ref: str) -> int:
    letters = _REF.match(ref).group(1)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{NS['m']}}}t"))


def _first_sheet_path(z: zipfile.ZipFile) -> str:
    try:
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        first = wb.find("m:sheets/m:sheet", NS)
        rid = first.get(f"{{{NS['r']}}}id")
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        for rel in rels.findall("pr:Relationship", NS):
            if rel.get("Id") == rid:
                target = rel.get("Target").lstrip("/")
                return target if target.startswith("xl/") else "xl/" + target
    except KeyError:
        pass
    return "xl/worksheets/sheet1.xml"


def parse_first_sheet(content: bytes) -> list[list[str | None]]:
    """All rows of the first sheet as lists of text (None for empty cells)."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in sst.findall("m:si", NS)]
        rows: list[list[str | None]] = []
        with z.open(_first_sheet_path(z)) as f:
            for _, el in ET.iterparse(f):
                if el.tag != f"{{{NS['m']}}}row":
                    continue
                cells: dict[int, str | None] = {}
                for i, c in enumerate(el.findall("m:c", NS)):
                    idx = _col_index(c.get("r")) if c.get("r") else i
                    kind = c.get("t", "n")
                    v = c.find("m:v", NS)
                    if kind == "s":
                        val = shared[int(v.text)] if v is not None else None
                    elif kind == "inlineStr":
                        is_ = c.find("m:is", NS)
                        val = _text(is_) if is_ is not None else None
                    elif kind == "b":
                        val = None if v is None else ("true" if v.text == "1" else "false")
                    else:
                        val = v.text if v is not None else None
                    cells[idx] = val if val not in ("",) else None
                width = max(cells) + 1 if cells else 0
                rows.append([cells.get(i) for i in range(width)])
                el.clear()
        return rows


def _parse_batches(ncols: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                rows = [r for r in parse_first_sheet(bytes(content)) if any(x is not None for x in r)]
                for r in rows[1:]:                      # first non-empty row is the header
                    r = (r + [None] * ncols)[:ncols]
                    out.append([path.rsplit("/", 1)[-1], *r])
            yield pd.DataFrame(out, columns=["file_name", *[f"c{i}" for i in range(ncols)]],
                               dtype=object)
    return run


def _typed(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        serial = c.rlike(r"^[0-9]+(\.[0-9]+)?$")
        return F.when(serial, F.date_add(F.lit(EXCEL_EPOCH).cast("date"),
                                         F.floor(c.cast("double")).cast("int"))) \
                .otherwise(F.to_date(c))
    if isinstance(dtype, T.StringType):
        return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)
    return c.cast(dtype)


def read_workbooks(spark: SparkSession, paths, schema: T.StructType) -> DataFrame:
    """First sheet of every workbook at ``paths`` (files, folders or globs),
    columns bound by position to ``schema``; adds ``file_name``."""
    ncols = len(schema.fields)
    raw_schema = T.StructType([T.StructField("file_name", T.StringType())] +
                              [T.StructField(f"c{i}", T.StringType()) for i in range(ncols)])
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    raw = files.mapInPandas(_parse_batches(ncols), raw_schema)
    return raw.select("file_name", *[_typed(F.col(f"c{i}"), f.dataType).alias(f.name)
                                     for i, f in enumerate(schema.fields)])
