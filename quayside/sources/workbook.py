"""Workbook files (xlsx) as rows: one file per record, parsed inside the tasks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "path string, sheet string, row_no long, cells map<string,string>"

# XML namespaces of the file format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{MAIN}t"))


def _sheet_rows(archive: zipfile.ZipFile, part: str, shared: list[str]) -> Iterator[tuple[int, dict]]:
    """Rows of one sheet, streamed: (row number, column letter -> text)."""
    with archive.open(part) as f:
        for _, row in ElementTree.iterparse(f):
            if row.tag != f"{MAIN}row":
                continue
            cells = {}
            for c in row.iter(f"{MAIN}c"):
                value = c.find(f"{MAIN}v")
                if c.get("t") == "inlineStr":
                    text = _text(c)
                elif value is None:
                    continue
                else:
                    text = shared[int(value.text)] if c.get("t") == "s" else value.text
                cells[re.match("[A-Z]+", c.get("r")).group()] = text
            yield int(row.get("r")), cells
            row.clear()


def _workbook_rows(path: str, content: bytes) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        names = archive.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = [_text(si) for si in ElementTree.fromstring(archive.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")]
        links = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target").lstrip("/") for r in links.iter(f"{PACKAGE}Relationship")}
        for sheet in ElementTree.fromstring(archive.read("xl/workbook.xml")).iter(f"{MAIN}sheet"):
            target = targets[sheet.get(f"{REL}id")]
            part = target if target.startswith("xl/") else f"xl/{target}"
            for number, cells in _sheet_rows(archive, part, shared):
                yield path, sheet.get("name"), number, cells


def read_workbooks(spark: SparkSession, path: str, sheet: str | None = None, batch: int = 5000) -> DataFrame:
    """Rows of all workbooks under `path`: path, sheet, row_no, cells by column letter."""

    def parse(frames):
        rows = []
        for frame in frames:
            for p, content in zip(frame["path"], frame["content"]):
                for row in _workbook_rows(p, content):
                    if sheet is None or row[1] == sheet:
                        rows.append(row)
                    if len(rows) >= batch:
                        yield pd.DataFrame(rows, columns=["path", "sheet", "row_no", "cells"])
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["path", "sheet", "row_no", "cells"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return files.select("path", "content").mapInPandas(parse, SCHEMA)


def with_header(rows: DataFrame, header: dict[str, str], first_row: int = 2) -> DataFrame:
    """Named text columns from the cell letters, below the header row."""
    return rows.filter(F.col("row_no") >= first_row).select(
        "path", "sheet", "row_no", *[F.col("cells")[letter].alias(name) for letter, name in header.items()]
    )
