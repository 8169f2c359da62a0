"""Spreadsheets with the standard library: reading them in Spark tasks, and a writer."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Width of a column in characters, least and most.
WIDTH = (12, 60)


def _column(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _letters(n: int) -> str:
    s = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        s = chr(65 + r) + s
    return s


def rows_of(data: bytes, sheet: str | None = None) -> list[list[str]]:
    """The cells of a sheet (the first, or the one named) as texts; empty cells are ''."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        book = ET.fromstring(z.read("xl/workbook.xml"))
        sheets = [(s.get("name"), s.get(_REL)) for s in book.find("m:sheets", _NS)]
        rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = next((r for n, r in sheets if sheet is None or n == sheet), sheets[0][1])
        where = rels[target].lstrip("/")
        root = ET.fromstring(z.read(where if where.startswith("xl/") else f"xl/{where}"))
    out = []
    for row in root.iter(f"{{{_NS['m']}}}row"):
        cells: list[str] = []
        for k, c in enumerate(row.findall("m:c", _NS)):
            at = _column(c.get("r")) if c.get("r") else k
            cells += [""] * (at - len(cells))
            v, kind = c.find("m:v", _NS), c.get("t")
            if kind == "inlineStr":
                value = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
            elif v is None:
                value = ""
            else:
                value = shared[int(v.text)] if kind == "s" else v.text or ""
            cells.append(value)
        out.append(cells)
    return out


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A sheet as a table of strings, the first row naming the columns; empty cells are ''.

    Read through Spark's file systems; a file is one task, as spreadsheets are bounded
    by their format. The older binary format (.xls) can't be read: a ValueError.
    """
    files = spark.read.format("binaryFile").load(path)
    kinds = files.select((F.substring("content", 1, 2) == F.lit(b"PK")).alias("zip")).collect()
    if not all(k["zip"] for k in kinds):
        raise ValueError(f"not a spreadsheet of the zipped format, save it as .xlsx or CSV: {path}")
    head = files.select("content").mapInPandas(lambda b: _sheet_rows(b, sheet, True), "cells array<string>").first()
    names = [h or f"_c{i}" for i, h in enumerate(head["cells"])] if head else []
    rows = files.select("content").mapInPandas(lambda b: _sheet_rows(b, sheet, False), "cells array<string>")
    return rows.select(*(F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)))


def _sheet_rows(batches: Iterator[pd.DataFrame], sheet: str | None, header: bool) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for content in pdf["content"]:
            rows = rows_of(bytes(content), sheet)
            yield pd.DataFrame({"cells": rows[:1] if header else rows[1:]})


def _cell(ref: str, value: object, style: int = 0) -> str:
    s = f' s="{style}"' if style else ""
    if value is None:
        return ""
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(value))
        return f'<c r="{ref}"{s} t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'
    return f'<c r="{ref}"{s}><v>{value}</v></c>'


def workbook(sheets: dict[str, tuple[Sequence[str], Iterable[Sequence[object]]]]) -> bytes:
    """A workbook of named sheets (header, rows): bold grey header, first row frozen, widths from the contents."""
    main, rel = _NS["m"], "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pkg = "http://schemas.openxmlformats.org/package/2006"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        names = []
        for k, (name, (header, rows)) in enumerate(sheets.items(), 1):
            names.append(name[:31])
            lines, widths = [], [len(str(h)) for h in header]
            for r, row in enumerate([header, *rows], 1):
                for i, v in enumerate(row[: len(widths)]):
                    widths[i] = max(widths[i], len(str(v)) if v is not None else 0)
                lines.append(f'<row r="{r}">' + "".join(_cell(f"{_letters(i)}{r}", v, int(r == 1)) for i, v in enumerate(row)) + "</row>")
            cols = "".join(f'<col min="{i}" max="{i}" width="{min(max(w + 2, WIDTH[0]), WIDTH[1])}" customWidth="1"/>' for i, w in enumerate(widths, 1))
            pane = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>'
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{main}">{pane}{f"<cols>{cols}</cols>" if cols else ""}<sheetData>{"".join(lines)}</sheetData></worksheet>')
        listed = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{k}" Type="{rel}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{pkg}/relationships">{rels}<Relationship Id="rIdS" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="3"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill><fill><patternFill patternType="solid"><fgColor rgb="FFD9D9D9"/></patternFill></fill></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" fillId="2" applyFont="1" applyFill="1"/></cellXfs></styleSheet>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{pkg}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{kind}.worksheet+xml"/>' for k in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'<Types xmlns="{pkg}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{parts}</Types>')
    return out.getvalue()


def write_workbook(sheets: dict[str, DataFrame], path: str, most_rows: int = 1_048_575) -> None:
    """Write tables as sheets; a sheet has a format's limit of rows, beyond which writing fails rather than drops rows."""
    ready = {}
    for name, df in sheets.items():
        rows = [tuple(r) for r in df.limit(most_rows + 1).collect()]
        if len(rows) > most_rows:
            raise ValueError(f"sheet {name!r} has more than {most_rows} rows; write it as Parquet")
        ready[name] = (df.columns, rows)
    with open(path, "wb") as f:
        f.write(workbook(ready))
