"""Control sheets as workbooks, with the standard library alone: one sheet named annotations."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import review

SHEET = "annotations"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def letters(n: int) -> str:
    """A column's letters, from 0."""
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def workbook(rows: list[list[str]], lists: dict[int, list[str]]) -> bytes:
    """A workbook of text cells; the first row stays in view; columns with lists take only their values."""
    cells = "".join(f'<row r="{r}">' + "".join(f'<c r="{letters(c)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' for c, v in enumerate(row) if v) + "</row>" for r, row in enumerate(rows, 1))
    checks = "".join(f'<dataValidation type="list" allowBlank="1" sqref="{letters(c)}2:{letters(c)}{max(2, len(rows))}"><formula1>"{escape(",".join(v))}"</formula1></dataValidation>' for c, v in lists.items())
    sheet = f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews><sheetData>{cells}</sheetData>' + (f'<dataValidations count="{len(lists)}">{checks}</dataValidations>' if lists else "") + "</worksheet>"
    parts = {
        "[Content_Types].xml": '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="{SHEET}" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": sheet,
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), text)
    return out.getvalue()


def cells_of(content: bytes) -> list[tuple[int, dict[int, str]]]:
    """(row number, text by column) of the sheet named annotations, or the first."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{{{_MAIN}}}t")) for s in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{{{_MAIN}}}si")]
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        sheets = list(ET.fromstring(z.read("xl/workbook.xml")).iter(f"{{{_MAIN}}}sheet"))
        chosen = next((s for s in sheets if s.get("name") == SHEET), sheets[0])
        target = targets[chosen.get(f"{{{_REL}}}id")].lstrip("/")
        root = ET.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
    out = []
    for row in root.iter(f"{{{_MAIN}}}row"):
        told = {}
        for c in row.iter(f"{{{_MAIN}}}c"):
            n = 0
            for x in re.match("[A-Z]+", c.get("r"))[0]:
                n = n * 26 + ord(x) - 64
            if c.get("t") == "inlineStr":
                told[n - 1] = "".join(t.text or "" for t in c.iter(f"{{{_MAIN}}}t"))
            elif (v := c.find(f"{{{_MAIN}}}v")) is not None:
                told[n - 1] = shared[int(v.text)] if c.get("t") == "s" else v.text or ""
        out.append((int(row.get("r")), told))
    return out


def workbooks(sheet: DataFrame) -> DataFrame:
    """(doc_id, content): review.sheet() as a workbook for each document, its rows in order; a document is one task's group."""
    told = sheet.select("doc_id", "row_ord", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in sheet.columns else F.lit("").alias(c) for c in review.COLUMNS])
    status, origin = review.COLUMNS.index("review_status"), review.COLUMNS.index("origin")

    def write(key: tuple, page: pd.DataFrame) -> pd.DataFrame:
        rows = page.sort_values("row_ord")[review.COLUMNS].to_numpy().tolist()
        return pd.DataFrame({"doc_id": [key[0]], "content": [workbook([review.COLUMNS, *rows], {status: review.STATUSES, origin: T.ORIGINS})]})

    return told.groupBy("doc_id").applyInPandas(write, f"doc_id {sheet.schema['doc_id'].dataType.simpleString()}, content binary")


def lines(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, errors) of workbooks (doc_id, content): review.read_lines() with excel_row; files that lack a column or are no workbook."""
    kind = files.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, excel_row int, error string, " + ", ".join(f"`{c}` string" for c in review.COLUMNS)

    def read(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for page in pages:
            out = []
            for doc_id, content in zip(page["doc_id"], page["content"], strict=True):
                try:
                    told = cells_of(content)
                except (zipfile.BadZipFile, KeyError, IndexError, ValueError, TypeError, ET.ParseError) as e:
                    out.append((doc_id, None, f"no workbook: {type(e).__name__}", *[None] * len(review.COLUMNS)))
                    continue
                head = {v.strip(): k for k, v in (told[0][1] if told else {}).items()}
                lacks = [c for c in review.COLUMNS if c not in head]
                if lacks:
                    out.append((doc_id, None, "missing columns: " + ", ".join(lacks), *[None] * len(review.COLUMNS)))
                    continue
                out += [(doc_id, n, None, *[cells.get(head[c], "") for c in review.COLUMNS]) for n, cells in told[1:]]
            yield pd.DataFrame(out, columns=["doc_id", "excel_row", "error", *review.COLUMNS])

    every = files.select("doc_id", "content").mapInPandas(read, schema)
    return review.read_lines(every.filter("error is null").drop("error")), every.filter("error is not null").select("doc_id", "error")
