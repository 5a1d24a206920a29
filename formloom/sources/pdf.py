"""PDF files as words and marks, where a library that reads them is installed; without one, the tables are the contract.

Files come from `tables.read_files()`. Each file is read in one task, page by page; a file that cannot be read gives one
row with an error and fails no job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

WORDS = "doc_id string, page_index int, width double, height double, x0 double, y0 double, x1 double, y1 double, word string, block int, error string"
BOX, COLOR = "struct<x0:double,y0:double,x1:double,y1:double>", "struct<r:double,g:double,b:double>"
STYLE = (
    f"struct<subtype:string,text_color:{COLOR},font:string,font_size:double,bold:boolean,italic:boolean,border_width:double,border_style:string,border_color:{COLOR},"
    "opacity:double,rotation:int,printable:boolean,hidden:boolean,rich_text:boolean,author:string,subject:string,modified:string>"
)
MARKS = f"doc_id string, mark_ord int, page_index int, bbox {BOX}, text string, boxed boolean, dashed boolean, fill {COLOR}, da string, flags int, page_width double, page_height double, style {STYLE}, error string"
#: The kinds of annotation that hold text, and the bits of a mark's flags.
TEXT_KINDS, PRINT, HIDDEN, NO_VIEW = ("FreeText", "Square"), 4, 2, 32


def opened(content: bytes) -> Any:
    """The document, by the optional library."""
    import pymupdf

    return pymupdf.open(stream=content, filetype="pdf")


def words_of(document: Any) -> Iterator[dict]:
    """The words of each page that are not blank, y down, in the order in which they are printed."""
    for k, page in enumerate(document):
        for x0, y0, x1, y1, word, block, *_ in page.get_text("words"):
            if word.strip():
                yield {"page_index": k, "width": page.rect.width, "height": page.rect.height, "x0": x0, "y0": y0, "x1": x1, "y1": y1, "word": word, "block": block}


def color(values: Any) -> dict | None:
    """Shares of red, green and blue; of one number, grey."""
    v = list(values or [])
    v = v * 3 if len(v) == 1 else v
    return dict(zip("rgb", map(float, v), strict=True)) if len(v) == 3 else None


def marks_of(document: Any) -> Iterator[dict]:
    """The text marks of each page that say something, y up."""
    from ..functions.text import BOLD_SHORT, BOLD_WORDS, ITALIC_SHORT, ITALIC_WORDS

    n = 0
    for k, page in enumerate(document):
        height = page.rect.height
        for mark in page.annots() or ():
            info, kind = mark.info or {}, mark.type[1]
            if kind not in TEXT_KINDS or not (info.get("content") or "").strip():
                continue
            r, colors, border = mark.rect, mark.colors or {}, mark.border or {}
            key = lambda name: (document.xref_get_key(mark.xref, name) or ("null", ""))[1]  # noqa: B023, E731
            da, dashes, width = key("DA"), border.get("dashes") or (), border.get("width", -1)
            face = da.split("/", 1)[1].split() if "/" in da else []
            low = face[0].lower() if face else ""
            of = lambda whole, short: any(w in low for w in whole) or low in short  # noqa: B023, E731
            style = {
                "subtype": kind, "text_color": color(colors.get("stroke")), "font": face[0] if face else None, "font_size": float(face[1]) if len(face) > 1 and face[1].replace(".", "", 1).isdigit() else None,
                "bold": of(BOLD_WORDS, BOLD_SHORT), "italic": of(ITALIC_WORDS, ITALIC_SHORT), "border_width": float(max(0, width)), "border_style": border.get("style"), "border_color": color(colors.get("stroke")),
                "opacity": float(mark.opacity if mark.opacity >= 0 else 1), "rotation": int(mark.rotation or 0), "printable": bool(mark.flags & PRINT), "hidden": bool(mark.flags & (HIDDEN | NO_VIEW)),
                "rich_text": key("RC") not in ("", "null"), "author": info.get("title") or None, "subject": info.get("subject") or None, "modified": info.get("modDate") or None,
            }
            yield {
                "mark_ord": n, "page_index": k, "bbox": {"x0": r.x0, "y0": height - r.y1, "x1": r.x1, "y1": height - r.y0}, "text": info["content"], "boxed": width > 0, "dashed": bool(dashes),
                "fill": color(colors.get("fill")), "da": da, "flags": int(mark.flags), "page_width": page.rect.width, "page_height": height, "style": style,
            }
            n += 1


def read(files: DataFrame, of: Callable[[Any], Iterator[dict]], schema: str, most: int = 5000) -> DataFrame:
    """Rows of `of` for each file (doc_id, content); a file that fails is one row with its error."""
    names = [part.split()[0] for part in schema.replace(BOX, "b").replace(STYLE, "s").replace(COLOR, "c").split(", ")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for doc_id, content in zip(part["doc_id"], part["content"], strict=True):
                rows: list[dict] = []
                try:
                    for r in of(opened(bytes(content))):
                        rows.append({"doc_id": doc_id, "error": None} | r)
                        if len(rows) >= most:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                except ImportError:
                    raise
                except Exception as e:  # noqa: BLE001  a damaged file is the file's matter
                    rows.append({"doc_id": doc_id, "error": f"{type(e).__name__}: {e}"})
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return files.select("doc_id", "content").mapInPandas(run, schema)


def read_words(files: DataFrame) -> DataFrame:
    """Words with their page's size; assign_lines() gives them lines."""
    return read(files, words_of, WORDS)


def read_marks(files: DataFrame) -> DataFrame:
    """Marks with their style."""
    return read(files, marks_of, MARKS)
