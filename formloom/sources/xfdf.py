"""Annotations as exchange XML, one text for each document, and back."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G

#: The format's name space, colours of what has no fill, and the appearance of a text: on a fill, of notes, of others.
SPACE = "http://ns.adobe.com/xfdf/"
NOTE_GREY, RED = "#7A7A7A", "#CC0D0D"
ON_FILL, GREY_TEXT, RED_TEXT = "/Helv 7 Tf 0 0 0 rg", "/Helv 7 Tf 0.48 0.48 0.48 rg", "/Helv 7 Tf 0.8 0.05 0.05 rg"
META = ["row_id", "slot", "group_id", "member_row_ids", "domain", "variable", "condition", "fixed_value", "codelist", "origin", "confidence", "suggested", "review_status", "reviewed_by", "rationale"]


def escaped(text: Column) -> Column:
    out = F.coalesce(text.cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def attribute(name: str, value: Column) -> Column:
    """Omitted where there is no value."""
    return F.when((F.coalesce(value.cast("string"), F.lit("")) != ""), F.concat(F.lit(f' {name}="'), escaped(value), F.lit('"'))).otherwise("")


def pdf_date(at: Column) -> Column:
    """A time as the format has dates, in UTC."""
    return F.date_format(F.to_utc_timestamp(at.cast("timestamp"), F.current_timezone()), "'D:'yyyyMMddHHmmss'Z'")


def texts(annotations: DataFrame, href: str | None = None) -> DataFrame:
    """(doc_id, xfdf) of annotations that are not rejected: doc_id, annot_id, page_index, bbox, shown, kind, color, and as far
    as they are there META, source_model and created_at.

    In order of page, down and across. A colour is the annotation's, or grey for notes, or red; the text is black on a
    fill. A group's members and what a reviewer needs stand in `meta`. `href` is the column that names the form's file.
    """
    a = annotations.filter("review_status is null or review_status <> 'rejected'")
    kinds = dict(a.dtypes)
    cell = {c: F.col(c).cast("string") if c in kinds else F.lit(None).cast("string") for c in (*META, "source_model", "created_at")}
    if kinds.get("member_row_ids", "").startswith("array"):
        cell["member_row_ids"] = F.array_join("member_row_ids", " ")
    if "confidence" in kinds:
        cell["confidence"] = F.regexp_replace(F.format_string("%.6f", F.col("confidence").cast("double")), r"\.?0+$", "")
        cell["confidence"] = F.when(F.col("confidence").isNotNull(), cell["confidence"])
    if "suggested" in kinds:
        cell["suggested"] = F.when(F.col("suggested"), "true")
    quiet = (F.col("kind") == "note") | (F.col("shown") == "")
    color = F.coalesce("color", F.when(quiet, NOTE_GREY).otherwise(RED))
    appearance = F.when(F.col("color").isNotNull(), ON_FILL).when(quiet, GREY_TEXT).otherwise(RED_TEXT)
    date = pdf_date(F.col("created_at")) if "created_at" in kinds else F.lit(None)
    meta = F.concat(F.lit("<meta"), *[attribute(c, cell[c]) for c in META], F.lit("/>"))
    one = F.concat(
        F.lit('<freetext page="'), F.col("page_index").cast("string"), F.lit('" rect="'), G.rect_text(F.col("bbox")), F.lit('"'), attribute("name", F.col("annot_id")), attribute("color", color), F.lit(' flags="print"'),
        attribute("title", cell["source_model"]), attribute("subject", F.col("kind")), attribute("date", date), F.lit("><contents>"), escaped(F.col("shown")), F.lit("</contents><defaultappearance>"), appearance, F.lit("</defaultappearance>"), meta, F.lit("</freetext>"),
    )
    order = F.struct("page_index", (-F.col("bbox.y1")).alias("y"), F.col("bbox.x0").alias("x"), "annot_id", one.alias("t"))
    told = F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda o: o["t"]), "")
    file = F.lit("") if href is None else F.concat(F.lit("<f"), attribute("href", F.element_at(F.split(F.first(href), "/"), -1)), F.lit("/>"))
    return a.groupBy("doc_id").agg(F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?><xfdf xmlns="{SPACE}" xml:space="preserve">'), file, F.lit("<annots>"), told, F.lit("</annots></xfdf>")).alias("xfdf"))


def annotations_of(parsed: DataFrame) -> DataFrame:
    """Annotations from parse()'s rows without an error: what texts() wrote, as columns of their own types again."""
    at = lambda c: F.col("meta")[c]
    kinds = {"slot": "int", "confidence": "double"}
    fields = [at(c).try_cast(kinds.get(c, "string")).alias(c) for c in META if c not in ("member_row_ids", "suggested")]
    members = F.filter(F.split(F.coalesce(at("member_row_ids"), F.lit("")), " "), lambda x: x != "").alias("member_row_ids")
    return parsed.filter("error is null").select(
        "doc_id", F.col("name").alias("annot_id"), "page_index", "bbox", F.col("contents").alias("shown"), F.coalesce("subject", F.lit("variable")).alias("kind"), "color", F.col("title").alias("source_model"), members,
        F.coalesce(at("suggested") == "true", F.lit(False)).alias("suggested"), *fields,
    )


def parse(docs: DataFrame, text: str = "xfdf") -> DataFrame:
    """(doc_id, page_index, rect, name, color, title, subject, contents, meta, error, bbox) of free texts and squares, with or
    without name space.

    A mark without a rectangle of four numbers or with a page that is no number, and a text that is no XML, are rows with
    an error.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "page", "rect", "name", "color", "title", "subject", "contents", "meta", "error"]
    schema = f"doc_id {kind}, " + ", ".join(f"{c} {'map<string,string>' if c == 'meta' else 'string'}" for c in columns[1:])

    def local(tag: str) -> str:
        return tag.rpartition("}")[2].lower()

    def read(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for page in pages:
            out = []
            for doc_id, xml in zip(page["doc_id"], page[text], strict=True):
                try:
                    root = ET.fromstring(xml or "")
                except ET.ParseError as e:
                    out.append((doc_id, *[None] * 8, f"no XML: {e}"))
                    continue
                for mark in root.iter():
                    if local(mark.tag) in ("freetext", "square"):
                        inner = {local(x.tag): x for x in mark}
                        meta = dict(inner["meta"].attrib) if "meta" in inner else {}
                        contents = "".join(inner["contents"].itertext()) if "contents" in inner else ""
                        out.append((doc_id, mark.get("page", "0"), *[mark.get(c) for c in columns[2:7]], contents, meta, None))
            yield pd.DataFrame(out, columns=columns)

    told = docs.select("doc_id", text).mapInPandas(read, schema)
    told = told.withColumns({"page_index": F.trim("page").try_cast("int"), "bbox": G.parse_rect(F.col("rect"))})
    wrong = F.when(F.col("rect").isNull() | (F.col("rect") == ""), "no rectangle").when(F.col("bbox").isNull(), F.concat(F.lit("no rectangle of four numbers: "), F.col("rect")))
    wrong = wrong.when(F.col("page_index").isNull() | (F.col("page_index") < 0), F.concat(F.lit("no page: "), F.col("page")))
    return told.withColumn("error", F.coalesce("error", wrong)).select("doc_id", "page_index", *columns[2:], "bbox")
