"""Colours by the order in which a form's domains are first met.

annotations: doc_id, row_id, page_index, kind, domain, origin, shown, x0, y1 (of the box), ord; rows: doc_id, row_id, form, row_ord.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

#: The palette, which starts anew when it ends, and the colour of what is not submitted.
PALETTE = [(191, 255, 255), (255, 255, 150), (150, 255, 150), (255, 190, 155)]
GREY = (204, 204, 204)


def palette(rank: Column) -> Column:
    """The colour of a rank from 1, as #RRGGBB."""
    table = F.array(*[F.lit("#%02X%02X%02X" % c) for c in PALETTE])
    return F.element_at(table, (F.pmod(rank - 1, F.lit(len(PALETTE))) + 1).cast("int"))


def forms_in_order(rows: DataFrame) -> DataFrame:
    """(doc_id, place, form): a document's forms as they are first met, from 1; rows without one don't count."""
    first = rows.filter("form <> ''").groupBy("doc_id", "form").agg(F.min("row_ord").alias("_first"))
    return first.select("doc_id", F.row_number().over(W.partitionBy("doc_id").orderBy("_first")).alias("place"), "form")


def with_form(annotations: DataFrame, rows: DataFrame) -> DataFrame:
    """Annotations with the form of their row, or the first on their page, or ""."""
    own = rows.filter("form <> ''").select("doc_id", "row_id", F.col("form").alias("_own"))
    page = rows.filter("form <> ''").groupBy("doc_id", "page_index").agg(F.min_by("form", "row_ord").alias("_page"))
    out = annotations.join(own, ["doc_id", "row_id"], "left").join(page, ["doc_id", "page_index"], "left")
    return out.withColumn("form", F.coalesce("_own", "_page", F.lit(""))).drop("_own", "_page")


def domain_order(annotations: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, form, domain, rank, color) in reading order: page, down, across; banners and what is not submitted don't count."""
    counts = with_form(annotations, rows).filter("kind <> 'domain' and domain <> ''").filter(~T.is_not_submitted(F.col("origin"), F.col("shown"), F.col("domain")))
    first = counts.groupBy("doc_id", "form", "domain").agg(F.min(F.struct("page_index", (-F.col("y1")).alias("y"), "x0", "ord")).alias("_at"))
    rank = F.row_number().over(W.partitionBy("doc_id", "form").orderBy("_at"))
    return first.withColumn("rank", rank).select("doc_id", "form", "domain", "rank", palette(F.col("rank")).alias("color"))


def page_colors(annotations: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, page_index, domain, color): what a page's legend shows, from its form's order."""
    counts = with_form(annotations, rows).filter("kind <> 'domain' and domain <> ''").filter(~T.is_not_submitted(F.col("origin"), F.col("shown"), F.col("domain")))
    told = counts.join(domain_order(annotations, rows), ["doc_id", "form", "domain"])
    return told.groupBy("doc_id", "page_index", "domain").agg(F.max_by("color", F.struct(F.col("y1") * -1, "x0", "ord")).alias("color"))


def apply_colors(annotations: DataFrame, rows: DataFrame) -> DataFrame:
    """Annotations with color: grey if not submitted, none for notes and without a domain, else the domain's in its form."""
    out = with_form(annotations, rows).join(domain_order(annotations, rows).select("doc_id", "form", "domain", F.col("color").alias("_c")), ["doc_id", "form", "domain"], "left")
    missing = (F.col("kind") != "domain") & T.is_not_submitted(F.col("origin"), F.col("shown"), F.col("domain"))
    return out.withColumn("color", F.when(missing, F.lit("#%02X%02X%02X" % GREY)).when(F.col("kind") != "note", F.col("_c"))).drop("_c")
