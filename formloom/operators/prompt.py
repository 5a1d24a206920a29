"""What is asked of a reader for the rows that nothing answers yet: batches of whole pages, a sheet and its instructions each.

rows are crf_rows; pages are doc_id and page_index of all pages, those without a row too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import reply

#: The names of a batch's files, by its number.
INSTRUCTIONS, SHEET, RESPONSE = "copilot_batch%d_instructions.txt", "copilot_batch%d_sheet.csv", "copilot_batch%d_response.csv"
#: The sheet's columns, those that stay and those that are filled in.
STAY, FILL = ["row_id", "page", "form", "text_1", "text_2"], reply.FIELDS[1:]


def on_pages(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of the wanted pages (doc_id, page_index)."""
    return rows.join(wanted.select("doc_id", "page_index").distinct(), ["doc_id", "page_index"], "left_semi")


def by_id(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Each wanted id (doc_id, row_id) with its row, the first where an id repeats; without one where there is none."""
    fields = [c for c in rows.columns if c not in ("doc_id", "row_id")]
    first = rows.groupBy("doc_id", "row_id").agg(F.min_by(F.struct(*fields), "row_ord").alias("_r"))
    return ids.select("doc_id", "row_id").distinct().join(first, ["doc_id", "row_id"], "left").select("doc_id", "row_id", "_r.*")


def page_counts(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page_index, n): rows of every page, none included."""
    n = rows.groupBy("doc_id", "page_index").agg(F.count("*").alias("n"))
    return pages.select("doc_id", "page_index").distinct().join(n, ["doc_id", "page_index"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def page_span(pages: Column) -> Column:
    """Page numbers from 1, as runs: pages 1-3, 5."""
    told = F.transform(F.array_sort(pages), lambda p: p + 1)
    first = F.filter(told, lambda p: ~F.array_contains(told, p - 1))
    last = F.filter(told, lambda p: ~F.array_contains(told, p + 1))
    runs = F.zip_with(first, last, lambda a, b: F.when(a == b, a.cast("string")).otherwise(F.concat_ws("-", a.cast("string"), b.cast("string"))))
    return F.concat(F.when(F.size(told) == 1, "page ").otherwise("pages "), F.array_join(runs, ", "))


def instructions(number: Column, of: Column, span: Column, rows: Column, appendix: Column) -> Column:
    """The text that goes with a batch's sheet."""
    lines = [
        F.format_string("Batch %d of %d: %s, %d rows.\n", number, of, span, rows),
        F.lit(f"""
The attached CSV has one line for each printed line of a blank case report form. text_1 is the question and text_2 the
response printed beside it; a line without text_1 is one more option of the question above. Say for each line which SDTM
variable holds its value, by filling in the columns that are empty: {', '.join(FILL)}.

- kind: leave it empty for a variable. Write note where the line holds no submitted data; then domain and variable stay
  empty and origin is NotSubmitted.
- domain: the two letters of the dataset; the form column tells most about it. variable: the name without the domain.
- variable2: a second variable of the same line, such as the unit of a result. Never add a line for it.
- condition: what selects the line where several lines share a result variable, such as VSTESTCD = SYSBP.
- codelist: the codelist of a line of controlled terms. origin: one of {', '.join(T.ORIGINS)}.
- confidence: from 0.0 to 1.0, below 0.7 where you had to guess. rationale: one short sentence that names what decided.

Keep all lines, their order, and the columns {', '.join(STAY)} as they are. Answer with the whole CSV and nothing else:
no table of bars, no fence, no words around it.
"""),
        F.when(F.coalesce(appendix, F.lit("")) != "", F.concat(F.lit("\nWhat finished forms say of like lines:\n"), appendix, F.lit("\n"))).otherwise(F.lit("")),
    ]
    return F.concat(*lines)


def appendix_text(entries: DataFrame) -> DataFrame:
    """(doc_id, batch, appendix): lines of (doc_id, batch, place, label, domain, variable, count), in order of place."""
    line = F.concat(F.lit('- "'), F.col("label"), F.lit('": '), F.concat_ws(".", T.or_null(F.col("domain")), "variable"), F.format_string(" (n=%s)", F.col("count").cast("string")))
    told = entries.groupBy("doc_id", "batch").agg(F.array_sort(F.collect_list(F.struct("place", line.alias("t")))).alias("_l"))
    return told.select("doc_id", "batch", F.array_join(F.transform("_l", lambda x: x["t"]), "\n").alias("appendix"))


def batch_files(rows: DataFrame, most: int = 150, appendix: DataFrame | None = None) -> DataFrame:
    """(doc_id, batch, pages, rows, instructions, sheet, expected_response, instructions_text, sheet_text): a manifest with the files.

    rows are those to ask for; documents without any have no batch. Batches hold whole pages, up to `most` rows unless
    one page has more. A batch's rows are one file and bound what a task holds.
    """
    of_page = reply.batches(rows.groupBy("doc_id", "page_index").agg(F.count("*").alias("n")), most)
    own = rows.join(of_page, ["doc_id", "page_index"])
    counts = own.groupBy("doc_id", "batch").agg(F.count("*").alias("rows"), F.array_sort(F.collect_set("page_index")).alias("pages"))
    of = of_page.groupBy("doc_id").agg(F.max("batch").alias("_of"))
    sheets = reply.spec_sheet(own.withColumn("doc_id", F.struct("doc_id", "batch"))).select("doc_id.*", F.col("csv").alias("sheet_text"))
    out = counts.join(of, "doc_id").join(sheets, ["doc_id", "batch"])
    out = out.withColumn("appendix", F.lit("")) if appendix is None else out.join(appendix, ["doc_id", "batch"], "left")
    name = lambda pattern: F.format_string(pattern, "batch")
    text = instructions(F.col("batch"), F.col("_of"), page_span(F.col("pages")), F.col("rows"), F.col("appendix"))
    return out.select("doc_id", "batch", "pages", "rows", name(INSTRUCTIONS).alias("instructions"), name(SHEET).alias("sheet"), name(RESPONSE).alias("expected_response"), text.alias("instructions_text"), "sheet_text")
