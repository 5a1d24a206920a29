"""Whole runs from files to files, one for each task of the form side; `python -m formloom` calls them by name.

Each takes a session and paths, and returns what it wrote or found. Errors are rows, and a run that finds any writes them
beside its output under `errors` and writes nothing that would hide work already done.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from ..operators import draw, extract, grouping, layout, precedent, prompt, recover, reply, review, style
from ..sources import named, pdf, tables, xfdf, xlsx
from ..sources.stage import staged


class Refused(ValueError):
    """A run that would discard work."""


def words(spark: SparkSession, path: str) -> DataFrame:
    """Words of a folder of PDF files, or of a Parquet table that holds them."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return staged(pdf.read_words(tables.read_files(spark, path, "*.pdf"))).filter("error is null")


def form_runs(spark: SparkSession, path: str, masked: DataFrame | None = None) -> DataFrame:
    """The printed runs of a folder's forms; words that a mark (doc_id, page_index, rect) covers are not printed."""
    found = words(spark, path)
    found = found if masked is None else extract.mask_words(found, masked)
    return staged(extract.runs(found) if "line_no" in found.columns else extract.lines_of(extract.folded_runs(found), together=True))


def form_rows(spark: SparkSession, path: str, masked: DataFrame | None = None) -> DataFrame:
    return staged(extract.rows_of(form_runs(spark, path, masked)))


def colored_and_placed(annotations: DataFrame, rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Annotations with colour and place: colours by the order of their rows, then boxes among the printed runs."""
    anchors = rows.select("doc_id", "row_id", "page_index", F.col("row_ord").alias("_ord"), F.coalesce("bbox_1", "bbox_2").alias("_a"))
    at = annotations.drop("page_index", "form").join(anchors, ["doc_id", "row_id"]).withColumns({"x0": F.col("_a.x0"), "y1": F.col("_a.y1"), "ord": F.col("_ord") * 10 + F.col("slot")}).drop("_ord", "_a")
    return staged(layout.place_annotations(staged(style.apply_colors(staged(at), rows)), rows, runs))


def warnings(placed: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, row_id, slot, warning, by): texts wider than their box, and groups that reach into a response of their rows."""
    told = ["doc_id", "row_id", "slot"]
    wide = layout.overflow(placed.filter("bbox is not null")).select(*told, F.lit("text is wider than its box").alias("warning"), F.col("overflow").alias("by"))
    groups = placed.filter("bbox is not null").filter(F.size("member_row_ids") > 0).withColumn("group_id", F.col("row_id"))
    members = groups.select("doc_id", "group_id", F.explode("member_row_ids").alias("row_id")).distinct().join(rows.select("doc_id", "row_id", "page_index", "bbox_1", "bbox_2"), ["doc_id", "row_id"])
    over = layout.overruns(groups, layout.block_anchors(members, F.lit(612.0)))
    return wide.unionByName(over.select(*told, F.lit("group reaches into a response").alias("warning"), F.col("overrun").alias("by")))


def write_sheets(rows: DataFrame, annotations: DataFrame, path: str) -> None:
    """A control sheet's workbook for each document, all of them or none."""
    named.write_named(xlsx.workbooks(review.sheet(rows, annotations)).withColumn("name", F.concat(F.col("doc_id").cast("string"), F.lit(".xlsx"))), path)


def as_annotations(known: DataFrame, rows: DataFrame) -> DataFrame:
    """What precedent answers, as annotations of slot 1 that wait for review; what repeats over neighbouring rows is one."""
    own = T.variable_text(F.col("variable"), F.col("condition"), F.col("fixed_value"))
    said = known.join(rows.select("doc_id", "row_ord", "row_id", "page_index"), ["doc_id", "row_ord"])
    said = staged(said.select("doc_id", "row_id", "page_index", F.lit(1).alias("slot"), F.lit("variable").alias("kind"), T.or_null(F.col("domain")).alias("domain"), F.lit(None).cast("string").alias("origin"), own.alias("shown"), F.lit(None).cast("string").alias("group_id"), "rationale"))
    keys = grouping.collapse_repeats(said, rows).select("doc_id", "row_id", "slot", F.col("group_id").alias("key"))
    out, _ = grouping.resolve_groups(said.drop("rationale"), rows, staged(keys))
    why = said.select("doc_id", "row_id", "slot", "rationale")
    return out.join(why, ["doc_id", "row_id", "slot"], "left").withColumns({"domain": T.or_null(F.col("domain")), "origin": T.or_null(F.col("origin")), "source_model": F.lit("precedent"), "suggested": F.lit(True), "review_status": F.lit("proposed"), "reviewed_by": F.lit("")})


def build_sheet(spark: SparkSession, forms: str, out: str, lookup: str | None = None, most: int = 150) -> DataFrame:
    """Forms to rows, proposals of what precedent answers, placed and in a control sheet for each form, and batches to ask
    for the rest. Returns the batches' manifest.
    """
    runs = form_runs(spark, forms)
    runs.write.parquet(f"{out}/runs")
    rows = staged(extract.rows_of(runs))
    tables.write_documents(rows, f"{out}/rows_json")
    rows.write.parquet(f"{out}/rows")
    known = tables.read_lookup(spark, lookup) if lookup else spark.createDataFrame([], ", ".join(f"{c} string" for c in tables.LOOKUP))
    answered = staged(precedent.match_precedent(rows, known))
    answered.write.parquet(f"{out}/precedent")
    proposals = colored_and_placed(as_annotations(answered, rows), rows, runs)
    proposals.write.parquet(f"{out}/proposals")
    write_sheets(rows, proposals, f"{out}/sheets")
    files = staged(prompt.batch_files(grouping.uncovered(rows, proposals), most))
    tables.write_batches(files, f"{out}/batches")
    return files.drop("instructions_text", "sheet_text")


def ingest_response(spark: SparkSession, rows: str, replies: str, out: str, sheets: str | None = None, proposals: str | None = None, runs: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(annotations, errors) of pasted replies, one file for each document; refused where a sheet is reviewed already.

    With `proposals`, what is there already stands with them. With `runs`, all of it is placed, and control sheets are
    written anew. Rows that were asked for and that no reply covers are errors.
    """
    if sheets:
        lines, _ = xlsx.lines(named_by_form(tables.read_files(spark, sheets, "*.xlsx")))
        done = review.reviewed(review.read_lines(lines)).filter("not open")
        if not done.isEmpty():
            raise Refused(f"reviewed already: {[r['doc_id'] for r in done.limit(5).collect()]}")
    form = spark.read.parquet(rows)
    told, unread = reply.parse(tables.read_texts(spark, replies))
    good, wrong = reply.proposals(told)
    kind = form.schema["doc_id"].dataType
    annotations, unknown = reply.attach(good.withColumn("doc_id", F.col("doc_id").cast(kind)), form)
    null = F.lit(None).cast("string")
    shown = T.display_text(null, F.col("variable"), F.col("condition"), null, F.col("origin"))
    annotations = annotations.select("annot_id", "doc_id", "row_id", "row_ord", "page_index", "slot", "kind", "domain", "variable", "condition", "codelist", "origin", "confidence", "rationale", shown.alias("shown")).withColumns({"group_id": F.lit(None).cast("string"), "member_row_ids": F.array().cast("array<string>"), "source_model": F.lit("reply"), "suggested": F.lit(True), "review_status": F.lit("proposed"), "reviewed_by": F.lit("")})
    errors = [unread.select(F.col("doc_id").cast("string"), "error"), wrong.select("doc_id", "error"), unknown.select(F.col("doc_id").cast("string"), "error")]
    if proposals:
        before = spark.read.parquet(proposals).drop("color", "bbox", "x0", "y1", "ord")
        lacks = reply.missing(grouping.uncovered(form, before), annotations)
        answered = annotations.select("doc_id").distinct()
        errors.append(lacks.join(answered, "doc_id", "left_semi").select(F.col("doc_id").cast("string"), F.concat(F.lit("no reply for row "), "row_id").alias("error")))
        annotations = review.merged(before.withColumn("annot_id", F.concat("row_id", F.lit("_a"), "slot")), annotations)
    errors = staged(reduce(DataFrame.unionByName, errors))
    if runs:
        annotations = colored_and_placed(annotations, form, spark.read.parquet(runs))
        write_sheets(form, annotations, f"{out}/sheets")
    annotations.write.parquet(f"{out}/annotations")
    errors.write.json(f"{out}/errors")
    return spark.read.parquet(f"{out}/annotations"), errors


def named_by_form(files: DataFrame) -> DataFrame:
    """Files of a form's name with an ending, by the name."""
    return files.withColumn("doc_id", F.regexp_replace("doc_id", r"\.xlsx$", ""))


def of_sheets(lines: DataFrame, form: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(annotations, errors) of reviewed sheets with groups as one, what each text says and who decided: a group's status is
    proposed while any of its texts is, and else its first text's.
    """
    folded, wrong = review.folded(lines, form)
    given = review.to_annotations(lines, form).select("doc_id", F.col("row_id").alias("covered"), "row_ord", "slot", "review_status", "reviewed_by")
    parts = grouping.covered_rows(folded.select("doc_id", "row_id", "slot", "member_row_ids")).join(given, ["doc_id", "covered", "slot"])
    first = F.min_by(F.struct("review_status", "reviewed_by"), "row_ord")
    status = parts.groupBy("doc_id", "row_id", "slot").agg(F.max(F.col("review_status") == "proposed").alias("_open"), first.alias("_f"))
    said = folded.join(status, ["doc_id", "row_id", "slot"], "left").withColumn("_p", T.parse_mapping(F.col("shown")))
    out = said.select(
        "doc_id", "row_id", "page_index", "slot", "kind", "shown", T.or_null(F.col("domain")).alias("domain"), F.col("_p.variable").alias("variable"), F.col("_p.condition").alias("condition"), F.col("_p.fixed_value").alias("fixed_value"),
        T.or_null(F.col("origin")).alias("origin"), "group_id", "member_row_ids", F.when(F.coalesce("_open", F.lit(True)), "proposed").otherwise(F.col("_f.review_status")).alias("review_status"), F.col("_f.reviewed_by").alias("reviewed_by"),
    )
    return out, wrong.select("doc_id", "error")


def annotate(spark: SparkSession, rows: str, sheets: str, out: str, runs: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(annotations, errors) of reviewed sheets. Of the documents that may be drawn and have no error: exchange files, and as
    tables the marks to draw, the groups' brackets, the pages' legends, and warnings.

    `runs` are the forms' printed runs, which boxes that wrap keep clear of.
    """
    form = spark.read.parquet(rows)
    kind = form.schema["doc_id"].dataType
    printed = spark.read.parquet(runs) if runs else spark.createDataFrame([], f"doc_id {kind.simpleString()}, page_index int, x0 double, y0 double, x1 double, y1 double")
    lines, damaged = xlsx.lines(named_by_form(tables.read_files(spark, sheets, "*.xlsx")))
    lines = staged(review.read_lines(lines).withColumn("doc_id", F.col("doc_id").cast(kind)))
    given, wrong = of_sheets(lines, form)
    given = staged(given)
    wrong = staged(review.errors(lines, form).select("doc_id", "error").unionByName(wrong).unionByName(damaged.select(F.col("doc_id").cast(kind), "error")))
    bad = wrong.select("doc_id").union(review.gate(given).filter("not open").select("doc_id")).distinct()
    good = colored_and_placed(review.submittable(given).join(bad, "doc_id", "left_anti"), form, printed).withColumn("annot_id", F.concat("row_id", F.lit("_a"), "slot"))
    files = xfdf.texts(good.filter("bbox is not null").withColumn("_href", F.col("doc_id").cast("string")), href="_href")
    named.write_named(files.select(F.concat(F.col("doc_id").cast("string"), F.lit(".xfdf")).alias("name"), F.col("xfdf").alias("content")), f"{out}/xfdf")
    draw.marks(draw.drawn(good).withColumn("fill", T.parse_hex(F.col("color")))).write.parquet(f"{out}/marks")
    members = good.filter(F.size("member_row_ids") > 0).select("doc_id", F.col("row_id").alias("group_id"), F.explode("member_row_ids").alias("row_id")).distinct()
    blocks = layout.block_anchors(members.join(form.select("doc_id", "row_id", "page_index", "bbox_1", "bbox_2"), ["doc_id", "row_id"]), F.lit(612.0))
    draw.brackets(good.filter("bbox is not null").withColumn("height", F.lit(792.0)).join(blocks.select("doc_id", F.col("group_id").alias("row_id"), "block"), ["doc_id", "row_id"]).filter(F.size("member_row_ids") > 0)).write.parquet(f"{out}/brackets")
    shades = style.page_colors(good.drop("color", "form"), form)
    place = F.row_number().over(W.partitionBy("doc_id", "page_index").orderBy("domain"))
    entries = shades.select("doc_id", "page_index", place.alias("place"), F.col("domain").alias("text"), T.parse_hex(F.col("color")).alias("fill"))
    draw.legends(entries, draw.legend_origins(printed, shades.select("doc_id", "page_index").distinct())).write.parquet(f"{out}/legends")
    warnings(good, form).write.json(f"{out}/warnings")
    wrong.write.json(f"{out}/errors")
    return good, wrong


def parse_annotated(spark: SparkSession, forms: str, marks: str, out: str, lookup: str | None = None) -> DataFrame:
    """Finished forms to mappings, with a report."""
    found = staged(spark.read.parquet(marks) if marks.endswith(".parquet") else pdf.read_marks(tables.read_files(spark, marks, "*.pdf")).filter("error is null"))
    if "muted" not in found.columns:
        found = found.withColumn("muted", G.is_muted(F.col("style.text_color")))
    # a mark's own text is not the form's: words below a mark are left out; boxes of marks are y up, words y down
    rows = form_rows(spark, forms, found.filter("trim(text) <> ''").select("doc_id", "page_index", G.flip(F.col("bbox"), F.lit(792.0)).alias("rect")))
    known = precedent.domain_table(tables.read_lookup(spark, lookup)) if lookup else None
    m = staged(recover.recover(found, rows, known))
    sized = m.withColumns({c: F.lit(v) for c, v in (("page_width", 612.0), ("page_height", 792.0)) if c not in m.columns})
    tables.write_cells(recover.report_rows(sized), f"{out}/report")
    tables.write_cells(recover.lookup_rows(m), f"{out}/lookup")
    return recover.report_counts(m)


def mine_corpus(spark: SparkSession, mappings: list[str], out: str) -> DataFrame:
    """The lookup table of the mappings of many forms."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(p) for p in mappings])
    look = staged(precedent.lookup_table(every if "ord" in every.columns else every.withColumn("ord", F.monotonically_increasing_id())))
    tables.write_lookup(look, f"{out}/lookup")
    return look


def preview(spark: SparkSession, forms: str, out: str) -> DataFrame:
    """What an overlay would show of an extraction."""
    run = form_runs(spark, forms)
    pages = extract.page_gutters(run, run.select("doc_id", "page_index").distinct(), F.lit(612.0)).withColumnRenamed("gutter", "gutter_x").withColumns({"width": F.lit(612.0), "height": F.lit(792.0)})
    boxes = draw.overlay(staged(extract.rows_of(run)), pages)
    boxes.write.parquet(f"{out}/overlay")
    return spark.read.parquet(f"{out}/overlay")


FLOWS = {f.__name__.replace("_", "-"): f for f in (build_sheet, ingest_response, annotate, parse_annotated, mine_corpus, preview)}
