"""Whole runs over the made form, and reading of PDF files by a stand-in for the library."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from formloom.operators import grouping, prompt, recover, reply, review
from formloom.plans import flows, sample
from formloom.sources import named, pdf, tables, xfdf, xlsx


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """The form's words, a lookup file that knows two of its questions, and what the first run makes of them."""
    top = str(tmp_path_factory.mktemp("flows"))
    sample.words(spark).write.parquet(f"{top}/words.parquet")
    look = [("Sex", "", "DM", "SEX", "", "", "3", "a.pdf"), ("visit date", "", "SV", "SVSTDTC", "", "", "2", "b.pdf")]
    spark.createDataFrame(look, "label string, context string, domain string, variable string, condition string, fixed_value string, count string, sample_pdfs string").write.option("header", True).csv(f"{top}/lookup")
    return top, flows.build_sheet(spark, f"{top}/words.parquet", f"{top}/out", f"{top}/lookup", 20)


def test_build_sheet(spark, made):
    top, manifest = made
    told = [(r["batch"], r["pages"], r["rows"], r["sheet"], r["expected_response"]) for r in manifest.orderBy("batch").collect()]
    # Sex | Male is asked again: its question is known, but not with this response alone; only rows that match are left out
    known = spark.read.parquet(f"{top}/out/precedent")
    assert known.count() >= 2 and sum(r[2] for r in told) == 54 - known.count()
    assert [r[0] for r in told] == [1, 2, 3][: len(told)] and told[0][3:] == ("copilot_batch1_sheet.csv", "copilot_batch1_response.csv") and [p for r in told for p in r[1]] == [0, 1, 2]
    files = spark.read.option("recursiveFileLookup", True).text(f"{top}/out/batches", wholetext=True).withColumn("n", F.input_file_name())
    sheets = [r["value"] for r in files.filter(F.col("n").contains("_sheet")).collect()]
    assert len(sheets) == len(told) and all(s.startswith("row_id,page,form,text_1,text_2,kind") for s in sheets)
    asked = [r["value"] for r in files.filter(F.col("n").contains("_instructions")).orderBy("n").collect()]
    assert asked[0].startswith(f"Batch 1 of {len(told)}: page 1, ") and all("NotSubmitted" in t and "eDT" in t for t in asked)


def test_ingest_and_annotate(spark, made, tmp_path):
    top, _ = made
    replies = tmp_path / "replies"
    replies.mkdir()
    (replies / "0").write_text("Here:\nrow_id,kind,domain,variable,variable2,origin\np1_r010,,DM,sex,,Collected\np1_r009,,DM,age,ageu,collected\np9_r001,,DM,X,,\n\nbye")
    annotations, errors = flows.ingest_response(spark, f"{top}/out/rows", str(replies), str(tmp_path / "in"))
    assert sorted((r["annot_id"], r["variable"]) for r in annotations.collect()) == [("p1_r009_a1", "AGE"), ("p1_r009_a2", "AGEU"), ("p1_r010_a1", "SEX")]
    assert [(r["doc_id"], r["error"]) for r in errors.collect()] == [("0", "unknown row")]
    rows = spark.read.parquet(f"{top}/out/rows")
    said = annotations.select("doc_id", "row_id", F.array().cast("array<string>").alias("member_row_ids"), "slot", F.concat_ws(".", "domain", "variable").alias("shown"), "domain", "origin", F.lit(None).cast("string").alias("group_id"), F.lit("m").alias("source_model"), F.lit("accepted").alias("review_status"), F.lit("me").alias("reviewed_by"), F.col("slot").alias("ord"))
    book = xlsx.workbooks(review.sheet(rows, said)).first()
    (tmp_path / "sheets").mkdir()
    (tmp_path / "sheets" / "0.xlsx").write_bytes(book["content"])
    with pytest.raises(flows.Refused):
        flows.ingest_response(spark, f"{top}/out/rows", str(replies), str(tmp_path / "again"), str(tmp_path / "sheets"))


def test_annotate(spark, made, tmp_path):
    """A reviewed sheet becomes exchange files, marks, brackets, legends and warnings; an open one becomes nothing."""
    top, _ = made
    rows, runs = spark.read.parquet(f"{top}/out/rows"), spark.read.parquet(f"{top}/out/runs")
    proposals = spark.read.parquet(f"{top}/out/proposals")
    assert {r["shown"] for r in proposals.collect()} == {"SEX", "SVSTDTC"} and proposals.filter("bbox is null").isEmpty()
    form = rows.orderBy("row_ord").collect()
    one, two, three, far = (form[k]["row_id"] for k in (8, 9, 10, 14))
    page = form[8]["page_index"]
    assert {form[k]["page_index"] for k in (8, 9, 10, 14)} == {page}
    said = [(one, 1, "AGE", "DM", "g"), (two, 1, "", "DM", "g"), (three, 1, "", "DM", "g"), (far, 1, "SEX", "DM", ""), (far, 2, "QVAL when QNAM = " + "A" * 60, "SUPPDM", "")]
    cells = {r: {"domain": d, "group": g} for r, _, _, d, g in said}
    for r, slot, text, _, _ in said:
        cells[r][f"anno{slot}"] = text
    doc = form[0]["doc_id"]
    lines = [(doc, r["row_ord"], *[str(r[c] or "") for c in ("row_id", "form", "text_1", "text_2")], *[cells.get(r["row_id"], {}).get(c, "") for c in ("domain", "group", "anno1", "anno2")], "accepted" if r["row_id"] in cells else "proposed", "me" if r["row_id"] in cells else "") for r in form]
    sheet = spark.createDataFrame(lines, "doc_id long, row_ord int, row_id string, form string, text_1 string, text_2 string, domain string, group string, anno1 string, anno2 string, review_status string, reviewed_by string")
    named.write_named(xlsx.workbooks(sheet).withColumn("name", F.concat(F.col("doc_id").cast("string"), F.lit(".xlsx"))), f"{tmp_path}/sheets")
    good, errors = flows.annotate(spark, f"{top}/out/rows", f"{tmp_path}/sheets", f"{tmp_path}/out", f"{top}/out/runs")
    assert errors.isEmpty()
    got = {(r["row_id"], r["slot"]): r for r in good.collect()}
    assert set(got) == {(one, 1), (far, 1), (far, 2)} and got[one, 1]["member_row_ids"] == [one, two, three] and got[one, 1]["review_status"] == "accepted"
    anchors = {r["row_id"]: r["bbox_1"] or r["bbox_2"] for r in form}
    block = [anchors[r] for r in (one, two, three)]
    middle = lambda *bs: (min(b["y0"] for b in bs) + max(b["y1"] for b in bs)) / 2
    assert middle(got[one, 1]["bbox"]) == pytest.approx(middle(*block)) and got[one, 1]["bbox"]["x0"] == pytest.approx(max(b["x1"] for b in block) + 4)
    printed = [(r["x0"], 792 - r["y1"], r["x1"], 792 - r["y0"]) for r in runs.filter(F.col("page_index") == page).collect()]
    for r in got.values():
        b = r["bbox"]
        assert (b["x0"], b["y0"]) != (anchors[r["row_id"]]["x0"], anchors[r["row_id"]]["y0"]), "on top of its question"
        if b["x0"] == anchors[r["row_id"]]["x0"]:  # wrapped: clear of what is printed
            assert not any(min(b["x1"] + 1.5, q[2]) - max(b["x0"] - 1.5, q[0]) > 1 and min(b["y1"] + 1.5, q[3]) - max(b["y0"] - 1.5, q[1]) > 1 for q in printed)
    back = xfdf.annotations_of(xfdf.parse(spark.createDataFrame([(doc, (tmp_path / "out" / "xfdf" / f"{doc}.xfdf").read_text())], "doc_id long, xfdf string"))).collect()
    assert {(r["row_id"], r["slot"], tuple(r["member_row_ids"]), r["reviewed_by"]) for r in back} == {(one, 1, (one, two, three), "me"), (far, 1, (), "me"), (far, 2, (), "me")}
    assert spark.read.parquet(f"{tmp_path}/out/marks").count() == 3 and spark.read.parquet(f"{tmp_path}/out/brackets").count() == 1
    assert {r["text"] for r in spark.read.parquet(f"{tmp_path}/out/legends").collect()} == {"DM", "SUPPDM"}
    half = sheet.withColumn("review_status", F.when(F.col("row_id") == far, "proposed").otherwise(F.col("review_status")))
    named.write_named(xlsx.workbooks(half).withColumn("name", F.concat(F.col("doc_id").cast("string"), F.lit(".xlsx"))), f"{tmp_path}/open")
    good, _ = flows.annotate(spark, f"{top}/out/rows", f"{tmp_path}/open", f"{tmp_path}/none", f"{top}/out/runs")
    assert good.isEmpty() and not [f for f in (tmp_path / "none" / "xfdf").iterdir() if f.suffix == ".xfdf"]


def test_replies_beside_proposals(spark, made, tmp_path):
    """Replies stand with what precedent had said, are placed, and go into new sheets; rows without a reply are told."""
    top, _ = made
    rows = spark.read.parquet(f"{top}/out/rows")
    known = {r["row_id"] for r in grouping.covered_rows(spark.read.parquet(f"{top}/out/proposals")).select(F.col("covered").alias("row_id")).collect()}
    (tmp_path / "replies").mkdir()
    free = [r["row_id"] for r in rows.orderBy("row_ord").collect() if r["row_id"] not in known]
    (tmp_path / "replies" / "0").write_text("row_id,kind,domain,variable,origin\n" + "".join(f"{r},,DM,V{n},Collected\n" for n, r in enumerate(free[:-2])))
    annotations, errors = flows.ingest_response(spark, f"{top}/out/rows", str(tmp_path / "replies"), str(tmp_path / "in"), proposals=f"{top}/out/proposals", runs=f"{top}/out/runs")
    assert {r["row_id"] for r in grouping.covered_rows(annotations).select(F.col("covered").alias("row_id")).collect()} == known | set(free[:-2]) and annotations.filter("bbox is null").isEmpty()
    assert {r["error"] for r in errors.collect()} == {f"no reply for row {r}" for r in free[-2:]}
    lines, wrong = xlsx.lines(tables.read_files(spark, f"{tmp_path}/in/sheets", "*.xlsx"))
    assert wrong.isEmpty() and lines.filter("anno1 <> ''").count() == annotations.select("row_id").distinct().count()
    assert review.errors(review.read_lines(lines.withColumn("doc_id", F.lit(0).cast("long"))), rows.withColumn("doc_id", F.lit(0).cast("long"))).isEmpty()


def test_parse_annotated_reads_a_form_without_its_marks(spark, tmp_path):
    """What a mark prints is not the form's text; a grey mark is a note."""
    words = [("f.pdf", 0, n, 90.0 + 40 * n, 100.0, 125.0 + 40 * n, 110.0, w, 1) for n, w in enumerate(["Year", "of", "birth", "BRTHDTC"])]
    spark.createDataFrame(words, "doc_id string, page_index int, word_no int, x0 double, y0 double, x1 double, y1 double, word string, block int").write.parquet(f"{tmp_path}/words.parquet")
    grey = {"text_color": {"r": 0.5, "g": 0.5, "b": 0.5}}
    black = {"text_color": {"r": 0.0, "g": 0.0, "b": 0.0}}
    marks = [("f.pdf", 0, 1, (209.0, 681.0, 250.0, 693.0), "BRTHDTC", False, False, (1.0, 1.0, 0.5), black), ("f.pdf", 0, 2, (400.0, 682.0, 440.0, 692.0), "check this", False, False, None, grey)]
    spark.createDataFrame(marks, "doc_id string, page_index int, mark_ord int, bbox struct<x0:double,y0:double,x1:double,y1:double>, text string, dashed boolean, boxed boolean, fill struct<r:double,g:double,b:double>, style struct<text_color:struct<r:double,g:double,b:double>>").write.parquet(f"{tmp_path}/marks.parquet")
    flows.parse_annotated(spark, f"{tmp_path}/words.parquet", f"{tmp_path}/marks.parquet", f"{tmp_path}/out")
    report = {r["text"]: r for r in spark.read.option("header", True).csv(f"{tmp_path}/out/report").collect()}
    assert report["BRTHDTC"]["label"] == "Year of birth" and report["BRTHDTC"]["kind"] == "variable" and report["check this"]["kind"] == "note" and report["check this"]["text_hex"] == "#808080"
    assert list(report["BRTHDTC"].asDict()) == [*recover.TOLD, *recover.POSITION, *recover.STYLE]
    one = spark.read.option("header", True).csv(f"{tmp_path}/out/lookup").collect()
    assert [(r["label"], r["variable"], r["page"]) for r in one] == [("Year of birth", "BRTHDTC", "1")] and one[0].__fields__ == recover.LOOKUP


def test_damaged_workbooks_are_told(spark):
    lines, errors = xlsx.lines(spark.createDataFrame([(1, b"PK no"), (2, b"")], "doc_id long, content binary"))
    assert lines.isEmpty() and sorted((r["doc_id"], r["error"]) for r in errors.collect()) == [(1, "no workbook: BadZipFile"), (2, "no workbook: BadZipFile")]


def test_page_span(spark):
    spans = lambda *p: spark.range(1).select(prompt.page_span(F.array(*[F.lit(x) for x in p]))).first()[0]
    assert [spans(4), spans(0, 1, 2), spans(5, 0, 1, 9)] == ["page 5", "pages 1-3", "pages 1-2, 6, 10"]


def test_words_and_marks_of_a_document():
    rect = SimpleNamespace(x0=10.0, y0=20.0, x1=60.0, y1=31.0, width=612.0, height=792.0)
    mark = lambda kind, text, **more: SimpleNamespace(**({"type": (2, kind), "info": {"content": text, "title": "me", "subject": "", "modDate": ""}, "rect": rect, "colors": {"stroke": [0.5], "fill": [1, 1, 0.5]}, "border": {"width": 1.0, "dashes": (3,), "style": "D"}, "flags": 4, "opacity": -1, "rotation": 0, "xref": 7} | more))
    page = SimpleNamespace(rect=rect, get_text=lambda _: [(1, 2, 3, 4, "Sex", 0, 0, 0), (5, 2, 6, 4, " ", 0, 0, 1)], annots=lambda: [mark("FreeText", "DM.SEX"), mark("FreeText", "  "), mark("Link", "x"), mark("Square", "note", colors={}, border={"width": 0}, flags=34)])

    class Document(list):
        def xref_get_key(self, xref, name):
            return ("string", "0 g /HeBo 7.5 Tf") if name == "DA" else ("null", "null")

    words = list(pdf.words_of(Document([page])))
    assert [(w["word"], w["page_index"], w["x0"], w["width"]) for w in words] == [("Sex", 0, 1, 612.0)]
    one, two = pdf.marks_of(Document([page]))
    assert (one["text"], one["bbox"]["y0"], one["bbox"]["y1"], one["dashed"], one["boxed"], one["fill"]) == ("DM.SEX", 761.0, 772.0, True, True, {"r": 1.0, "g": 1.0, "b": 0.5})
    assert (one["style"]["bold"], one["style"]["font_size"], one["style"]["printable"], one["style"]["hidden"], one["style"]["opacity"], one["style"]["text_color"]) == (True, 7.5, True, False, 1.0, {"r": 0.5, "g": 0.5, "b": 0.5})
    assert (two["mark_ord"], two["fill"], two["boxed"], two["dashed"], two["style"]["hidden"], two["style"]["printable"]) == (1, None, False, False, True, False)


def test_wide_names_of_forms_stay(spark, made):
    """The rows of the run are those of the printed list."""
    top, _ = made
    got = [(r["page_index"], r["form"], r["text_1"], r["text_2"]) for r in spark.read.parquet(f"{top}/out/rows").orderBy("row_ord").collect()]
    assert got == [t[:4] for t in sample.truth()]
    assert reply.FIELDS[0] == "row_id"


def test_groups_of_the_sheet(spark):
    """A text typed on one row of a group stands for all; what cannot be one is told with the sheet's lines."""
    rows = spark.createDataFrame([(1, k, f"r{k}", 0) for k in range(1, 8)], "doc_id long, row_ord int, row_id string, page_index int")
    said = [("r1", "AE.X", "g"), ("r2", "", "g"), ("r3", "", "g"), ("r4", "A", "h"), ("r5", "B", "h"), ("r6", "C", ""), ("r7", "", "")]
    lines = spark.createDataFrame([(1, k, r, a, "", "", "proposed", "", "", g, "") for k, (r, a, g) in enumerate(said, 2)], "doc_id long, excel_row int, row_id string, anno1 string, anno2 string, note string, review_status string, reviewed_by string, domain string, `group` string, origin string")
    out, errors = review.folded(review.read_lines(lines), rows)
    assert sorted((r["row_id"], r["shown"], r["group_id"], tuple(r["member_row_ids"])) for r in out.collect()) == [("r1", "AE.X", "g", ("r1", "r2", "r3")), ("r6", "C", None, ())]
    assert [(r["key"], r["slot"], r["error"], r["excel_rows"]) for r in errors.collect()] == [("h", 1, "contents differ", "5, 6")]
