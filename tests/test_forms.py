"""Folds against their window forms, small fixtures with results worked out by hand, and round trips."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from formloom.functions import geometry as G
from formloom.functions import text as T
from formloom.operators import extract, grouping, layout, precedent, recover, reply, review
from formloom.plans import testbed
from formloom.sources import tables, xfdf, xlsx
from formloom.streaming import words as stream

SF = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("DM.SEX", ("DM", "SEX", None, None)), ("SEX", (None, "SEX", None, None)), ('SUPPDM.QVAL when QNAM = "RACE1"', ("SUPPDM", "QVAL", 'QNAM = "RACE1"', None)),
        ("DSCAT = PROTOCOL MILESTONE", (None, "DSCAT", None, "PROTOCOL MILESTONE")), ('dm.x = "A b"', ("DM", "X", None, "A b")), ("[Not Submitted]", (None,) * 4), ("", (None,) * 4), ("RESCREEN in SUPPDM", (None,) * 4), (None, (None,) * 4),
    ],
)
def test_parse_mapping(spark, text, want):
    assert tuple(one(spark, T.parse_mapping(F.lit(text).cast("string")))) == want


def test_scalars(spark):
    assert one(spark, T.normalize_key(F.lit("  Year of  Birth :: "))) == "year of birth"
    assert one(spark, T.legend(F.lit("dm (Demographics)")))["code"] == "DM" and one(spark, T.legend(F.lit("DS = Disposition")))["name"] == "Disposition"
    assert one(spark, T.coerce(F.lit(" not_submitted"), T.ORIGINS)) == "NotSubmitted" and one(spark, T.coerce(F.lit("EDT"), T.ORIGINS)) == "eDT" and one(spark, T.coerce(F.lit("x"), T.KINDS)) is None
    assert one(spark, T.builtin_domain(F.lit("RFICDTC"))) == "DM" and one(spark, T.builtin_domain(F.lit("AETERM"))) == "AE" and one(spark, T.builtin_domain(F.lit("AE"))) is None
    assert one(spark, T.pasted(F.lit("```csv\n“a”\n```"))) == '"a"\n'
    assert one(spark, G.text_width(F.lit("AGE"))) == pytest.approx((667 + 778 + 667) * 7 / 1000)
    assert tuple(one(spark, G.parse_rect(F.lit("3, 4 1,2")))) == (1, 2, 3, 4) and one(spark, G.parse_rect(F.lit("1,2,x,4"))) is None
    assert [one(spark, T.scrub(F.lit(x))) for x in (" N/A ", " Not Applicable ", "-", "0", " x ", "nan")] == [None, None, None, "0", "x", "nan"]
    assert tuple(one(spark, T.parse_hex(F.lit("#BFFF96")))) == (191, 255, 150) and one(spark, T.parse_hex(F.lit("#zz"))) is None


def test_folded_lines_are_the_windows(spark):
    words = testbed.words(spark, SF).filter("doc_id < 25")
    a = extract.runs(words).select("doc_id", "page_index", "x0", "y0", "x1", "y1", "text")
    b = extract.runs(extract.assign_lines(words)).select(a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_first_fit_grows(spark):
    """Three words whose line grows to hold the last, which the first alone would not."""
    w = [(1, 0, 0, k, 10.0 * k, y, 10.0 * k + 5, y + 10, f"w{k}", 0) for k, y in enumerate((0.0, 4.0, 8.0))]
    df = spark.createDataFrame(w, stream.WORDS)
    assert [r["line_no"] for r in extract.assign_lines(df).orderBy("y0").collect()] == [0, 0, 0]


def records(spark, seed):
    rng = random.Random(seed)
    rows = []
    for n in range(40):
        two = rng.random() < 0.3
        blocks = sorted({n // 3 + rng.randint(0, 1) for _ in range(rng.randint(1, 2))})
        rows.append((1, 0, n, f"q{n}", "r" if two else "", 10.0, float(n), 20.0, n + 1.0, *((30.0, float(n), 40.0, n + 1.0) if two else (None,) * 4), blocks, rng.random() < 0.1))
    df = spark.createDataFrame(rows, "doc_id long, page_index int, line_no int, text_1 string, text_2 string, " + ", ".join(f"{c} double" for c in extract.CORNERS) + ", blocks_1 array<int>, full_width boolean")
    return rows, df.withColumn("band", G.box(F.lit(0), F.col("line_no"), F.lit(1), F.col("line_no") + 1))


@pytest.mark.parametrize("seed", range(3))
def test_wrapped_lines(spark, seed):
    rows, df = records(spark, seed)
    want, last = [], None
    for r in rows:
        alone, blocks = r[9] is None, set(r[13])
        if last and alone and last[1] is not None and last[2] == r[14] and last[1] & blocks:
            last[0].append(r[3])
            last[1] |= blocks
        else:
            last = [[r[3]], set(blocks) if alone else None, r[14]]
            want.append(last)
    got = extract.merge_wrapped(df).orderBy("line_no").collect()
    assert [r["text_1"] for r in got] == [" ".join(x[0]) for x in want]


def test_rows_merge_by_all_blocks_so_far(spark):
    """A question whose lines stand in blocks 1 and 2, 2, then 1 is one row: the third line shares a block with the first."""
    said = [(0, "why", 1), (0, "not", 2), (1, "go", 2), (2, "on", 1), (3, "next", 3)]
    words = [(1, 0, k, n, 90.0 + 22 * n, 100.0 + 12 * k, 110.0 + 22 * n, 110.0 + 12 * k, w, b) for n, (k, w, b) in enumerate(said)]
    df = spark.createDataFrame(words, "doc_id long, page_index int, line_no int, word_no int, x0 double, y0 double, x1 double, y1 double, word string, block int")
    assert [r["text_1"] for r in extract.rows(df).orderBy("row_ord").collect()] == ["why not go on", "next"]


def form_rows(spark):
    """Five rows of one page of a form: a question with narrower options, 14 points apart."""
    data = [(1, k + 1, f"p1_r00{k + 1}", 0, "Disposition", f"row {k}", "", (90.0, y, 280.0 if k == 2 else 250.0, y + 12)) for k, y in enumerate((700.0, 686.0, 672.0, 658.0, 620.0))]
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    df = spark.createDataFrame(data, f"doc_id long, row_ord int, row_id string, page_index int, form string, text_1 string, text_2 string, bbox_1 {box}")
    return df.withColumn("bbox_2", F.lit(None).cast(box)).withColumn("band", G.box(F.lit(0), F.col("bbox_1.y0") - 1, F.lit(612), F.col("bbox_1.y1") + 1))


def mark(spark, x0, y0, w=40.0, h=11.0, text="SEX"):
    return spark.createDataFrame([(1, 0, 1, (x0, y0, x0 + w, y0 + h), text, False, False, False, None)], "doc_id long, page_index int, mark_ord int, bbox struct<x0:double,y0:double,x1:double,y1:double>, text string, dashed boolean, muted boolean, boxed boolean, fill struct<r:double,g:double,b:double>")


@pytest.mark.parametrize(
    ("x0", "y0", "row", "placement"),
    [(254.0, 700.0, "p1_r001", "slot1"), (300.0, 700.4, "p1_r001", "slot2"), (90.0, 661.0, "p1_r003", "wrap"), (300.0, 659.0, "p1_r004", "band"), (300.0, 560.0, "p1_r005", "nearest"), (600.0, 20.0, None, None)],
)
def test_placements(spark, x0, y0, row, placement):
    m = recover.mappings(mark(spark, x0, y0))
    got = recover.match_rows(m, form_rows(spark)).collect()
    assert [(r["row_id"], r["placement"]) for r in got] == [(row, placement)]


def test_group_is_recovered(spark):
    """A box centred beside rows 3 to 5 comes back for each of them."""
    rows = form_rows(spark)
    blocks = layout.block_anchors(rows.filter("row_ord >= 3").withColumn("group_id", F.lit("g")), F.lit(612.0))
    placed = layout.place_groups(spark.createDataFrame([(1, "g", 1, "SUPPDS.QVAL")], "doc_id long, group_id string, slot int, shown string"), blocks).first()["bbox"]
    got = recover.match_rows(recover.mappings(mark(spark, placed["x0"], placed["y0"], text="SUPPDS.QVAL")), rows).orderBy("row_ord").collect()
    assert [r["row_id"] for r in got] == ["p1_r003", "p1_r004", "p1_r005"] and {r["placement"] for r in got} == {"group"}
    assert got[0]["member_row_ids"] == ["p1_r003", "p1_r004", "p1_r005"]


def test_votes_go_to_the_first_seen(spark):
    m = spark.createDataFrame([("variable", "X", d, s, k) for k, (d, s) in enumerate([("B", None), ("A", "banner"), ("A", "legend"), ("A", None), ("B", "banner")])], "kind string, variable string, domain string, domain_inference_source string, ord int")
    assert [tuple(r) for r in precedent.domain_votes(m).collect()] == [("X", "B", 2)] and precedent.domain_votes(m, 3).count() == 0


def test_support_does_not_fall_through(spark):
    rows = spark.createDataFrame([(1, 1, "Sex", "Male"), (1, 2, "", "Female"), (1, 3, "none", "")], "doc_id long, row_ord int, text_1 string, text_2 string")
    look = spark.createDataFrame([("sex:", "DM", "SEX", "", "", "1"), ("Sex / Male", "DM", "SEXM", "", "", "9"), ("FEMALE", "DM", "F1", "", "", "2"), ("female", "DM", "F2", "", "", "3")], "label string, domain string, variable string, condition string, fixed_value string, count string")
    got = {r["row_ord"]: r for r in precedent.match_precedent(rows, look).collect()}
    assert got[1]["variable"] == "SEX" and got[2]["variable"] == "F2" and "DM.F1 (n=2)" in got[2]["rationale"] and 3 not in got
    assert {r["row_ord"] for r in precedent.match_precedent(rows, look, 2).collect()} == {2}


def test_unannotated_row_ends_a_run(spark):
    rows = spark.createDataFrame([(1, k, f"r{k}", 0, "F") for k in range(1, 7)], "doc_id long, row_ord int, row_id string, page_index int, form string")
    said = [(1, f"r{k}", 1, 0, "variable", "DM", None, "A", None) for k in (1, 2, 4, 5, 6)]
    ann = spark.createDataFrame(said, "doc_id long, row_id string, slot int, page_index int, kind string, domain string, origin string, shown string, group_id string")
    got = {r["row_id"]: r["group_id"] for r in grouping.collapse_repeats(ann, rows).collect()}
    assert got == {"r1": "g_r1", "r2": "g_r1", "r4": "g_r4", "r5": "g_r4", "r6": "g_r4"}


def test_placement_wraps_and_keeps_clear(spark):
    unit = (1, 0, 1, 1, 100.0, 90.0, 600.0, 250.0, 612.0, 300.0, False)
    df = spark.createDataFrame([unit], "doc_id long, page_index int, unit long, slot int, w double, ax0 double, ay0 double, ax1 double, ay1 double, limit double, grouped boolean")
    near = spark.createDataFrame([(1, 0, 80.0, 590.0, 200.0, 598.0)], "doc_id long, page_index int, x0 double, y0 double, x1 double, y1 double")
    r = layout.place(df, near).first()
    assert (r["x0"], r["y0"]) == (90.0, 590.0 - 12.0 - 1.5)
    r = layout.place(df.withColumn("limit", F.lit(400.0)), near).first()
    assert (r["x0"], r["y0"], r["x1"]) == (254.0, 600.0, 354.0)


def plain_places(units, printed):
    """The rule of placement, box by box: one page's units (unit, grouped, anchor, limit, widths), in order, among printed text."""
    hits = lambda a, b: min(a[2] + 1.5, b[2]) - max(a[0] - 1.5, b[0]) > 1 and min(a[3] + 1.5, b[3]) - max(a[1] - 1.5, b[1]) > 1
    taken, edge, out = list(printed), {}, {}
    for unit, grouped, (ax0, ay0, ax1, ay1), limit, widths in sorted(units, key=lambda u: (u[0], not u[1])):
        made, used, y, h = [], 0, ay0, max(11.0, ay1 - ay0)
        x = edge[unit] + 3 if not grouped and edge.get(unit, ax1) > ax1 else ax1 + 4
        for slot, w in enumerate(widths, 1):
            if grouped:
                b = (x, ay0 + (ay1 - ay0 - 11) / 2, x + w, ay0 + (ay1 - ay0 - 11) / 2 + 11)
                edge[unit] = b[2]
            else:
                if x + w > limit and ax0 + w <= limit and used < 6:
                    x, y, used = ax0, y - 11, used + 1
                b = (x, y, x + w, y + h)
                while 0 < used <= 6:
                    stops = [t for t in taken if hits(b, t)]
                    if not stops and b[0] >= 6 and b[1] >= 6 and b[2] <= 606 and b[3] <= 786:
                        break
                    y = min(t[1] for t in stops) - h - 1.5 if stops else y - 11
                    used += 1
                    b = (x, y, x + w, y + h)
            made.append(b)
            out[unit, grouped, slot] = b
            x = b[2] + 3
        taken += made
    return out


def test_placement_of_pages(spark):
    """Random crowded pages against the rule, box by box."""
    rng = np.random.default_rng(6)
    units, printed, want = [], [], set()
    for page in range(40):
        words = [(x, y, x + rng.uniform(20, 200), y + 9) for x, y in zip(rng.uniform(20, 400, 40), rng.uniform(0, 780, 40), strict=True)]
        printed += [(1, page, *map(float, w)) for w in words]
        own = []
        for unit in range(12):
            y = float(760 - 60 * unit + rng.uniform(-20, 20))
            box = (60.0, y, float(rng.uniform(100, 420)), y + float(rng.choice([8, 11, 14])))
            limit, grouped = float(rng.uniform(200, 606)), bool(rng.random() < 0.3)
            for g in ([True, False] if grouped else [False]):
                widths = [float(x) for x in rng.uniform(20, 260, rng.integers(1, 4))]
                own.append((unit, g, box, limit, widths))
                units += [(1, page, unit, slot, w, *box, limit, g) for slot, w in enumerate(widths, 1)]
        want |= {(page, unit, slot, *[round(v, 6) for v in b]) for (unit, _, slot), b in plain_places(own, words).items()}
    df = spark.createDataFrame(units, "doc_id long, page_index int, unit long, slot int, w double, ax0 double, ay0 double, ax1 double, ay1 double, limit double, grouped boolean")
    around = spark.createDataFrame(printed, "doc_id long, page_index int, x0 double, y0 double, x1 double, y1 double")
    got = [tuple(r)[1:] for r in layout.place(df, around).collect()]
    assert len(got) == len(units) and {(p, u, s, *[round(v, 6) for v in b]) for p, u, s, *b in got} == want


def test_replies(spark):
    texts = spark.createDataFrame([(1, "Sure\n| Row ID | Variable |\n|---|---|\n| r1 | age |\n| r2 |\n\nbye"), (2, 'x\nrow_id,variable\nr1,"a, b"\n\nend'), (3, "no table"), (4, None)], "doc_id long, text string")
    rows, errors = reply.parse(texts)
    assert [(r["doc_id"], r["row"]) for r in rows.collect()] == [(2, {"row_id": "r1", "variable": "a, b"})]
    assert {(r["doc_id"], r["error"]) for r in errors.collect()} == {(1, "1 cells under 2 headers"), (3, "no table found"), (4, "no table found")}


def test_delimited_replies(spark):
    """Empty first cells, delimiters, quotes and line ends within quotes, cells beyond the header and missing ones."""
    text = 'row_id;kind;variable;origin;rationale\n;variable;SEX;Guessed;\nr2;;"a;b";;"one\ntwo ""x"""\nr3;note\nr4;;C;;d;e;f\n\'r5\';;5" thing;;\n\nbye'
    texts = spark.createDataFrame([(1, text), (2, "row_id\tvariable\n\tX\nr1\t")], "doc_id long, text string")
    heads = {1: ("row_id", "kind", "variable", "origin", "rationale"), 2: ("row_id", "variable")}
    got = [(r["doc_id"], tuple(r["row"][h] for h in heads[r["doc_id"]])) for r in reply.parse(texts)[0].orderBy("doc_id", "n").collect()]
    assert got == [
        (1, ("", "variable", "SEX", "Guessed", "")), (1, ("r2", "", "a;b", "", 'one\ntwo "x"')), (1, ("r3", "note", "", "", "")), (1, ("r4", "", "C", "", "d")), (1, ("'r5'", "", '5" thing', "", "")),
        (2, ("", "X")), (2, ("r1", "")),
    ]


def test_wrong_rows_are_told_and_their_reply_gives_nothing(spark):
    head = "row_id,kind,variable,variable2,origin,confidence\n"
    texts = spark.createDataFrame([(1, head + ",variable,SEX,,Collected,"), (2, head + "r1,variable,SEX,,Guessed,2\nr2,thing,A,,,x"), (3, head + "r1,,age,ageu,EDT,0.5\nr2,NOTE,,,not submitted,Not Applicable")], "doc_id long, text string")
    good, errors = reply.proposals(reply.parse(texts)[0])
    assert {tuple(r) for r in errors.select("doc_id", "row_id", "error").collect()} == {
        (1, None, "missing row_id"), (2, "r1", "unknown origin: Guessed"), (2, "r1", "confidence is not from 0 to 1: 2"), (2, "r2", "unknown kind: thing"), (2, "r2", "confidence is not from 0 to 1: x"),
    }
    assert sorted((r["row_id"], r["slot"], r["kind"], r["variable"], r["origin"], r["confidence"]) for r in good.collect()) == [("r1", 1, "variable", "AGE", "eDT", 0.5), ("r1", 2, "variable", "AGEU", "eDT", 0.5), ("r2", 1, "note", None, "NotSubmitted", None)]


def test_notes_of_the_sheet(spark):
    """A note takes the next slot: alone it is a note in slot 1, beside anno1 a variable in slot 2, after slot 2 a note."""
    said = [(k, f"r{k}", a1, a2, note, status, by) for k, (a1, a2, note, status, by) in enumerate([("AE.X", "", "", "accepted", "me"), ("AE.X", "", "AE.Y", "proposed", ""), ("", "B", "C", "proposed", ""), ("", "", "see p. 2", "edited", ""), ("A", "B", "AE.C = 1", "", "")], 1)]
    lines = review.read_lines(spark.createDataFrame([(1, k + 1, r, a1, a2, note, st, by, "dm", "", "") for k, r, a1, a2, note, st, by in said], "doc_id long, excel_row int, row_id string, anno1 string, anno2 string, note string, review_status string, reviewed_by string, domain string, `group` string, origin string"))
    rows = spark.createDataFrame([(1, k, f"r{k}", 0) for k in range(1, 6)], "doc_id long, row_ord int, row_id string, page_index int")
    got = [(r["row_id"], r["slot"], r["kind"], r["domain"], r["variable"], r["fixed_value"]) for r in review.to_annotations(lines, rows).orderBy("row_ord", "slot", "shown").collect()]
    assert got == [
        ("r1", 1, "variable", "AE", "X", None), ("r2", 1, "variable", "AE", "X", None), ("r2", 2, "variable", "AE", "Y", None), ("r3", 2, "variable", "DM", "B", None), ("r3", 2, "note", "DM", "C", None),
        ("r4", 1, "note", "DM", None, None), ("r5", 1, "variable", "DM", "A", None), ("r5", 2, "note", "AE", "C", "1"), ("r5", 2, "variable", "DM", "B", None),
    ]
    assert [tuple(r) for r in review.errors(lines, rows).select("row_id", "error", "excel_rows").collect()] == [("r4", "reviewed by nobody", "5")]


def test_batches(spark):
    pages = spark.createDataFrame([(1, k, n) for k, n in enumerate([100, 60, 200, 10, 140])], "doc_id long, page_index int, n int")
    assert [r["batch"] for r in reply.batches(pages).orderBy("page_index").collect()] == [1, 2, 3, 4, 4]


def test_xfdf_round_trip(spark):
    a = spark.createDataFrame([(1, "a1", 0, (1.0, 2.0, 3.0, 4.0), 'A < "B" & C', "variable", "#BFFFFF", "proposed", "r1"), (1, "a2", 0, (1.0, 2.0, 3.0, 9.0), "é", "note", None, "accepted", None), (1, "a3", 0, (1.0, 2.0, 3.0, 9.0), "no", "note", None, "rejected", None)], "doc_id long, annot_id string, page_index int, bbox struct<x0:double,y0:double,x1:double,y1:double>, shown string, kind string, color string, review_status string, row_id string")
    got = xfdf.parse(xfdf.texts(a)).collect()
    assert [(r["name"], r["contents"], r["color"], r["rect"]) for r in got] == [("a2", "é", "#7A7A7A", "1.000,2.000,3.000,9.000"), ("a1", 'A < "B" & C', "#BFFFFF", "1.000,2.000,3.000,4.000")]
    assert got[1]["meta"] == {"row_id": "r1", "review_status": "proposed"} and got[0]["error"] is None
    bad = spark.createDataFrame([(1, "<xfdf><annots><square page='1'/></annots></xfdf>"), (2, "<x")], "doc_id long, xfdf string")
    assert sorted(r["error"][:7] for r in xfdf.parse(bad).collect()) == ["no XML:", "no rect"]


def test_workbook_round_trip(spark):
    rows = form_rows(spark)
    ann = spark.createDataFrame([(1, "p1_r001", [], 1, "DM.SEX <&", "DM", None, None, "m", "accepted", "me", 1), (1, "p1_r002", ["p1_r002", "p1_r003"], 1, "X", "DM", None, "g1", "m", "proposed", "", 2)], "doc_id long, row_id string, member_row_ids array<string>, slot int, shown string, domain string, origin string, group_id string, source_model string, review_status string, reviewed_by string, ord int")
    sheet = review.sheet(rows, ann)
    lines, errors = xlsx.lines(xlsx.workbooks(sheet))
    got = {r["row_id"]: r for r in lines.collect()}
    assert errors.isEmpty() and [r["excel_row"] for r in lines.orderBy("excel_row").collect()] == [2, 3, 4, 5, 6]
    assert got["p1_r001"]["anno1"] == "DM.SEX <&" and got["p1_r001"]["review_status"] == "accepted" and got["p1_r003"]["anno1"] == "" and got["p1_r003"]["group"] == "g1"
    assert review.errors(lines, rows).isEmpty()
    assert [r["shown"] for r in review.to_annotations(lines, rows).orderBy("row_ord").collect()] == ["DM.SEX <&", "X"]


def test_tables_round_trip(spark, tmp_path):
    look = spark.createDataFrame([('a "q", b', "c\nd", "DM", "SEX", "", "", "3", "x; y")], ", ".join(f"{c} string" for c in tables.LOOKUP))
    tables.write_lookup(look, f"{tmp_path}/l")
    assert tables.read_lookup(spark, f"{tmp_path}/l").collect() == look.collect()
    rows = form_rows(spark)
    tables.write_documents(rows, f"{tmp_path}/r")
    assert tables.read_documents(spark, f"{tmp_path}/r", rows.schema).orderBy("row_ord").collect() == rows.orderBy("row_ord").collect()
    tables.write_report(recover.mappings(mark(spark, 1.25, 2.0)), f"{tmp_path}/m")
    assert spark.read.csv(f"{tmp_path}/m", header=True).first()["bbox_y0"] == "2.0"


def test_stream(spark, tmp_path):
    words = testbed.words(spark, SF).filter("doc_id < 5")
    words.write.parquet(f"{tmp_path}/in")
    stream.extract_rows(stream.watch(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/ck", header=testbed.HEADER).awaitTermination(180)
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    assert got.count() == extract.rows(words, header=testbed.HEADER).count() > 0


def test_empty_forms(spark):
    none = testbed.words(spark, SF).filter("false")
    assert extract.rows(none).count() == 0 and extract.assign_lines(none).count() == 0
