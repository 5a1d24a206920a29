"""What fails or grows only on larger tables or under other settings."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formloom.functions import geometry as G
from formloom.operators import extract, recover, reply, review
from formloom.plans import queries, testbed

SMALL = "/root/testdata/sf0.01"


@pytest.fixture
def settings(spark):
    """Sets of the session, taken back at the end."""
    was = {}

    def put(**kv):
        for k, v in kv.items():
            k = "spark.sql." + k.replace("_", ".")
            was.setdefault(k, spark.conf.get(k))
            spark.conf.set(k, v)

    yield put
    for k, v in was.items():
        spark.conf.set(k, v)


def test_rows_with_small_broadcasts(spark, settings):
    """Sides that turn out small are broadcast on the way: no stage may stand on how a union of others was dealt."""
    settings(autoBroadcastJoinThreshold="256k", shuffle_partitions="12", files_maxPartitionBytes="16m", adaptive_advisoryPartitionSizeInBytes="8m")
    rows = testbed.crf_rows(spark, SMALL)
    assert rows.count() == 37030 == rows.select("doc_id", "row_ord").distinct().count()


def by_relations(run, width=612.0, height=792.0, header=extract.FORM_HEADER):
    """Rows as the relations of pages, lines and records tell them, sent by page and line."""
    w, h, page = F.lit(width), F.lit(height), ["doc_id", "page_index"]
    pages = run.select(*page).distinct()
    bands = extract.line_bands(extract.line_rects(run), w, h).select(*page, "line_no", "band")
    merged = extract.merge_wrapped(extract.assemble(run, extract.page_gutters(run, pages, w)).join(bands, [*page, "line_no"], "left"))
    n = F.row_number().over(W.partitionBy(*page).orderBy("line_no"))
    corner = lambda k: F.when(F.col(f"x0_{k}").isNotNull(), G.flip(G.box(*[F.col(f"{c}_{k}") for c in ("x0", "y0", "x1", "y1")]), h))
    return merged.join(extract.forms(run, pages, header), page).select(
        "doc_id", F.row_number().over(W.partitionBy("doc_id").orderBy("page_index", "line_no")).alias("row_ord"), F.format_string("p%d_r%03d", F.col("page_index") + 1, n).alias("row_id"), "page_index", "form", "text_1", "text_2",
        corner(1).alias("bbox_1"), corner(2).alias("bbox_2"), G.flip(F.col("band"), h).alias("band"), "full_width",
    )


def test_rows_send_nothing(spark):
    rows = extract.rows_of(testbed.runs(spark, "/root/testdata/sf0.001"), header=testbed.HEADER, together=True)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(rows.collect()) == sorted(by_relations(testbed.runs(spark, "/root/testdata/sf0.001"), header=testbed.HEADER).collect())


def test_rows_of_odd_pages(spark, settings):
    """Pages of one or two columns, of no words or few, lines in several blocks or none, lines that overlap, blank texts, batches that cut anywhere."""
    rng, words = random.Random(7), []
    for doc in range(40):
        for page in range(rng.choice([1, 2, 5])):
            gap, y = rng.choice([0, 0, 60, 200]), 20.0
            for line in range(rng.choice([1, 3, 12, 30])):
                y += rng.choice([12.0, 14.0, 3.0, 0.0])
                x = 90.0
                for k in range(rng.choice([1, 2, 4, 9])):
                    x += rng.choice([3.0, 3.0, 5.0, 12.0, gap])
                    said = rng.choice(["a", "bc", "Form:", "\u00a0", "q", None]) if rng.random() < 0.5 else "word"
                    words.append((f"d{doc}", page, line, k, x, y, x + 5.0 * len(said or "xx"), y + rng.choice([10.0, 10.0, 8.5]), said, rng.choice([line // 3, line // 3, line // 3 + 1, None])))
                    x = words[-1][6]
    df = spark.createDataFrame(words, "doc_id string, page_index int, line_no int, word_no int, x0 double, y0 double, x1 double, y1 double, word string, block int")
    want = sorted(map(str, by_relations(extract.runs(df)).collect()))
    assert len(want) > 500 and any("Row(x0=" in w.split("bbox_2=")[1][:8] for w in want)
    for n in ("10000", "7"):
        settings(execution_arrow_maxRecordsPerBatch=n)
        assert sorted(map(str, extract.rows(df).collect())) == want


def test_runs_of_lines_that_come_whole(spark, settings):
    """No word of the tables is sent, and batches that cut lines and words in any order make no difference."""
    settings(execution_arrow_maxRecordsPerBatch="7")
    run = testbed.runs(spark, "/root/testdata/sf0.001")
    assert "Exchange" not in run._jdf.queryExecution().executedPlan().toString()
    sent = extract.runs(testbed.words(spark, "/root/testdata/sf0.001").orderBy("word", "word_no"))
    assert sorted(run.collect()) == sorted(sent.collect())


def test_runs_of_odd_words(spark):
    """Null words and blocks, words within others, names as ids, no words."""
    kind = "doc_id string, page_index int, line_no int, word_no int, x0 double, y0 double, x1 double, y1 double, word string, block string"
    words = [("a", 0, 0, 2, 9.0, 0.0, 12.0, 10.0, None, "y"), ("a", 0, 0, 1, 0.0, 0.0, 30.0, 10.0, "wide", "x"), ("a", 0, 0, 3, 33.0, 0.0, 40.0, 10.0, "near", None), ("a", 0, 0, 4, 47.0, 0.0, 50.0, 10.0, "far", "x"), (None, 0, 0, 1, 0.0, 0.0, 1.0, 1.0, None, None)]
    got = extract.runs(spark.createDataFrame(words, kind)).orderBy("doc_id", "run_no").collect()
    assert [(r["doc_id"], r["run_no"], r["x0"], r["x1"], r["text"], r["blocks"]) for r in got] == [(None, 0, 0.0, 1.0, "", []), ("a", 0, 0.0, 40.0, "wide near", ["x", "y"]), ("a", 1, 47.0, 50.0, "far", ["x"])]
    assert not extract.runs(spark.createDataFrame([], kind)).collect()


def test_rectangles_are_parsed_without_folds(spark):
    """Compiled with the rest of a stage: no function over an array's items, which is worked out item by item."""
    texts = ["1, 2,3 4", " 4 3 2 1 ", "1 2 x 4", "1,2,3", "", None, ",1 2 3 4", "1 2 3 4 5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", G.parse_rect(F.col("t")).alias("b"))
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = [tuple(r["b"]) if r["b"] else None for r in df.collect()]
    assert got == [(1.0, 2.0, 3.0, 4.0), (2.0, 1.0, 4.0, 3.0), None, None, None, None, (1.0, 2.0, 3.0, 4.0), None]


def test_files_that_arrive_are_as_many_as_partitions(spark, settings):
    """No task reads all mappings or a fixed share of them."""
    settings(shuffle_partitions="16")
    folder, _ = queries.arriving(spark.range(4000).selectExpr("id AS x"), "x % 5 = 0")
    told = spark.read.parquet(folder)
    assert told.count() == 4800 and len(told.inputFiles()) == 20


def test_first_fit_sends_no_word(spark, settings):
    """Pages of the tables come whole: lines by first fit need no shuffle; sent in any order, words and runs fall into the same lines."""
    settings(execution_arrow_maxRecordsPerBatch="7")
    sf = "/root/testdata/sf0.001"
    for name in ("line_growth", "run_split_folded", "line_regroup"):
        assert "Exchange" not in queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString(), name
    words = testbed.words(spark, sf)
    assert sorted(queries.run_split_folded(spark, sf).collect()) == sorted(extract.folded_runs(words.drop("line_no").orderBy("word", "word_no")).drop("blocks").collect())
    run = testbed.runs(spark, sf)
    assert sorted(extract.lines_of(run.orderBy("text", "x0")).collect()) == sorted(extract.lines_of(run, together=True).collect())


@pytest.mark.parametrize("grows", [True, False])
def test_first_fit_against_a_plain_version(grows):
    """Random extents with none, null and no number among them, page by page."""
    rng, nan = random.Random(5), float("nan")
    for odd in (0, 0.1):
        page, top, bottom, want = [], [], [], []
        for p in range(60):
            a = sorted(rng.choice([0, 1, 4, 9]) + 3 * rng.randrange(30) for _ in range(rng.randrange(1, 50)))
            b = [x + rng.choice([0, 1, 5, 10, 10, 40, -2]) for x in a]
            a, b = ([rng.choice([None, nan]) if rng.random() < odd else float(x) for x in v] for v in (a, b))
            page, top, bottom, want = page + [p] * len(a), top + a, bottom + b, want + extract.first_fit_odd(a, b, grows)
        got = extract.first_fit(np.array(page), pa.chunked_array([pa.array(top, pa.float64())]), pa.chunked_array([pa.array(bottom, pa.float64())]), grows)
        assert got.tolist() == want


def test_replies_are_read_where_they_lie(spark):
    """No text is sent to be parsed, and each is read by itself, even of one id; rows that are wrong are told without a shuffle."""
    texts = spark.createDataFrame([(1, "x\n| row_id | kind |\n|---|---|\n| r1 | note |"), (1, "row_id;kind\nr2;note\n\nrow_id;kind\nr3;note"), (1, "none"), (1, None)], "doc_id long, text string")
    rows, errors = reply.parse(texts)
    for df in (rows, errors, reply.proposals(rows)[1]):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["n"], r["row"]["row_id"]) for r in rows.collect()) == [(1, "r2"), (3, "r1")]
    assert [r["error"] for r in errors.collect()] == ["no table found"] * 2


def test_sheet_errors_read_lines_once(spark):
    """One pass over a sheet's lines for all kinds of errors, and one over the form's rows."""
    columns = ["doc_id", "excel_row", "row_id", "anno1", "anno2", "note", "review_status", "reviewed_by", "origin"]
    told = [(1, 2, "r1", "A", "", "", "open", "", ""), (1, 3, "r1", "B", "C", "", "proposed", "", "who"), (1, 4, "r9", "", "", "x", "accepted", "", "")]
    out = review.errors(spark.createDataFrame(told, columns), spark.createDataFrame([(1, "r1"), (1, "r1")], ["doc_id", "row_id"]))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
    got = sorted((r["row_id"], r["error"], r["n"], r["excel_rows"]) for r in out.collect())
    assert got == [("r1", "slot filled twice: 1", 2, "2, 3"), ("r1", "unknown origin", 1, "3"), ("r1", "unknown status", 1, "2"), ("r9", "reviewed by nobody", 1, "4"), ("r9", "unknown row", 1, "4")]


def test_masked_words_are_not_sent(spark, settings, monkeypatch):
    """Pages of the tables come whole; a stretch of words at a time, they are those that the join of words and rectangles leaves."""
    settings(execution_arrow_maxRecordsPerBatch="7")
    monkeypatch.setattr(extract, "PAIRS", 50)
    sf = "/root/testdata/sf0.001"
    got, words = queries.mask_words(spark, sf), testbed.words(spark, sf)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    rects = words.filter("word_no = 4 and line_no % 2 = 0").select("doc_id", "page_index", G.box(F.col("x0"), F.col("y0"), F.col("x1") + 20, F.col("y1")).alias("rect"))
    assert sorted(got.collect()) == sorted(extract.mask_words(words, rects).select(got.columns).collect())


def test_blocks_of_many_pages_at_once(spark):
    """Pages of any number of marks and rows, odd ones among them: as each page by itself; and all rows are met by as many steps as one page has."""
    rng, parts = np.random.default_rng(5), []
    for p in range(60):
        n, m = int(rng.integers(0, 30)), int(rng.integers(0, 30))
        high = 780 - np.cumsum(rng.choice([14.0, 12.0, 28.0], n))
        q = rng.choice([250.0, 260.0, 310.5, np.nan], n)
        x, y = rng.choice([250.0, 260.0, 310.5, 450.0, 100.0], m) + G.GAP + rng.choice([0, 0.3, -0.5, 5.0], m), rng.uniform(300, 780, m)
        y[: p % 5 == 0] = np.nan
        parts.append((x, y, q, np.where(np.isnan(q), 450.0, q), high - 10, high))
    marked, page = (np.repeat(np.arange(60), [len(p[c]) for p in parts]) for c in (0, 2))
    start, length = recover.smallest_blocks(*(np.concatenate([p[c] for p in parts]) for c in range(6)), marked, page)
    each = [recover.smallest_blocks(*p) for p in parts]
    assert start.tolist() == [v for s, _ in each for v in s] and length.tolist() == [v for _, n in each for v in n] and (length > 1).sum() > 50
    arrays = [pa.array(range(60)), pa.array([0] * 60), *[pa.array([list(range(len(p[0]))) for p in parts], pa.list_(pa.int32())) for _ in (0,)], *[pa.array([p[c].tolist() for p in parts], pa.list_(pa.float64())) for c in range(6)]]
    batch = pa.RecordBatch.from_arrays(arrays, ["doc_id", "page_index", "mark_ord", "x", "y", "q", "right", "low", "high"])
    got = pa.Table.from_batches([*recover.blocks_of_pages(iter([batch.slice(7, 40)]))])
    own = (marked >= 7) & (marked < 47) & (length > 0)
    assert got["doc_id"].to_pylist() == marked[own].tolist() and got["start"].to_pylist() == start[own].tolist() and got["length"].to_pylist() == length[own].tolist()


def test_marks_meet_rows_once(spark):
    """What finds no row by its strip is told from the same join as what does; the rows are as before."""
    rows, _, m = queries.attributed(spark, "/root/testdata/sf0.001")
    out = recover.match_rows(m, rows)
    got = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("Join" in line and "_strip" in line for line in plan.splitlines()) == 1
    assert {r["placement"] for r in got} >= {None, "slot1", "slot2", "wrap", "band", "group", "nearest"} and len({(r["doc_id"], r["page_index"], r["mark_ord"]) for r in got}) == m.count()
