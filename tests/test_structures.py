"""Folds, indexes, merges, named files, streams and the session's views, each against a plain version or by its rule."""

import os
import random
import subprocess
import sys
import time
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from formloom.functions import geometry as G
from formloom.functions import text as T
from formloom.operators import extract, layout, precedent, prefix, recover, reply, review
from formloom.plans import session, testbed
from formloom.sources import named, tables, xfdf
from formloom.streaming import votes

WORDS = "doc_id string, page_index int, word_no int, x0 double, y0 double, x1 double, y1 double, word string, block int"


def fit(items, grows):
    """Lines by first fit, as the rule says: items (y0, y1) in order; a line's extent grows or stays its first item's."""
    lines, at = [], []
    for y0, y1 in items:
        for k, (a, b) in enumerate(lines):
            if max(0.0, min(b, y1) - max(a, y0)) / max(min(b - a, y1 - y0), 1e-6) >= 0.5:
                if grows:
                    lines[k] = (min(a, y0), max(b, y1))
                at.append(k)
                break
        else:
            lines.append((y0, y1))
            at.append(len(lines) - 1)
    return lines, at


def test_first_fit_of_words_and_of_runs(spark):
    rng = random.Random(4)
    rows = [(f"{d}.pdf", 0, n, rng.uniform(0, 500), y := rng.uniform(0, 80), 600.0, y + rng.choice([6.0, 10.0, 16.0]), f"w{n}", n) for d in range(4) for n in range(60)]
    df = spark.createDataFrame(rows, WORDS).repartition(3)
    got = {(r["doc_id"], r["word_no"]): r["line_no"] for r in extract.assign_lines(df).collect()}
    runs = df.select("doc_id", "page_index", F.lit(0).alias("line_no"), F.col("word_no").alias("run_no"), "x0", "y0", "x1", "y1", F.col("word").alias("text"))
    regrouped = {(r["doc_id"], r["text"]): (r["line_no"], r["run_no"]) for r in extract.lines_of(runs).collect()}
    differ = 0
    for d in {r[0] for r in rows}:
        own = sorted([r for r in rows if r[0] == d], key=lambda r: (r[4], r[3]))
        _, at = fit([(r[4], r[6]) for r in own], True)
        assert [got[d, r[2]] for r in own] == at
        own = sorted(own, key=lambda r: r[2])
        lines, fixed = fit([(r[4], r[6]) for r in own], False)
        order = sorted(range(len(lines)), key=lambda k: lines[k][0])
        want = {}
        for place, k in enumerate(order):
            for n, r in enumerate(sorted([r for r, a in zip(own, fixed, strict=True) if a == k], key=lambda r: r[3])):
                want[r[7]] = (place, n)
        assert {t: v for (doc, t), v in regrouped.items() if doc == d} == want
        differ += len(lines) != len(fit([(r[4], r[6]) for r in own], True)[0])
    assert differ


def test_forms_with_names_as_ids_and_lines_of_many_blocks(spark):
    """Words without lines, of forms that are told by a file's name; a question's lines share a block with all before them."""
    said = [(0, "why", 1), (0, "not", 2), (1, "go", 2), (2, "on", 1), (3, "next", 3)]
    words = [(f"{f}.pdf", 0, n, 90.0 + 22 * n, 100.0 + 12 * k, 110.0 + 22 * n, 110.0 + 12 * k, w, b) for f in "ab" for n, (k, w, b) in enumerate(said)]
    rows = extract.rows(spark.createDataFrame(words, WORDS)).orderBy("doc_id", "row_ord").collect()
    assert [(r["doc_id"], r["row_id"], r["text_1"]) for r in rows] == [(f"{f}.pdf", *x) for f in "ab" for x in (("p1_r001", "why not go on"), ("p1_r002", "next"))]


def plain_blocks(x, y, q, right, low, high):
    out = []
    for a, c in zip(x, y, strict=True):
        best = (0, 0)
        for n in range(2, len(right) + 1):
            for s in range(len(right) - n + 1):
                own = [v for v in q[s : s + n] if not np.isnan(v)]
                edge, centre = max(own or right[s : s + n]) + 4, (min(low[s : s + n]) + max(high[s : s + n])) / 2
                if not best[1] and abs(a - edge) <= recover.ALIGN and abs(c - centre) <= recover.GROUP_CENTRE:
                    best = (s + 1, n)
            if best[1]:
                break
        out.append(best)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_smallest_blocks(seed):
    """Pages in any order of height, of few and of many edges."""
    rng = np.random.default_rng(seed)
    n, m = 25, 40
    low = np.cumsum(rng.uniform(8, 20, n))[::-1].copy() if seed % 2 else rng.uniform(0, 700, n)
    high, right = low + rng.choice([8.0, 11.0, 24.0], n), rng.choice([100.0, 140.0, 140.5, 200.25], n)
    q = np.where(rng.random(n) < 0.3, np.nan, right - rng.choice([0.0, 20.0], n))
    x, y = rng.choice([84.0, 104.0, 124.3, 144.2, 204.0, 204.8], m), rng.uniform(0, 700, m)
    start, length = recover.smallest_blocks(x, y, q, right, low, high)
    assert list(zip(start.tolist(), length.tolist(), strict=True)) == plain_blocks(x, y, q, right, low, high)
    assert length.any()


def test_smallest_blocks_of_a_long_page():
    n = 2000
    low = np.arange(n)[::-1] * 14.0
    rng, right = np.random.default_rng(1), np.full(n, 250.0)
    x, y = np.full(n, 254.0), rng.uniform(-200, n * 14.0, n)
    began = time.time()
    _, length = recover.smallest_blocks(x, y, right, right, low, low + 12)
    assert time.time() - began < 60 and (length > 0).sum() > 0.9 * n and length.max() <= 3


def test_nearest_banner_above(spark):
    box = lambda y: (90.0, y, 130.0, y + 11)
    said = [(1, "domain", "DM", box(700.0)), (2, "domain", "AE", box(600.0)), (3, "domain", "VS", box(600.0)), (4, "variable", None, box(650.0)), (5, "variable", None, box(589.0)), (6, "variable", None, box(589.5)), (7, "variable", None, box(750.0)), (8, "variable", "LB", box(500.0)), (9, "note", None, box(400.0))]
    df = spark.createDataFrame([("a.pdf", 0, n, kind, dom, b, "XXVAR" if kind == "variable" else None, None) for n, kind, dom, b in said], "doc_id string, page_index int, mark_ord int, kind string, domain string, bbox struct<x0:double,y0:double,x1:double,y1:double>, variable string, fill string")
    out = recover.attribute_domains(df)
    assert {r["mark_ord"]: (r["domain"], r["domain_inference_source"]) for r in out.filter("mark_ord > 3").collect()} == {4: ("DM", "banner"), 5: ("AE", "banner"), 6: ("DM", "banner"), 7: (None, None), 8: ("LB", None), 9: (None, None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_functions_travel_by_value(tmp_path):
    """A worker that has no copy of the package places boxes all the same."""
    (tmp_path / "f").write_bytes(cloudpickle.dumps(layout.settle_page))
    code = f"import pickle, sys; assert not any('repo' in p for p in sys.path); print(pickle.load(open({str(tmp_path / 'f')!r}, 'rb'))([], [(1, 1, 0, 254.0, 600.0, 90.0, 100.0, 11.0, 300.0)], 612.0, 792.0))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    assert out.stdout.strip() == "[(0, 1, 90.0, 589.0, 190.0, 600.0)]"


def plain_appendix(labels, docs, most):
    out = {}
    for d, words in docs.items():
        best = sorted(((-len(set(words) & set(ws)), -n, label) for label, (n, ws) in labels.items() if set(words) & set(ws)))[:most]
        out[d] = [(label, -o) for o, _, label in best]
    return out


@pytest.mark.parametrize("light", [1, 3, 1000])
def test_appendix(spark, light):
    rng = random.Random(light)
    vocabulary = [f"word{k}" for k in range(40)] + ["the"] * 30 + ["form"] * 10
    labels = {" ".join(dict.fromkeys(rng.choices(vocabulary, k=4))) + f" l{n}": n % 7 for n in range(60)}
    docs = {d: list(dict.fromkeys(rng.choices(vocabulary, k=8))) for d in range(30)}
    lookup = spark.createDataFrame(list(labels.items()), "label string, count int")
    words = spark.createDataFrame([(d, w) for d, ws in docs.items() for w in ws], "doc_id long, word string")
    got = {}
    for r in reply.appendix(lookup, words, 5, light).orderBy("doc_id", "place").collect():
        got.setdefault(r["doc_id"], []).append((r["label"], r["overlap"]))
    assert got == {d: v for d, v in plain_appendix({label: (n, [w for w in label.split() if len(w) > 2]) for label, n in labels.items()}, docs, 5).items() if v}


def test_appendix_of_one_word_that_all_share(spark):
    lookup = spark.range(600).select(F.concat(F.lit("the label "), "id").alias("label"), (F.col("id") % 50).cast("int").alias("count"))
    words = spark.range(300).select(F.col("id").alias("doc_id"), F.explode(F.array(F.lit("the"), F.concat(F.lit("own"), "id"))).alias("word"))
    assert reply.appendix_pairs(lookup, words, 20).count() == 300 * 20
    assert reply.appendix(lookup, words, 20).filter("place = 1").select("label").distinct().collect()[0][0] == "the label 149"


def test_appendix_of_batches_that_lie_in_parts(spark, monkeypatch):
    """As the joins tell it, whatever is counted at once; ids that come twice are one batch, and only known words are sent."""
    rng = random.Random(5)
    vocabulary = [f"w{n}a" for n in range(50)] + ["the"] * 30
    lookup = spark.createDataFrame([(" ".join(rng.choices(vocabulary, k=4)) + f" é{n}", n % 5) for n in range(80)] + [("an", 9)], "label string, count int")
    told = [(d % 25 if d % 7 else None, rng.choices([*vocabulary, "unknown"], k=rng.randrange(9)) or None) for d in range(60)]
    batches = spark.createDataFrame(told, "doc_id long, words array<string>")
    words = batches.select("doc_id", F.explode("words").alias("word")).filter("doc_id is not null")
    rows = lambda df: sorted(map(tuple, df.filter("doc_id is not null").select("doc_id", "label", "overlap", "count", "place").collect()))
    expected = rows(reply.appendix(lookup, words, 5))
    assert rows(reply.appendix_of(lookup, batches, 5)) == expected == rows(reply.appendix_of(lookup, batches, 5, held=1))
    monkeypatch.setattr(reply, "COUNTED", 100)
    assert rows(reply.appendix_of(lookup, batches, 5)) == expected
    assert reply.appendix_of(lookup.filter("false"), batches).isEmpty() and reply.appendix_of(lookup, batches.filter("false")).isEmpty()


def test_lookup_table_of_mappings_of_one_place_in_order(spark):
    """Of one `ord` the table's order tells files, label and context apart, as the SQL does when one thread reads it."""
    told = [("Age ", "b", "s2", 7, 1), ("AGE", "a", "s1", 7, 2), ("age", "c", "s0", 9, 0), ("age", "d", "s3", 7, 3)]
    m = spark.createDataFrame(told, "label string, context string, source_pdf string, ord long, at long")
    m = m.select("*", *[F.lit(v).alias(c) for c, v in (("kind", "variable"), ("row_id", "r"), ("domain", "DM"), ("variable", "AGE"), ("condition", None), ("fixed_value", None))])
    assert [tuple(r)[:2] + tuple(r)[-2:] for r in precedent.lookup_table(m).collect()] == [("Age ", "b", 4, "s2; s1; s3; s0")]
    assert precedent.lookup_table(m.drop("at")).first()["sample_pdfs"] == "s1; s2; s3; s0"


def test_prefix_lookup(spark):
    keys = spark.createDataFrame([("Form", "f", 3), ("Form: De", "fd", 9), ("Page ", "p", 1), ("Page 1", "p1", 2), ("exactly", "e", 8), ("exact", "x", 0), ("", "none", 0), (None, "none", 0), ("é漢", "u", 5), ("Page ", "later", 7)], "key string, says string, place int")
    texts = [("Form", "f", True), ("Form: Demographics", "f", False), ("Page 12", "p", False), ("exactly", "e", True), ("exactly so", "x", False), ("", None, None), (None, None, None), ("nothing", None, None), ("é漢字", "u", False), ("é", None, None), ("Form", "f", True)]
    df = spark.createDataFrame([(n, t) for n, (t, _, _) in enumerate(texts)], "n int, text string").repartition(3)
    got = prefix.prefix_lookup(df, keys)
    assert [(r["says"], r["exact"]) for r in got.orderBy("n").collect()] == [(s, e) for _, s, e in texts]
    longest = prefix.prefix_lookup(df, keys.drop("place").filter("says <> 'later'"))
    assert [r["says"] for r in longest.orderBy("n").collect()][1:5] == ["fd", "p1", "e", "e"]
    assert prefix.prefix_lookup(df, keys.filter("false")).filter("says is not null").isEmpty() and prefix.prefix_lookup(df.filter("false"), keys).isEmpty()


def test_prefix_lookup_of_keys_of_many_lengths(spark):
    """Against a plain version, with keys and texts about each power of two; a text that begins as no key does is not held against each length."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("aé") for _ in range(n))
    keys = sorted({word(n) for n in [*range(1, 10), *range(15, 18), *range(31, 34), 64, 65, 100] for _ in range(4)})
    place = {k: rng.randrange(20) for k in keys}
    texts = [k[:n] + t for k in keys for n in (len(k) - 1, len(k)) for t in ("", "a", "b")] + ["b" * 200]
    df, told = spark.createDataFrame(list(enumerate(texts)), "n int, text string"), spark.createDataFrame(list(place.items()), "key string, place int")
    best = lambda t: t if t in place else min((k for k in keys if t.startswith(k)), key=lambda k: (place[k], k), default=None)
    out = prefix.prefix_lookup(df, told)
    assert [r["key"] for r in out.orderBy("n").collect()] == [best(t) for t in texts]
    few = prefix.prefix_lookup(spark.createDataFrame([(n, f"b{n}" * 99) for n in range(1000)], "n int, text string"), told)
    assert {r["key"] for r in few.collect()} == {None}
    assert 0 < generated(spark) <= 1000 * 7  # a row for each of 1, 2, 4 ... 64 letters, not for each of 18 lengths and more


def generated(spark):
    """Rows that the last action's explode() made."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    last = max((store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())))
    nodes, values = store.planGraph(last).allNodes(), store.executionMetrics(last)
    metrics = [n.metrics().apply(k) for n in map(nodes.apply, range(nodes.size())) if n.name() == "Generate" for k in range(n.metrics().size())]
    return sum(int(values.apply(m.accumulatorId()).replace(",", "")) for m in metrics if m.name() == "number of output rows" and values.contains(m.accumulatorId()))


def test_sheets_merge_and_no_decision_is_lost(spark):
    def cells(*rows):
        return spark.createDataFrame([(1, r, 1, t, s, w) for r, t, s, w in rows], "doc_id long, row_id string, slot int, shown string, review_status string, reviewed_by string")

    sent = cells(("same", "A", "proposed", ""), ("kept", "A", "proposed", ""), ("changed", "A", "proposed", ""), ("cleared", "A", "proposed", ""), ("gone", "A", "proposed", ""), ("quiet", "A", "proposed", ""))
    returned = cells(("same", "A", "proposed", ""), ("kept", "A", "accepted", "me"), ("changed", "B", "proposed", ""), ("gone", "A", "rejected", "me"), ("quiet", "A", "proposed", ""), ("typed", "T", "proposed", ""), ("cleared", " ", "proposed", ""))
    new = cells(("same", "N", "proposed", ""), ("kept", "N", "proposed", ""), ("changed", "B", "proposed", ""), ("cleared", "N", "proposed", ""), ("typed", "U", "proposed", ""), ("fresh", "F", "proposed", ""))
    got = {r["row_id"]: (r["shown"], r["review_status"], r["reviewed_by"], r["taken"], r["conflict"]) for r in review.merge(sent, returned, new).collect()}
    assert got == {
        "same": ("N", "proposed", "", "new", None), "kept": ("A", "accepted", "me", "returned", "accepted, proposed anew"), "changed": ("B", "proposed", "", "returned", None),
        "cleared": (None, "proposed", "", "returned", "cleared, proposed anew"), "gone": ("A", "rejected", "me", "returned", "rejected, no longer proposed"), "typed": ("T", "proposed", "", "returned", "written, proposed otherwise"), "fresh": ("F", "proposed", "", "new", None),
    }


def test_replies_of_any_length(spark):
    """A quoted cell of a million characters with line ends, delimiters and doubled quotes; a reply of 100,000 rows."""
    long = 'a "q", b;\n' * 100_000
    many = "row_id;variable\n" + "\n".join(f'r{n};"v;{n}"' for n in range(100_000))
    texts = spark.createDataFrame([(1, 'x\nrow_id,variable\nr1,"' + long.replace('"', '""') + '"\nr2,"b"\n\nend'), (2, many), (3, 'row_id,variable\nr1,"broken" cell\nr2,"open\nr3,x\n')], "doc_id long, text string")
    rows, errors = reply.parse(texts)
    got = rows.select("doc_id", "n", "row").collect()
    one = {r["row"]["row_id"]: r["row"]["variable"] for r in got if r["doc_id"] == 1}
    assert one == {"r1": long, "r2": "b"} and errors.isEmpty()
    two = {r["row"]["row_id"]: r["row"]["variable"] for r in got if r["doc_id"] == 2}
    assert len(two) == 100_000 and two["r99999"] == "v;99999"
    assert [(r["row"]["row_id"], r["row"]["variable"]) for r in sorted((r for r in got if r["doc_id"] == 3), key=lambda r: r["n"])] == [("r1", '"broken" cell'), ("r2", '"open'), ("r3", "x")]


def test_exchange_files_keep_groups_and_review(spark):
    fields = "doc_id string, annot_id string, page_index int, bbox struct<x0:double,y0:double,x1:double,y1:double>, shown string, kind string, color string, row_id string, slot int, group_id string, member_row_ids array<string>, domain string, variable string, confidence double, suggested boolean, review_status string, reviewed_by string, rationale string, source_model string"
    a = spark.createDataFrame([("a.pdf", "x1", 0, (1.0, 2.0, 3.0, 9.0), 'DM.SEX <"&', "variable", "#BFFFFF", "r1", 1, "g1", ["r1", "r2", "r3"], "DM", "SEX", 0.25, True, "accepted", "me", "why\nnot", "m"), ("a.pdf", "x2", 1, (1.0, 2.0, 3.0, 4.0), "n", "note", None, None, 2, None, [], None, None, None, False, "proposed", None, None, None)], fields)
    file = xfdf.texts(a)
    text = file.first()["xfdf"]
    assert 'title="m" subject="variable"' in text and "/Helv 7 Tf 0 0 0 rg" in text and "/Helv 7 Tf 0.48 0.48 0.48 rg" in text and 'member_row_ids="r1 r2 r3"' in text
    back = {r["annot_id"]: r for r in xfdf.annotations_of(xfdf.parse(file)).collect()}
    for r in a.collect():
        for c in a.columns:
            if c not in ("color", "rationale"):
                assert back[r["annot_id"]][c] == r[c], c
    assert back["x1"]["rationale"].split() == ["why", "not"]
    bad = spark.createDataFrame([("a", "<xfdf><freetext page='one' rect='1,2,3,4'/><freetext page='1' rect='1,2,3'/><square rect='1 2 3 4'/></xfdf>")], "doc_id string, xfdf string")
    assert [(r["page_index"], r["error"]) for r in xfdf.parse(bad).collect()] == [(None, "no page: one"), (1, "no rectangle of four numbers: 1,2,3"), (0, None)]


def test_files_under_their_names(spark, tmp_path):
    path = str(tmp_path / "out")
    files = spark.createDataFrame([("a/one.txt", "1"), ("b/two.txt", None), ("three.txt", "漢"), (None, "x")], "name string, content string").repartition(3)
    named.write_named(files, path)
    told = lambda: {os.path.relpath(os.path.join(d, n), path): open(os.path.join(d, n), encoding="utf-8").read() for d, _, names in os.walk(path) for n in names if not n.endswith(".crc")}
    assert told() == {"a/one.txt": "1", "b/two.txt": "", "three.txt": "漢", "_SUCCESS": ""}
    for wrong in (spark.createDataFrame([("four.txt", "4"), ("../out.txt", "5")], "name string, content string"), spark.createDataFrame([("six.txt", "1"), ("six.txt", "2")], "name string, content string"), files.withColumn("content", F.when(F.col("name") == "three.txt", F.raise_error(F.lit("no"))).otherwise("y"))):
        with pytest.raises(Exception, match="name|no"):
            named.write_named(wrong.repartition(2), path)
        assert set(told()) == {"a/one.txt", "b/two.txt", "three.txt", "_SUCCESS"} and not (tmp_path / "out.txt").exists()
    named.write_named(files.filter("name = 'three.txt'"), path, overwrite=True)
    assert told() == {"three.txt": "漢", "_SUCCESS": ""}
    batches = spark.createDataFrame([("f.pdf", "b1.txt", "b1.csv", "do", "row_id")], "doc_id string, instructions string, sheet string, instructions_text string, sheet_text string")
    tables.write_batches(batches, str(tmp_path / "batches"))
    assert sorted(os.listdir(tmp_path / "batches" / "f.pdf")) == ["b1.csv", "b1.txt"]


def test_votes_go_on_after_a_stop(spark, tmp_path):
    """Three batches, a stop, a file that repeats rows and a new one: as the whole at each time."""
    m = spark.range(300).select(F.lit("variable").alias("kind"), F.concat(F.lit("V"), F.col("id") % 7).alias("variable"), F.concat(F.lit("D"), F.floor(F.col("id") / 40) % 3).alias("domain"), F.lit(None).cast("string").alias("domain_inference_source"), F.col("id").alias("ord"))
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def add(*parts):
        for lo, hi in parts:
            m.filter(F.col("ord").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(folder)
        votes.keep_votes(votes.watch(spark, folder, m.schema, 1), out, state, ["ord"]).awaitTermination()
        return sorted(map(tuple, votes.votes_now(spark, out).collect()))

    whole = lambda n: sorted(map(tuple, precedent.domain_votes(m.filter(F.col("ord") < n)).collect()))
    assert add((100, 200), (0, 60), (60, 100)) == whole(200)
    assert sum(d.startswith("batch=") for d in os.listdir(out)) >= 3
    assert add((0, 60), (200, 300)) == whole(300) == add()


def test_functions_of_the_session_say_what_the_columns_say(spark):
    session.register_functions(spark)
    texts = ["DM.SEX", ' SUPPDM.QVAL when QNAM = "RACE1"', 'dm.x = "A b"', "[Not Submitted]", "", None, "DM = Demographics", "ds (Disposition) ", "  Year of  Birth :: ", "3, 4 1,2", "1,2,x,4", "RFICDTC", "AETERM", "AE", "it's \\ odd", 'x = "'] + ["VSTEST = a\nb"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for name, column in (("normalize_key", T.normalize_key), ("parse_mapping", T.parse_mapping), ("parse_legend", T.legend), ("builtin_domain", T.builtin_domain), ("parse_rect", G.parse_rect)):
        got = df.select(F.expr(f"{name}(t)").alias("a"), column(F.col("t")).alias("b")).collect()
        assert [r["a"] for r in got] == [r["b"] for r in got], name
    pairs = df.crossJoin(df.withColumnRenamed("t", "u")).limit(100)
    got = pairs.select(F.expr("is_not_submitted(t, u, 'XY')").alias("a"), T.is_not_submitted(F.col("t"), F.col("u"), F.lit("XY")).alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]
    box = F.expr("named_struct('x0', t * 1.0D, 'y0', t * 2.0D, 'x1', t + 9.0D, 'y1', t * 2 + 11.0D)")
    boxes = spark.range(8).withColumnRenamed("id", "t").select(box.alias("a"), G.box(F.lit(3), F.lit(4), F.lit(5), F.lit(20)).alias("b"))
    got = boxes.select(F.expr("rect_distance(a, b)").alias("a"), G.distance(F.col("a"), F.col("b")).alias("b"), F.expr("in_band(a, b)").alias("c"), G.in_band(F.col("a"), F.col("b")).alias("d")).collect()
    assert [(r["a"], r["c"]) for r in got] == [(r["b"], r["d"]) for r in got]
    kinds = spark.sql("SELECT d, f, m, b FROM VALUES (true), (false) AS x(d), VALUES (true), (false) AS y(f), VALUES (true), (false) AS z(m), VALUES (true), (false) AS w(b)")
    got = kinds.select(F.expr("mark_kind(d, f, m, b)").alias("a"), recover.classify(F.col("d"), F.when(F.col("f"), 1), F.col("m"), F.col("b")).alias("b")).collect()
    assert len(got) == 16 and [r["a"] for r in got] == [r["b"] for r in got]


def test_views_are_the_relations(spark):
    sf = "/root/testdata/sf0.001"
    words = testbed.words(spark, sf).filter("doc_id < 6")
    rows = extract.rows(words, header=testbed.HEADER)
    marks = testbed.marks(rows)
    look = spark.createDataFrame([("a", "", "DM", "XXTERM", "", "", "3", "f")], ", ".join(f"{c} string" for c in tables.LOOKUP))
    views = session.Relations(spark, words, marks, testbed.annotations(rows), look, header=testbed.HEADER)
    names = views.register("t_")
    assert {"t_rows", "t_mappings", "t_lookup", "t_matched", "t_mined", "t_repeats", "t_uncovered", "t_proposals"} <= set(names)
    assert sorted(map(str, spark.sql("SELECT * FROM t_rows").collect())) == sorted(map(str, rows.collect()))
    assert spark.sql("SELECT domain FROM t_mappings WHERE variable = 'XXTERM' AND domain_inference_source = 'precedent' LIMIT 1").first()[0] == "DM"
    assert Counter(r[0] for r in spark.sql("SELECT kind FROM t_matched").collect()) == Counter(r["kind"] for r in recover.match_rows(views.of("mappings"), rows).collect())
    assert all(spark.table(n) is not None for n in names)


def test_numbers_round_as_they_lie(spark):
    rng = random.Random(9)
    values = [2.675, 0.35, 0.25, 0.75, -0.25, -0.35, 1.005, 0.05, 1e9 + 0.25, 0.0, -2.5, 1e13 + 0.5, 612.0] + [round(rng.uniform(-700, 700), rng.randint(1, 4)) for _ in range(3000)] + [rng.uniform(-1e6, 1e6) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for places in (1, 2):
        got = [r[0] for r in df.select(G.rounded(F.col("v"), places)).collect()]
        assert got == [v if abs(v) >= 2.0**40 else round(v, places) for v in values] + [None]


def test_coordinates_of_the_sheet(spark):
    rows = spark.createDataFrame([(1, 1, "r1", 0, "f", "q", "", (1.0, 2.0, 3.456, 4.0), None)], "doc_id long, row_ord int, row_id string, page_index int, form string, text_1 string, text_2 string, bbox_1 struct<x0:double,y0:double,x1:double,y1:double>, bbox_2 struct<x0:double,y0:double,x1:double,y1:double>")
    none = spark.createDataFrame([], "doc_id long, row_id string, member_row_ids array<string>, slot int, shown string, domain string, origin string, group_id string, source_model string, review_status string, reviewed_by string, ord int")
    sheet = review.sheet(rows, none)
    assert tuple(sheet.select("coord1", "coord2").first()) == ("1.00, 2.00, 3.46, 4.00", "")
    lines = review.read_lines(sheet.withColumns({"excel_row": F.lit(2), "note": F.lit("")}))
    assert review.errors(lines, rows).isEmpty()
    assert [r["error"] for r in review.errors(lines.withColumn("coord2", F.lit("1, 2, 3, x")), rows).collect()] == ["no rectangle in coord2"]
