"""Whitening, fill-in-the-middle and merge-type pieces against plain versions, with nulls, empty texts, ties and clashing columns."""

import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from formloom.llm import common, infill, pieces, queries, whitening

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def table(spark):
    return {r["doc_id"]: r["text"] or "" for r in common.read(spark, SF, "documents").collect()}


# ---------------------------------------------------------------- whitening


def exact(rows):
    """n, sums, deviations and the covariance times n squared, in whole numbers of any size."""
    n, d = len(rows), len(rows[0])
    sums = [sum(r[j] for r in rows) for j in range(d)]
    y = [[n * v - s for v, s in zip(r, sums, strict=True)] for r in rows]
    cov = [[sum(r[i] * r[j] for r in y) for j in range(d)] for i in range(d)]
    return n, sums, [sum(v * v for v in r) for r in y], cov


def steps_of(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def test_pairs_hold_what_doubles_lose():
    rng = np.random.default_rng(5)
    high = rng.normal(size=(3, 1001)) * 10.0 ** rng.integers(-20, 20, (3, 1001))
    h, low = whitening.total(high, np.zeros_like(high))
    assert [float(a) + float(b) for a, b in zip(h, low, strict=True)] == pytest.approx([math.fsum(r) for r in high], rel=1e-15)
    x = rng.integers(-(2**40), 2**40, (4, 33)).astype(float)
    for i, (h, low) in enumerate(whitening.outer_sums(x, np.zeros_like(x))):
        want = [sum(int(a) * int(b) for a, b in zip(x[i], x[j], strict=True)) for j in range(i, 4)]
        assert [int(a) + int(b) for a, b in zip(h, low, strict=True)] == want


def test_op11(spark):
    rows = {r["vec_id"]: steps_of(r["embedding"]) for r in common.read(spark, SF, "embeddings").collect() if r["embedding"] and all(c is not None and math.isfinite(c) for c in r["embedding"])}
    n, sums, deviation, cov = exact(list(rows.values()))
    df = queries.QUERIES["op11_whitening"](spark, SF)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    got = df.collect()
    told = min(32, len(sums))
    assert len(got) == n * told and {r["component"] for r in got} == set(range(1, told + 1))
    assert {r["n"] for r in got} == {n} and {r["vec_id"]: r["deviation"] for r in got} == dict(zip(rows, deviation, strict=True))
    exact_cov = np.array([[c / n**3 for c in r] for r in cov])
    values, vectors = np.linalg.eigh(exact_cov)
    own = {}
    for r in got:
        own.setdefault(r["component"], {})[r["vec_id"]] = r["whitened"]
        assert r["explained"] == pytest.approx(values[-r["component"]] / np.trace(exact_cov), rel=1e-4) and r["identity_error"] < 1e-8
    x = np.array([[v - s / n for v, s in zip(r, sums, strict=True)] for r in rows.values()])
    for c, w in own.items():
        want, w = x @ vectors[:, -c] / math.sqrt(values[-c]), np.array([w[i] for i in rows])
        assert np.allclose(w, want, atol=1e-6) or np.allclose(w, -want, atol=1e-6)


def test_whitening_of_odd_vectors(spark):
    rng = random.Random(2)
    good = [[rng.gauss(0, 1) * 3**k for k in range(3)] for _ in range(60)]
    rows = [(i, v, "x") for i, v in enumerate(good)] + [(100, None, "x"), (101, [1.0, None, 2.0], None), (102, [float("nan"), 1.0, 1.0], "x"), (103, [float("inf"), 1.0, 1.0], "x"), (104, [], "x"), (105, [1.0], "x"), (106, [1e30, 0.0, 0.0], "x"), (None, good[0], "x"), (0, good[0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string").repartition(5)
    got = whitening.components(df).collect()
    assert len(got) == 62 * 3 and {r["n"] for r in got} == {62}
    want = exact([steps_of(v) for v in [*good, good[0], good[0]]])[2]
    assert sorted(r["deviation"] for r in got) == sorted(want * 3)
    assert len({(r["component"], r["whitened"]) for r in got if r["vec_id"] in (0, None)}) == 3
    assert {r["identity_error"] < 1e-9 for r in got} == {True}
    model = whitening.fit(df)
    cov = exact([steps_of(v) for v in [*good, good[0], good[0]]])[3]
    told = model.covariance
    assert all(abs((float(told[0][i, j]) + float(told[1][i, j])) - cov[i][j] / 62**3) <= 1e-15 * abs(cov[i][j] / 62**3) + 1e-18 for i in range(3) for j in range(3))
    assert whitening.components(df.filter("false")).columns == whitening.components(df).columns and whitening.components(df.filter("vec_id = 100")).count() == 0
    alone = whitening.components(df.filter("vec_id = 5")).collect()
    assert len(alone) == 3 and all(r["whitened"] is None and r["deviation"] == 0 and r["identity_error"] is None for r in alone)


def test_deviation_beyond_a_long_is_null():
    model = whitening.Whitening(1 << 32, [0], (np.zeros(1), np.zeros(1)), (np.eye(1), np.zeros((1, 1))), np.ones(1), np.eye(1), 1)
    assert model.deviation(np.array([[1], [1 << 20]])) == [None, None]
    model.n = 1 << 30
    assert model.deviation(np.array([[1], [2], [1 << 20]])) == [1 << 60, 1 << 62, None]


# ---------------------------------------------------------------- fill in the middle


def plain_infill(doc_id, text):
    h = [int(sha(f"1:{doc_id}")[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_op12(spark, table):
    df = queries.QUERIES["op12_fill_in_middle"](spark, SF)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"), ("output_sha256", "string"), ("restored_sha256", "string")]
    got = {r["doc_id"]: tuple(r)[1:] for r in df.collect()}
    assert got == {i: (*(w := plain_infill(i, t))[:4], sha(w[4]), sha(t)) for i, t in table.items()}
    assert {r[1] for r in got.values()} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("chunk", [1 << 20, 700, 5])
def test_fill_in_middle(spark, chunk):
    """Of texts of one chunk and of many, whose borders stand within code points and marks."""
    rng = random.Random(chunk)
    words = ["ab", "é", "漢字", "🙂", "<", "P", ">", "S>", "<M", "\n", "\x00", " "]
    texts = ["".join(rng.choice(words) for _ in range(rng.choice([1, 3, 400]))) for _ in range(40)] + ["", None, "<P>", "<<S>", "a<P", "M>b", "x" * 3000 + "<M>", "🙂" * 2000]
    rows = [(i, t, "f", 3) for i, t in enumerate(texts)] + [(3, texts[3], "f", 3), (3, "another", "f", 3), (None, "no id: 漢字 and so on", "f", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, n long").repartition(3)
    out = infill.fill_in_middle(df, chunk=chunk)
    got = out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", infill.restore(F.col("output"), F.col("form")).alias("restored")).collect()
    want = [(i, *plain_infill("" if i is None else i, t or ""), t or "") for i, t, *_ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert infill.fill_in_middle(df.filter("false"), chunk=chunk).count() == 0


def test_chunks_compose_in_any_grouping():
    rng = random.Random(7)
    for _ in range(60):
        text = "".join(rng.choice("ab<>PSM漢🙂é") for _ in range(rng.randint(0, 900)))
        data = text.encode()
        at = sorted(rng.randint(0, len(data)) for _ in range(4))
        scan = infill.Scan([data[a:b] for a, b in zip([0, *at], [*at, len(data)], strict=True)])
        units, marks, counts = scan.units.tolist(), scan.marks.tolist(), scan.counts.tolist()
        while len(units) > 1:  # any neighbours first
            k = rng.randrange(len(units) - 1)
            counts[k : k + 2] = [[counts[k][s] + counts[k + 1][units[k] >> 2 * s & 3] for s in range(4)]]
            units[k : k + 2], marks[k : k + 2] = [int(infill.THEN[units[k], units[k + 1]])], [int(infill.THEN[marks[k], marks[k + 1]])]
        assert counts[0][0] == len(text) and (marks[0] & 3 == 3) == any(m in text for m in ("<P>", "<S>", "<M>"))


# ---------------------------------------------------------------- pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_op13(spark, table, library):
    df = queries.QUERIES["op13_sentencepiece"](spark, SF)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string"), ("agrees", "boolean")]
    got = {r["doc_id"]: tuple(r)[1:] for r in df.collect()}
    ids = {i: library.encode(t, add_bos=True, add_eos=True) for i, t in table.items()}
    assert got == {i: (len(x), sha(np.array(x, "<u4").tobytes()), sha(library.decode(x)), True) for i, x in ids.items()}


def test_pieces(spark, library, monkeypatch):
    """The agenda alone gives the library's ids, with and without room to remember stretches, and for stretches of any length."""
    rng = random.Random(11)
    marks = " ▁\n\tab.<s>/0x41é́漢字🙂\x00​\"'  eeestth--====ﬁ﻿"
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + ["=" * 5000 + "ab" * 3000, " " * 333, "a" + " " * 40 + "b ", "<s></s><unk><0x41>", "lorem ipsum  dolor " * 9000]
    own = pieces.Pieces(MODEL)
    monkeypatch.setattr(pieces, "CUT_AT_ONCE", 37)
    monkeypatch.setattr(pieces, "CHECK_AT_ONCE", 50)
    monkeypatch.setattr(pieces, "KNOWN_BYTES", 5000)
    for t in texts:
        ids = library.encode(t, add_bos=True, add_eos=True)
        want = np.array(ids, "<u4").tobytes(), library.decode(ids).encode()
        assert (x := own.encode(t), own.decode(x)) == want == own.by_library(t), t[:60]


def test_pieces_of_odd_rows(spark, library):
    rows = [(1, "Hello  world", 1), (1, "Hello  world", 1), (2, None, 1), (3, "", 1), (None, "x", 1), (4, "long " * 300_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    for check in (True, False):
        got = pieces.encode_decode(df, MODEL, check=check).collect()
        want = [(i, np.array(x := library.encode(t or "", add_bos=True, add_eos=True), "<u4").tobytes(), library.decode(x).encode(), check or None) for i, t, _ in rows]
        assert sorted([(r["doc_id"], bytes(r["ids"]), bytes(r["decoded"]), r["agrees"]) for r in got], key=str) == sorted(want, key=str)
    assert pieces.encode_decode(df.filter("false"), MODEL).count() == 0


def test_a_row_that_the_library_encodes_otherwise_says_so(monkeypatch):
    import pyarrow as pa

    own = pieces.Pieces(MODEL)
    monkeypatch.setattr(pieces, "pieces", lambda path: own)
    monkeypatch.setattr(own, "merged", lambda text: [own.byte[b] for b in text.encode()])
    out = next(pieces.encode_batches(MODEL, True)(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["hello"])], names=["doc_id", "text"])])))
    assert out.column(3).to_pylist() == [False] and out.column(1)[0].as_py() == own.by_library("hello")[0]
