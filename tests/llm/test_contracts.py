"""Each registered query of the training-text operators over the smallest tables: its columns, types and rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from formloom.llm import bpe, common, queries

from .test_llm import base_pii, base_secrets, item_words, plain_groups

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def table(spark):
    return {r["doc_id"]: r["text"] for r in common.read(spark, SF, "documents").collect()}


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def told(spark, name, types):
    df = queries.QUERIES[name](spark, SF)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields][: len(types)] == types
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_op1(spark, table, tok):
    got, start, want = told(spark, "op1_token_file", [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]), 0, {}
    for i in sorted(table):
        ids = np.array([*tok.encode(table[i] or "", add_special_tokens=False).ids, 1], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want


def test_words_are_forgotten_without_a_trace(monkeypatch, table):
    """What an encoder remembers is bounded, and ids do not depend on the bound."""
    texts, path = [(t or "").encode() for t in table.values()], public_tokenizers.path("word_bpe_49k.json")
    whole = bpe.Encoder(path).texts(texts)
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 20_000)
    small, out, most = bpe.Encoder(path), [], 0
    for k in range(0, len(texts), 5):
        out += small.texts(texts[k : k + 5])
        most = max(most, len(small.known))
    assert out == whole and most < len({w for t in texts for w in bpe.Encoder(path).words(t)})


def test_op2(spark):
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    columns = [("doc_id", "bigint"), ("n_words", "bigint"), ("n_hit", "bigint"), ("n_items", "bigint"), ("items_sha256", "string"), ("contaminated", "boolean")]
    want = duck.execute(queries.SQL["op2_decontaminate"]).fetchall()
    assert told(spark, "op2_decontaminate", columns) == {r[0]: tuple(r[1:]) for r in want} and any(r[5] for r in want)


def test_op3(spark, table):
    columns = [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double")]
    got = told(spark, "op3_lm_score", columns)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in table}
    words = {i: (t or "").encode().lower().split() for i, t in table.items()}
    count = Counter(w for i, ws in words.items() if not held[i] for w in [*ws, None])
    n, v = sum(count.values()), len(count)
    for i, ws in words.items():
        seen = [count[w] for w in [*ws, None]]
        assert got[i][:4] == (held[i], len(seen), sum(c > 0 for c in seen), n) and got[i][5] < 0
        assert got[i][4] == pytest.approx(sum(math.log10((c + 1) / (n + v + 1)) for c in seen))


def test_op4(spark, table):
    label, sets = plain_groups(table)
    got = told(spark, "op4_near_duplicates", [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")])
    assert got == {i: (len(sets[i]), label[i], label[i] == i) for i in table}


def spans_hold(base, spans):
    """Every base span is among all spans, in order."""
    return set(filter(None, base.split(","))) <= set(filter(None, spans.split(","))) and [int(s.split(":")[1]) for s in filter(None, spans.split(","))] == sorted(int(s.split(":")[1]) for s in filter(None, spans.split(",")))


def test_op5(spark, table):
    columns = [("doc_id", "bigint"), *[(f"n_{k}", "bigint") for k in ("email", "ip", "card", "phone")], ("base_sha256", "string"), ("spans", "string")]
    for i, r in told(spark, "op5_personal_data", columns).items():
        base = base_pii(table[i] or "")
        assert r[:5] == (*[sum(s.startswith(k + ":") for s in base) for k in ("email", "ip", "card", "phone")], sha(",".join(base))) and spans_hold(",".join(base), r[5])


def test_op6(spark, table):
    columns = [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    got, at = told(spark, "op6_shuffle_shards", columns), {}
    assert set(got) == set(table)
    for i, (size, crc, law, shard, slot, grown) in got.items():
        data = (table[i] or "").encode()
        assert (size, crc, law, grown) == (len(data) + 8, zlib.crc32(data), "rows", None)
        at.setdefault(shard, []).append(slot)
    assert set(at) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in at.values()) and max(map(len, at.values())) - min(map(len, at.values())) <= 1


def test_op7(spark, table):
    columns = [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], ("base_failed", "boolean"), ("kept", "boolean")]
    for i, r in told(spark, "op7_quality", columns).items():
        t = table[i] or ""
        w = WORD.findall(t)
        g = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        repeat = len({j for k in range(len(w) - 7) if g[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)})
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 20 or 100 * repeat > 30 * len(w)
        assert r[:6] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeat, failed) and not (failed and r[6])


def test_op8(spark, table):
    columns = [("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"), ("spans", "string")]
    for i, r in told(spark, "op8_secrets", columns).items():
        base = base_secrets(table[i] or "")
        kinds = Counter(s.split(":")[0] for s in base.split(",") if s)
        assert r[:4] == (kinds["assign"], kinds["access"], kinds["hex"], sha(base)) and spans_hold(base, r[4])


def test_op9(spark, table, tok):
    got = told(spark, "op9_bpe", [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")])
    for i, t in table.items():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tok.decode(ids, skip_special_tokens=False)))


def test_op10(spark, table):
    got = told(spark, "op10_toxicity", [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")])
    assert set(got) == set(table)
    for i, (held, score, predicted, passages) in got.items():
        assert held == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= score <= 1 and predicted == int(score >= 0.5)
        assert all(0 <= int(a) < int(b) <= len(table[i]) for a, b in (p.split(":") for p in passages.split(",") if p))


def test_item_words_are_words_of_the_contract():
    assert item_words("Abc-9 É x_y") == ["abc", "9", "É", "x", "y"]
