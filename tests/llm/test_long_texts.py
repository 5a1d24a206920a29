"""Secrets and personal data: links against a plain version, and texts whose matches or digits are many."""

import random
import re
import time

import pytest
import regex
from pyspark.sql import functions as F

from formloom.llm import decontaminate, pii, secrets

from .test_llm import base_pii, base_secrets, item_words


def plain_links(text):
    """Linked keys and identifiers by every pair, as find_secrets() says."""
    of = {k: [(m.start(1), m.end(1), m[1]) for m in regex.finditer(p, text)] for k, p in secrets.PARTS.items()}
    base = [(int(a), int(b), k) for k, a, b in (s.split(":") for s in base_secrets(text).split(",") if s)]
    access = [(a, b, text[a:b]) for a, b, k in base if k == "access"]
    breaks = [m.start() for m in re.finditer(secrets.SCOPE, text)]
    scope = lambda a: sum(b < a for b in breaks)
    meets = lambda x, others: any(o[0] < x[1] and x[0] < o[1] for o in others)
    keys = [x for x in of["named"] if not meets(x, base + of["endpoint"])] + [x for x in of["key"] if not meets(x, base + of["endpoint"] + of["id"] + of["named"])]
    out = set()
    for a, b, v in keys:
        for kind, others in (("identifier", of["id"]), ("access", access), ("endpoint", of["endpoint"])):
            for c, d, w in others:
                if scope(a) == scope(c) and abs(a - c) <= secrets.REACH and v != w:
                    out.add((a, 3, "linked", b))
                    if kind == "identifier" and c not in {x[0] for x in access}:
                        out.add((c, 4, "identifier", d))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_links_are_those_of_every_pair(spark, seed):
    rng = random.Random(seed)
    key = lambda n: "".join(rng.choice("aB3cD9/+x") for _ in range(n)) + "aB3"
    pieces = [lambda: "client_id: abcd" + str(rng.randint(0, 9)), lambda: "AKIA" + "".join(rng.choice("ABC123") for _ in range(18)), lambda: key(22), lambda: "secret_key = '" + key(18) + "'", lambda: "password=" + key(7), lambda: "https://h.example.org/" + key(4),
              lambda: "my.bucket.amazonaws.com", lambda: "x.." + "a.amazonaws.com", lambda: "access_key_id = AKIA" + "A" * 16, lambda: "é word " * rng.randint(1, 40), lambda: "\n \n", lambda: "deadbeef" * 4, lambda: "access_key = " + key(30)]
    texts = [rng.choice([" ", "\n", "; "]).join(rng.choice(pieces)() for _ in range(rng.randint(1, 40))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    linked = 0
    for r in secrets.find_secrets(df).select("doc_id", "spans", secrets.redact(F.col("text"), F.col("spans")).alias("clean")).collect():
        text = texts[r["doc_id"]]
        spans = [(s["start"], s["rank"], s["kind"], s["end"]) for s in r["spans"]]
        assert spans == sorted(spans) and all((text[: s["start"]].encode(), text[: s["end"]].encode()) == (text.encode()[: s["at"]], text.encode()[: s["to"]]) for s in r["spans"])
        assert {s for s in spans if s[1] > 2} == plain_links(text)
        linked += any(s[1] > 2 for s in spans)
        want, at = "", 0
        for a, _, _, b in spans:
            if a >= at:
                want += text[at:a] + "[secret]"
            at = max(at, b)
        assert r["clean"] == want + text[at:]
    assert linked > 20


def test_hosts_of_any_length(spark):
    hosts = {"a." * n + "amazonaws.com": True for n in (1, 11, 150)} | {"w" * 90 + ".azure.com": True, "a..b.amazonaws.com": False, "amazonaws.com": False, "x.amazonaws.com.evil": False}
    key = "wJalrXUtnFEMI9K7MDENGsbPxRfiCY"
    df = spark.createDataFrame([(n, f"{h} {key}") for n, h in enumerate(hosts)] + [(99, f"{'a.' * 5000}amazonaws.com {key}")], "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in secrets.find_secrets(df).select("doc_id", F.size("spans").alias("n")).collect()}
    assert [got[n] for n in range(len(hosts))] == [int(v) for v in hosts.values()] and got[99] == 0


def test_a_text_of_many_secrets(spark):
    """Ten times the matches take about ten times as long: 4 MB with 200,000 matches, found and taken out."""
    took = {}
    for n in (20_000, 200_000):
        df = spark.createDataFrame([(1, "token=abcdef12 é\n" * n)], "doc_id long, text string")
        began = time.time()
        r = secrets.find_secrets(df).select("n_assign", F.sha2(secrets.redact(F.col("text"), F.col("spans")), 256).alias("clean"), F.element_at("spans", -1).alias("last")).first()
        took[n] = time.time() - began
        assert (r["n_assign"], r["last"]["start"], r["last"]["to"]) == (n, 17 * (n - 1), 18 * (n - 1) + 14)
        assert r["clean"] == spark.range(1).select(F.sha2(F.lit("[secret] é\n" * n), 256).alias("x")).first()["x"]
    assert took[200_000] < 90


def test_texts_of_digits():
    """A million digits, with and without points between: each digit is read a few times."""
    for text in ("7" * 1_000_000, "1." * 500_000, "12.3 " * 200_000, "9" * 300_000 + ".1.2.3 " + "9" * 300_000, "1.2.3.4." * 100_000):
        began = time.time()
        pii.base_spans(text)
        assert time.time() - began < 10, text[:20]
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("0123456789012....  -+x") for _ in range(rng.randint(0, 60)))
        assert [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in pii.base_spans(text)] == base_pii(text)


def test_spans_are_removed(spark):
    """The words of windows go, with what stands before each; all else stays as it is."""
    rng = random.Random(8)
    vocabulary = ["ab", "Cd", "é", "İx", "7", "zz"]
    items = [(n, " ".join(rng.choice(vocabulary) for _ in range(k))) for n, k in enumerate((1, 2, 3, 13, 20))] + [(9, None)]
    items[0] = (0, "only")
    made = lambda n: "".join(rng.choice(vocabulary + ["only", "Other"]) + rng.choice([" ", ", ", "\n", " -- "]) for _ in range(n))
    rows = [(n, made(rng.randint(0, 60)) + (items[rng.randint(1, 4)][1] if n % 3 else ""), "x") for n in range(60)] + [(70, None, "x"), (71, "", "x"), (72, "Other, other!", "x"), (5, "only this, ONLY", "x"), (5, "only this, ONLY", "x"), (None, "(only)", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, cleaned string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.remove_spans(df, bench).collect()
    assert len(got) == len(rows)
    some = 0
    for r in got:
        w, hit = item_words(r["text"]), set()
        for _, t in items:
            b = item_words(t)
            n = min(13, len(b))
            for win in {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if n else ():
                hit |= {j for k in range(len(w) - n + 1) if tuple(w[k : k + n]) == win for j in range(k, k + n)}
        tokens = re.findall(decontaminate.WORD_WITH_LEAD, r["text"] or "")
        assert len(tokens) == len(w)
        want = None if r["text"] is None else "".join(t for k, t in enumerate(tokens) if k not in hit) + r["text"][len("".join(tokens)) :]
        assert r["cleaned"] == want and {k for s in r["removed"] for k in range(s["start"] - 1, s["end"] - 1)} == hit
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:], strict=False))
        some += 0 < len(hit) < len(w)
    assert some > 10
    began = time.time()
    long = spark.createDataFrame([(1, "only other " * 100_000)], "doc_id long, text string")
    assert decontaminate.remove_spans(long, bench).select(F.length("cleaned"), F.size("removed")).first()[:] == (6 * 100_000 + 1, 100_000) and time.time() - began < 90
    assert decontaminate.remove_spans(df.filter("false"), bench).count() == 0 and decontaminate.remove_spans(df, bench.filter("false")).filter("cleaned <> text").isEmpty()
