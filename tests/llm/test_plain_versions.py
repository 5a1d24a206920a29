"""What no contract fixes, against plain versions: the verdict of the line rules, and the scored graph of patterns and instances."""

import random
import re
from collections import Counter

import pytest

from formloom.llm import pii, quality

MARKS = ["|", "»", "›", ">", ":", "·", "•", "/", "::", "->", "→"]


def plain_fails(line, seen):
    words = re.findall(r"[^\x20\x09-\x0D]+", line)
    n, letters = len(words), [c for c in line if c.isalpha()]
    loud = sum(c.isupper() for c in line)
    rules = [
        seen and n >= 3,
        5 * sum(c in "#*$%&|<>" for c in line) > n,
        4 * sum(w in MARKS and w != ":" for w in re.split(r"\s+", line)) >= n and any(w in MARKS and w != ":" for w in re.split(r"\s+", line)),
        n >= 5 and loud and 5 * loud >= 4 * len(letters),
        n >= 6 and 2 * sum(a == b for a, b in zip(words, words[1:], strict=False)) > n,
        n <= 12 and quality.BOILERPLATE.search(line),
    ]
    return any(rules), n <= 4 and not line.rstrip().endswith(quality.ENDS)


def plain_verdict(text):
    """(kept, words of the lines that stay, those lines)."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, stays, out = text.split("\n"), set(), 0, []
    for line in lines:
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        if own:
            wrong, short = plain_fails(line, line in seen)
            seen.add(line)
            if wrong or (short and len(lines) > 1):
                continue
            stays += len(own)
        out.append(line)
    grams = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    repeat = {j for k in range(len(words) - 7) if grams[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    return not (len(words) < 20 or 100 * len(repeat) > 30 * len(words)) and 2 * stays >= len(words), stays, "\n".join(out)


def test_verdict_of_the_line_rules(spark):
    rng = random.Random(5)
    words = ["the", "Tree", "grows", "é", "LOUD", "no", "no", "7", "end.", "Why?", "#", "*", "a|b", ">", "»", "·", "::", "/", "Ärger", "漢字。", "ÉTÉ"]
    lines = [lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 14))), lambda: "A plain line of common words that ends as it should.", lambda: " ".join(f"w{rng.randint(0, 400)}" for _ in range(12)) + ".", lambda: "READ MORE ABOUT THIS NOW", lambda: "Home » News » Sport", lambda: "click here", lambda: " ", lambda: "no no no no no no no", lambda: "Title"]
    texts = ["\n".join(rng.choice(lines)() for _ in range(rng.randint(1, 14))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["kept"], r["kept_words"], r["cleaned"]) for r in quality.clean_lines(df).collect()}
    assert got == {n: plain_verdict(t) for n, t in enumerate(texts)}
    assert 50 < sum(k for k, _, _ in got.values()) < 550


def plain_confident(edges, turns=pii.TURNS):
    score = {(p, v): float(known) for p, v, known in edges}
    for turn in range(turns):
        believed = {}
        for pattern in {p for p, _, _ in edges}:
            own = [score[p, v] for p, v, _ in edges if p == pattern]
            mass, n = sum(own), sum(s + pii.UNLABELLED * (1 - s) for s in own)
            if mass >= pii.LEAST_KNOWN and mass / (n + 1) >= pii.CONFIDENT:
                believed[pattern] = mass / (n + 1)
        if turn == turns - 1 or not believed:
            return believed
        for p, v, known in edges:
            if not known:
                left = 1.0
                for q, w, k in edges:
                    if w == v and not k and q in believed:
                        left *= 1 - believed[q]
                score[p, v] = 1 - left


@pytest.mark.parametrize("seed", range(3))
def test_scored_graph(spark, seed):
    """Patterns that later turns believe through values that earlier ones have scored are among them."""
    rng = random.Random(seed)
    share = {f"p{k}": rng.choice([0.0, 0.3, 0.8, 0.95, 1.0]) for k in range(25)}
    edges = {}
    for p, s in share.items():
        for _ in range(rng.randint(1, 25)):
            v = rng.randint(0, 120)
            edges[p, f"v{v}"] = rng.random() < s and v % 3 > 0
    rows = [(p, v, k) for (p, v), k in edges.items()]
    df = spark.createDataFrame(rows, "pattern string, value string, known boolean").repartition(3)
    want, once = plain_confident(rows), plain_confident(rows, 1)
    got = {r["pattern"]: r["confidence"] for r in pii.confident_patterns(df).collect()}
    assert set(got) == set(want) and got == pytest.approx(want)
    assert want and want != once
