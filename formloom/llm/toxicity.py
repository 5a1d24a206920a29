"""Toxicity: maximum-scoring segments of token log-odds, judged by the law of extreme values.

Log-odds between toxic and other labelled texts, of tokens and of how they begin (for languages that inflect), have an
informative Dirichlet prior. A token scores by the strongest of its features; all others cost what their lack
in toxic texts says. All maximal segments of a text are found in one pass, as the stack algorithm for all maximal
scoring subsequences does. How unlikely a segment's score is in a text of that length follows from the scores' own
distribution over other texts; the strongest evidence, calibrated on labelled texts that the log-odds have not seen,
gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import trim
from .common import held_out, read, written

#: Labelled rows to learn from, about; above, a hash of doc_id draws them.
LEARN_ROWS = 30_000
#: Of 3 parts, those that the log-odds are counted in; the rest calibrates.
LEXICON_PARTS = 2
#: Prior counts of a feature: HALF, and its share of PRIOR by its frequency in all texts.
HALF, PRIOR, LEAST_Z, LEAST_TEXTS = 0.5, 50.0, 3.5, 3
#: Standard errors below the log-odds that a feature scores.
BOUND = 1.64
#: A token's features: its first characters, so many, and all of it with a mark that no token has.
BEGINS, WHOLE, ALL = range(3, 9), "$", ""
#: Features that a task sums before it tells them, and tokens whose scores it remembers.
MOST_COUNTED, REMEMBERED = 200_000, 300_000
FOLDS, HELD_FOLD = 5, 0
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
EVIDENCE = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("evidence", pa.float64()), ("segments", pa.list_(pa.list_(pa.int32())))])


def small(text: str) -> str:
    """In small letters, of the same length: some letters have a small form of two characters and stay."""
    own = text.lower()
    return own if len(own) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def tokens(text: str) -> list[str]:
    return WORD.findall(small(text))


def features(token: str) -> list[str]:
    return [token[:k] for k in BEGINS if k <= len(token)] + [token + WHOLE]


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) to (feature, toxic, n, texts): occurrences, and the texts that hold it. All tokens count as ALL."""
    from collections import Counter

    trim()
    n: Counter = Counter()
    texts: Counter = Counter()

    def told() -> pa.RecordBatch:
        keys = list(n)
        out = pa.RecordBatch.from_arrays([pa.array([f for f, _ in keys], pa.string()), pa.array([t for _, t in keys], pa.int32()), pa.array([n[k] for k in keys], pa.int64()), pa.array([texts[k] for k in keys], pa.int64())], names=["feature", "toxic", "n", "texts"])
        n.clear()
        texts.clear()
        return out

    for b in batches:
        for i, toxic in enumerate(b.column(0).to_pylist()):
            own: Counter = Counter({ALL: 0})
            for w, k in Counter(tokens(b.column(1)[i].as_py() or "")).items():
                own[ALL] += k
                for f in features(w):
                    own[f] += k
            n.update({(f, toxic): k for f, k in own.items()})
            texts.update((f, toxic) for f in own)
            if len(n) > MOST_COUNTED:
                yield told()
    if n:
        yield told()
    trim()


def log_odds(y1, y0, n1: float, n0: float):
    """Of counts y1 among n1 and y0 among n0, with the prior: the log-odds ratio, and its standard score."""
    share = (y1 + y0) / (n1 + n0)
    a, b = y1 + HALF + PRIOR * share, y0 + HALF + PRIOR * share
    odds = F.log(a / (n1 + PRIOR + 1 - a)) - F.log(b / (n0 + PRIOR + 1 - b))
    return odds, odds / F.sqrt(1 / a + 1 / b)


def lexicon(counts: DataFrame, tokens_: tuple[float, float], texts: tuple[float, float]) -> dict[str, float]:
    """All features that speak for toxic texts, with the lower bound of their log-odds.

    They are fewer than the features of LEARN_ROWS texts divided by LEAST_TEXTS: each stands in that many toxic ones.
    """
    if not all(tokens_) or not all(texts):
        return {}
    # texts tell whether a feature is one, since occurrences in one text hang together
    _, z = log_odds(F.col("texts1"), F.col("texts0"), *texts)
    odds, _ = log_odds(F.col("n1"), F.col("n0"), *tokens_)
    best = counts.filter(F.col("texts1") >= LEAST_TEXTS).select("feature", odds.alias("odds"), z.alias("z")).filter((F.col("z") >= LEAST_Z) & (F.col("odds") > 0))
    return {r["feature"]: r["odds"] * (1 - BOUND / r["z"]) for r in best.collect()}


class Scores(dict):
    """A token's log-odds: the largest of its features, or 0. Remembers the tokens that it was asked for."""

    def __init__(self, lex: dict[str, float]) -> None:
        self.lex = lex

    def __missing__(self, token: str) -> float:
        score = max((self.lex[f] for f in features(token) if f in self.lex), default=0.0)
        if len(self) > REMEMBERED:
            self.clear()
        self[token] = score
        return score


def segments(at: list[int], scores: list[float], cost: float) -> list[tuple[int, int, float]]:
    """All maximal segments (first, last, score) of a text whose tokens at the places `at` score and all others cost `cost`."""
    stack: list[list] = []  # first, last, left sum, right sum
    total, before = 0.0, -1
    for place, s in zip(at, scores, strict=True):
        total -= cost * (place - before - 1)
        before = place
        if s <= 0:
            total += s
            continue
        now = [place, place, total, total + s]
        total += s
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= now[2]:
                j -= 1
            if j < 0 or stack[j][3] >= now[3]:
                stack.append(now)
                break
            now = [stack[j][0], now[1], stack[j][2], now[3]]
            del stack[j:]
    return [(a, b, r - left) for a, b, left, r in stack]


class Law:
    """The lexicon with the law of its segments' scores in texts that are not toxic: the rate and K, and the cost of other tokens."""

    def __init__(self, lex: dict[str, float], cost: float, rate: float, k: float) -> None:
        self.lex, self.cost, self.rate, self.k = lex, cost, rate, k

    def found(self, words: list[str], scores: Scores) -> list[tuple[int, int, float]]:
        """The maximal segments (first, last, score) of a text's tokens."""
        each = list(map(scores.__getitem__, words)) if self.lex else []
        if not any(each):
            return []
        at = [i for i, s in enumerate(each) if s]
        return segments(at, [each[i] for i in at], self.cost)

    def evidence(self, text: str, scores: Scores, least: float = math.inf) -> tuple[int, float, list]:
        """The length in tokens, the strongest evidence against chance, and the passages with at least so much, as places in the text."""
        words = tokens(text)
        n, best, told = len(words), 0.0, []
        for a, e, s in self.found(words, scores):
            # -log of the number of such segments expected by chance in a text of n tokens
            evidence = self.rate * s - math.log(self.k * n)
            best = max(best, evidence)
            if evidence >= least:
                told.append([a, e])
        if told:
            at = [m.span() for m in WORD.finditer(small(text))]
            told = [[at[a][0], at[e][1]] for a, e in told]
        return n, best, told

    def find(self, least: float):
        """For mapInArrow over (doc_id, text): evidence() of each."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trim()
            scores = Scores(self.lex)
            for b in batches:
                found = [self.evidence(text.as_py() or "", scores, least) for text in b.column(1)]
                yield pa.RecordBatch.from_pylist([{"doc_id": i, "n": n, "evidence": x, "segments": s} for i, (n, x, s) in zip(b.column(0).to_pylist(), found, strict=True)], schema=EVIDENCE)
            del scores
            trim()

        return run

    def passing(self, text: str, most: float):
        """For mapInArrow: the rows whose texts have less evidence than `most`."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trim()
            scores = Scores(self.lex)
            for b in batches:
                yield b.filter(pa.array([self.evidence(t.as_py() or "", scores)[1] < most for t in b.column(b.schema.get_field_index(text))], pa.bool_()))
            del scores
            trim()

        return run

    def chances(self, least: float):
        """For mapInArrow over (text): of each text, 1 if it has a segment, and its tokens times exp(-rate * score) of the best one, of `least` without one."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scores = Scores(self.lex)
            for b in batches:
                rows = []
                for text in b.column(0):
                    words = tokens(text.as_py() or "")
                    best = max((s for *_, s in self.found(words, scores)), default=0.0)
                    rows.append((int(best > 0), len(words) * math.exp(-self.rate * (best or least))))
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.float64())], names=["has", "chance"])

        return run


def token_scores(lex: dict[str, float]):
    """For mapInArrow over (toxic, text): how many tokens have each score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        scores, found = Scores(lex), Counter()
        for b in batches:
            for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found.update((toxic, scores[w]) for w in tokens(text or ""))
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.int32()), pa.array([s for _, s in found], pa.float64()), pa.array(list(found.values()), pa.int64())], names=["toxic", "score", "n"])

    return run


def law_of(lex: dict[str, float], told: list, clean: DataFrame) -> Law:
    """The law of extreme values of segments' scores.

    The cost of a token that scores nothing follows from how often tokens score in toxic texts. The rate is the positive
    root x of E[exp(x s)] = 1 over a token's score s in the others, with half a token of the least score among them, so
    that there is one. K is the most likely one for the best scores of the texts `clean`: with segments over a score s
    in a text of n tokens expected K n exp(-x s) times, texts without one tell that they have none over the least score.
    """
    total = [sum(r["n"] for r in told if r["toxic"] == t) or 1 for t in (0, 1)]
    scoring = [sum(r["n"] for r in told if r["toxic"] == t and r["score"]) for t in (0, 1)]
    p0, p1 = scoring[0] / total[0], min(0.5, scoring[1] / total[1])
    least = min(lex.values(), default=1.0)
    s = np.array([least, *[r["score"] for r in told if r["toxic"] == 0 and r["score"]]])
    p = np.array([0.5, *[r["n"] for r in told if r["toxic"] == 0 and r["score"]]]) / (total[0] + 0.5)
    cost = max(0.01, math.log((1 - p0) / (1 - p1)) if p1 > p0 else 0.0, 2 * float((p * s).sum()))  # on the whole, scores fall
    f = lambda x: float((p * np.exp(np.minimum(700, x * s))).sum() + (1 - p.sum()) * math.exp(-x * cost) - 1)
    low, high = 1e-6, 1.0
    while f(high) < 0:
        low, high = high, 2 * high
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    law = Law(lex, cost, high, 1.0)
    if lex:
        seen = clean.select("text").mapInArrow(law.chances(least), "has bigint, chance double").agg(F.sum("has"), F.sum("chance")).first()
        if seen[1]:
            law.k = ((seen[0] or 0) + 0.5) / (seen[1] + 0.5)
    return law


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept, by Newton steps with a small penalty; the slope is not negative."""
    a, b = 0.0, math.log((y.sum() + 1) / (len(y) - y.sum() + 9))  # without any label, one in ten
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((y - p) * x).sum() - 0.05 * a, (y - p).sum()])
        h = np.array([[(w * x * x).sum() + 0.05, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        da, db = np.linalg.solve(h, g)
        a, b = a + float(np.clip(da, -2, 2)), b + float(np.clip(db, -2, 2))
        if abs(da) + abs(db) < 1e-8:
            break
    return max(a, 0.0), b


class Model:
    """What scoring needs: the law with its lexicon, and the calibration."""

    def __init__(self, law: Law, slope: float, intercept: float) -> None:
        self.law, self.slope, self.intercept = law, slope, intercept

    def even(self) -> float:
        """The evidence at which the score is a half."""
        return -self.intercept / self.slope if self.slope > 0 else math.inf * (1 if self.intercept < 0 else -1)

    def keep(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """The rows, with all their columns, whose score is under a half."""
        return docs.mapInArrow(self.law.passing(text, self.even()), docs.schema)

    def score(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """doc_id, score and segments (start and end in code points of the passages with evidence for a half or more) of every row."""
        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        out = rows.mapInArrow(self.law.find(self.even()), "doc_id bigint, n bigint, evidence double, segments array<array<int>>")
        return out.select("doc_id", (1 / (1 + F.exp(-(self.slope * F.col("evidence") + self.intercept)))).alias("score"), "segments")


def fit(docs: DataFrame, labels: DataFrame, learn_rows: int = LEARN_ROWS) -> Model:
    """Learns from about `learn_rows` of the labelled rows whose doc_id is not held out; null labels, ids and unlabelled rows are left.

    A doc_id labelled twice is toxic if one label is, and rows of one doc_id give one text, the least. Texts are read
    whole. Without both classes all scores are one rate, a tenth if there is no label. What comes to the driver, the
    lexicon and one number for each text that calibrates, is bounded by `learn_rows`.
    """
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id"), FOLDS, HELD_FOLD))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    share = min(1.0, learn_rows / max(1, known.count()))
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1_000_000))
    some = known.filter(draw < round(share * 1_000_000)).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3)).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(some), "doc_id")  # about learn_rows ids
    sample = sample.groupBy("doc_id", "toxic", "part").agg(F.min("text").alias("text"))  # rows of one id are one text
    sample = written(sample, "toxicity-sample")
    first = sample.filter(F.col("part") < LEXICON_PARTS).select("toxic", "text")
    counts = first.mapInArrow(count_features, "feature string, toxic int, n bigint, texts bigint").groupBy("feature").agg(
        *[F.sum(F.when(F.col("toxic") == t, F.col(c)).otherwise(0)).alias(f"{c}{t}") for c in ("n", "texts") for t in (0, 1)]
    )
    counts = written(counts, "toxicity-features")
    size = counts.filter(F.col("feature") == ALL).first()
    n, n_texts = ((size[f"{c}1"], size[f"{c}0"]) if size else (0, 0) for c in ("n", "texts"))
    lex = lexicon(counts.filter(F.col("feature") != ALL), n, n_texts)
    scores = first.mapInArrow(token_scores(lex), "toxic int, score double, n bigint").groupBy("toxic", "score").agg(F.sum("n").alias("n")).collect()
    law = law_of(lex, scores, first.filter("toxic = 0"))
    rest = sample.filter(F.col("part") >= LEXICON_PARTS)
    seen = rest.select(F.col("toxic").cast("long"), "text").mapInArrow(law.find(math.inf), "toxic bigint, n bigint, evidence double, segments array<array<int>>").select("evidence", "toxic").toPandas()
    return Model(law, *logistic(seen["evidence"].to_numpy(float), seen["toxic"].to_numpy(float)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts score as texts without evidence; null ids are kept and not held out; equal rows score the same;
    texts are scored whole; other columns are not read. passages: start:end in code points, comma-joined."""
    docs = read(spark, sf_dir, "documents")
    out = fit(docs, read(spark, sf_dir, "labels")).score(docs)
    passages = F.array_join(F.transform("segments", lambda s: F.concat_ws(":", s[0].cast("string"), s[1].cast("string"))), ",")
    return out.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_FOLD).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), passages.alias("passages"))
