"""Personal data: entities of known form, and identifiers found through the contexts that such entities induce.

Entities of known form are the seeds. The two words before an identifier-like token (at a text's start, the one), or a
label that ends in a mark, are a pattern. Patterns and instances are the two sides of a graph, scored in turns: a pattern by how much of what it
introduces is known, an instance by the patterns that introduce it. Tokens that confident patterns introduce are new
identifiers. Only identifier-like tokens enter the graph, and they are summed by pattern and instance before it is built.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, written

#: The forms of the base kinds. Of an email, what follows the @.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: An address begins where a run of digits does, so a run is read from its start alone, and at most as each of its four parts.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
KINDS = ("email", "ip", "card", "phone", "context")

_EDGE, _AFTER = r"(?<![^\x20\x09-\x0D(\[\"'<:=#])", r"(?=[\x20\x09-\x0D.,;:!?)\]\"'>]|\Z)"
#: Runs without white space that hold a digit, each tried once from its start.
NUMBERED = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+")
RUN = re.compile(r"[^\x20\x09-\x0D]+")
#: An identifier-like token: six characters or more with five digits or more, of letters, digits and joints.
TOKEN = re.compile(_EDGE + r"[A-Za-z0-9]+(?:[-./_][A-Za-z0-9]+)*" + _AFTER)
#: Tokens that are like a seed: emails and handles, names with joints, numbers of colons, and seven to 19 digits with joints.
LIKE = tuple(re.compile(_EDGE + form + _AFTER) for form in (
    r"[A-Za-z0-9._%+-]++(?:@|[(\[]at[)\]])[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*", r"@[A-Za-z0-9_]+(?:[.-][A-Za-z0-9_]+)*",
    r"(?=[A-Za-z0-9-]*[._])[A-Za-z0-9]+(?:[._-][A-Za-z0-9]+)+", r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}", r"\(?[0-9](?:[\x20().-]{0,2}[0-9])+",
))
#: A context word of more characters is told by its last ones and a checksum of all.
LONG_WORD, LAST = 48, 16
#: Turns of scoring; the confidence of a pattern that is believed; the known instances that it needs.
TURNS, CONFIDENT, LEAST_KNOWN = 3, 0.7, 3.0
#: How much an instance of which nothing is known counts against a pattern: it lacks a label, it is not shown to be wrong.
UNLABELLED = 0.5

TABLE = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base array<struct<start:int,kind:int,end:int>>, tokens array<struct<start:int,end:int,value:string,known:boolean,patterns:array<string>>>"
SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
MENTION = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("known", pa.bool_()), ("patterns", pa.list_(pa.string()))])
ARROW = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS[:4]], ("base", pa.list_(SPAN)), ("tokens", pa.list_(MENTION))])


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """By the @ signs: a match's local part is the whole run of its characters that ends there, after the last match."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARACTERS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            free = m.end()
            out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base entities, sorted; the kind is its place in KINDS."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split(".") if len(x.lstrip("0")) < 4) and all(len(x.lstrip("0")) < 4 for x in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "") if len(m[0]) >= 12 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out)


def small(text: str) -> str:
    """In small letters, digits as 0, of the same length: some letters have a small form of two characters and stay."""
    own = text.lower()
    if len(own) != len(text):
        own = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    return DIGIT.sub("0", own)


class Contexts:
    """What stands before a place of a text: places come in ascending order, and every run is read once."""

    def __init__(self, text: str) -> None:
        self.text = small(text)
        runs = [m.span() for m in RUN.finditer(text)]
        self.starts, self.ends = [a for a, _ in runs], [b for _, b in runs]
        self.read: dict[int, tuple[int, int]] = {}

    def word(self, start: int, end: int) -> str:
        if end - start <= LONG_WORD:
            return self.text[start:end]
        at, sum_ = self.read.get(start, (start, 0))
        if at > end:
            at, sum_ = start, 0
        self.read[start] = end, (sum_ := zlib.crc32(self.text[at:end].encode("utf-8", "surrogatepass"), sum_))
        return f"\u2026{sum_:08x}{self.text[end - LAST : end]}"

    def patterns(self, place: int) -> list[str]:
        """The two words before a place, or the one that opens the text, and the last one if it is a label. Digits read as 0."""
        k = bisect_left(self.starts, place) - 1
        if k < 0:
            return []
        last = self.word(self.starts[k], min(place, self.ends[k]))
        before = self.word(self.starts[k - 1], self.ends[k - 1]) if k else ""
        return [f"{before} {last}"] + ([last] if last[-1] in ":=#" and len(last) > 1 else [])


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """The base entities and the identifier-like tokens beside them, that have a context, by start."""
    found: dict[int, int] = {}
    if DIGIT.search(text):
        for run in NUMBERED.finditer(text):
            for m in TOKEN.finditer(text, *run.span()):
                if len(m[0]) >= 6 and len(DIGIT.findall(m[0])) >= 5:
                    found[m.start()] = m.end()
    for k, form in enumerate(LIKE):
        for m in form.finditer(text):
            if k != len(LIKE) - 1 or 7 <= len(DIGIT.findall(m[0])) <= 19:
                found.setdefault(m.start(), m.end())
    starts, ends = [], []  # of the base entities, those that overlap made one
    for a, _, b in base:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    free = lambda a, b: (k := bisect_left(starts, b) - 1) < 0 or ends[k] <= a
    every = sorted([(a, b, True) for a, _, b in base] + [(a, b, False) for a, b in found.items() if free(a, b)])
    if not every:
        return []
    contexts = Contexts(text)
    told = [{"start": a, "end": b, "value": text[a:b].lower(), "known": known, "patterns": contexts.patterns(a)} for a, b, known in every]
    return [x for x in told if x["patterns"]]


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for i in range(b.num_rows):
            text = b.column(1)[i].as_py() or ""
            base = base_spans(text)
            counts = [0] * 4
            for _, kind, _ in base:
                counts[kind] += 1
            rows.append({"doc_id": b.column(0)[i].as_py(), **{f"n_{k}": n for k, n in zip(KINDS, counts, strict=False)}, "base": [{"start": s, "kind": k, "end": e} for s, k, e in base], "tokens": mentions(text, base)})
        yield pa.RecordBatch.from_pylist(rows, schema=ARROW)


def confident_patterns(edges: DataFrame, turns: int = TURNS) -> DataFrame:
    """(pattern, confidence) of the believed patterns over edges (pattern, value, known).

    A pattern's confidence is the sum of its instances' scores over one more than their number, in which what an instance
    lacks to 1 counts as UNLABELLED; a known instance scores 1, any other what the believed patterns that introduce it
    leave to no chance.
    """
    score = F.when(F.col("known"), 1.0).otherwise(0.0)
    scored = edges.withColumn("score", score)
    for turn in range(turns):
        p = scored.groupBy("pattern").agg(F.sum("score").alias("mass"), F.sum(F.col("score") + UNLABELLED * (1 - F.col("score"))).alias("n"))
        p = p.withColumn("confidence", F.col("mass") / (F.col("n") + 1)).filter((F.col("mass") >= LEAST_KNOWN) & (F.col("confidence") >= CONFIDENT))
        p = written(p.select("pattern", "confidence"), "pii-patterns")
        if turn == turns - 1 or p.isEmpty():
            return p
        new = edges.filter(~F.col("known")).join(p, "pattern").groupBy("value").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("new"))
        scored = edges.join(new, "value", "left").withColumn("score", F.when(F.col("known"), 1.0).otherwise(F.coalesce("new", F.lit(0.0))))
    raise ValueError("turns is less than 1")


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base and spans (arrays of start, kind, end in code points) of every row.

    Null and empty texts hold none; null ids are kept; equal rows are searched each, and count once as context; other
    columns are not read; texts, words and tokens of any length are read whole; patterns with equal confidence are all
    believed or none. No rows give none.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    table = written(rows.mapInArrow(scan, TABLE).withColumn("_fl_row", F.monotonically_increasing_id()), "pii")
    told = table.select("_fl_row", F.explode("tokens").alias("t")).select("_fl_row", "t.*").withColumn("pattern", F.explode("patterns"))
    edges = written(told.groupBy("pattern", "value").agg(F.max("known").alias("known")), "pii-edges")
    believed = confident_patterns(edges)
    found = told.filter(~F.col("known")).join(believed, "pattern").groupBy("_fl_row").agg(F.collect_set(F.struct("start", F.lit(4).alias("kind"), "end")).alias("found"))
    out = table.join(found, "_fl_row", "left").withColumn("spans", F.when(F.col("found").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "found"))))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS[:4]], "base", "spans")


def told(spans):
    """kind:start:end by start, then kind, comma-joined."""
    name = lambda k: reduce(lambda a, i: F.when(k == i, KINDS[i]).otherwise(a), range(len(KINDS)), F.lit(None).cast("string"))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_personal_data(read(spark, sf_dir, "documents"))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS[:4]], F.sha2(told(F.col("base")), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
