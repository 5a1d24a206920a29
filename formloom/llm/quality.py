"""Quality rules, line first: lines that break a rule are removed, then documents that lost too much are rejected."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: Odd numbers for the hash of a window, modulo 2**64.
_ODD = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WINDOW)], np.uint64)
#: What tells lines of web pages' frames.
BOILERPLATE = re.compile(
    r"cookie(s)? (policy|settings|preferences)|privacy policy|terms (of use|of service|and conditions)|all rights reserved|javascript|lorem ipsum|"
    r"(sign|log) ?(in|up|out)\b|subscribe|newsletter|skip to (main )?content|back to top|share (this|on)|follow us|read more|click here|powered by|©",
    re.IGNORECASE,
)
NAVIGATION = re.compile(r"(?:^|\s)(?:[|»›>·•/]|::|->|→)(?=\s|$)")
ENDS = (".", "!", "?", ":", ";", "…", "。", "！", "？", '"', "'", "”", "’", "»", ")", "]")

SCHEMA = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, kept_words bigint, cleaned string"
ARROW = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("kept_words", pa.int64()), ("cleaned", pa.string())])


def repeated(ids: np.ndarray) -> int:
    """Words in windows that occur twice or more. Hashes find the few documents with any; those are counted exactly."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        hashes = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            hashes += ids[k : k + n] * _ODD[k]
    hashes.sort()
    if not (hashes[1:] == hashes[:-1]).any():
        return 0
    own, size = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while size < WINDOW:  # ids of windows of twice the size
        a, b = own[:-size], own[size:]
        own, size = np.unique(a * (own.max() + 1) + b, return_inverse=True)[1].astype(np.int64), 2 * size
    twice = np.bincount(own)[own] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def line_fails(line: str, words: list[bytes], symbols: int, seen: bool) -> str | None:
    """The rule that a line with words breaks, or None.

    duplicate: equal to an earlier line of three words or more. symbols: more than one of `#*$%&|<>` for five words.
    navigation: a separator for every four words. shouting: 5 words or more, four fifths of the letters upper case.
    repetition: 6 words or more, over half of them equal to the one before. boilerplate: at most 12 words with a phrase of
    web pages' frames. punctuation: at most 4 words, without a closing mark, among other lines.
    """
    n = len(words)
    if seen and n >= 3:
        return "duplicate"
    if 5 * symbols > n:
        return "symbols"
    if any(c in line for c in "|>/:»›·•→"):
        if 4 * len(NAVIGATION.findall(line)) >= n:
            return "navigation"
    if n >= 5 and (not line.isascii() or line != line.lower()):  # some capitals beyond ASCII have no small letter
        upper = sum(map(str.isupper, line))
        if upper and 5 * upper >= 4 * sum(map(str.isalpha, line)):
            return "shouting"
    if n >= 6 and 2 * sum(map(bytes.__eq__, words[1:], words[:-1])) > n:
        return "repetition"
    if n <= 12 and BOILERPLATE.search(line):
        return "boilerplate"
    if n <= 4 and not line.rstrip().endswith(ENDS):
        return "punctuation"
    return None


def judge(text: bytes, number: defaultdict, max_lost: float, clean: bool) -> tuple:
    """Of one text, the columns after doc_id."""
    words = text.split()
    n = len(words)
    string = text.decode()
    blank = sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen, dup, kept, out = set(), 0, 0, []
    lines = string.split("\n")
    for line in lines:
        own = line.encode().split() if len(lines) > 1 else words
        if not own:
            out.append(line)
            continue
        again = line in seen
        dup += again
        seen.add(line)
        has = sum(map(line.count, "#*$%&|<>")) if symbols else 0
        why = line_fails(line, own, has, again)
        if why == "punctuation" and len(lines) == 1:
            why = None
        if why is None:
            kept += len(own)
            out.append(line)
    repeat = repeated(np.array(list(map(number.__getitem__, words)), np.uint64)) if n > WINDOW else 0
    base_failed = n < 20 or 100 * repeat > 30 * n
    return n, len(string) - blank, symbols, dup, repeat, base_failed, not base_failed and kept >= (1 - max_lost) * n, kept, "\n".join(out) if clean else None


def run(max_lost: float, clean: bool):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number: defaultdict = defaultdict()
            number.default_factory = number.__len__
            rows = []
            for i in range(b.num_rows):
                text = b.column(1)[i].as_py()
                rows.append((b.column(0)[i].as_py(), *judge((text or "").encode(), number, max_lost, clean)))
                if len(number) > 200_000:
                    number.clear()
            number.default_factory = None  # else it refers to itself and waits for the collector
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)] if rows else [pa.array([], f.type) for f in ARROW], schema=ARROW)

    return over


def clean_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_lost: float = 0.5, clean: bool = True) -> DataFrame:
    """Of every row: the base counts, base_failed, kept, kept_words (in lines that stay) and cleaned (those lines; null unless clean).

    Null and empty texts have no words and fail; null ids are kept; equal rows are judged each; other columns are not
    read; texts and lines of any length are read whole; no rows give none. A document stays if it passes the base and
    loses at most `max_lost` of its words with the lines that are removed; one that loses just so much stays.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run(max_lost, clean), SCHEMA)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(read(spark, sf_dir, "documents"), clean=False).drop("cleaned", "kept_words")
