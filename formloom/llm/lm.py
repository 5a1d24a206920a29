"""Prediction by partial matching over bytes: escape estimation, symbol exclusion, and the code length of each document.

The model reads a text as its words with a space between, from a start mark to an end. A symbol's contexts are the last
DEPTH, ..., 1, 0 bytes before it, across words, back to the start mark. Escapes are estimated by leaving each training
symbol out, for classes of nodes. Supersteps pass packed messages:

1. documents to blocks: each block's distinct (context, symbol) pairs and distinct words with their training counts;
2. groups of pairs, by the last three bytes of the context, and buckets of words: counts over all blocks;
3. groups and buckets again: each pair's code length, escapes and exclusions included, and each word's count, told to
   the blocks that ask. A group holds the nodes of orders DEPTH to 3 whole; orders 2 to 0, of at most 2**24 pairs, are
   summed in Spark and at hand everywhere;
4. blocks: sums over each document.

What travels follows distinct pairs and words of blocks, so a frequent context is no larger than its distinct symbols.
A group's memory follows its distinct pairs: requests stream by. The trie grows with the corpus and is never broadcast
or collected.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import batch, pack, pack_ints, trim, unpack, unpack_ints
from .common import held_out, read, spread, written

DEPTH = 5
#: Orders at hand everywhere, at most 2**24 pairs.
LOW = 2
#: Groups of contexts and buckets of words at most: how many messages a block sends.
GROUPS = 4096
#: Bytes of text after which a block ends: its words and pairs are held at once.
BLOCK_BYTES = 12 << 20
#: Symbols worked on at once.
AT_ONCE = 1 << 18
#: Classes of a node's total and of its distinct symbols, for estimates of escapes.
TOTALS, KINDS = 48, 12
FOLDS, HELD_FOLD = 7, 2
COUNTED = "kind int, bucket int, blob binary, counts binary"
COUNTED_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary()), ("counts", pa.binary())])
REQUEST = "kind int, block bigint, bucket int, blob binary, counts binary, ids array<bigint>"
REQUEST_ARROW = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary()), ("counts", pa.binary()), ("ids", pa.list_(pa.int64()))])
REPLY = "kind int, block bigint, blob binary, costs binary, counts binary, ids array<bigint>"
REPLY_ARROW = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("blob", pa.binary()), ("costs", pa.binary()), ("counts", pa.binary()), ("ids", pa.list_(pa.int64()))])
SCORES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
#: Kinds of rows: a merged table comes before the requests of its group.
TABLE, WORDS, PAIRS, LOW_PAIRS, TEXT, ESTIMATES = range(-1, 5)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(DEPTH + 2)], np.uint64)
_U = np.uint64


def symbols(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the symbols of texts (words with a space between) and their ends: the text's number and the key of the pair.

    A key is order << 56 | context << 8 | symbol, with the longest context of at most DEPTH bytes.
    """
    s = np.frombuffer(b"".join([b"\n%b\n" % t for t in texts]), np.uint8)
    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    starts = np.cumsum(lens) - lens
    for p in range(0, len(s), AT_ONCE):
        e = min(p + AT_ONCE, len(s))
        j = np.arange(p, e)
        first, last = np.searchsorted(starts, [p, e - 1], side="right") - 1
        edges = np.clip(np.append(starts[first : last + 1], e), p, e)
        doc = np.repeat(np.arange(first, last + 1), np.diff(edges))
        far = j - starts[doc]
        before = max(0, p - DEPTH)
        wide = np.concatenate([np.zeros(DEPTH - (p - before), _U), s[before:e].astype(_U)])  # wide[DEPTH] is s[p]
        key = wide[DEPTH:].copy()
        for k in range(1, DEPTH + 1):
            key |= wide[DEPTH - k : len(wide) - k] << _U(8 * k)
        short = np.flatnonzero(far < DEPTH)
        key[short] &= _MASKS[far[short] + 1]
        on = far > 0
        yield doc[on], ((np.minimum(far, DEPTH).astype(_U) << _U(56)) | key)[on]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of each one's counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(counts, first) if len(first) else counts)


def group_of(keys: np.ndarray, groups: int) -> np.ndarray:
    """By the last three bytes of the context."""
    three = (keys >> _U(8)) & _U(0xFFFFFF)
    return (((three * _U(0x9E3779B97F4A7C15)) >> _U(40)) % _U(groups)).astype(np.int64)


def gathered(keys: list[np.ndarray], counts: list[np.ndarray], most: int = 1 << 19) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The pieces, summed to one where those after the first outgrow it."""
    if len(keys) > 1 and sum(map(len, keys[1:])) > max(most, len(keys[0])):
        keys, counts = ([x] for x in summed(np.concatenate(keys), np.concatenate(counts)))
    return keys, counts


class Pairs:
    """The distinct pairs of a block's texts with their training counts, and the texts, packed as they come."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.texts: list[bytes] = []
        self.learns: list[bool] = []
        self.size = self.many = 0
        self.packer, self.packed = zstandard.ZstdCompressor(level=3).compressobj(), []

    def add(self, text: bytes, learns: bool) -> None:
        self.texts.append(text)
        self.learns.append(learns)
        self.size += len(text) + 1
        if self.size >= AT_ONCE:
            self.take()

    def take(self) -> None:
        for k, text in enumerate(self.texts):
            self.packed.append(self.packer.compress(b"\n" + text if self.many + k else text))
        learns = np.array(self.learns, bool)
        for doc, key in symbols(self.texts):
            codes, own = pd.factorize(key)
            self.keys.append(own)
            self.counts.append(np.bincount(codes, learns[doc], len(own)).astype(np.int64))
            self.keys, self.counts = gathered(self.keys, self.counts)
        self.many += len(self.texts)
        self.texts, self.learns, self.size = [], [], 0

    def told(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The texts, a line each, packed; the keys, sorted, and their counts."""
        self.take()
        return b"".join([*self.packed, self.packer.flush()]), *summed(np.concatenate(self.keys), np.concatenate(self.counts))


class Words:
    """The distinct words of a block with their training counts."""

    def __init__(self) -> None:
        self.learned: Counter = Counter()
        self.others: set[bytes] = set()

    def add(self, words: list[bytes], learns: bool) -> None:
        self.learned.update(words) if learns else self.others.update(words)

    def told(self, buckets: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
        """Each bucket of a hash that has words: its number, the words, a line each, and their counts."""
        words = [*self.learned, *self.others.difference(self.learned)]
        counts = np.zeros(len(words), np.int64)
        counts[: len(self.learned)] = np.fromiter(self.learned.values(), np.int64, len(self.learned))
        bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % buckets
        by = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for b in range(buckets):
            if len(at := by[edges[b] : edges[b + 1]]):
                yield b, b"\n".join([words[i] for i in at.tolist()]), counts[at]


def lm_blocks(groups: int, block_bytes: int = BLOCK_BYTES):
    """Superstep 1, for mapInArrow over (doc_id, text, learns): a block's documents, and its words and pairs for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        trim()
        part, made, words, pairs, ids, size = TaskContext.get().partitionId(), 0, Words(), Pairs(), [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal pairs, words
            row = lambda **cells: batch([dict.fromkeys(REQUEST_ARROW.names) | {"block": (part << 20) + made} | cells], REQUEST_ARROW)
            text, keys, counts = pairs.told()
            pairs = Pairs()
            yield row(kind=TEXT, blob=text, ids=ids)
            on = keys[counts > 0]
            order = np.minimum(on >> _U(56), _U(LOW))
            low, n = summed((order << _U(56)) | (on & _MASKS[order.astype(np.int64) + 1]), counts[counts > 0])
            yield row(kind=LOW_PAIRS, blob=pack(low.astype("<u8").tobytes()), counts=pack(n.astype("<i8").tobytes()))
            del text, on, order, low, n
            group = group_of(keys, groups)
            by = np.argsort(group, kind="stable")
            edges = np.searchsorted(group[by], np.arange(groups + 1))
            for g in range(groups):
                if len(at := by[edges[g] : edges[g + 1]]):
                    yield row(kind=PAIRS, bucket=g, blob=pack(keys[at].astype("<u8").tobytes()), counts=pack_ints(counts[at]))
            del keys, counts, group, by
            for b, blob, n in words.told(groups):
                yield row(kind=WORDS, bucket=b, blob=pack(blob), counts=pack_ints(n))
            words = Words()

        for b in batches:
            for i, doc_id, learns in zip(range(b.num_rows), b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                own = (b.column(1)[i].as_py() or "").encode().lower().split()
                text = b" ".join(own)
                pairs.add(text, bool(learns))
                words.add(own, bool(learns))
                ids.append(doc_id)
                size += len(text)
                if size >= block_bytes:
                    yield from out()
                    made, ids, size = made + 1, [], 0
                    trim()
        if ids:
            yield from out()
        del words, pairs, ids
        trim()

    return run


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each block, by which the rows are sorted."""
    rows: list[dict] = []
    for r in rows_of(batches):
        if rows and r["block"] != rows[0]["block"]:
            yield rows
            rows = []
        rows.append(r)
    if rows:
        yield rows


def table_row(bucket: int, blob: bytes, counts: np.ndarray, kind: int = TABLE) -> pa.RecordBatch:
    return batch([{"kind": kind, "bucket": bucket, "blob": pack(blob), "counts": pack(counts.astype("<i8").tobytes())}], COUNTED_ARROW)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Superstep 2, for mapInArrow over requests sorted by bucket: each bucket's training words and their counts."""
    now, total = None, {}

    def done() -> Iterator[pa.RecordBatch]:
        if now is not None:
            yield table_row(now, b"\n".join(total), np.fromiter(total.values(), np.int64, len(total)))

    for r in rows_of(batches):
        if r["bucket"] != now:
            yield from done()
            now, total = r["bucket"], {}
        for w, n in zip(unpack(r["blob"]).split(b"\n"), unpack_ints(r["counts"]).tolist(), strict=True):
            if n:
                total[w] = total.get(w, 0) + n
    yield from done()


def tell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Superstep 3, for mapInArrow over tables and requests sorted by bucket and kind: the training counts of asked words."""
    now, total = None, {}
    for r in rows_of(batches):
        if r["bucket"] != now:
            now, total = r["bucket"], {}
        words = unpack(r["blob"]).split(b"\n")
        if r["kind"] == TABLE:
            n = np.frombuffer(unpack(r["counts"]), "<i8").tolist()
            total = dict(zip(words, n, strict=True)) if n else {}
            continue
        n = np.fromiter((total.get(w, 0) for w in words), np.int64, len(words))
        yield batch([dict.fromkeys(REPLY_ARROW.names) | {"kind": WORDS, "block": r["block"], "blob": r["blob"], "counts": pack(n.astype("<i8").tobytes())}], REPLY_ARROW)


def class_of(total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """By the power of two of the total, and the distinct symbols up to four or their power of two."""
    log = lambda x: np.log2(np.maximum(x, 1)).astype(np.int64)
    return np.minimum(log(total), TOTALS - 1) * KINDS + np.where(kinds <= 4, kinds, np.minimum(2 + log(kinds), KINDS - 1))


def left_out(order: int, node: np.ndarray, counts: np.ndarray, nodes: int) -> np.ndarray:
    """How often a symbol would be new if it were left out, by order and class of what is left: [escapes, all]."""
    total, kinds = np.bincount(node, counts, nodes).astype(np.int64), np.bincount(node, minlength=nodes)
    once = np.bincount(node, counts == 1, nodes).astype(np.int64)
    on = total > 1
    total, kinds, once = total[on], kinds[on], once[on]
    out = np.zeros((DEPTH + 1, TOTALS * KINDS, 2), np.int64)
    new, old = class_of(total - 1, kinds - 1), class_of(total - 1, kinds)
    for column, at, n in ((0, new, once), (1, new, once), (1, old, total - once)):
        out[order, :, column] += np.bincount(at, n, TOTALS * KINDS).astype(np.int64)
    return out


def escape(seen: np.ndarray, order: int, total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The probability of a new symbol: the class's rate, with one case of weight at kinds / (total + kinds)."""
    at = class_of(total, kinds)
    prior = kinds / np.maximum(1, total + kinds)
    return np.clip((seen[order, at, 0] + prior) / (seen[order, at, 1] + 1.0), 1e-9, 1 - 1e-9)


class Level:
    """The nodes of one order: totals, distinct symbols, and the mass that each node's symbols have in its parent."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, below: Level | None) -> None:
        """keys: context << 8 | symbol, distinct and sorted, with counts over 0."""
        self.keys, self.counts, self.order = keys, counts, order
        node = keys >> np.uint64(8)
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, np.int64)
        self.nodes = node[first]
        add = lambda x: np.add.reduceat(x, first) if len(first) else np.zeros(0, np.int64)
        self.total, self.kinds = add(counts), add(np.ones(len(keys), np.int64))
        self.outer = add(below.count(keys)) if below is not None else np.zeros(len(first), np.int64)

    def suffix(self, keys: np.ndarray) -> np.ndarray:
        """Of keys with contexts of at least this order: the last bytes of the context, and the symbol."""
        return keys & np.uint64((1 << (8 * (self.order + 1))) - 1)

    def count(self, keys: np.ndarray) -> np.ndarray:
        return self.find(self.keys, self.suffix(keys), self.counts)

    @staticmethod
    def find(among: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not len(among):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
        return np.where(among[at] == keys, values[at], 0)

    def at(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each key's node, and whether there is one."""
        node = self.suffix(keys) >> np.uint64(8)
        if not len(self.nodes):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.nodes, node), len(self.nodes) - 1)
        return at, self.nodes[at] == node

    def left_out(self) -> np.ndarray:
        return left_out(self.order, np.repeat(np.arange(len(self.nodes)), self.kinds), self.counts, len(self.nodes))


def low_levels(low: np.ndarray, n: np.ndarray) -> list[Level]:
    """Orders 0 to LOW, from distinct keys with contexts of at most LOW bytes, their longest."""
    levels: list[Level] = []
    for k in range(LOW + 1):
        on = (low >> _U(56)) >= k
        levels.append(Level(*summed(low[on] & _MASKS[k + 1], n[on]), k, levels[-1] if levels else None))
    return levels


def levels_of(low: list[Level], keys: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Orders 0 to DEPTH, from distinct keys with counts over 0."""
    levels = list(low)
    for k in range(LOW + 1, DEPTH + 1):
        on = (keys >> _U(56)) >= k
        levels.append(Level(*summed(keys[on] & _U((1 << (8 * (k + 1))) - 1), counts[on]), k, levels[-1] if levels else None))
    return levels


def costs_of(keys: np.ndarray, levels: list[Level], seen: np.ndarray) -> np.ndarray:
    """log10 of the probability of each pair's symbol in its context.

    From the longest context that was seen down: (1 - e) n / T for a symbol with count n, an escape e otherwise; T, and
    the class of e, are those of the node without the symbols of the longer context. After order 0, the bytes that are
    left are equally likely. An escape from a node with no other symbol costs nothing.
    """
    order, cost = (keys >> np.uint64(56)).astype(np.int64), np.zeros(len(keys))
    open_, mass, kinds = np.ones(len(keys), bool), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for level in reversed(levels):
        on = np.flatnonzero(open_ & (order >= level.order))
        at, there = level.at(keys[on])
        on, at = on[there], at[there]
        n, t, q = level.count(keys[on]), level.total[at] - mass[on], level.kinds[at] - kinds[on]
        cost[on] += step(seen, level.order, n, t, q)
        open_[on[n > 0]] = False
        mass[on], kinds[on] = level.outer[at], level.kinds[at]
    left = np.flatnonzero(open_)
    cost[left] -= np.log10(np.maximum(1, 256 - kinds[left]))
    return cost


def step(seen: np.ndarray, order: int, n: np.ndarray, t: np.ndarray, q: np.ndarray) -> np.ndarray:
    """log10 of what one node gives: the symbol's share, or the escape."""
    e = escape(seen, order, t, q)
    return np.where(n > 0, np.log10((1 - e) * np.maximum(n, 1) / np.maximum(t, 1)), np.where(t > 0, np.log10(e), 0.0))


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Superstep 2, for mapInArrow over requests sorted by group: each group's training pairs, and last left_out() of orders above LOW."""
    told, now, keys, counts = np.zeros((DEPTH + 1, TOTALS * KINDS, 2), np.int64), None, [], []

    def done() -> Iterator[pa.RecordBatch]:
        nonlocal told
        if now is not None:
            own, n = summed(np.concatenate(keys), np.concatenate(counts))
            for level in levels_of([], own, n):
                told += level.left_out()
            yield table_row(now, own.astype("<u8").tobytes(), n)

    for r in rows_of(batches):
        if r["bucket"] != now:
            yield from done()
            now, keys, counts = r["bucket"], [], []
        n = unpack_ints(r["counts"]).astype(np.int64)
        keys.append(np.frombuffer(unpack(r["blob"]), "<u8")[n > 0])
        counts.append(n[n > 0])
        keys, counts = gathered(keys, counts)
    yield from done()
    yield table_row(-1, b"", told, ESTIMATES)


def answer(low: np.ndarray, low_n: np.ndarray, seen: np.ndarray):
    """Superstep 3, for mapInArrow over tables and requests sorted by group and kind: the costs of asked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = low_levels(low, low_n)
        now, levels = None, base
        for r in rows_of(batches):
            if r["bucket"] != now:
                now, levels = r["bucket"], base
            keys = np.frombuffer(unpack(r["blob"]), "<u8")
            if r["kind"] == TABLE:
                levels = levels_of(base, keys, np.frombuffer(unpack(r["counts"]), "<i8"))
                continue
            cost = costs_of(keys, levels, seen)
            yield batch([dict.fromkeys(REPLY_ARROW.names) | {"kind": PAIRS, "block": r["block"], "blob": r["blob"], "costs": pack(cost.astype("<f8").tobytes())}], REPLY_ARROW)

    return run


def low_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for blob, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(unpack(x), "<i8")) for x in (blob, counts)], names=["key", "n"])


def totals_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (counts): their sum and number."""
    for b in batches:
        for x in b.column(0).to_pylist():
            n = np.frombuffer(unpack(x), "<i8")
            yield pa.RecordBatch.from_pydict({"tokens": [int(n.sum())], "words": [len(n)]})


def estimate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x in b.column(0).to_pylist():
            n = np.frombuffer(unpack(x), "<i8")
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["at", "n"])


def lines_of(blob: bytes) -> Iterator[list[bytes]]:
    """A packed text's lines, some at a time."""
    source, rest = zstandard.ZstdDecompressor().stream_reader(blob), b""
    while data := source.read(AT_ONCE):
        *lines, rest = (rest + data).split(b"\n")
        if lines:
            yield lines
    yield [rest]


def score(train_tokens: int, distinct: int, end_count: int):
    """Superstep 4, for mapInArrow over payloads and replies sorted by block: sums over documents."""

    def finish(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        of = lambda kind: [r for r in rows if r["kind"] == kind]
        (text,) = of(TEXT)
        base = lambda c: np.log10((c + 1.0) / (train_tokens + 1.0 * (distinct + 1)))
        number, counts = {}, []
        for r in of(WORDS):
            for w in unpack(r["blob"]).split(b"\n"):
                number[w] = len(number)
            counts.append(np.frombuffer(unpack(r["counts"]), "<i8"))
        count = np.concatenate([*counts, np.zeros(0, np.int64)])
        share = base(count)
        keys, costs = [], []
        for r in of(PAIRS):
            keys.append(np.frombuffer(unpack(r["blob"]), "<u8"))
            costs.append(np.frombuffer(unpack(r["costs"]), "<f8"))
        asked, cost, first = pd.Index(np.concatenate(keys)), np.concatenate(costs), 0
        del keys, costs
        for texts in lines_of(text["blob"]):
            own = np.zeros(len(texts))
            for doc, key in symbols(texts):
                own += np.bincount(doc, cost[asked.get_indexer(key)], len(texts))
            told = []
            for t in texts:
                words = t.split()
                at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                told.append((len(words) + 1, int((count[at] > 0).sum()) + (end_count > 0), float(share[at].sum() + base(end_count))))
            n, known, bases = zip(*told, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(text["ids"][first : first + len(texts)], pa.int64()), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(bases), pa.array(own)], schema=SCORES)
            first += len(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for rows in by_block(batches):
            yield from finish(rows)
            del rows
            trim()

    return run


def score_documents(docs: DataFrame, held, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row; the model learns from rows where `held` is false.

    The score is log10 of the probability of the text's words with a space between, and of the end. Null and empty texts
    are one end; null ids are kept; equal rows are scored each, and learned from each; other columns are not read; texts
    of any length are read whole, a task holding one block or one longer text. With no row to learn from, every byte is
    as likely as any other and the base is 0. No rows give none.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), (~held).alias("learns"))
    n = spread(rows, "text")
    groups = min(n, GROUPS)
    table = written(rows.mapInArrow(lm_blocks(groups), REQUEST), "lm-blocks")
    asked = {k: table.filter(F.col("kind") == k) for k in (WORDS, PAIRS)}
    counted = {k: written(asked[k].repartition(groups, "bucket").sortWithinPartitions("bucket").mapInArrow(f, COUNTED), "lm-counts") for k, f in ((WORDS, count_words), (PAIRS, count_pairs))}

    end_count = rows.filter("learns").count()
    known = counted[WORDS].select("counts").mapInArrow(totals_of, "tokens bigint, words bigint").agg(F.sum("tokens"), F.sum("words")).first()
    train_tokens, distinct = (known[0] or 0) + end_count, (known[1] or 0) + int(end_count > 0)
    low = table.filter(F.col("kind") == LOW_PAIRS).select("blob", "counts").mapInArrow(low_rows, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toPandas()  # at most 2**24 + 2**16 rows
    low_keys, low_n = low["key"].to_numpy(np.int64).view(_U), low["n"].to_numpy(np.int64)
    seen = sum((level.left_out() for level in low_levels(low_keys, low_n)), np.zeros((DEPTH + 1, TOTALS * KINDS, 2), np.int64))
    told = counted[PAIRS].filter(F.col("kind") == ESTIMATES).select("counts").mapInArrow(estimate_rows, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    seen.reshape(-1)[told["at"].to_numpy(np.int64)] += told["n"].to_numpy(np.int64)

    def replies(kind: int, reply) -> DataFrame:
        tables = counted[kind].filter(F.col("kind") == TABLE).select("kind", "bucket", F.lit(None).cast("bigint").alias("block"), "blob", "counts")
        both = tables.union(asked[kind].select("kind", "bucket", "block", "blob", "counts"))
        return both.repartition(groups, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(reply, REPLY)

    payloads = table.filter(F.col("kind") == TEXT).select("kind", "block", "blob", F.lit(None).cast("binary").alias("costs"), "counts", "ids")
    all_ = payloads.union(replies(WORDS, tell_counts)).union(replies(PAIRS, answer(low_keys, low_n, seen)))
    per_doc = all_.repartition(n, "block").sortWithinPartitions("block").mapInArrow(
        score(train_tokens, distinct, end_count), "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return per_doc.withColumn("train_tokens", F.lit(train_tokens).cast("long"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = lambda: held_out(F.col("doc_id"), FOLDS, HELD_FOLD)
    out = score_documents(read(spark, sf_dir, "documents"), held())
    return out.select("doc_id", held().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
