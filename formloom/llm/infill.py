"""Fill-in-the-middle documents, cut by a parallel scan of automata.

An automaton reads bytes: its states tell how many bytes of a code point are outstanding, another's how much of a mark has
been read. A chunk of bytes need not know the state that it is entered in: it emits the function from entry state to exit
state, and for each entry state the units that end within it. Functions compose associatively, so chunks of a text, and
blocks of a chunk, are read apart from each other. Composing them in order gives each chunk's entry state and the units
before it; a cut is then sought in the one chunk, and there in the one block, that holds its unit.

A function from four states to four is one byte, so composing many is looking up many bytes in a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import trim
from .common import partitions, read, written

#: What stands before each part, the shares of plain texts and of those that begin with the suffix.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT_BELOW, SUFFIX_FIRST_BELOW = 90, 20
#: Bytes of a chunk, and of a block within it.
CHUNK, BLOCK = 4 << 20, 256

STATES = 4
#: Classes of bytes: the letters of marks, other ASCII bytes, bytes within a code point, first bytes of two, three and four; and none.
OPEN, LETTER, CLOSE, OTHER, WITHIN, TWO, THREE, FOUR, NONE = range(9)


def byte_classes() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    out[[ord(c) for c in "<>"]] = OPEN, CLOSE
    out[[ord(m[1]) for m in (PREFIX, SUFFIX, MIDDLE)]] = LETTER
    out[0x80:0xC0], out[0xC0:0xE0], out[0xE0:0xF0], out[0xF0:] = WITHIN, TWO, THREE, FOUR
    return out


#: By class and state: the next state. Of units, the bytes outstanding; of marks, the bytes of one that are read, all three for good.
UNITS = np.array([[0, 0, 0, 0]] * 4 + [[0, 0, 1, 2], [1] * 4, [2] * 4, [3] * 4, [0, 1, 2, 3]], np.uint8)
#: By class and state: whether a unit ends.
ENDS = np.array([[1, 1, 1, 1]] * 4 + [[1, 1, 0, 0], [0] * 4, [0] * 4, [0] * 4, [0] * 4], np.uint8)
MARKS = np.array([[1, 1, 1, 3], [0, 2, 0, 3], [0, 0, 3, 3], *[[0, 0, 0, 3]] * 5, [0, 1, 2, 3]], np.uint8)
CLASSES = byte_classes()


def packed(functions: np.ndarray) -> np.ndarray:
    """Functions (their values on the last axis) as bytes."""
    return (functions << (2 * np.arange(STATES, dtype=np.uint8))).sum(axis=-1).astype(np.uint8)


def compositions() -> np.ndarray:
    """By two functions as bytes: the first, then the second."""
    every = (np.arange(256)[:, None] >> (2 * np.arange(STATES))) & 3
    return packed(every[np.arange(256)[None, :, None], every[:, None, :]].astype(np.uint8))


THEN = compositions()
UNITS_1, MARKS_1 = packed(UNITS), packed(MARKS)
#: The function that changes no state.
SAME = int(packed(np.arange(STATES, dtype=np.uint8)))


def at(functions, states):
    """Values of functions as bytes."""
    return (functions >> (2 * states).astype(np.uint8)) & 3


class Scan:
    """Chunks of bytes read by both automata, all their blocks at once.

    Of each chunk: `units` and `marks` (functions as bytes) and `counts` (units by entry state).
    """

    def __init__(self, chunks: list[bytes]) -> None:
        self.sizes = np.array([len(c) for c in chunks], np.int64)
        blocks = -(-self.sizes // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(blocks)])
        n = int(self.first[-1])
        self.kinds = kinds = np.full(n * BLOCK, NONE, np.uint8)
        for c, k in zip(chunks, (self.first[:-1] * BLOCK).tolist(), strict=True):
            kinds[k : k + len(c)] = CLASSES[np.frombuffer(c, np.uint8)]
        kinds = kinds.reshape(n, BLOCK)
        units, marks, counts = UNITS_1[kinds], MARKS_1[kinds], [ENDS[:, s][kinds].astype(np.int32) for s in range(STATES)]
        while units.shape[1] > 1:  # neighbours are composed until one function is left of each block
            one, two = units[:, ::2], units[:, 1::2]
            counts = [counts[s][:, ::2] + self.chosen([c[:, 1::2] for c in counts], at(one, np.uint8(s))) for s in range(STATES)]
            units, marks = THEN[one, two], THEN[marks[:, ::2], marks[:, 1::2]]
        self.block_units, block_marks, self.block_counts = units[:, 0], marks[:, 0], np.stack([c[:, 0] for c in counts], 1).astype(np.int64)
        # blocks are composed in rounds of twice the distance, each within its own chunk
        place = np.arange(n) - np.repeat(self.first[:-1], blocks)
        upto, upto_marks, step = self.block_units.copy(), block_marks.copy(), 1
        while step < (int(blocks.max()) if len(blocks) else 0):
            k = np.flatnonzero(place >= step)
            upto[k], upto_marks[k] = THEN[upto[k - step], upto[k]], THEN[upto_marks[k - step], upto_marks[k]]
            step *= 2
        #: The function from a chunk's entry to a block's entry.
        self.before = np.where(place > 0, np.concatenate([[SAME], upto[:-1]])[:n], SAME).astype(np.uint8)
        full = blocks > 0
        last = self.first[1:] - 1
        self.units, self.marks = np.full(len(chunks), SAME, np.uint8), np.full(len(chunks), SAME, np.uint8)
        self.units[full], self.marks[full] = upto[last[full]], upto_marks[last[full]]
        self.counts = np.zeros((len(chunks), STATES), np.int64)
        for s in range(STATES):
            self.counts[:, s] = self.cumulated(np.full(len(chunks), s))[self.first[1:]] - self.cumulated(np.full(len(chunks), s))[self.first[:-1]]

    @staticmethod
    def chosen(of: list[np.ndarray], states: np.ndarray) -> np.ndarray:
        out = of[0].copy()
        for s in range(1, STATES):
            np.copyto(out, of[s], where=states == s)
        return out

    def cumulated(self, states: np.ndarray) -> np.ndarray:
        """Units up to each block, over all chunks one after the other, each entered in its state."""
        entry = at(self.before, np.repeat(states, np.diff(self.first)).astype(np.uint8))
        return np.concatenate([[0], np.cumsum(self.block_counts[np.arange(len(entry)), entry])])

    def select(self, chunk: np.ndarray, states: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Of some chunks with their entry states: the bytes up to the end of the k-th unit that ends there. None for k = 0."""
        every = np.zeros(len(self.sizes), np.int64)
        every[chunk] = states
        upto = self.cumulated(every)
        want = upto[self.first[chunk]] + k
        block = np.maximum(np.searchsorted(upto, want) - 1, self.first[chunk])
        block = np.minimum(block, max(0, len(upto) - 2))
        out = np.where(k > 0, (block - self.first[chunk]) * BLOCK, 0)
        left, some = want - upto[block], np.flatnonzero(k > 0)
        if not len(some):
            return out
        left, kinds = left[some], self.kinds.reshape(-1, BLOCK)[block[some]]
        state, found = at(self.before[block[some]], np.asarray(states)[some].astype(np.uint8)), np.full(len(some), BLOCK)
        for j in range(BLOCK):
            left = left - ENDS[kinds[:, j], state]
            state = UNITS[kinds[:, j], state]
            found = np.where((left == 0) & (found == BLOCK), j + 1, found)
        out[some] += found
        return out


def draws(doc_id: Column) -> list[Column]:
    """h1 to h4 of an id; a null one draws as an empty text."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def cuts(n: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = h1 % (n + 1), h2 % (n + 1)
    return np.minimum(a, b), np.maximum(a, b)


WHOLE = "doc_id bigint, text string, h3 bigint, h4 bigint, n bigint, marked boolean, one bigint, two bigint, units_1 bigint, units_2 bigint"
WHOLE_ARROW = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("h3", pa.int64()), ("h4", pa.int64()), ("n", pa.int64()), ("marked", pa.bool_()), *[(c, pa.int64()) for c in ("one", "two", "units_1", "units_2")]])


def whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, text, h1, h2, h3, h4) of texts that are one chunk each: units, cuts in bytes and in units."""

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x.as_py() for x in b.column(1).cast(pa.binary())]
        h1, h2 = (b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
        scan = Scan(texts)
        every, start = np.arange(len(texts)), np.zeros(len(texts), np.int64)
        n = scan.counts[:, 0]
        one, two = cuts(n, h1, h2)
        marked = at(scan.marks, np.uint8(0)) == 3
        columns = [b.column(0), b.column(1), b.column(4), b.column(5), n, marked, scan.select(every, start, one), scan.select(every, start, two), one, two]
        return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, WHOLE_ARROW, strict=True)], schema=WHOLE_ARROW)

    for b in batches:
        sizes, k = np.cumsum([len(x.as_buffer()) for x in b.column(1)]), 0
        while k < b.num_rows:  # as many texts at once as make a chunk, and one at least
            upto = max(k + 1, int(np.searchsorted(sizes, (sizes[k - 1] if k else 0) + CHUNK, side="right")))
            yield cut(b.slice(k, upto - k))
            k = upto
    trim()


def chunk_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (key, chunk, bytes): each chunk's functions and counts."""
    for b in batches:
        for i in range(b.num_rows):
            scan = Scan([b.column(2)[i].as_py()])
            yield pa.RecordBatch.from_pylist([{"key": b.column(0)[i].as_py(), "chunk": b.column(1)[i].as_py(), "units": int(scan.units[0]), "marks": int(scan.marks[0]), "counts": scan.counts[0].tolist()}], schema=FUNCTIONS_ARROW)


FUNCTIONS = "key bigint, chunk int, units int, marks int, counts array<bigint>"
FUNCTIONS_ARROW = pa.schema([("key", pa.int64()), ("chunk", pa.int32()), ("units", pa.int32()), ("marks", pa.int32()), ("counts", pa.list_(pa.int64()))])
PLACED = "key bigint, n bigint, marked boolean, cut int, units bigint, chunk int, entry int, k bigint"
PLACED_ARROW = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("marked", pa.bool_()), ("cut", pa.int32()), ("units", pa.int64()), ("chunk", pa.int32()), ("entry", pa.int32()), ("k", pa.int64())])


def place_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (key, h1, h2, functions in order): the units, and for each cut its chunk, entry state and unit there."""
    for b in batches:
        rows = []
        for key, h1, h2, functions in zip(*[c.to_pylist() for c in b.columns], strict=True):
            state, mark, upto, entries = 0, 0, [0], []
            for f in functions:
                entries.append(state)
                upto.append(upto[-1] + f["counts"][state])
                state, mark = f["units"] >> 2 * state & 3, f["marks"] >> 2 * mark & 3
            one, two = cuts(np.array([upto[-1]]), np.array([h1]), np.array([h2]))
            for cut, units in enumerate((int(one[0]), int(two[0])), 1):
                chunk = max(0, int(np.searchsorted(upto, units)) - 1)
                rows.append({"key": key, "n": upto[-1], "marked": mark == 3, "cut": cut, "units": units, "chunk": chunk, "entry": entries[chunk], "k": units - upto[chunk]})
        yield pa.RecordBatch.from_pylist(rows, schema=PLACED_ARROW)


def select_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (key, cut, entry, k, bytes): the bytes of the chunk up to the cut."""
    for b in batches:
        for i in range(b.num_rows):
            key, cut, entry, k = (b.column(j)[i].as_py() for j in range(4))
            here = Scan([b.column(4)[i].as_py()]).select(np.array([0]), np.array([entry]), np.array([k]))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((key, pa.int64()), (cut, pa.int32()), (int(here[0]), pa.int64()))], names=["key", "cut", "here"])


def long_texts(rows: DataFrame, chunk: int) -> DataFrame:
    """As whole_texts(), of texts of more than a chunk: their chunks are read by different tasks.

    A text has at most 2^31 bytes, so the functions of one text are a short list.
    """
    n = partitions(rows.sparkSession)
    table = written(rows.withColumn("key", F.monotonically_increasing_id()), "infill-long")
    size = F.octet_length("text")
    pieces = F.transform(F.sequence(F.lit(0), ((size - 1) / chunk).cast("int")), lambda c: F.substring(F.col("text").cast("binary"), c * chunk + 1, F.lit(chunk)))
    chunks = written(table.select("key", F.posexplode(pieces).alias("chunk", "bytes")), "infill-chunks")
    functions = chunks.repartition(n, "key", "chunk").mapInArrow(chunk_functions, FUNCTIONS)
    of = functions.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("chunk", "units", "marks", "counts"))).alias("functions"))
    placed = written(table.select("key", "h1", "h2").join(of, "key").select("key", "h1", "h2", "functions").mapInArrow(place_cuts, PLACED), "infill-placed")
    found = placed.join(chunks, ["key", "chunk"]).select("key", "cut", "entry", "k", "bytes").mapInArrow(select_cuts, "key bigint, cut int, here bigint")
    cut = placed.join(found, ["key", "cut"]).withColumn("bytes", F.col("chunk").cast("long") * chunk + F.col("here"))
    told = cut.groupBy("key", "n", "marked").agg(*[F.max(F.when(F.col("cut") == k, F.col(c))).alias(f"{name}{k}") for c, name in (("bytes", "bytes_"), ("units", "units_")) for k in (1, 2)])
    return table.join(told, "key").select("doc_id", "text", "h3", "h4", "n", "marked", F.col("bytes_1").alias("one"), F.col("bytes_2").alias("two"), "units_1", "units_2")


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """doc_id, n (code points), form (plain, psm or spm), prefix_chars, middle_chars and output of every row.

    A null or empty text and one that holds a mark are plain, and their own output, as is a share of the others; the parts'
    lengths are then null. Cuts may coincide or stand at either end, so that parts are empty. A null id draws as an empty
    text; equal rows are cut alike; texts of any length are cut whole; other columns are not read; no rows give none.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = own.select("doc_id", "text", *draws(F.col("doc_id")))
    short = F.octet_length("text") <= chunk
    cut = rows.filter(short).mapInArrow(whole_texts, WHOLE)
    if not rows.filter(~short).isEmpty():
        cut = cut.unionByName(long_texts(rows.filter(~short), chunk))
    form = F.when((F.col("n") == 0) | F.col("marked") | (F.col("h3") % 100 >= CUT_BELOW), "plain").when(F.col("h4") % 100 < SUFFIX_FIRST_BELOW, "spm").otherwise("psm")
    data = F.col("text").cast("binary")
    prefix = F.substring(data, F.lit(1), F.col("one").cast("int"))
    middle = F.substring(data, F.col("one").cast("int") + 1, (F.col("two") - F.col("one")).cast("int"))
    suffix = F.substring(data, F.col("two").cast("int") + 1, F.lit((1 << 31) - 1))
    mark = {m: F.lit(m).cast("binary") for m in (PREFIX, SUFFIX, MIDDLE)}
    psm = F.concat(mark[PREFIX], prefix, mark[SUFFIX], suffix, mark[MIDDLE], middle)
    spm = F.concat(mark[SUFFIX], suffix, mark[PREFIX], prefix, mark[MIDDLE], middle)
    told = cut.withColumn("form", form)
    is_cut = F.col("form") != "plain"
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(data).cast("string")
    return told.select("doc_id", "n", "form", F.when(is_cut, F.col("units_1")).alias("prefix_chars"), F.when(is_cut, F.col("units_2") - F.col("units_1")).alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of: what is cut holds no mark, so each mark stands where its part begins."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fill_in_middle() over all documents, with digests of each output and of the text restored from it."""
    out = fill_in_middle(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))
