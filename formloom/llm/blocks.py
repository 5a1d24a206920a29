"""Blocks of documents as sequences over a table of their distinct words.

A block holds the documents of one input partition up to some bytes of text. Its distinct words, ranked by frequency, go
out in packed lists, one for each bucket of a hash of the word, so that whatever is worked out once for each distinct
word is worked out in the word's bucket and sent back to the blocks that use it. What travels follows the distinct
words of blocks, not the words; no table of all words is broadcast or collected.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

#: Bytes of text after which a block ends.
BLOCK_BYTES = 24 << 20
REQUEST = "kind int, block bigint, bucket int, blob binary, counts binary, places binary, ids array<bigint>, lens array<int>"


def trim() -> None:
    """Give freed memory back: a worker stays and its next task's needs differ."""
    gc.collect()  # what came with an earlier task refers to itself
    pa.set_memory_pool(pa.system_memory_pool())
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_ints(a: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by planes of bytes."""
    return pack(np.ascontiguousarray(np.asarray(a, "<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def pack_sorted(a: np.ndarray) -> bytes:
    return pack_ints(np.diff(np.asarray(a, np.int64), prepend=0))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(data).astype(np.int64))


def in_parts(b: pa.RecordBatch, most: int = 4 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of some of a batch's rows at a time."""
    ids, texts, size = [], [], 0
    for i in range(b.num_rows):
        ids.append(b.column(0)[i].as_py())
        texts.append((b.column(1)[i].as_py() or "").encode())
        size += len(texts[-1])
        if size >= most:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


class Block:
    """Documents gathered until the block is full."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.seqs: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.learns: list[bool] = []
        self.size = 0

    def add(self, doc_id: int | None, learns: bool, words: list[bytes], size: int) -> None:
        number = self.number
        try:
            seq = list(map(number.__getitem__, words))
        except KeyError:
            seq = [number.setdefault(w, len(number)) for w in words]
        self.seqs.append(np.array(seq, np.uint32))
        self.ids.append(doc_id)
        self.learns.append(learns)
        self.size += size

    def rows(self, block: int, buckets: int) -> Iterator[dict]:
        """The payload (kind 0) and a row of distinct words for each bucket of a hash (kind 1), the most frequent words first."""
        n = len(self.number)
        lens = np.array([len(s) for s in self.seqs], np.int64)
        seq = np.concatenate(self.seqs) if self.seqs else np.zeros(0, np.uint32)
        self.seqs = []
        order = np.argsort(-np.bincount(seq, minlength=n), kind="stable")
        rank = np.empty(n, np.uint32)
        rank[order] = np.arange(n, dtype=np.uint32)
        learned = np.bincount(seq[np.repeat(np.array(self.learns, bool), lens)], minlength=n)[order]
        yield {"kind": 0, "block": block, "bucket": None, "blob": pack_ints(rank[seq]), "counts": None, "places": None, "ids": self.ids, "lens": lens.tolist()}
        words = list(self.number)
        words = [words[i] for i in order.tolist()]
        bucket = np.fromiter((zlib.crc32(w) for w in words), np.uint32, n) % buckets
        by = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for b in range(buckets):
            if len(at := by[edges[b] : edges[b + 1]]):
                yield {"kind": 1, "block": block, "bucket": b, "blob": pack(b"\n".join([words[i] for i in at.tolist()])), "counts": pack_ints(learned[at]), "places": pack_sorted(at), "ids": None, "lens": None}


def batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


REQUEST_ARROW = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary()), ("counts", pa.binary()), ("places", pa.binary()), ("ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int32()))])


def blocks(buckets: int, lower: bool, block_bytes: int = BLOCK_BYTES):
    """For mapInArrow over (doc_id, text, learns): the rows of REQUEST.

    Words are runs of characters other than space and tab to carriage return. A block's number is its partition's and
    its own; a task that runs again reads the same rows and makes the same blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        trim()
        part, made, block = TaskContext.get().partitionId(), 0, Block()

        def out(block: Block) -> Iterator[pa.RecordBatch]:
            for r in block.rows((part << 20) + made, buckets):
                yield batch([r], REQUEST_ARROW)

        for b in batches:
            texts = b.column(1).cast(pa.binary() if b.column(1).type != pa.large_string() else pa.large_binary())
            for i, doc_id, learns in zip(range(b.num_rows), b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                text = texts[i].as_py() or b""
                block.add(doc_id, bool(learns), (text.lower() if lower else text).split(), len(text))
                if block.size >= block_bytes:
                    yield from out(block)
                    made, block = made + 1, Block()
                    trim()
        if block.ids:
            yield from out(block)
        del block
        trim()

    return run
