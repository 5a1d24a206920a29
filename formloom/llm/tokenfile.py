"""Token-id files: independent zstandard frames, a document index and a trailing seek table with a checksum of each frame.

A file is a sequence of frames that each hold the ids of whole documents (little-endian unsigned 32-bit), a skippable frame
with the index of its documents, and, as in the public seekable format of zstandard, a skippable frame with the table of
compressed sizes, sizes and checksums. Any zstandard reader can read the ids; a reader of single documents fetches the
table, the index, and the frames that hold them.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import in_parts, trim
from .bpe import encoder
from .common import partitions, read, shared_dir

#: Fixed values of the seekable format.
SKIPPABLE_INDEX, SKIPPABLE_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUMS = 0x80
#: Ids after which a frame ends.
FRAME_IDS = 1 << 16
END_ID = 1
MANIFEST = pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())])
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def filesystem(uri: str):
    """The file system of a folder, and the folder's path in it."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + os.path.abspath(uri.removeprefix("file:"))
    return fs.FileSystem.from_uri(uri)


class Writer:
    """Writes one file; documents come in their order."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS) -> None:
        self.sink, self.frame_ids = sink, frame_ids
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.lens: list[int] = []
        self.open: list[bytes] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.open and self.size + len(ids) > 4 * self.frame_ids:
            self.end_frame()
        self.open.append(ids)
        self.size += len(ids)
        self.ids.append(doc_id)
        self.lens.append(len(ids) // 4)

    def end_frame(self) -> None:
        data = b"".join(self.open)
        packed = zstandard.ZstdCompressor(level=1, write_checksum=True).compress(data)
        self.sink.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.open, self.size = [], 0

    def close(self) -> None:
        if self.open:
            self.end_frame()
        index = np.array([i is not None for i in self.ids], "<u1").tobytes() + np.array([i or 0 for i in self.ids], "<i8").tobytes() + np.array(self.lens, "<u8").tobytes()
        index = struct.pack("<Q", len(self.ids)) + zstandard.ZstdCompressor(write_checksum=True).compress(index)
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        self.frames.append((8 + len(index), 0, 0))
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), HAS_CHECKSUMS, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE_TABLE, len(table)) + table)


class Reader:
    """Reads single documents of a file, by their place in it, from a seekable source."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        count, _, magic = struct.unpack("<IBI", self.at(size - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        rows = np.frombuffer(self.at(size - 9 - 12 * count, 12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(rows[:, 0])])
        self.frames, index = rows[:-1], self.at(int(self.places[-2]) + 8, int(rows[-1, 0]) - 8)
        n = struct.unpack("<Q", index[:8])[0]
        raw = zstandard.ZstdDecompressor().decompress(index[8:]) if n else b""
        has, ids = np.frombuffer(raw, "<u1", n), np.frombuffer(raw, "<i8", n, n)
        self.ids = [i if h else None for h, i in zip(has.tolist(), ids.tolist(), strict=True)]
        self.lens = np.frombuffer(raw, "<u8", n, 9 * n).astype(np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.opens = np.cumsum(self.frames[:, 1]) - self.frames[:, 1]
        self.held: tuple[int, bytes] = (-1, b"")

    def at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def frame(self, k: int) -> bytes:
        """A frame's ids; the last one read is kept."""
        if self.held[0] != k:
            data = zstandard.ZstdDecompressor().decompress(self.at(int(self.places[k]), int(self.frames[k, 0])), max_output_size=int(self.frames[k, 1]))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.frames[k, 2]:
                raise ValueError(f"frame {k} does not have its checksum")
            self.held = (k, data)
        return self.held[1]

    def document(self, place: int) -> bytes:
        start, size = 4 * int(self.starts[place]), 4 * int(self.lens[place])
        if not size:
            return b""
        k = int(np.searchsorted(self.opens, start, side="right")) - 1
        return self.frame(k)[start - int(self.opens[k]) :][:size]


def write_parts(path: str, folder: str, end: int | None):
    """For mapInArrow over (doc_id, text) in order: encodes, writes the partition's file, and tells of it.

    The file gets its name when it is whole, so a task that runs again, or twice at once, leaves one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        trim()
        coder = encoder(path)
        last = np.array([] if end is None else [end], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        fs, top = filesystem(folder)
        fs.create_dir(top, recursive=True)
        name, own = f"{top}/part-{part:06d}.zst", f"{top}/.part-{part:06d}-{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as sink:
            out = Writer(sink)
            for b in batches:
                for ids, texts in in_parts(b, 2 << 20):
                    for doc_id, own_ids in zip(ids, coder.texts(texts), strict=True):
                        out.add(doc_id, own_ids + last)
            out.close()
        fs.move(own, name)
        yield pa.RecordBatch.from_pylist([{"part": part, "path": f"part-{part:06d}.zst", "documents": len(out.ids), "tokens": sum(out.lens)}], schema=MANIFEST)

    return run


def write_tokens(docs: DataFrame, path: str, folder: str, end: int | None = END_ID, doc_id: str = "doc_id", text: str = "text") -> list[dict]:
    """Writes all documents' ids in ascending order of doc_id (null first; ties by text), and returns the manifest by part.

    Null and empty texts have only the end id, if there is one; equal rows are written each; other columns are not read;
    a text of any length is one document, in a frame of its own if it is longer than a frame. No rows give empty files.
    """
    n = partitions(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    told = rows.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    parts = told.mapInArrow(write_parts(path, folder, end), "part int, path string, documents bigint, tokens bigint").collect()
    return [r.asDict() for r in sorted(parts, key=lambda r: r["part"])]


def read_parts(folder: str):
    """For mapInArrow over (path, base): the documents of each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = filesystem(folder)
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with fs.open_input_file(f"{top}/{path}") as source:
                    file, first, own, size = Reader(source), 0, [], 0
                    for k in range(len(file.ids)):
                        own.append(file.document(k))
                        size += len(own[-1])
                        if size > 4 << 20 or k + 1 == len(file.ids):
                            told = slice(first, k + 1)
                            yield pa.RecordBatch.from_arrays([pa.array(file.ids[told], pa.int64()), pa.array(base + file.starts[told]), pa.array(file.lens[told]), pa.array(own, pa.binary())], schema=DOCUMENTS)
                            first, own, size = k + 1, [], 0

    return run


def read_tokens(spark: SparkSession, manifest: list[dict], folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids of all documents in the files."""
    bases = np.cumsum([0, *[m["tokens"] for m in manifest]]).tolist()
    parts = [(m["path"], b) for m, b in zip(manifest, bases[:-1], strict=True) if m["documents"]]
    files = spark.createDataFrame(parts, "path string, base bigint")
    return files.repartition(max(1, len(parts)), "path").mapInArrow(read_parts(folder), "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([zlib.crc32(x.as_buffer()) for x in b.column(3)], pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "tokens")
    manifest = write_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return read_tokens(spark, manifest, folder).mapInArrow(checksums, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
