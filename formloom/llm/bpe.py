"""BPE by a table of distinct words: each is encoded once, and ids go back to where it stands."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import REQUEST, REQUEST_ARROW, batch, blocks, pack_ints, trim, unpack, unpack_ints, unpack_sorted
from .common import partitions, read

OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def tokenizer(path: str):
    """Truncation and padding unused; one for each process and path, kept with its library."""
    import tokenizers

    known = vars(tokenizers).setdefault("_formloom_known", {})
    if path not in known:
        known[path] = tokenizers.Tokenizer.from_file(path)
        known[path].no_truncation()
        known[path].no_padding()
    return known[path]


#: Bytes of distinct words that a process remembers, by what each takes as two objects of a dict; when it has more it starts anew.
KNOWN_BYTES, EACH = 160 << 20, 170
#: Marks of which the first with one token stands between words that are encoded as one text; parts that hold it are encoded word by word.
MARKS = "\u00A4\u00B1\u2020\u00A7\u2022\u00A9^~"
#: A capital with a character beyond ASCII behind it: a mark may compose with the small letter alone.
MARKED = re.compile(rb"[A-Z][\x80-\xff]")
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_FULL = np.zeros(256, bool)
_FULL[[44, 46]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[10, 32]] = True


class Encoder:
    """Ids (little-endian unsigned 32-bit) of texts, by their distinct words, as the whole texts would have them.

    No token of this kind of vocabulary crosses white space, so many words are encoded as one text with a mark between.
    """

    def __init__(self, path: str) -> None:
        self.tok = tokenizer(path)
        self.known: dict[bytes, bytes] = {}
        self.held = 0
        ids = lambda t: self.tok.encode(t, add_special_tokens=False).ids
        self.mark = next((m for m in MARKS if len(ids(m)) == 1), "")
        self.mark_id = ids(self.mark)[0] if self.mark else -1
        alone = [ids(t) for t in ("ab", ".", ",")]
        #: Whether capitals of A to Z are as good as small letters, and a point or comma after a letter is a token of its own.
        self.folds = ids("aB Z") == ids("ab z") and ids("ab. ab,") == alone[0] + alone[1] + alone[0] + alone[2]

    def words(self, text: bytes) -> list[bytes]:
        """Runs without white space; if the vocabulary folds, in small letters and without a point or comma after them.

        What looks like a special token stays as it is, and so do words with a capital that a mark may follow.
        """
        if self.folds and b"<|" not in text:
            marked = not text.isascii() and MARKED.search(text)
            text = b" ".join([w if MARKED.search(w) else w.lower() for w in text.split()]) if marked else text.lower()
            a = np.frombuffer(text, np.uint8)
            at = np.flatnonzero(_FULL[a[1:-1]])
            at = at[_LETTER[a[at]] & _BLANK[a[at + 2]]] + 1
            if len(at):
                text = np.insert(a, at, 32).tobytes()
        return text.split()

    def encode(self, words: list[bytes], at_once: int = 500) -> list[bytes]:
        """The ids of each word."""
        out, mark = [], self.mark.encode()
        parts = [words[k : k + at_once] for k in range(0, len(words), at_once)]
        join = f" {self.mark} ".encode().join
        for k in range(0, len(parts), 20):
            some = parts[k : k + 20]
            for part, e in zip(some, self.tok.encode_batch_fast([join(p).decode() for p in some], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4")
                cut = np.flatnonzero(ids == self.mark_id)
                if not mark or len(cut) != len(part) - 1 or any(mark in w for w in part):
                    out += [np.array(x.ids, "<u4").tobytes() for x in self.tok.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)]
                    continue
                raw, cut = ids.tobytes(), (4 * cut).tolist()
                out += [raw[a:b] for a, b in zip([0, *[c + 4 for c in cut]], [*cut, len(raw)], strict=True)]
        return out

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text; distinct words are remembered."""
        told = list(map(self.words, texts))
        if self.held > KNOWN_BYTES:
            self.known, self.held = {}, 0
        new = list(set().union(*told).difference(self.known))
        ids = self.encode(new)
        self.known.update(zip(new, ids, strict=True))
        self.held += EACH * len(new) + sum(map(len, new)) + sum(map(len, ids))
        return [b"".join(map(self.known.__getitem__, words)) for words in told]


def encoder(path: str) -> Encoder:
    """One for each process and path, kept with its library, so that the tasks of a process share what it remembers."""
    import tokenizers

    known = vars(tokenizers).setdefault("_formloom_encoders", {})
    if path not in known:
        known[path] = Encoder(path)
    return known[path]


def encode_buckets(path: str):
    """For mapInArrow over the rows of a bucket, sorted by bucket: word rows come back with ids in `blob`, their counts in `counts`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder, bucket, known = encoder(path), None, {}
        for b in batches:
            for i in range(b.num_rows):
                r = {n: b.column(k)[i] for k, n in enumerate(REQUEST_ARROW.names)}
                if r["kind"].as_py() == 0:
                    yield b.slice(i, 1)
                    continue
                if r["bucket"].as_py() != bucket:
                    trim()
                    bucket, known = r["bucket"].as_py(), {}
                words = unpack(r["blob"].as_py()).split(b"\n")
                new = [w for w in words if w not in known]
                known.update(zip(new, coder.encode(new), strict=True))
                ids = [known[w] for w in words]
                lens = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                yield batch([{n: r[n].as_py() for n in ("kind", "block", "bucket", "places")} | {"blob": pack_ints(np.frombuffer(b"".join(ids), "<u4")), "counts": pack_ints(lens), "ids": None, "lens": None}], REQUEST_ARROW)

    return run


def join_back(path: str):
    """For mapInArrow over the rows of blocks, sorted by block and kind: each document's ids and decoded text.

    Decoding joins each id with its piece; a vocabulary's pieces are as many as its ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        piece: dict[int, bytes] = {}
        if tok.decoder is not None:
            raise ValueError("only vocabularies whose pieces are joined by spaces are decoded here")

        def finish(payload, places: list, ids: list, lens: list) -> Iterator[pa.RecordBatch]:
            seq = unpack_ints(payload["blob"]).astype(np.int64)
            n = sum(len(p) for p in places)
            own, text = [b""] * n, [b""] * n
            for p, x, m in zip(places, ids, lens, strict=True):
                for i in np.unique(x).tolist():
                    if i not in piece:
                        piece[i] = tok.id_to_token(i).encode()
                pieces, raw, at, a = list(map(piece.__getitem__, x.tolist())), np.asarray(x, "<u4").tobytes(), np.cumsum(m).tolist(), 0
                for where, e in zip(p.tolist(), at, strict=True):
                    own[where], text[where] = raw[4 * a : 4 * e], b" ".join(pieces[a:e])
                    a = e
            empty, at, rows, size = {i for i, t in enumerate(own) if not t}, 0, [], 0
            for doc_id, k in zip(payload["ids"], payload["lens"], strict=True):
                s = seq[at : at + k].tolist()
                at += k
                told = [i for i in s if i not in empty] if empty else s
                rows.append({"doc_id": doc_id, "ids": b"".join(map(own.__getitem__, s)), "decoded": b" ".join(map(text.__getitem__, told))})
                size += len(rows[-1]["ids"]) + len(rows[-1]["decoded"])
                if size > 4 << 20:
                    yield batch(rows, OUT)
                    rows, size = [], 0
            if rows:
                yield batch(rows, OUT)

        payload, block, places, ids, lens = None, None, [], [], []
        for b in batches:
            for i in range(b.num_rows):
                r = {n: b.column(k)[i].as_py() for k, n in enumerate(REQUEST_ARROW.names)}
                if r["block"] != block:
                    if payload:
                        yield from finish(payload, places, ids, lens)
                    payload, block, places, ids, lens = None, r["block"], [], [], []
                    trim()
                if r["kind"] == 0:
                    payload = r
                else:
                    places.append(unpack_sorted(r["places"]))
                    ids.append(unpack_ints(r["blob"]))
                    lens.append(unpack_ints(r["counts"]).astype(np.int64))
        if payload:
            yield from finish(payload, places, ids, lens)
        del payload, places, ids, lens
        trim()

    return run


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    for b in batches:
        rows = [{"doc_id": d.as_py(), "n_tokens": len(i.as_buffer()) // 4, "ids_sha256": hashlib.sha256(i.as_buffer()).hexdigest(), "decoded_sha256": hashlib.sha256(t.as_buffer()).hexdigest()} for d, i, t in zip(b.column(0), b.column(1), b.column(2), strict=True)]
        yield batch(rows, schema)


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) and decoded (UTF-8) of every row.

    Null and empty texts have no ids and decode to nothing; null ids are kept; equal rows come back as often as they came
    in; other columns are not read; no rows give none. A task holds one block: a text of any length and the others up to
    the block's bytes.
    """
    n = partitions(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.lit(True).alias("learns"))
    asked = rows.mapInArrow(blocks(n, lower=False), REQUEST)
    to_bucket = F.coalesce(F.col("bucket"), F.pmod(F.hash("block"), F.lit(n)))
    told = asked.repartition(n, to_bucket).sortWithinPartitions("kind", "bucket").mapInArrow(encode_buckets(path), REQUEST)
    return told.repartition(n, "block").sortWithinPartitions("block", "kind").mapInArrow(join_back(path), "doc_id bigint, ids binary, decoded binary")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.mapInArrow(digests, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
