"""SentencePiece by merges: an agenda of adjacent pairs, the best score first, checked against the library in Arrow batches.

Every text is normalised as the model says and cut between characters that stand side by side in no piece, since no merge
can cross such a place. What lies between is merged by an agenda: a heap of adjacent pairs that are a piece, by score and
then by place, in which a pair that has changed since it was entered is passed over. Stretches that come again are
remembered up to a bound on bytes. The library then encodes and decodes the same batch, and each row says if they agree.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import trim
from .common import read

#: The mark that stands for a space.
SPACE = "▁"
#: Bytes of distinct stretches that a process remembers, by what each takes as two objects of a dict; when it has more it starts anew.
KNOWN_BYTES, EACH = 160 << 20, 190
#: Characters that are cut at once, and a stretch that the library encodes at once where a text has lone spaces to cut it at.
CUT_AT_ONCE, CHECK_AT_ONCE = 1 << 20, 1 << 20
#: Bytes of results that are returned at once.
RETURN_AT_ONCE = 4 << 20
OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary()), ("agrees", pa.bool_())])
ENCODED = "doc_id bigint, ids binary, decoded binary, agrees boolean"


class Pieces:
    """A vocabulary of the merge type: pieces with scores, and a byte piece for each byte of what is no piece."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = len(sp)
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        names = [sp.id_to_piece(i) for i in range(n)]
        if any(sp.is_unused(i) for i in range(n)) or len(sp.encode("\x00a", out_type=int)) < 3:
            raise ValueError("only vocabularies of the merge type with byte pieces and without unused pieces are encoded here")
        self.id = {p: i for i, p in enumerate(names) if not special[i]}
        self.cost = {p: -sp.get_score(i) for p, i in self.id.items()}
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(names) if sp.is_byte(i)}
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.text = [b"" if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        for b, i in self.byte.items():
            self.text[i] = bytes([b])
        #: Whether the normaliser puts a space before a text, which decoding takes away again.
        self.opens = sp.normalize("a") == SPACE + "a"
        #: Whether texts may be checked in stretches: a space only ever opens a piece, so what a lone space parts is encoded apart.
        self.parts = self.opens and sp.normalize("a  b ") == f"{SPACE}a{SPACE}{SPACE}b{SPACE}" and not any(SPACE in p.lstrip(SPACE) for p in self.id)
        # classes of the characters of longer pieces, 0 for all others, and the pairs of classes that stand side by side in a piece
        pairs = {p[k : k + 2] for p in self.id for k in range(len(p) - 1)}
        chars = sorted(set("".join(pairs)))
        self.kind = np.zeros(0x110000, np.uint16)
        self.kind[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.side = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in pairs:
            self.side[self.kind[ord(a)], self.kind[ord(b)]] = True
        self.known: dict[str, bytes] = {}
        self.held = 0

    def stretches(self, text: str) -> list[str]:
        """The text cut at every place that no piece can cross."""
        out, rest = [], ""
        for k in range(0, len(text), CUT_AT_ONCE):
            part = rest + text[k : k + CUT_AT_ONCE]
            kind = self.kind[np.frombuffer(part.encode("utf-32-le"), "<u4")]
            cut = (np.flatnonzero(~self.side[kind[:-1], kind[1:]]) + 1).tolist()
            out += [part[a:b] for a, b in zip([0, *cut], cut, strict=False)]
            rest = part[cut[-1] if cut else 0 :]
        return [*out, rest] if rest else out

    def merged(self, text: str) -> list[int]:
        """The ids of one stretch, by the agenda."""
        cost, symbol, n = self.cost, list(text), len(text)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [(cost[p], k, p) for k in range(n - 1) if (p := text[k : k + 2]) in cost]
        heapq.heapify(agenda)
        while agenda:
            _, a, piece = heapq.heappop(agenda)
            if not symbol[a] or (b := right[a]) < 0 or symbol[a] + symbol[b] != piece:
                continue  # entered before one of its sides was merged
            symbol[a], symbol[b] = piece, ""
            right[a] = c = right[b]
            if c >= 0:
                left[c] = a
                if (p := piece + symbol[c]) in cost:
                    heapq.heappush(agenda, (cost[p], a, p))
            if (c := left[a]) >= 0 and (p := symbol[c] + piece) in cost:
                heapq.heappush(agenda, (cost[p], c, p))
        out = []
        for s in filter(None, symbol):
            if (i := self.id.get(s)) is not None:
                out.append(i)
            else:
                out += [self.byte[b] for b in s.encode()]
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text (little-endian unsigned 32-bit), between the begin and end ids."""
        if self.held > KNOWN_BYTES:
            self.known, self.held = {}, 0
        told = self.stretches(self.library.normalize(text))
        known = self.known
        for s in set(told).difference(known):
            known[s] = ids = np.array(self.merged(s), "<u4").tobytes()
            self.held += EACH + 4 * len(s) + len(ids)
        return b"".join([np.uint32(self.bos).tobytes(), *map(known.__getitem__, told), np.uint32(self.eos).tobytes()])

    def decode(self, ids: bytes) -> bytes:
        """The text of ids, UTF-8: each id's piece, and without the space that opens a normalised text."""
        out = b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return out[1:] if self.opens and out.startswith(b" ") else out

    def by_library(self, text: str) -> tuple[bytes, bytes]:
        """What the library makes of the text: ids between the begin and end ids, and their text."""
        ids, at = [], 0
        while self.parts and len(text) - at > CHECK_AT_ONCE:
            k = at + CHECK_AT_ONCE
            while (k := text.find(" ", k)) >= 0 and (text[k - 1] in (" ", SPACE) or text[k + 1 : k + 2] in ("", " ", SPACE)):
                k += 1
            if k < 0:
                break
            ids.append(np.array(self.library.encode(text[at:k]), "<u4"))
            at = k + 1
        ids.append(np.array(self.library.encode(text[at:]), "<u4"))
        every = np.concatenate([np.array([self.bos], "<u4"), *ids, np.array([self.eos], "<u4")])
        return every.tobytes(), self.library.decode(every.tolist()).encode()


def pieces(path: str) -> Pieces:
    """One for each process and path, kept with its library, so that the tasks of a process share what it remembers."""
    import sentencepiece

    known = vars(sentencepiece).setdefault("_formloom_pieces", {})
    if path not in known:
        known[path] = Pieces(path)
    return known[path]


def encode_batches(path: str, check: bool):
    """For mapInArrow over (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows, size = pieces(path), [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), OUT, strict=True)], schema=OUT)

        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1), strict=True):
                text = text.as_py() or ""
                ids = own.encode(text)
                row, agrees = (ids, own.decode(ids)), None
                if check and not (agrees := row == (library := own.by_library(text))):
                    row = library
                rows.append((doc_id.as_py(), *row, agrees))
                size += len(row[0]) + len(row[1])
                if size >= RETURN_AT_ONCE:
                    yield out()
                    rows, size = [], 0
        if rows:
            yield out()
        rows = []
        trim()

    return run


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", check: bool = True) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit, begin and end ids included), decoded (UTF-8) and agrees of every row.

    With `check` the library encodes and decodes each text too; a row on which it differs says so in `agrees` and holds the
    library's result. Without, `agrees` is null. Null and empty texts have the begin and end ids alone and decode to
    nothing; null ids are kept; equal rows come back as often as they came in; among pairs of one score the leftmost is
    merged first; other columns are not read; no rows give none. A task holds one text of any length and results of 4 MB.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(encode_batches(path, check), ENCODED)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of every document's ids and decoded text, as encode_decode() has them, and whether the library agrees."""
    out = encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    count = (F.octet_length("ids") / 4).cast("long")
    return out.select("doc_id", count.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")
