"""Near duplicates by circulant MinHash, exact Jaccard verification and connected components.

Texts with equal sets of shingles are one class from the start. A class's signature comes from two permutations: the
first spreads the shingles, the second, shifted by 0, 1, 2, ... places, gives one coordinate for each shift. Classes meet
in buckets of bands. In a bucket, members are first held against one hub, the class that meets most others, then against
the foremost of those that are still apart from it; so a group of copies becomes one component without its pairs. Classes
of buckets that are then still in several components are joined exactly: linked sets share one of their rarest shingles,
in places that leave room for enough in common, so only such pairs of different components are held against each other.

Classes have dense long numbers, so that counts, least labels and joins hash and sort fixed-width keys. A bucket's hub is
sent to as many parts of the bucket as its size asks for, and a shingle's foremost component only meets the others.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .blocks import in_parts, trim
from .common import discard, read, written, written_some

SHINGLE = 4
#: A pair with a similarity of 0.8 shares no band with a probability of (1 - 0.8**4)**24 = 3e-6.
BANDS, ROWS = 24, 4
#: Ids of candidate classes above which texts are fetched by a shuffle.
BROADCAST_IDS = 1_000_000
HUB_ROUNDS = 2
#: Members of a bucket for each copy of its hub.
PART = 2000
BLANK = re.compile(rb"[\x20\x09-\x0D]")
SKETCH = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("text_hash_2", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64()))])
SETS = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, given by two odd factors."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(a)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(b)
    return x ^ (x >> np.uint32(16))


def signatures(values: np.ndarray, starts: np.ndarray, at_once: int = 1 << 16) -> np.ndarray:
    """Of each set (values from its start to the next one's; none is empty): the least places of the shifted permutation."""
    out = np.full((len(starts), BANDS * ROWS), 0xFFFFFFFF, np.uint32)
    spread = permute(values.astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    for a in range(0, len(values), at_once):
        part = spread[a : a + at_once]
        first = max(0, int(np.searchsorted(starts, a, side="right")) - 1)
        last = int(np.searchsorted(starts, a + len(part)))
        at = np.maximum(starts[first:last] - a, 0)
        for k in range(BANDS * ROWS):
            np.minimum(out[first:last, k], np.minimum.reduceat(permute(part + np.uint32(k), 0x9E3779B1, 0x7FEB352D), at), out=out[first:last, k])
    return out


def bands_of(signature: np.ndarray) -> np.ndarray:
    s = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), s.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + s[:, :, k])
    return key.view(np.int64)


def pieces(text: bytes, size: int = 1 << 17) -> Iterator[bytes]:
    """The text in pieces of about that size, cut at white space."""
    a = 0
    while len(text) - a > size and (m := BLANK.search(text, a + size)):
        yield text[a : m.start()]
        a = m.start()
    yield text[a:]


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; of all its words, if they are fewer."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    ids = [np.concatenate([np.fromiter(map(number.__getitem__, p.lower().split()), np.int32) for p in pieces(t)]) for t in texts]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    number.default_factory = None  # else it refers to itself and waits for the collector
    out = []
    for own in ids:
        h = hashes[own]
        size = min(SHINGLE, len(h))
        n = len(h) - size + 1 if size else 0
        x = np.full(n, size, np.uint64)
        for k in range(size):
            x *= np.uint64(0x9E3779B97F4A7C15)
            x += h[k : k + n]
            x ^= x >> np.uint64(32)
        out.append(np.unique(mix(x)))
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    return struct.unpack("<qq", hashlib.blake2b(s.tobytes(), digest_size=16).digest())


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, text, and two hashes of it): the digest of each text's set, its size and its bands."""
    trim()
    for b in batches:
        at = 0
        for ids, texts in in_parts(b):
            sets = shingle_sets(texts)
            full = [s for s in sets if len(s)]
            bands = iter(bands_of(signatures(np.concatenate(full), np.cumsum([0, *map(len, full[:-1])]))).tolist() if full else [])
            digests = list(map(digest, sets))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), b.column(2).slice(at, len(ids)), b.column(3).slice(at, len(ids)), pa.array(map(len, sets), pa.int64()), pa.array([d for d, _ in digests], pa.int64()),
                pa.array([d for _, d in digests], pa.int64()), pa.array([next(bands) if len(s) else [] for s in sets], pa.list_(pa.int64())),
            ], schema=SKETCH)
            at += len(ids)
    trim()


def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trim()
    for b in batches:
        for _, texts in in_parts(b, 1 << 20):
            sets = shingle_sets(texts)
            digests = list(map(digest, sets))
            yield pa.RecordBatch.from_arrays([
                pa.array([d for d, _ in digests], pa.int64()), pa.array([d for _, d in digests], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ], schema=SETS)
    trim()


def components(edges: DataFrame) -> DataFrame:
    """(v, label) of every end of the edges (a, b): the least vertex that it reaches.

    Each round takes the least label among neighbours, then the label's own label; both ways of an edge count. An edge
    within one label is left out of later rounds' first labels.
    """
    both = written(edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select("b", "a")).distinct(), "neardup-edges")
    labels = both.groupBy("v").agg(F.least("v", F.min("w")).alias("label"))
    last = None
    while True:
        if last is None:
            labels = last = written(labels, "neardup-labels")
        near = both.join(labels.withColumnsRenamed({"v": "w", "label": "other"}), "w").groupBy("v").agg(F.min("other").alias("near"))
        took = labels.join(near, "v").select("v", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        jump = labels.select(F.col("v").alias("to"), F.col("label").alias("further"))
        moves = F.count_if(F.col("label") != F.col("was")).alias("moves")
        seen = Observation()
        moved = written(took.join(jump, "to", "left").select("v", F.least("to", "further").alias("label"), "was").observe(seen, moves), "neardup-labels")
        discard(last)
        labels, last = moved.select("v", "label"), moved
        if not seen.get["moves"]:
            discard(both)
            labels._fl_folder = moved._fl_folder
            return labels


def prefix_pairs(sets: DataFrame, low: int, high: int) -> DataFrame:
    """(c, other) of sets (c, label, shingles) with different labels that may be linked; no linked pair of different labels is left out.

    Sets of n and m linked shingles have k = low (n + m) / (low + high) or more in common. All sets have their shingles
    in one order: those of a single label, which no pair of two labels shares, then the rarest first. Their first common
    one stands where n - i and m - j are still at least k. A shingle's most frequent label is held against the others
    only, so copies of one component that share it do not meet.
    """
    tokens = sets.select("c", "label", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    across = tokens.groupBy("s").agg(F.count("*").alias("f"), F.min("label").alias("_l"), F.max("label").alias("_m")).filter("_l < _m").select("s", "f")
    ranked = tokens.join(across, "s").groupBy("c", "label", "n").agg(F.array_sort(F.collect_list(F.struct("f", "s"))).alias("t"))
    alone = F.col("n") - F.size("t")
    most = (F.col("n") - F.ceil(F.lit(low) * F.col("n") / high) + 1 - alone).cast("int")
    within = ranked.filter(most > 0).select("c", "label", "n", alone.alias("alone"), F.posexplode(F.slice("t", F.lit(1), most)).alias("i", "t"))
    prefix = written(within.select("c", "label", "n", (F.col("i") + F.col("alone")).alias("i"), F.col("t.s").alias("s")), "neardup-prefix")
    by_label = prefix.groupBy("s", "label").agg(F.count("*").alias("f"))
    first = by_label.groupBy("s").agg(F.max_by("label", "f").alias("first"), F.count("*").alias("labels")).filter("labels > 1").select("s", "first")
    met = prefix.join(first, "s")
    others = met.filter("label <> first").drop("first")
    every = met.select("s", *[F.col(c).alias(f"_{c}") for c in ("c", "label", "n", "i")])
    room = (low + high) * F.least(F.col("n") - F.col("i"), F.col("_n") - F.col("_i")) >= low * (F.col("n") + F.col("_n"))
    return others.join(every, "s").filter((F.col("label") != F.col("_label")) & room).select("c", F.col("_c").alias("other"))


def verified(pairs: DataFrame, sets: DataFrame, low: int, high: int) -> DataFrame:
    """The pairs (a, b, part) whose full sets are linked, as (a, b). b's set goes to each of its parts."""
    whole = F.col("part") == 0
    parts = pairs.filter(~whole).select(F.col("b").alias("c"), "part").distinct()
    of_b = sets.select("c", F.lit(0).cast("long").alias("part"), "shingles").union(sets.join(parts, "c").select("c", "part", "shingles"))
    held = pairs.join(sets.select(F.col("c").alias("a"), F.col("shingles").alias("sa")), "a").join(of_b.withColumnsRenamed({"c": "b", "shingles": "sb"}), ["b", "part"])
    both = F.size(F.array_intersect("sa", "sb"))
    return held.select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb") - both).alias("all")).filter(high * F.col("both") >= low * F.col("all")).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash and text_hash_2 (of the text) and component (a number; null where alone) of every row.

    Null and empty texts and those without a word have no shingle and are alone. Rows with equal sets are linked, repeated
    rows and rows with one id among them. A null id is never a component's; a component of null ids has a null one, and
    keeps its rows. Ties go to the least id. Other columns of docs are not read. Texts of any length are read whole. No
    rows give none.
    """
    spark = docs.sparkSession
    low, high = similarity
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketches = rows.select("*", F.xxhash64("text").alias("text_hash"), F.xxhash64(F.lit(1), F.coalesce("text", F.lit(""))).alias("text_hash_2"))
    sketches = written(sketches.mapInArrow(sketch, "doc_id bigint, text_hash bigint, text_hash_2 bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>"), "neardup-sketches")
    full = sketches.filter("n > 0")
    classes = full.groupBy("d1", "d2").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = written(classes.withColumn("c", F.monotonically_increasing_id()), "neardup-classes")
    members = classes.select("c", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    met = written(members.join(shared, "bucket"), "neardup-buckets")

    candidates, count = written_some(met.groupBy("c").agg(F.sum(F.col("size") - 1).alias("degree")).join(classes.select("c", "d1", "d2", "n", "least"), "c"), "neardup-candidates")
    label = candidates.select("c", F.col("c").alias("label"))
    if count:
        small = (lambda df: F.broadcast(df)) if count <= BROADCAST_IDS else (lambda df: df)
        wanted = small(candidates.select(F.col("least").alias("doc_id")).distinct())
        texts = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")
        sets = texts.mapInArrow(sets_of, "d1 bigint, d2 bigint, shingles array<bigint>")
        # rows of one id may have several sets, and equal rows one
        sets = written(sets.join(small(candidates.select("c", "d1", "d2")), ["d1", "d2"]).select("c", "shingles").dropDuplicates(["c"]), "neardup-sets")
        tested = []
        for turn in range(HUB_ROUNDS + 1):
            part = F.when(F.col("size") > PART, 1 + F.pmod(F.hash("c"), F.ceil(F.col("size") / PART))).otherwise(0).cast("long").alias("part")
            now = met.join(label.join(candidates.select("c", "degree", "n"), "c"), "c")
            first = [F.max_by(c, "degree").alias(f"h_{c}") for c in ("c", "label", "n")]
            split = now.groupBy("bucket").agg(F.min("label").alias("_l"), F.max("label").alias("_m"), *first, F.max("size").alias("h_size")).filter("_l < _m").drop("_l", "_m")
            if turn == HUB_ROUNDS:
                apart = now.join(split.select("bucket"), "bucket", "left_semi").select("c", "label").distinct()
                pairs = prefix_pairs(sets.join(apart, "c"), low, high).withColumn("part", F.lit(0).cast("long"))
            else:
                if turn:  # the foremost of those that are apart from the first hub
                    split = now.join(split.select("bucket", F.col("h_label").alias("not")), "bucket").filter(F.col("label") != F.col("not"))
                    split = split.groupBy("bucket").agg(*first, F.max("size").alias("h_size"))
                hubs = split.withColumn("part", F.explode(F.when(F.col("h_size") > PART, F.sequence(F.lit(1).cast("long"), F.ceil(F.col("h_size") / PART))).otherwise(F.array(F.lit(0).cast("long")))))
                pairs = now.select("bucket", part, "c", "label", "n").join(hubs, ["bucket", "part"]).filter((F.col("label") != F.col("h_label")) & (high * F.least("n", "h_n") >= low * F.greatest("n", "h_n")))
                pairs = pairs.select("c", F.col("h_c").alias("other"), "part")
            # a has few pairs; b, a hub, may have many, dealt to parts
            pairs = pairs.select(F.col("c").alias("a"), F.col("other").alias("b"), "part").distinct()
            for t in tested:
                pairs = pairs.join(t, ["a", "b"], "left_anti")
            pairs, found = written_some(pairs, "neardup-pairs")
            if not found:
                continue
            tested.append(pairs.select("a", "b"))
            links, found = written_some(verified(pairs, sets, low, high), "neardup-links")
            if not found:
                continue
            at = lambda c: label.select(F.col("c").alias(c), F.col("label").alias(f"l{c}"))  # noqa: B023, E731
            merged = components(links.join(at("a"), "a").join(at("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).filter("a <> b"))
            label = written(label.join(merged.select(F.col("v").alias("label"), F.col("label").alias("new")), "label", "left").select("c", F.coalesce("new", "label").alias("label")), "neardup-labels")
            discard(links, merged)
        discard(sets)
    discard(met)

    named = classes.select("c", "d1", "d2", "least").join(label, "c", "left").withColumn("component", F.coalesce("label", "c"))
    of = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("d1", "d2", "component", "component_id")
    out = full.join(of, ["d1", "d2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash", "text_hash_2", "component")
    out = out.union(sketches.filter("n = 0").select("doc_id", "n", "doc_id", "text_hash", "text_hash_2", F.lit(None).cast("long")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash", "text_hash_2", "component")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
