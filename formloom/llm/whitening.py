"""Whitening of embeddings by a compensated covariance.

Every number is held as an unevaluated sum of two doubles. Sums and products go through error-free transformations (the
rounding error of each operation is itself a double), so that outer products of centred vectors lose nothing of note
however many there are. Tasks send the high and low parts of their sums; those are merged in the same way, in two steps.
The covariance is small (dimensions squared). Its eigenvectors come from LAPACK's divide-and-conquer solver: the matrix
is brought to tridiagonal form, and halves of it are solved and joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, read

#: An entry c becomes floor(64 * c) + 1000000, and so many components are told.
STEPS, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Entries of this size or more are no whole numbers of steps any more; their vectors are left out like those that are not finite.
TOO_LARGE = float(1 << 46)
#: Rows whose products are summed at once, and the parts that sums of tasks are merged in before the last step.
AT_ONCE, PARTS = 512, 1024
SUMS = "part int, place int, high binary, low binary"
SUMS_ARROW = pa.schema([("part", pa.int32()), ("place", pa.int32()), ("high", pa.binary()), ("low", pa.binary())])


def two_sum(a, b):
    """a + b and its rounding error."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def fast_two_sum(a, b):
    """As two_sum(), where a is not the smaller one."""
    s = a + b
    return s, b - (s - a)


def split(a):
    """a as a sum of two doubles of 26 bits."""
    t = 134217729.0 * a
    high = t - (t - a)
    return high, a - high


def add(ah, al, bh, bl):
    """The sum of two pairs."""
    s, e = two_sum(ah, bh)
    t, f = two_sum(al, bl)
    s, e = fast_two_sum(s, e + t)
    return fast_two_sum(s, e + f)


def total(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sums of pairs over the last axis, by halves."""
    while (n := high.shape[-1]) > 1:
        half = n // 2
        h, e = add(high[..., :half], low[..., :half], high[..., half : 2 * half], low[..., half : 2 * half])
        if n % 2:
            h[..., 0], e[..., 0] = add(h[..., 0], e[..., 0], high[..., -1], low[..., -1])
        high, low = h, e
    return high[..., 0], low[..., 0]


def outer_sums(high: np.ndarray, low: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each dimension i, the sums over all vectors of products of i with i and those after it. Vectors are columns."""
    a, b = split(high)
    out = []
    for i in range(len(high)):
        p = high[i] * high[i:]
        e = ((a[i] * a[i:] - p) + a[i] * b[i:] + b[i] * a[i:]) + b[i] * b[i:]
        out.append(total(*fast_two_sum(p, e + (high[i] * low[i:] + low[i] * high[i:]))))
    return out


def vectors_of(column: pa.Array, d: int) -> np.ndarray:
    """Arrow's lists, all of d entries, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def centred(x: np.ndarray, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors less a mean that is a pair, as columns of pairs."""
    s, e = two_sum(x.astype(np.float64).T, -high[:, None])
    return fast_two_sum(s, e - low[:, None])


def task_part() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId() % PARTS


def sum_rows(part: int, sums: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    high, low = ([np.ascontiguousarray(x[k], "<f8").tobytes() for x in sums] for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array([part] * len(sums), pa.int32()), pa.array(range(len(sums)), pa.int32()), pa.array(high, pa.binary()), pa.array(low, pa.binary())], schema=SUMS_ARROW)


def task_sums(d: int, of, columns: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (x): the task's sums of what `of` makes of up to AT_ONCE vectors. columns bounds what is held at once."""
    sums, step = None, max(1, min(AT_ONCE, (16 << 20) // max(1, columns)))
    for b in batches:
        x = vectors_of(b.column(0), d)
        for k in range(0, len(x), step):
            more = of(x[k : k + step])
            sums = more if sums is None else [add(*a, *m) for a, m in zip(sums, more, strict=True)]
    if sums is not None:
        yield sum_rows(task_part(), sums)


def merge_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over rows sorted by part and place: one row for each of them."""
    at, high, low = None, None, None
    for b in batches:
        for part, place, h, m in zip(*[c.to_pylist() for c in b.columns], strict=True):
            h, m = np.frombuffer(h, "<f8"), np.frombuffer(m, "<f8")
            if at != (part, place):
                if at is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*at, high.tobytes(), low.tobytes()), SUMS_ARROW, strict=True)], schema=SUMS_ARROW)
                at, high, low = (part, place), h, m
            else:
                high, low = add(high, low, h, m)
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*at, high.tobytes(), low.tobytes()), SUMS_ARROW, strict=True)], schema=SUMS_ARROW)


def merged(sums: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """The tasks' sums merged by part and place, then by place. A row for each dimension comes back, whatever the vectors."""
    n = partitions(sums.sparkSession)
    for part in (F.col("part"), F.lit(0)):
        sums = sums.withColumn("part", part).repartition(n, "part", "place").sortWithinPartitions("part", "place").mapInArrow(merge_sums, SUMS)
    rows = sorted(sums.collect(), key=lambda r: r["place"])
    return [(np.frombuffer(bytes(r["high"]), "<f8"), np.frombuffer(bytes(r["low"]), "<f8")) for r in rows]


def pair(x: Fraction) -> tuple[float, float]:
    return (high := float(x)), float(x - Fraction(high))


def vector_sums(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    high = np.ascontiguousarray(x.T)
    s, e = total(high, np.zeros_like(high))
    return [(s, e)]


def mean_of(vectors: DataFrame, d: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean of vectors of doubles, as a pair."""
    (high, low) = merged(vectors.mapInArrow(partial(task_sums, d, vector_sums, d), SUMS))[0]
    told = [pair((Fraction(h) + Fraction(e)) / n) for h, e in zip(high.tolist(), low.tolist(), strict=True)]
    return np.array([h for h, _ in told]), np.array([e for _, e in told])


def covariance(vectors: DataFrame, d: int, n: int, mean: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The covariance (divisor n) of n vectors of d entries around their mean, as a pair of matrices."""

    def of(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return outer_sums(*centred(x, *mean))

    high, low = np.zeros((d, d)), np.zeros((d, d))
    for i, (h, e) in enumerate(merged(vectors.mapInArrow(partial(task_sums, d, of, d * 8), SUMS))):
        told = [pair((Fraction(a) + Fraction(b)) / n) for a, b in zip(h.tolist(), e.tolist(), strict=True)]
        high[i, i:] = high[i:, i] = [a for a, _ in told]
        low[i, i:] = low[i:, i] = [b for _, b in told]
    return high, low


@dataclass
class Whitening:
    """A fit: n vectors of d entries with sums S, and the components as columns by falling eigenvalue.

    Components without variance have no scale; `rank` is the number of those that have.
    """

    n: int
    sums: list[int]
    mean: tuple[np.ndarray, np.ndarray]
    covariance: tuple[np.ndarray, np.ndarray]
    values: np.ndarray
    vectors: np.ndarray
    rank: int

    def project(self, x: np.ndarray) -> np.ndarray:
        """Rows of whitened coordinates, those without variance left out."""
        high, low = centred(x, *self.mean)
        return (high.T + low.T) @ (self.vectors[:, : self.rank] / np.sqrt(self.values[: self.rank]))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sums over dimensions of (n * x - S)^2, exact; null beyond a long."""
        with np.errstate(over="ignore"):
            own = x * np.int64(self.n) - np.array([s % (1 << 64) for s in self.sums], np.uint64).view(np.int64)
            exact = (own * own).sum(axis=1)  # right modulo 2^64, whatever overflows on the way
        about = ((self.n * (x.astype(np.float64) - self.mean[0]) - self.n * self.mean[1]) ** 2).sum(axis=1)
        return [e if a < 2.0**63 - 2.0**40 else None for e, a in zip(exact.tolist(), about.tolist(), strict=True)]


def steps(docs: DataFrame, vector: str, *keep: str) -> DataFrame:
    """(keep, x): the vectors in whole steps, without those that are null, empty, or hold a null or an entry that is not finite."""
    entries = F.col(vector).cast("array<double>")
    rows = docs.select(*[F.col(k).alias(f"_fl_{k}") for k in keep], entries.alias("_fl_in")).filter(F.coalesce(F.size("_fl_in") > 0, F.lit(False)))
    held = lambda c: F.coalesce(F.abs(c) < TOO_LARGE, F.lit(False))  # noqa: E731  false for a NaN, which is the greatest number
    x = F.transform("_fl_in", lambda c: F.when(held(c), F.floor(c * STEPS) + SHIFT))
    return rows.filter(F.forall("_fl_in", held)).select(*[F.col(f"_fl_{k}").alias(k) for k in keep], x.alias("x"))


def fit(docs: DataFrame, vector: str = "embedding") -> Whitening | None:
    """Fits on all vectors of steps(); where lengths differ, on those of the most frequent one (of ties, the greater). None without any."""
    x = steps(docs, vector).select("x")
    lengths = x.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return None
    d, n = lengths["d"], lengths["n"]
    x = x.filter(F.size("x") == d)
    each = x.select(F.posexplode("x").alias("place", "x")).groupBy("place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"))
    sums = [int(r["s"]) for r in sorted(each.collect(), key=lambda r: r["place"])]
    pairs = [pair(Fraction(s, n)) for s in sums]
    mean = np.array([h for h, _ in pairs]), np.array([e for _, e in pairs])
    high, low = covariance(x, d, n, mean)
    values, vectors = np.linalg.eigh(high)
    values, vectors = values[::-1], vectors[:, ::-1]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(d)] < 0, -1.0, 1.0)
    rank = int((values > max(values[0], 0.0) * d * np.finfo(float).eps).sum())
    return Whitening(n, sums, mean, (high, low), values, vectors, min(rank, COMPONENTS))


def identity_error(docs: DataFrame, model: Whitening, vector: str = "embedding") -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, over the components with variance."""
    if not model.rank:
        return None
    d = len(model.sums)
    x = steps(docs, vector).select("x").filter(F.size("x") == d)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                w = model.project(vectors_of(b.column(0), d))
                yield pa.RecordBatch.from_arrays([lists(w)], names=["w"])

    w = x.mapInArrow(project, "w array<double>")
    high, low = covariance(w, model.rank, model.n, mean_of(w, model.rank, model.n))
    return float(np.abs((high - np.eye(model.rank)) + low).max())


def lists(rows: np.ndarray) -> pa.Array:
    n, k = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(np.ascontiguousarray(rows).ravel()))


def whiten(docs: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, deviation and whitened (an array by component) of every vector that the model's fit would take.

    Null, empty and wrong vectors have no row, nor have those of another length than the model's; null ids are kept; equal
    rows come back as often as they came in; other columns are not read; no rows give none.
    """
    d = len(model.sums)
    rows = steps(docs.withColumn("_fl_id", F.col(vec_id).cast("long")), vector, "_fl_id").filter(F.size("x") == d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = vectors_of(b.column(1), d)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.deviation(x), pa.int64()), lists(model.project(x))], names=["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(run, "vec_id bigint, deviation bigint, whitened array<double>")


def components(docs: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each vector that is left and each component up to COMPONENTS, numbered from 1 by falling eigenvalue.

    Vectors that are null, empty, of another length than most, or hold a null or an entry that is not finite are left out.
    A component without variance, as repeated rows or one vector alone have, has a null `whitened`; of equal eigenvalues
    the order is the solver's. No vectors give no rows; extra columns are not read.
    """
    model = fit(docs, vector)
    if model is None:
        return docs.sparkSession.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    error, trace = identity_error(docs, model, vector), float(np.trace(model.covariance[0]))
    told = min(len(model.sums), COMPONENTS)
    explained = F.array(*[F.lit(max(float(e), 0.0) / trace if trace > 0 else None).cast("double") for e in model.values[:told]])
    rows = whiten(docs, model, vec_id, vector).withColumn("component", F.explode(F.sequence(F.lit(1), F.lit(told))))
    return rows.select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", F.get("whitened", F.col("component") - 1).alias("whitened"),
        F.get(explained, F.col("component") - 1).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """components() over all embeddings."""
    return components(read(spark, sf_dir, "embeddings"))
