"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions, read, written

#: Rows above which numpy's own generator refuses to draw.
NUMPY_MOST = 1_000_000_000


def rest_of_stirling(n: float) -> float:
    """log n! less Stirling's formula for it."""
    if n < 16:
        return math.lgamma(n + 1) - ((n + 0.5) * math.log(n) - n + 0.5 * math.log(2 * math.pi) if n else 0.0)
    return (1 / 12 - (1 / 360 - 1 / 1260 / (n * n)) / (n * n)) / n


def deviance(x: float, mean: float) -> float:
    """x log(x / mean) + mean - x, without loss of digits where both are large and near."""
    if not x:
        return mean
    d = (x - mean) / mean
    if abs(d) > 0.1:
        return x * math.log(x / mean) + mean - x
    # (1 + d) log(1 + d) - d as a series
    return mean * math.fsum((-d) ** k / (k * (k - 1)) for k in range(2, 24))


def log_binomial(k: int, n: int, p: float) -> float:
    """log of the probability of k among n, each with probability p, by the saddle point."""
    if k in (0, n):
        return n * (math.log1p(-p) if k == 0 else math.log(p))
    rest = rest_of_stirling(n) - rest_of_stirling(k) - rest_of_stirling(n - k)
    return rest - deviance(k, n * p) - deviance(n - k, n * (1 - p)) - 0.5 * math.log(2 * math.pi * k * (n - k) / n)


def log_hypergeometric(k: int, good: int, bad: int, n: int) -> float:
    """log of the probability that k of n draws without replacement are good."""
    if n in (0, good + bad):
        return 0.0
    p = n / (good + bad)
    return log_binomial(k, good, p) + log_binomial(n - k, bad, p) - log_binomial(n, good + bad, p)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n draws without replacement are good; inversion from the mode where numpy refuses."""
    if good + bad < NUMPY_MOST:
        return int(rng.hypergeometric(good, bad, n)) if n and good else 0
    low, high = max(0, n - bad), min(n, good)
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    p = up = down = math.exp(log_hypergeometric(mode, good, bad, n)) if high > low else 1.0
    u, i, j = rng.random() - p, mode, mode
    while u > 0 and (i < high or j > low):
        if i < high:
            up *= (good - i) * (n - i) / ((i + 1) * (bad - n + i + 1))
            i, u = i + 1, u - up
            if u <= 0:
                return i
        if j > low:
            down *= j * (bad - n + j) / ((good - j + 1) * (n - j + 1))
            j, u = j - 1, u - down
            if u <= 0:
                return j
    return mode


def communication_matrix(counts: list[int], lacks: list[int], seed: tuple[int, ...]) -> np.ndarray:
    """Rows that each partition sends to each shard: the law of a uniform shuffle, given both margins (equal in sum).

    Each partition takes its row of the matrix from what the shards still lack.
    """
    rng = np.random.default_rng(seed)
    lacks, out = list(lacks), np.zeros((len(counts), len(lacks)), dtype=np.int64)
    for p, n in enumerate(counts):
        rest = sum(lacks)
        for s in range(len(lacks)):
            got = hypergeometric(rng, lacks[s], rest - lacks[s], n)
            rest -= lacks[s]
            out[p, s] = got
            n -= got
        lacks = [a - int(b) for a, b in zip(lacks, out[p], strict=True)]
    return out


def drawn(counts: DataFrame, shards: int, parts: int, seed: int) -> DataFrame:
    """(_fl_part, _fl_ends): of each partition (_fl_part, n), where its shards end among its rows.

    The matrix is drawn in two steps, which have the same law as one: the driver deals the shards' sizes to about
    sqrt(parts) groups of partitions, and each group's task deals its share to its partitions.
    """
    size = max(1, math.isqrt(parts))
    grouped = counts.withColumn("_fl_group", (F.col("_fl_part") / size).cast("int"))
    sums = sorted((r[0], r[1]) for r in grouped.groupBy("_fl_group").agg(F.sum("n")).collect())
    total = sum(n for _, n in sums)
    share = communication_matrix([n for _, n in sums], [total // shards + (s < total % shards) for s in range(shards)], (seed, 0))
    shares = {g: [int(x) for x in row] for (g, _), row in zip(sums, share, strict=True)}

    def deal(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_fl_part")
        matrix = communication_matrix(rows["n"].tolist(), shares[key[0]], (seed, 1, int(key[0])))
        return pd.DataFrame({"_fl_part": rows["_fl_part"], "_fl_ends": list(np.cumsum(matrix, axis=1))})

    return grouped.groupBy("_fl_group").applyInPandas(deal, "_fl_part int, _fl_ends array<bigint>")


def shard(df: DataFrame, shards: int, key: list[str], seed: int = 7, rows_per_part: int = 250_000) -> DataFrame:
    """All rows of df with `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard), replacing columns so named.

    Rows are dealt to partitions by a hash of `key`, permuted there, sent by the drawn matrix and permuted again by
    sub-range of each shard, so no task holds a whole shard. About sqrt(partitions) counts come to the driver; the
    matrix, and where sub-ranges begin, are tables that meet the rows by partition. Equal rows are interchangeable, and
    all in one partition, so `key` should identify a row; sizes are exact whatever it is. Null keys hash as any value;
    other columns pass as they are, texts of any length too. No rows give none.
    """
    spark, names = df.sparkSession, [c for c in df.columns if c not in ("shard", "slot")]
    parts = max(partitions(spark), math.ceil(df.count() / rows_per_part))
    draw = lambda salt: F.xxhash64(F.lit(seed), F.lit(salt), *[F.col(k) for k in key])
    dealt = df.select(*names).withColumn("_fl_part", F.pmod(draw("part"), F.lit(parts)).cast("int"))
    ends = written(drawn(dealt.groupBy("_fl_part").agg(F.count("*").alias("n")), shards, parts, seed), "shard-matrix")
    local = W.partitionBy("_fl_part").orderBy(draw("local"), *key)
    sent = (
        dealt.withColumn("_fl_k", F.row_number().over(local))
        .join(ends, "_fl_part")
        .withColumn("shard", F.size(F.filter("_fl_ends", lambda e: e < F.col("_fl_k"))).cast("int"))
        .withColumn("_fl_sub", F.pmod(draw("sub"), F.lit(max(1, math.ceil(parts / shards)))).cast("int"))
        .drop("_fl_ends", "_fl_k", "_fl_part")
    )
    counts = sent.groupBy("shard", "_fl_sub").agg(F.count("*").alias("_fl_n"))
    before = F.sum("_fl_n").over(W.partitionBy("shard").orderBy("_fl_sub").rowsBetween(W.unboundedPreceding, -1))
    begins = counts.select("shard", "_fl_sub", F.coalesce(before, F.lit(0).cast("long")).alias("_fl_begin"))
    again = W.partitionBy("shard", "_fl_sub").orderBy(draw("again"), *key)
    return (
        sent.withColumn("_fl_k", F.row_number().over(again))
        .join(begins, ["shard", "_fl_sub"])
        .withColumn("slot", F.col("_fl_begin") + F.col("_fl_k") - 1)
        .select(*names, "shard", "slot")
    )


def op6_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a uniform shuffle over 24 shards; the law is `rows`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    out = shard(docs, 24, ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
