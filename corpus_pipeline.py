"""The corpus pipeline: documents to token digests, in stages that each call one operator of formloom.llm.

All stages but the last take and return the columns of documents, and keep clean documents as they are.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.llm import bpe, decontaminate, neardup, secrets, toxicity
from formloom.llm.common import read, written, written_some


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose score is a half or more. Learns from these documents' labels.

    Null and empty texts score as texts without evidence, rows of a null id like any other, equal rows the same; a text
    is scored whole. No rows give none, and without labels nothing is rejected. Columns of any name pass as they are.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return model.keep(docs)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with `_fl_key_<k>`: the id and two hashes of the text. Rows of one key are equal in both."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"_fl_key_id": F.col("doc_id").cast("long"), "_fl_key_1": F.xxhash64("text"), "_fl_key_2": F.xxhash64(F.lit(1), text)})


KEY = ["_fl_key_id", "_fl_key_1", "_fl_key_2"]


def by_key(docs: DataFrame, keys: DataFrame, rows: int, how: str) -> DataFrame:
    """The rows of keyed docs that `how` (left_anti, left_semi) joins with keys; nulls are equal. Few keys are broadcast, more are not."""
    keys = keys.select(*[F.col(k).alias(f"{k}_") for k in KEY])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in KEY])
    return docs.join(F.broadcast(keys) if rows <= neardup.BROADCAST_IDS else keys, same, how)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: of the least id (a null one is the greatest), then of the least hashes.

    Rows are told apart by id and text, so a row whose id another one shares is judged by its own text. Of rows that are
    equal in both, one stays. Texts without a word, null ones too, are alone and stay, each row of them. No rows give
    none. Columns of any name pass as they are.
    """
    told = keyed(docs)
    rows = told.select(F.col("_fl_key_id").alias("doc_id"), "text")
    near = neardup.near_duplicates(rows).filter("component is not null")
    near = written(near.select("component", "kept", F.col("doc_id").alias("_fl_key_id"), F.col("text_hash").alias("_fl_key_1"), F.col("text_hash_2").alias("_fl_key_2")), "pipeline-near")
    # of a group, the rows of the least id are few: more than one only where ids repeat or all are null
    least = near.filter("kept").groupBy("component", *KEY).agg(F.count("*").alias("rows"))
    best = least.groupBy("component").agg(F.min(F.struct(*KEY)).alias("best"))
    least = written(least.join(best, "component").withColumn("first", F.struct(*KEY).eqNullSafe(F.col("best"))), "pipeline-least")
    rejected, many = written_some(near.filter("not kept").select(*KEY).union(least.filter("not first").select(*KEY)).distinct(), "pipeline-rejected")
    repeated, some = written_some(least.filter("first and rows > 1").select(*KEY), "pipeline-repeated")
    if many:
        told = by_key(told, rejected, many, "left_anti")
    if some:
        told = by_key(told, repeated, some, "left_anti").unionByName(by_key(told, repeated, some, "left_semi").dropDuplicates(KEY))
    return told.select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of whose words a twentieth or more stand in benchmark windows.

    Rows are told apart by id and text; equal rows are judged alike, rows of a null id like any other. Null and empty
    texts stay. Texts are read whole. No rows give none. Columns of any name pass as they are.
    """
    told = keyed(docs)
    found = decontaminate.decontaminate(told.select(*KEY, F.col("text").alias("text")), read(spark, sf_dir, "benchmark"), KEY)
    rejected, many = written_some(found.filter("contaminated").select(*KEY).distinct(), "pipeline-rejected")
    return by_key(told, rejected, many, "left_anti").select(*docs.columns) if many else docs


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With every secret in a text replaced, and n_chars counted again where one was.

    Null and empty texts stay as they are, equal rows come back as often as they came in, null ids are kept, and a text
    is scanned whole. No rows give none. Columns of any name but text and n_chars pass as they are.
    """
    own = {c: f"_fl_own_{k}" for k, c in enumerate(docs.columns)}
    found = secrets.find_secrets(docs.withColumnsRenamed(own), text=own["text"])
    text, held = F.col(own["text"]), F.size("spans") > 0
    clean = F.when(held, secrets.redact(text, F.col("spans"))).otherwise(text)
    told = found.withColumn("_fl_clean", clean)
    out = {c: F.col(o) for c, o in own.items()} | {"text": F.col("_fl_clean")}
    if "n_chars" in own:
        out["n_chars"] = F.when(held, F.length("_fl_clean").cast("long")).otherwise(F.col(own["n_chars"]))
    return told.select(*[out[c].alias(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left: doc_id, n_tokens, ids_sha256 and decoded_sha256.

    Null and empty texts have no ids and decode to nothing; equal rows come back as often as they came in; null ids are
    kept; texts are encoded whole; other columns are not read. No rows give none.
    """
    out = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.mapInArrow(bpe.digests, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


STAGES = [
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("bpe", tokens),
]

#: None: SQL expresses neither the learned stages nor the encoding; test_pipeline holds run() against plain rules.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again as the next one's input."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
