"""Helpers that the training-text operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names. Unset, a temporary folder serves, on a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="formloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends there, and a lost executor costs no recomputation."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._fl_folder = path
    return out


def written_some(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """written(), and its number of rows, counted as they are written. A task that ran twice may count twice: 0 is exact."""
    rows = Observation()
    out = written(df.observe(rows, F.count(F.lit(1)).alias("n")), name)
    return out, rows.get["n"]


def discard(*tables: DataFrame) -> None:
    """Deletes tables that written() gave and nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._fl_folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, text: str, each: int = 64 << 20) -> int:
    """Partitions for what comes of a column of texts: the session's number, and more where that leaves over `each` bytes to one."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(partitions(df.sparkSession), -(-size // each))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves that remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
