"""Votes and the lookup table kept up to date as files of mappings arrive.

Sums live in the stream's state, so a file is read once; a mapping that comes again, in the same file or in another, is
known by its source and place and not counted twice. Each batch writes the sums that it changed, under its own number: a
batch that runs again after a failure replaces what it wrote. What stands now is the last written of each sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import precedent


def watch(spark: SparkSession, folder: str, schema: StructType | str, files: int | None = None) -> DataFrame:
    """New files of mappings, as they come; `files` bounds those of a batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(folder)


def once(mappings: DataFrame, keys: list[str], arrived: str | None = None, within: str = "30 days") -> DataFrame:
    """Each mapping once, by its keys. With a time column, state is kept for as long as copies may come: `within`."""
    if arrived:
        return mappings.withWatermark(arrived, within).dropDuplicatesWithinWatermark(keys)
    return mappings.dropDuplicates(keys)


def keep(sums: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes the sums that each batch changes; ends when all that has arrived is read, and goes on from there when called again."""

    def batch(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={n}")

    return sums.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Each sum as it was written last."""
    told = spark.read.parquet(out)
    fields = [c for c in told.columns if c not in (*keys, "batch")]
    return told.groupBy(*keys).agg(F.max_by(F.struct(*fields), "batch").alias("_s")).select(*keys, "_s.*")


def keep_votes(mappings: DataFrame, out: str, checkpoint: str, keys: list[str], arrived: str | None = None) -> StreamingQuery:
    return keep(precedent.vote_counts(once(mappings, keys, arrived)), out, checkpoint)


def votes_now(spark: SparkSession, out: str, min_support: int = 2) -> DataFrame:
    """As precedent.domain_votes() of all mappings so far."""
    return precedent.most_voted(current(spark, out, ["variable", "domain"]), min_support)


def keep_lookup(mappings: DataFrame, out: str, checkpoint: str, keys: list[str], arrived: str | None = None) -> StreamingQuery:
    return keep(precedent.label_counts(once(mappings, keys, arrived)), out, checkpoint)


def lookup_now(spark: SparkSession, out: str) -> DataFrame:
    """As precedent.lookup_table() of all mappings so far."""
    return precedent.lookup_of(current(spark, out, ["_key", *precedent.FIELDS, "pdf"]))
