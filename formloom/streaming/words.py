"""Stages without a corpus-wide barrier, over a stream of word files: each micro-batch holds whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import extract

WORDS = "doc_id bigint, page_index int, line_no int, word_no int, x0 double, y0 double, x1 double, y1 double, word string, block int"


def watch(spark: SparkSession, folder: str) -> DataFrame:
    """New files of words, as they come."""
    return spark.readStream.schema(WORDS).parquet(folder)


def extract_rows(words: DataFrame, out: str, checkpoint: str, width: float = 612.0, height: float = 792.0, header: str = extract.FORM_HEADER) -> StreamingQuery:
    """Rows of each file's documents, written once for each batch: a batch that runs again replaces its own folder."""

    def batch(df: DataFrame, n: int) -> None:
        extract.rows(df, width, height, header).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return words.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
