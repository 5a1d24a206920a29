"""Lookup tables, rows and reports as CSV and JSON files, and texts as whole files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .named import write_named

LOOKUP = ["label", "context", "domain", "variable", "condition", "fixed_value", "count", "sample_pdfs"]
_CSV = {"header": True, "multiLine": True, "escape": '"', "quote": '"'}


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text, empty ones as ""; columns that a file lacks are empty."""
    df = spark.read.options(**_CSV).csv(path)
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in LOOKUP])


def write_lookup(lookup: DataFrame, path: str) -> None:
    """By count, then label."""
    lookup.select(*LOOKUP).orderBy(F.desc(F.col("count").cast("long")), "label").write.options(**_CSV, emptyValue="").csv(path)


def write_report(mappings: DataFrame, path: str, places: int = 1) -> None:
    """Every mapping with its boxes as columns; numbers rounded here and nowhere else; what was never known is empty."""
    flat = []
    for f in mappings.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() == "struct":
            flat += [(F.round(c[x.name], places) if x.dataType.typeName() == "double" else c[x.name]).alias(f"{f.name}_{x.name}") for x in f.dataType.fields]
        elif f.dataType.typeName() == "array":
            flat.append(F.array_join(c, " ").alias(f.name))
        else:
            flat.append((F.round(c, places) if f.dataType.typeName() == "double" else c).alias(f.name))
    mappings.select(*flat).write.options(**_CSV, emptyValue="").csv(path)


def write_cells(rows: DataFrame, path: str) -> None:
    """Rows as they stand; what was never known is empty."""
    rows.write.options(**_CSV, emptyValue="").csv(path)


def write_documents(df: DataFrame, path: str, order: str = "row_ord") -> None:
    """One JSON object for each document: doc_id and its rows in order."""
    rows = F.struct(*[c for c in [order, *[x for x in df.columns if x not in (order, "doc_id")]]])
    df.groupBy("doc_id").agg(F.array_sort(F.collect_list(rows)).alias("rows")).write.json(path)


def read_documents(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of write_documents(), in the schema given."""
    from pyspark.sql import types as t

    inner = t.StructType([f for f in schema.fields if f.name != "doc_id"])
    df = spark.read.schema(t.StructType([schema["doc_id"], t.StructField("rows", t.ArrayType(inner))])).json(path)
    return df.select("doc_id", F.explode("rows").alias("r")).select("doc_id", "r.*").select(*schema.names)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text): whole files by their names."""
    return spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("doc_id"), F.col("value").alias("text"))


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(doc_id, content): binary files of a folder by their names."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select(F.element_at(F.split("path", "/"), -1).alias("doc_id"), "content")


def counterparts(annotated: DataFrame, blank: DataFrame) -> DataFrame:
    """(doc_id, blank_id): each annotated file (doc_id, a name or path) with the blank form of the same name, null if there is none."""
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    own = blank.groupBy(name("doc_id").alias("_n")).agg(F.min("doc_id").alias("blank_id"))
    return annotated.select("doc_id", name("doc_id").alias("_n")).join(own, "_n", "left").select("doc_id", "blank_id")


def write_batches(files: DataFrame, path: str) -> None:
    """A batch's texts as files, below a folder for each document and under the names that the manifest tells."""
    one = lambda name, text: files.select(F.concat_ws("/", F.col("doc_id").cast("string"), name).alias("name"), F.col(text).alias("content"))
    write_named(one("instructions", "instructions_text").unionByName(one("sheet", "sheet_text")), path)
