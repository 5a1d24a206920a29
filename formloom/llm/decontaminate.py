"""Benchmark decontamination: word windows of benchmark items, looked up among the windows of documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, read
from .secrets import let, running

WINDOW = 13
#: A larger table of windows is joined by a shuffle.
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    """Runs of 0-9, a-z and characters beyond ASCII, in order; none for null."""
    spaced = F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def windows_of(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct windows (win, n, items): `window` consecutive words, or all words of a shorter item."""
    w = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    one = w.select("item", F.explode_outer(F.transform(at, lambda i: F.slice("w", i, window))).alias("win"))
    return one.groupBy("win").agg(F.collect_set("item").alias("items")).withColumn("n", F.size("win"))


def lead_sizes(lengths: list[int]) -> list[int]:
    """Words by whose hash windows are looked up: for lengths that are near, the least of them, so that leads stay rare."""
    floor = lambda n: max(k for k in (1, 2, 3, 4, 6, 9, WINDOW) if k <= n)
    least: dict[int, int] = {}
    for n in sorted(lengths):
        least.setdefault(floor(n), n)
    return list(least.values())


def hits(docs: DataFrame, windows: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """One row for each row of docs: `keep`, n_words, spans (start, end in words, of windows that occur) and items.

    Each row's key is its kept columns with two hashes of its text; equal rows share one and are multiplied again at the
    end. Windows are broadcast up to BROADCAST_BYTES, and joined by a shuffle beyond.
    """
    spark = docs.sparkSession
    facts = windows.groupBy("n").agg(F.sum(F.length(F.concat_ws(" ", "win")) + 64 + 24 * F.size("items")).alias("b")).collect()
    sizes = lead_sizes(sorted(r["n"] for r in facts))
    lead = reduce(lambda a, k: F.when(F.col("n") >= k, F.lit(k)).otherwise(a), sizes, F.lit(0))
    table = windows.withColumn("_lead", lead.cast("int")).select(
        F.xxhash64(F.slice("win", F.lit(1), F.col("_lead"))).alias("_h"), "_lead", "win", F.col("n").alias("_n"), "items"
    )
    small = sum(r["b"] for r in facts) <= BROADCAST_BYTES
    w = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("_keep"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_t1"),
        F.xxhash64(F.lit(1), F.coalesce(F.col(text), F.lit(""))).alias("_t2"),
        words(F.col(text)).alias("_w"),
    )

    def leads(k: int) -> Column:
        at = F.sequence(F.lit(1), F.size("_w") - k + 1)
        grams = F.transform(at, lambda i: F.struct(i.alias("i"), F.lit(k).alias("k"), F.xxhash64(F.slice("_w", i, k)).alias("h")))
        return F.when(F.size("_w") >= k, grams).otherwise(F.expr("cast(array() as array<struct<i:int,k:int,h:bigint>>)"))

    found = F.struct(F.col("_g.i").alias("start"), (F.col("_g.i") + F.col("_n")).alias("end")).alias("_span")
    same = (F.col("_g.h") == F.col("_h")) & (F.col("_g.k") == F.col("_lead"))
    key = ["_keep", "_t1", "_t2"]
    # explode_outer: explode() would add a filter that repeats all of its expressions
    if small:  # one pass, in which a last, unmatched position keeps documents without a hit
        last = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("k"), F.lit(None).cast("long").alias("h")))
        at = w.withColumn("_at", F.concat(*[leads(k) for k in sizes], last)).select("*", F.explode_outer("_at").alias("_g")).drop("_at")
        at = at.withColumn("_nw", F.when(F.col("_g.i") == 0, F.size("_w")))
        met = at.join(F.broadcast(table), same, "left")
        met = met.filter((F.col("_g.i") == 0) | F.when(F.col("_g.i") > 0, F.slice("_w", F.col("_g.i"), F.col("_n")) == F.col("win")).otherwise(F.lit(False)))
        met = met.select(*key, "_nw", F.when(F.col("_g.i") > 0, found).alias("_span"), "items")
    else:  # windows travel with their own words; documents come to their hits by their keys, never by a null hash
        longest = max([1, *[r["n"] for r in facts]])
        at = w.withColumn("_at", F.concat(*[leads(k) for k in sizes])).select(*key, "_w", F.explode_outer("_at").alias("_g")).filter("_g is not null")
        at = at.select(*key, "_g", F.slice("_w", F.col("_g.i"), F.lit(longest)).alias("_own"))
        met = at.join(table, same).filter(F.slice("_own", F.lit(1), F.col("_n")) == F.col("win"))
        met = met.select(*key, F.lit(None).cast("int").alias("_nw"), found, "items")
        met = met.union(w.select(*key, F.size("_w"), F.lit(None).cast("struct<start:int,end:int>"), F.lit(None).cast("array<string>")))
    grouped = met.groupBy(*key).agg(
        F.count("_nw").alias("_rows"), F.max("_nw").cast("long").alias("n_words"), F.sort_array(F.collect_set("_span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return grouped.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int")))).select("_keep.*", "n_words", "spans", "items")


def merged(spans: Column) -> Column:
    """Sorted spans with those that meet or overlap made one: a span opens another where it starts beyond all ends before."""
    told = F.struct(spans.alias("s"), running(F.transform(spans, lambda s: s["end"]), F.greatest).alias("upto"))

    def of(t: Column) -> Column:
        opens = F.filter(F.sequence(F.lit(0), F.size(t["s"]) - 1), lambda i: (i == 0) | (F.get(t["s"], i)["start"] > F.get(t["upto"], i - 1)))
        last = lambda o, j: F.coalesce(F.get(o, j + 1) - 1, F.size(t["s"]) - 1)
        return let(opens, lambda o: F.transform(o, lambda i, j: F.struct(F.get(t["s"], i)["start"].alias("start"), F.get(t["upto"], last(o, j)).alias("end"))))

    return F.when(F.size(spans) == 0, spans).otherwise(let(told, of))


#: A word as it stands in a text, and what is no word before it.
WORD_WITH_LEAD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*+[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"


def without(text: Column, spans: Column) -> Column:
    """The text without the words of merged() spans and what stands before each of them; what stands behind the last word stays."""
    told = F.struct(text.alias("text"), F.regexp_extract_all(text, F.lit(WORD_WITH_LEAD), F.lit(0)).alias("words"), spans.alias("s"))

    def of(t: Column) -> Column:
        words, s = t["words"], t["s"]
        end = lambda i: F.when(i > 0, F.get(s, i - 1)["end"]).otherwise(1)
        kept = F.transform(s, lambda x, i: F.array_join(F.slice(words, end(i), x["start"] - end(i)), ""))
        after = F.element_at(s, -1)["end"]
        tail = F.substr(t["text"], F.length(F.array_join(words, "")) + 1)
        return F.concat(F.array_join(kept, ""), F.array_join(F.slice(words, after, F.greatest(F.lit(0), F.size(words) - after + 1)), ""), tail)

    return F.when(F.size(spans) == 0, text).otherwise(let(told, of))


def hit_words(spans: Column) -> Column:
    """Words in any span: spans come sorted, so each adds what lies beyond the furthest end so far."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(acc: Column, s: Column) -> Column:
        more = F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(acc["end"], s["start"].cast("long")))
        return F.struct((acc["n"] + more).alias("n"), F.greatest(acc["end"], s["end"].cast("long")).alias("end"))

    return F.aggregate(spans, zero, add, lambda acc: acc["n"])


def decontaminate(docs: DataFrame, items: DataFrame, keep: list[str], item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Every row of docs: `keep`, n_words, n_hit, n_items, items, spans and contaminated (a twentieth of its words or more hit).

    Null and empty texts have no words and are not contaminated; items without a word have no window; an empty benchmark
    contaminates nothing; equal rows come back as often as they came in, and items with equal windows are all told. Null
    ids are kept; other columns are not read; texts are read whole. No rows give none.
    """
    found = hits(docs, windows_of(items, item_id, text, window), keep, text).withColumn("n_hit", hit_words(F.col("spans")))
    return found.select(
        *keep, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def remove_spans(docs: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with `cleaned` (the text without the words of windows that occur) and `removed` (their spans, in words from 1).

    Texts without a hit stay as they are, null ones too; rows come back as often as they came in, and columns of any name
    but those two pass; no rows give none. Rows are told apart by two hashes of their text, of which only those with a hit
    travel.
    """
    rest = docs.drop("cleaned", "removed")
    key = {"_fl_1": F.xxhash64(F.coalesce(F.col(text), F.lit(""))), "_fl_2": F.xxhash64(F.lit(1), F.coalesce(F.col(text), F.lit("")))}
    texts = docs.select(F.col(text).alias("text")).withColumns({k: F.xxhash64(*([F.lit(1)] if k == "_fl_2" else []), F.coalesce(F.col("text"), F.lit(""))) for k in key}).dropDuplicates(list(key))
    found = decontaminate(texts, items, list(key), item_id, "text", window).filter("n_hit > 0")
    out = rest.withColumns(key).join(found.select(*key, merged(F.col("spans")).alias("removed")), list(key), "left").drop(*key)
    hit = F.size("removed") > 0
    return out.withColumn("cleaned", F.when(hit, without(F.col(text), F.col("removed"))).otherwise(F.col(text))).withColumn("removed", F.coalesce("removed", F.expr("cast(array() as array<struct<start:int,end:int>>)")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS win, least(len(w), 13) AS n
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item FROM dw JOIN bw USING (win, n)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
hi AS (SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS s FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
