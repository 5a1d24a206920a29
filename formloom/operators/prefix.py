"""Lookup by an exact key or else by a key that a text begins with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_lookup(texts: DataFrame, keys: DataFrame, text: str = "text", key: str = "key") -> DataFrame:
    """texts, each with what its key says: the key that it is, else the first by `place` that it begins with, else nothing.

    keys have a key, any other columns, and may have `place`; without it the longest key is first. Of equal keys the first
    by place, or any one, stands; a null or empty key is none. Adds the key's columns and `exact`; a null text has none.

    A text meets the keys of its own beginnings alone. Its beginnings of 1, 2, 4, 8 letters and so on tell which lengths up
    to twice that are worth a look, since some key begins so too; of these it has one hash each, as far as the text goes.
    Distinct texts are looked up once each, and a key that many texts begin with is one row on its side of the joins.
    """
    fields = [c for c in keys.columns if c not in (key, "place")]
    order = F.col("place") if "place" in keys.columns else -F.length(key)
    known = keys.filter(F.length(key) > 0).withColumn("_order", order)
    known = known.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*[F.col(c) for c in [key, *fields]]), "_order").alias("_says"), F.min("_order").alias("_order"))
    known = known.withColumns({"_size": F.length("_key"), "_hash": F.xxhash64("_key")})
    begins = lambda c, n: F.xxhash64(F.substring(c, F.lit(1), F.col(n)))
    lead = F.expr("shiftleft(1, length(bin(_size)) - 1)")  # the greatest power of two up to the key's length
    leads = known.withColumn("_lead", lead).withColumn("_begins", begins("_key", "_lead")).groupBy("_lead", "_begins").agg(F.collect_set("_size").alias("_sizes"))
    own = texts.select(F.col(text).alias("_text")).filter("_text is not null").distinct()
    own = own.withColumn("_lead", F.explode(leads.agg(F.collect_set("_lead")).scalar())).filter(F.col("_lead") <= F.length("_text"))
    own = own.withColumn("_begins", begins("_text", "_lead")).join(leads, ["_lead", "_begins"])
    own = own.select("_text", F.explode("_sizes").alias("_size")).filter(F.col("_size") <= F.length("_text"))
    own = own.withColumns({"_start": F.substring("_text", F.lit(1), F.col("_size")), "_exact": F.col("_size") == F.length("_text")}).withColumn("_hash", F.xxhash64("_start"))
    met = own.join(known, ["_size", "_hash"]).filter(F.col("_start") == F.col("_key"))
    best = met.groupBy("_text").agg(F.min_by(F.struct("_says", "_exact"), F.struct((~F.col("_exact")).alias("n"), "_order", "_key")).alias("_b"))
    out = texts.join(best, F.col(text) == F.col("_text"), "left")
    return out.select(*[texts[c] for c in texts.columns], F.col(f"_b._says.{key}").alias(key), *[F.col(f"_b._says.{c}").alias(c) for c in fields], F.col("_b._exact").alias("exact"))
