"""Annotations that repeat over rows: collapsed by themselves, or declared by a key.

rows: doc_id, row_ord, row_id, page_index, form. annotations: doc_id, row_id, slot, page_index, kind, domain, origin, shown
(the text that is drawn), group_id. Keys of one document are matched in all joins; order is row_ord.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.stage import staged

AUTO = "g_"


#: Rows of a stretch, by which rows and the groups that span them meet.
CELL = 32


def content() -> Column:
    """What makes two annotations one assertion: kind, domain, origin and the text."""
    e = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(F.col("kind").alias("kind"), e("domain").alias("domain"), e("origin").alias("origin"), F.col("shown").alias("shown"))


def collapse_repeats(annotations: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, row_ord, row_id, slot, group_id): islands of two or more neighbouring rows with equal content in a slot.

    A row without an annotation in the slot ends an island, as does another page or form. Declared groups stay out.
    """
    own = annotations.filter("group_id is null and shown <> ''").withColumn("_c", content()).select("doc_id", "row_id", "slot", "_c")
    # neighbours of the full sequence of rows, told before the join, so that rows without annotations need no place in it
    order = W.partitionBy("doc_id").orderBy("row_ord")
    r = rows.select("doc_id", "row_ord", "row_id", "page_index", "form").withColumn("_place", F.row_number().over(order))
    a = own.join(r, ["doc_id", "row_id"])
    slot = W.partitionBy("doc_id", "slot").orderBy("_place")
    was = lambda c: F.lag(c).over(slot)
    same = (was("_place") == F.col("_place") - 1) & (was("_c") == F.col("_c")) & (was("page_index") == F.col("page_index")) & (was("form") == F.col("form"))
    a = a.withColumn("_new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn("_island", F.sum("_new").over(slot.rowsBetween(W.unboundedPreceding, 0)))
    heads = a.groupBy("doc_id", "slot", "_island").agg(F.count("*").alias("_n"), F.min_by("row_id", "_place").alias("_first")).filter("_n >= 2")
    return a.join(heads, ["doc_id", "slot", "_island"]).select("doc_id", "row_ord", "row_id", "slot", F.concat(F.lit(AUTO), F.col("_first")).alias("group_id"))


def row_membership(keys: DataFrame, slots: tuple[int, ...] = (1, 2)) -> DataFrame:
    """(doc_id, row_id, slot, key) from one key for each row; blank keys are none."""
    return keys.filter("key <> ''").select("doc_id", "row_id", F.explode(F.array(*[F.lit(s) for s in slots])).alias("slot"), "key")


def own_membership(annotations: DataFrame) -> DataFrame:
    """(doc_id, row_id, slot, key) from the annotations' own groups: every row that a grouped one covers."""
    return covered_rows(annotations.filter("coalesce(group_id, '') <> ''")).select("doc_id", F.col("covered").alias("row_id"), "slot", F.col("group_id").alias("key")).distinct()


def resolve_groups(annotations: DataFrame, rows: DataFrame, membership: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(resolved, errors): each group and slot as one annotation for each page that its members stand on.

    errors (doc_id, key, slot, error, row_id): members that are no rows, contents that differ, and rows amid a group that
    say something else. Groups with an error, or without content, give no annotation; the first member's content is the
    group's. A run of one has no members. Annotations of no group stay as they are. Without membership, groups are those
    that the annotations say themselves, as a set that was resolved before does.
    """
    if membership is None:
        membership = own_membership(annotations)
    r = rows.select("doc_id", "row_id", F.col("row_ord"), F.col("page_index").alias("_page"))
    m = staged(membership.join(r, ["doc_id", "row_id"], "left"))
    unknown = m.filter("row_ord is null").select("doc_id", "key", "slot", F.lit("unknown row").alias("error"), "row_id")
    m = m.filter("row_ord is not null")
    said = annotations.filter("shown <> ''").select("doc_id", "row_id", "slot", content().alias("_c"))
    told = m.join(said, ["doc_id", "row_id", "slot"], "left")
    g = staged(told.groupBy("doc_id", "key", "slot").agg(F.count_distinct("_c").alias("_kinds"), F.min(F.when(F.col("_c").isNotNull(), F.struct("row_ord", "_c"))).alias("_first"), F.min("row_ord").alias("_lo"), F.max("row_ord").alias("_hi")))
    differ = g.filter("_kinds > 1").select("doc_id", "key", "slot", F.lit("contents differ").alias("error"), F.lit(None).cast("string").alias("row_id"))
    others = said.join(r, ["doc_id", "row_id"]).join(m.select("doc_id", "row_id", "slot", F.col("key").alias("_own")), ["doc_id", "row_id", "slot"], "left")
    cell = lambda c: F.floor(F.col(c) / CELL)
    spans = g.filter("_kinds > 0").select("doc_id", "slot", "key", "_lo", "_hi", F.explode(F.sequence(cell("_lo"), cell("_hi"))).alias("_cell"))
    within = others.withColumn("_cell", cell("row_ord")).join(spans, ["doc_id", "slot", "_cell"]).filter((F.col("row_ord") > F.col("_lo")) & (F.col("row_ord") < F.col("_hi")) & ~F.col("_own").eqNullSafe(F.col("key")))
    between = within.select("doc_id", "key", "slot", F.lit("row between").alias("error"), "row_id")
    errors = unknown.unionByName(differ).unionByName(between)
    good = g.filter("_kinds = 1").join(errors.select("doc_id", "key", "slot").distinct(), ["doc_id", "key", "slot"], "left_anti")
    runs = m.join(good.select("doc_id", "key", "slot", F.col("_first._c").alias("_c")), ["doc_id", "key", "slot"]).groupBy("doc_id", "key", "slot", F.col("_page").alias("page_index"), "_c").agg(F.array_sort(F.collect_list(F.struct("row_ord", "row_id"))).alias("_rows"))
    ids = F.transform("_rows", lambda x: x["row_id"])
    grouped = runs.select("doc_id", F.element_at(ids, 1).alias("row_id"), "slot", "page_index", "_c.*", F.col("key").alias("group_id"), F.when(F.size("_rows") > 1, ids).otherwise(F.array().cast("array<string>")).alias("member_row_ids"))
    rest = annotations.join(m.select("doc_id", "row_id", "slot").distinct(), ["doc_id", "row_id", "slot"], "left_anti")
    free = rest.select("doc_id", "row_id", "slot", "page_index", "kind", F.coalesce("domain", F.lit("")).alias("domain"), F.coalesce("origin", F.lit("")).alias("origin"), "shown", "group_id", F.array().cast("array<string>").alias("member_row_ids"))
    return grouped.unionByName(free), errors


def covered_rows(annotations: DataFrame) -> DataFrame:
    """(doc_id, covered, ...) one for each member, or the annotation's own row; none for what belongs to a page."""
    ids = F.when(F.size("member_row_ids") > 0, F.col("member_row_ids")).when(F.col("row_id").isNotNull(), F.array("row_id"))
    return annotations.withColumn("covered", F.explode(ids))


def coverage(annotations: DataFrame) -> DataFrame:
    """(doc_id, covered, groups): the groups that cover a row, in order."""
    return covered_rows(annotations.filter("group_id is not null")).groupBy("doc_id", "covered").agg(F.array_sort(F.collect_set("group_id")).alias("groups"))


def summary(annotations: DataFrame) -> DataFrame:
    """(groups, members): how many annotations cover several rows, and how many rows those are."""
    return annotations.filter(F.size("member_row_ids") > 0).agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.size("member_row_ids")), F.lit(0)).alias("members"))


def uncovered(rows: DataFrame, annotations: DataFrame) -> DataFrame:
    """Rows that no annotation covers."""
    ids = covered_rows(annotations).select("doc_id", F.col("covered").alias("row_id")).distinct()
    return rows.join(ids, ["doc_id", "row_id"], "left_anti")
