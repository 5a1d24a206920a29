"""The control sheet: one line for each row, two annotation cells; written from annotations, read back, validated, gated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from . import grouping

STATUSES = ["proposed", "accepted", "edited", "rejected"]
TWICE = "slot filled twice: "
COLUMNS = ["row_id", "page", "form", "text_1", "text_2", "coord1", "coord2", "domain", "group", "anno1", "anno2", "note", "origin", "source", "review_status", "reviewed_by"]


def sheet(rows: DataFrame, annotations: DataFrame) -> DataFrame:
    """Every row's line: anno1 and anno2 on the anchor row, domain, group and status from the leading slot.

    annotations: doc_id, row_id, member_row_ids, slot, shown, domain, origin, group_id, source_model, review_status,
    reviewed_by, ord. A later annotation of a slot holds. Members other than the anchor show their group alone.
    """
    ids = F.when(F.size("member_row_ids") > 0, F.col("member_row_ids")).otherwise(F.array("row_id"))
    a = annotations.filter("row_id is not null").withColumn("_on", F.explode(ids)).withColumn("_anchor", F.col("_on") == F.col("row_id"))
    last = a.withColumn("_r", F.row_number().over(W.partitionBy("doc_id", "_on", "slot").orderBy(F.desc("ord")))).filter("_r = 1")
    text = lambda s: F.max(F.when((F.col("slot") == s) & F.col("_anchor"), F.col("shown")))
    lead = F.min(F.struct("slot", "domain", F.col("group_id").alias("group"), "origin", F.col("source_model").alias("source"), "review_status", "reviewed_by")).alias("_l")
    cells = last.groupBy("doc_id", F.col("_on").alias("row_id")).agg(text(1).alias("anno1"), text(2).alias("anno2"), lead)
    out = rows.join(cells, ["doc_id", "row_id"], "left")
    e = lambda c: F.coalesce(c, F.lit(""))
    coords = [(F.when(F.col(f"bbox_{k}").isNotNull(), G.rect_text(F.col(f"bbox_{k}"), 2, ", ")).otherwise("") if f"bbox_{k}" in rows.columns else F.lit("")).alias(f"coord{k}") for k in (1, 2)]
    return out.select("doc_id", "row_ord", "row_id", (F.col("page_index") + 1).alias("page"), "form", "text_1", "text_2", *coords, e("anno1").alias("anno1"), e("anno2").alias("anno2"), *[e(f"_l.{c}").alias(c) for c in ("domain", "group", "origin", "source")], F.coalesce("_l.review_status", F.lit("proposed")).alias("review_status"), e("_l.reviewed_by").alias("reviewed_by"))


def read_lines(lines: DataFrame) -> DataFrame:
    """Sheet lines as read: blank row_id skipped, blank status proposed, cells trimmed, excel_row kept."""
    trimmed = [F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in lines.columns if c not in ("doc_id", "excel_row")]
    out = lines.select("doc_id", "excel_row", *trimmed).filter("row_id <> ''")
    return out.withColumn("review_status", F.when(F.col("review_status") == "", "proposed").otherwise(F.lower("review_status")))


def slots(lines: DataFrame) -> DataFrame:
    """(doc_id, excel_row, row_id, slot, shown): the cells that are filled."""
    both = F.explode(F.array(F.struct(F.lit(1).alias("slot"), F.col("anno1").alias("shown")), F.struct(F.lit(2).alias("slot"), F.col("anno2").alias("shown")))).alias("c")
    return lines.select("doc_id", "excel_row", "row_id", both).select("doc_id", "excel_row", "row_id", "c.*").filter(F.trim("shown") != "")


def errors(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, row_id, error, n, excel_rows): rows that the form does not have, slots filled twice, unknown statuses and
    origins, and decisions without the name of who made them; excel_rows names the lines."""
    form = rows.select("doc_id", "row_id").distinct().withColumn("_known", F.lit(True))
    told = lines.join(form, ["doc_id", "row_id"], "left").withColumn("_lines", F.count("*").over(W.partitionBy("doc_id", "row_id")))
    is_so = lambda condition, error: F.when(condition, F.lit(error))
    filled = (F.col("anno1") != "") | (F.col("anno2") != "") | (F.col("note") != "")
    # a row of one line alone fills no slot twice; of the others a slot of one line is dropped below
    slot = [is_so((F.col("_lines") > 1) & (F.trim(f"anno{k}") != ""), f"{TWICE}{k}") for k in (1, 2)]
    coords = [is_so((F.col(c) != "") & G.parse_rect(F.col(c)).isNull(), f"no rectangle in {c}") for c in ("coord1", "coord2") if c in lines.columns]
    found = F.array(
        is_so(F.col("_known").isNull(), "unknown row"), *slot, is_so(~F.col("review_status").isin(STATUSES), "unknown status"),
        is_so((F.col("origin") != "") & T.coerce(F.col("origin"), T.ORIGINS).isNull(), "unknown origin"),
        is_so(filled & F.col("review_status").isin(STATUSES[1:]) & (F.col("reviewed_by") == ""), "reviewed by nobody"), *coords,
    )
    each = told.select("doc_id", "row_id", F.col("excel_row").cast("long").alias("excel_row"), F.explode(F.array_compact(found)).alias("error"))
    out = each.groupBy("doc_id", "row_id", "error").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("excel_row")), ", ").alias("excel_rows"))
    return out.filter(~F.col("error").startswith(TWICE) | (F.col("n") > 1)).select("doc_id", "row_id", "n", "excel_rows", "error")


def to_annotations(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """Filled cells of known rows as annotations, and notes beside them.

    A note takes the slot after the last one that is filled, 2 at most. It is a note if it stands alone or after slot 2,
    and a variable if it takes the free slot 2. A text stands verbatim; what it parses to is told beside it, for notes too.
    """
    cells = slots(lines).withColumn("kind", F.lit("variable"))
    last = F.when(F.col("anno2") != "", 2).when(F.col("anno1") != "", 1).otherwise(0)
    kind = F.when(last == 1, "variable").otherwise("note")
    notes = lines.filter("note <> ''").select("doc_id", "excel_row", "row_id", F.least(F.lit(2), last + 1).alias("slot"), F.col("note").alias("shown"), kind.alias("kind"))
    known = cells.unionByName(notes).join(rows.select("doc_id", "row_id", "row_ord", "page_index"), ["doc_id", "row_id"])
    parsed = known.withColumn("_p", T.parse_mapping(F.col("shown")))
    more = lines.select("doc_id", "excel_row", F.col("domain").alias("_d"), F.col("group").alias("group_id"), T.coerce(F.col("origin"), T.ORIGINS).alias("origin"), "review_status", "reviewed_by")
    out = parsed.join(more, ["doc_id", "excel_row"])
    return out.select(
        "doc_id", "row_id", "row_ord", "page_index", "slot", "kind", "shown", F.coalesce("_p.domain", T.or_null(F.upper("_d"))).alias("domain"), F.col("_p.variable").alias("variable"),
        F.col("_p.condition").alias("condition"), F.col("_p.fixed_value").alias("fixed_value"), T.or_null(F.col("group_id")).alias("group_id"), "origin", "review_status", "reviewed_by",
    )


def gate(annotations: DataFrame) -> DataFrame:
    """(doc_id, proposed, rejected, total, open): whether a document may be drawn: no annotation is still only proposed."""
    g = annotations.groupBy("doc_id").agg(F.count_if(F.col("review_status") == "proposed").alias("proposed"), F.count_if(F.col("review_status") == "rejected").alias("rejected"), F.count("*").alias("total"))
    return g.withColumn("open", F.col("proposed") == 0)


def reviewed(lines: DataFrame) -> DataFrame:
    """(doc_id, reviewed, row_id, excel_row, open): whether a sheet may be written anew: no line of it is decided on.

    lines are read_lines(); reviewed counts decided ones, and row_id and excel_row name the first.
    """
    decided = F.when(~F.col("review_status").isin("", STATUSES[0]), F.struct("excel_row", "row_id"))
    out = lines.groupBy("doc_id").agg(F.count(decided).alias("reviewed"), F.min(decided).alias("_f"))
    return out.select("doc_id", "reviewed", "_f.row_id", "_f.excel_row", (F.col("reviewed") == 0).alias("open"))


def folded(lines: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(annotations, errors): a sheet's annotations with its groups made one, and the groups' errors with their lines.

    A text is typed on any row of a group; the group's key stands on every row.
    """
    keys = lines.filter("`group` <> ''").select("doc_id", "row_id", F.col("group").alias("key"))
    given = to_annotations(lines, rows).withColumn("group_id", F.lit(None).cast("string"))
    out, wrong = grouping.resolve_groups(given, rows, grouping.row_membership(keys))
    at = lines.select("doc_id", "row_id", F.col("group").alias("_key"), "excel_row")
    hit = (F.col("row_id").isNull() & (F.col("_key") == F.col("key"))) | (F.col("_row") == F.col("row_id"))
    named = wrong.join(at.withColumnRenamed("row_id", "_row"), "doc_id").filter(hit)
    return out, named.groupBy("doc_id", "key", "slot", "error", "row_id").agg(F.array_join(F.array_sort(F.collect_set(F.col("excel_row").cast("long"))), ", ").alias("excel_rows"))


def submittable(annotations: DataFrame) -> DataFrame:
    return annotations.filter("review_status <> 'rejected'")


def merged(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both, none dropped."""
    return existing.unionByName(new, allowMissingColumns=True)


SLOT = ["doc_id", "row_id", "slot"]


def merge(sent: DataFrame, returned: DataFrame, new: DataFrame) -> DataFrame:
    """Three sheets as one, cell by cell: as it was sent, as it came back, and as it would be written now.

    Each is (doc_id, row_id, slot, shown, review_status, reviewed_by), a row for each filled cell; of a cell that is filled
    twice the first text in order holds. Gives doc_id, row_id, slot, shown, review_status, reviewed_by, taken (returned or
    new) and conflict (null, or what both sides did).

    A decision is never lost: a cell that is decided on, written, changed or cleared since it was sent stands as it came
    back, and where the new text would have been another, the row says so. Every other cell is as it would be now, and is
    proposed. A cleared cell has no row unless that conflicts; it then has no text.
    """

    def cells(df: DataFrame, pre: str) -> DataFrame:
        first = df.filter(F.trim("shown") != "").groupBy(*SLOT).agg(F.min(F.struct("shown", "review_status", "reviewed_by")).alias(pre))
        return first.select(*[F.col(c).alias(f"{pre}_{c}") for c in SLOT], pre)

    was, came, now = cells(sent, "_was"), cells(returned, "_came"), cells(new, "_now")
    key = lambda *pres: [F.coalesce(*[F.col(f"{p}_{c}") for p in pres]) for c in SLOT]
    on = lambda left, right: [a.eqNullSafe(F.col(f"{right}_{c}")) for a, c in zip(key(*left), SLOT, strict=True)]
    every = was.join(came, on(["_was"], "_came"), "full").join(now, on(["_was", "_came"], "_now"), "full")
    shown = {p: F.col(f"{p}.shown") for p in ("_was", "_came", "_now")}
    decided = F.coalesce(F.col("_came.review_status").isin(STATUSES[1:]), F.lit(False))
    touched = decided | ~shown["_came"].eqNullSafe(shown["_was"])
    moved = ~shown["_now"].eqNullSafe(shown["_was"]) & ~shown["_now"].eqNullSafe(shown["_came"])
    did = F.when(shown["_came"].isNull(), "cleared").when(decided, F.col("_came.review_status")).when(shown["_was"].isNull(), "written").otherwise("changed")
    then = F.when(shown["_now"].isNull(), "no longer proposed").when(shown["_was"].isNull(), "proposed otherwise").otherwise("proposed anew")
    out = every.select(
        *[k.alias(c) for k, c in zip(key("_was", "_came", "_now"), SLOT, strict=True)], F.when(touched, shown["_came"]).otherwise(shown["_now"]).alias("shown"),
        F.when(touched, F.coalesce("_came.review_status", F.lit(STATUSES[0]))).otherwise(STATUSES[0]).alias("review_status"), F.when(touched, F.coalesce("_came.reviewed_by", F.lit(""))).otherwise("").alias("reviewed_by"),
        F.when(touched, "returned").otherwise("new").alias("taken"), F.when(touched & moved, F.concat_ws(", ", did, then)).alias("conflict"),
    )
    return out.filter("shown is not null or conflict is not null")
