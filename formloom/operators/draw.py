"""What a drawing step would put on a page, as tables: marks, legends, brackets and overlays, and what is refused.

Marks are annotations apart from the page's own content and stay so: no row here says to flatten them, and none carries a
callout line. Boxes are y up unless a name says that they are y down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T

PAGE = ["doc_id", "page_index"]
#: Inks as shares of red, green and blue, border and dash, the bracket's arm, gap and width, and the legend's measures.
INK, NOTE_INK, PLAIN_INK = (0.0, 0.0, 0.0), (0.20, 0.20, 0.20), (0.80, 0.05, 0.05)
BORDER_WIDTH, DASH = 1.0, 3
BRACKET_ARM, BRACKET_GAP, BRACKET_WIDTH = 3.0, 2.0, 0.75
LEGEND_X, LEGEND_TOP, LEGEND_HEIGHT, LEGEND_GAP, LEGEND_FONT, BELOW_BANNER = 36.0, 2.0, 13.0, 4.0, 8.0, 14.0


def ink(rgb: tuple[float, float, float]) -> Column:
    return F.struct(*[F.lit(v).alias(c) for c, v in zip("rgb", rgb, strict=True)])


def flag(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False)) if name in df.columns else F.lit(False)


def marks(annotations: DataFrame) -> DataFrame:
    """annotations with text_color, border_width and dash (a length, null for a solid border).

    annotations: shown, fill (struct r, g, b from 0 to 255, or null), kind, and muted and bordered if they have them. A
    filled mark reads in black, a note or muted one in grey, any other in red. Filled and dashed marks have a border, so
    that a plain one is not taken for a banner when it is read back. Notes are dashed.
    """
    filled, dashed = F.col("fill").isNotNull(), F.coalesce(F.col("kind") == "note", F.lit(False))
    color = F.when(filled, ink(INK)).when(dashed | flag(annotations, "muted"), ink(NOTE_INK)).otherwise(ink(PLAIN_INK))
    bordered = filled | dashed
    if "bordered" in annotations.columns:
        bordered = F.coalesce("bordered", bordered)
    return annotations.withColumns({"text_color": color, "border_width": F.when(bordered, BORDER_WIDTH).otherwise(0.0), "dash": F.when(dashed, DASH)})


def brackets(groups: DataFrame) -> DataFrame:
    """groups (block, bbox) with points_down: the four points, y down on a page of `height`, of the bracket that spans the block.

    Groups whose box does not stand right of the block, or whose block has no height, have none.
    """
    x = F.greatest(F.col("block.x1") + BRACKET_GAP, F.col("bbox.x0") - BRACKET_ARM - BRACKET_GAP)
    top, bottom = F.col("height") - F.col("block.y1"), F.col("height") - F.col("block.y0")
    points = F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((x + BRACKET_ARM, top), (x, top), (x, bottom), (x + BRACKET_ARM, bottom))])
    beside = (F.col("block.y1") > F.col("block.y0")) & (F.col("bbox.x0") > F.col("block.x1"))
    return groups.filter(beside).withColumns({"points_down": points, "line_width": F.lit(BRACKET_WIDTH), "color": ink(NOTE_INK)})


def legend_origins(runs: DataFrame, pages: DataFrame, least: float = LEGEND_TOP) -> DataFrame:
    """(doc_id, page_index, x, y), y down: above the topmost printed run (y0 down) of each page, but no higher than `least`."""
    top = runs.groupBy(*PAGE).agg(F.min("y0").alias("_top"))
    y = F.greatest(F.lit(least), F.coalesce(F.col("_top") - LEGEND_HEIGHT - LEGEND_GAP, F.lit(least)))
    return pages.select(*PAGE).distinct().join(top, PAGE, "left").select(*PAGE, F.lit(LEGEND_X).alias("x"), y.alias("y"))


def legends(domains: DataFrame, origins: DataFrame, width: float = 612.0) -> DataFrame:
    """(doc_id, page_index, place, text, fill, x0, y0, x1, y1), y down: a page's domains from left to right, in lines.

    domains: doc_id, page_index, place, text, fill. A box opens the next line if it would pass the page's width, unless
    it is the line's first. A page's domains bound the array that the running place is folded over.
    """
    told = domains.withColumn("w", G.text_width(F.col("text"), LEGEND_FONT) + 2 * LEGEND_GAP)
    one = told.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("place", "text", "fill", "w"))).alias("_d")).join(origins, PAGE)
    zero = F.struct(F.lit(0.0).alias("at"), F.lit(0.0).alias("down"), F.expr("cast(array() as array<struct<k:int,x:double,y:double>>)").alias("out"))
    limit = F.lit(width) - 2 * F.col("x")  # from the origin on

    def add(acc: Column, d: Column) -> Column:
        fresh = (acc["at"] > 0) & (acc["at"] + d["w"] > limit)
        at, down = F.when(fresh, 0.0).otherwise(acc["at"]), acc["down"] + F.when(fresh, LEGEND_HEIGHT + LEGEND_GAP).otherwise(0.0)
        placed = F.struct(F.size(acc["out"]).alias("k"), at.alias("x"), down.alias("y"))
        return F.struct((at + d["w"] + LEGEND_GAP).alias("at"), down.alias("down"), F.concat(acc["out"], F.array(placed)).alias("out"))

    flow = one.withColumn("_o", F.aggregate("_d", zero, add, lambda acc: acc["out"])).select(*PAGE, "x", "y", F.explode(F.arrays_zip("_d", "_o")).alias("z"))
    x0, y0 = F.col("x") + F.col("z._o.x"), F.col("y") + F.col("z._o.y")
    return flow.select(*PAGE, "z._d.place", "z._d.text", "z._d.fill", x0.alias("x0"), y0.alias("y0"), (x0 + F.col("z._d.w")).alias("x1"), (y0 + LEGEND_HEIGHT).alias("y1"))


def drawn(annotations: DataFrame) -> DataFrame:
    """The annotations that are drawn: neither rejected nor without text."""
    return annotations.filter("review_status <> 'rejected' and coalesce(shown, '') <> ''")


def stamp(annotations: DataFrame) -> DataFrame:
    """(doc_id, drawn, suggested): what a check copy's banner tells of each document, those with nothing drawn too."""
    is_drawn = (F.col("review_status") != "rejected") & (F.coalesce("shown", F.lit("")) != "")
    return annotations.groupBy("doc_id").agg(F.count_if(is_drawn).alias("drawn"), F.count_if(is_drawn & F.coalesce("suggested", F.lit(False))).alias("suggested"))


def exchanged(found: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(marks, errors) of annotations read from exchange files (xfdf.parse(): doc_id, page_index, name, color, contents, kind).

    pages: doc_id, page_index of the forms. What a file holds is drawn as it stands; texts that are empty are not drawn.
    errors (doc_id, name, error): annotations on pages that the form lacks, and forms whose file has no annotation.
    """
    there = pages.select("doc_id", "page_index", F.lit(True).alias("_there")).distinct()
    on = found.join(there, ["doc_id", "page_index"], "left")
    lacks = on.filter("_there is null").select("doc_id", "name", F.concat(F.lit("no page "), F.col("page_index") + 1).alias("error"))
    none = there.select("doc_id").distinct().join(found.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", F.lit(None).cast("string").alias("name"), F.lit("no annotations").alias("error"))
    good = on.filter("_there and coalesce(contents, '') <> ''").drop("_there").withColumn("fill", T.parse_hex(F.col("color"))).withColumnRenamed("contents", "shown")
    return marks(good), lacks.unionByName(none)


def overlay(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page_index, what, row_id, label, bbox): what a look at the extraction shows: gutters, halves and row names.

    pages: doc_id, page_index, width, height, gutter_x. A page of one column says so. `what` is gutter, one_column, column_1,
    column_2 or spans.
    """
    null = F.lit(None).cast("string")
    gutter = F.when(F.col("gutter_x").isNotNull(), G.box(F.col("gutter_x"), F.lit(0.0), F.col("gutter_x"), F.col("height")))
    label = F.coalesce(F.format_string("gutter x=%.1f", "gutter_x"), F.lit("one column"))
    p = pages.select(*PAGE, F.when(F.col("gutter_x").isNotNull(), "gutter").otherwise("one_column").alias("what"), null.alias("row_id"), label.alias("label"), gutter.alias("bbox"))
    half = lambda c, what: rows.filter(F.col(c).isNotNull()).select(*PAGE, what.alias("what"), "row_id", F.substring_index("row_id", "_", -1).alias("label"), F.col(c).alias("bbox"))
    return p.unionByName(half("bbox_1", F.when(F.col("full_width"), "spans").otherwise("column_1"))).unionByName(half("bbox_2", F.lit("column_2")))
