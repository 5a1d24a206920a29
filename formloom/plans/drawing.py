"""Queries of what is asked, drawn and looked up: batches, legends, brackets, marks and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import draw, extract, grouping, layout, precedent, prompt, recover, reply, review, style
from ..sources import tables, xfdf
from ..sources.stage import staged
from . import testbed
from .queries import LINES, add, resolved, sheet_lines

WIDTH, HEIGHT = testbed.WIDTH, testbed.HEIGHT


@add("domain_table", "", """
WITH v AS (SELECT 'V' || l_suppkey % 40 AS variable, l_returnflag || l_linestatus AS domain,
 sum(CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE l_quantity::BIGINT END) AS n FROM lineitem GROUP BY ALL)
SELECT variable, arg_min(domain, (-n, domain)) AS domain FROM v GROUP BY variable""")
def domain_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a lookup file's rows: every third count is no number."""
    li = testbed.read(spark, sf_dir, "lineitem")
    count = F.when(F.col("l_linenumber") % 3 == 0, "many").otherwise(F.col("l_quantity").cast("long").cast("string"))
    look = li.select(F.concat(F.lit("V"), F.col("l_suppkey") % 40).alias("variable"), F.concat("l_returnflag", "l_linestatus").alias("domain"), count.alias("count"))
    return precedent.domain_table(look)


@add("forms_in_order", "rows", """
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY f) AS place, form FROM (
 SELECT doc_id, form, min(row_ord) AS f FROM rows WHERE form <> '' GROUP BY ALL)""")
def forms_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.forms_in_order(testbed.crf_rows(spark, sf_dir))


@add("page_counts", "rows", """
SELECT doc_id, page_index, count(*) FILTER (WHERE text_2 <> '') AS n FROM rows GROUP BY ALL""")
def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a response, of all pages."""
    rows = testbed.crf_rows(spark, sf_dir)
    return prompt.page_counts(rows.filter("text_2 <> ''"), rows)


@add("rows_looked_up", "rows", """
SELECT w.doc_id, w.row_id, r.row_ord, r.text_1 FROM (
 SELECT doc_id, 'p1_r' || lpad(k::VARCHAR, 3, '0') AS row_id FROM documents, (SELECT unnest([1, 2, 999]) AS k)) w LEFT JOIN rows r USING (doc_id, row_id)
UNION ALL SELECT doc_id, row_id, row_ord, text_1 FROM rows WHERE page_index % 3 = 1""")
def rows_looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ids of each document, one of which no form has; and the rows of every third page."""
    rows = testbed.crf_rows(spark, sf_dir)
    ids = testbed.read(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(999))).alias("k"))
    told = prompt.by_id(rows, ids.select("doc_id", F.format_string("p1_r%03d", "k").alias("row_id")))
    pages = rows.select("doc_id", "page_index").distinct().filter("page_index % 3 = 1")
    columns = ["doc_id", "row_id", "row_ord", "text_1"]
    return told.select(*columns).unionByName(prompt.on_pages(rows, pages).select(*columns))


@add("row_context", "rows", """
SELECT doc_id, row_id, concat_ws('; ', CASE WHEN form <> '' THEN 'form: ' || form END, CASE WHEN text_2 <> '' THEN 'response: ' || text_2 END) AS context FROM rows""")
def row_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.crf_rows(spark, sf_dir).select("doc_id", "row_id", recover.row_context(F.col("form"), F.col("text_2")).alias("context"))


@add("counterparts", "", """
SELECT 'annotated/' || p_partkey || '.pdf' AS doc_id, CASE WHEN p_partkey <= (SELECT max(s_suppkey) FROM supplier) THEN 'blank/' || p_partkey || '.pdf' END AS blank_id FROM part""")
def counterparts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as annotated files, suppliers as blank ones."""
    name = lambda folder, c: F.concat(F.lit(f"{folder}/"), F.col(c), F.lit(".pdf")).alias("doc_id")
    return tables.counterparts(testbed.read(spark, sf_dir, "part").select(name("annotated", "p_partkey")), testbed.read(spark, sf_dir, "supplier").select(name("blank", "s_suppkey")))


@add("sheets_reviewed", "", f"""
WITH l AS ({LINES}), d AS (SELECT * FROM l WHERE lower(review_status) NOT IN ('', 'proposed'))
SELECT l.doc_id, count(d.doc_id) AS reviewed, arg_min(d.row_id, (d.excel_row, d.row_id)) AS row_id, min(d.excel_row) AS excel_row, count(d.doc_id) = 0 AS open
FROM l LEFT JOIN d ON d.doc_id = l.doc_id AND d.excel_row = l.excel_row GROUP BY l.doc_id""")
def sheets_reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.reviewed(sheet_lines(spark, sf_dir)[0])


@add("resolve_again", "resolved", "SELECT * FROM resolved")
def resolve_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations that say their groups themselves resolve to what they are."""
    rows = staged(testbed.rows(spark, sf_dir).drop("text_1", "text_2", "band"))
    once = staged(resolved(spark, sf_dir, rows)[0].withColumns({"domain": T.or_null(F.col("domain")), "origin": T.or_null(F.col("origin"))}))
    out = grouping.resolve_groups(once, rows)[0]
    return out.select("doc_id", "row_id", "slot", "page_index", "kind", "domain", "shown", "group_id", F.array_join("member_row_ids", ",").alias("members"))


@add("obstacles", "runs", f"SELECT doc_id, page_index, x0, {HEIGHT} - y1 AS y0, x1, {HEIGHT} - y0 AS y1 FROM runs")
def obstacles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.obstacles(testbed.runs(spark, sf_dir), HEIGHT)


@add("draw_marks", "annotations colored", """
SELECT a.doc_id, a.row_id, a.slot, CASE WHEN color IS NOT NULL THEN 0.0 WHEN kind = 'note' THEN 0.2 ELSE 0.8 END::DOUBLE AS r,
 CASE WHEN color IS NOT NULL THEN 0.0 WHEN kind = 'note' THEN 0.2 ELSE 0.05 END::DOUBLE AS g, CASE WHEN color IS NOT NULL OR kind = 'note' THEN 1.0 ELSE 0.0 END::DOUBLE AS border_width,
 CASE WHEN kind = 'note' THEN 3 END AS dash, ('0x' || substr(color, 2, 2))::INT AS fill_r
FROM annotations a JOIN colored c ON c.doc_id = a.doc_id AND c.row_id = a.row_id AND c.slot = a.slot""")
def draw_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testbed.crf_rows(spark, sf_dir)
    colored = style.apply_colors(staged(testbed.annotations(rows).drop("form")), rows).withColumn("fill", T.parse_hex(F.col("color")))
    out = draw.marks(colored)
    return out.select("doc_id", "row_id", "slot", "text_color.r", "text_color.g", "border_width", "dash", F.col("fill.r").alias("fill_r"))


@add("group_brackets", "anchored", f"""
, b AS (SELECT doc_id, page_index, row_ord // 5 AS k, max(ax1) AS x1, min(ay0) AS y0, max(ay1) AS y1 FROM anchored GROUP BY ALL),
x AS (SELECT *, greatest(x1 + 2, x1 + (k % 3) * 20 - 10 - 5) AS x FROM b WHERE k % 3 > 0)
SELECT doc_id, page_index, k, unnest([0, 1, 2, 3]) AS point, unnest([x + 3, x, x, x + 3]) AS x, unnest([{HEIGHT} - y1, {HEIGHT} - y1, {HEIGHT} - y0, {HEIGHT} - y0]) AS y FROM x""")
def group_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of five rows with a box before, close behind or far behind their right edge; before it there is no bracket."""
    a = testbed.anchored(testbed.crf_rows(spark, sf_dir)).withColumn("group_id", F.floor(F.col("row_ord") / 5))
    b = a.groupBy("doc_id", "page_index", "group_id").agg(F.max("anchor.x1").alias("x1"), F.min("anchor.y0").alias("y0"), F.max("anchor.y1").alias("y1"))
    x = F.col("x1") + F.col("group_id") % 3 * 20 - 10
    box = lambda x0: F.struct(x0.alias("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    g = b.select("doc_id", "page_index", "group_id", box(F.lit(0.0)).alias("block"), box(x).alias("bbox"), F.lit(HEIGHT).alias("height"))
    out = draw.brackets(g).select("doc_id", "page_index", F.col("group_id").alias("k"), F.posexplode("points_down").alias("point", "p"))
    return out.select("doc_id", "page_index", "k", "point", "p.x", "p.y")


@add("legend_boxes", "rows runs", """
, o AS (SELECT doc_id, page_index, greatest(2.0, min(y0) - 17) AS y FROM runs GROUP BY ALL),
r AS (SELECT doc_id, page_index, row_ord, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY row_ord) - 1 AS k FROM rows)
SELECT doc_id, page_index, row_ord AS place, round(36 + (k % 15) * 34.24, 3) AS x0, round(y + (k // 15) * 17, 3) AS y0, round(36 + (k % 15) * 34.24 + 30.24, 3) AS x1 FROM r JOIN o USING (doc_id, page_index)""")
def legend_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A legend entry of five digits for each row of a page, all as wide: fifteen fit a line."""
    rows = testbed.crf_rows(spark, sf_dir)
    entries = rows.select("doc_id", "page_index", F.col("row_ord").alias("place"), F.format_string("%05d", F.col("row_ord").cast("int")).alias("text"), F.lit("#FFFFFF").alias("fill"))
    origins = draw.legend_origins(testbed.runs(spark, sf_dir), rows)
    at = lambda c: F.round(c, 3).alias(c)
    return draw.legends(entries, origins, WIDTH).select("doc_id", "page_index", "place", at("x0"), at("y0"), at("x1"))


@add("stamp_counts", "annotations", """
SELECT doc_id, count(*) FILTER (WHERE row_ord % 6 <> 0) AS drawn, count(*) FILTER (WHERE row_ord % 6 <> 0 AND slot = 2) AS suggested FROM annotations GROUP BY doc_id""")
def stamp_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = testbed.annotations(testbed.crf_rows(spark, sf_dir))
    return draw.stamp(a.withColumns({"review_status": F.when(F.col("row_ord") % 6 == 0, "rejected").otherwise(F.col("review_status")), "suggested": F.col("slot") == 2}))


@add("exchange_marks", "annotations", """
SELECT doc_id, 'a' || ord AS name, shown, NULL AS error FROM annotations WHERE page_index % 4 <> 3
UNION ALL SELECT doc_id, 'a' || ord, NULL, 'no page ' || (page_index + 1) FROM annotations WHERE page_index % 4 = 3
UNION ALL SELECT doc_id, NULL, NULL, 'no annotations' FROM (SELECT DISTINCT doc_id FROM anchored WHERE page_index % 4 <> 3) WHERE doc_id NOT IN (SELECT doc_id FROM annotations)""")
def exchange_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations through exchange files, onto forms that lack every fourth page."""
    rows = testbed.crf_rows(spark, sf_dir)
    box = F.struct(F.col("x0"), (F.col("y1") - 11).alias("y0"), (F.col("x0") + 40).alias("x1"), F.col("y1"))
    a = testbed.annotations(rows).withColumns({"bbox": box, "annot_id": F.concat(F.lit("a"), "ord"), "color": F.lit(None).cast("string")})
    found = xfdf.parse(staged(xfdf.texts(a))).withColumn("kind", F.lit("variable"))
    marks, errors = draw.exchanged(staged(found), rows.filter("page_index % 4 <> 3").select("doc_id", "page_index"))
    null = F.lit(None).cast("string")
    return marks.select("doc_id", "name", "shown", null.alias("error")).unionByName(errors.withColumn("shown", null))


@add("overlay_boxes", "rows gutters", """
SELECT doc_id, page_index, CASE WHEN gutter IS NULL THEN 'one_column' ELSE 'gutter' END AS what, NULL AS label, gutter AS x0, gutter AS x1 FROM gutters
UNION ALL SELECT doc_id, page_index, CASE WHEN full_width THEN 'spans' ELSE 'column_1' END, split_part(row_id, '_', 2), bbox_1_x0, bbox_1_x1 FROM rows WHERE bbox_1_x0 IS NOT NULL
UNION ALL SELECT doc_id, page_index, 'column_2', split_part(row_id, '_', 2), bbox_2_x0, bbox_2_x1 FROM rows WHERE bbox_2_x0 IS NOT NULL""")
def overlay_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = staged(testbed.runs(spark, sf_dir))
    pages = extract.page_gutters(run, run.select("doc_id", "page_index").distinct(), F.lit(WIDTH)).withColumnRenamed("gutter", "gutter_x")
    out = draw.overlay(testbed.crf_rows(spark, sf_dir), pages.withColumns({"width": F.lit(WIDTH), "height": F.lit(HEIGHT)}))
    label = F.when(F.col("row_id").isNotNull(), F.col("label"))
    return out.select("doc_id", "page_index", "what", label.alias("label"), "bbox.x0", "bbox.x1")


@add("batch_manifest", "rows", """
, p AS (SELECT doc_id, page_index, count(*) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY page_index) AS k FROM rows GROUP BY doc_id, page_index),
b AS (SELECT doc_id, k, page_index, n, n AS held, 1 AS batch FROM p WHERE k = 1 UNION ALL SELECT p.doc_id, p.k, p.page_index, p.n, CASE WHEN b.held + p.n > 60 THEN p.n ELSE b.held + p.n END,
 CASE WHEN b.held + p.n > 60 THEN b.batch + 1 ELSE b.batch END FROM b JOIN p ON p.doc_id = b.doc_id AND p.k = b.k + 1),
m AS (SELECT doc_id, batch, sum(n)::BIGINT AS rows, min(page_index) + 1 AS a, max(page_index) + 1 AS z FROM b GROUP BY ALL)
SELECT doc_id, batch, rows, 'copilot_batch' || batch || '_sheet.csv' AS sheet, rows + 1 AS lines,
 'Batch ' || batch || ' of ' || max(batch) OVER (PARTITION BY doc_id) || ': ' || CASE WHEN a = z THEN 'page ' || a ELSE 'pages ' || a || '-' || z END || ', ' || rows || ' rows.' AS says FROM m""")
def batch_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes out for each document at 60 rows a batch; texts here have no line ends, so a sheet has a line for each row."""
    files = prompt.batch_files(testbed.crf_rows(spark, sf_dir), 60)
    lines = (F.length("sheet_text") - F.length(F.translate("sheet_text", "\n", "")) + 1).cast("long")
    return files.select("doc_id", "batch", "rows", "sheet", lines.alias("lines"), F.substring_index("instructions_text", "\n", 1).alias("says"))
