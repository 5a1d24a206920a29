"""The same relations in DuckDB's SQL, as named steps that a query's SQL strings together."""

from __future__ import annotations

WIDTH, HEIGHT = 612.0, 792.0

STEPS: dict[str, tuple[list[str], str]] = {}


RECURSIVE: set[str] = set()


def step(name: str, needs: str, text: str, recursive: bool = False) -> None:
    STEPS[name] = (needs.split(), text)
    if recursive:
        RECURSIVE.add(name)


def query(needs: str, final: str) -> str:
    """The final select after all steps that it needs."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in STEPS[name][0]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs.split():
        add(n)
    head = ", ".join(f"{n} AS {'' if n in RECURSIVE else 'MATERIALIZED '}({STEPS[n][1].strip()})" for n in order)
    return f"WITH RECURSIVE {head} {final.strip()}" if order else final.strip()


step("t_lines", "", "SELECT doc_id, ln, list_filter(string_split(string_split(coalesce(text, ''), chr(10))[ln], ' '), lambda x: x <> '') AS w FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS ln FROM documents)")
step("t_tens", "t_lines", "SELECT doc_id, ln, k, w[k * 10 + 1:k * 10 + 10] AS w FROM (SELECT doc_id, ln, w, unnest(range(0, (greatest(len(w), 1) - 1) // 10 + 1)) AS k FROM t_lines)")
step("t_vis", "t_tens", "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ln, k) - 1 AS line_no, w FROM t_tens")
step("t_words", "t_vis", "SELECT doc_id, line_no, i - 1 AS word_no, w[i] AS word, (i > 6 AND line_no % 3 <> 1) AS col2 FROM (SELECT doc_id, line_no, w, unnest(range(1, len(w) + 1)) AS i FROM t_vis)")
step("words", "t_words", """
SELECT doc_id, page_index, line_no, word_no, x0, y0, x0 + 5 * length(word) AS x1, y0 + 10 AS y1, word, block FROM (
 SELECT *, CAST(line_no // 40 AS INT) AS page_index, CAST((line_no + CASE WHEN line_no % 8 = 5 THEN word_no % 3 * 3 WHEN line_no % 4 = 1 THEN word_no % 3 ELSE 0 END) // 3 AS INT) AS block, CAST(30 + 14 * (line_no % 40) AS DOUBLE) AS y0,
  CAST(CASE WHEN col2 THEN 400 ELSE 90 END + coalesce(sum(5 * length(word) + 3) OVER (PARTITION BY doc_id, line_no, col2 ORDER BY word_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS x0
 FROM t_words)""")
step("t_cut", "words", """
SELECT *, sum(CASE WHEN x0 - px > greatest(3.0, 0.6 * h) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, line_no ORDER BY x0, word_no ROWS UNBOUNDED PRECEDING) AS run_no
FROM (SELECT *, max(x1) OVER (PARTITION BY doc_id, line_no ORDER BY x0, word_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS px,
 max(y1) OVER (PARTITION BY doc_id, line_no) - min(y0) OVER (PARTITION BY doc_id, line_no) AS h FROM words)""")
step("runs", "t_cut", "SELECT doc_id, page_index, line_no, CAST(run_no AS INT) AS run_no, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, string_agg(word, ' ' ORDER BY x0, word_no) AS text, list_sort(list(DISTINCT block)) AS blocks, count(DISTINCT block) AS n_blocks FROM t_cut GROUP BY ALL")
step("t_narrow", "runs", f"SELECT * FROM runs WHERE x1 - x0 <= 0.6 * {WIDTH}")
step("t_spans", "t_narrow", "SELECT doc_id, page_index, text_x0, span, text_x0 + 0.3 * span AS lo, text_x0 + 0.9 * span AS hi FROM (SELECT doc_id, page_index, min(x0) AS text_x0, max(x1) - min(x0) AS span, count(*) AS n FROM t_narrow GROUP BY ALL) WHERE n >= 4 AND span > 8")
step("t_edges", "t_narrow t_spans", """
SELECT doc_id, page_index, lo, greatest(lo, x0) AS a, least(hi, x1) AS b FROM t_narrow JOIN t_spans USING (doc_id, page_index) WHERE x1 > lo AND x0 < hi
UNION ALL SELECT doc_id, page_index, lo, hi, hi FROM t_spans""")
step("free", "t_edges", "SELECT doc_id, page_index, a, b FROM (SELECT doc_id, page_index, greatest(lo, coalesce(max(b) OVER (PARTITION BY doc_id, page_index ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo)) AS a, a AS b FROM t_edges) WHERE b > a")
step("clusters", "t_narrow t_spans", """
SELECT doc_id, page_index, x0 - 2 AS gutter FROM (
 SELECT doc_id, page_index, x0, n, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY n DESC, c) AS r FROM (
  SELECT doc_id, page_index, c, count(*) AS n, min(x0) AS x0 FROM (
   SELECT *, sum(fresh) OVER (PARTITION BY doc_id, page_index ORDER BY x1, line_no, run_no ROWS UNBOUNDED PRECEDING) AS c FROM (
    SELECT *, CASE WHEN x1 - lag(x1) OVER (PARTITION BY doc_id, page_index ORDER BY x1, line_no, run_no) <= 4 THEN 0 ELSE 1 END AS fresh
    FROM t_narrow JOIN t_spans USING (doc_id, page_index) WHERE x1 >= text_x0 + 0.55 * span)) GROUP BY ALL)) WHERE r = 1 AND n >= 3""")
step("own_gutters", "free t_narrow t_spans clusters", """
SELECT doc_id, page_index, coalesce(c.g, CASE WHEN k.gutter BETWEEN s.lo AND s.hi THEN k.gutter END) AS gutter FROM t_spans s
LEFT JOIN (SELECT doc_id, page_index, g FROM (
  SELECT doc_id, page_index, g, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY b - a DESC, a) AS r FROM (
   SELECT f.doc_id, f.page_index, a, b, (a + b) / 2 AS g, count(*) FILTER (WHERE x1 <= (a + b) / 2) AS l, count(*) FILTER (WHERE x1 > (a + b) / 2) AS r
   FROM free f JOIN t_narrow n ON f.doc_id = n.doc_id AND f.page_index = n.page_index WHERE b - a >= 8 GROUP BY ALL) WHERE l >= 2 AND r >= 2) WHERE r = 1) c USING (doc_id, page_index)
LEFT JOIN clusters k USING (doc_id, page_index) WHERE coalesce(c.g, CASE WHEN k.gutter BETWEEN s.lo AND s.hi THEN k.gutter END) IS NOT NULL""")
step("pages", "words", "SELECT DISTINCT doc_id, page_index FROM words")
step("gutters", "pages own_gutters t_narrow", """
SELECT p.doc_id, p.page_index, coalesce(o.gutter, f.m) AS gutter FROM pages p LEFT JOIN own_gutters o USING (doc_id, page_index) LEFT JOIN (
 SELECT n.doc_id, n.page_index, m FROM t_narrow n JOIN (SELECT doc_id, median(gutter) AS m FROM own_gutters GROUP BY 1) USING (doc_id)
 GROUP BY ALL HAVING count(*) FILTER (WHERE x1 <= m) >= 2 AND count(*) FILTER (WHERE x0 >= m) >= 2) f USING (doc_id, page_index)""")
step("lines", "runs", "SELECT doc_id, page_index, line_no, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM runs GROUP BY ALL")
step("bands", "lines", f"""
SELECT doc_id, page_index, line_no, x0, y0, x1, y1, coalesce(e, greatest(0.0, y0 - pad)) AS top, coalesce(lead(e) OVER p, least({HEIGHT}, y1 + pad)) AS bottom FROM (
 SELECT *, CASE WHEN plo >= hi THEN (plo + hi) / 2 ELSE least(greatest((py1 + y0) / 2, plo), hi) END AS e FROM (
  SELECT *, (y0 + y1) / 2 AS hi, lag((y0 + y1) / 2) OVER p AS plo, lag(y1) OVER p AS py1, 0.5 * median(y1 - y0) OVER (PARTITION BY doc_id, page_index) AS pad
  FROM lines WINDOW p AS (PARTITION BY doc_id, page_index ORDER BY line_no)))
WINDOW p AS (PARTITION BY doc_id, page_index ORDER BY line_no)""")
step("t_named", "runs", "SELECT doc_id, page_index, line_no, run_no, regexp_extract(text, '^(The [a-z]+|La [a-z]+|De [a-z]+)', 1) AS name FROM runs WHERE regexp_matches(text, '^(The [a-z]+|La [a-z]+|De [a-z]+)')")
step("forms", "pages t_named", """
SELECT doc_id, page_index, coalesce(last_value(name IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_index ROWS UNBOUNDED PRECEDING), '') AS form
FROM pages LEFT JOIN (SELECT doc_id, page_index, arg_min(name, line_no * 100 + run_no) AS name FROM t_named GROUP BY ALL) USING (doc_id, page_index)""")
step("records", "runs gutters", """
SELECT doc_id, page_index, line_no, coalesce(string_agg(text, ' ' ORDER BY run_no) FILTER (WHERE NOT c2), '') AS text_1, coalesce(string_agg(text, ' ' ORDER BY run_no) FILTER (WHERE c2), '') AS text_2,
 min(x0) FILTER (WHERE NOT c2) AS x0_1, min(y0) FILTER (WHERE NOT c2) AS y0_1, max(x1) FILTER (WHERE NOT c2) AS x1_1, max(y1) FILTER (WHERE NOT c2) AS y1_1,
 min(x0) FILTER (WHERE c2) AS x0_2, min(y0) FILTER (WHERE c2) AS y0_2, max(x1) FILTER (WHERE c2) AS x1_2, max(y1) FILTER (WHERE c2) AS y1_2,
 list_distinct(flatten(list(blocks) FILTER (WHERE NOT c2))) AS blocks_1, bool_or(st) AS full_width FROM (
 SELECT *, coalesce(x0 >= gutter, false) AND NOT st AS c2 FROM (
  SELECT r.* REPLACE (trim(regexp_replace(text, '[\\s\\p{Z}]+', ' ', 'g')) AS text), gutter, coalesce(x0 < gutter AND gutter < x1, false) AS st FROM runs r LEFT JOIN gutters g USING (doc_id, page_index)) WHERE text <> '')
GROUP BY ALL""")
step("t_alone", "records bands", """
SELECT r.*, b.top, b.bottom, row_number() OVER (PARTITION BY r.doc_id, r.page_index ORDER BY r.line_no) AS k, r.x0_1 IS NOT NULL AND r.x0_2 IS NULL AS alone
FROM records r JOIN bands b USING (doc_id, page_index, line_no)""")
JOINS = "i.alone AND t.alone AND i.full_width = t.full_width AND list_has_any(i.held, t.blocks_1)"
step("t_islands", "t_alone", f"""
SELECT doc_id, page_index, k, 1 AS island, blocks_1 AS held, alone, full_width FROM t_alone WHERE k = 1
UNION ALL SELECT t.doc_id, t.page_index, t.k, CASE WHEN {JOINS} THEN island ELSE island + 1 END, CASE WHEN {JOINS} THEN list_distinct(list_concat(i.held, t.blocks_1)) ELSE t.blocks_1 END, t.alone, t.full_width
FROM t_islands i JOIN t_alone t ON t.doc_id = i.doc_id AND t.page_index = i.page_index AND t.k = i.k + 1""", recursive=True)
step("merged", "t_alone t_islands", """
SELECT doc_id, page_index, min(line_no) AS line_no, count(*) AS lines, string_agg(nullif(text_1, ''), ' ' ORDER BY line_no) AS text_1, string_agg(nullif(text_2, ''), ' ' ORDER BY line_no) AS text_2,
 min(x0_1) AS x0_1, min(y0_1) AS y0_1, max(x1_1) AS x1_1, max(y1_1) AS y1_1, min(x0_2) AS x0_2, min(y0_2) AS y0_2, max(x1_2) AS x1_2, max(y1_2) AS y1_2,
 any_value(t.full_width) AS full_width, min(top) AS top, max(bottom) AS bottom
FROM t_alone t JOIN (SELECT doc_id, page_index, k, island FROM t_islands) USING (doc_id, page_index, k) GROUP BY doc_id, page_index, island""")
step("rows", "merged forms", f"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page_index, line_no) AS row_ord,
 'p' || (page_index + 1) || '_r' || lpad(CAST(row_number() OVER (PARTITION BY doc_id, page_index ORDER BY line_no) AS VARCHAR), CAST(greatest(3, length(CAST(row_number() OVER (PARTITION BY doc_id, page_index ORDER BY line_no) AS VARCHAR))) AS INT), '0') AS row_id,
 page_index, form, coalesce(text_1, '') AS text_1, coalesce(text_2, '') AS text_2, full_width,
 x0_1 AS bbox_1_x0, {HEIGHT} - y1_1 AS bbox_1_y0, x1_1 AS bbox_1_x1, {HEIGHT} - y0_1 AS bbox_1_y1, x0_2 AS bbox_2_x0, {HEIGHT} - y1_2 AS bbox_2_y0, x1_2 AS bbox_2_x1, {HEIGHT} - y0_2 AS bbox_2_y1,
 0.0::DOUBLE AS band_x0, {HEIGHT} - bottom AS band_y0, {WIDTH}::DOUBLE AS band_x1, {HEIGHT} - top AS band_y1
FROM merged JOIN forms USING (doc_id, page_index)""")
step("anchored", "rows", "SELECT *, coalesce(bbox_1_x0, bbox_2_x0) AS ax0, coalesce(bbox_1_y0, bbox_2_y0) AS ay0, coalesce(bbox_1_x1, bbox_2_x1) AS ax1, coalesce(bbox_1_y1, bbox_2_y1) AS ay1 FROM rows")
step("body_marks", "anchored", """
SELECT doc_id, page_index, row_ord AS mark_ord, x0, y0, x0 + 40 AS x1, y0 + 11 AS y1,
 CASE WHEN row_ord % 13 = 0 THEN code WHEN row_ord % 4 = 0 THEN code || '.' || var WHEN row_ord % 4 = 1 THEN var || ' when QNAM = "A"' WHEN row_ord % 4 = 2 THEN var ELSE var || ' = "FIXED"' END AS text,
 row_ord % 17 = 0 AS dashed, row_ord % 19 = 0 AS muted, row_ord % 13 = 0 AS boxed, row_ord % 3 = 0 AS filled, CASE WHEN row_ord % 3 = 0 THEN row_ord % 5 / 4.0 END AS r, CASE WHEN row_ord % 3 = 0 THEN 1.0 END AS g, CASE WHEN row_ord % 3 = 0 THEN 0.5 END AS b FROM (
 SELECT *, CASE row_ord % 7 WHEN 0 THEN ax1 + 4 WHEN 1 THEN ax0 WHEN 2 THEN ax1 + 60 WHEN 3 THEN ax1 + 30 WHEN 4 THEN ax1 + 4.25 WHEN 5 THEN 560 ELSE ax1 + 4 END AS x0,
  CASE row_ord % 7 WHEN 1 THEN ay0 - 11 WHEN 3 THEN ay0 + 3 WHEN 5 THEN ay0 + 7.25 WHEN 6 THEN ay0 - 7 ELSE ay0 END AS y0,
  ['DM', 'AE', 'VS', 'LB', 'CM'][row_ord % 5 + 1] AS code, ['AESTDTC', 'VSORRES', 'SUBJID', 'XXTERM', 'QVAL', 'RFICDTC'][row_ord % 6 + 1] AS var FROM anchored)""")
step("legend_marks", "pages", """
SELECT doc_id, page_index, -k AS mark_ord, 40.0 * k AS x0, CASE WHEN k = 3 THEN 300.0 ELSE 780.0 END AS y0, 40.0 * k + 36 AS x1, CASE WHEN k = 3 THEN 311.0 ELSE 791.0 END AS y1,
 CASE WHEN page_index % 2 = 0 THEN code || ' (' || code || ' Domain)' ELSE code || ' = ' || code || ' Domain' END AS text, false AS dashed, false AS muted, true AS boxed, true AS filled, k / 4.0 AS r, 1.0 AS g, 0.5 AS b
FROM (SELECT doc_id, page_index, k, ['DM', 'AE', 'VS', 'LB', 'CM'][(page_index + k) % 5 + 1] AS code FROM pages, (SELECT unnest([1, 2, 3]) AS k))""")
step("marks", "body_marks legend_marks", "SELECT * FROM body_marks UNION ALL SELECT * FROM legend_marks")
LEG = r"^\s*([A-Za-z]{2,8})\s*(?:=\s*([A-Za-z][A-Za-z0-9 /&\-]*)|\(\s*([A-Za-z][A-Za-z0-9 /&\-]*?)\s*\))\s*$"
step("t_shaped", "marks anchored", f"""
SELECT m.*, CASE WHEN regexp_matches(text, '{LEG}') THEN upper(regexp_extract(text, '{LEG}', 1)) END AS code,
 trim(coalesce(nullif(regexp_extract(text, '{LEG}', 2), ''), regexp_extract(text, '{LEG}', 3))) AS name, top
FROM marks m LEFT JOIN (SELECT doc_id, page_index, max(ay1) AS top FROM anchored GROUP BY ALL) USING (doc_id, page_index)""")
step("legends", "t_shaped", "SELECT * FROM t_shaped WHERE code IS NOT NULL AND y0 >= top")
step("legend_names", "legends", "SELECT doc_id, page_index, code, arg_max(name, mark_ord) AS name FROM legends GROUP BY ALL")
step("legend_colors", "t_shaped legends", """
SELECT doc_id, page_index, kr, kg, kb, arg_max(code, mark_ord) AS code FROM (SELECT *, CAST(round_even(r * 255, 0) AS INT) AS kr, CAST(round_even(g * 255, 0) AS INT) AS kg, CAST(round_even(b * 255, 0) AS INT) AS kb FROM t_shaped) t
WHERE filled AND EXISTS (SELECT 1 FROM legends l WHERE l.doc_id = t.doc_id AND l.page_index = t.page_index AND l.code = t.code) GROUP BY ALL""")
MAP = r'^\s*(?:([A-Za-z]{2,8})\.([A-Za-z0-9_]+)|([A-Za-z0-9_]+))(?:\s+when\s+(.+?)|\s*=\s*("[^"]*"|.+?))?\s*$'
step("mappings", "t_shaped", f"""
SELECT * EXCLUDE (pd, pv), CASE WHEN kind = 'domain' THEN coalesce(pd, pv) ELSE pd END AS domain, CASE WHEN kind <> 'domain' THEN pv END AS variable FROM (
 SELECT * EXCLUDE (code, name, top), CASE WHEN dashed THEN 'note' WHEN filled THEN 'variable' WHEN muted THEN 'note' WHEN boxed THEN 'domain' ELSE 'variable' END AS kind,
  upper(nullif(regexp_extract(text, '{MAP}', 1), '')) AS pd, upper(coalesce(nullif(regexp_extract(text, '{MAP}', 2), ''), nullif(regexp_extract(text, '{MAP}', 3), ''))) AS pv,
  nullif(regexp_extract(text, '{MAP}', 4), '') AS condition, trim(nullif(regexp_extract(text, '{MAP}', 5), ''), '"') AS fixed_value
 FROM t_shaped WHERE NOT (code IS NOT NULL AND coalesce(y0 >= top, false)))""")
step("attributed", "mappings legend_colors", """
SELECT m.* EXCLUDE (domain), CASE WHEN lacks THEN coalesce(banner, l.code, builtin) ELSE domain END AS domain,
 CASE WHEN lacks THEN CASE WHEN banner IS NOT NULL THEN 'banner' WHEN l.code IS NOT NULL THEN 'legend' WHEN builtin IS NOT NULL THEN 'builtin' END END AS source FROM (
 SELECT *, kind = 'variable' AND domain IS NULL AS lacks, (SELECT arg_min(b.domain, (b.y0 - m.y1) * 100000 + b.mark_ord) FROM mappings b WHERE b.doc_id = m.doc_id AND b.page_index = m.page_index AND b.kind = 'domain' AND b.domain IS NOT NULL AND b.y0 >= m.y1) AS banner,
  CASE WHEN variable IN ('RFICDTC', 'SUBJID') THEN 'DM' WHEN left(variable, 2) IN ('DM', 'AE', 'VS', 'LB', 'CM') AND variable <> left(variable, 2) THEN left(variable, 2) END AS builtin FROM mappings m) m
LEFT JOIN legend_colors l ON l.doc_id = m.doc_id AND l.page_index = m.page_index AND m.filled AND kr = CAST(round_even(r * 255, 0) AS INT) AND kg = CAST(round_even(g * 255, 0) AS INT) AND kb = CAST(round_even(b * 255, 0) AS INT)""")
step("t_single", "attributed anchored", """
SELECT doc_id, page_index, mark_ord, row_ord, CASE placement WHEN 'slot1' THEN 0.0 WHEN 'slot2' THEN 0.5 WHEN 'wrap' THEN round(k) WHEN 'band' THEN 7 + near / 1000 ELSE 16 + near END AS rank, 0 AS grouped, placement, CASE WHEN placement = 'wrap' THEN CAST(round(k) AS INT) ELSE 0 END AS wrap_lines, 1 AS length FROM (
 SELECT *, CASE WHEN abs(y0 - ay0) <= 0.55 AND abs(x0 - (ax1 + 4)) <= 0.55 THEN 'slot1' WHEN abs(y0 - ay0) <= 0.55 AND x0 > ax1 + 4 THEN 'slot2'
   WHEN abs(x0 - ax0) <= 0.55 AND k > 0 AND abs(k - round(k)) <= 0.001 AND round(k) BETWEEN 1 AND 6 THEN 'wrap' WHEN near > 200 THEN NULL
   WHEN cy BETWEEN band_y0 AND band_y1 THEN 'band' ELSE 'nearest' END AS placement FROM (
  SELECT m.doc_id, m.page_index, mark_ord, row_ord, x0, y0, ax0, ay0, ax1, band_y0, band_y1, (ay0 - y0) / 11 AS k, (y0 + y1) / 2 AS cy,
   sqrt(((x0 + x1) / 2 - least(greatest((x0 + x1) / 2, ax0), ax1)) * ((x0 + x1) / 2 - least(greatest((x0 + x1) / 2, ax0), ax1)) + ((y0 + y1) / 2 - least(greatest((y0 + y1) / 2, ay0), ay1)) * ((y0 + y1) / 2 - least(greatest((y0 + y1) / 2, ay0), ay1))) AS near
  FROM attributed m JOIN anchored r ON r.doc_id = m.doc_id AND r.page_index = m.page_index WHERE kind <> 'domain')) WHERE placement IS NOT NULL""")
step("t_placed", "anchored", "SELECT *, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY row_ord) AS place FROM anchored")
step("blocks", "t_placed", """
SELECT doc_id, page_index, start, place - start + 1 AS length, coalesce(max(q) OVER w, max(ax1) OVER w) AS bx1, min(ay0) OVER w AS by0, max(ay1) OVER w AS by1 FROM (
 SELECT s.doc_id, s.page_index, s.place AS start, r.place, r.bbox_1_x1 AS q, r.ax1, r.ay0, r.ay1 FROM t_placed s JOIN t_placed r ON r.doc_id = s.doc_id AND r.page_index = s.page_index AND r.place >= s.place)
WINDOW w AS (PARTITION BY doc_id, page_index, start ORDER BY place ROWS UNBOUNDED PRECEDING) QUALIFY place > start""")
step("groups", "attributed blocks", """
SELECT doc_id, page_index, mark_ord, start, length FROM (
 SELECT m.doc_id, m.page_index, mark_ord, start, length, row_number() OVER (PARTITION BY m.doc_id, m.page_index, mark_ord ORDER BY length, start) AS r
 FROM attributed m JOIN blocks b ON b.doc_id = m.doc_id AND b.page_index = m.page_index AND abs(x0 - (bx1 + 4)) <= 0.55 AND abs((y0 + y1) / 2 - (by0 + by1) / 2) <= 5.5 WHERE kind <> 'domain') WHERE r = 1""")
step("matched", "t_single groups t_placed attributed", """
SELECT a.*, placement, wrap_lines, row_ord, row_id, members, coalesce(nullif(text_1, ''), text_2) AS label,
 CASE WHEN row_id IS NOT NULL THEN concat_ws('; ', CASE WHEN form <> '' THEN 'form: ' || form END, CASE WHEN text_2 <> '' THEN 'response: ' || text_2 END) END AS context,
 sqrt(((x0 + x1) / 2 - (ax0 + ax1) / 2) * ((x0 + x1) / 2 - (ax0 + ax1) / 2) + ((y0 + y1) / 2 - (ay0 + ay1) / 2) * ((y0 + y1) / 2 - (ay0 + ay1) / 2)) AS match_distance, x0 - ax1 AS dx_from_text, y0 - ay0 AS dy_from_text
FROM attributed a LEFT JOIN (
 SELECT c.doc_id, c.page_index, c.mark_ord, placement, wrap_lines, r.row_ord, r.row_id, r.form, r.text_1, r.text_2, r.ax0, r.ay0, r.ax1, r.ay1, CASE WHEN c.length > 1 THEN string_agg(r.row_id, ',') OVER (PARTITION BY c.doc_id, c.page_index, c.mark_ord ORDER BY r.row_ord ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) ELSE '' END AS members FROM (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_index, mark_ord ORDER BY rank, grouped, row_ord) AS best FROM (
   SELECT * FROM t_single UNION ALL SELECT g.doc_id, g.page_index, mark_ord, row_ord, 0.25, 1, 'group', 0, length FROM groups g JOIN t_placed p ON p.doc_id = g.doc_id AND p.page_index = g.page_index AND p.place = g.start)) WHERE best = 1) c
 JOIN t_placed r ON r.doc_id = c.doc_id AND r.page_index = c.page_index AND r.row_ord BETWEEN c.row_ord AND c.row_ord + c.length - 1) t USING (doc_id, page_index, mark_ord)""")
step("d_keys", "", r"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS row_ord, trim(p[i]) AS text_1 FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '[.\n]') AS p FROM documents)) WHERE trim(p[i]) <> ''""")
step("b_lookup", "", r"""
SELECT label, 'D' || (item_id % 3) AS domain, 'VAR' || (item_id % 7) AS variable, count(*) AS n FROM (SELECT item_id, trim(p[i]) AS label FROM (SELECT item_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT item_id, string_split_regex(text, '[.\n]') AS p FROM benchmark))) WHERE label <> '' GROUP BY ALL""")
step("annotations", "anchored", """
SELECT *, CASE WHEN kind <> 'note' THEN ['DM', 'AE', 'VS', 'LB', 'CM', 'XX'][row_ord // 3 % 6 + 1] END AS domain, row_ord * 10 + slot AS ord, CASE WHEN row_ord % 3 = 0 THEN 'accepted' ELSE 'proposed' END AS review_status, CASE WHEN row_ord % 3 = 0 THEN 'r' END AS reviewed_by FROM (
 SELECT *, CASE WHEN row_ord % 11 = 0 THEN 'note' WHEN row_ord % 23 = 0 THEN 'domain' ELSE 'variable' END AS kind FROM (
  SELECT doc_id, row_ord, row_id, page_index, form, ax0 AS x0, ay1 AS y1, 1 AS slot, 'VAR' || (row_ord // 4 % 3) AS shown FROM anchored WHERE row_ord % 5 <> 4
  UNION ALL SELECT doc_id, row_ord, row_id, page_index, form, ax0, ay1, 2, CASE WHEN row_ord % 8 = 0 THEN '[NOT SUBMITTED]' ELSE 'SECOND' END FROM anchored WHERE row_ord % 4 = 0))""")
step("collapsed", "annotations", """
SELECT doc_id, row_ord, row_id, slot, 'g_' || first_value(row_id) OVER (PARTITION BY doc_id, slot, island ORDER BY row_ord) AS group_id FROM (
 SELECT *, count(*) OVER (PARTITION BY doc_id, slot, island) AS n FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, slot ORDER BY row_ord ROWS UNBOUNDED PRECEDING) AS island FROM (
   SELECT *, CASE WHEN lag(row_ord) OVER w = row_ord - 1 AND lag(shown) OVER w = shown AND lag(kind) OVER w = kind AND coalesce(lag(domain) OVER w, '') = coalesce(domain, '') AND lag(page_index) OVER w = page_index AND lag(form) OVER w = form THEN 0 ELSE 1 END AS fresh
   FROM annotations WINDOW w AS (PARTITION BY doc_id, slot ORDER BY row_ord)))) WHERE n >= 2""")
step("members", "annotations rows", "SELECT r.doc_id, r.row_id, r.row_ord, r.page_index, s.slot, 'k' || (r.row_ord // 6) AS key FROM rows r, (SELECT unnest([1, 2]) AS slot) s WHERE r.row_ord % 6 BETWEEN 1 AND 4 AND r.row_ord % 6 <> 2")
step("t_groups", "members annotations", """
SELECT m.doc_id, key, m.slot, count(DISTINCT CASE WHEN shown IS NOT NULL THEN concat_ws('|', kind, coalesce(domain, ''), shown) END) AS kinds, min(m.row_ord) AS lo, max(m.row_ord) AS hi, arg_min(kind, m.row_ord) FILTER (WHERE shown IS NOT NULL) AS kind,
 arg_min(coalesce(domain, ''), m.row_ord) FILTER (WHERE shown IS NOT NULL) AS domain, arg_min(shown, m.row_ord) FILTER (WHERE shown IS NOT NULL) AS shown
FROM members m LEFT JOIN annotations a ON a.doc_id = m.doc_id AND a.row_id = m.row_id AND a.slot = m.slot GROUP BY ALL""")
step("group_errors", "t_groups annotations members", """
SELECT doc_id, key, slot, 'contents differ' AS error, NULL::VARCHAR AS row_id FROM t_groups WHERE kinds > 1
UNION ALL SELECT g.doc_id, g.key, g.slot, 'row between', a.row_id FROM t_groups g JOIN annotations a ON a.doc_id = g.doc_id AND a.slot = g.slot AND a.row_ord > g.lo AND a.row_ord < g.hi
 WHERE kinds > 0 AND NOT EXISTS (SELECT 1 FROM members m WHERE m.doc_id = a.doc_id AND m.row_id = a.row_id AND m.slot = a.slot AND m.key = g.key)""")
step("resolved", "t_groups group_errors members annotations", """
SELECT m.doc_id, arg_min(m.row_id, m.row_ord) AS row_id, m.slot, m.page_index, g.kind, g.domain, g.shown, m.key AS group_id, CASE WHEN count(*) > 1 THEN string_agg(m.row_id, ',' ORDER BY m.row_ord) ELSE '' END AS members
FROM members m JOIN t_groups g ON g.doc_id = m.doc_id AND g.key = m.key AND g.slot = m.slot WHERE kinds = 1 AND NOT EXISTS (SELECT 1 FROM group_errors e WHERE e.doc_id = m.doc_id AND e.key = m.key AND e.slot = m.slot) GROUP BY m.doc_id, m.slot, m.page_index, g.kind, g.domain, g.shown, m.key
UNION ALL SELECT a.doc_id, a.row_id, a.slot, a.page_index, a.kind, coalesce(a.domain, ''), a.shown, NULL, '' FROM annotations a WHERE NOT EXISTS (SELECT 1 FROM members m WHERE m.doc_id = a.doc_id AND m.row_id = a.row_id AND m.slot = a.slot)""")
step("t_counted", "annotations rows", """
SELECT a.*, coalesce(nullif(a.form, ''), p.form, '') AS own_form FROM annotations a LEFT JOIN (SELECT doc_id, page_index, arg_min(form, row_ord) AS form FROM rows WHERE form <> '' GROUP BY ALL) p USING (doc_id, page_index)""")
step("domain_order", "t_counted", """
SELECT doc_id, own_form AS form, domain, row_number() OVER (PARTITION BY doc_id, own_form ORDER BY p, y, x, o) AS rank FROM (
 SELECT doc_id, own_form, domain, page_index AS p, -y1 AS y, x0 AS x, ord AS o, row_number() OVER (PARTITION BY doc_id, own_form, domain ORDER BY page_index, -y1, x0, ord) AS r FROM t_counted
 WHERE kind <> 'domain' AND domain IS NOT NULL AND domain <> 'XX' AND shown <> '[NOT SUBMITTED]') WHERE r = 1""")
step("colored", "t_counted domain_order", """
SELECT t.doc_id, t.row_id, t.slot, own_form AS form, t.domain, CASE WHEN kind <> 'domain' AND (shown = '[NOT SUBMITTED]' OR coalesce(t.domain = 'XX', false)) THEN '#CCCCCC' WHEN kind <> 'note' THEN ['#BFFFFF', '#FFFF96', '#96FF96', '#FFBE9B'][(rank - 1) % 4 + 1] END AS color
FROM t_counted t LEFT JOIN domain_order d ON d.doc_id = t.doc_id AND d.form = t.own_form AND d.domain = t.domain""")
#: First fit as recursion over a page's items in order; a line's extent grows with its items, or is that of its first one.
FIT = "coalesce(list_position(list_transform(range(1, len(f.tops) + 1), lambda i: greatest(0.0, least(f.bots[i], o.y1) - greatest(f.tops[i], o.y0)) / greatest(least(f.bots[i] - f.tops[i], o.y1 - o.y0), 0.000001) >= 0.5), true), 0)"


def fit(name: str, items: str, grows: bool) -> None:
    grown = "list_transform(range(1, len(tops) + 1), lambda i: CASE WHEN i = line THEN {0}({1}[i], y) ELSE {1}[i] END)" if grows else "{1}"
    step(name, items, f"""
SELECT doc_id, page_index, k, [y0] AS tops, [y1] AS bots, 1 AS line FROM {items} WHERE k = 1
UNION ALL SELECT doc_id, page_index, k, CASE WHEN line = 0 THEN list_append(tops, y0) ELSE {grown.format("least", "tops").replace(", y)", ", y0)")} END, CASE WHEN line = 0 THEN list_append(bots, y1) ELSE {grown.format("greatest", "bots").replace(", y)", ", y1)")} END, CASE WHEN line = 0 THEN len(tops) + 1 ELSE line END
FROM (SELECT o.doc_id, o.page_index, o.k, o.y0, o.y1, f.tops, f.bots, {FIT} AS line FROM {name} f JOIN {items} o ON o.doc_id = f.doc_id AND o.page_index = f.page_index AND o.k = f.k + 1)""", recursive=True)


step("uneven_words", "words", "SELECT *, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY y0, x0, word_no) AS k FROM (SELECT * REPLACE (y0 + word_no % 4 * 3 AS y0, y1 + word_no % 4 * 3 AS y1) FROM words)")
fit("t_word_lines", "uneven_words", True)
step("word_lines", "t_word_lines uneven_words", "SELECT doc_id, page_index, w.line_no AS was, w.word_no, line - 1 AS line_no FROM uneven_words w JOIN (SELECT doc_id, page_index, k, line FROM t_word_lines) USING (doc_id, page_index, k)")
step("uneven_runs", "runs", "SELECT *, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY line_no, run_no) AS k FROM (SELECT * REPLACE (y0 + (line_no + run_no) % 3 * 4 AS y0, y1 + (line_no + run_no) % 3 * 4 AS y1) FROM runs)")
fit("t_run_lines", "uneven_runs", False)
step("run_lines", "t_run_lines uneven_runs", """
SELECT doc_id, page_index, line_no AS was, run_no AS was_run, dense_rank() OVER (PARTITION BY doc_id, page_index ORDER BY top, line) - 1 AS line_no, row_number() OVER (PARTITION BY doc_id, page_index, line ORDER BY x0, k) - 1 AS run_no FROM (
 SELECT *, first_value(y0) OVER (PARTITION BY doc_id, page_index, line ORDER BY k) AS top FROM uneven_runs JOIN (SELECT doc_id, page_index, k, line FROM t_run_lines) USING (doc_id, page_index, k))""")
