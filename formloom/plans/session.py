"""A session's relations by name: temporary views over words and marks, and functions, for SQL and for other tools.

A view is a plan, and one that stands on others takes what it needs of them; but runs, rows and mappings, which most others
read several times, are written once, when they are first needed. The functions say the same as the column functions of their names, and tests hold them to that.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import extract, grouping, precedent, recover, style
from ..sources.stage import staged

WRITTEN = ("runs", "rows", "mappings")
BOX = "STRUCT<x0: DOUBLE, y0: DOUBLE, x1: DOUBLE, y1: DOUBLE>"


def quoted(text: str) -> str:
    """A string literal of SQL, as it stands."""
    return "r'" + text + "'" if "'" not in text else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(values: list[str]) -> str:
    return ", ".join(map(quoted, values))


ENDS = f"regexp_replace(coalesce(t, ''), {quoted('(?U)^' + chr(92) + 's+|' + chr(92) + 's+$')}, '')"


def functions() -> dict[str, tuple[str, str, str]]:
    """By name: parameters, what comes back, and its expression."""
    part = lambda k: f"nullif(regexp_extract({ENDS}, {quoted(T.MAPPING)}, {k}), '')"
    is_one = f"(upper({ENDS}) <> {quoted(T.NOT_SUBMITTED)} AND {ENDS} RLIKE {quoted(T.MAPPING)})"
    when = lambda c: f"CASE WHEN {is_one} THEN {c} END"
    value = f"trim({part(5)})"
    fixed = f"CASE WHEN {value} RLIKE {quoted('(?s)^\".*\"$')} AND length({value}) >= 2 THEN substring({value}, 2, length({value}) - 2) ELSE {value} END"
    legend = lambda k: f"nullif(regexp_extract(t, {quoted(T.LEGEND)}, {k}), '')"
    parts = "transform(filter(split(trim(t), r'[,\\s]+'), x -> x <> ''), x -> try_cast(x AS DOUBLE))"
    at = lambda k: f"element_at({parts}, {k})"
    corners = ", ".join(f"'{n}', {f}({at(a)}, {at(b)})" for n, f, a, b in (("x0", "least", 1, 3), ("y0", "least", 2, 4), ("x1", "greatest", 1, 3), ("y1", "greatest", 2, 4)))
    return {
        "normalize_key": ("t STRING", "STRING", f"lower(trim(regexp_replace(trim(regexp_replace(t, {quoted(T._SPACE)}, ' ')), ':+$', '')))"),
        "parse_mapping": ("t STRING", "STRUCT<domain: STRING, variable: STRING, condition: STRING, fixed_value: STRING>", f"named_struct('domain', {when(f'upper({part(1)})')}, 'variable', {when(f'upper(coalesce({part(2)}, {part(3)}))')}, 'condition', {when(part(4))}, 'fixed_value', {when(fixed)})"),
        "parse_legend": ("t STRING", "STRUCT<code: STRING, name: STRING>", f"CASE WHEN t RLIKE {quoted(T.LEGEND)} THEN named_struct('code', upper(regexp_extract(t, {quoted(T.LEGEND)}, 1)), 'name', trim(coalesce({legend(2)}, {legend(3)}))) ELSE named_struct('code', CAST(NULL AS STRING), 'name', CAST(NULL AS STRING)) END"),
        "builtin_domain": ("v STRING", "STRING", f"CASE WHEN v IN ({listed(T.HOME_VARIABLES)}) THEN {quoted(T.HOME_DOMAIN)} WHEN substring(v, 1, 2) IN ({listed(T.DOMAIN_PREFIXES)}) AND v <> substring(v, 1, 2) THEN substring(v, 1, 2) END"),
        "mark_kind": ("dashed BOOLEAN, filled BOOLEAN, muted BOOLEAN, boxed BOOLEAN", "STRING", "CASE WHEN dashed THEN 'note' WHEN filled THEN 'variable' WHEN muted THEN 'note' WHEN boxed THEN 'domain' ELSE 'variable' END"),
        "parse_rect": ("t STRING", BOX, f"CASE WHEN size({parts}) = 4 AND NOT exists({parts}, x -> x IS NULL) THEN named_struct({corners}) END"),
        "rect_distance": (f"a {BOX}, b {BOX}", "DOUBLE", "sqrt(((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2) * ((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2) + ((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2) * ((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2))"),
        "in_band": (f"mark {BOX}, band {BOX}", "BOOLEAN", "coalesce((mark.y0 + mark.y1) / 2 BETWEEN band.y0 AND band.y1, false)"),
        "is_not_submitted": ("origin STRING, shown STRING, domain STRING", "BOOLEAN", f"coalesce(origin = 'NotSubmitted', false) OR upper(trim(shown)) = {quoted(T.NOT_SUBMITTED)} OR coalesce(domain = {quoted(T.NOT_SUBMITTED_DOMAIN)}, false)"),
    }


def register_functions(spark: SparkSession) -> list[str]:
    for name, (takes, gives, body) in functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURNS {gives} RETURN {body}")
    return list(functions())


@dataclass
class Relations:
    """The relations of some forms, each made of others by name.

    words are as extract.rows() takes them; marks, annotations and lookup, where given, as their operators take them. The
    pages' size and the pattern of a form's header hold for all forms.
    """

    spark: SparkSession
    words: DataFrame
    marks: DataFrame | None = None
    annotations: DataFrame | None = None
    lookup: DataFrame | None = None
    width: float = 612.0
    height: float = 792.0
    header: str = extract.FORM_HEADER
    stage: Callable[[DataFrame], DataFrame] = staged
    made: dict[str, DataFrame] = field(default_factory=dict)

    def of(self, name: str) -> DataFrame:
        """The relation of that name; its plan is made once."""
        if name not in self.made:
            df = self.recipes()[name]()
            self.made[name] = self.stage(df) if name in WRITTEN else df
        return self.made[name]

    def recipes(self) -> dict[str, Callable[[], DataFrame]]:
        """How each relation is made that the given tables allow."""
        of, w, h = self.of, F.lit(self.width), F.lit(self.height)
        page = extract.PAGE
        out: dict[str, Callable[[], DataFrame]] = {
            "words": lambda: self.words,
            "runs": lambda: extract.runs(self.words) if "line_no" in self.words.columns else extract.lines_of(extract.folded_runs(self.words), together=True),
            "pages": lambda: extract.page_gutters(of("runs"), of("runs").select(*page).distinct(), w).join(extract.forms(of("runs"), of("runs").select(*page).distinct(), self.header), page, "left"),
            "bands": lambda: extract.line_bands(extract.line_rects(of("runs")), w, h),
            "rows": lambda: extract.rows_of(of("runs"), self.width, self.height, self.header),
        }
        if self.marks is not None:
            split = lambda: recover.split_legends(self.marks, of("rows"))
            known = lambda: precedent.domain_table(of("lookup")) if self.lookup is not None else None
            out |= {
                "marks": lambda: self.marks,
                "legends": lambda: split()[0],
                "mappings": lambda: recover.attribute_domains(recover.mappings(split()[1]), recover.legend_colors(self.marks, of("legends")), known()),
                "matched": lambda: recover.match_rows(of("mappings"), of("rows")),
                "page_domains": lambda: recover.page_domains(of("mappings"), recover.legend_names(of("legends"))),
                "votes": lambda: precedent.domain_votes(of("mappings").withColumn("ord", F.struct("doc_id", "mark_ord"))),
                "mined": lambda: precedent.mine(self.marks, of("rows")),
            }
        if self.lookup is not None:
            out |= {"lookup": lambda: self.lookup, "proposals": lambda: precedent.match_precedent(of("rows"), of("lookup"))}
        if self.annotations is not None:
            out |= {
                "annotations": lambda: self.annotations,
                "colored": lambda: style.apply_colors(self.annotations.drop("form"), of("rows")),
                "repeats": lambda: grouping.collapse_repeats(self.annotations, of("rows")),
                "uncovered": lambda: grouping.uncovered(of("rows"), self.annotations),
            }
        return out

    def register(self, prefix: str = "", names: list[str] | None = None) -> list[str]:
        """Makes each relation, or those named, a temporary view, and the functions known. A later call replaces views of the same names."""
        register_functions(self.spark)
        names = list(self.recipes()) if names is None else names
        for name in names:
            self.of(name).createOrReplaceTempView(prefix + name)
        return [prefix + name for name in names]
