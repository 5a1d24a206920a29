"""Column functions over text: keys, mapping texts, legends, appearance strings and scrubbed cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a mark says when its row is not submitted, and domains that the standard fixes.
NOT_SUBMITTED = "[NOT SUBMITTED]"
NOT_SUBMITTED_DOMAIN = "XX"
HOME_DOMAIN = "DM"
HOME_VARIABLES = ["RFICDTC", "RFSTDTC", "RFENDTC", "RFXSTDTC", "RFXENDTC", "RFPENDTC", "DTHDTC", "SUBJID", "USUBJID"]
DOMAIN_PREFIXES = ["DM", "DS", "AE", "CM", "VS", "LB", "EG", "MH", "PE", "SU", "EX", "CE", "DV", "IE", "DA", "FA", "MB", "MI", "RS", "SC", "SS", "TU", "TR", "QS"]
#: Spellings of an absent cell, kinds and origins by their letters, and quotes that editors put in.
NULLISH = ["", "null", "none", "n/a", "na", "not applicable", "-"]
KINDS = ["domain", "variable", "note"]
ORIGINS = ["Collected", "Derived", "Assigned", "Protocol", "eDT", "Predecessor", "NotSubmitted"]
SMART_QUOTES = ("“”„‟″‘’‚‛′", "\"\"\"\"\"'''''")
#: Names of bold and italic faces, and the short names of the base fonts that are.
BOLD_WORDS, ITALIC_WORDS = ["bold", "black", "heavy", "semibold", "demi"], ["italic", "oblique"]
BOLD_SHORT, ITALIC_SHORT = ["hebo", "hebi", "cobo", "cobi", "tibo", "tibi"], ["heit", "hebi", "coit", "cobi", "tiit", "tibi"]

_SPACE = r"(?U)\s+"
#: The patterns of a mapping's text (a domain and variable, or a variable, with a condition or a value) and of a legend's.
MAPPING = r"(?s)^\s*(?:([A-Za-z]{2,8})\.([A-Za-z0-9_]+)|([A-Za-z0-9_]+))(?:\s+when\s+(.+?)|\s*=\s*(\"[^\"]*\"|.+?))?\s*$"
LEGEND = r"^\s*([A-Za-z]{2,8})\s*(?:=\s*([A-Za-z][A-Za-z0-9 /&\-]*)|\(\s*([A-Za-z][A-Za-z0-9 /&\-]*?)\s*\))\s*$"


def or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def collapse(text: Column) -> Column:
    """White space of any alphabet collapsed to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, _SPACE, " "))


def clean_label(text: Column) -> Column:
    """Collapsed, without trailing colons."""
    return F.trim(F.regexp_replace(collapse(text), ":+$", ""))


def normalize_key(text: Column) -> Column:
    return F.lower(clean_label(text))


def joined_text(text_1: Column, text_2: Column) -> Column:
    return F.concat_ws(" / ", or_null(text_1), or_null(text_2))


def unquoted(value: Column) -> Column:
    v = F.trim(value)
    return F.when(v.rlike(r'(?s)^".*"$') & (F.length(v) >= 2), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)


def parse_mapping(text: Column) -> Column:
    """struct(domain, variable, condition, fixed_value) of a mark's text; nulls where it is no mapping."""
    t = collapse_ends(text)
    part = lambda k: or_null(F.regexp_extract(t, MAPPING, k))
    is_one = (F.upper(t) != NOT_SUBMITTED) & t.rlike(MAPPING)
    when = lambda c: F.when(is_one, c)
    fixed = F.regexp_extract(t, MAPPING, 5)
    return F.struct(
        when(F.upper(part(1))).alias("domain"), when(F.upper(F.coalesce(part(2), part(3)))).alias("variable"),
        when(part(4)).alias("condition"), when(F.when(fixed != "", unquoted(fixed))).alias("fixed_value"),
    )


def collapse_ends(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")


def legend(text: Column) -> Column:
    """struct(code, name) of a text with the shape of a legend, nulls otherwise."""
    name = F.coalesce(or_null(F.regexp_extract(text, LEGEND, 2)), F.regexp_extract(text, LEGEND, 3))
    is_one = text.rlike(LEGEND)
    return F.struct(F.when(is_one, F.upper(F.regexp_extract(text, LEGEND, 1))).alias("code"), F.when(is_one, F.trim(name)).alias("name"))


def builtin_domain(variable: Column) -> Column:
    prefix = F.substring(variable, 1, 2)
    return F.when(variable.isin(HOME_VARIABLES), HOME_DOMAIN).when(prefix.isin(DOMAIN_PREFIXES) & (variable != prefix), prefix)


def composed(name: Column, condition: Column, fixed_value: Column) -> Column:
    """name = value when condition, of what there is; null where there is nothing."""
    valued = or_null(F.concat_ws(" = ", or_null(name), or_null(fixed_value)))
    return or_null(F.concat_ws(" when ", valued, or_null(condition)))


def label_text(domain: Column, variable: Column, condition: Column, fixed_value: Column) -> Column:
    """The whole mapping, domain and all."""
    return F.coalesce(composed(F.concat_ws(".", or_null(domain), or_null(variable)), condition, fixed_value), F.lit(""))


def variable_text(variable: Column, condition: Column, fixed_value: Column) -> Column:
    """The mapping without its domain, which colour and legend tell: what goes on the page and into the sheet."""
    return F.coalesce(composed(variable, condition, fixed_value), F.lit(""))


def display_text(text: Column, variable: Column, condition: Column, fixed_value: Column, origin: Column) -> Column:
    """What an annotation shows: its own text, or its variable's, or that it is not submitted."""
    return F.coalesce(or_null(collapse_ends(text)), composed(variable, condition, fixed_value), F.when(origin == "NotSubmitted", F.lit(NOT_SUBMITTED)), F.lit(""))


def mark_colors(subtype: Column, stroke: Column, interior: Column) -> Column:
    """struct(fill, border) of a mark's two colours: a square's stroke is its border, any other mark's is its background."""
    square = F.coalesce(subtype == "Square", F.lit(False))
    return F.struct(F.when(square, interior).otherwise(stroke).alias("fill"), F.when(square, stroke).alias("border"))


def is_not_submitted(origin: Column, shown: Column, domain: Column) -> Column:
    return F.coalesce(origin == "NotSubmitted", F.lit(False)) | (F.upper(F.trim(shown)) == NOT_SUBMITTED) | F.coalesce(domain == NOT_SUBMITTED_DOMAIN, F.lit(False))


def squeezed(text: Column) -> Column:
    return F.lower(F.translate(F.trim(text), " _-", ""))


def coerce(text: Column, values: list[str]) -> Column:
    """The value whose letters the text has, whatever its case, spaces, dashes and underscores; null for none."""
    return reduce(lambda a, v: F.when(squeezed(text) == v.lower().replace(" ", ""), v).otherwise(a), values, F.lit(None).cast("string"))


def scrub(text: Column) -> Column:
    """The cell without blanks at its ends; null if it says nothing."""
    cell = collapse_ends(text)
    return F.when(~F.lower(cell).isin(NULLISH), cell)


def pasted(text: Column) -> Column:
    """Without fence lines, with plain quotes."""
    return F.translate(F.regexp_replace(text, r"(?m)^\s*```.*$\n?", ""), *SMART_QUOTES)


def label_words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)), lambda w: F.length(w) > 2))


def count_or(text: Column, other: int = 0) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(other))


def da_color(da: Column) -> Column:
    """struct(r, g, b) of an appearance string's text colour: rg, else k, else g."""
    num = r"([0-9]*\.?[0-9]+)"
    rgb, cmyk, grey = rf"{num}\s+{num}\s+{num}\s+rg\b", rf"{num}\s+{num}\s+{num}\s+{num}\s+k\b", rf"{num}\s+g\b"
    at = lambda p, k: F.regexp_extract(da, p, k).try_cast("double")
    ink = lambda k: (1 - at(cmyk, k)) * (1 - at(cmyk, 4))
    three = lambda a, b, c: F.struct(a.alias("r"), b.alias("g"), c.alias("b"))
    return F.when(da.rlike(rgb), three(at(rgb, 1), at(rgb, 2), at(rgb, 3))).when(da.rlike(cmyk), three(ink(1), ink(2), ink(3))).when(da.rlike(grey), three(at(grey, 1), at(grey, 1), at(grey, 1)))


def da_font(da: Column) -> Column:
    """struct(font, size, bold, italic) of an appearance string."""
    p = r"/([^\s/]+)\s+([0-9]*\.?[0-9]+)\s+Tf"
    font = or_null(F.regexp_extract(da, p, 1))
    low = F.lower(font)
    any_of = lambda words, short: F.coalesce(low.rlike("|".join(words)) | low.isin(short), F.lit(False))
    return F.struct(font.alias("font"), F.regexp_extract(da, p, 2).try_cast("double").alias("size"), any_of(BOLD_WORDS, BOLD_SHORT).alias("bold"), any_of(ITALIC_WORDS, ITALIC_SHORT).alias("italic"))


def annotation_flags(flags: Column) -> Column:
    """struct(printable, hidden) of a mark's flag bits: hidden 2, print 4, no view 32."""
    bit = lambda b: F.coalesce(flags, F.lit(0)).bitwiseAND(b) != 0
    return F.struct(bit(4).alias("printable"), (bit(2) | bit(32)).alias("hidden"))


def hex_color(r: Column, g: Column, b: Column) -> Column:
    return F.format_string("#%02X%02X%02X", r, g, b)


def parse_hex(text: Column) -> Column:
    """struct(r, g, b) of #RRGGBB; null if it is none."""
    at = lambda k: F.conv(F.substring(text, k, 2), 16, 10).cast("int")
    return F.when(text.rlike("^#[0-9A-Fa-f]{6}$"), F.struct(at(2).alias("r"), at(4).alias("g"), at(6).alias("b")))
