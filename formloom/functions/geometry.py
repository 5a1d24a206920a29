"""Column functions over rectangles: structs of x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let

CORNERS = ["x0", "y0", "x1", "y1"]
#: Fixed values of layout, in points.
FONT_SIZE, GAP, SLOT_GAP, PAD, MARGIN, LINE_STEP = 7.0, 4.0, 3.0, 2.0, 6.0, 11.0
MIN_OVERLAP, MAX_WRAPS, CLEARANCE, BORDER = 1.0, 6, 1.5, 0.5
#: Advance widths of Helvetica in thousandths, from space to tilde.
ADVANCES = [
    278, 278, 355, 556, 556, 889, 667, 191, 333, 333, 389, 584, 278, 333, 278, 278, 556, 556, 556, 556, 556, 556, 556, 556, 556, 556, 278, 278, 584, 584, 584, 556,
    1015, 667, 667, 722, 722, 667, 611, 778, 722, 278, 500, 667, 556, 833, 722, 778, 667, 778, 722, 667, 611, 722, 667, 944, 667, 667, 611, 278, 278, 278, 469, 556,
    333, 556, 556, 500, 556, 556, 278, 556, 556, 222, 222, 500, 222, 833, 556, 556, 556, 556, 333, 500, 278, 556, 500, 722, 500, 500, 500, 334, 260, 334, 584,
]
OTHER_ADVANCE = 556


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    d = lambda c, n: c.cast("double").alias(n)
    return F.struct(d(x0, "x0"), d(y0, "y0"), d(x1, "x1"), d(y1, "y1"))


def flip(b: Column, height: Column) -> Column:
    """Reflected about the page's height, its corners in order again."""
    a, c = height - b["y0"], height - b["y1"]
    return box(F.least(b["x0"], b["x1"]), F.least(a, c), F.greatest(b["x0"], b["x1"]), F.greatest(a, c))


def rect_text(b: Column, places: int = 3, between: str = ",") -> Column:
    return F.format_string(between.join([f"%.{places}f"] * 4), b["x0"], b["y0"], b["x1"], b["y1"])


def rounded(x: Column, places: int = 1) -> Column:
    """To so many places, as the number itself lies and not as it prints: 2.675 is less than it says. A true half goes to the even digit.

    The product with twice the scale is told with its rounding error, by splitting the number in two halves of its digits.
    """
    twice = 2.0 * 10**places

    def of(v: Column) -> Column:
        high = 134217729.0 * v - (134217729.0 * v - v)
        p = v * twice
        error = (high * twice - p) + (v - high) * twice
        half = (F.abs(p) < 2.0**52) & (F.floor(p) == p) & (F.pmod(p, F.lit(2.0)) == 1.0)
        k = F.when(half & (error < 0), (p - 1) / 2).when(half & (error > 0), (p + 1) / 2).otherwise(F.rint(p / 2))
        return F.when(F.abs(v) < 2.0**40, k / float(10**places)).otherwise(v)

    return let(x.cast("double"), of)


def parse_rect(text: Column) -> Column:
    """Of four numbers with commas or spaces between, corners put in order; null if they are not four."""
    parts = F.array_remove(F.split(F.trim(text), r"[,\s]+"), "")
    at = lambda k: F.get(parts, F.lit(k - 1)).try_cast("double")
    good = (F.size(parts) == 4) & at(1).isNotNull() & at(2).isNotNull() & at(3).isNotNull() & at(4).isNotNull()
    return F.when(good, box(F.least(at(1), at(3)), F.least(at(2), at(4)), F.greatest(at(1), at(3)), F.greatest(at(2), at(4))))


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """What two extents share, over the shorter."""
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0)) / F.greatest(F.least(a1 - a0, b1 - b0), F.lit(1e-6))


def covered(word: Column, rect: Column) -> Column:
    """The share of a word's area under a rectangle; 0 for a word without area."""
    area = (word["x1"] - word["x0"]) * (word["y1"] - word["y0"])
    w = F.greatest(F.lit(0.0), F.least(word["x1"], rect["x1"]) - F.greatest(word["x0"], rect["x0"]))
    h = F.greatest(F.lit(0.0), F.least(word["y1"], rect["y1"]) - F.greatest(word["y0"], rect["y0"]))
    return F.when(area > 0, w * h / area).otherwise(0.0)


def length(x: Column, y: Column) -> Column:
    return F.sqrt(x * x + y * y)


def distance(a: Column, b: Column) -> Column:
    """Between centres."""
    return length((a["x0"] + a["x1"]) / 2 - (b["x0"] + b["x1"]) / 2, (a["y0"] + a["y1"]) / 2 - (b["y0"] + b["y1"]) / 2)


def proximity(mark: Column, anchor: Column) -> Column:
    """From a mark's centre to the nearest point of an anchor."""
    x, y = (mark["x0"] + mark["x1"]) / 2, (mark["y0"] + mark["y1"]) / 2
    near = lambda c, lo, hi: F.least(F.greatest(c, lo), hi)
    return length(x - near(x, anchor["x0"], anchor["x1"]), y - near(y, anchor["y0"], anchor["y1"]))


def in_band(mark: Column, band: Column) -> Column:
    return F.coalesce(((mark["y0"] + mark["y1"]) / 2).between(band["y0"], band["y1"]), F.lit(False))


def too_near(a: Column, b: Column) -> Column:
    """Whether two boxes come closer than the clearance, grazes aside."""
    x = F.least(a["x1"] + CLEARANCE, b["x1"]) - F.greatest(a["x0"] - CLEARANCE, b["x0"])
    y = F.least(a["y1"] + CLEARANCE, b["y1"]) - F.greatest(a["y0"] - CLEARANCE, b["y0"])
    return (x > MIN_OVERLAP) & (y > MIN_OVERLAP)


def on_page(b: Column, width: Column, height: Column) -> Column:
    return (b["x0"] >= MARGIN) & (b["x1"] <= width - MARGIN) & (b["y0"] >= MARGIN) & (b["y1"] <= height - MARGIN)


def text_width(text: Column, size: float = FONT_SIZE) -> Column:
    """Of the text in Helvetica, in points; characters outside the table count as a digit does."""
    table = F.array(*[F.lit(x) for x in ADVANCES])
    code = lambda c: F.ascii(c) - 31
    advance = lambda c: F.when(F.ascii(c).between(32, 126), F.get(table, code(c) - 1)).otherwise(OTHER_ADVANCE)
    total = F.aggregate(F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: c != ""), F.lit(0).cast("long"), lambda a, c: a + advance(c))
    return total * size / 1000.0


def right_limit(bbox_1: Column, bbox_2: Column, width: Column) -> Column:
    return F.when(bbox_1.isNotNull() & bbox_2.isNotNull(), bbox_2["x0"] - GAP).otherwise(width - MARGIN)


def color_key(c: Column) -> Column:
    """A colour of fractions as three bytes, halves to even."""
    part = lambda n: F.bround(c[n] * 255).cast("int").alias(n)
    return F.when(c.isNotNull(), F.struct(part("r"), part("g"), part("b")))


def is_muted(c: Column) -> Column:
    """Grey that is not near white: channels within 0.08 of each other, none of 0.9 or more."""
    high, low = F.greatest(c["r"], c["g"], c["b"]), F.least(c["r"], c["g"], c["b"])
    return F.coalesce((high - low <= 0.08) & (high < 0.9), F.lit(False))
