"""A made form of three pages and 54 rows whose true rows are known: two pages of two columns, one of one.

What is printed is listed by page as (baseline, question, response); a question in column 1 starts at 90, or 95 where it
is indented, and a response ends at 470. The truth follows from the list, not from the extraction.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions import geometry as G

WIDTH, HEIGHT, LEFT, INDENT, RIGHT = 612.0, 792.0, 90.0, 95.0, 470.0
#: The printed lines (baseline, question, response), those indented, and the forms' names.
FORMS = ["Demographics", "Vital Signs", "Instructions"]
HEAD = [(30, "SYNTHETIC TEST DATA - NOT A REAL CRF", ""), (44, "Protocol SYNTH-001   Subject: ________", "")]
PAGES = [
    [
        (80, "Site Identifier", ""), (104, "Was this participant a prior screen failure?", "Yes"), (118, "", "No"), (142, "If Yes, please provide the original", ""), (152, "participant number (xxxxx-xxxx)", ""),
        (182, "DEMOGRAPHICS", ""), (206, "Year of Birth (yyyy)", ""), (230, "Age (years) at time of consent", "Fixed Unit: years"), (254, "Sex", "Male"), (268, "", "Female"),
        (292, "Is the participant of childbearing potential?", "Yes"), (306, "", "No"), (330, "Ethnicity", "Hispanic or Latino"), (344, "", "Not Hispanic or Latino"), (358, "", "Not Reported"), (372, "", "Unknown"),
        (400, "Race (check all that apply)", ""), (414, "When multiple values are selected then RACE = MULTIPLE and individual responses are RACE1, RACE2, RACEn in SUPPDM", ""),
        (436, "American Indian or Alaska Native", ""), (450, "Asian", ""), (464, "Black or African American", ""), (478, "White", ""), (506, "Country of Enrollment", ""), (757, "Investigator Initials", ""),
    ],
    [(80, "Visit Date", ""), (110, "VITAL SIGNS", "")]
    + [(140 + 24 * k, q, r) for k, (q, r) in enumerate([("Systolic Blood Pressure", "mmHg"), ("Diastolic Blood Pressure", "mmHg"), ("Pulse Rate", "beats/min"), ("Body Temperature", "C"), ("Respiratory Rate", "breaths/min")])]
    + [(290, "Position", "Sitting"), (304, "", "Supine"), (318, "", "Standing"), (757, "Assessor Initials", "")],
    [(90, "INSTRUCTIONS FOR COMPLETION", "")]
    + [(120 + 16 * k, f"Paragraph {k + 1} tells at some length, from margin to margin, how one part of the pages before is to be filled in.", "") for k in range(7)],
]
INDENTED, MERGED_UP = {142, 152, 436, 450, 464, 478}, {152}
SIZE, ASCENT, DESCENT = 9.0, 9.675, 2.7


def width_of(text: str, size: float = SIZE) -> float:
    return sum(G.ADVANCES[ord(c) - 32] if 32 <= ord(c) < 127 else G.OTHER_ADVANCE for c in text) * size / 1000


def printed() -> list[tuple[int, float, str, str]]:
    """(page, baseline, question, response) of all lines, heads and feet among them."""
    out = []
    for k, body in enumerate(PAGES):
        feet = [(58, f"Form: {FORMS[k]}", ""), (770, f"Form {FORMS[k]} v1.0", f"Page {k + 1} of {len(PAGES)}")]
        out += [(k, float(y), q, r) for y, q, r in sorted([*HEAD, *body, *feet])]
    return out


def words(spark: SparkSession) -> DataFrame:
    """The printed words: doc_id, page_index, line_no, word_no, x0, y0, x1, y1 (y down), word, block. A wrapped question is one block."""
    rows, block, line = [], 0, 0
    for page, y, question, response in printed():
        block += not (page == 0 and y in MERGED_UP)
        n = 0
        for text, start in ((question, INDENT if page == 0 and y in INDENTED else LEFT), (response, RIGHT - width_of(response))):
            for m in re.finditer(r"\S+", text):
                x = start + width_of(text[: m.start()])
                rows.append((0, page, line, n, x, y - ASCENT, x + width_of(m[0]), y + DESCENT, m[0], block))
                n += 1
        line += 1
    return spark.createDataFrame(rows, "doc_id long, page_index int, line_no int, word_no int, x0 double, y0 double, x1 double, y1 double, word string, block int")


def truth() -> list[tuple[int, str, str, str, float | None, float | None]]:
    """(page, form, text_1, text_2, x of the question, right edge of the response) of the rows, in order.

    On the page of one column a line's halves are one text; a question that goes on is one row.
    """
    out: list[tuple[int, str, str, str, float | None, float | None]] = []
    for page, y, question, response in printed():
        question, response = (" ".join(t.split()) for t in (question, response))
        if page == 2:
            question, response = " ".join(filter(None, (question, response))), ""
        if page == 0 and y in MERGED_UP:
            last = out.pop()
            out.append((*last[:2], f"{last[2]} {question}", *last[3:]))
            continue
        x = (INDENT if page == 0 and y in INDENTED else LEFT) if question else None
        out.append((page, FORMS[page], question, response, x, RIGHT if response else None))
    return out
