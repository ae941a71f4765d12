"""Clean forms of case numbers, decision numbers and decision dates, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.chars import fold_digits, plain_marks, plain_spaces, to_cyrillic

#: Month names in the genitive, January first.
MONTHS_GENITIVE = "січня лютого березня квітня травня червня липня серпня вересня жовтня листопада грудня".split()


def base(col: Column) -> Column:
    """Digits, widths, dashes, slashes, invisible characters and spaces made plain."""
    return plain_spaces(plain_marks(fold_digits(col)))


def clean_case_number(col: Column) -> Column:
    """``digits/digits/digits`` of a court case, or null where there is none."""
    hit = F.regexp_extract(F.regexp_replace(base(col), " ", ""), r"(\d+/\d+/\d+)", 1)
    return F.when(col.rlike(r"^\d+/\d+/\d+$"), col).otherwise(F.when(hit != "", hit))


def clean_decision_number(col: Column) -> Column:
    """``61/1042-р/к``, ``325-р`` and the like; the suffix ``-р`` is added where it was lost. Null where no digit is left.

    ``№``, spaces, dashes, case and look-alike letters make no difference; digits stay as they are.
    """
    # most numbers are clean already: one test saves the foldings
    return F.when(col.rlike(r"^(?:\d+/)?\d+-р(?:/к)?$"), col).otherwise(_folded_number(col))


def _once(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _folded_number(col: Column) -> Column:
    def read(t: Column) -> Column:
        head = F.regexp_extract(t, r"^[^0-9]*(\d[\d/]*?)/?(?:[^\d/].*)?$", 1)
        tail = F.when(F.regexp_extract(t, r"\d/?([^\d/].*)$", 1).isin("р/к", "рк"), F.lit("-р/к")).otherwise(F.lit("-р"))
        return F.when(head != "", F.concat(head, tail))

    return _once(F.regexp_replace(F.lower(to_cyrillic(base(col))), "[^0-9а-яіїєґ/]", ""), read)


def clean_date(col: Column) -> Column:
    """``yyyy-MM-dd`` of an ISO date or time, ``yyyy/M/d``, ``d.M.yyyy``, ``d-M-yyyy`` or a date in words; null for any other text and for days that do not exist."""
    iso = F.when(F.try_to_date(col, "yyyy-MM-dd").isNotNull(), col)
    return F.when(col.rlike(r"^(?:19|20)\d\d-\d\d-\d\d$"), iso).otherwise(_folded_date(col))


def _folded_date(col: Column) -> Column:
    ymd = r"(?<!\d)((?:19|20)\d\d)[-/.](\d{1,2})[-/.](\d{1,2})(?!\d)"
    dmy = r"(?<!\d)(\d{1,2})[-/.](\d{1,2})[-/.]((?:19|20)\d\d)(?!\d)"
    words = r"(?<!\d)(\d{1,2}) (" + "|".join(MONTHS_GENITIVE) + r") ((?:19|20)\d\d)(?!\d)"
    month = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS_GENITIVE) for x in (m, f"{i + 1:02d}")])

    def day(y: Column, m: Column, d: Column) -> Column:
        text = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
        return F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd")

    def read(t: Column) -> Column:
        part = lambda p, i: F.regexp_extract(t, p, i)
        return F.coalesce(
            F.when(t.rlike(ymd), day(part(ymd, 1), part(ymd, 2), part(ymd, 3))),
            F.when(t.rlike(dmy), day(part(dmy, 3), part(dmy, 2), part(dmy, 1))),
            F.when(t.rlike(words), day(part(words, 3), F.try_element_at(month, part(words, 2)), part(words, 1))),
        )

    return _once(F.lower(to_cyrillic(base(col))), read)
