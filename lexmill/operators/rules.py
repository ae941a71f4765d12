"""Rule families: ordered first-match cascades, tagging, aliases and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(text: Column, patterns: list[str]) -> Column:
    """One alternation, case-insensitive for all scripts; null texts match nothing."""
    return F.coalesce(text.rlike("(?iu)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def cascade(steps: list[tuple[Column, str]], default: str) -> Column:
    """The name of the first step whose test holds."""
    out = F.when(steps[0][0], steps[0][1])
    for test, name in steps[1:]:
        out = out.when(test, name)
    return out.otherwise(default)


def code_map(value: Column, aliases: dict[str, str], default: Column) -> Column:
    """Aliases (lower case) to codes; anything else is the default."""
    table = F.create_map(*[F.lit(x) for p in aliases.items() for x in p])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(value))), default)


#: Points of the article on violations; articles on unfair competition, in order.
POINTS = (1, 21)
UNFAIR_ARTICLES = ["4", "5", "6", "7", "8", "10", "11", "13", "14", "15", "15-1", "16", "17", "18", "19"]


def primary_code(code: Column) -> Column:
    """``zek:50:n`` or ``unfair:a`` of the known ones, else null."""
    c = F.translate(F.regexp_replace(F.lower(code), r"\s+", ""), "–—", "--")
    n = F.regexp_extract(c, r"^zek:50:(\d{1,2})$", 1).try_cast("int")
    a = F.regexp_replace(F.regexp_extract(c, r"^unfair:(15-?1|\d{1,2})$", 1), "^15-?1$", "15-1")
    return F.when(n.between(*POINTS), F.concat(F.lit("zek:50:"), n)).when(a.isin(*UNFAIR_ARTICLES), F.concat(F.lit("unfair:"), a))
