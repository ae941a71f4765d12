"""Search over practice rows: query language, facets, sorts."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import search_form

#: Scalar and array fields in which quoted phrases are looked for.
EXACT_TEXTS = ["decision_number", "decision_date", "primary_code", "primary_label", "outcome_label", "outcome_summary", "violation_summary", "amcu_reasoning", "respondent_position", "sanction", "market_or_sector"]
EXACT_ARRAYS = ["liable_parties", "key_takeaways", "evidence_factors", "legal_basis"]
_QUOTED = re.compile(r'"([^"]+)"|«([^»]+)»|“([^”]+)”')


@dataclass(frozen=True)
class Query:
    phrases: tuple[str, ...]
    terms: tuple[str, ...]


def plain(text: str) -> str:
    """The search form of a query text, on the driver."""
    t = re.sub("[’ʼ`´]", "'", text.lower().replace(" ", " ")).replace("¹", "-1")
    return " ".join(re.sub(r"[^0-9a-zа-яіїєґ'\-]+", " ", re.sub("[–—]", "-", t)).split())


def parse(text: str) -> Query:
    """Quoted phrases (straight, angle, curly) and the other words of more than one character; both kinds must all match."""
    phrases = [plain(next(g for g in m.groups() if g)) for m in _QUOTED.finditer(text)]
    terms = [w for w in plain(_QUOTED.sub(" ", text)).split() if len(w) > 1]
    return Query(tuple(p for p in phrases if p), tuple(terms))


def _holds(phrase: str):
    return lambda field: F.contains(field, F.lit(f" {phrase} "))


def matches(q: Query, blob: Column, texts: list[Column], arrays: list[Column]) -> Column:
    """Words are parts of the blob; phrases are whole words within one field. An empty query matches all."""
    form = search_form(blob)
    tests = [F.contains(form, F.lit(t)) for t in q.terms]
    if q.phrases:
        fields = F.concat(F.array(*texts), *[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])
        padded = F.transform(fields, lambda f: F.concat(F.lit(" "), search_form(f), F.lit(" ")))
        tests += [F.exists(padded, _holds(p)) for p in q.phrases]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def search_all(rows: DataFrame, searches: list[tuple[str, str | None, int | None]], key: str) -> DataFrame:
    """``search_no, key`` of the rows that each search finds, by one scan: texts are brought to search form once for all of them."""
    fields = F.concat(F.array(*EXACT_TEXTS), *[F.coalesce(a, F.array().cast("array<string>")) for a in EXACT_ARRAYS])
    padded = F.transform(fields, lambda f: F.concat(F.lit(" "), search_form(f), F.lit(" ")))
    forms = rows.select(key, "year", F.col("classification.law_family").alias("family"), search_form(F.col("search_blob")).alias("blob"), padded.alias("fields"))

    def test(text: str, family: str | None, year: int | None) -> Column:
        q = parse(text)
        tests = [F.contains("blob", F.lit(t)) for t in q.terms] + [F.exists("fields", _holds(p)) for p in q.phrases]
        tests += [F.col(c) == v for c, v in (("family", family), ("year", year)) if v is not None]
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    numbers = F.array_compact(F.array(*[F.when(test(*s), n) for n, s in enumerate(searches)]))
    return forms.select(F.explode(numbers).alias("search_no"), key)


def search(rows: DataFrame, text: str, family: str | None = None, year: int | None = None, code: str | None = None) -> DataFrame:
    """Rows that match the query and all given facets (``None`` is no filter)."""
    facets = [(F.col("classification.law_family"), family), (F.col("year"), year), (F.col("primary_code"), code)]
    test = reduce(lambda a, b: a & b, [c == v for c, v in facets if v is not None], F.lit(True))
    return rows.filter(test & matches(parse(text), F.col("search_blob"), [F.col(c) for c in EXACT_TEXTS], [F.col(c) for c in EXACT_ARRAYS]))


def orders(total: Column) -> dict[str, list[Column]]:
    """The four sorts of a result list; text in the order of the Ukrainian alphabet, ties by record."""
    uk = lambda c: F.collate(F.col(c), "uk")
    return {
        "date_desc": [uk("sort_key").desc_nulls_last(), F.col("rec_id")],
        "date_asc": [uk("sort_key").asc_nulls_last(), F.col("rec_id")],
        "sanction_desc": [total.desc(), uk("sort_key").desc_nulls_last(), F.col("rec_id")],
        "title_asc": [F.collate(F.concat(F.coalesce("decision_date", F.lit("null")), F.lit("|"), F.coalesce("decision_number", F.lit("null"))), "uk").asc(), F.col("rec_id")],
    }


def page(rows: DataFrame, order: list[Column], size: int) -> DataFrame:
    """The first ``size`` rows in an order (a bounded top list, no full sort)."""
    return rows.orderBy(*order).limit(size)
