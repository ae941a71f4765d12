"""Text normalisation, parsing and formatting as Column expressions (all run inside the JVM)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Any white space, as scripts and databases with Unicode rules see it.
WS = "[\\s\\x0B\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"


def trim_all(col: Column) -> Column:
    """Trim white space of any kind. (The look-behind keeps long runs inside a text from being tried at each of their places.)"""
    return F.regexp_replace(col, f"^{WS}+|(?<!{WS}){WS}+$", "")


def normalize_spaces(col: Column) -> Column:
    """No-break spaces and runs of blanks become one space, three or more line ends two, ends are trimmed."""
    t = F.regexp_replace(col, "\u00a0", " ")
    t = F.regexp_replace(t, r"[ \t\r\f\x0B]+", " ")
    return trim_all(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def compact(col: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.trim(F.regexp_replace(col, f"{WS}+", " "))


def clean(col: Column) -> Column:
    """Byte-order marks dropped, ends trimmed."""
    return trim_all(F.regexp_replace(col, "\ufeff", ""))


def search_form(col: Column) -> Column:
    """The form in which search compares: lower case, one apostrophe, one dash, words and nothing else."""
    t = F.lower(F.coalesce(col, F.lit("")))
    t = F.translate(t, "\u00a0’ʼ`´–—", " ''''--")
    t = F.regexp_replace(t, "¹", "-1")
    return F.trim(F.regexp_replace(t, "[^0-9a-zа-яіїєґ'\\-]+", " "))


def match_form(plain: Column) -> Column:
    """The form in which texts and identifiers are matched; ``plain`` has compatibility characters resolved (see ``decoders.nfkc``)."""
    t = F.translate(F.lower(plain), "ґ‐‑‒–—−", "г------")
    return F.trim(F.regexp_replace(t, r"[^0-9a-zа-яіїєг/\-]+", " "))


def identifier_form(plain: Column) -> Column:
    """An identifier without spaces and signs other than ``/`` and ``-``."""
    t = F.translate(F.lower(plain), "ґ‐‑‒–—−", "г------")
    return F.regexp_replace(t, r"[^0-9a-zа-яіїєг/\-]+", "")


def first_date(col: Column) -> Column:
    """ISO date of this century kept, else the first ``d.m.20yy`` (dot, dash, slash); the calendar is not checked."""
    iso = F.regexp_extract(col, r"(20\d{2}-\d{2}-\d{2})", 1)
    p = r"(\d{1,2})[.\-/](\d{1,2})[.\-/](20\d{2})"
    dmy = F.concat_ws("-", F.regexp_extract(col, p, 3), F.lpad(F.regexp_extract(col, p, 2), 2, "0"), F.lpad(F.regexp_extract(col, p, 1), 2, "0"))
    return F.when(iso != "", iso).when(F.regexp_extract(col, p, 3) != "", dmy)


def register_date(col: Column) -> Column:
    """DateType of the first ten characters, ISO or ``dd.MM.yyyy``; null where they are no date."""
    head = F.substring(clean(col), 1, 10)
    return F.coalesce(F.try_to_date(head, "yyyy-MM-dd"), F.try_to_date(head, "dd.MM.yyyy"))


def date_order(col: Column) -> Column:
    """Sort value: texts that are no date come before all dates."""
    d = register_date(col)
    return F.struct(d.isNotNull().alias("known"), F.coalesce(d.cast("string"), F.coalesce(clean(col), F.lit(""))).alias("value"))


def document_order(adjudication: Column, receipt: Column, doc_id: Column) -> Column:
    return F.struct(date_order(adjudication).alias("a"), date_order(receipt).alias("r"), F.coalesce(doc_id.try_cast("bigint"), F.lit(0)).alias("i"))


def date_spellings(day: Column, months: Iterable[str]) -> Column:
    """The four ways in which a text may write a date, as an array without repeats."""
    names = F.array(*[F.lit(m) for m in months])
    d, m, y = F.dayofmonth(day), F.month(day), F.year(day)
    return F.array_sort(F.array_distinct(F.array(F.date_format(day, "dd.MM.yyyy"), F.concat_ws(".", d, m, y), F.date_format(day, "yyyy-MM-dd"), F.concat_ws(" ", d, F.element_at(names, m), y))))


def result_key(date: Column, number: Column) -> Column:
    """Merge key ``date|number``; a missing part is the empty text."""
    return F.concat(F.coalesce(date, F.lit("")), F.lit("|"), F.coalesce(number, F.lit("")))


def decision_key(date: Column, number: Column, file_hash: Column) -> Column:
    """``date|number``, else ``unknown-date|number``, else ``file-hash|hash``."""
    return F.coalesce(F.concat(date, F.lit("|"), number), F.concat(F.lit("unknown-date|"), number), F.concat(F.lit("file-hash|"), file_hash))


def signature(*cols: Column) -> Column:
    """Non-empty parts joined by a bar."""
    return F.concat_ws("|", *[F.when(c != "", c) for c in cols])


def url_key(col: Column) -> Column:
    """A URL without slashes at its end."""
    return F.regexp_replace(col, "/+$", "")


def fit(col: Column, limit: int, marker: str = "\n\n[...]\n\n") -> Column:
    """Texts over ``limit`` characters: the first 70 % and the last 30 % of the limit with a marker between."""
    head = int(limit * 0.7)
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, head), F.lit(marker), F.right(col, F.lit(limit - head)))).otherwise(col)


def excerpt(col: Column, needles: Column, limit: int, head: int = 8000, before: int = 4500, after: int = 6500, tail: int = 4000) -> Column:
    """Head, a window around the first hit of each needle, tail; overlaps stay, the total is bounded by ``limit``."""
    low = F.lower(col)
    at = F.filter(F.transform(needles, lambda n: F.position(F.lower(n), low)), lambda p: p > 0)
    windows = F.concat(
        F.array(F.substring(col, 1, head)),
        F.transform(at, lambda p: F.substring(col, F.greatest(p - before, F.lit(1)), F.least(p + after - 1, F.length(col)) - F.greatest(p - before - 1, F.lit(0)))),
        F.array(F.right(col, F.lit(tail))),
    )
    kept = F.aggregate(
        windows,
        F.struct(F.lit(0).alias("used"), F.array().cast("array<string>").alias("out")),
        lambda acc, w: F.struct(
            (acc["used"] + F.least(F.length(w), F.lit(limit) - acc["used"])).alias("used"),
            F.when(acc["used"] < limit, F.concat(acc["out"], F.array(F.substring(w, F.lit(1), F.lit(limit) - acc["used"])))).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.array_join(F.filter(acc["out"], lambda x: x != ""), "\n\n[...]\n\n"),
    )
    return F.when(F.length(col) <= limit, col).otherwise(kept)


def token_estimate(col: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(col) / 2)).cast("int")


def unique_texts(col: Column) -> Column:
    """Array without blanks and repeats, each trimmed, in order of first sight."""
    return F.array_distinct(F.filter(F.transform(col, trim_all), lambda x: x != ""))


def escape_html(col: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        col = F.replace(col, F.lit(a), F.lit(b))
    return col


def plural(n: Column, one: str, few: str, many: str) -> Column:
    """Ukrainian plural by the last digits."""
    d, c = n % 10, n % 100
    return F.when((d == 1) & (c != 11), one).when(d.between(2, 4) & ~c.between(12, 14), few).otherwise(many)


def money(col: Column) -> Column:
    """Whole hryvnias, thousands apart by no-break spaces; a dash for none."""
    return F.when(F.coalesce(col, F.lit(0)) == 0, "—").otherwise(F.concat(F.translate(F.format_number(F.floor(col + 0.5), 0), ",", "\u00a0"), F.lit(" грн")))


def short_label(col: Column) -> Column:
    """A label without its leading article reference."""
    return F.regexp_replace(col, r"^(?:п\. *\d+ *ст\. *50|ст\. *[\d-]+[^—]*) *— *", "")


def amount(text: Column) -> Column:
    """Money of a text: digits, dots and commas stay, the first comma is the decimal sign; null if that is no number or zero."""
    t = F.regexp_replace(text, r"[^\d.,]", "")
    first = F.regexp_replace(t, r"^([^,]*),", "$1.")
    v = first.try_cast("double")
    return F.when(v != 0, v)


def tag_body(html: Column, tag: str) -> Column:
    """What stands in the first element of a tag; null where there is none."""
    body = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    return F.when(body != "", body)


def strip_tags(html: Column) -> Column:
    """Drawings, scripts and styles dropped, block ends as line ends, tags as blanks."""
    t = F.regexp_replace(html, r"(?is)<(script|style|noscript|svg)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</(?:p|div|li|tr|h[1-6]|section|article)\s*>", "\n")
    return F.regexp_replace(t, r"<[^>]*>", " ")


def page_title(html: Column) -> Column:
    """First heading, else the title element."""
    return compact(strip_tags(F.coalesce(tag_body(html, "h1"), tag_body(html, "title"), F.lit(""))))


def page_text(html: Column) -> Column:
    """Text of the main part: main, else article, else body, else all."""
    return normalize_spaces(strip_tags(F.coalesce(tag_body(html, "main"), tag_body(html, "article"), tag_body(html, "body"), html)))


def day_of(iso: Column) -> Column:
    """``dd.MM.yyyy`` of an ISO date, the text itself where it is none."""
    p = r"^(\d{4})-(\d{2})-(\d{2})"
    return F.when(iso.rlike(p), F.concat_ws(".", F.regexp_extract(iso, p, 3), F.regexp_extract(iso, p, 2), F.regexp_extract(iso, p, 1))).otherwise(iso)
