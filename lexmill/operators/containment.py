"""Texts that contain an identifier: boundary-safe containment without a nested loop.

Tokens of identifier shape are cut out of each text once, brought to the canonical form of identifiers and
joined by equality; the boundary test runs on the joined pairs only. An identifier may be written with
spaces around its signs and without its dashes; a slash must be there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGE = "0-9a-zа-яіїєг/"


def canonical(identifier: Column) -> Column:
    """Spaces and dashes dropped: equal for all the ways in which one identifier may be written."""
    return F.regexp_replace(identifier, r"[\s-]+", "")


def _parts(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(text, "([/-])", " $1 "), " +"), lambda p: (p != "") & (p != "-"))


def shapes(identifiers: DataFrame, identifier: str) -> tuple[list[str], list[int]]:
    """First characters of the identifiers, and the numbers of parts that they have with all, some or none of their dashes: one aggregate."""
    c = F.col(identifier)
    lengths = F.sequence(F.size(_parts(F.regexp_replace(c, "-", ""))), F.size(_parts(c)))
    own = identifiers.filter(canonical(c) != "").select(F.substring(canonical(c), 1, 1).alias("s"), F.explode(lengths).alias("n"))
    one = own.agg(F.sort_array(F.collect_set("s")), F.sort_array(F.collect_set("n"))).first()
    return list(one[0]), list(one[1])


def tokens(text: Column, starts: list[str], lengths: list[int]) -> Column:
    """Canonical forms of all runs of as many parts (words and signs) of a matched-form text as in ``lengths`` that start with one of ``starts``.

    The text is cut at blanks, slashes and dashes once; no pattern with a repeated group runs over it, so texts of
    any length are safe. Only runs of shapes that some identifier has (see :func:`shapes`) are made.
    """
    wanted = F.array(*[F.lit(n) for n in lengths or [0]])

    def runs(p: Column) -> Column:
        at = F.filter(F.sequence(F.lit(1), F.size(p)), lambda i: F.substring(F.element_at(p, i), 1, 1).isin(*starts))
        return F.flatten(F.transform(at, lambda i: F.transform(F.filter(wanted, lambda k: k <= F.size(p) - i + 1), lambda k: F.array_join(F.slice(p, i, k), ""))))

    # the parts are computed once, and a text without any has no runs
    return F.array_distinct(F.flatten(F.transform(F.filter(F.array(_parts(text)), lambda p: F.size(p) > 0), runs)))


def pattern(identifier: Column) -> Column:
    """The boundary-safe pattern of one identifier, used on joined pairs only."""
    body = F.regexp_replace(F.regexp_replace(identifier, "/", r"\\s*/\\s*"), "-", r"\\s*-?\\s*")
    return F.concat(F.lit(f"(?<![{EDGE}])"), body, F.lit(f"(?![{EDGE}])"))


def contained(texts: DataFrame, doc: str, form: str, identifiers: DataFrame, identifier: str) -> DataFrame:
    """``doc, identifier``: each text and each identifier that it holds. Rows of both inputs should be distinct by those columns."""
    ids = identifiers.select(identifier).filter(F.col(identifier) != "").distinct().withColumn("_t", canonical(F.col(identifier)))
    cut = texts.select(doc, F.explode(tokens(F.col(form), *shapes(ids, identifier))).alias("_t"))
    # only keys and tokens are joined; the texts come back for the pairs that are left
    # the optimizer's estimates go by the size of the files, far below that of tokens and texts: merged, neither is ever sent to the driver for a broadcast
    pairs = cut.join(ids.hint("merge"), "_t").select(doc, identifier).distinct().join(texts.select(doc, form).hint("merge"), doc)
    return pairs.filter(F.regexp_like(F.col(form), pattern(F.col(identifier)))).select(doc, identifier).distinct()
