"""Character classes and foldings, built by rule from the Unicode database.

Only the look-alike pairs are data: they say which letters of two alphabets are drawn alike.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin letters and the Cyrillic letters drawn like them.
LATIN_ALIKE = "AaBCcEeHIiJjKkMOoPpSsTXxYy"
CYRILLIC_ALIKE = "АаВСсЕеНІіЈјКкМОоРрЅѕТХхУу"
#: Dashes and minus signs that stand for a hyphen, and slashes that stand for a solidus.
DASHES = "‐‑‒–—―−﹘﹣－"
SLASHES = "∕⁄／"


@lru_cache
def digit_pairs() -> tuple[str, str]:
    """All characters with a digit value that are no ASCII digits (also super- and subscripts, styles), with their digits."""
    src, dst = [], []
    for cp in range(0x80, sys.maxunicode + 1):
        c = chr(cp)
        d = unicodedata.digit(c, None)
        if d is not None and unicodedata.category(c) in ("Nd", "No"):
            src.append(c)
            dst.append(str(d))
    return "".join(src), "".join(dst)


@lru_cache
def width_pairs() -> tuple[str, str]:
    """Full-width forms of ASCII, with the plain character."""
    src = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
    return src, "".join(chr(ord(c) - 0xFEE0) for c in src)


#: Invisible characters: format characters, soft hyphen, variation selectors; spaces other than the plain one.
INVISIBLE_CLASS = r"[\p{Cf}\x{00AD}\x{FE00}-\x{FE0F}\x{034F}\x{115F}\x{1160}\x{3164}]"
SPACE_CLASS = r"[\s\x{0085}\p{Z}]"


def fold_digits(col: Column) -> Column:
    """Any digit character to its ASCII digit; full-width ASCII to ASCII. JVM only."""
    d, w = digit_pairs(), width_pairs()
    seen = dict(zip(w[0], w[1])) | dict(zip(d[0], d[1]))
    return F.translate(col, "".join(seen), "".join(seen.values()))


def plain_spaces(col: Column) -> Column:
    """Drop invisible characters, turn every run of white space of any kind into one space, trim."""
    return F.trim(F.regexp_replace(F.regexp_replace(col, INVISIBLE_CLASS, ""), SPACE_CLASS + "+", " "))


def to_cyrillic(col: Column) -> Column:
    """Latin look-alikes to Cyrillic."""
    return F.translate(col, LATIN_ALIKE, CYRILLIC_ALIKE)


def to_latin(col: Column) -> Column:
    """Cyrillic look-alikes to Latin."""
    return F.translate(col, CYRILLIC_ALIKE, LATIN_ALIKE)


def plain_marks(col: Column) -> Column:
    """Dashes to the hyphen, slashes to the solidus."""
    return F.translate(col, DASHES + SLASHES, "-" * len(DASHES) + "/" * len(SLASHES))
