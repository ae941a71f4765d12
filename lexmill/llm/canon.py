"""One consistent form of visually identical text: a compiled longest-match transducer over grapheme clusters.

The mapping is computed once from the Unicode database and the look-alike pairs, and checked for conflicts
(one image for each key; no image is a key of another image). Its keys are grapheme clusters: a character, or a base letter
with the marks that make a letter of an alphabet; of several keys that start at a place the longest counts, and marks that
belong to none go. One compiled automaton runs over a text once, from left to right, and stops at

- the number of a decision, in whatever characters: digits, hyphen, solidus and suffix come out plain;
- a word (a run of letters, marks and invisible characters): its Cyrillic and its Latin image are built side by side, and the
  word's own letters decide at its end which one is emitted;
- any other cluster that has an image.

A test for characters that may have an image comes before, so that plain texts aren't run through at all.

Defined results: null stays null (no change); the empty text stays empty; text of plain characters comes out
as it is, so a text is changed if and only if its form differs from what came in; `№`, quotation marks,
apostrophes, plain spaces, tabs and line ends, dashes in names and letter case are plain. Texts of any
length are read whole.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.chars import CYRILLIC_ALIKE, DASHES, LATIN_ALIKE, SLASHES

#: Letters of the alphabets that may be native to a text.
ALPHABETS = {
    "uk": "абвгґдеєжзиіїйклмнопрстуфхцчшщьюя",
    "ru": "абвгдеёжзийклмнопрстуфхцчшщъыьэюя",
    "en": "abcdefghijklmnopqrstuvwxyz",
    "pl": "ąćęłńóśźż",
    "de": "äöüß",
}
#: Greek letters and the Cyrillic letters drawn like them, and lower-case letters whose upper case is drawn alike.
GREEK_ALIKE = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαβεικμνορτυχ"
GREEK_CYRILLIC = "АВЕЗНІКМНОРТУХавеікмноргух"
SMALL_LATIN = "tbhmnku"
SMALL_CYRILLIC = "твнмпки"
#: Legal forms made of letters that all have look-alikes.
LEGAL_FORMS = frozenset({"тов", "ооо", "ат", "ват", "тнв", "сооо"})
STYLES = ("<wide>", "<narrow>", "<font>", "<circle>", "<super>", "<sub>", "<small>", "<square>", "<compat>")
_SPACES = {chr(c) for c in range(0x80, 0x3001) if unicodedata.category(chr(c)) in ("Zs", "Zl", "Zp")} | {"\x85", "\xa0"}
_INVISIBLE_EXTRA = {"͏", "ᅟ", "ᅠ", "ㅤ", "ﾠ"} | {chr(c) for c in range(0xFE00, 0xFE10)}


class MappingConflictError(ValueError):
    """Two images for one key, or an image that would itself be mapped to something else."""


def invisible(c: str) -> bool:
    return unicodedata.category(c) == "Cf" or c in _INVISIBLE_EXTRA


@lru_cache
def style_map() -> dict[str, str]:
    """Width and style variants, spaces and invisible characters, each with its plain image."""
    out: dict[str, str] = {}
    for cp in range(0x80, sys.maxunicode + 1):
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Co", "Cs"):
            continue
        if invisible(c):
            out[c] = ""
        elif c in _SPACES:
            out[c] = " "
        elif unicodedata.decomposition(c).startswith(STYLES) and (kind[0] in "LN" or not unicodedata.decomposition(c).startswith("<compat>")):
            image = "".join(x for x in unicodedata.normalize("NFKC", c) if not invisible(x))
            if image != c and not any(unicodedata.category(x).startswith("M") for x in image):
                out[c] = image
    # follow images to their end, then check
    for c, image in out.items():
        out[c] = "".join(out.get(x, x) for x in image)
    return checked(out)


def checked(mapping: dict[str, str], more: dict[str, str] | None = None) -> dict[str, str]:
    """Join two mappings; raise where they disagree or where an image would be mapped again."""
    out = dict(mapping)
    for k, v in (more or {}).items():
        if out.setdefault(k, v) != v:
            raise MappingConflictError(f"{k!r}: {out[k]!r} and {v!r}")
    for k, v in out.items():
        if v != k and any(out.get(x, x) != x for x in v):
            raise MappingConflictError(f"{k!r} -> {v!r} is mapped again")
    return out


def _pairs(a: str, b: str) -> dict[str, str]:
    return dict(zip(a, b, strict=True))


@lru_cache
def to_cyrillic_map() -> dict[str, str]:
    return checked(_pairs(LATIN_ALIKE, CYRILLIC_ALIKE), _pairs(SMALL_LATIN[:5], SMALL_CYRILLIC[:5]) | _pairs(GREEK_ALIKE, GREEK_CYRILLIC) | {"u": "и"})


@lru_cache
def to_latin_map() -> dict[str, str]:
    return checked(_pairs(CYRILLIC_ALIKE, LATIN_ALIKE), {"к": "k", "в": "b", "н": "h", "м": "m", "т": "t"} | {"Ο": "O", "ο": "o", "Α": "A", "α": "a", "Ρ": "P", "ρ": "p", "Τ": "T", "τ": "t", "Β": "B", "Κ": "K", "κ": "k", "Ε": "E", "Ι": "I", "Μ": "M", "Ν": "N", "Χ": "X"})


def script(c: str) -> str:
    """C, L or G for a letter of those scripts, else the empty text."""
    cp = ord(c)
    if 0x400 <= cp <= 0x52F:
        return "C"
    if c.isascii():
        return "L" if c.isalpha() else ""
    if 0xC0 <= cp <= 0x24F or 0x1E00 <= cp <= 0x1EFF:
        return "L" if c.isalpha() else ""
    if 0x370 <= cp <= 0x3FF or 0x1F00 <= cp <= 0x1FFF:
        return "G" if c.isalpha() else ""
    return ""


class Keys(dict):
    """Grapheme cluster to its image in characters of the alphabets, by longest match; each cluster is compiled when it is first seen."""

    def __init__(self, native: set[str], style: dict[str, str]):
        super().__init__()
        self.style = style
        self.native = native
        # base letter with marks, in every order in which they decompose
        self.composed = {unicodedata.normalize("NFD", c): c for c in native if unicodedata.normalize("NFD", c) != c}

    def __missing__(self, cluster: str) -> str:
        base, marks = cluster[0], cluster[1:]
        if unicodedata.category(base)[0] == "M":  # marks without a base
            image = ""
        elif base in self.style:
            image = self.style[base]
        elif base in self.native or script(base) not in ("L", "C"):
            image = base
        else:  # a letter with an accent that no alphabet at hand has
            parts = unicodedata.normalize("NFD", base)
            image = parts[0] if len(parts) > 1 and all(unicodedata.category(x)[0] == "M" for x in parts[1:]) else base
        for m in marks:
            if m in self.style:
                image += self.style[m]
            elif image:
                image = image[:-1] + self.composed.get(unicodedata.normalize("NFD", image[-1] + m), image[-1])
        self[cluster] = image
        return image


class Transducer:
    """``profile``: ``text`` or ``number`` (every letter Cyrillic, every dash a hyphen, every slash a solidus)."""

    WORDS_KEPT = 200_000

    def __init__(self, profile: str = "text", alphabets: tuple[str, ...] = ("uk", "ru", "en")):
        self.profile = profile
        native = "".join(ALPHABETS[a] for a in alphabets)
        self.native = set(native) | set(native.upper()) | {"ß"}
        self.style, self.cyr, self.lat = style_map(), to_cyrillic_map(), to_latin_map()
        self.known: dict[str, str] = {}
        plain = "".join(sorted(self.native | {chr(c) for c in range(0x20, 0x7F)})) + "\t\n\r№«»“”„‘’‚ʼ`´…–—‐‑‒―−•·§°"
        plain = "".join(c for c in plain if c not in self.style)
        cyr, lat = "а-яА-ЯіїєґІЇЄҐёЁ", "a-zA-Z"
        forms = "|".join(sorted("".join(self.lat.get(x, x) for x in f) for f in LEGAL_FORMS))
        self.suspect = re.compile(rf"[^{re.escape(plain)}]|[{cyr}][{lat}]|[{lat}][{cyr}]|(?i:(?<![^\W_])(?:{forms})(?![^\W_]))|\d ?[{re.escape(DASHES)}] ?[рpРP]|\d ?-? ?[pP](?![a-zA-Z])|[рР] ?/ ?[kK](?![^\W_])")
        marks = "[" + re.escape("".join(self._marks())) + "\ufe00-\ufe0f\u034f]"
        self.keys = Keys(self.native, self.style)
        self.cluster = re.compile(rf"[\s\S]{marks}*")
        run = rf"(?P<word>(?:[^\W\d_]|{marks})+)"
        self.scan = re.compile(rf"(?P<number>{self._numbers()})|{run}|(?P<one>[^\x00-\x7f])")

    def _numbers(self) -> str:
        """Numbers of decisions with a dash, a letter or a suffix that is not plain, in any characters that stand for them."""
        images: dict[str, str] = {}
        for c, image in self.style.items():
            if len(image) == 1:
                plain = self.cyr.get(image, image)
                images[plain] = images.get(plain, "") + c
        gone = re.escape("".join(c for c, image in self.style.items() if not image))
        skip = f"[{gone}]*" if gone else ""

        def one(plain: str, more: str = "") -> str:
            return "[" + re.escape(plain + more + "".join(images.get(x, "") for x in plain)) + "]" + skip

        digit, blank, r, k = one("0123456789"), f"(?:{one(' ')})?", one("рР", "pP"), one("кК", "kK")
        slash, hyphen, dash = one("/"), one("-"), "[" + re.escape(DASHES) + "]" + skip
        prefix = rf"(?:(?:{digit}){{1,3}}{blank}{slash}{blank})?(?:{digit}){{1,5}}{blank}"
        latin = "[pP" + re.escape("".join(c for c, i in self.style.items() if i in ("p", "P"))) + "]" + skip
        latin_k = "[kK" + re.escape("".join(c for c, i in self.style.items() if i in ("k", "K"))) + "]" + skip
        tail = rf"(?:{blank}{slash}{blank}{k})?(?![^\W_])"
        suffix = rf"(?:{dash}{blank}{r}|(?:{hyphen})?{blank}{latin}){tail}"
        return rf"(?<![\w/])(?:{prefix}{suffix}|{prefix}(?:{hyphen})?{blank}{r}{blank}{slash}{blank}{latin_k}(?![^\W_]))"

    @staticmethod
    def _marks() -> list[str]:
        return [chr(c) for c in range(0x80, 0x20000) if unicodedata.category(chr(c)) in ("Mn", "Me", "Mc", "Cf")]

    def clusters(self, run: str) -> str:
        """The image of a run, cluster by cluster, each by its longest key."""
        return "".join(self.keys[m[0]] for m in self.cluster.finditer(run))

    def word(self, run: str) -> str:
        got = self.known.get(run)
        if got is None:
            got = self._word(run)
            if len(run) <= 64:
                if len(self.known) >= self.WORDS_KEPT:
                    self.known.clear()
                self.known[run] = got
        return got

    def _word(self, run: str) -> str:
        c = l = g = own_c = own_l = 0
        plain, cyr, lat = [], [], []
        for x in self.clusters(run):
            s = script(x)
            c, l, g = c + (s == "C"), l + (s == "L"), g + (s == "G")
            own_c, own_l = own_c + (s == "C" and x not in self.lat), own_l + (s == "L" and x not in self.cyr)
            plain.append(x)
            cyr.append(self.cyr.get(x, x) if s in "LG" else x)
            lat.append(self.lat.get(x, x) if s in "CG" else x)
        if self.profile == "number":
            return "".join(cyr)
        if not g and not (c and l):
            form = "".join(cyr)
            return form if l and form.lower() in LEGAL_FORMS and all(x in self.cyr for x in plain) else "".join(plain)
        if not c and not l:  # Greek letters alone
            return "".join(cyr) if all(script(x) == "C" for x in cyr) else "".join(plain)
        # letters of one script only decide; a word of look-alikes alone is taken as Cyrillic
        return "".join(lat if own_l and not own_c else cyr)

    def _number(self, run: str) -> str:
        plain = "".join(self.keys[c] for c in run)
        return "".join("-" if x in DASHES else self.cyr.get(x, x) for x in plain)

    def _emit(self, m: re.Match) -> str:
        if m.lastgroup == "word":
            return self.word(m[0])
        return self._number(m[0]) if m.lastgroup == "number" else self.keys[m[0]]

    def __call__(self, text: str) -> str:
        if not text or self.profile == "text" and not self.suspect.search(text):
            return text
        out = self.scan.sub(self._emit, text)
        if self.profile == "number":
            return "".join("-" if x in DASHES else "/" if x in SLASHES else x for x in out)
        return out


@lru_cache
def transducer(profile: str) -> Transducer:
    return Transducer(profile)


def canonical(df: DataFrame, key: str, fields: dict[str, str], only_changed: bool = False, texts: bool = True) -> DataFrame:
    """``key, field_name, changed`` (and ``plain``, an array of the field's consistent texts) for each record and field.

    ``fields``: column (string or array of strings) to profile. Null fields give ``changed`` false and a
    null ``plain``; a null element of an array stays null. Rows of a repeated key come out each. Only ``key``
    and the named columns are read, so other columns may have any name. Narrow: no shuffle.
    """
    kinds = dict(df.dtypes)
    cols = [F.col(f"`{key}`").alias("k")] + [(F.col(f"`{c}`") if kinds[c].startswith("array") else F.when(F.col(f"`{c}`").isNotNull(), F.array(f"`{c}`"))).alias(f"f{i}") for i, c in enumerate(fields)]
    names, profiles = list(fields), list(fields.values())

    def run(batches):
        machines = [transducer(p) for p in profiles]
        for b in batches:
            ks, cols_out = [], ([], [], [], [])
            keys = b.column(0)
            for i, name in enumerate(names):
                machine, column = machines[i], b.column(i + 1)
                values, seen = column.values.to_pylist(), column.offsets.to_pylist()
                valid = column.is_valid().to_pylist()
                for row in range(len(column)):
                    changed, plain = False, None
                    if valid[row]:
                        part = values[seen[row] : seen[row + 1]]
                        plain = [x if x is None else machine(x) for x in part]
                        changed = plain != part
                    if changed or not only_changed:
                        ks.append(row)
                        cols_out[0].append(name)
                        cols_out[1].append(changed)
                        cols_out[2].append(plain if texts else None)
            yield pa.record_batch([keys.take(pa.array(ks, pa.int64())), pa.array(cols_out[0], pa.string()), pa.array(cols_out[1], pa.bool_()), pa.array(cols_out[2], pa.list_(pa.string()))], names=["k", "field_name", "changed", "plain"])

    got = df.select(*cols).mapInArrow(run, f"k {kinds[key]}, field_name string, changed boolean, plain array<string>")
    out = got.withColumnRenamed("k", key)
    return out if texts else out.drop("plain")
