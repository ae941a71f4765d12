"""Names of parties read into parts: legal form, kind of business, own name, addition, place; or the parts of a person's name.

Reading is per name (Python, once for each distinct name); the parts are compared in one alphabet: Latin
spellings are read back into Cyrillic letters, letters that are often left out or exchanged in
transliteration are made one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

from lexmill.llm.canon import Transducer

#: Legal forms, each with its spellings (lower case).
FORMS = {
    "тов": ["товариство з обмеженою відповідальністю", "тов", "ооо", "общество с ограниченной ответственностью", "tov", "ooo", "товариство"],
    "прат": ["приватне акціонерне товариство", "прат", "чао", "частное акционерное общество", "prat"],
    "пат": ["публічне акціонерне товариство", "пат", "пао", "публичное акционерное общество", "pat"],
    "ат": ["акціонерне товариство", "акционерное общество", "ат"],
    "пп": ["приватне підприємство", "пп", "чп", "частное предприятие", "pp"],
    "дп": ["державне підприємство", "дп", "гп", "государственное предприятие", "dp"],
    "кп": ["комунальне підприємство", "кп", "коммунальное предприятие", "kp"],
    "фоп": ["фізична особа-підприємець", "фізична особа - підприємець", "фізична особа підприємець", "фоп", "фоп", "флп", "физическое лицо-предприниматель", "fop"],
}
#: Kinds of business with their abbreviations.
BUSINESS = {
    "бк": "будівельна компанія",
    "мц": "медичний центр",
    "тд": "торговий дім",
    "тк": "транспортна компанія",
    "вк": "виробнича компанія",
    "нвп": "науково-виробниче підприємство",
    "апф": "агропромислова фірма",
    "іг": "інвестиційна група",
}
#: Additions that tell related firms apart.
ADDITIONS = ["захід", "груп", "плюс", "буд", "агро", "україна", "сервіс", "енерго", "трейд", "фарм", "інвест", "логістик"]
#: Short given names and the full ones.
SHORT_NAMES = {
    "слава": "вячеслав", "славко": "вячеслав", "катя": "катерина", "рома": "роман", "юра": "юріі", "аня": "ганна", "анна": "ганна", "ксеня": "оксана", "ксенія": "оксана",
    "стьопа": "степан", "стопа": "степан", "женя": "євген", "діма": "дмитро", "міша": "михаіло", "миша": "михаіло", "мишко": "михаіло", "саша": "олександр", "сашко": "олександр", "лесь": "олександр",
    "наташа": "наталія", "наталка": "наталія", "таня": "тетяна", "люда": "людмила", "мила": "людмила", "вова": "володимир", "володя": "володимир", "гоша": "ігор", "ігорьок": "ігор", "оксанка": "оксана", "ганя": "ганна", "галя": "ганна",
}
#: Common given names that have no short form above.
GIVEN_NAMES = "андріі анатоліі антон артем богдан борис вадим василь віктор віталіі валеріі григоріі денис іван ілля кирило костянтин леонід лев максим марко микита микола назар олег олексіі остап павло петро руслан святослав сергіі тарас тимоті федір юліан ярослав алла анастасія богдана валентина валерія вікторія віра галина дарина євгенія жанна зоя інна ірина ксенія лариса леся лідія любов марина марія надія ніна оксана олена олександра ольга раїса роксолана світлана софія уляна юлія яна ярослава"
#: Letters of the official romanisation, longest first where they overlap.
ROMAN = [("shch", "щ"), ("zgh", "зг"), ("zh", "ж"), ("kh", "х"), ("ts", "ц"), ("ch", "ч"), ("sh", "ш"), ("ia", "я"), ("ya", "я"), ("iu", "ю"), ("yu", "ю"), ("ie", "є"), ("ye", "є"), ("yi", "ї")] + list(zip("abvhgdezyiklmnoprstufxc", "абвгґдезиіклмнопрстуфхц"))
_ROMAN = re.compile("|".join(a for a, _ in ROMAN))
_ROMAN_TO = dict(ROMAN)
_WORD = re.compile(r"[^\W\d_]+|\d+")
_PLACE = re.compile(r"\(\s*(?:м|місто|смт|с)\.?\s*([^)]*)\)")
_APOSTROPHE = re.compile("(?<=[^\\W\\d_])['’‘ʼ`´](?=[^\\W\\d_])")
_QUOTES = re.compile("[«»“”„\"'‘’`]")
_QUOTED = re.compile("^\\s*([^«“„\"‘'’]*[^\\W\\d_][^«“„\"‘'’]*?)\\s*[«“„\"‘'’](?=[^\\W_])")
_PATRONYMIC = re.compile(r"(?:ович|евич|івна|овна|евна|ічна|кіч|міч|ліч)$")
#: Most words of a person's name.
PERSON_WORDS = 5
_GLUED = re.compile(r"^(ПрАТ|ТОВ|ООО|ПАТ|ПАО|ЧАО|ФОП|ПП|ЧП|ДП|ГП|КП)(?:['’‘`]|(?=[А-ЯІЇЄҐ][а-яіїєґ]))")


def cyrillic(word: str) -> str:
    """A lower-case word in Cyrillic letters, with letters made one that spellings exchange."""
    if word.isascii():
        word = _ROMAN.sub(lambda m: _ROMAN_TO[m[0]], word)
    return word.translate(_ONE)


_ONE = str.maketrans({"й": "і", "ї": "і", "ґ": "г", "ь": None, "ё": "е", "э": "е", "ы": "и", "ъ": None})


@lru_cache
def _given() -> frozenset[str]:
    return frozenset(cyrillic(w) for w in [*GIVEN_NAMES.split(), *SHORT_NAMES.values()])


def near(a: str, b: str) -> bool:
    """At most one letter missing, added, changed, or exchanged with its neighbour."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[1::-1] and x[2:] == y[2:] and len(x) > 1)


def person(words: list[str]) -> tuple[str, ...]:
    """Surname first, then the other words in their order; short given names in full."""
    short = _phrases()[2]
    full = [i for i, w in enumerate(words) if len(w) > 1]
    words = [short.get(w, w) for w in words]
    given = [i for i in full if words[i] in _given()] or [i for i in full if len(words[i]) > 3 and any(near(words[i], g) for g in _given())]
    if len(full) == 1:
        own = full[0]
    elif not full:
        return ()
    elif given:
        g = min(given, key=lambda i: (i == 0 and len(full) > 1 and full[0] == 0 and 1 in given, i))
        rest = [i for i in full if i != g]
        # a patronymic stands right after the given name
        own = rest[0] if len(rest) == 1 else next(i for i in rest if i != g + 1) if g + 1 in rest else rest[0]
    else:
        own = full[0]
    return (words[own], *(w for i, w in enumerate(words) if i != own))


@lru_cache
def _phrases() -> tuple[dict, dict, dict, set]:
    def key(s: str) -> tuple[str, ...]:
        return tuple(cyrillic(w) for w in _WORD.findall(s))

    forms = {key(s): f for f, spellings in FORMS.items() for s in spellings}
    business = {key(s): b for b, s in BUSINESS.items()} | {key(b): b for b in BUSINESS}
    roman_business = {"torhovyi dim": "тд", "medychnyi tsentr": "мц", "budivelna kompaniia": "бк", "transportna kompaniia": "тк", "vyrobnycha kompaniia": "вк", "naukovo-vyrobnyche pidpryiemstvo": "нвп", "ahropromyslova firma": "апф", "investytsiina hrupa": "іг", "mts": "мц", "ih": "іг", "apf": "апф", "nvp": "нвп", "td": "тд", "tk": "тк", "bk": "бк", "vk": "вк"}
    business |= {key(s): b for s, b in roman_business.items()}
    short = {cyrillic(a): cyrillic(b) for a, b in SHORT_NAMES.items()}
    return forms, business, short, {cyrillic(a) for a in ADDITIONS}


@dataclass(frozen=True)
class Party:
    """``kind``: ``firm``, ``person`` or empty (anonymous or unreadable). ``words``: the own name of a firm, or of a person the surname and then the rest."""

    kind: str
    form: str
    business: str
    words: tuple[str, ...]
    addition: str
    place: str


EMPTY = Party("", "", "", (), "", "")


@lru_cache
def _plain() -> Transducer:
    return Transducer("text", ("uk", "ru", "en"))


def _take(words: list[str], phrases: dict, ends: bool) -> str:
    """Remove the longest phrase that starts (or also ends) the words; its meaning."""
    for n in range(min(5, len(words)), 0, -1):
        got = phrases.get(tuple(words[:n]))
        if got:
            del words[:n]
            return got
        got = phrases.get(tuple(words[-n:])) if ends else None
        if got:
            del words[-n:]
            return got
    return ""


def place_key(place: str) -> str:
    """A place in one form."""
    return "".join(cyrillic(w) for w in _WORD.findall(_APOSTROPHE.sub("", place.lower())))


def _unknown_form(text: str) -> tuple[str, ...]:
    """Words before a quoted name that are no known form or business: a form that no list has (a concern, a fund, a farm)."""
    m = _QUOTED.match(text)
    words = [cyrillic(w) for w in _WORD.findall(_APOSTROPHE.sub("", m[1]).lower())] if m else []
    rest = list(words)
    forms, business, _, _ = _phrases()
    while rest and (_take(rest, forms, True) or _take(rest, business, True)):
        pass
    return tuple(words) if words and rest == words else ()


def is_person(words: list[str]) -> bool:
    """Words with a given name, an initial or a patronymic among them."""
    if not 2 <= len(words) <= PERSON_WORDS:
        return False
    short, given = _phrases()[2], _given()
    return any(len(w) == 1 and w.isalpha() or w in given or w in short or _PATRONYMIC.search(w) or len(w) > 3 and any(near(w, g) for g in given) for w in words)


def _unglued(words: list[str]) -> list[str]:
    """A form typed onto the word after it, where that word is a kind of business."""
    forms, business, _, _ = _phrases()
    starts = {k[0] for k in business}
    for n in range(2, len(words[0]) - 1) if words else ():
        if words[0][:n] in {k[0] for k in forms if len(k) == 1} and words[0][n:] in starts:
            return [words[0][:n], words[0][n:], *words[1:]]
    return words


def read(name: str | None, learned: frozenset[str] = frozenset()) -> Party:
    """Parts of a name; the null, empty or anonymous name has none. ``learned``: further additions (see :func:`tails`)."""
    if not name:
        return EMPTY
    text = _plain()(name)
    place = ""
    m = _PLACE.search(text)
    if m:
        place = place_key(m[1])
        text = text[: m.start()] + " " + text[m.end() :]
    unknown = _unknown_form(_APOSTROPHE.sub("", text))
    text = _APOSTROPHE.sub("", _GLUED.sub(r"\1 ", text.strip()))
    text = _GLUED.sub(r"\1 ", _QUOTES.sub(" ", text).strip())
    words = _unglued([cyrillic(w) for w in _WORD.findall(text.lower())])
    forms, business, _, additions = _phrases()
    additions = additions | learned
    form = _take(words, forms, True)
    if not words or words[0].startswith(("особа", "інформація", "назва")):
        return EMPTY
    if not form and unknown and len(words) > len(unknown):
        form, words = " ".join(unknown), words[len(unknown) :]
    elif form == "фоп" or not form and is_person(words):
        words = person(words)
        return Party("person", "", "", words, "", place) if words else EMPTY
    line = _take(words, business, False)
    addition = ""
    if len(words) > 1 and (words[-1] in additions or words[-1].isdigit()):
        addition = words.pop()
    elif len(words) == 1:
        for a in sorted(additions, key=len, reverse=True):
            if words[0].endswith(a) and len(words[0]) >= len(a) + 4:
                words[0], addition = words[0][: -len(a)], a
                break
    return Party("firm", form, line, tuple(words), addition, place)


def tails(name: str | None) -> tuple[str, str] | None:
    """Last word of a firm's name and the word before it; what many firms share there is an addition."""
    p = read(name)
    words = [*p.words, *filter(None, [p.addition])] if p.kind == "firm" else []
    return (words[-1], words[-2]) if len(words) > 1 and not words[-1].isdigit() else None
