"""Rules over the texts of decisions: number and day, outcome, relevance, norms, canonical classification.

All rules are Column expressions; a phrase is built from its words, with white space of any kind between them, and
compared without regard to case.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.registry_text import MONTHS_GENITIVE
from lexmill.functions.text import WS, normalize_spaces, unique_texts
from lexmill.operators.rules import UNFAIR_ARTICLES, any_of, cascade, code_map, primary_code

#: The points of the article on violations, 1 to 21, and the articles on unfair competition, with their labels.
POINT_LABELS = [
    "антиконкурентні узгоджені дії",
    "зловживання монопольним (домінуючим) становищем",
    "антиконкурентні дії органів влади, органів місцевого самоврядування, органів адміністративно-господарського управління та контролю",
    "невиконання рішення, попереднього рішення органів АМКУ або їх виконання не в повному обсязі",
    "дії учасників узгоджених дій, заборонені згідно з ч. 5 ст. 10 Закону",
    "делегування повноважень у випадках, заборонених ст. 16 Закону",
    "вчинення дій, заборонених ст. 17 Закону",
    "обмежувальна та дискримінаційна діяльність, заборонена ч. 2 ст. 18, ст. 19 і 20 Закону",
    "обмежувальна діяльність, заборонена ч. 1 ст. 18 Закону",
    "недотримання умов, передбачених пунктами 2, 5 та 6 ч. 3 ст. 22 Закону",
    "порушення положень погоджених установчих документів суб’єкта, створеного в результаті концентрації",
    "концентрація без отримання відповідного дозволу органів АМКУ",
    "неподання інформації у встановлені строки",
    "подання інформації в неповному обсязі у встановлені строки",
    "подання недостовірної інформації",
    "створення перешкод працівникам АМКУ у проведенні перевірок, огляду, вилученні чи накладенні арешту",
    "надання рекомендацій, що схиляють до вчинення порушень або сприяють таким порушенням",
    "обмеження в господарській діяльності у відповідь на звернення до АМКУ",
    "невиконання вимог і зобов’язань, якими було обумовлене рішення про надання дозволу",
    "обмежувальна діяльність об’єднань, заборонена ст. 21 Закону",
    "розпломбування приміщень, систем електронних комунікацій, інших володінь чи місць зберігання інформації",
]
ARTICLE_LABELS = {
    "4": "неправомірне використання позначень",
    "5": "неправомірне використання товару іншого виробника",
    "6": "копіювання зовнішнього вигляду виробу",
    "7": "порівняльна реклама",
    "8": "дискредитація суб’єкта господарювання",
    "10": "схилення до бойкоту суб’єкта господарювання",
    "11": "схилення постачальника до дискримінації покупця (замовника)",
    "13": "підкуп працівника, посадової особи постачальника",
    "14": "підкуп працівника, посадової особи покупця (замовника)",
    "15": "досягнення неправомірних переваг у конкуренції",
    "15-1": "поширення інформації, що вводить в оману",
    "16": "неправомірне збирання комерційної таємниці",
    "17": "розголошення комерційної таємниці",
    "18": "схилення до розголошення комерційної таємниці",
    "19": "неправомірне використання комерційної таємниці",
}
#: Outcomes with their labels and the spellings that annotations use.
OUTCOME_LABELS = {"violation_found": "Порушення встановлено", "proceeding_closed_no_violation": "Провадження закрито / порушення не доведено", "permit_granted": "Дозвіл надано", "other": "Інший результат"}
OUTCOME_ALIASES = {
    "violation_found": "violation_found",
    "порушення встановлено": "violation_found",
    "proceeding_closed_no_violation": "proceeding_closed_no_violation",
    "closed_no_violation": "proceeding_closed_no_violation",
    "no_violation_found": "proceeding_closed_no_violation",
    "провадження закрито": "proceeding_closed_no_violation",
    "порушення не доведено": "proceeding_closed_no_violation",
    "permit_granted": "permit_granted",
    "дозвіл надано": "permit_granted",
    "other": "other",
}
#: How much of a text each rule reads from its start, and the tail that the outcome reads as well (features of the rules).
HEAD_CLOSED, HEAD_PERMIT, HEAD_RELEVANT, HEAD_META, TAIL_OUTCOME = 45_000, 18_000, 25_000, 6_000, 18_000
HEAD_CODE, TAIL_CODE = 25_000, 12_000


def phrase(*words: str) -> str:
    """Words with white space of any kind between them."""
    return f"{WS}+".join(words)


def apart(a: str, b: str, most: int) -> str:
    """Two phrases with at most ``most`` characters of any kind between them."""
    return rf"{a}[\s\S]{{0,{most}}}?{b}"


#: A point in words or short, with its number as the only group; what it is a point of.
_POINT_WORD, _POINT_SHORT, _OF_50 = f"пункт(?:ом|у|а|і)?{WS}*", rf"п\.?{WS}*", f"{WS}+статті{WS}*50"
_SHORT_50 = rf"{WS}*ст\.?{WS}*50"
POINTS = [rf"{_POINT_WORD}(\d{{1,2}}){_OF_50}", rf"{_POINT_SHORT}(\d{{1,2}}){_SHORT_50}", rf"{_POINT_WORD}(\d{{1,2}}){WS}+{phrase('частини', 'першої')}{_OF_50}"]
_LAW = phrase("Закону", "України", "«?Про", "захист", "від", "недобросовісної", "конкуренції»?")
_ARTICLE = rf"(15{WS}*[-–—]?{WS}*1|15{WS}*¹|\d{{1,2}}){WS}+"
ARTICLES = [rf"статт(?:і|ею|я){WS}*{_ARTICLE}{_LAW}", rf"ст\.?{WS}*{_ARTICLE}{_LAW}"]
_ECONOMIC = phrase("законодавства", "про", "захист", "економічної", "конкуренції")
_UNFAIR = phrase("законодавства", "про", "захист", "від", "недобросовісної", "конкуренції")
_CONCENTRATION = "концентраці[юї]"
CLOSED = [
    phrase("про", "закриття", "провадження"),
    phrase("закрит(?:и|тя)", "провадження"),
    apart(phrase("не", "доведено", "вчинення"), "порушення", 180),
    apart("порушення", phrase("не", "доведено"), 180),
]
PERMIT = [phrase("про", "надання", "дозволу", "на", _CONCENTRATION), *[apart(phrase("надати", "дозвіл"), phrase("на", x), 250) for x in (_CONCENTRATION, "створення")]]
VIOLATION = [phrase("справ[аи]", "про", "порушення"), phrase("провадженн[яі]", "у", "справ[іи]"), rf"пункт(?:ом|у)?{WS}*\d{{1,2}}{_OF_50}", rf"п\.{WS}*\d{{1,2}}{WS}*ст\.{WS}*50"]
INCLUDED = [phrase("про", "порушення", _ECONOMIC), phrase("порушення", _UNFAIR)]
PROCEDURAL = [phrase("про", a, "сплати", "штрафу") for a in ("розстрочення", "відстрочення")] + [phrase("про", a, "рішення") for a in ("перевірку", "перегляд")] + [phrase("про", "внесення", "змін")]


def says(text: Column, phrases: Iterable[str]) -> Column:
    return any_of(text, list(phrases))


def head(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def _all(text: Column, patterns: list[str]) -> Column:
    return F.concat(*[F.coalesce(F.regexp_extract_all(text, F.lit("(?iu)" + p), F.lit(1)), F.array().cast("array<string>")) for p in patterns])


def points(text: Column) -> Column:
    """Points of the article on violations that a text names, and the two it implies, ascending."""
    named = F.transform(_all(text, POINTS), lambda x: x.try_cast("int"))
    agreed = says(text, [rf"{_POINT_WORD}4{WS}+{phrase('частини', 'другої', 'статті')}{WS}*6"]) & says(text, [phrase("антиконкурентн[іи]", "узгоджен[іи]", "ді[їй]")])
    dominant = says(text, [rf"{phrase('частин[аи]', 'перш[аої]+', 'статті')}{WS}*13"]) & says(text, ["зловживан"])
    implied = F.array_compact(F.array(F.when(agreed, 1), F.when(dominant, 2)))
    return F.array_sort(F.array_distinct(F.filter(F.concat(named, implied), lambda n: n.between(1, len(POINT_LABELS)))))


def article(value: Column) -> Column:
    """An article on unfair competition in its own form (``15-1``), null for any other."""
    t = F.lower(value)
    for p in ("¹", rf"прим\.{WS}*1", f"примітка{WS}*1"):
        t = F.regexp_replace(t, p, "-1")
    t = F.translate(F.regexp_replace(t, WS, ""), "–—", "--")
    number = F.regexp_extract(t, r"^(\d+)", 1)
    number = F.regexp_replace(number, r"^0+(?=\d)", "")
    return F.when(t.rlike("^15-?1$"), "15-1").when(number.isin(*UNFAIR_ARTICLES), number)


def articles(text: Column) -> Column:
    """Articles on unfair competition that a text names, 15 before 15-1 before 16."""
    found = F.array_distinct(F.array_compact(F.transform(_all(text, ARTICLES), article)))
    ordered = F.array_sort(F.transform(found, lambda a: F.struct(F.replace(a, F.lit("-1"), F.lit(".1")).cast("double").alias("n"), a.alias("a"))))
    return F.transform(ordered, lambda x: x["a"])


def concentration_without_permit(text: Column) -> Column:
    """Point 12, a concentration, and the lack of a permit: one phrase of each."""
    point = says(text, [rf"пункт(?:ом|у)?{WS}*12{_OF_50}", rf"{_POINT_SHORT}12{_SHORT_50}"])
    act = says(text, [phrase("здійснення", "концентрації"), phrase("концентраці[яї]", "без", "отримання"), phrase("набуття", "контролю"), phrase("придбання", "акці[йї]"), phrase("придбання", "активів")])
    return point & act & says(text, [phrase("без", "отримання", f"(?:відповідного{WS}+)?дозволу"), phrase("наявність", "такого", "дозволу", "необхідна")])


def names_norm(text: Column) -> Column:
    """A text names a norm that may be violated."""
    return (F.size(points(text)) > 0) | (F.size(articles(text)) > 0) | concentration_without_permit(text) | says(text, [_ECONOMIC, _UNFAIR])


def is_closed(text: Column) -> Column:
    """Proceedings on a violation that were closed without one."""
    h = head(text, HEAD_CLOSED)
    return says(h, CLOSED) & names_norm(h)


def is_permit_only(text: Column) -> Column:
    """A permit for a concentration and nothing about a violation."""
    h = head(text, HEAD_PERMIT)
    return says(h, PERMIT) & ~is_closed(text) & ~says(h, VIOLATION)


def outcome(text: Column) -> Column:
    """Outcome that a text shows; where nothing else does, a violation was found."""
    t = F.concat(head(text, HEAD_CLOSED), F.lit("\n"), F.right(text, F.lit(TAIL_OUTCOME)))
    return cascade([(is_closed(t), "proceeding_closed_no_violation"), (is_permit_only(t), "permit_granted")], "violation_found")


def outcome_of(value: Column, text: Column) -> Column:
    """Code of an annotated outcome in any of its spellings, else what the text shows, else a violation."""
    inferred = F.when(F.coalesce(text, F.lit("")) != "", outcome(normalize_spaces(text))).otherwise("violation_found")
    return code_map(F.coalesce(value, F.lit("")), OUTCOME_ALIASES, inferred)


def outcome_code(value: Column) -> Column:
    """The same for finished rows, where only the codes count."""
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(v.isin("proceeding_closed_no_violation", "closed_no_violation", "no_violation_found"), "proceeding_closed_no_violation").when(v.isin("permit_granted", "other"), v).otherwise("violation_found")


def outcome_label(code: Column, given: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for p in OUTCOME_LABELS.items() for x in p])
    return F.coalesce(F.when(given != "", given), F.try_element_at(labels, code))


def relevance(text: Column, closed_only: bool = False, procedural: bool = False, point_12: bool = True) -> Column:
    """``relevant, reason, law_area, outcome`` of a text: the first step of the cascade that holds.

    ``closed_only``: nothing but closed proceedings; ``procedural``: take procedural decisions; ``point_12``: take concentrations without a permit.
    """
    h, closed = head(text, HEAD_RELEVANT), is_closed(text)
    steps = [(~closed, "closure_backfill_non_closure")] if closed_only else []
    steps += [(is_permit_only(text), "permit_only_concentration_or_clearance"), (~(says(h, INCLUDED) | closed), "not_violation_decision")]
    steps += [] if procedural else [(says(h, PROCEDURAL) & ~closed, "procedural_decision")]
    steps += [] if point_12 else [(concentration_without_permit(text), "concentration_without_permit_p12")]
    reason = cascade([*steps, (closed, "closure_practice")], "included_by_regex")
    relevant = reason.isin("closure_practice", "included_by_regex")
    area = F.when(says(h, [phrase("недобросовісної", "конкуренції")]), "unfair_competition").otherwise("economic_competition")
    result = F.when(closed, "proceeding_closed_no_violation").otherwise(outcome(text))
    return F.struct(relevant.alias("relevant"), reason.alias("reason"), F.when(relevant, area).alias("law_area"), F.when(relevant, result).alias("outcome"))


def meta(text: Column, file_name: Column) -> Column:
    """``decision_date, decision_number`` from the start of a text: the first day in words; the first number after it, else anywhere, else of the file name."""
    t = head(normalize_spaces(text), HEAD_META)
    months = "|".join(MONTHS_GENITIVE)
    day = rf"(?iu)(\d{{1,2}}){WS}+({months}){WS}+(20\d{{2}})"
    month = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS_GENITIVE) for x in (m, f"{i + 1:02d}")])
    part = lambda i: F.regexp_extract(t, day, i)
    date = F.when(part(3) != "", F.concat_ws("-", part(3), F.try_element_at(month, F.lower(part(2))), F.lpad(part(1).cast("int").cast("string"), 2, "0")))
    after = F.when(date.isNotNull(), F.substring(t, F.regexp_instr(t, F.lit(day)), F.lit(HEAD_META))).otherwise(t)
    number = rf"(?iu)№{WS}*([0-9]{{1,5}}{WS}*[-–—]?{WS}*[а-яіїєґa-z]*)"
    found = F.coalesce(*[F.when(x != "", x) for x in (F.regexp_extract(after, number, 1), F.regexp_extract(t, number, 1), F.regexp_extract(file_name, number, 1), F.regexp_extract(file_name, rf"(?iu)(\d{{1,5}}){WS}*[-–—]{WS}*р", 1))])
    plain = F.translate(F.regexp_replace(found, WS, ""), "–—", "--")
    return F.struct(date.alias("decision_date"), F.when(plain.rlike(r"^\d+$"), F.concat(plain, F.lit("-р"))).otherwise(plain).alias("decision_number"))


def inferred_code(basis: Column, text: Column) -> Column:
    """Code from the legal basis and what stands around it, else from the start and the end of the text: the smallest point, else the first article."""
    wide = F.concat_ws("\n", basis, head(text, HEAD_CODE), F.right(text, F.lit(TAIL_CODE)))

    def of(t: Column) -> list[Column]:
        return [F.concat(F.lit("zek:50:"), F.get(points(t), F.lit(0))), F.concat(F.lit("unfair:"), F.get(articles(t), F.lit(0)))]

    return F.coalesce(*of(normalize_spaces(basis)), *of(normalize_spaces(wide)))


def code_label(code: Column) -> Column:
    """``п. n ст. 50 — …`` or ``ст. a — …`` of a code."""
    point, art = F.regexp_extract(code, r"^zek:50:(\d+)$", 1), F.regexp_extract(code, "^unfair:(.+)$", 1)
    names = F.create_map(*[F.lit(x) for p in [(str(i + 1), v) for i, v in enumerate(POINT_LABELS)] for x in p])
    arts = F.create_map(*[F.lit(x) for p in ARTICLE_LABELS.items() for x in p])
    return F.when(point != "", F.concat(F.lit("п. "), point, F.lit(" ст. 50 — "), F.try_element_at(names, point))).when(art != "", F.concat(F.lit("ст. "), art, F.lit(" — "), F.try_element_at(arts, art)))


def classification(inferred: Column, annotated: Column, family: Column, found_points: Column, found_articles: Column, basis: Column) -> Column:
    """The canonical classification: what is inferred outweighs the annotation; a code holds one point or article, ``other`` all that was found."""
    code = F.coalesce(inferred, primary_code(annotated))
    point, art = F.regexp_extract(code, r"^zek:50:(\d+)$", 1), F.regexp_extract(code, "^unfair:(.+)$", 1)
    none_i, none_s = F.array().cast("array<int>"), F.array().cast("array<string>")
    is_point, is_article = F.coalesce(point != "", F.lit(False)), F.coalesce(art != "", F.lit(False))
    return F.struct(
        F.when(is_point, "economic_competition").when(is_article, "unfair_competition").otherwise(F.coalesce(family, F.lit("other"))).alias("law_family"),
        F.coalesce(code, F.lit("other")).alias("primary_code"),
        F.when(is_point, F.concat(F.lit("п. "), point, F.lit(" ст. 50"))).when(is_article, F.concat(F.lit("ст. "), art)).alias("primary_article"),
        F.coalesce(code_label(code), F.lit("Інше / потребує перевірки")).alias("primary_label"),
        F.when(is_point, F.array(point.cast("int"))).when(is_article, none_i).otherwise(found_points).alias("article_50_points"),
        F.when(is_article, F.array(art)).when(is_point, none_s).otherwise(found_articles).alias("unfair_competition_articles"),
        unique_texts(basis).alias("secondary_legal_basis"),
    )


def law_area_label(area: Column) -> Column:
    return F.when(area == "unfair_competition", "Захист від недобросовісної конкуренції").when(area == "economic_competition", "Захист економічної конкуренції").otherwise("Інше / потребує перевірки")


def badge(area: Column, basis: Column) -> Column:
    """Short mark of a violation from its legal basis."""
    t = F.lower(F.array_join(F.filter(F.coalesce(basis, F.array().cast("array<string>")), lambda x: x != ""), "; "))
    steps = [F.when((area == "unfair_competition") | t.rlike(f"15{WS}*[¹1]"), "ст. 15¹")]
    steps += [F.when(t.rlike(rf"(?:пункт{WS}*|п\.?{WS}*){n}"), f"п. {n} ст. 50") for n in (12, 13, 14, 4)]
    return F.coalesce(*steps, law_area_label(area))

