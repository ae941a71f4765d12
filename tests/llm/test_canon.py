"""The transducer over grapheme clusters: single cases, idempotence, conflicts."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import canon

T, N = canon.Transducer("text"), canon.Transducer("number")

CHANGED = [
    ("ТОΒ «Ветоца́пими Фарм»", "ТОВ «Ветоцапими Фарм»"),
    ("TOB «Хясіпа»", "ТОВ «Хясіпа»"),
    ("ОРЕН​ДАР", "ОРЕНДАР"),
    ("ＡＢＣ１", "ABC1"),
    ("Андрій".replace("й", "й"), "Андрій"),
    ("ФОП Ігор", "ФОП Ігор"),
    ("Tоrhovyi dim", "Torhovyi dim"),
    ("ooО", "ооО"),
    ("𝟽𝟽/𝟸𝟹𝟻-р", "77/235-р"),
    ("рішення 66/421-p/к від", "рішення 66/421-р/к від"),
    ("81/724−р/к || 2023", "81/724-р/к || 2023"),
]
PLAIN = ["", "ТОВ «Тімобігизу»", "TOV “Riaryrifatsi”", "фізична особа – підприємець", "В’ячеслав В'ячеславович", "№ 45658 щодо «цемент»", "rishennia_00000_0.docx", "файл 28.08.2020 r.docx", "ПАТ 2", "Андрій їжак ёж"]


@pytest.mark.parametrize("text, want", CHANGED)
def test_changed(text, want):
    assert T(text) == want and T(want) == want


@pytest.mark.parametrize("text", PLAIN)
def test_plain_stays(text):
    assert T(text) == text


@pytest.mark.parametrize("text, want", [("６６/421-p/k", "66/421-р/к"), ("81/724−р/к", "81/724-р/к"), ("65\xad/288-р", "65/288-р"), ("№ 5-р", "№ 5-р")])
def test_numbers(text, want):
    assert N(text) == want


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("абвоеіpoxcTОВ́̆​\xa0 １𝟕-/№«»"), max_size=25))
def test_idempotent_and_visible(text):
    once = T(text)
    assert T(once) == once
    assert not any(canon.invisible(c) or unicodedata.category(c) == "Mn" for c in once if c not in "№") or once == text


def test_conflicts_are_refused():
    with pytest.raises(canon.MappingConflictError):
        canon.checked({"a": "b"}, {"a": "c"})
    with pytest.raises(canon.MappingConflictError):
        canon.checked({"a": "b", "b": "c"})
    canon.style_map(), canon.to_cyrillic_map(), canon.to_latin_map()


def test_operator(spark):
    rows = [(1, "66/421-p", ["ТОΒ «А»", None], "x" * 9), (2, None, None, None), (3, "5-р", [], "y"), (3, "5-р", [], "y")]
    df = spark.createDataFrame(rows, "rec_id long, n string, p array<string>, changed string")
    out = canon.canonical(df, "rec_id", {"n": "number", "p": "text"})
    got = sorted((r.rec_id, r.field_name, r.changed, tuple(r.plain) if r.plain is not None else None) for r in out.collect())
    assert got == [(1, "n", True, ("66/421-р",)), (1, "p", True, ("ТОВ «А»", None)), (2, "n", False, None), (2, "p", False, None), *[(3, "n", False, ("5-р",))] * 2, *[(3, "p", False, ())] * 2]
    assert canon.canonical(df, "rec_id", {"n": "number"}, only_changed=True, texts=False).collect()[0].asDict() == {"rec_id": 1, "field_name": "n", "changed": True}
    assert canon.canonical(df.limit(0), "rec_id", {"n": "number"}).count() == 0


@pytest.mark.parametrize("text, want", [("у ７７/２３５–р", "у 77/235-р"), ("12 − p / k.", "12 - р / к."), ("61/1042р/k", "61/1042р/к"), ("5-ріг", "5-ріг"), ("BAT «Зоря»", "ВАТ «Зоря»"), ("PAT «Zoria»", "PAT «Zoria»")])
def test_numbers_and_forms_within_texts(text, want):
    assert T(text) == want and T(want) == want


BREVE, DIAERESIS, ACUTE = chr(0x306), chr(0x308), chr(0x301)


def test_longest_key_counts():
    keys = canon.Keys(set("иійї"), canon.style_map())
    assert [keys[c] for c in ("и", "и" + BREVE, "і" + DIAERESIS, "и" + ACUTE, "и" + BREVE + ACUTE, ACUTE, "①")] == ["и", "й", "ї", "и", "й", "", "1"]


def test_each_text_is_run_through_once(monkeypatch):
    machine, seen = canon.Transducer("text"), []
    emit = machine._emit
    machine._emit = lambda m: seen.append(m.span()) or emit(m)
    machine("ТОΒ «Х» 81/724−р/к 1")
    assert seen == sorted(seen) and all(a[1] <= b[0] for a, b in zip(seen, seen[1:]))
