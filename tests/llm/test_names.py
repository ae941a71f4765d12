"""Spellings of firms and persons."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import name_links as M
from lexmill.llm.party_names import near, read

SCHEMA = "name_id long, party_name string, party_norm string, id_code string, city string"
SAME = [
    ["ТОВ «Торговий дім Чітамісана»", "ООО \"торговий дім Чітамісана\"", "TOV „Torhovyi dim Chitamisana“", "«ТД Чіьамісана», ТОВ", "Товариство з обмеженою відповідальністю 'ТД ЧІТАМІСАНА'", "ТОВ​“ТД Чітамісaна” (м. Зеленогір)"],
    ["ТОВ «Торговий дім Чітамісана Агро»"],  # a related firm
    ["ПП «Торговий дім Чітамісана»"],  # another form
    ["ПрАТ «Тежялітали Енерго»", "ЧАО Тежялітали-Енерго", "“Тежялліталиенерго”, ПрАТ"],
    ["ФОП Неліпубавюк Володимир Володимирович", "В.В. Неліпубавюк", "Фізична особа-підприємець НЕЛІПУБАВЮК В. В.", "Володимир Неліпубавюк", "Neliputavuk"[:0] or "Nelipubaviuk Volodymyr", "Неліпубавюк Воодимир Володимирович, ФОП", "ФОП Вова Неліпубавюк"],
    ["ФОП Неліпубавюк Оксана Володимирівна", "Неліпубавюк О. В."],  # a relative
]


def rows():
    out, n = [], 0
    for group, names in enumerate(SAME):
        for name in names:
            n += 1
            out.append((n, name, None, None, None, group))
    return out


def test_groups(spark):
    data = rows()
    extra = [(90, None, None, None, None), (91, "", None, None, None), (92, "особа 1", None, None, None), (93, "Інформація з обмеженим доступом", None, None, None), (94, "ТОВ «ТД Чітамісана»", None, None, None), (95, "ТОВ «ТД Чітамісана»", None, None, None)]
    df = spark.createDataFrame([r[:5] for r in data] + extra, SCHEMA).selectExpr("*", "1 as a", "2 as entity")
    got = {(r.a, r.b) for r in M.pairs(df).collect()}
    group = {r[0]: r[5] for r in data} | {94: 0, 95: 0}
    want = {(a, b) for a in group for b in group if a < b and group[a] == group[b]}
    assert got == want
    assert M.pairs(df.limit(0)).count() == 0


def test_code_and_town_decide_between_relatives(spark):
    data = [(1, "ФОП Бяніфулавович Іван Петрович", None, "1", "Степове"), (2, "ФОП Бяніфулавович Ігор Павлович", None, "2", "Мостище"), (3, "Бяніфулавович І. П.", None, "2", None), (4, "І.П. Бяніфулавович", None, None, None), (5, "І.П. Бяніфулавович", None, None, "Степове")]
    got = {(r.a, r.b) for r in M.pairs(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == {(2, 3), (1, 5)}


def test_mistyped_surname_of_a_family_in_several_towns(spark):
    data = [(1, "Фозузоелцчук Наталія В'ячеславівна", None, None, "Дубогай"), (2, "ФОП Фозузолецчук Євген В'ячеславович", None, "7", "Степове"), (3, "ФОП Фозузолецчук Наталія В'ячеславівна", None, None, None)]
    assert {(r.a, r.b) for r in M.pairs(spark.createDataFrame(data, SCHEMA)).collect()} == {(1, 3)}


def test_index_links_equal_brute_force(spark):
    r = random.Random(2)
    words = {"".join(r.choice("абв") for _ in range(r.randrange(3, 8))) for _ in range(120)}
    toks = spark.createDataFrame([(i, "s", w, None, None) for i, w in enumerate(sorted(words))], "node long, scope string, token string, code string, town string")
    got = {(x.a, x.b) for x in M.token_links(toks).collect()}
    ws = sorted(words)
    assert got == {(i, j) for i in range(len(ws)) for j in range(i + 1, len(ws)) if near(ws[i], ws[j]) and min(len(ws[i]), len(ws[j])) >= M.LEAST_LETTERS}


@settings(max_examples=200, deadline=None)
@given(st.text("абв", max_size=7), st.text("абв", max_size=7))
def test_near_is_one_edit(a, b):
    def one(x):
        out = {x[:i] + x[i + 1 :] for i in range(len(x))}
        out |= {x[:i] + c + x[i:] for i in range(len(x) + 1) for c in "абв"}
        out |= {x[:i] + c + x[i + 1 :] for i in range(len(x)) for c in "абв"}
        return out | {x[:i] + x[i + 1] + x[i] + x[i + 2 :] for i in range(len(x) - 1)}

    assert near(a, b) == (a == b or b in one(a))


def test_assignment():
    assert M.fits(("о", "в"), ("оксана", "володимирівна")) == 2
    assert M.fits(("оксана",), ("оксана", "володимирівна")) == 0
    assert M.fits(("володимир",), ("оксана", "володимирівна")) is None
    assert M.fits((), ("оксана",)) == 0


def test_parts():
    assert read("ППЧіфябевіби (м. Зеленогір)").words == ("чіфябевіби",) and read("ППЧіфябевіби (м. Зеленогір)").place == "зеленогір"
    assert read("ПрАТ Виробнича компанія Ніцижурипо 2").addition == "2"
    assert read("ФОП ОСОБА_1").kind == "" and read(None).kind == ""


def linked(spark, *names):
    df = spark.createDataFrame([(i, n, None, None, None) for i, n in enumerate(names)], SCHEMA)
    return {(r.a, r.b) for r in M.pairs(df).collect()}


def test_forms_that_no_list_has_are_firms(spark):
    for name in ("ТДВ «Аркада»", "Концерн «Іван Франко»", "Фермерське господарство «Світанок»", "Громадська організація «Союз власників житла та підприємців малого бізнесу міста Степове і області»"):
        assert read(name).kind == "firm"
    assert read("ППАПФ Хокутоніча - Буд").words == ("хокутоніча",) and read("ТОВбудівельна компанія Сяробидеся").business == "бк"
    assert read("Шевченко Іван").kind == "person" and read("Незнайко І. П.").kind == "person"
    assert linked(spark, "ТДВ «Аркада»", "ТДВ «Аркадa»", "ТДВ «Аркадда»", "Концерн «Аркада»") == {(0, 1), (0, 2), (1, 2)}


def test_short_names_and_words_in_another_order(spark):
    assert linked(spark, "ТОВ «Мрія»", "ТОВ «Мріа»", "ТОВ «ББ»", "ТОВ «БВ»", "ПП «Зелений гай»", "ПП «Гай зелений»", "ПП «Зеленый гаай»", "ПП «Зеленийгай»") >= {(0, 1), (4, 5), (4, 7)}
    assert (2, 3) not in linked(spark, "ТОВ «Мрія»", "ТОВ «Мріа»", "ТОВ «ББ»", "ТОВ «БВ»")


def test_assignment_equals_every_permutation():
    from itertools import permutations

    r = random.Random(5)
    for _ in range(200):
        n, m = r.randrange(1, 5), r.randrange(4, 6)
        cost = [[r.randrange(10) for _ in range(m)] for _ in range(n)]
        got = M.assignment(cost)
        assert len(set(got)) == n
        assert sum(cost[i][j] for i, j in enumerate(got)) == min(sum(cost[i][j] for i, j in enumerate(w)) for w in permutations(range(m), n))


def test_long_names_take_no_time():
    import time

    words = [f"словоназви{c}" for c in "абвгдежзиклм"]
    began = time.perf_counter()
    assert M.fits(tuple(words), tuple(reversed(words))) == 12
    assert time.perf_counter() - began < 0.05


def test_persons_of_a_large_family_equal_all_against_all(monkeypatch):
    r = random.Random(8)
    given, fathers = ["іван", "ігор", "олена", "оксана", "петро"], ["іванович", "петрович", "ігорович"]
    forms = set()
    while len(forms) < 120:
        g, f = r.choice(given), r.choice(fathers)
        words = r.choice([(g, f), (g[0], f[0]), (g,), (f, g), (g[:-1], f), (g[0], f), ()])
        forms.add((words, frozenset(r.sample("123", r.randrange(2))), frozenset(r.sample("абв", r.randrange(2)))))
    forms = sorted(forms, key=str)
    got = M.persons(forms)

    class All:
        def __init__(self):
            self.all, self.bare = [], []

        def add(self, n, words):
            self.all.append(n)

        def near(self, words):
            return set(self.all)

    monkeypatch.setattr(M, "Forms", All)
    assert got == M.persons(forms)


def test_additions_are_learned(spark):
    r = random.Random(3)
    own = ["".join(r.choice("бвгджз") + r.choice("аиоу") for _ in range(4)) for _ in range(60)]
    names = [f"ТОВ «{w} Холдинг»" for w in own[:40]] + [f"ТОВ «{w}»" for w in own[20:]]
    df = spark.createDataFrame([(i, n, None, None, None) for i, n in enumerate(names)], SCHEMA)
    assert M.learned_additions(df) == {"холдинг"}
    assert M.pairs(df).count() == 0
    assert M.linked(df).filter("links > 0 or entity <> name_id").count() == 0
