"""Acts and the cases that contest them."""

from lexmill.llm import case_links as K

P = "rec_id long, decision_number string, decision_date string, violation_summary string, sanction string, liable_parties array<string>"
ACTS = [
    (1, "74/196-р", "2020-05-27", "Діяння тривало 5 днів і охопило 6 договорів у місті Степове.", "Штраф 15069300 грн", ["ПАТ «Півіцикииху»"]),
    (2, "№ 74/196-p", "27.05.2020", None, None, ["особа 1"]),
    (3, "74/196-р", "2021-03-01", None, None, ["ТОВ «Інша»"]),
    (4, None, "2022-07-29", "Діяння тривало 7 днів і охопило 8 договорів у місті Степове.", None, ["ТОВ «Хамілитаху»"]),
    (5, "9-р", None, None, None, None),
]
TEXTS = [
    ("d1", "Касаційне провадження № 924/72801/21: скаржник PAT Pivitsykyikhu не погоджується з рішенням № № 74/196-р про накладення штрафу в розмірі 15 069 300 грн, ухваленим органом комітету."),
    ("d2", "Касаційне провадження № 928/81176/22: скаржник TOB «Хамілитаxу» не погоджується з рішенням від 2022-07-29, ухваленим органом комітету."),
    ("d3", "Справа 923/1/24. ТОВ «Фячове» просить стягнути з ПП «Туходя» шкоду. Суд бере до уваги практику, викладену в рішенні комітету від 27.05.2020 № 74/196-р, яке стосувалося інших осіб."),
    ("d4", "Господарський суд у справі № 906/2/22 за позовом ТОВ «А» до виконавчого комітету міської ради про скасування розпорядження від 27.05.2020 № 74/196-р та акта № 32/1."),
    ("d5", "Справа № 925/3/20 за позовом ТОВ «НАЗВА_2» до АМКУ про визнання недійсним рішення від 1 березня 2021 року № 74/ 196 р."),
    ("d6", None),
    ("d7", "У справі 900/4/20 оспорюється рішення, ухвалене АМКУ від 2019-01-01 № 1-р, яким притягнуто до відповідальності ФОП ОСОБА_1."),
]
DOCS = [("d1", "﻿924/72801/21 "), ("d1", "924/72801/21"), ("d2", ""), ("d3", "923/1/24"), ("d4", "906/2/22"), ("d5", "925/3/20"), ("d9", None)]


def frames(spark):
    return spark.createDataFrame(ACTS, P), spark.createDataFrame(DOCS, "doc_id string, cause_num string"), spark.createDataFrame(TEXTS, "doc_id string, text string")


def test_contested(spark):
    out = K.contested(*frames(spark)).collect()
    assert {(r.rec_id, r.cause_num) for r in out} == {(1, "924/72801/21"), (4, "928/81176/22"), (3, "925/3/20")}
    assert all(0.8 < r.confidence < 1 for r in out)


def test_very_long_texts(spark):
    p, d, _ = frames(spark)
    texts = [("d1", TEXTS[0][1] + " слово" * 200_000), ("d2", "яким притягнуто до відповідальності " + "слово " * 200_000), ("d3", "№ " * 100_000), ("d4", "1 " * 100_000 + "скасувати рішення " * 1000)]
    got = K.contested(p, d, spark.createDataFrame(texts, "doc_id string, text string")).collect()
    assert [(r.rec_id, r.cause_num) for r in got] == [(1, "924/72801/21")]


def test_empty(spark):
    p, d, t = frames(spark)
    assert K.contested(p.limit(0), d, t).count() == 0
    assert K.contested(p, d.limit(0), t.limit(0)).count() == 0


def test_window_counts_acts_only(spark):
    known = spark.createDataFrame([("r", f"{i:03d}", i) for i in range(50)], "run string, place string, act long")
    said = spark.createDataFrame([("r", "020", 7), *[("r", "020", 100 + i) for i in range(40)]], "run string, place string, mention long")
    got = {r.act for r in K.neighbours(said, known, 3).collect() if r.mention == 7}
    assert got == {18, 19, 20, 21, 22, 23}


def test_many_acts_of_one_day_and_party(spark):
    party = ["ТОВ «Хамілитаху»"]
    acts = [(1, None, "2022-07-29", None, None, party), *[(i, f"{100 + i}-р", "2022-07-29", None, None, party) for i in range(2, 52)]]
    said = "Касаційне провадження № {}: скаржник ТОВ «{}» не погоджується з рішенням {}, ухваленим органом комітету."
    texts = [
        ("d1", said.format("924/1/22", "Хамілитаху", "від 2022-07-29 № 999-р")),  # the one act without a number
        ("d2", said.format("924/2/22", "Хамілитаху", "від 2022-07-29")),  # all fit: the lowest record
        ("d3", said.format("924/3/22", "Хамілитахуу", "від 2022-07-29 № 999-р")),  # a name beside theirs
        ("d4", said.format("924/4/22", "НАЗВА_1", "від 2022-07-29 № 147-р")),
        ("d5", said.format("924/5/22", "НАЗВА_1", "від 2022-07-29 № 417-р")),  # 147 with two digits exchanged
    ]
    got = K.contested(spark.createDataFrame(acts, P), spark.createDataFrame([], "doc_id string, cause_num string"), spark.createDataFrame(texts, "doc_id string, text string")).collect()
    assert {r.cause_num: r.rec_id for r in got} == {"924/1/22": 1, "924/2/22": 1, "924/3/22": 1, "924/4/22": 47, "924/5/22": 47}


def test_all_acts_of_a_place(spark):
    known = spark.createDataFrame([("r", "020", i) for i in range(50)] + [("r", "021", 50), ("r", "022", 51)], "run string, place string, act long")
    got = {r.act for r in K.neighbours(spark.createDataFrame([("r", "020", 1), ("r", "0200", 2)], "run string, place string, mention long"), known, 1).filter("mention = 1").collect()}
    assert got == set(range(51))


def test_all_statements_of_a_text_however_long(spark):
    acts = [(1, "74/196-р", "2020-05-27", None, None, ["ПАТ «Півіцикииху»"]), (2, "9-р", "2021-02-03", None, None, ["ТОВ «Хамілитаху»"]), (3, "325-р", "2022-01-01", None, None, ["ТОВ «Інша»"])]
    far = "за наслідками розгляду справи про порушення законодавства " * 8
    texts = [
        ("d1", f"Справа № 924/1/22: просить визнати недійсним рішення АМКУ, ухвалене {far}від 27.05.2020 № 74/196-р. Також просить скасувати рішення АМКУ від 03.02.2021 № 9-р. Суд бере до уваги рішення комітету від 01.01.2022 № 325-р."),
        ("d2", "Справа № 924/2/22: просить скасувати рішення АМКУ. Суд бере до уваги практику, викладену в рішенні комітету від 27.05.2020 № 74/196-р."),
        ("d3", "Справа № 924/3/22: просить скасувати рішення АМКУ від 27.05.2020 № 74/196-р."),
        ("d4", "Справа № 924/3/22: скаржник ПАТ «Півіцикииху» не погоджується з рішенням АМКУ від 27.05.2020."),
    ]
    got = K.contested(spark.createDataFrame(acts, P), spark.createDataFrame([], "doc_id string, cause_num string"), spark.createDataFrame(texts, "doc_id string, text string")).collect()
    assert {(r.rec_id, r.cause_num) for r in got} == {(1, "924/1/22"), (2, "924/1/22"), (1, "924/3/22")} and len(got) == 3


def test_assignment_is_of_the_greatest_total(spark):
    from itertools import product

    cases = [("c", 1), ("c", 2), ("c", 3), ("e", 1)]
    scored = [(1, 10, 5.0), (1, 11, 6.0), (2, 10, 6.0), (3, 12, 5.5), (3, 13, 5.5)]
    got = K.assigned(spark.createDataFrame(cases, "cause_num string, mention long"), spark.createDataFrame(scored, "mention long, act long, score double"))
    assert {(r.rec_id, r.cause_num) for r in got.collect()} == {(10, "c"), (12, "c"), (11, "e")}
    # every choice of acts for the statements of the first case: none has a greater sum of the acts' totals
    total = {a: sum(s for m, b, s in scored if b == a) for a in (10, 11, 12, 13)}
    fits = {m: [a for n, a, _ in scored if n == m] for m in (1, 2, 3)}
    assert max(sum(total[a] for a in way) for way in product(*fits.values())) == total[10] * 2 + total[12]
