"""Rules over decision texts, rows, challenges, timelines and loaders, on small fixtures with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from lexmill.functions import decoders as D
from lexmill.functions import text as X
from lexmill.operators import challenges as K
from lexmill.operators import decisions as V
from lexmill.operators import resources as R
from lexmill.operators import rows as W
from lexmill.operators import timeline as L
from lexmill.sources import files


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "text, want",
    [
        ("п. 12 ст. 50; пунктом 4 статті 50 та пункт 4 частини першої статті 50", [4, 12]),
        ("ПУНКТ 4 частини другої статті 6: антиконкурентні узгоджені дії", [1]),
        ("частини першої статті 13 — зловживання", [2]),
        ("пункт 22 статті 50, пункт 0 статті 50", []),
        (None, []),
    ],
)
def test_points(spark, text, want):
    assert one(spark, text, V.points) == want


def test_articles(spark):
    law = "Закону України «Про захист від недобросовісної конкуренції»"
    assert one(spark, f"статтею 16 {law}, стаття 15¹ {law}, ст. 15 – 1 {law}; ст. 15 {law}; стаття 9 {law}", V.articles) == ["15", "15-1", "16"]


TEXTS = {
    "Про закриття провадження. Пункт 4 статті 50": ("closure_practice", "economic_competition", "proceeding_closed_no_violation"),
    "Про надання дозволу на концентрацію": ("permit_only_concentration_or_clearance", None, None),
    "Надати дозвіл товариству на створення; пункт 4 статті 50": ("not_violation_decision", None, None),
    "Про порушення законодавства про захист від недобросовісної конкуренції": ("included_by_regex", "unfair_competition", "violation_found"),
    "про порушення законодавства про захист економічної конкуренції. Про розстрочення сплати штрафу": ("procedural_decision", None, None),
    "": ("not_violation_decision", None, None),
}


def test_relevance(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", V.relevance(F.col("t")).alias("r")).select("t", "r.*")
    assert {r.t: (r.reason, r.law_area, r.outcome) for r in df.collect()} == TEXTS
    p12 = "про порушення законодавства про захист економічної конкуренції: пункт 12 статті 50, набуття контролю без отримання дозволу"
    assert one(spark, p12, lambda c: V.relevance(c, point_12=False)["reason"]) == "concentration_without_permit_p12"
    assert one(spark, p12, lambda c: V.relevance(c, closed_only=True)["reason"]) == "closure_backfill_non_closure"
    late = "x" * 45_000 + " Про закриття провадження. Пункт 4 статті 50"
    assert one(spark, late, V.is_closed) is False and one(spark, "x" * 44_000 + " Про закриття провадження. Пункт 4 статті 50", V.is_closed) is True


def test_meta_and_codes(spark):
    df = spark.createDataFrame([("№ 1-р від 5 травня 2020 р. № 302 – р", "a"), ("без дати № 17", "b"), ("", "Рішення № 9-рк.doc"), ("", "11-р.doc"), (None, None)], "t string, f string")
    got = [tuple(r.m) for r in df.select(V.meta(F.col("t"), F.col("f")).alias("m")).collect()]
    assert got == [("2020-05-05", "302-р"), (None, "17-р"), (None, "9-рк"), (None, "11-р"), (None, None)]
    assert one(spark, "п. 14 ст. 50 і п. 2 ст. 50", lambda c: V.inferred_code(c, F.lit(""))) == "zek:50:2"
    assert one(spark, "ст. 7", lambda c: V.inferred_code(c, F.lit("п. 3 ст. 50"))) == "zek:50:3"
    assert one(spark, "unfair:15-1", V.code_label) == "ст. 15-1 — поширення інформації, що вводить в оману"
    assert one(spark, ["п. 13"], lambda c: V.badge(F.lit("economic_competition"), c), "array<string>") == "п. 13 ст. 50"


CASE = "decision_key string, case_number string, challenger string, status string, status_label string, status_detail string, latest_merits struct<doc_id:string,type:string,date:string,court:string,url:string>, latest_relevant struct<doc_id:string,type:string,date:string,court:string,url:string>, updated_at string"


def test_challenges(spark):
    doc = lambda i, u: (i, "Рішення", "2024-01-01", "Суд", u)
    rows = [("k", "1/1/1", "А", "upheld", "L", None, doc("1", "u1"), doc("2", "u2"), "2024"), ("k", "2/2/2", None, "overturned", "L", None, None, doc("3", ""), "2023"), ("k", "", "x", "ongoing", "", "", None, None, "2025"), ("q", "3/3/3", None, None, None, None, None, None, "2025")]
    got = {r.decision_key: r.challenge for r in W.challenges(spark.createDataFrame(rows, CASE)).collect()}
    assert got["k"].display_status == "overturned" and got["k"].primary_case_number == "2/2/2" and got["k"].cases_count == 2 and [c.case_number for c in got["k"].cases] == ["1/1/1", "2/2/2"]
    assert got["q"].display_status == "ongoing" and got["q"].display_url == ""
    df = W.challenges(spark.createDataFrame(rows, CASE)).select("decision_key", W.challenge_url(F.col("challenge")).alias("u"))
    assert {r.decision_key: r.u for r in df.collect()} == {"k": "u1", "q": ""}
    assert W.challenges(spark.createDataFrame([], CASE)).count() == 0


def test_status_by_the_newest_decisive_act(spark):
    e = "c string, doc_id string, n int, verified boolean, invalidates boolean, resolves boolean, outcome string"
    rows = [("a", "1", 1, True, False, True, "upheld"), ("a", "2", 2, True, True, False, None), ("b", "1", 1, True, False, True, "upheld"), ("b", "2", 2, True, False, True, "ongoing"), ("c", "1", 1, False, False, False, None), ("d", "1", 1, True, False, False, None), ("e", "1", 1, True, False, False, None)]
    prior = spark.createDataFrame([("a", None), ("b", None), ("c", "upheld"), ("d", "overturned"), ("e", None), ("f", None)], "c string, prior_status string")
    got = {r.c: (r.case_status, r.challenge_status, r.merits_doc, r.invalidates) for r in K.status(spark.createDataFrame(rows, e), ["c"], F.col("n"), prior).collect()}
    assert got == {"a": ("ongoing", "pending_no_merits", None, True), "b": ("upheld", "merits_found", "1", False), "c": ("upheld", "merits_not_verified", None, False), "d": ("overturned", "history_prior_merits", None, False), "e": ("ongoing", "pending_no_merits", None, False), "f": ("ongoing", "pending_no_merits", None, False)}


def test_later_act(spark):
    s = "c string, case_status string, challenge_status string, merits_doc string, merits_order int, latest_doc string, latest_order int, annotation string"
    rows = [("undone", "upheld", "merits_found", "1", 1, "2", 2, "INVALIDATES_PRIOR"), ("review", "upheld", "merits_found", "1", 1, "2", 2, "ONGOING"), ("same", "upheld", "merits_found", "1", 1, "2", 2, "FINAL_UNCHANGED"), ("unread", "upheld", "merits_found", "1", 1, "2", 2, None), ("older", "upheld", "merits_found", "1", 2, "2", 2, "ONGOING"), ("open", "ongoing", "pending_no_merits", None, None, "2", 2, "ONGOING")]
    got = {r.c: (r.case_status, r.challenge_status, r.merits_doc, r.blocks_write) for r in K.later_act(spark.createDataFrame(rows, s)).collect()}
    assert got == {"undone": ("ongoing", "pending_no_merits", None, False), "review": ("ongoing", "merits_found_review_ongoing", "1", False), "same": ("upheld", "merits_found", "1", False), "unread": ("upheld", "current_status_not_verified", "1", True), "older": ("upheld", "merits_found", "1", False), "open": ("ongoing", "pending_no_merits", None, False)}


def test_discovery(spark):
    cases = spark.createDataFrame([("a", "1", "latest_merits", "0"), ("b", "2", "latest_active", "3"), ("c", "4", "latest_merits", "5"), ("d", "6", "latest_merits", "6")], "cause string, primary_doc string, primary_kind string, earliest string")
    hits = spark.createDataFrame([("1", "n1"), ("0", "n0"), ("3", "n3"), ("4", "n4"), ("5", "n5")], "doc_id string, number string")
    got = {(r.cause, r.number, r.source) for r in K.discovered(cases, hits, spark.createDataFrame([("4",), ("3",)], "doc_id string")).collect()}
    assert got == {("a", "n1", "latest_merits"), ("b", "n3", "earliest_fallback")}


def test_rolling_equals_a_plain_window(spark):
    import random

    from pyspark.sql import Window

    r = random.Random(1)
    rows = [(i, r.choice("ab"), r.randrange(0, 5000), r.random()) for i in range(400)] + [(900, "a", 599, 1.0), (901, "a", 600, 1.0), (902, "a", 609, 1.0)]
    df = spark.createDataFrame(rows, "i int, k string, at long, v double")
    w = Window.partitionBy("k").orderBy("at").rangeBetween(-9, 0)
    want = {x.i: x.n for x in df.withColumn("n", F.count("*").over(w)).collect()}
    assert {x.i: x.n for x in L.rolling(df, "k", "at", 10, [F.count("*")], ["n"]).collect()} == want


def test_announcements(spark):
    t = "справа № 127–26.4/116-26 та № 128-25/11-26, № 127-26.4/116-26; № 145-26.13/14126"
    assert one(spark, t, L.case_numbers) == ["127-26.4/116-26", "128-25/11-26"]
    q = one(spark, "пунктом 4 статті 50 Закону України «Про захист економічної конкуренції»", L.qualification)
    assert (q.article, q.point) == ("ст. 50", "п. 4")
    q = one(spark, "стаття 15¹ Закону України Про захист від недобросовісної конкуренції", L.qualification)
    assert (q.article, q.text) == ("ст. 15-1", "ст. 15-1 Закону України «Про захист від недобросовісної конкуренції»")
    assert one(spark, "нічого", L.qualification).text == "Не зазначено в повідомленні"
    assert [one(spark, x, L.sector_signal) for x in ("Аптеки", "фарма та бад", "фармаX", "xбадx", None)] == [True, False, True, True, False]
    text = '{"data": {"2024-01-01": [{"title": "a", "url": "u/", "tags": [{"name": "t"}]}], "x": "no list"}}'
    assert [(r.day, r.place, r.title, r.tags) for r in L.flatten(spark.createDataFrame([(1, text)], "page int, value string")).collect()] == [("2024-01-01", 0, "a", ["t"])]


def test_resources(spark):
    r = spark.createDataFrame([("a", "zip", "x"), ("b", "pdf", "y.pdf"), ("c", None, "z.ZIP")], "id string, format string, url string")
    assert [(x.id, x.problem) for x in R.chosen(r, ["c", "a", "q", "b"]).orderBy("place").collect()] == [("c", None), ("a", None), ("q", "missing"), ("b", "not_zip")]
    df = spark.createDataFrame([(2024 * 12 + m,) for m in (1, 5, 9)] + [(None,)], "m int")
    assert [x.r for x in df.select(R.in_months(F.col("m"), "2024-02", None).alias("r")).collect()] == [False, True, True, False]


def test_decoders():
    rtf = rb"{\rtf1\ansi\ansicpg1251\uc1{\fonttbl{\f0 A;}}325\_\u1088?{\b {\i x}}\u-10179?\u-8704?{\footnote gone}\par y}"
    assert D.rtf_to_text(rtf) == "325-рx\U0001F600\ny"
    assert D.document_to_text(b"a" * 3000 + b"<p>b</p>", None, None).endswith("a b")
    assert D.bytes_to_text(b'<meta charset="koi8-u">\xd0\xb0') == '<meta charset="koi8-u">а'
    assert D.bytes_to_text("ї".encode("cp1251"), "windows-1251") == "ї"


def test_formats(spark):
    assert [one(spark, v, X.money, "double") for v in (1234567.5, 0.0, None)] == ["1 234 568 грн", "—", "—"]


def test_loading(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"rows": [{"decision_number": " 1-р ", "id": "x", "liable_parties": ["ТОВ «А»", "Особа 7", ""]}, {"decision_date": "2020-01-01"}, {"decision_number": "2-р"}]}', encoding="utf-8")
    rows = files.practice_rows(files.read_envelope(spark, files.PRACTICE, str(tmp_path / "p.json")))
    assert [(r.row_id, r.decision_number, r.liable_parties, r.party_norms) for r in rows.collect()] == [("x", "1-р", ["ТОВ «А»", "Особа 7"], ["тов а"]), ("practice-2", "2-р", [], [])]
    d = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("", "c", 3), (None, "d", 4)], "code string, name string, n int")
    assert [tuple(r) for r in files.dictionary(d, "code", "name", F.col("n")).collect()] == [("1", "b")]
    m = spark.createDataFrame([("z", "b/X.TSV", b"2"), ("z", "a/x.tsv", b"1"), ("z", "y.tsv", b"3")], "archive string, member string, content binary")
    assert [(r.member, bytes(r.content)) for r in files.member(m, "x.tsv").collect()] == [("a/x.tsv", b"1")]
    files.write_csv(spark.createDataFrame([("a", ["x"])], "k string, l array<string>"), str(tmp_path / "csv"), ["k", "l"])
    out = "".join(x.read_text(encoding="utf-8") for x in sorted((tmp_path / "csv").glob("*.csv")))
    assert out.startswith("﻿k,l") and '[\\"x\\"]' in out
    files.write_json(d, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 4
