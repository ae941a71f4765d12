"""Language models: probabilities, held-out accuracy, segments."""

from collections import Counter

import duckdb
import numpy as np
import pytest

from lexmill.llm import langid as G

TEXTS = {
    "uk": "Колегія відділення дійшла висновку, що підприємство завищило тариф на теплову енергію. Рішення може бути оскаржене до господарського суду. Штраф слід сплатити у двомісячний строк.",
    "ru": "Коллегия пришла к выводу, что предприятие завысило тариф на тепловую энергию. Решение может быть обжаловано в суде. Штраф следует уплатить в двухмесячный срок.",
    "en": "The board concluded that the undertaking raised the tariff for heat supply. The decision may be appealed to the court. The fine must be paid within two months.",
    "pl": "Kolegium uznało, że przedsiębiorstwo zawyżyło taryfę na ciepło. Decyzję można zaskarżyć do sądu. Karę należy zapłacić w ciągu dwóch miesięcy.",
    "de": "Das Kollegium stellte fest, dass das Unternehmen den Tarif für Wärme überhöhte. Gegen den Beschluss kann geklagt werden. Die Geldbuße ist binnen zwei Monaten zu zahlen.",
}


@pytest.fixture(scope="module")
def models():
    return G.train([(l, t) for l, t in TEXTS.items() for _ in range(3)])


def test_probabilities_of_a_context_sum_to_one():
    m = G.fit([Counter({"мама": 3, "мова": 2}), Counter({"mama": 1})] + [Counter()] * 3)
    # over all characters that any model knows, after the start of a word
    chars = sorted({c for w in ("мама", "мова", "mama") for c in w} | {"\x03"})
    w = np.array([[2, 2, 2, 2, ord(c)] for c in chars], np.uint64)
    p = np.zeros(len(chars))
    got = None
    for n in range(1, G.ORDER + 1):
        at, found = G._find(m.grams[n - 1], G._hash(w[:, G.ORDER - n :]))
        lower = np.where(found, m.logs[n - 1][at, 0], m.unseen if n == 1 else 0)
        if n > 1:
            c, known = G._find(m.contexts[n - 2], G._hash(w[:, G.ORDER - n : G.ORDER - 1]))
            lower = np.where(found, m.logs[n - 1][at, 0], got + np.where(known, m.backoffs[n - 2][c, 0], 0))
        got = lower
    p = 2.0**got
    assert 0.8 < p.sum() <= 1.0001


def test_held_out_accuracy():
    rows = duckdb.sql("select lang, text from '/root/testdata/sf0.01/documents.parquet' where lang in ('uk','ru','en','pl','de') and length(text) > 200 order by doc_id").fetchall()
    m = G.train(rows[: len(rows) // 2])
    p, right = G.Pieces(m), []
    test = rows[len(rows) // 2 :]
    for (lang, _), found in zip(test, G.scan(m, p, [t for _, t in test])):
        if len(found) == 1:
            right.append(G.LANGUAGES[found[0][0]] == lang)
    assert len(right) > 250 and np.mean(right) > 0.85  # some labels are wrong on purpose


def test_segments(models):
    p = G.Pieces(models)
    mixed = TEXTS["uk"] + " " + TEXTS["ru"] + "\n" + TEXTS["uk"]
    got = [[(G.LANGUAGES[l]) for l, _, _ in f] if f else None for f in G.scan(models, p, [TEXTS["de"], mixed, "", None, " 12 \n ", "... ---", TEXTS["pl"] + " We've."])]
    assert got == [["de"], ["uk", "ru", "uk"], None, None, None, None, ["pl"]]


def test_nothing_to_fit(spark):
    none = G.train([])
    df = spark.createDataFrame([(1, TEXTS["uk"], None)], "doc_id long, text string, lang string")
    assert G.segments(df, none).count() == 0
    assert G.train([(r.lang, r.t) for r in G.sample(df, "doc_id", "text", "lang").collect()]).grams[0].size == 0


def test_labels(spark):
    rows = [("uk_UA", "uk"), ("ukr", "uk"), ("EN", "en"), ("en-GB", "en"), ("ger", "de"), ("be", "be"), ("??", None), ("", None), (None, None), ("unknown", None), ("und", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    from pyspark.sql import functions as F

    assert all(r.x == r.b for r in df.select(G.label_code(F.col("a")).alias("x"), "b").collect())


def test_operator(spark, models):
    mixed = TEXTS["en"] + "\n" + TEXTS["de"]
    rows = [(1, TEXTS["uk"], "uk"), (2, TEXTS["uk"], "ru"), (3, mixed, "en"), (4, None, "uk"), (5, "", None), (6, TEXTS["pl"], None), (6, TEXTS["pl"], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' as seg_no", "1 as k")
    seg = G.segments(df, models)
    got = sorted((r.doc_id, r.seg_no, r.lang) for r in G.wrong_or_mixed(seg).collect())
    assert got == [(2, 0, "uk"), (3, 0, "en"), (3, 1, "de"), (6, 0, "pl"), (6, 0, "pl")]
    part = {r.seg_no: mixed[r.begin : r.end] for r in seg.collect() if r.doc_id == 3}
    assert part[0].strip() == TEXTS["en"] and part[1] == TEXTS["de"]
    assert all(0.5 < r.confidence <= 1 for r in seg.collect())
    assert G.segments(df.limit(0), models).count() == 0


def test_short_foreign_sentences_and_unknown_languages():
    rows = duckdb.sql("select lang, text from '/root/testdata/sf0.01/documents.parquet' where lang in ('uk','ru','en','pl','de') and length(text) > 200 order by doc_id").fetchall()
    m = G.train(rows)
    uk = "Рішення може бути оскаржене до господарського суду."
    texts = [f"{uk} Fine paid. {uk}", f"{uk} OK. {uk}", "Bonjour, je voudrais réserver une chambre pour deux personnes. Merci beaucoup.", uk]
    got = [[f[0] if f[0] is None else G.LANGUAGES[f[0]] for f in x] for x in G.scan(m, G.Pieces(m), texts)]
    assert got == [["uk", "en", "uk"], ["uk"], [None], ["uk"]]


def test_documents_in_an_unknown_language(spark):
    rows = duckdb.sql("select lang, text from '/root/testdata/sf0.01/documents.parquet' where lang in ('uk','ru','en','pl','de') and length(text) > 200 order by doc_id").fetchall()
    docs = spark.createDataFrame([(1, "Bonjour, je voudrais réserver une chambre pour deux personnes.", "uk")], "doc_id long, text string, lang string")
    out = G.segments(docs, G.train(rows))
    assert [(r.lang, r.confidence, r.seg_no) for r in out.collect()] == [("und", 0.0, 0)]
    assert G.wrong_or_mixed(out).count() == 0
