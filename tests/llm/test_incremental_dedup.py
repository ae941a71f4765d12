"""Arriving batches against history: the rules, the order, equality of one and many batches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill.llm import incremental_dedup as inc

SCHEMA = "rec_id long, decision_number string, decision_date string, violation_summary string, extra string"


def facts(a, b):
    return f"Діяння тривало {a} днів і охопило {b} договорів у місті Степове."


HISTORY = [
    (1, "61/1042-р/к", "2019-04-10", facts(766, 26), None),
    (2, None, "2020-06-01", facts(382, 32), None),
    (3, "72/4-р/к", None, facts(335, 3), None),
    (4, "60/526-р/к", "2021-09-29", facts(482, 38), None),
    (5, None, None, facts(1, 1), None),
    (6, "568-р", "2025-02-02", facts(122, 10), None),
    (7, "82/577-р/к", "2023-11-08", facts(548, 37), None),
]
BATCHES = [
    [
        (101, "№ 61/1042 − p/k", "10.4.2019 р.", None, "a"),  # same number and day, other notation
        (102, "62/937-р", "2020/06/01", facts(382, 32).replace("тривало", "продовжувалось").replace("договорів", "угод"), "a"),  # the first lost its number
        (103, "72/4-р/к", "1 лютого 2020 року", facts(335, 3), "a"),  # the first lost its day
        (104, "60/528-р/к", "2021-12-29", facts(482, 38), "a"),  # another act: other number and day
        (105, None, None, facts(1, 1), "a"),  # neither number nor day
        (106, "75/1-р", "2024-01-01", facts(9, 9), "a"),
        (107, "75/1", "2024-01-01", facts(9, 9), "a"),  # repeats 106 within the batch, suffix lost
    ],
    [
        (201, "568-р", "2024-02-02", facts(122, 10), "b"),  # the year is mistyped
        (202, "28/577-р/к", "2023-11-08", facts(548, 37), "b"),  # two digits exchanged
        (203, "60/528-р/к", None, facts(482, 38), "b"),  # repeats 104, the day is lost
        (204, "61/1042-р/к", "2019-04-10", facts(9, 2), "b"),  # same number and day: the same act, whatever its figures
        (205, "61/1043-р/к", "2019-04-11", facts(766, 26), "b"),  # one edit in the number and one in the day: another act
        (207, "61/1988-р/к", "2019-04-10", facts(766, 26), "b"),  # another number
        (208, "61/1042-р/к", "2017-12-31", facts(766, 26), "b"),  # another day
        (209, "61/1042-р/к", "2019-04-12", facts(767, 26), "b"),  # other figures
        (206, "62/937-р", "2020-06-01", None, "b"),  # repeats 102 and so 2
    ],
]
WANT = {(1, 101), (2, 102), (3, 103), (106, 107), (6, 201), (7, 202), (104, 203), (2, 206), (1, 204)}


def found(spark, history, batches):
    parts = lambda rows: inc.act_parts(spark.createDataFrame(rows, SCHEMA))
    index = inc.SegmentIndex(spark)
    index.accept(parts(history))
    for b in batches:
        inc.SegmentIndex(spark, index.path).accept(parts(b))
    return {(r.rec_id_first, r.rec_id_dup) for r in index.repeats(parts([r for b in batches for r in b])).collect()}


def test_batch_by_batch(spark):
    assert found(spark, HISTORY, BATCHES) == WANT


def test_all_at_once_is_the_same(spark):
    assert found(spark, HISTORY, [BATCHES[0] + BATCHES[1]]) == WANT


def test_empty(spark):
    assert found(spark, [], [[]]) == set()
    assert found(spark, [], [[BATCHES[0][0]]]) == set()


def test_hot_act(spark):
    rows = [(1000 + i, "1-р", "2020-01-01", facts(5, 5), None) for i in range(400)]
    assert found(spark, rows[:1], [rows[1:]]) == {(1000, 1000 + i) for i in range(1, 400)}


def test_wording_makes_no_difference(spark):
    other = [[(*r[:3], r[3] and r[3].replace("днів", "діб").replace("Діяння тривало", "Усе це зайняло") + " Додано речення.", r[4]) for r in b] for b in BATCHES]
    assert found(spark, HISTORY, other) == WANT


def test_figures(spark):
    texts = ["Справа № 5. Тривало 71 дн. і 12 угод, 3 роки! Потім 9.", "Без чисел", "", None, "Станом на ７１ і ２"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r.f for r in df.select("i", inc.figures_of(F.col("t")).alias("f")).orderBy("i").collect()] == ["12.3", None, None, None, "71.2"]


def test_a_batch_reads_the_partitions_of_its_own_keys_only(spark):
    parts = lambda rows: inc.act_parts(spark.createDataFrame(rows, SCHEMA))
    index = inc.SegmentIndex(spark, buckets=64)
    index.accept(parts(HISTORY))
    strs = inc.strings(parts([BATCHES[1][0]]))
    of = sorted({r.bucket for r in inc.pairs(strs, 64).unionByName(inc.probes(strs, buckets=64)).collect()})
    assert 0 < len(of) < 40
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ (?:IN|INSET)", index.entries(of)._jdf.queryExecution().toString())
    assert {r.bucket for r in index.entries(of).collect()} <= set(of) < {r.bucket for r in index.entries().collect()} | set(of)
    met = index.entries(of).join(inc.probes(strs, buckets=64).select("key"), "key", "left_semi")
    assert {r.first for r in met.collect()} == {6}


@pytest.mark.parametrize("edits", [1, 2])
def test_slips_equal_brute_force(spark, edits):
    r = random.Random(edits)
    numbers = {"".join(r.choice("12/") for _ in range(r.randrange(edits + 1, 9))) for _ in range(150)}
    strs = spark.createDataFrame([("2020-01-01", n, "5.5", i) for i, n in enumerate(sorted(numbers))], "date string, number string, figures string, first long")
    near = inc.segments(strs, edits)
    got = {(x.a, x.b) for x in inc.slips(inc.probes(strs, edits), near, edits).collect()}
    half = {frozenset((x.a, x.b)) for x in inc.slips(inc.probes(strs, edits, shorter=True), near, edits).collect()}
    assert half == {frozenset(x) for x in got}
    ns = sorted(numbers)
    assert got == {(i, j) for i, a in enumerate(ns) for j, b in enumerate(ns) if i != j and distance(a, b) <= edits}


def distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a):
        before, d[0] = d[0], i + 1
        for j, y in enumerate(b):
            before, d[j + 1] = d[j + 1], min(d[j] + 1, d[j + 1] + 1, before + (x != y))
    return d[-1]


def test_lost_parts_link_to_the_earliest_and_to_no_other(spark):
    history = [(1, "1-р", "2020-01-01", facts(5, 5), None), (2, "20/777-р/к", "2020-01-01", facts(5, 5), None)]
    batches = [[(10, None, "2020-01-01", facts(5, 5), None)], [(20, None, "2020-01-01", facts(5, 5), None), (21, "20/777-р/к", "2020-01-01", None, None)]]
    assert found(spark, history, batches) == {(1, 10), (1, 20), (2, 21)}
    assert found(spark, [], [[(10, None, "2020-01-01", facts(5, 5), None)], [(20, None, "2020-01-01", facts(5, 5), None)], [(30, "7-р", "2020-01-01", facts(5, 5), None)]]) == {(10, 20), (10, 30)}


def test_a_batch_that_broke_off_is_written_anew(spark, monkeypatch):
    parts = lambda rows: inc.act_parts(spark.createDataFrame(rows, SCHEMA))
    index = inc.SegmentIndex(spark)
    index.accept(parts(HISTORY))
    with monkeypatch.context() as m:
        m.setattr(inc, "slips", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.accept(parts(BATCHES[0]))
    assert index.loads() == 1
    index.accept(parts(BATCHES[0]))
    index.accept(parts(BATCHES[1]))
    assert index.loads() == 3
    assert {(r.rec_id_first, r.rec_id_dup) for r in index.repeats(parts(BATCHES[0] + BATCHES[1])).collect()} == WANT
