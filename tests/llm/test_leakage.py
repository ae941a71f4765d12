"""Passages of test items in documents, against a brute-force search."""

import random

from lexmill.llm import leakage as L

WORDS = "альфа бета гамма дельта епсилон дзета ета тета йота каппа лямбда мю ню ксі омікрон пі ро сигма тау іпсилон фі хі псі омега один два три чотири п'ять шість".split()


def item(r, n):
    return [f"{r.choice(WORDS)}{r.randrange(40)}" for _ in range(n)]


def run_of(doc: list[str], it: list[str]) -> int:
    best = 0
    for i in range(len(doc)):
        for j in range(len(it)):
            k = 0
            while i + k < len(doc) and j + k < len(it) and doc[i + k] == it[j + k]:
                k += 1
            best = max(best, k)
    return best


def hashes(docs):
    words = L.Words()
    return [words.of(" ".join(ws)) for ws in docs]


def test_full_suffix_order():
    r = random.Random(7)
    for n in (1, 2, 30, 200):
        docs = [[r.choice("аб") for _ in range(r.randrange(1, 40))] for _ in range(n)]
        docs += docs[: n // 2]  # repeated documents
        s = L.Shard.of(hashes(docs))
        ids = s.ids.tolist()
        assert s.array.tolist() == sorted(range(len(ids)), key=lambda i: ids[i:])


def test_order_goes_on_after_the_first_words():
    s = L.Shard.of(hashes([list("абвгде"), list("абвжзи"), list("абв")]))
    texts = [s.ids[i:].tolist() for i in s.array]
    assert texts == sorted(texts)


def test_intervals_and_longest_matches_equal_brute_force():
    r = random.Random(4)
    docs = [[r.choice("абв") for _ in range(r.randrange(1, 30))] for _ in range(20)]
    s = L.Shard.of(hashes(docs))
    it = [r.choice("абвг") for _ in range(60)]
    words = s.numbers(L.np.array(hashes([it])[0]))
    longest, found = s.matches(words, (2, 5))
    for q in range(len(it)):
        assert longest[q] == max(next((k for k in range(min(len(it) - q, len(d) - i) + 1) if k == min(len(it) - q, len(d) - i) or d[i + k] != it[q + k])) for d in docs for i in range(len(d)))
        for depth, (low, high) in found.items():
            want = sorted((n, i) for n, d in enumerate(docs) for i in range(len(d)) if q + depth <= len(it) and d[i : i + depth] == it[q : q + depth])
            assert sorted((int(L.np.searchsorted(s.starts, p, "right")) - 1, int(p - s.starts[L.np.searchsorted(s.starts, p, "right") - 1])) for p in s.array[low[q] : high[q]]) == want


def brute_chain(doc, it):
    best = {}
    top = 0
    for i in range(len(doc)):
        for j in range(len(it)):
            m = 0
            while m <= min(i, j) and doc[i - m] == it[j - m]:
                m += 1
                if m >= L.SEED:
                    si, sj = i - m + 1, j - m + 1
                    before = [best.get((si - 1 - ga, sj - 1 - gb), 0) for ga in range(L.GAP + 1) for gb in range(L.GAP + 1) if abs(ga - gb) <= L.DRIFT]
                    best[i, j] = max(best.get((i, j), 0), m + max(before))
            top = max(top, best.get((i, j), 0))
    return top


def test_chains_equal_brute_force():
    r = random.Random(9)
    for _ in range(60):
        it = L.np.array([r.randrange(6) for _ in range(r.randrange(1, 25))])
        doc = L.np.array([r.randrange(6) for _ in range(r.randrange(1, 25))])
        words, longest, first, span = L.chain(doc, it)
        assert words == brute_chain(doc.tolist(), it.tolist()) and longest == run_of(doc.tolist(), it.tolist())
        assert words <= span <= len(it) and 0 <= first <= len(it) - span


def test_found_equals_checking_every_pair():
    r = random.Random(3)
    items = [(i, item(r, r.randrange(5, 60))) for i in range(12)]
    docs = []
    for _ in range(60):
        ws = item(r, r.randrange(0, 80))
        _, it = r.choice(items)
        a = r.randrange(len(it))
        own = it[a : a + r.randrange(3, 30)] if r.random() < 0.5 else [w if r.random() < 0.85 else "інше" for w in it]
        ws[len(ws) // 2 : len(ws) // 2] = own
        docs.append(ws)
    docs = [d for d in docs if d]
    s = L.Shard.of(hashes(docs))
    held = L.Items([(i, " ".join(ws)) for i, ws in items])
    got = {(d, held.keys[i]): f for d, i, f in L.search(s, held, True)}
    want = {}
    for d in range(len(docs)):
        for n, k in enumerate(held.keys):
            f = L.chain(s.document(d), s.numbers(held.hashes[held.starts[n] : held.starts[n] + held.lengths[n]]))
            if L.is_leak(f[0], f[1], f[3], int(held.lengths[n])):
                want[d, k] = f
    assert got == want and len(want) > 20 and any(f[1] < L.RUN for f in want.values())
    for (d, k), f in got.items():
        assert f[1] == run_of(docs[d], dict(items)[k])


def test_a_phrase_that_fills_shard_and_items_takes_linear_memory():
    import tracemalloc

    phrase = "які з наступних тверджень правильні".split()
    docs = [phrase * 1800] + [phrase * 3 + [f"x{i}"] for i in range(200)]
    its = L.Items([(i, " ".join(phrase * 20 + [f"y{i}"])) for i in range(120)])
    s = L.Shard.of(hashes(docs))
    tracemalloc.start()
    got = {(d, i) for d, i, _ in L.search(s, its)}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == {(d, i) for d in range(len(docs)) for i in range(120)}
    assert peak < 20_000_000


def test_operator(spark):
    r = random.Random(1)
    a, b = item(r, 50), item(r, 50)
    exchanged = ["***" if n % 7 == 4 else w for n, w in enumerate(b)]
    docs = [
        (1, "Початок. " + " ".join(a[10:22]).upper() + " кінець", "x"),
        (2, " ".join(a[10:20]), None),  # ten words only
        (3, "слово " + " ".join(exchanged) + " слово", None),
        (4, " ".join(a[5:20]).replace("о", "o").replace(" ", ", — "), None),  # look-alikes, other spaces, punctuation
        (5, None, None),
        (6, "", None),
        (7, " ".join(a) + " " + " ".join(b), None),
        (7, " ".join(a) + " " + " ".join(b), None),
        (8, "а" * 100_000 + " " + " ".join(b[:12]), None),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    it = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b)), (3, None), (4, "")], "item_id long, text string")
    got = sorted((x.doc_id, x.item_id) for x in L.leaks(d, it).collect())
    assert got == [(1, 1), (3, 2), (4, 1), (7, 1), (7, 1), (7, 2), (7, 2), (8, 2)]
    assert L.leaks(d.limit(0), it).count() == 0 and L.leaks(d, it.limit(0)).count() == 0
    clean = L.without_leaks(d, L.leaks(d, it))
    assert {(x.doc_id, x.text) for x in clean.collect()} == {(2, docs[1][1]), (5, None), (6, "")}
    assert clean.columns == d.columns


def test_shards_are_searched_again_without_the_corpus(spark):
    r = random.Random(2)
    a, b = item(r, 30), item(r, 30)
    table = L.shards(spark.createDataFrame([("p", " ".join(a)), ("q", " ".join(b))], "doc_id string, text string"))
    for i, ws in ((1, a), (2, b)):
        got = L.found_in(table, spark.createDataFrame([(i, " ".join(ws))], "item_id long, text string")).collect()
        assert [(x.doc_id, x.item_id, x.words, x.longest, x.exchanged, x.at, x.span) for x in got] == [("pq"[i - 1], i, 30, 30, 0, 0, 30)]


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    r = random.Random(5)
    its = [(i, " ".join(item(r, 30))) for i in range(7)]
    d = spark.createDataFrame([(i, "x " + t) for i, t in its], "doc_id long, text string")
    it = spark.createDataFrame(its, "item_id long, text string")
    whole = sorted((x.doc_id, x.item_id) for x in L.leaks(d, it).collect())
    monkeypatch.setattr(L, "BLOCK_ITEMS", 2)
    assert sorted((x.doc_id, x.item_id) for x in L.leaks(d, it).collect()) == whole == [(i, i) for i in range(7)]
