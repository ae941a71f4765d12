"""Language of documents and of the segments of mixed ones.

One interpolated Kneser-Ney model of characters for each language, all in one set of sorted hash arrays: for
each order the hashes of the n-grams, with one column of log probabilities for each language, and the hashes of the
contexts with their back-off weights; look-up is by binary search. A word's log probabilities depend on the
word alone, so each worker scores a word once. A sentence gets the language of the lowest length-normalised
cross-entropy; a sentence whose margin is under the calibrated threshold is rejected and goes with its
neighbours (best path over the document's sentences with a cost for each change). Neighbouring sentences of one
language make a segment. A document whose cross-entropy is over the calibrated ceiling even so (two and a half times what all but one in a hundred
held-out sentences have) is in none of the languages: one segment of language ``und`` with confidence 0.

The models are fitted on a bounded sample of labelled documents (``per_language`` documents at most for each
language, chosen by a hash of the key); everything else reads all documents whole.

Defined results: null texts and texts without words have no segments (``segments`` gives no row for them);
repeated documents come out each; if no document has a label of the languages there is
nothing to fit, and no document has segments; every label notation of :func:`label_code` counts as its language.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.canon import Transducer

LANGUAGES = ("uk", "ru", "en", "pl", "de")
#: Further codes of the languages.
OTHER_CODES = {"ukr": "uk", "ua": "uk", "rus": "ru", "eng": "en", "pol": "pl", "deu": "de", "ger": "de"}
ORDER = 5
#: Bound of the sample of labelled documents for each language.
PER_LANGUAGE = 1000
#: Words (of more than two letters) and letters in them from which a sentence has a say of its own: single foreign words and inserted symbols make no segment.
LEAST_WORDS, LEAST_LETTERS = 2, 8
#: Language of a text that none of the models knows.
UNKNOWN = "und"
#: Bits that a change of language between two sentences costs.
CHANGE_BITS = 8.0
_RUNS = re.compile(r"[^\W\d_]+")
_LINES = re.compile(r"[\r\n\v\f\x85  ]+")
_END = re.compile(r"[.;!?…][\"'»“”’)\]]*$")


def label_code(label: Column) -> Column:
    """Two-letter code of a label in any notation (``ukr``, ``uk_UA``, ``EN``), null for a placeholder, else its main part."""
    main = F.regexp_extract(F.lower(F.trim(label)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    other = F.create_map(*[F.lit(x) for p in OTHER_CODES.items() for x in p])
    return F.when(main.isin("", "und", "unk", "mul", "zxx"), None).otherwise(F.coalesce(F.try_element_at(other, main), main))


# -- models ---------------------------------------------------------------------------------------------


def _windows(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each character of each word (and its end) the ``order`` characters that end there; number of the word."""
    text = "".join("\x02" * (order - 1) + w + "\x03" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + order for w in words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    own = np.repeat(np.arange(len(words)), lengths - order + 1)
    within = np.arange(len(own)) - np.repeat(np.cumsum(lengths - order + 1) - (lengths - order + 1), lengths - order + 1)
    at = np.repeat(starts, lengths - order + 1) + within
    return codes[at[:, None] + np.arange(order)], own


def _hash(windows: np.ndarray) -> np.ndarray:
    h = np.full(len(windows), 1469598103934665603, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(windows.shape[1]):
            h = (h ^ windows[:, k]) * np.uint64(1099511628211)
            h ^= h >> np.uint64(29)
    return h


@dataclass
class Models:
    """Sorted hash arrays of the models; ``unseen`` is the log probability of a character that no model knows."""

    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoffs: list[np.ndarray]
    unseen: float
    calibration: tuple[float, float] = (0.0, 1.0)
    reject: float = 0.0
    ceiling: float = float("inf")

    def score(self, words: list[str]) -> np.ndarray:
        """Bits of each word under each language (rows words, columns languages)."""
        if not words:
            return np.zeros((0, len(LANGUAGES)))
        w, own = _windows(words, ORDER)
        got = None
        for n in range(1, ORDER + 1):
            at, found = _find(self.grams[n - 1], _hash(w[:, ORDER - n :]))
            if n == 1:
                lower = np.where(found[:, None], self.logs[0][at], self.unseen)
            else:
                c, known = _find(self.contexts[n - 2], _hash(w[:, ORDER - n : ORDER - 1]))
                lower = got + np.where(known[:, None], self.backoffs[n - 2][c], 0.0)
                lower = np.where(found[:, None], self.logs[n - 1][at], lower)
            got = lower
        out = np.zeros((len(words), len(LANGUAGES)))
        np.add.at(out, own, -got)
        return out


def _find(table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        raise ValueError("the models were fitted on nothing")
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return at, table[at] == h


def fit(counts: list[Counter], purge: float = 0.0) -> Models:
    """Interpolated Kneser-Ney models of words with counts, one Counter for each language.

    ``purge``: n-grams whose share in a language is under this part of their greatest share in any are dropped
    there: what wrong labels brought in.
    """
    langs = len(counts)
    words = [list(c) for c in counts]
    data = []
    for c, ws in zip(counts, words):
        if ws:
            w, own = _windows(ws, ORDER)
            data.append((w, np.array([c[x] for x in ws], float)[own]))
        else:
            data.append((np.zeros((0, ORDER), np.uint64), np.zeros(0)))
    full = [(_hash(w), x) for w, x in data]
    if purge:
        keys = np.unique(np.concatenate([h for h, _ in full]))
        share = np.stack([np.bincount(np.searchsorted(keys, h), x, len(keys)) / max(1.0, x.sum()) for h, x in full], 1)
        keep = share >= purge * share.max(1, keepdims=True)
        data = [(w[k], x[k]) for l, ((w, x), (h, _)) in enumerate(zip(data, full)) for k in [keep[np.searchsorted(keys, h), l]]]
    grams, logs, contexts, backoffs = [], [], [], []
    lower_p = None
    size = len(np.unique(np.concatenate([w[:, -1] for w, _ in data]))) + 1
    uniform = 1.0 / size
    for n in range(1, ORDER + 1):
        types, table = [], []
        for w, x in data:
            if n == ORDER:
                h, first = np.unique(_hash(w), return_index=True)
                count = np.bincount(np.searchsorted(h, _hash(w)), x, len(h))
            else:  # continuation counts: distinct characters before the n-gram
                longer, first = np.unique(_hash(w[:, ORDER - n - 1 :]), return_index=True)
                own = _hash(w[first, ORDER - n :])
                h, back = np.unique(own, return_index=True)
                first = first[back]
                count = np.bincount(np.searchsorted(h, own), minlength=len(h)).astype(float)
            types.append((h, count, w[first]))
            table.append(h)
        union, pick = np.unique(np.concatenate(table), return_index=True)
        sample = np.concatenate([t[2] for t in types])[pick]
        suffix = _hash(sample[:, ORDER - n + 1 :]) if n > 1 else None
        context = _hash(sample[:, ORDER - n : ORDER - 1])
        ctx, where = np.unique(context, return_inverse=True)
        p = np.zeros((len(union), langs))
        bow = np.ones((len(ctx), langs))
        base = np.full((len(union), langs), uniform) if n == 1 else lower_p[np.searchsorted(grams[-1], suffix)]
        for l, (h, count, _) in enumerate(types):
            c = np.zeros(len(union))
            c[np.searchsorted(union, h)] = count
            n1, n2 = (count == 1).sum(), (count == 2).sum()
            d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            total = np.bincount(where, c, len(ctx))
            kinds = np.bincount(where, c > 0, len(ctx))
            known = total > 0
            bow[known, l] = d * kinds[known] / total[known]
            t = total[where]
            p[:, l] = np.where(t > 0, np.maximum(c - d, 0) / np.maximum(t, 1e-9), 0) + bow[where, l] * base[:, l]
        lower_p = p
        grams.append(union)
        logs.append(np.log2(np.maximum(p, 1e-12)))
        if n > 1:
            contexts.append(ctx)
            backoffs.append(np.log2(bow))
    return Models(grams, logs, contexts, backoffs, float(np.log2(uniform)) - 4)


# -- words and sentences --------------------------------------------------------------------------------


class Pieces(dict):
    """Blank-separated piece of text to its row in a table of scores; new pieces are scored together by ``fill``."""

    KEPT = 500_000

    def __init__(self, models: Models | None):
        super().__init__()
        self.models = models
        self.plain = Transducer("text", LANGUAGES)
        self.begin()

    def begin(self) -> None:
        """Forget all pieces. Row 0 stands for a line end."""
        self.clear()
        self.todo: list[tuple[int, str]] = []
        self.rows = 1
        # of each piece: bits by language, letters, words of more than two letters and their letters, whether a sentence ends with it
        self.table = np.zeros((1024, len(LANGUAGES) + 4))
        self.table[0, -1] = 1

    def words(self, piece: str) -> list[str]:
        return [w.lower() for w in _RUNS.findall(self.plain(piece))]

    def __missing__(self, piece: str) -> int:
        row = self[piece] = self.rows
        self.rows += 1
        self.todo.append((row, piece))
        return row

    def fill(self) -> None:
        if not self.todo:
            return
        split = [(row, piece, self.words(piece)) for row, piece in self.todo]
        flat = sorted({w for _, _, ws in split for w in ws})
        place = {w: i for i, w in enumerate(flat)}
        bits = np.concatenate([self.models.score(flat[i : i + 20_000]) for i in range(0, len(flat), 20_000)]) if flat else np.zeros((0, len(LANGUAGES)))
        if self.rows > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((max(self.rows - len(self.table), len(self.table)), self.table.shape[1]))])
        for row, piece, ws in split:
            self.table[row, -1] = bool(_END.search(piece))
            for w in ws:
                self.table[row, :-4] += bits[place[w]]
                self.table[row, -4] += len(w)
            telling = [len(w) for w in ws if len(w) > 2]
            self.table[row, -3:-1] = len(telling), sum(telling)
        self.todo = []


def best_path(bits: np.ndarray, change: float = CHANGE_BITS) -> np.ndarray:
    """Language of each sentence: least total bits with a cost for each change of language."""
    n, k = bits.shape
    cost, back = bits[0].copy(), np.zeros((n, k), int)
    for i in range(1, n):
        b = int(cost.argmin())
        stay = cost <= cost[b] + change
        back[i] = np.where(stay, np.arange(k), b)
        cost = np.where(stay, cost, cost[b] + change) + bits[i]
    out = np.zeros(n, int)
    out[-1] = int(cost.argmin())
    for i in range(n - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def confidence(models: Models, bits: np.ndarray) -> float:
    """Calibrated probability that the language with the least bits is right."""
    s = np.sort(bits)
    a, b = models.calibration
    return float(1 / (1 + np.exp(-np.clip(a + b * np.log1p(s[1] - s[0]), -30, 30))))


def scan(models: Models, pieces: Pieces, texts: list[str | None]):
    """Yields for each text its segments: language (None for an unknown one), bits, number of pieces before it; None for a text without words."""
    flat: list[int] = []
    bounds = [0]
    if not len(models.grams[0]):
        texts = [None] * len(texts)
    for t in texts:
        if t:
            for line in _LINES.split(t):
                flat.extend(map(pieces.__getitem__, line.split()))
                flat.append(0)  # a line end ends a sentence
        bounds.append(len(flat))
    pieces.fill()
    ids = np.array(flat, np.int64)
    rows = pieces.table[ids]
    ends = rows[:, -1] > 0
    real = np.cumsum(ids != 0)
    for i in range(len(texts)):
        a, b = bounds[i], bounds[i + 1]
        if a == b:
            yield None
            continue
        cut = np.flatnonzero(ends[a:b]) + 1
        starts = np.r_[0, cut[:-1]] if len(cut) and cut[-1] == b - a else np.r_[0, cut]
        sums = np.add.reduceat(rows[a:b, :-1], starts, 0)
        has = sums[:, -3] > 0
        if not has.any():
            yield None
            continue
        sums, starts = sums[has], starts[has]
        bits, chars, words, telling = sums[:, :-3], sums[:, -3], sums[:, -2], sums[:, -1]
        s = np.sort(bits, 1)
        # a rejected sentence has no say of its own
        sure = ((s[:, 1] - s[:, 0]) / np.maximum(chars, 8) >= models.reject) & (words >= LEAST_WORDS) & (telling >= LEAST_LETTERS)
        say = np.where(sure[:, None], bits, 0.0) if sure.any() else np.tile(bits.sum(0), (len(bits), 1))
        first = say.argmin(1)
        voting = say.any(1)
        path = np.full(len(say), first[voting][0]) if (first[voting] == first[voting][0]).all() else best_path(say)
        if bits[np.arange(len(path)), path].sum() > models.ceiling * chars.sum():
            yield [(None, bits.sum(0), 0)]
            continue
        turn = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
        before = real[a + starts] - (ids[a + starts] != 0) - (real[a - 1] if a else 0)
        yield [(int(path[x]), bits[x:y].sum(0), int(before[x])) for x, y in zip(turn, np.r_[turn[1:], len(path)])]


# -- fitting on a sample ----------------------------------------------------------------------------------


def sample(docs: DataFrame, key: str, text: str, label: str, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``lang, text`` of at most about ``per_language`` labelled documents of each language, chosen by a hash of the key.

    One count of labels sets the share that is kept; no row moves between executors.
    """
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), label_code(F.col(f"`{label}`")).alias("lang")).filter(F.col("lang").isin(*LANGUAGES) & (F.length("t") > 0))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    keep = F.lit(False)
    for lang, n in counts.items():
        keep = keep | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < F.lit(int(per_language / n * (1 << 30)))))
    return rows.filter(keep).select("lang", "t")


def train(rows: list[tuple[str, str]], rounds: int = 2) -> Models:
    """Fit on labelled texts in which some labels are wrong and some texts mixed.

    The first models leave out what is rare in a language against another; each further round is fitted on the
    sentences that the models before it find in the language of their label. A fifth of the sentences is held
    out at the end, to fit the confidence and the margin under which a sentence is rejected.
    """
    held = Pieces(None)
    sentences: list[tuple[int, list[str]]] = []
    for lang, text in rows:
        for line in _LINES.split(text):
            now: list[str] = []
            for piece in line.split():
                now += held.words(piece)
                if _END.search(piece):
                    sentences.append((LANGUAGES.index(lang), now))
                    now = []
            sentences.append((LANGUAGES.index(lang), now))
    sentences = [(l, ws) for l, ws in sentences if ws]

    def counted(some) -> list[Counter]:
        out = [Counter() for _ in LANGUAGES]
        for l, ws in some:
            out[l].update(ws)
        return out

    def scored(models: Models, some) -> np.ndarray:
        flat = sorted({w for _, ws in some for w in ws})
        place = {w: i for i, w in enumerate(flat)}
        bits = models.score(flat)
        return np.stack([bits[[place[w] for w in ws]].sum(0) for _, ws in some]) if some else np.zeros((0, len(LANGUAGES)))

    models = fit(counted(sentences), purge=0.25)
    for _ in range(rounds):
        best = scored(models, sentences).argmin(1)
        clean = [s for s, b in zip(sentences, best) if s[0] == b]
        models = fit(counted(clean))
    part = fit(counted([s for i, s in enumerate(clean) if i % 5]))
    # short pieces of the held-out sentences as well, so that the margins reach down to the hard ones
    test = [(l, ws[:n]) for n in (1, 2, 4, 99) for l, ws in clean[::5]]
    bits = scored(part, test)
    right = np.array([l for l, _ in test]) == bits.argmin(1) if test else np.zeros(0, bool)
    s = np.sort(bits, 1)
    margin, chars = (s[:, 1] - s[:, 0], np.array([sum(map(len, ws)) for _, ws in test])) if test else (np.zeros(0), np.zeros(0))
    models.calibration = _logistic(np.log1p(margin), right)
    models.reject = _threshold(margin / np.maximum(chars, 8), right)
    whole = np.arange(len(test)) >= len(test) // 4 * 3  # the pieces that are whole sentences
    if len(test):
        models.ceiling = float(2.5 * np.quantile(s[whole, 0] / np.maximum(chars[whole], 1), 0.99))
    return models


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    a, b = 0.0, 1.0
    for _ in range(30 if len(x) and 0 < y.mean() < 1 else 0):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        g = np.array([(y - p).sum(), ((y - p) * x).sum()]) - 1e-3 * np.array([a, b])
        w = p * (1 - p)
        h = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum()]]) + 1e-3 * np.eye(2)
        a, b = np.array([a, b]) + np.linalg.solve(h, g)
    return float(a), float(b)


def _threshold(margin: np.ndarray, right: np.ndarray, error: float = 0.02) -> float:
    """Least margin above which at most a share ``error`` of the held-out pieces is wrong."""
    if not len(margin):
        return 0.0
    order = np.argsort(-margin)
    wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    ok = np.flatnonzero(wrong <= error)
    return float(margin[order][ok[-1]]) if len(ok) else float(margin.max())


# -- the operator ---------------------------------------------------------------------------------------


def segments(docs: DataFrame, models: Models, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """``key, label, langs, seg_no, lang, confidence, begin, end`` (characters) of every segment of every document with words.

    ``langs`` lists the languages of the document's segments, in order.

    The models (a few MB: their size follows from the bound of the sample) go to the executors once, as a broadcast.
    """
    held = docs.sparkSession.sparkContext.broadcast(models)
    kind = dict(docs.dtypes)[key]

    def run(batches):
        m = held.value
        pieces = Pieces(m)
        for b in batches:
            if len(pieces) > Pieces.KEPT:
                pieces.begin()
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                texts = part.column(1).to_pylist()
                row, seg, lang, conf, begin, end, langs = [], [], [], [], [], [], []
                for i, found in enumerate(scan(m, pieces, texts)):
                    if found is None:
                        continue
                    places = [0]
                    if len(found) > 1:
                        starts = [x.start() for x in re.finditer(r"\S+", texts[i])]
                        places += [starts[min(f[2], len(starts) - 1)] for f in found[1:]]
                    for j, (l, bits, _) in enumerate(found):
                        row.append(i)
                        seg.append(j)
                        lang.append(UNKNOWN if l is None else LANGUAGES[l])
                        langs.append([UNKNOWN if f[0] is None else LANGUAGES[f[0]] for f in found] if j == 0 else langs[-1])
                        conf.append(0.0 if l is None else confidence(m, bits))
                        begin.append(places[j])
                        end.append(places[j + 1] if j + 1 < len(found) else len(texts[i]))
                take = pa.array(row, pa.int64())
                yield pa.record_batch([part.column(0).take(take), part.column(2).take(take), pa.array(langs, pa.list_(pa.string())), pa.array(seg, pa.int32()), pa.array(lang, pa.string()), pa.array(conf, pa.float64()), pa.array(begin, pa.int32()), pa.array(end, pa.int32())], names=["k", "label", "langs", "seg_no", "lang", "confidence", "begin", "end"])

    got = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), F.col(f"`{label}`").alias("label")).mapInArrow(run, f"k {kind}, label string, langs array<string>, seg_no int, lang string, confidence double, begin int, end int")
    return got.withColumnRenamed("k", key)


def wrong_or_mixed(found: DataFrame) -> DataFrame:
    """The segments of documents whose label is no language of theirs, or that have more than one segment; documents in an unknown language are left out."""
    ok = F.coalesce(F.array_contains("langs", label_code(F.col("label"))), F.lit(False))
    return found.filter((F.col("lang") != UNKNOWN) & (~ok | (F.size("langs") > 1)))
