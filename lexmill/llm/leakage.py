"""Evaluation passages in a corpus: suffix arrays over shards of the corpus, searched for every suffix of the test items.

A shard is a run of whole documents. Its words (in a form that ignores case, punctuation, spacing and characters that only
look different) are numbered, and all its suffixes are sorted in full (prefix doubling; each document ends with a sign of its
own, so no suffix runs into the next document). The shards are a table, written once and searched for any number of items.

Each suffix of each item is looked up by binary search, word by word: what it matches is an interval of the suffix array, and stays
one, however often a phrase is repeated. The depth at which the interval becomes empty is the longest verbatim match. From the intervals
come

- the documents that hold ``RUN`` words in a row of an item, and
- the documents that hold enough short pieces of an item to be its run with single words exchanged. An item's most frequent
  pieces, of which a passage can't consist alone, bring up no documents. These documents are aligned with the item: matches
  of ``SEED`` words or more that lie on neighbouring diagonals, with up to ``GAP`` words exchanged or lost between them, are chained.
  The chain is a leak if it runs over at least ``SPAN`` of the item and holds at least ``SHARE`` of its words, and ``RUN`` words.
  (Texts made after the pattern of an item share pieces of it, but not its run as a whole.)

The memory of a search is linear in the shard and the items, also where one phrase fills both.

Defined results: null and empty texts hold nothing; an item of fewer than ``RUN`` words is never reported, as a leak is defined by that
many words of it; repeated documents and items are reported each; nothing is cut: texts are read whole, and the items may be any
number (they are searched in blocks of bounded size, one after the other).
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.chars import CYRILLIC_ALIKE, LATIN_ALIKE
from lexmill.llm.canon import GREEK_ALIKE, GREEK_CYRILLIC, invisible
from lexmill.session import scratch_path, written

#: Words in a row that make a leak.
RUN = 12
#: Shares of an item that a passage with exchanged words covers, and holds verbatim.
SPAN, SHARE = 0.7, 0.6
#: Most words between two neighbouring matches of a chain, and most by which the two sides may differ there.
GAP, DRIFT = 6, 2
#: Words of a shortest match.
SEED = 3
#: Words in a shard, and items and their words in a block: bounds of memory, not of the result.
SHARD_WORDS = 600_000
BLOCK_ITEMS, BLOCK_WORDS = 2_000, 400_000
_WORD = re.compile(r"[^\W_]+")
_APOSTROPHES = re.compile("['’‘ʼ`´ʹ]")


@lru_cache
def _skeleton_table() -> dict[int, str]:
    pairs = dict(zip((LATIN_ALIKE + GREEK_ALIKE).lower(), (CYRILLIC_ALIKE + GREEK_CYRILLIC).lower()))
    pairs |= {"b": "в", "t": "т", "m": "м", "n": "п", "h": "н", "k": "к", "u": "и"}
    return str.maketrans(pairs)


def words_of(text: str) -> list[str]:
    """The words of a text in a form in which all characters that look alike are one."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        text = "".join(c for c in text if not (unicodedata.category(c) == "Mn" or invisible(c)))
    return _WORD.findall(_APOSTROPHES.sub("", text).casefold().translate(_skeleton_table()))


class Words(dict):
    """Blank-separated piece of text to the hashes of its words (64 bits)."""

    KEPT = 400_000

    def __missing__(self, piece: str) -> list[int]:
        got = [xxhash.xxh64_intdigest(w) >> 1 for w in words_of(piece)]
        if len(piece) <= 64:
            if len(self) >= self.KEPT:
                self.clear()
            self[piece] = got
        return got

    def of(self, text: str) -> list[int]:
        return [h for piece in text.split() for h in self[piece]]


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """All suffixes of ``ids`` in order, by prefix doubling. The last sign of ``ids`` must be unique, and so must be every sign that a suffix may not run past."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)

    def ranked(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Number the suffixes at sorted ``slots`` by their group's first slot; the slots of groups that are not told apart yet."""
        new = np.r_[True, keys[1:] != keys[:-1]]
        group = np.cumsum(new) - 1
        rank[order[slots]] = slots[np.flatnonzero(new)[group]]
        return slots[np.bincount(group)[group] > 1]

    slots, k = np.arange(n), 1
    slots = ranked(slots, ids[order]) if n else slots
    while len(slots):
        p = order[slots]
        keys = rank[p] * np.int64(n) + rank[p + k]
        s = np.argsort(keys, kind="stable")
        order[slots] = p[s]
        slots = ranked(slots, keys[s])
        k *= 2
    return order


class Shard:
    """Words of some documents as numbers (``ids``), the hashes behind them (``vocabulary``, sorted), the documents' first places, the suffix array."""

    def __init__(self, vocabulary: np.ndarray, ids: np.ndarray, starts: np.ndarray, array: np.ndarray):
        self.vocabulary, self.ids, self.starts, self.array = vocabulary, ids, starts, array

    @classmethod
    def of(cls, hashes: list[list[int]]) -> Shard:
        lengths = np.array([len(h) for h in hashes], np.int64)
        flat = np.fromiter((x for h in hashes for x in h), np.int64, int(lengths.sum()))
        vocabulary, words = np.unique(flat, return_inverse=True)
        starts = np.cumsum(lengths + 1) - (lengths + 1)
        ids = np.empty(len(flat) + len(hashes), np.int32)
        doc = np.repeat(np.arange(len(hashes)), lengths)
        ids[np.arange(len(flat)) + doc] = words
        ids[starts + lengths] = len(vocabulary) + np.arange(len(hashes))  # each document's end
        return cls(vocabulary, ids, starts.astype(np.int32), suffix_array(ids).astype(np.int32))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words here; -1 for words that no document holds."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1) if len(self.vocabulary) else np.full(len(hashes), -1)

    def narrow(self, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each interval of suffixes that share ``depth`` words the part whose next word is ``word``, by binary search."""

        last = len(self.ids) - 1

        def first(least: np.ndarray) -> np.ndarray:
            a, b = low.copy(), high.copy()
            while (open_ := a < b).any():
                mid = (a + b) // 2  # of an interval that is closed already it is any place
                less = open_ & (self.ids[np.minimum(self.array[np.minimum(mid, last)] + depth, last)] < least)
                a, b = np.where(less, mid + 1, a), np.where(open_ & ~less, mid, b)
            return a

        return first(word), first(word + 1)

    def matches(self, words: np.ndarray, depths: tuple[int, ...]) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """Longest verbatim match of every suffix of ``words`` (-1 is in no document), and its interval at each of ``depths`` (empty where it ends before)."""
        n = len(words)
        longest = np.zeros(n, np.int64)
        low, high = np.zeros(n, np.int64), np.full(n, len(self.array), np.int64)
        out = {d: (np.zeros(n, np.int64), np.zeros(n, np.int64)) for d in depths}
        live, depth = np.arange(n), 0
        while len(live):
            live = live[live + depth < n]
            live = live[words[live + depth] >= 0]
            a, b = self.narrow(low[live], high[live], depth, words[live + depth])
            low[live], high[live] = a, b
            live = live[a < b]
            depth += 1
            longest[live] = depth
            if depth in out:
                out[depth][0][live], out[depth][1][live] = low[live], high[live]
        return longest, out

    def documents(self, low: int, high: int) -> np.ndarray:
        """Numbers of the documents in an interval, each once."""
        return np.unique(np.searchsorted(self.starts, self.array[low:high], "right") - 1)

    def document(self, number: int) -> np.ndarray:
        end = self.starts[number + 1] if number + 1 < len(self.starts) else len(self.ids)
        return self.ids[self.starts[number] : end - 1]


class Items:
    """A block of test items as hashes, one after the other with a sign between them that no document holds."""

    def __init__(self, rows: list[tuple[object, str]]):
        words = Words()
        held = [(k, h) for k, t in rows if t and len(h := words.of(t)) >= RUN]
        self.keys = [k for k, _ in held]
        self.lengths = np.array([len(h) for _, h in held], np.int64)
        self.starts = np.cumsum(self.lengths + 1) - (self.lengths + 1)
        self.hashes = np.array([x for _, h in held for x in (*h, -1)], np.int64)
        self.item = np.repeat(np.arange(len(held)), self.lengths + 1)


def chain(doc: np.ndarray, item: np.ndarray) -> tuple[int, int, int, int]:
    """Words, longest match, first item word and span of the best chain of matches of ``SEED`` words or more.

    One row for each word of the item over all places of the document; only the rows a gap can reach back to are kept.
    """
    n, mask = len(doc), (1 << 24) - 1
    order = np.argsort(doc, kind="stable")
    low, high = np.searchsorted(doc, item, "left", order), np.searchsorted(doc, item, "right", order)
    none = np.zeros(n + 1, np.int64)
    run = value = none  # of matches that end at a place (from 1); value: words, then the earliest start
    past: list[np.ndarray] = []
    best, end, longest = 0, 0, 0
    for j in range(len(item)):
        if low[j] == high[j]:
            run = value = none
        else:
            at = order[low[j] : high[j]] + 1
            before = run[at - 1]
            now, worth = np.zeros(n + 1, np.int64), none
            now[at] = before + 1
            longest = max(longest, int(before.max()) + 1)
            begun, more = at[before == SEED - 1], at[before >= SEED]
            if len(begun) or len(more):
                worth = np.zeros(n + 1, np.int64)
                worth[more] = value[more - 1] + (mask + 1)
                if len(begun):
                    top = np.full(len(begun), mask - (j - SEED + 1), np.int64)
                    for gb in range(min(GAP + 1, max(0, len(past) - SEED + 1))):
                        row = past[len(past) - SEED - gb] if len(past) - SEED - gb >= 0 else none
                        if row is not none:
                            for ga in range(max(0, gb - DRIFT), min(GAP, gb + DRIFT) + 1):
                                top = np.maximum(top, row[np.maximum(begun - SEED - ga, 0)])
                    worth[begun] = top + SEED * (mask + 1)
                if (m := int(worth[np.concatenate((begun, more))].max())) >> 24 > best >> 24:
                    best, end = m, j
            run, value = now, worth
        past.append(value)
        if len(past) > SEED + GAP + 1:
            past.pop(0)
    first = mask - (best & mask)
    return best >> 24, longest, first if best else 0, end - first + 1 if best else 0


def is_leak(words: int, longest: int, span: int, length: int) -> bool:
    return longest >= RUN or (words >= max(RUN, SHARE * length) and span >= SPAN * length)


def _groups(low: np.ndarray, high: np.ndarray, shard: Shard) -> tuple[np.ndarray, list[np.ndarray]]:
    """Number of each interval among the distinct ones (-1 if empty), and the documents of each distinct one. An interval is read once, whoever asks."""
    there = high > low
    first, at, number = np.unique(low[there], return_index=True, return_inverse=True)
    out = np.full(len(low), -1, np.int64)
    out[there] = number
    return out, [shard.documents(a, b) for a, b in zip(first, high[there][at])]


def _pairs(group: np.ndarray, documents: list[np.ndarray], item: np.ndarray, items: int) -> np.ndarray:
    """Distinct pairs ``document * items + item`` of item places with a group and that group's documents."""
    asked = np.unique(group[group >= 0] * np.int64(items) + item[group >= 0])
    parts = [documents[g] * np.int64(items) + i for g, i in zip(asked // items, asked % items)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def search(shard: Shard, items: Items, detail: bool = False):
    """Document number, item number and the passage's figures (words, longest, first item word, span; only with ``detail`` for long matches) of each leak."""
    count = len(items.keys)
    if not count or not len(shard.ids):
        return
    words = shard.numbers(items.hashes)
    _, found = shard.matches(words, (SEED, RUN))
    long_pairs = _pairs(*_groups(*found[RUN], shard), items.item, count)
    group, documents = _groups(*found[SEED], shard)
    # a passage with exchanged words holds at least so many of its item's pieces
    least = np.ceil(np.maximum(RUN, SHARE * items.lengths) / SEED).astype(np.int64)
    often = np.where(group >= 0, np.array([len(d) for d in documents] + [0])[group], -1)
    by_item = np.lexsort((-often, items.item))
    place = np.empty(len(group), np.int64)
    place[by_item] = np.arange(len(group)) - items.starts[items.item[by_item]]
    rare = np.where(place >= (least - 1)[items.item], group, -1)
    near = np.setdiff1d(_pairs(rare, documents, items.item, count), long_pairs, assume_unique=True)
    held = np.unique(np.concatenate([d * np.int64(len(documents)) + g for g, d in enumerate(documents)])) if documents else np.zeros(0, np.int64)
    for pair in long_pairs:
        d, i = divmod(int(pair), count)
        own = slice(items.starts[i], items.starts[i] + items.lengths[i])
        yield d, i, chain(shard.document(d), words[own]) if detail else None
    for pair in near:
        d, i = divmod(int(pair), count)
        own = slice(items.starts[i], items.starts[i] + items.lengths[i])
        # the item's words that lie in a piece which the document holds: no chain has more
        codes = np.where(group[own] >= 0, d * np.int64(len(documents)) + group[own], -1)
        hit = held[np.minimum(np.searchsorted(held, codes), len(held) - 1)] == codes
        if np.convolve(hit, np.ones(SEED, int))[: len(hit)].astype(bool).sum() >= max(RUN, SHARE * items.lengths[i]):
            figures = chain(shard.document(d), words[own])
            if is_leak(figures[0], figures[1], figures[3], int(items.lengths[i])):
                yield d, i, figures


# -- the operator -----------------------------------------------------------------------------------------


def shards(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The corpus as a written table of shards: ``keys`` of their documents, and their arrays. One scan, no shuffle."""
    kind = dict(docs.dtypes)[key]

    def run(batches):
        words = Words()
        keys, hashes, held = [], [], 0

        def record():
            s = Shard.of(hashes)
            row = [pa.array([pa.concat_arrays(keys).to_pylist()], pa.list_(keys[0].type))] + [pa.array([x.tobytes()], pa.binary()) for x in (s.vocabulary, s.ids, s.starts, s.array)]
            return pa.record_batch(row, names=["keys", "vocabulary", "ids", "starts", "sorted"])

        for b in batches:
            for i, t in enumerate(b.column(1).to_pylist()):
                own = words.of(t) if t else None
                if not own:
                    continue
                keys.append(b.column(0).slice(i, 1))
                hashes.append(own)
                held += len(own) + 1
                if held >= SHARD_WORDS:
                    yield record()
                    keys, hashes, held = [], [], 0
        if hashes:
            yield record()

    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    return written(rows.mapInArrow(run, f"keys array<{kind}>, vocabulary binary, ids binary, starts binary, sorted binary"), "shards")


def blocks(items: DataFrame, key: str, text: str):
    """Blocks of items ``(key, text)`` of bounded size; one block at a time is on the driver."""
    block, size = [], 0
    for r in items.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).filter("t is not null").toLocalIterator():
        block.append((r.k, r.t))
        size += len(r.t) // 4
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def found_in(table: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", item_text: str = "text", detail: bool = True) -> DataFrame:
    """``doc_key, item_key, words, longest, exchanged, at, span`` of each leak that a table of :func:`shards` holds.

    ``detail``: false leaves the figures of passages with ``RUN`` words in a row null. The shards are read once for each block of items.
    """
    kinds = table.schema["keys"].dataType.elementType.simpleString(), dict(items.dtypes)[item_key]
    schema = f"d {kinds[0]}, i {kinds[1]}, words int, longest int, exchanged int, at int, span int"
    names = ["d", "i", "words", "longest", "exchanged", "at", "span"]
    path = scratch_path(table.sparkSession, "leaks")

    def searching(block: list):
        def run(batches):
            held = Items(block)
            for b in batches:
                for r in range(b.num_rows):
                    arrays = [np.frombuffer(b.column(c)[r].as_buffer(), t) for c, t in ((1, np.int64), (2, np.int32), (3, np.int32), (4, np.int32))]
                    keys, rows = b.column(0)[r].values, []
                    for d, i, f in search(Shard(*arrays), held, detail):
                        rows.append((d, held.keys[i], *((f[0], f[1], f[3] - f[0], f[2], f[3]) if f else (None,) * 5)))
                    if rows:
                        cols = list(zip(*rows))
                        yield pa.record_batch([keys.take(pa.array(cols[0], pa.int64())), pa.array(cols[1]), *[pa.array(c, pa.int32()) for c in cols[2:]]], names=names)

        return table.mapInArrow(run, schema)

    for block in blocks(items, item_key, item_text):
        searching(block).write.mode("append").parquet(path)
    table.sparkSession.createDataFrame([], schema).write.mode("append").parquet(path)
    return table.sparkSession.read.schema(schema).parquet(path).withColumnsRenamed({"d": doc_key, "i": item_key})


def leaks(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", doc_text: str = "text", item_key: str = "item_id", item_text: str = "text", detail: bool = True) -> DataFrame:
    """The leaks of a corpus: :func:`shards`, then :func:`found_in`."""
    return found_in(shards(docs, doc_key, doc_text), items, doc_key, item_key, item_text, detail)


def without_leaks(docs: DataFrame, found: DataFrame, doc_key: str = "doc_id") -> DataFrame:
    """The corpus without the documents that hold a passage."""
    return docs.join(found.select(doc_key).distinct(), doc_key, "left_anti")
