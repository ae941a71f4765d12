"""Variant spellings of the names of firms and persons.

Each distinct name is read into parts (:mod:`lexmill.llm.party_names`). The words of a firm's own name and the surname of a
person are the tokens of a symmetric-delete index: every token is stored with all its forms of one letter less, beside the
name's other words (sorted, so their order makes no difference); two names that share an entry are one edit apart in one
token at most (a letter missing, added, changed, or exchanged with its neighbour), which is verified. The whole name without spaces
is one token more, for words typed together. Names are only compared under the same form, business and addition (firms) or among
persons, so related firms stay apart. What words are additions is learned from the table as well: last words that many different
names share. An entry is shared by a bounded number of distinct names (the places of a token times the alphabet), so no
group grows with the data.

Persons of one surname are told apart by the other words, aligned by optimal assignment: equal or one edit apart, a short name
for the full one, an initial for a name, or a word that is missing on one side. A name that fits several persons goes to the one
that shares its state code or town, or to none. The distinct forms of a surname are looked up by deletion forms and first letters,
never all against all.

Defined results: null, empty, blank and anonymous names are linked to nothing; equal names of several rows are all linked; tokens of
one or two letters are abbreviations and only linked to equal ones; two names with different state codes, or fuzzy ones from
different towns, are not linked on their own account; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.graph import components
from lexmill.llm.party_names import near, place_key, read, tails
from lexmill.session import width, written

#: Tokens of fewer letters are abbreviations.
LEAST_LETTERS = 3
#: A last word is an addition if it follows so many different words, and this share of all different ones: at most ``1 / TAIL_SHARE`` words can.
TAIL_LEAST, TAIL_SHARE = 20, 0.002


def learned_additions(names: DataFrame, name: str = "party_name") -> frozenset[str]:
    """Last words of firms that stand after many different words; their number is bounded by ``TAIL_SHARE``."""

    def run(batches):
        for b in batches:
            got = [t for t in map(tails, b.column(0).to_pylist()) if t]
            yield pa.record_batch([pa.array([t[0] for t in got], pa.string()), pa.array([t[1] for t in got], pa.string())], names=["last", "before"])

    pairs = names.select(F.col(f"`{name}`").alias("n")).filter("n is not null").mapInArrow(run, "last string, before string").distinct()
    counts = written(pairs.groupBy("last").count(), "tails")
    least = max(TAIL_LEAST, TAIL_SHARE * (counts.agg(F.sum("count")).first()[0] or 0))
    return frozenset(r["last"] for r in counts.filter(F.col("count") >= least).collect())


def parts(names: DataFrame, key: str = "name_id", name: str = "party_name", code: str | None = "id_code", town: str | None = "city") -> DataFrame:
    """``id, scope, token, rest, code, town`` of each readable name. ``scope`` holds what must be equal, ``rest`` a person's other words."""
    q = lambda c: F.col(f"`{c}`") if c else F.lit(None).cast("string")
    kind = dict(names.dtypes)[key]
    learned = learned_additions(names, name)
    rows = names.select(q(key).alias("id"), q(name).alias("name"), q(code).cast("string").alias("code"), q(town).cast("string").alias("town"))

    def run(batches):
        for b in batches:
            at, scope, token, rest, town_out = [], [], [], [], []
            for i, (n, t) in enumerate(zip(b.column(1).to_pylist(), b.column(3).to_pylist())):
                p = read(n, learned)
                if not p.kind or not p.words:
                    continue
                at.append(i)
                if p.kind == "firm":
                    scope.append("|".join((p.form, p.business, p.addition)))
                    token.append(" ".join(p.words))
                    rest.append([])
                else:
                    scope.append("person")
                    token.append(p.words[0])
                    rest.append(list(p.words[1:]))
                place = read_town(t) or p.place
                town_out.append(place or None)
            take = pa.array(at, pa.int64())
            yield pa.record_batch([b.column(0).take(take), pa.array(scope, pa.string()), pa.array(token, pa.string()), pa.array(rest, pa.list_(pa.string())), b.column(2).take(take), pa.array(town_out, pa.string())], names=["id", "scope", "token", "rest", "code", "town"])

    return rows.mapInArrow(run, f"id {kind}, scope string, token string, rest array<string>, code string, town string")


@lru_cache(maxsize=50_000)
def read_town(town: str | None) -> str:
    """A town in the same form as one that a name carries."""
    return place_key(town or "")


def tokens(rows: DataFrame) -> DataFrame:
    """Distinct tokens by scope with a number, and the state code and town if all their rows have but one."""
    one = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).alias(c)
    return rows.groupBy("scope", "token").agg(F.min("id").alias("node"), one("code"), one("town"))


def token_links(toks: DataFrame) -> DataFrame:
    """``a, b``: names of one scope that differ by one edit in one token at most, by the symmetric-delete index."""
    words = F.split("token", " ")
    each = F.transform(words, lambda w, i: F.struct(w.alias("word"), F.array_join(F.array_sort(F.filter(words, lambda _, j: i != j)), " ").alias("others")))
    glued = F.array(F.struct(F.regexp_replace("token", " ", "").alias("word"), F.lit("").alias("others")))
    entries = toks.select("*", F.explode(F.array_distinct(F.concat(each, glued))).alias("_e")).select(*toks.columns, "_e.*")
    n = F.length("word")
    less = F.when(n >= LEAST_LETTERS, F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(F.col("word"), F.lit(1), i - 1), F.substring(F.col("word"), i + 1, n)))).otherwise(F.array().cast("array<string>"))
    forms = entries.select("node", "scope", "code", "town", "word", "others", F.explode(F.array_distinct(F.concat(F.array("word"), less))).alias("form"))
    x, y = forms.alias("x"), forms.alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("scope", "others", "form")]
    met = x.join(y, [*same, F.col("x.node") < F.col("y.node")])
    # relatives share a surname, so its rows' codes and towns say nothing about the token
    agree = lambda c: (F.col("x.scope") == "person") | F.coalesce(F.col(f"x.{c}") == F.col(f"y.{c}"), F.lit(True))
    a, b = F.col("x.word"), F.col("y.word")
    lev = F.levenshtein(a, b, 2)
    # two edits that exchange neighbours: equal letters, and but one place where they turn
    swapped = (lev == 2) & (F.length(a) == F.length(b)) & F.exists(F.sequence(F.lit(1), F.length(a) - 1), lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.length(a))) == b)
    close = (lev == 0) | ((lev == 1) | swapped) & (F.least(F.length(a), F.length(b)) >= LEAST_LETTERS)
    return met.filter(close & agree("code") & agree("town")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def with_roots(rows: DataFrame) -> DataFrame:
    """Rows with ``root``, the number of their token's cluster."""
    toks = written(tokens(rows), "tokens")
    roots = components(written(token_links(toks), "token-links"))
    named = toks.join(roots.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left")
    return rows.join(named.select("scope", "token", F.coalesce("root", "node").alias("root")), ["scope", "token"])


# -- persons of one surname -------------------------------------------------------------------------------


def assignment(cost: list[list[float]]) -> list[int]:
    """Column of each row in an assignment of least total cost (rows at most as many as columns), by augmenting paths."""
    rows, columns = len(cost), len(cost[0]) if cost else 0
    u, v = [0.0] * (rows + 1), [0.0] * (columns + 1)
    owner, way = [0] * (columns + 1), [0] * (columns + 1)
    for i in range(1, rows + 1):
        owner[0], j = i, 0
        least, used = [float("inf")] * (columns + 1), [False] * (columns + 1)
        while True:
            used[j] = True
            delta, to = float("inf"), 0
            for k in range(1, columns + 1):
                if not used[k]:
                    c = cost[owner[j] - 1][k - 1] - u[owner[j]] - v[k]
                    if c < least[k]:
                        least[k], way[k] = c, j
                    if least[k] < delta:
                        delta, to = least[k], k
            for k in range(columns + 1):
                if used[k]:
                    u[owner[k]] += delta
                    v[k] -= delta
                else:
                    least[k] -= delta
            j = to
            if not owner[j]:
                break
        while j:
            owner[j] = owner[way[j]]
            j = way[j]
    out = [0] * rows
    for k in range(1, columns + 1):
        if owner[k]:
            out[owner[k] - 1] = k - 1
    return out


#: Cost of words that don't fit each other: more than any assignment that fits.
UNFIT = 1e6


@lru_cache(maxsize=100_000)
def fits(a: tuple[str, ...], b: tuple[str, ...]) -> int | None:
    """Cost of the best assignment of the words of the shorter to those of the longer, None if some word fits none.

    0 for an equal word (1 more if the words change places), 1 for one edit, 1 for an initial at its own place;
    words left over on the longer side cost nothing.
    """
    if len(a) > len(b):
        a, b = b, a

    def cost(x: str, y: str, moved: bool) -> float:
        if len(x) == 1 or len(y) == 1:
            return UNFIT if moved or x[0] != y[0] else int(x != y)
        if x == y:
            return int(moved)
        return 1 if min(len(x), len(y)) >= LEAST_LETTERS and near(x, y) else UNFIT

    if not a:
        return 0
    costs = [[cost(x, y, i != j) for j, y in enumerate(b)] for i, x in enumerate(a)]
    total = sum(costs[i][j] for i, j in enumerate(assignment(costs)))
    return int(total) if total < UNFIT else None


def _less(word: str) -> set[str]:
    """A word and its forms of one letter less; of an initial only itself."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))} if len(word) >= LEAST_LETTERS else {word}


class Forms:
    """Forms (words without the surname) looked up by what fits them: each word's deletion forms and each word's first letter."""

    def __init__(self):
        self.by_word: dict[str, list[int]] = defaultdict(list)
        self.by_letter: dict[str, list[int]] = defaultdict(list)
        self.bare: list[int] = []

    def add(self, n: int, words: tuple[str, ...]) -> None:
        for form in {f for w in words for f in _less(w)}:
            self.by_word[form].append(n)
        for letter in {w[0] for w in words}:
            self.by_letter[letter].append(n)
        if not words:
            self.bare.append(n)

    def near(self, words: tuple[str, ...]) -> set[int]:
        """All forms that may fit: they share a deletion form or an initial with the word of ours that is rarest."""
        found = []
        for w in words:
            if len(w) == 1:
                found.append(set(self.by_letter[w[0]]))
            else:
                found.append({n for f in _less(w) for n in self.by_word[f]} | set(self.by_word.get(w[0], ())))
        return min(found, key=len) if found else set()


def persons(forms: list[tuple[tuple[str, ...], frozenset, frozenset]]) -> list[int | None]:
    """Person of each distinct form (words without the surname, state codes, towns) of one surname; None for a form that fits several.

    Full forms (a given name and a patronymic written out) that fit make a person; any other form goes to the
    one person that it fits, or that it fits and shares a state code or a town with.
    """
    full = [i for i, (w, _, _) in enumerate(forms) if sum(len(x) > 1 for x in w) >= 2]
    person: dict[int, int] = {}
    # forms that differ by town alone are one spelling of one person
    spelled: dict = {}
    for i in full:
        spelled.setdefault(forms[i][:2], i)
    heads = list(spelled.values())
    root = {i: i for i in heads}

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    known: dict[int, Forms] = defaultdict(Forms)  # by number of words
    for i in heads:
        words, codes, _ = forms[i]
        for j in known[len(words)].near(words):
            if not (codes and forms[j][1] and not codes & forms[j][1]) and fits(words, forms[j][0]) is not None:
                x, y = sorted((find(i), find(j)))
                root[y] = x
        known[len(words)].add(i, words)
    person.update({i: find(spelled[forms[i][:2]]) for i in full})
    rest = [i for i in range(len(forms)) if i not in person]
    # given name alone before initials: without a full form a given name makes the person
    rest.sort(key=lambda i: (-max((len(x) for x in forms[i][0]), default=0) > -2, i))
    held = Forms()
    for j in person:
        held.add(j, forms[j][0])
    for i in rest:
        w, codes, towns = forms[i]
        who = defaultdict(list)
        # without any word, or against forms that have none, every person fits
        for j in sorted({*held.near(w), *held.bare} if w else person):
            if fits(w, forms[j][0]) is not None:
                who[person[j]].append(j)
        if len(who) > 1:
            by_code = {p for p, js in who.items() if any(codes & forms[j][1] for j in js)}
            by_town = {p for p, js in who.items() if any(towns & forms[j][2] for j in js)}
            free = {p for p, js in who.items() if not any(towns and forms[j][2] and not towns & forms[j][2] for j in js)}
            pick = by_code or by_town or free
            who = {p: who[p] for p in pick} if len(pick) == 1 else None
            if who is None:
                continue
        person[i] = next(iter(who)) if who else i
        held.add(i, w)
    return [person.get(i) for i in range(len(forms))]


def _of_surnames(batches):
    """Persons of the forms of each surname; rows come sorted by surname, one surname is held at a time."""
    names = ["root", "rest", "town_key", "code_key", "who"]

    def done(rows: list[tuple]):
        who = persons([(tuple(w), frozenset(filter(None, [c])), frozenset(filter(None, [t]))) for _, w, t, c, _ in rows])
        for r, w in zip(rows, who):
            if w is not None:
                for column, v in zip(out, (*r[:4], rows[w][4])):
                    column.append(v)

    def record():
        kinds = (pa.int64(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64())
        got = pa.record_batch([pa.array(x, k) for x, k in zip(out, kinds)], names=names)
        for x in out:
            x.clear()
        return got

    out: tuple[list, ...] = ([], [], [], [], [])
    held: list[tuple] = []
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if held and held[0][0] != r[0]:
                done(held)
                held = []
            held.append(r)
        yield record()
    if held:
        done(held)
    yield record()


def entities(rows: DataFrame) -> DataFrame:
    """``id, entity`` of each readable name; names that fit several persons are left out."""
    rooted = written(with_roots(rows), "names")
    firms = rooted.filter("scope <> 'person'").select("id", F.col("root").alias("entity"))
    # the distinct forms of a surname: few, however many rows repeat them
    own = rooted.filter("scope = 'person'").withColumn("town_key", F.coalesce("town", F.lit(""))).withColumn("code_key", F.coalesce("code", F.lit("")))
    forms = own.groupBy("root", "rest", "town_key", "code_key").agg(F.min("id").alias("least"))
    # a number of its own for the partitions: these few bytes are much work, and would be merged into one task
    forms = forms.repartition(width(rows.sparkSession, 12), "root").sortWithinPartitions("root", "rest", "town_key", "code_key")
    found = forms.select("root", "rest", "town_key", "code_key", "least").mapInArrow(_of_surnames, "root long, rest array<string>, town_key string, code_key string, who long")
    people = own.join(found, ["root", "rest", "town_key", "code_key"]).select("id", F.col("who").alias("entity"))
    return firms.unionByName(people)


def linked(names: DataFrame, key: str = "name_id", **columns) -> DataFrame:
    """``key, entity, links``: each readable name with its entity (the least name of it) and the number of other names linked to it."""
    e = written(entities(parts(names, key, **columns)), "entities")
    n = e.groupBy("entity").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    return e.join(n, "entity").select(F.col("id").alias(key), F.col("least").alias("entity"), (F.col("n") - 1).alias("links"))


def pairs(names: DataFrame, key: str = "name_id", **columns) -> DataFrame:
    """``a, b`` (a < b): every two rows that name the same firm or person."""
    e = written(entities(parts(names, key, **columns)), "entities").repartition(width(names.sparkSession), "entity")
    x, y = e.select("entity", F.col("id").alias("a")), e.select("entity", F.col("id").alias("b"))
    return x.join(y, "entity").filter("a < b").select("a", "b")
