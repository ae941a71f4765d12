"""Acts and the court cases that contest them: matching across sources without a key.

From the texts of a case the passages that contest a decision of the authority are read: number, day, liable
party, fine, each of which may be missing, anonymised or typed in another way. Both sources get several
composite keys; a mention meets all acts of an equal key, and within the keys by name, which are sorted (sorted
neighbourhood), also all acts of the names next to its own in a sliding window; each pair gets a weighted similarity of its fields.
Statements are then assigned to acts, one each (see :func:`assigned`): a case may contest several acts, and an act may be contested by
several cases.

The keys pair a number or a day with a second field, so a run of equal keys is a run of like acts; acts are merged and
equal mentions of many cases are made one before. Of acts that tie on a key none is left out; where very many may tie, as
those of one day and party, a mention with a number meets only the acts without one, for an act of another number can't fit.

Defined results: texts that are null, cite only, or contest something else give no mention; mentions that
fit no act well enough give no row, of equally good acts the lowest record is taken; repeated texts and
register rows count once; empty tables give no rows; only the named columns are read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.registry_text import base, clean_case_number, clean_date, clean_decision_number
from lexmill.llm.incremental_dedup import PARTS, SegmentIndex, act_parts
from lexmill.llm.party_names import read
from lexmill.operators.history import hash_diff
from lexmill.session import written

#: Names before and after a mention's own in sorted order whose acts it is compared with.
WINDOW = 8
#: Weights: field equal, nearly equal, different.
WEIGHTS = {"number": (4.0, 2.0, -4.0), "day": (3.0, 1.0, -4.0), "party": (3.0, 3.0, -1.0), "fine": (2.0, 2.0, -1.0)}
#: Least total of a match: two strong fields, or one with two weaker ones.
LEAST = 5.0
#: Words by which a text says that a decision is contested.
CUES = ["скасувати рішення", "скасування рішення", "скасування постанови колегії", "визнання недійсним рішення", "визнати недійсним рішення", "оскарження рішення", "оспорюється рішення", "не погоджується з рішенням"]
AUTHORITY = r"амку|антимонопольн|територіальн\S* відділення|орган\S* комітету|постанови колегії"


def _first(*cols: Column) -> Column:
    return F.coalesce(*[F.when(c != "", c) for c in cols])


#: End of a sentence: not after an abbreviation or an initial.
SENTENCE_END = r"(?<=[\p{L}]{3}|[)»\"\d]|[)»\"]\.)[.!?;]+(?= +[\p{Lu}«\"№])"


def mentions(texts: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, own_num, number, day, fine, party`` of each statement by which a text contests a decision of the authority.

    A statement runs from words that contest a decision to the end of its sentence or the next such words, however long that is.
    """
    q = lambda c: F.col(f"`{c}`")
    t = F.regexp_replace(base(q(text)), "№ ?(?=№)", "")
    cue = "(?:" + "|".join(CUES) + ")"
    rows = texts.select(q(doc).alias("doc"), t.alias("t")).filter(F.col("t").rlike("(?iu)" + cue) & F.col("t").rlike("(?iu)" + AUTHORITY))
    x = lambda p: F.regexp_extract("t", p, 1)
    party = _first(
        x(r"(?:за позовом|позов) (.+?) до (?:АМКУ|Антимонопольн|територіальн|\S+ територіальн)"),
        x(r"апеляційну скаргу (.+?) (?:у|в) справі"),
        x(r"скаржник (.+?) не погоджується"),
        x(r"Позивач - (.+?)\. Відповідач"),
        x(r"(?:Справа|справа) [№ ]*[\d/]+[.:] (.+?) звернул"),
        x(r"до відповідальності ([^.(]+(?:\([^)]*\))?[^.(]*)"),
    )
    pieces = F.slice(F.split("t", "(?iu)(?=" + cue + ")"), F.lit(1) + F.when(F.col("t").rlike("(?iu)^" + cue), 0).otherwise(1), F.length("t"))
    said = F.array_distinct(F.transform(pieces, lambda p: F.lower(F.get(F.split(p, SENTENCE_END, 2), F.lit(0)))))
    rows = rows.select("doc", clean_case_number(F.col("t")).alias("own_num"), party.alias("party"), F.explode(said).alias("said"))
    number = F.regexp_extract("said", r"№ ?((?:\d{1,3} ?/ ?)?\d{1,4}(?: ?- ?| ?)(?:[рp](?: ?/ ?[кk])?)?)(?![0-9]| ?/ ?[0-9])", 1)
    fine = F.regexp_replace(F.regexp_extract("said", r"штраф\S* в розмірі ([0-9 ]+) (?:грн|гривень)", 1), " ", "")
    got = rows.select("doc", "own_num", clean_decision_number(F.when(number != "", number)).alias("number"), clean_date(F.col("said")).alias("day"), F.when(fine != "", fine).alias("fine"), "party")
    return got.distinct()


def of_cases(found: DataFrame, docs: DataFrame, doc: str = "doc_id", cause: str = "cause_num") -> DataFrame:
    """Mentions with the clean number of their case: the register's, else the text's own."""
    d = docs.select(F.col(f"`{doc}`").alias("doc"), clean_case_number(F.col(f"`{cause}`")).alias("registered")).groupBy("doc").agg(F.max("registered").alias("registered"))
    return found.join(d, "doc", "left").withColumn("cause_num", F.coalesce("registered", "own_num")).filter("cause_num is not null").drop("own_num", "registered", "doc").distinct()


def party_key(names: DataFrame, name: str, keep: list[str]) -> DataFrame:
    """Adds ``scope, token`` (null where anonymous): a firm's form, business, addition and own name, or a person's surname."""
    kinds = dict(names.dtypes)

    def run(batches):
        for b in batches:
            scope, token = [], []
            for n in b.column(b.num_columns - 1).to_pylist():
                p = read(n)
                own = bool(p.words)
                scope.append(("person" if p.kind == "person" else f"{p.form}|{p.business}|{p.addition}") if own else None)
                token.append((p.words[0] if p.kind == "person" else " ".join(p.words)) if own else None)
            yield pa.record_batch([*b.columns[:-1], pa.array(scope, pa.string()), pa.array(token, pa.string())], names=[*keep, "scope", "token"])

    return names.select(*keep, name).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", scope string, token string")


def acts(practice: DataFrame) -> DataFrame:
    """``act, numbers, days, fines, parties`` of each act of practice, over all its records; the sets are of distinct values."""
    parts = written(act_parts(practice), "act-parts")
    index = SegmentIndex(practice.sparkSession)
    index.accept(parts)
    known = index.acts()
    owner = written(
        parts.alias("r").join(known.alias("s"), [F.col(f"r.{p}").eqNullSafe(F.col(f"s.{p}")) for p in PARTS], "left").select("r.rec", "r.number", "r.date", F.coalesce("act", "rec").alias("act")), "owners"
    )
    fine = F.regexp_replace(F.regexp_extract(base(F.col("sanction")), r"([0-9][0-9 ]*) (?:грн|гривень)", 1), " ", "")
    rows = practice.select(F.col("rec_id").alias("rec"), F.when(fine != "", fine).alias("fine"), F.explode_outer("liable_parties").alias("name"))
    keyed = party_key(rows, "name", ["rec", "fine"])
    return (
        owner.join(keyed, "rec")
        .groupBy("act")
        .agg(
            F.collect_set("number").alias("numbers"),
            F.collect_set("date").alias("days"),
            F.collect_set("fine").alias("fines"),
            F.collect_set(F.when(F.col("token").isNotNull(), F.struct("scope", "token"))).alias("parties"),
        )
    )


def _digits(number: Column) -> Column:
    return F.array_sort(F.split(number, ""))


def _keys(rows: DataFrame, keep: list[str], keys: list[Column]) -> DataFrame:
    return rows.select(*keep, F.explode(F.array_distinct(F.array_compact(F.array(*keys)))).alias("_k")).select(*keep, "_k.*").distinct()


def _run(name: str, *parts: Column | str) -> Column:
    """The run of a key; null if a part is."""
    return F.concat(F.lit(name), *[x for p in parts for x in (F.lit("|"), F.col(p) if isinstance(p, str) else p)])


def equal_keys(rows: DataFrame, keep: list[str], act: bool) -> DataFrame:
    """``run`` of each composite key that must be equal, of rows with number, day, fine (nulls make no key).

    Numbers of the same digits share a run, as do days but for the year. A day and a fine are enough only where the act or the
    mention has no number, for two numbers that differ outweigh them: the acts without one have a run of their own, which
    is all that a mention with a number meets.
    """
    none = F.col("number").isNull()
    key = lambda run: F.when(run.isNotNull(), F.struct(run.alias("run")))
    keys = [key(_run("nd", F.concat_ws("", _digits(F.col("number"))), F.substring("day", 6, 5))), key(_run("nf", "number", "fine"))]
    return _keys(rows, keep, [*keys, *[key(F.when(when, _run(f"df{side}", "day", "fine"))) for side, when in _sides(none, act)]])


def _sides(none: Column, act: bool) -> list[tuple[str, Column]]:
    """Run 0 holds the acts without a field and meets the mentions with it, run 1 all acts and the mentions without it."""
    return [("0", none if act else ~none), ("1", F.lit(True) if act else none)]


def sort_keys(rows: DataFrame, keep: list[str], act: bool) -> DataFrame:
    """``run, place`` of each composite key by name, sorted both ways round, of rows with number, day, token (nulls make no key).

    Number and name decide only where a day is missing, day and name where a number is (see :func:`equal_keys`).
    """
    digits, keys = F.concat_ws("", _digits(F.col("number"))), []
    for order, place, end in (("f", F.col("token"), F.substring("token", 1, 2)), ("b", F.reverse("token"), F.substring("token", -2, 2))):
        for name, by, missing in ((f"np{order}", digits, "day"), (f"dp{order}", F.col("day"), "number")):
            for side, when in _sides(F.col(missing).isNull(), act):
                run = F.when(when, _run(name + side, by, end))
                keys.append(F.when(run.isNotNull(), F.struct(run.alias("run"), place.alias("place"))))
    return _keys(rows, keep, keys)


def neighbours(said: DataFrame, known: DataFrame, window: int = WINDOW) -> DataFrame:
    """``mention, act`` of each mention and the acts within ``window`` places of its own place in a run.

    Only distinct places of acts are counted, and all acts of a place are taken: neither many mentions of one act nor many
    acts of one place push anything out of the window.
    """
    both = known.select("run", "place", "act", F.lit(None).cast("long").alias("mention")).unionByName(said.select("run", "place", F.lit(None).cast("long").alias("act"), "mention"))
    w = Window.partitionBy("run").orderBy("place", F.col("act").isNull())
    # the acts of a place come first, so its first row tells whether it holds one
    new = F.col("act").isNotNull() & ~F.lag("place").over(w).eqNullSafe(F.col("place"))
    both = both.withColumn("_new", new.cast("int")).withColumn("at", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    both = written(both.drop("_new"), "neighbourhood")
    a = both.filter("act is not null").select("run", "at", "act")
    m = both.filter("mention is not null").select("run", F.explode(F.sequence(F.col("at") - window + 1, F.col("at") + window)).alias("at"), "mention")
    return m.join(a, ["run", "at"]).select("mention", "act").distinct()


def met(said: DataFrame, known: DataFrame) -> DataFrame:
    """``mention, act`` of all that share a key, or stand near each other by name within one."""
    same = equal_keys(said, ["mention"], False).join(equal_keys(known, ["act"], True), "run").select("mention", "act")
    return same.unionByName(neighbours(sort_keys(said, ["mention"], False), sort_keys(known, ["act"], True))).distinct()


def _field(name: str, value: Column, values: Column, close: Column | None) -> Column:
    same, nearly, other = WEIGHTS[name]
    score = F.when(F.array_contains(values, value), same)
    if close is not None:
        score = score.when(close, nearly)
    return F.when(value.isNull() | (F.size(values) == 0), 0.0).otherwise(score.otherwise(other))


def similarity() -> Column:
    """Weighted total of a mention (number, day, fine, scope, token) against an act's sets."""
    number, day, token = F.col("number"), F.col("day"), F.col("token")
    near_number = F.exists("numbers", lambda v: (F.levenshtein(v, number, 2) >= 0) & (_digits(v) == _digits(number)))
    near_day = F.exists("days", lambda v: (F.substring(v, 6, 5) == F.substring(day, 6, 5)) & (F.abs(F.substring(v, 1, 4).cast("int") - F.substring(day, 1, 4).cast("int")) == 1))
    party = F.exists("parties", lambda v: (v["scope"] == F.col("scope")) & (F.levenshtein(v["token"], token, 2) >= 0) & ((F.levenshtein(v["token"], token, 2) < 2) | (F.length(token) >= 7)))
    same, _, other = WEIGHTS["party"]
    by_party = F.when(token.isNull() | (F.size("parties") == 0), 0.0).when(party, same).otherwise(other)
    return _field("number", number, F.col("numbers"), near_number) + _field("day", day, F.col("days"), near_day) + by_party + _field("fine", F.col("fine"), F.col("fines"), None)


def contested(practice: DataFrame, docs: DataFrame, texts: DataFrame) -> DataFrame:
    """``rec_id, cause_num, confidence`` of the acts that each case contests."""
    fields = ["number", "day", "fine", "scope", "token"]
    cases = party_key(of_cases(mentions(texts), docs), "party", ["cause_num", *fields[:3]]).distinct()
    cases = written(cases.withColumn("mention", hash_diff(fields)), "mentions")
    # equal mentions of many cases are compared once
    said = cases.select("mention", *fields).distinct()
    known = written(acts(practice), "acts")
    flat = known.select("act", F.explode_outer("numbers").alias("number"), "days", "fines", "parties")
    flat = flat.select("act", "number", F.explode_outer("days").alias("day"), "fines", "parties")
    flat = flat.select("act", "number", "day", F.explode_outer("fines").alias("fine"), "parties")
    flat = flat.select("act", "number", "day", "fine", F.explode_outer("parties").alias("_p")).select("act", "number", "day", "fine", "_p.token")
    scored = met(said, flat).join(said, "mention").join(known, "act").withColumn("score", similarity()).filter(F.col("score") >= LEAST).select("mention", "act", "score")
    return assigned(cases.select("cause_num", "mention"), scored)


def assigned(cases: DataFrame, scored: DataFrame) -> DataFrame:
    """``rec_id, cause_num, confidence``: the assignment of each case's statements to acts with the greatest total confidence.

    ``cases``: cause_num, mention; ``scored``: mention, act, score. Every statement of a case goes to one act: of those that it fits, the one with the
    greatest total over all statements of the case (then the lowest record). So statements that can be of one act are, and a case has
    at most as many acts as it has statements; an act may be contested by several cases.
    """
    fit = cases.join(scored, "mention")
    total = fit.groupBy("cause_num", "act").agg(F.sum("score").alias("total"), F.max("score").alias("best"))
    ranked = fit.select("cause_num", "mention", "act").join(total, ["cause_num", "act"])
    one = ranked.groupBy("cause_num", "mention").agg(F.max_by(F.struct("act", "best"), F.struct("total", -F.col("act"))).alias("_b"))
    best = one.groupBy("cause_num", F.col("_b.act").alias("rec_id")).agg(F.max("_b.best").alias("best"))
    return best.select("rec_id", "cause_num", (1 / (1 + F.exp(-(F.col("best") - 3)))).alias("confidence"))
