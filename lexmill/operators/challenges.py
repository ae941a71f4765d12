"""Court challenges: the documents of cases, discovery of candidates, status by the newest decisive act, later acts, merging of registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators.registry import FINAL, label
from lexmill.operators.rows import STATUS_LABELS, court_document

#: Label of an open case that was sent back, words of the relation that discovery gives, what a known case carries.
RETURNED = "Справу направлено на новий розгляд"
KNOWN = {"strength": "known_case_history", "classification": "YES", "confidence": "registry_confirmed", "cache_source": "known_case_registry"}


def is_merits_form(name: Column) -> Column:
    """A form of judgment that decides on the merits, by its name."""
    return name.rlike(r"(?iu)(?:^|\s)(?:рішення|постанова)(?:\s|$)") & ~name.rlike("(?iu)ухвала|судовий наказ")


def case_documents(docs: DataFrame, order: Column, merits: Column) -> DataFrame:
    """``cause, latest_merits, latest_active, earliest_active, primary_doc, primary_kind`` of each case from its active documents.

    ``docs``: cause and the fields ``doc_id, type, date, court, url``. The first document to read is the newest on the merits, else the newest.
    """
    doc = court_document(F.col("doc_id"), F.col("type"), F.col("date"), F.col("court"), F.col("url"))
    g = docs.filter("cause is not null").groupBy("cause").agg(
        F.max_by(F.when(merits, doc), F.when(merits, order)).alias("latest_merits"), F.max_by(doc, order).alias("latest_active"), F.min_by(doc, order).alias("earliest_active")
    )
    kind = F.when(F.col("latest_merits").isNotNull(), "latest_merits").when(F.col("latest_active").isNotNull(), "latest_active").otherwise("none")
    return g.withColumn("primary_doc", F.coalesce("latest_merits", "latest_active")).withColumn("primary_kind", kind)


def newest_first(docs: DataFrame, order: Column, merits: Column) -> DataFrame:
    """Documents on the merits with their ``place`` in their case, the newest first; equal ones by id."""
    w = Window.partitionBy("cause").orderBy(order.desc(), F.col("doc_id"))
    return docs.filter(merits & F.col("cause").isNotNull()).withColumn("place", F.row_number().over(w))


# -- discovery --------------------------------------------------------------------------------------------


def discovered(cases: DataFrame, hits: DataFrame, excluded: DataFrame) -> DataFrame:
    """``cause, doc_id, number, source`` of the candidates of each case.

    ``cases``: cause, primary_doc, primary_kind, earliest (ids); ``hits``: doc_id, number; ``excluded``: doc_id of texts in which the authority itself sues.
    The earliest document is looked at only where the first one has no hit at all; an excluded first document drops its own candidates, never those of the earliest.
    """
    doc = lambda c, source, first: F.struct(F.col(c).alias("doc_id"), source.alias("source"), F.lit(first).alias("_first"))
    fallback = F.when(F.col("earliest") != F.col("primary_doc"), doc("earliest", F.lit("earliest_fallback"), False))
    looked = cases.select("cause", F.explode(F.array(doc("primary_doc", F.col("primary_kind"), True), fallback)).alias("_d")).select("cause", "_d.*")
    # all inputs grow with the register, and the optimizer's estimates go by the size of its files: merged, none is ever sent to the driver for a broadcast
    found = looked.join(hits.hint("merge"), "doc_id").withColumn("_any", F.max("_first").over(Window.partitionBy("cause")))
    own = found.filter(F.col("_first") | ~F.col("_any"))
    out = excluded.select(F.col("doc_id").alias("_x"))
    return own.join(out.hint("merge"), F.col("_first") & (F.col("doc_id") == F.col("_x")), "left_anti").select("cause", "doc_id", "number", "source")


def strength(party: Column) -> Column:
    return F.when(party, "number+party").otherwise("number_only")


def weak(classification: Column, date: Column, party: Column) -> Column:
    """A confirmed candidate that neither its day nor its party supports."""
    return F.coalesce((F.upper(classification) == "YES") & ~date & ~party, F.lit(False))


def priority(party: Column, date: Column, order: Column) -> list[Column]:
    """Candidates with party and day first, then those with the party, newest documents first."""
    return [(party & date).desc(), party.desc(), order.desc()]


def known_case_rows(cases: DataFrame) -> DataFrame:
    """Work rows for known cases: their link is confirmed, so nothing is discovered again; an unknown status is open."""
    status = F.when(F.lower(F.trim("status")).isin(*STATUS_LABELS), F.lower(F.trim("status"))).otherwise("ongoing")
    return cases.select("decision_key", "case_number", *[F.lit(v).alias(k) for k, v in KNOWN.items()], F.coalesce(F.trim("challenger"), F.lit("")).alias("challenger"), status.alias("case_outcome"), F.lit(False).alias("resolves"), F.lit(False).alias("invalidates"))


def seeded(candidates: DataFrame, seeds: DataFrame, keys: list[str], guard: dict[str, object]) -> DataFrame:
    """Candidates with approved answers; a seed counts only for the same run (``guard``), and only as confirmed and still open."""
    own = seeds
    for c, v in guard.items():
        own = own.filter(F.col(c).eqNullSafe(F.lit(v)))
    own = own.select(*keys, F.lit(True).alias("_hit")).distinct()
    hit = F.coalesce("_hit", F.lit(False))
    out = candidates.join(own, keys, "left")
    return out.withColumns({"classification": F.when(hit, "YES"), "case_outcome": F.when(hit, "ongoing"), "merits": F.when(hit, "not_applicable"), "seeded": hit}).drop("_hit")


# -- status -----------------------------------------------------------------------------------------------


def status(events: DataFrame, keys: list[str], order: Column, prior: DataFrame) -> DataFrame:
    """``keys, case_status, challenge_status, merits_doc, invalidates`` of each case by its newest decisive document.

    ``events``: keys, doc_id, verified, invalidates, resolves, outcome of each document on the merits; ``prior``: keys, prior_status (null where no
    earlier result is known). Documents are judged from the newest on; the first that can't be verified, invalidates or resolves decides. It is
    the maximum over the decisive ones, so no walk is needed.
    """
    final = F.col("outcome").isin(*FINAL)
    event = F.when(~F.col("verified"), "unverified").when(F.col("invalidates"), "invalidates").when(F.col("resolves") & final, "resolves")
    g = events.withColumn("_e", event).groupBy(*keys).agg(F.max_by(F.when(F.col("_e").isNotNull(), F.struct("_e", "doc_id", "outcome")), F.when(F.col("_e").isNotNull(), order)).alias("_d"))
    out = prior.join(g, keys, "left")
    e, old = F.col("_d._e"), F.col("prior_status")
    return out.select(
        *keys,
        F.when(e == "resolves", F.col("_d.outcome")).when(e == "invalidates", "ongoing").otherwise(F.coalesce(old, F.lit("ongoing"))).alias("case_status"),
        F.when(e == "resolves", "merits_found").when(e == "invalidates", "pending_no_merits").when(e == "unverified", "merits_not_verified").otherwise(F.when(old.isNotNull(), "history_prior_merits").otherwise("pending_no_merits")).alias("challenge_status"),
        F.when(e == "resolves", F.col("_d.doc_id")).alias("merits_doc"), F.coalesce(e == "invalidates", F.lit(False)).alias("invalidates"),
    )


def later_act(rows: DataFrame) -> DataFrame:
    """Cases with a final result after the newest act that came later: ``annotation`` says what it means, null that it could not be read.

    ``rows``: keys, case_status, challenge_status, merits_doc, merits_order, latest_doc, latest_order, annotation.
    """
    eligible = F.coalesce(F.col("case_status").isin(*FINAL) & F.col("merits_doc").isNotNull() & (F.col("latest_doc") != F.col("merits_doc")) & (F.col("latest_order") > F.col("merits_order")), F.lit(False))
    a = F.col("annotation")
    undone, reopened, unread = eligible & (a == "INVALIDATES_PRIOR"), eligible & (a == "ONGOING"), eligible & ~F.coalesce(a.isin("INVALIDATES_PRIOR", "ONGOING", "FINAL_UNCHANGED"), F.lit(False))
    yes = lambda c: F.coalesce(c, F.lit(False))
    return rows.withColumns({
        "eligible": eligible,
        "case_status": F.when(yes(undone) | yes(reopened), "ongoing").otherwise(F.col("case_status")),
        "challenge_status": F.when(yes(undone), "pending_no_merits").when(yes(reopened), "merits_found_review_ongoing").when(unread, "current_status_not_verified").otherwise(F.col("challenge_status")),
        "merits_doc": F.when(~yes(undone), F.col("merits_doc")), "invalidates": yes(undone), "blocks_write": unread,
    })


# -- registry ---------------------------------------------------------------------------------------------


def merge_cases(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Two registries of cases: all fields of the fresher row (by date and id of its newest act, as texts; the incoming one on a tie), but the union of years,
    the newest act of both, the newest act on the merits of both unless the fresher row undoes it, and the latest update; labels anew.

    Columns: keys, status, status_detail, challenger, invalidates, source_years, latest_relevant, latest_merits (structs), updated_at.
    """
    empty = F.lit("")
    both = existing.withColumn("_in", F.lit(0)).unionByName(incoming.withColumn("_in", F.lit(1)))
    age = lambda c: F.struct(F.coalesce(F.col(f"{c}.date"), empty), F.coalesce(F.col(f"{c}.doc_id"), empty))
    there = lambda c: F.coalesce(F.col(f"{c}.doc_id"), empty) != ""
    newest = lambda c: F.max_by(F.when(there(c), F.col(c)), F.when(there(c), age(c))).alias(c)
    g = both.groupBy(*keys).agg(
        F.max_by(F.struct("status", "status_detail", "challenger", "invalidates"), F.struct(age("latest_relevant"), "_in")).alias("_f"),
        newest("latest_relevant"), newest("latest_merits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("source_years")))).alias("source_years"), F.max("updated_at").alias("updated_at"),
    )
    undone = F.coalesce("_f.invalidates", F.lit(False))
    st = F.when(undone, "ongoing").otherwise(F.coalesce(F.when(F.col("_f.status") != "", F.lower("_f.status")), F.lit("ongoing")))
    g = g.withColumn("status", st).withColumn("latest_merits", F.when(~undone, F.col("latest_merits")))
    detail = F.coalesce("_f.status_detail", empty)
    return g.select(*keys, "status", label(F.col("status"), detail, STATUS_LABELS, RETURNED).alias("status_label"), detail.alias("status_detail"), F.col("_f.challenger").alias("challenger"), undone.alias("invalidates"), "latest_relevant", "latest_merits", "source_years", "updated_at")


def outcome_counts(cases: DataFrame, status_column: str = "status") -> DataFrame:
    """One row: how many cases have each status, zero where none has."""
    return cases.agg(*[F.count_if(F.col(status_column) == s).alias(s) for s in STATUS_LABELS], F.count("*").alias("cases"))
