"""Row constructors: finished practice rows with their court challenge, search texts, display values, case starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import compact, decision_key, first_date, result_key, search_form, unique_texts, url_key
from lexmill.operators.decisions import outcome_code, outcome_label
from lexmill.operators.registry import PRECEDENCE, rank
from lexmill.operators.timeline import case_numbers, qualification, summary

#: Statuses of a challenge with their labels, the type of a court act without one, the label of a row without a code.
STATUS_LABELS = {"ongoing": "Оскарження триває", "upheld": "Рішення АМКУ залишено чинним", "overturned": "Рішення АМКУ скасовано", "partially_overturned": "Рішення АМКУ скасовано частково"}
NO_TYPE, NO_LABEL = "Судовий акт", "Без класифікації"
#: Fields of a row in its search text, in order; arrays are joined by a bar.
BLOB = ["decision_number", "decision_date", "primary_code", "primary_label", "decision_outcome", "outcome_label", "outcome_summary", "classification.primary_label", "liable_parties", "violation_summary", "amcu_reasoning", "respondent_position", "sanction", "key_takeaways", "evidence_factors", "market_or_sector", "search_keywords", "source_resource", "source_file"]
#: Fields in which quoted phrases are looked for.
EXACT = ["decision_number", "decision_date", "primary_code", "primary_label", "outcome_label", "outcome_summary", "liable_parties", "violation_summary", "amcu_reasoning", "respondent_position", "sanction", "key_takeaways", "evidence_factors", "legal_basis", "market_or_sector"]


def given(c: Column | str) -> Column:
    """A text, or null if it is empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c != "", c)


def compacted(c: Column | str) -> Column:
    return given(compact(F.col(c) if isinstance(c, str) else c))


def listed(array: Column | str) -> Column:
    a = F.col(array) if isinstance(array, str) else array
    return F.coalesce(a, F.array().cast("array<string>"))


def court_document(doc_id: Column, kind: Column, date: Column, court: Column, url: Column) -> Column:
    """A court act as a struct; null without an id, with a type where none is given."""
    fields = (F.coalesce(compacted(kind), F.lit(NO_TYPE)).alias("type"), compacted(date).alias("date"), F.coalesce(compacted(court), F.lit("")).alias("court"), F.coalesce(compacted(url), F.lit("")).alias("url"))
    return F.when(doc_id != "", F.struct(doc_id.alias("doc_id"), *fields))


def challenges(cases: DataFrame, key: str = "decision_key") -> DataFrame:
    """``key, challenge`` of each decision from its cases: the status by precedence, the freshest case that has it, all cases newest first.

    ``cases``: key, case_number, challenger, status, status_label, status_detail, latest_merits, latest_relevant (see :func:`court_document`), updated_at.
    Cases without a number are left out. A decision's cases make one array: the few courts that one act goes through.
    """
    fields = ["updated_at", "case_number", "challenger", "status", "status_label", "status_detail", "latest_merits", "latest_relevant"]
    own = cases.filter(F.col("case_number") != "").select(
        key, "updated_at", "case_number", F.coalesce(compacted("challenger"), F.lit("")).alias("challenger"), F.coalesce(compacted("status"), F.lit("ongoing")).alias("status"),
        *[F.coalesce(compacted(c), F.lit("")).alias(c) for c in ("status_label", "status_detail")], "latest_merits", "latest_relevant",
    )
    fresh = F.struct("updated_at", "case_number")
    r = rank(F.col("status"))
    g = own.groupBy(key).agg(
        F.min(r).alias("_r"),
        *[F.max_by(F.when(r == i, F.struct(*fields)), F.when(r == i, fresh)).alias(f"_c{i}") for i in range(len(PRECEDENCE) + 1)],
        F.sort_array(F.collect_list(F.struct(*fields)), asc=False).alias("cases"),
    )
    primary = F.coalesce(*[F.when(F.col("_r") == i, F.col(f"_c{i}")) for i in range(len(PRECEDENCE) + 1)])
    g = g.withColumn("_p", primary)
    labels = F.create_map(*[F.lit(x) for p in STATUS_LABELS.items() for x in p])
    status = F.when(F.col("_p.status").isin(*PRECEDENCE), F.col("_p.status")).otherwise("ongoing")
    decided = F.when(status != "ongoing", F.col("_p.latest_merits"))
    shown = F.coalesce(decided, F.col("_p.latest_relevant"))
    challenge = F.struct(
        status.alias("display_status"), F.try_element_at(labels, status).alias("display_status_label"), F.col("_p.case_number").alias("primary_case_number"),
        F.size("cases").alias("cases_count"), F.coalesce(shown["url"], F.lit("")).alias("display_url"), F.col("_p.latest_merits").alias("latest_merits"), F.col("_p.latest_relevant").alias("latest_relevant"), "cases",
    )
    return g.select(key, challenge.alias("challenge"))


def with_challenges(rows: DataFrame, cases: DataFrame, key: str = "decision_key") -> DataFrame:
    """Rows with ``challenge``, null where the registry knows no case: a left join by key."""
    return rows.join(challenges(cases, key), key, "left")


def _court_texts(c: Column, with_details: bool) -> Column:
    """Search texts of a challenge; ``with_details`` as in the search text, else as in the exact fields."""
    def one(x: Column) -> Column:
        parts = [x["case_number"], x["challenger"], x["status_label"]] + [x["status_detail"]] * with_details
        for doc in (x["latest_merits"], x["latest_relevant"]):
            parts += [doc["court"]] + [doc["type"]] * with_details
        return F.array(*parts)

    head = F.array(c["display_status_label"], c["primary_case_number"])
    each = F.flatten(F.transform(c["cases"], one))
    return F.filter(F.coalesce(F.concat(head, each), F.array().cast("array<string>")), lambda v: v.isNotNull() & (v != ""))


def _fields(rows: DataFrame, names: list[str]) -> list[tuple[Column, bool]]:
    kinds = {f.name: f.dataType.typeName() for f in rows.schema}
    return [(F.col(n), kinds.get(n.split(".")[0]) == "array") for n in names]


def search_blob(rows: DataFrame) -> Column:
    """The lower-case search text of a row with its ``challenge``: all fields that hold something."""
    parts = [given(F.array_join(c, " | ")) if array else given(c) for c, array in _fields(rows, BLOB)]
    return F.lower(F.concat_ws(" || ", *parts, _court_texts(F.col("challenge"), True)))


def exact_fields(rows: DataFrame) -> Column:
    """The fields in which quoted phrases are looked for, each in search form, empty ones left out."""
    parts = [listed(c) if array else F.array(c) for c, array in _fields(rows, EXACT)]
    return F.filter(F.transform(F.concat(*parts, _court_texts(F.col("challenge"), False)), search_form), lambda v: v != "")


def finished(rows: DataFrame) -> DataFrame:
    """Practice rows (with ``challenge``) as they are published: defaults for what is missing, totals, search text and sort key."""
    code = outcome_code(F.col("decision_outcome"))
    total = F.aggregate(F.coalesce(F.transform("sanction_amounts", lambda s: F.coalesce(s["amount_uah"], F.lit(0.0))), F.array().cast("array<double>")), F.lit(0.0), lambda a, x: a + x)
    c = "classification"
    return rows.select(
        "rec_id",
        F.coalesce(given("decision_key"), result_key(F.col("decision_date"), F.col("decision_number"))).alias("decision_key"),
        given("decision_number").alias("decision_number"), given("decision_date").alias("decision_date"),
        *[F.when(F.col(x) != 0, F.col(x)).alias(x) for x in ("year", "month")],
        F.coalesce(given("primary_code"), given(f"{c}.primary_code"), F.lit("other")).alias("primary_code"),
        F.coalesce(given("primary_label"), given(f"{c}.primary_label"), F.lit(NO_LABEL)).alias("primary_label"),
        F.coalesce(given(f"{c}.law_family"), given("law_area"), F.lit("other")).alias("law_family"),
        code.alias("decision_outcome"), outcome_label(code, F.col("outcome_label")).alias("outcome_label"),
        *[F.coalesce(compacted(x), F.lit("")).alias(x) for x in ("outcome_summary", "violation_summary", "amcu_reasoning", "respondent_position", "sanction", "market_or_sector")],
        *[listed(x).alias(x) for x in ("liable_parties", "key_takeaways", "evidence_factors", "search_keywords", "legal_basis")],
        total.alias("sanction_total_uah"), given("confidence").alias("confidence"),
        F.struct(F.col("source_resource").alias("resource_title"), F.col("source_file").alias("file"), F.col("source_url").alias("url"), F.col("source_resource_id").alias("resource_id")).alias("source"),
        F.coalesce(given("analyzed_at"), F.col("analysis.analyzed_at")).alias("analyzed_at"),
        "challenge", search_blob(rows).alias("search_blob"),
        F.concat(F.coalesce(given("decision_date"), F.lit("9999-99-99")), F.lit("|"), F.coalesce(given("decision_number"), F.lit(""))).alias("sort_key"),
    )


def challenge_url(c: Column) -> Column:
    """Where a challenge is shown: its own address, its acts', else the first case's that has one."""
    first = lambda doc: F.get(F.filter(F.transform(c["cases"], lambda x: x[doc]["url"]), lambda u: u != ""), F.lit(0))
    return F.coalesce(given(c["display_url"]), given(c["latest_merits"]["url"]), given(c["latest_relevant"]["url"]), first("latest_merits"), first("latest_relevant"), F.lit(""))


def challenge_counts(rows: DataFrame) -> DataFrame:
    """``challenged, cases``: decisions with a challenge, and their cases."""
    n = F.coalesce(F.when(F.col("challenge.cases_count") > 0, F.col("challenge.cases_count")), F.size("challenge.cases"), F.lit(0))
    return rows.agg(F.count("challenge").alias("challenged"), F.coalesce(F.sum(F.when(F.col("challenge").isNotNull(), n)), F.lit(0)).alias("cases"))


def analysed(annotations: DataFrame, number: Column, date: Column, classification: Column, outcome: Column, file_hash: Column) -> DataFrame:
    """Practice rows from annotations: what they give, else what the text gave (``number``, ``date``); keys and calendar fields.

    The key of a row without a number holds the hash of its file.
    """
    d = F.coalesce(first_date(F.col("decision_date")), date)
    n = F.coalesce(given("decision_number"), number)
    rows = annotations.withColumns({"_d": d, "_n": n, "_c": classification, "_o": outcome})
    return rows.select(
        "rec_id",
        F.concat(F.coalesce("_d", F.lit("unknown-date")), F.lit("|"), F.coalesce(F.col("_n"), file_hash)).alias("decision_key"),
        F.col("_n").alias("decision_number"), F.col("_d").alias("decision_date"),
        F.substring("_d", 1, 4).try_cast("int").alias("year"), F.substring("_d", 6, 2).try_cast("int").alias("month"),
        F.col("_o").alias("decision_outcome"), outcome_label(F.col("_o"), F.coalesce("outcome_label", F.lit(""))).alias("outcome_label"),
        F.col("_c").alias("classification"), F.col("_c.primary_code").alias("primary_code"), F.col("_c.primary_label").alias("primary_label"), F.col("_c.law_family").alias("law_area"),
        F.array_distinct(F.concat(unique_texts(listed("legal_basis")), F.col("_c.secondary_legal_basis"))).alias("legal_basis"),
        *[F.filter(listed(x), lambda v: v != "").alias(x) for x in ("liable_parties", "key_takeaways", "evidence_factors")],
        unique_texts(listed("search_keywords")).alias("search_keywords"),
        *[given(x).alias(x) for x in ("violation_summary", "amcu_reasoning", "respondent_position", "sanction", "market_or_sector", "confidence")],
        decision_key(F.col("_d"), F.col("_n"), file_hash).alias("state_key"),
        F.concat(F.coalesce("_d", F.lit("9999-99-99")), F.lit("|"), F.coalesce("_n", F.lit(""))).alias("sort_key"),
    )


def case_start(pages: DataFrame, cues: list[str]) -> DataFrame:
    """Rows of announced cases from pages (``url, title, page_title, date_from, text``) and what was annotated (``case_numbers, sector, law, short_description``, null where nothing was)."""
    t = F.col("text")
    basic = qualification(t)
    numbers = F.when(F.size("case_numbers") > 0, F.col("case_numbers")).otherwise(case_numbers(t))
    key = F.coalesce(given(url_key(F.trim("url"))), F.sha2(F.concat_ws("|", F.coalesce("title", F.lit("")), F.coalesce("date_from", F.lit(""))), 256))
    return pages.select(
        key.alias("case_start_key"), given(F.substring("date_from", 1, 10)).alias("publication_date"), F.col("date_from").alias("publication_datetime"),
        F.coalesce(given("page_title"), given("title")).alias("title"), "url", F.coalesce(given("sector"), F.lit("other")).alias("sector"), numbers.alias("case_numbers"),
        F.when(F.col("law").isNotNull(), F.col("law")).otherwise(basic["law"]).alias("law"), F.when(F.col("law").isNull(), basic["text"]).alias("qualification"),
        F.coalesce(given("short_description"), given(summary(t, cues))).alias("short_description"), F.sha2(t, 256).alias("page_text_sha256"),
    )
