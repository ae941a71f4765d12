"""Queries over practice with its court challenges: finished rows, discovery, status, registries; each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.functions.chars import fold_digits
from lexmill.functions.registry_text import clean_case_number
from lexmill.operators import challenges as K
from lexmill.operators import court_documents as V
from lexmill.operators import registry as G
from lexmill.operators import rows as R
from lexmill.operators import search as S
from lexmill.plans import court_queries as Q
from lexmill.plans import practice_queries as P
from lexmill.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Forms of judgment of the test register, as a parameter: 2 and 3 decide on the merits.
FORMS = {"1": "Ухвала", "2": "Рішення", "3": "Постанова", "4": "Судовий наказ"}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Active documents with the names of their form and court, cause clean. The dimensions are small tables; broadcasting is left to the optimizer."""
    d = table(spark, sf, "court_docs").filter(F.col("status") == "1")
    forms = F.create_map(*[F.lit(x) for p in FORMS.items() for x in p])
    courts = table(spark, sf, "courts").groupBy("court_code").agg(F.max("name").alias("court"))
    return d.join(courts, "court_code", "left").select(clean_case_number(F.col("cause_num")).alias("cause"), "doc_id", F.try_element_at(forms, "judgment_code").alias("type"), F.col("adjudication_date").alias("date"), "court", F.col("doc_url").alias("url"), Q.doc_order().alias("o"))


def case_documents(spark: SparkSession, sf: str) -> DataFrame:
    return K.case_documents(documents(spark, sf), F.col("o"), K.is_merits_form(F.coalesce("type", F.lit(""))))


_CASE = Q._CASE
_TYPE = "CASE judgment_code WHEN '1' THEN 'Ухвала' WHEN '2' THEN 'Рішення' WHEN '3' THEN 'Постанова' WHEN '4' THEN 'Судовий наказ' ELSE 'Судовий акт' END"
_C = P._COMPACT
_DOCS = Q._DOCS + f""", cn AS (SELECT court_code, max(name) AS court FROM courts GROUP BY 1), od AS (SELECT o.*, {_TYPE} AS kind, coalesce({_C.format(c='cn.court')}, '') AS court, nullif({_C.format(c='adjudication_date')}, '') AS day, coalesce({_C.format(c='doc_url')}, '') AS url FROM o LEFT JOIN cn USING (court_code)),
  cd AS (SELECT cause, max(doc_id) FILTER (newest_kind = 1 AND judgment_code IN ('2', '3')) AS m_id, max(kind) FILTER (newest_kind = 1 AND judgment_code IN ('2', '3')) AS m_type, max(court) FILTER (newest_kind = 1 AND judgment_code IN ('2', '3')) AS m_court, max(url) FILTER (newest_kind = 1 AND judgment_code IN ('2', '3')) AS m_url, max(day) FILTER (newest_kind = 1 AND judgment_code IN ('2', '3')) AS m_day,
   max(doc_id) FILTER (newest = 1) AS r_id, max(kind) FILTER (newest = 1) AS r_type, max(court) FILTER (newest = 1) AS r_court, max(url) FILTER (newest = 1) AS r_url, max(day) FILTER (newest = 1) AS r_day, max(doc_id) FILTER (oldest = 1) AS e_id FROM od GROUP BY 1)"""


@query(_DOCS + " SELECT cause, m_id, m_type, m_court, m_day, r_id, r_type, r_court, r_day, e_id, coalesce(m_id, r_id) AS primary_id, CASE WHEN m_id IS NOT NULL THEN 'latest_merits' ELSE 'latest_active' END AS primary_kind FROM cd")
def q54_case_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The acts of each case as they are shown, with names, and the one to read first with its kind."""
    d = case_documents(spark, sf)
    f = lambda c, p: [F.col(f"{c}.{x}").alias(f"{p}_{y}") for x, y in (("doc_id", "id"), ("type", "type"), ("court", "court"), ("date", "day"))]
    return d.select("cause", *f("latest_merits", "m"), *f("latest_active", "r"), F.col("earliest_active.doc_id").alias("e_id"), F.col("primary_doc.doc_id").alias("primary_id"), "primary_kind")


@query(Q._DOCS + " SELECT cause, doc_id, row_number() OVER (PARTITION BY cause ORDER BY " + Q._desc(Q._order_sql()) + ", doc_id) AS place FROM d WHERE cause IS NOT NULL AND judgment_code IN ('2', '3')")
def q54_merits_newest_first(spark: SparkSession, sf: str) -> DataFrame:
    """The acts on the merits of each case, the newest first."""
    return K.newest_first(documents(spark, sf), F.col("o"), K.is_merits_form(F.coalesce("type", F.lit("")))).select("cause", "doc_id", "place")


def registry_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Each case of the registry as last seen, with the acts of the register."""
    s = table(spark, sf, "registry_snapshots").select("decision_key", clean_case_number(F.col("case_number")).alias("case_number"), "snapshot_on", "updated_at", F.lower(F.trim(F.translate("status", " ", " "))).alias("status"), "challenger", "status_label", "status_detail")
    last = F.struct("snapshot_on", "updated_at", *[F.coalesce(c, F.lit("")) for c in ("status", "challenger", "status_label", "status_detail")])
    g = s.filter("case_number is not null").groupBy("decision_key", "case_number").agg(F.max_by(F.struct("status", "challenger", "status_label", "status_detail"), last).alias("_l"), F.max("updated_at").alias("updated_at"))
    docs = case_documents(spark, sf).select("cause", "latest_merits", F.col("latest_active").alias("latest_relevant"))
    return g.select("decision_key", "case_number", "_l.*", "updated_at").join(docs, F.col("cause") == F.col("case_number"), "left").drop("cause")


_CASES = _DOCS + f""", sn AS (SELECT decision_key, {_CASE.replace('cause_num', 'case_number')} AS cn, snapshot_on, updated_at, lower(trim(replace(status, chr(160), ' '))) AS st, challenger, status_label, status_detail FROM registry_snapshots),
  ls AS (SELECT *, row_number() OVER (PARTITION BY decision_key, cn ORDER BY snapshot_on DESC, updated_at DESC, coalesce(st, '') DESC, coalesce(challenger, '') DESC, coalesce(status_label, '') DESC, coalesce(status_detail, '') DESC) AS k, max(updated_at) OVER (PARTITION BY decision_key, cn) AS upd FROM sn WHERE cn IS NOT NULL),
  rc AS (SELECT decision_key, cn, coalesce(nullif({_C.format(c='st')}, ''), 'ongoing') AS st, coalesce({_C.format(c='challenger')}, '') AS challenger, coalesce({_C.format(c='status_label')}, '') AS lab, coalesce({_C.format(c='status_detail')}, '') AS det, upd, cd.* FROM ls LEFT JOIN cd ON cd.cause = cn WHERE k = 1),
  rk AS (SELECT *, coalesce(list_position(['ongoing', 'overturned', 'partially_overturned', 'upheld'], st), 5) AS r FROM rc),
  ch AS (SELECT decision_key, min(r) AS r, count(*) AS n, string_agg(concat_ws(' || ', nullif(cn, ''), nullif(challenger, ''), nullif(lab, ''), nullif(det, ''), nullif(m_court, ''), nullif(m_type, ''), nullif(r_court, ''), nullif(r_type, '')), ' || ' ORDER BY upd DESC, cn DESC) AS parts,
     list(cn ORDER BY upd DESC, cn DESC) AS cns FROM rk GROUP BY 1),
  pc AS (SELECT ch.*, rk.cn AS primary_case, rk.m_url, rk.r_url, CASE WHEN ch.r IN (1, 5) THEN 'ongoing' ELSE rk.st END AS display FROM ch JOIN rk USING (decision_key) WHERE rk.r = ch.r QUALIFY row_number() OVER (PARTITION BY decision_key ORDER BY rk.upd DESC, rk.cn DESC) = 1),
  pr AS (SELECT p.*, pc.n, pc.parts, pc.cns, pc.primary_case, pc.display, pc.m_url, pc.r_url, CASE pc.display WHEN 'ongoing' THEN 'Оскарження триває' WHEN 'upheld' THEN 'Рішення АМКУ залишено чинним' WHEN 'overturned' THEN 'Рішення АМКУ скасовано' WHEN 'partially_overturned' THEN 'Рішення АМКУ скасовано частково' END AS dlabel FROM practice p LEFT JOIN pc USING (decision_key))"""
_BLOB = "lower(concat_ws(' || ', " + ", ".join(f"nullif(array_to_string({c}, ' | '), '')" if c in ("liable_parties", "key_takeaways", "evidence_factors", "search_keywords") else f"nullif({c}, '')" for c in ["decision_number", "decision_date", "primary_code", "primary_label", "decision_outcome", "outcome_label", "outcome_summary", "classification.primary_label", "liable_parties", "violation_summary", "amcu_reasoning", "respondent_position", "sanction", "key_takeaways", "evidence_factors", "market_or_sector", "search_keywords", "source_resource", "source_file"]) + ", nullif(dlabel, ''), nullif(primary_case, ''), nullif(parts, '')))"


def challenged_rows(spark: SparkSession, sf: str) -> DataFrame:
    return R.with_challenges(table(spark, sf, "practice"), registry_cases(spark, sf))


@query(_CASES + f""" SELECT rec_id, coalesce(nullif(decision_key, ''), coalesce(decision_date, '') || '|' || coalesce(decision_number, '')) AS decision_key, nullif(year, 0) AS year, coalesce(nullif(primary_code, ''), nullif(classification.primary_code, ''), 'other') AS primary_code, coalesce(nullif(primary_label, ''), nullif(classification.primary_label, ''), 'Без класифікації') AS primary_label,
   coalesce(nullif(classification.law_family, ''), nullif(law_area, ''), 'other') AS law_family, CASE WHEN decision_outcome IN ('proceeding_closed_no_violation', 'permit_granted', 'other') THEN decision_outcome ELSE 'violation_found' END AS decision_outcome, coalesce({_C.format(c='violation_summary')}, '') AS violation_summary, len(coalesce(liable_parties, [])) AS parties, {P._TOTAL} AS sanction_total_uah,
   coalesce(decision_date, '9999-99-99') || '|' || coalesce(decision_number, '') AS sort_key, display AS display_status, dlabel AS display_status_label, primary_case, n AS cases_count, CASE WHEN n IS NOT NULL THEN array_to_string(cns, ',') END AS case_numbers, CASE WHEN n IS NOT NULL THEN coalesce(CASE WHEN display <> 'ongoing' THEN nullif(m_url, '') END, nullif(r_url, ''), '') <> '' END AS has_url, {_BLOB} AS search_blob FROM pr""")
def q55_finished_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Practice with its court challenges as it is published: defaults, totals, status, search text."""
    f = R.finished(challenged_rows(spark, sf))
    c = F.col("challenge")
    return f.select(
        "rec_id", "decision_key", "year", "primary_code", "primary_label", "law_family", "decision_outcome", "violation_summary", F.size("liable_parties").alias("parties"), "sanction_total_uah", "sort_key",
        c["display_status"].alias("display_status"), c["display_status_label"].alias("display_status_label"), c["primary_case_number"].alias("primary_case"), c["cases_count"].cast("bigint").alias("cases_count"),
        F.when(c.isNotNull(), F.array_join(F.transform(c["cases"], lambda x: x["case_number"]), ",")).alias("case_numbers"), F.when(c.isNotNull(), c["display_url"] != "").alias("has_url"), "search_blob",
    )


@query(_CASES + " SELECT count(n) AS challenged, CAST(coalesce(sum(n), 0) AS BIGINT) AS cases FROM pr")
def q55_challenge_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Challenged decisions and their cases."""
    return R.challenge_counts(challenged_rows(spark, sf).select("challenge"))


@query(_CASES + f""" SELECT rec_id, coalesce(nullif(CASE WHEN display <> 'ongoing' THEN coalesce(nullif(m_url, ''), r_url) ELSE r_url END, ''), nullif(m_url, ''), '') <> '' AS shown, 
   len(list_filter(list_transform([decision_number, decision_date, primary_code, primary_label, outcome_label, outcome_summary, violation_summary, amcu_reasoning, respondent_position, sanction, market_or_sector] || coalesce(liable_parties, []) || coalesce(key_takeaways, []) || coalesce(evidence_factors, []) || coalesce(legal_basis, []), lambda x: {P._SEARCH_SQL.format(c='x')}), lambda v: v <> '')) AS fields, {P._SEARCH_SQL.format(c="coalesce(dlabel, '') || ' ' || coalesce(primary_case, '')")} AS court_form FROM pr WHERE n IS NULL
   UNION ALL SELECT rec_id, coalesce(nullif(CASE WHEN display <> 'ongoing' THEN coalesce(nullif(m_url, ''), r_url) ELSE r_url END, ''), nullif(m_url, ''), '') <> '', NULL, {P._SEARCH_SQL.format(c="coalesce(dlabel, '') || ' ' || coalesce(primary_case, '')")} FROM pr WHERE n IS NOT NULL""")
def q56_exact_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The fields that quoted phrases are looked for in (their number where no court field is among them), and the address of a challenge."""
    rows = challenged_rows(spark, sf)
    c = F.col("challenge")
    court = X.search_form(F.concat(F.coalesce(c["display_status_label"], F.lit("")), F.lit(" "), F.coalesce(c["primary_case_number"], F.lit(""))))
    return rows.select("rec_id", F.coalesce(R.challenge_url(c) != "", F.lit(False)).alias("shown"), F.when(c.isNull(), F.size(R.exact_fields(rows))).cast("bigint").alias("fields"), court.alias("court_form"))


_EVENTS = f"""e AS (SELECT decision_key, {_CASE.replace('cause_num', 'case_number')} AS case_number, snapshot_on, updated_at, lower(trim(replace(status, chr(160), ' '))) AS st, coalesce(invalidates_prior_merits, false) AS inv, list_contains(source_years, 2025) AS old FROM registry_snapshots),
  f AS (SELECT *, CASE WHEN st IS NULL THEN 'unverified' WHEN inv THEN 'invalidates' WHEN st IN ('overturned', 'partially_overturned', 'upheld') THEN 'resolves' END AS ev, strftime(snapshot_on, '%Y-%m-%d') || ' ' || updated_at AS doc FROM e WHERE case_number IS NOT NULL),
  p AS (SELECT decision_key, case_number, max(st) FILTER (old AND st IN ('overturned', 'partially_overturned', 'upheld')) AS prior FROM f GROUP BY 1, 2),
  d AS (SELECT decision_key, case_number, arg_max(ev, (doc, ev, coalesce(st, ''))) AS ev, arg_max(doc, (doc, ev, coalesce(st, ''))) AS doc, arg_max(st, (doc, ev, coalesce(st, ''))) AS st FROM f WHERE ev IS NOT NULL GROUP BY 1, 2),
  w AS (SELECT decision_key, case_number, CASE WHEN ev = 'resolves' THEN st WHEN ev = 'invalidates' THEN 'ongoing' ELSE coalesce(prior, 'ongoing') END AS case_status, CASE WHEN ev = 'resolves' THEN 'merits_found' WHEN ev = 'invalidates' THEN 'pending_no_merits' WHEN ev = 'unverified' THEN 'merits_not_verified' WHEN prior IS NOT NULL THEN 'history_prior_merits' ELSE 'pending_no_merits' END AS challenge_status, CASE WHEN ev = 'resolves' THEN doc END AS merits_doc, coalesce(ev = 'invalidates', false) AS invalidates FROM p LEFT JOIN d USING (decision_key, case_number))"""


def walked(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Snapshots read as acts (a null status could not be verified), and the status of each case by the newest decisive one."""
    s = table(spark, sf, "registry_snapshots").select("decision_key", clean_case_number(F.col("case_number")).alias("case_number"), F.lower(F.trim(F.translate("status", " ", " "))).alias("outcome"), F.coalesce("invalidates_prior_merits", F.lit(False)).alias("invalidates"), F.concat_ws(" ", F.date_format("snapshot_on", "yyyy-MM-dd"), "updated_at").alias("doc_id"), F.array_contains("source_years", 2025).alias("old"))
    e = s.filter("case_number is not null").withColumn("verified", F.col("outcome").isNotNull()).withColumn("resolves", F.coalesce(F.col("outcome").isin(*G.FINAL), F.lit(False)))
    keys = ["decision_key", "case_number"]
    prior = e.groupBy(*keys).agg(F.max(F.when(F.col("old") & F.col("resolves"), F.col("outcome"))).alias("prior_status"))
    event = F.when(~F.col("verified"), "unverified").when(F.col("invalidates"), "invalidates").when(F.col("resolves"), "resolves")
    return e, K.status(e, keys, F.struct("doc_id", event.alias("v"), F.coalesce("outcome", F.lit("")).alias("s")), prior)


@query(f"WITH {_EVENTS} SELECT * FROM w")
def q57_status(spark: SparkSession, sf: str) -> DataFrame:
    """The status of each case by its newest decisive act."""
    return walked(spark, sf)[1]


@query(f"""WITH {_EVENTS}, l AS (SELECT decision_key, case_number, max(doc) AS latest_doc, arg_max(CASE WHEN inv THEN 'INVALIDATES_PRIOR' WHEN st = 'ongoing' THEN 'ONGOING' WHEN st IS NOT NULL THEN 'FINAL_UNCHANGED' END, (doc, coalesce(st, ''), inv)) AS a FROM (SELECT * FROM f) GROUP BY 1, 2),
  la AS (SELECT decision_key, case_number, latest_doc, CASE a0 WHEN '' THEN NULL ELSE a0 END AS a FROM (SELECT decision_key, case_number, max(doc) AS latest_doc, arg_max(CASE WHEN inv THEN 'INVALIDATES_PRIOR' WHEN st = 'ongoing' THEN 'ONGOING' WHEN st IS NOT NULL THEN 'FINAL_UNCHANGED' ELSE '' END, (doc, coalesce(st, ''), inv)) AS a0 FROM f GROUP BY 1, 2)),
  j AS (SELECT w.*, latest_doc, a, coalesce(case_status IN ('overturned', 'partially_overturned', 'upheld') AND merits_doc IS NOT NULL AND latest_doc > merits_doc, false) AS eligible FROM w JOIN la USING (decision_key, case_number))
  SELECT decision_key, case_number, eligible, CASE WHEN eligible AND a IN ('INVALIDATES_PRIOR', 'ONGOING') THEN 'ongoing' ELSE case_status END AS case_status, CASE WHEN eligible AND a = 'INVALIDATES_PRIOR' THEN 'pending_no_merits' WHEN eligible AND a = 'ONGOING' THEN 'merits_found_review_ongoing' WHEN eligible AND a IS NULL THEN 'current_status_not_verified' ELSE challenge_status END AS challenge_status,
   CASE WHEN NOT (eligible AND coalesce(a = 'INVALIDATES_PRIOR', false)) THEN merits_doc END AS merits_doc, eligible AND a IS NULL AS blocks_write FROM j""")
def q58_later_act(spark: SparkSession, sf: str) -> DataFrame:
    """Final results after the newest act that came later: undone, under review again, unchanged, or not verified."""
    e, w = walked(spark, sf)
    says = F.when(F.col("invalidates"), "INVALIDATES_PRIOR").when(F.col("outcome") == "ongoing", "ONGOING").when(F.col("outcome").isNotNull(), "FINAL_UNCHANGED")
    last = e.groupBy("decision_key", "case_number").agg(F.max("doc_id").alias("latest_doc"), F.max_by(F.struct(says.alias("a")), F.struct("doc_id", F.coalesce("outcome", F.lit("")), "invalidates")).alias("_a"))
    rows = w.join(last, ["decision_key", "case_number"]).withColumns({"merits_order": F.col("merits_doc"), "latest_order": F.col("latest_doc"), "annotation": F.col("_a.a")})
    return K.later_act(rows).select("decision_key", "case_number", "eligible", "case_status", "challenge_status", "merits_doc", "blocks_write")


_YEARS = f"""y AS (SELECT decision_key, {_CASE.replace('cause_num', 'case_number')} AS case_number, snapshot_on, updated_at, lower(trim(replace(status, chr(160), ' '))) AS st, coalesce(challenger, '') AS challenger, coalesce(status_detail, '') AS det, coalesce(invalidates_prior_merits, false) AS inv, source_years, year(snapshot_on) = 2026 AS incoming FROM registry_snapshots),
  z AS (SELECT *, row_number() OVER (PARTITION BY decision_key, case_number, incoming ORDER BY snapshot_on DESC, updated_at DESC, coalesce(st, '') DESC, challenger DESC, det DESC, inv DESC) AS k FROM y WHERE case_number IS NOT NULL), s AS (SELECT *, strftime(snapshot_on, '%Y-%m-%d') AS day, CASE WHEN st IN ('overturned', 'partially_overturned', 'upheld') THEN strftime(snapshot_on, '%Y-%m-%d') END AS mday FROM z WHERE k = 1),
  m AS (SELECT decision_key, case_number, arg_max(coalesce(st, ''), (day, incoming)) AS st, arg_max(det, (day, incoming)) AS det, arg_max(challenger, (day, incoming)) AS challenger, arg_max(inv, (day, incoming)) AS inv, max(day) AS relevant_on, max(mday) AS merits_on, max(updated_at) AS updated_at FROM s GROUP BY 1, 2),
  ys AS (SELECT decision_key, case_number, array_to_string(list_sort(list(DISTINCT yy)), ',') AS years FROM (SELECT decision_key, case_number, unnest(source_years) AS yy FROM s) GROUP BY 1, 2), fin AS (SELECT m.*, years, CASE WHEN inv THEN 'ongoing' ELSE coalesce(nullif(st, ''), 'ongoing') END AS status FROM m LEFT JOIN ys USING (decision_key, case_number))"""


def merged(spark: SparkSession, sf: str) -> DataFrame:
    """The registry of 2026 merged into that of the year before; a snapshot stands for its newest act."""
    s = table(spark, sf, "registry_snapshots").select("decision_key", clean_case_number(F.col("case_number")).alias("case_number"), "snapshot_on", "updated_at", F.lower(F.trim(F.translate("status", " ", " "))).alias("status"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("challenger", "status_detail")], F.coalesce("invalidates_prior_merits", F.lit(False)).alias("invalidates"), "source_years").filter("case_number is not null")
    day = F.date_format("snapshot_on", "yyyy-MM-dd")
    act = R.court_document(day, F.lit(None).cast("string"), day, F.lit(None).cast("string"), F.lit(None).cast("string"))
    s = s.withColumn("latest_relevant", act).withColumn("latest_merits", F.when(F.col("status").isin(*G.FINAL), act))

    def last(rows: DataFrame) -> DataFrame:
        order = F.struct("snapshot_on", "updated_at", F.coalesce("status", F.lit("")), "challenger", "status_detail", "invalidates")
        rest = ["status", "status_detail", "challenger", "invalidates", "source_years", "latest_relevant", "latest_merits", "updated_at"]
        return rows.groupBy("decision_key", "case_number").agg(F.max_by(F.struct(*rest), order).alias("_l")).select("decision_key", "case_number", "_l.*")

    new = F.year("snapshot_on") == 2026
    return K.merge_cases(last(s.filter(~new)), last(s.filter(new)), ["decision_key", "case_number"])


@query(f"""WITH {_YEARS} SELECT decision_key, case_number, status, CASE WHEN status = 'ongoing' AND contains(lower(det), 'направ') AND contains(lower(det), 'нов') AND contains(lower(det), 'розгляд') THEN 'Справу направлено на новий розгляд' ELSE CASE status WHEN 'ongoing' THEN 'Оскарження триває' WHEN 'upheld' THEN 'Рішення АМКУ залишено чинним' WHEN 'overturned' THEN 'Рішення АМКУ скасовано' WHEN 'partially_overturned' THEN 'Рішення АМКУ скасовано частково' ELSE status END END AS status_label,
   challenger, inv AS invalidates, relevant_on, CASE WHEN NOT inv THEN merits_on END AS merits_on, years, updated_at FROM fin""")
def q59_merged_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Two yearly registries of cases merged: the fresher row, the newest acts of both, years, labels."""
    return merged(spark, sf).select("decision_key", "case_number", "status", "status_label", "challenger", "invalidates", F.col("latest_relevant.date").alias("relevant_on"), F.col("latest_merits.date").alias("merits_on"), F.array_join("source_years", ",").alias("years"), "updated_at")


@query(f"WITH {_YEARS} SELECT count(*) FILTER (status = 'ongoing') AS ongoing, count(*) FILTER (status = 'upheld') AS upheld, count(*) FILTER (status = 'overturned') AS overturned, count(*) FILTER (status = 'partially_overturned') AS partially_overturned, count(*) AS cases FROM fin")
def q59_outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many cases have each status."""
    return K.outcome_counts(merged(spark, sf))


_SUED = "(?:за\\s+(?:первісн[а-яіїєґ]*\\s+)?позов[а-яіїєґ]*|за\\s+позовн[а-яіїєґ]*\\s+заяв[а-яіїєґ]*).{0,280}?(?:амку|антимонопольн[а-яіїєґ]*\\s+комітет[а-яіїєґ]*|територіальн[а-яіїєґ]*\\s+відділен[а-яіїєґ]*).{0,140}?\\sдо\\s"


@query(Q._CONTAINED + f""", {_DOCS.removeprefix('WITH ')}, x AS (SELECT doc_id FROM t WHERE regexp_matches(substr(form, 1, 12000), '{_SUED}')),
   a AS (SELECT cause, r_id, e_id, coalesce(m_id, r_id) AS p_id, CASE WHEN m_id IS NOT NULL THEN 'latest_merits' ELSE 'latest_active' END AS kind FROM cd), f1 AS (SELECT cause, doc_id, number, kind AS source FROM a JOIN hit ON hit.doc_id = p_id), f2 AS (SELECT cause, doc_id, number, 'earliest_fallback' AS source FROM a JOIN hit ON hit.doc_id = e_id WHERE e_id <> p_id AND cause NOT IN (SELECT cause FROM f1))
   SELECT cause, doc_id, number, source FROM f1 WHERE doc_id NOT IN (SELECT doc_id FROM x) UNION ALL SELECT * FROM f2""")
def q60_discovery(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates of each case: by the first document to read, else the earliest; texts in which the authority sues drop their own only."""
    c = case_documents(spark, sf).select("cause", F.col("primary_doc.doc_id").alias("primary_doc"), "primary_kind", F.col("earliest_active.doc_id").alias("earliest"))
    forms = table(spark, sf, "court_texts").filter("text is not null").select("doc_id", Q._form(F.col("text")).alias("form"))
    sued = forms.filter(F.substring("form", 1, 12000).rlike(_SUED)).select("doc_id")
    return K.discovered(c, Q.held_numbers(spark, sf), sued)


_PADDED = "' ' || form || ' '"


@query(Q._CONTAINED + f""", ps AS (SELECT rec_id, {Q._IDENT_SQL.format(c=P._fold_sql('decision_number'))} AS number, CASE WHEN regexp_matches(decision_date, '^\\d{{4}}-\\d\\d-\\d\\d$') THEN try_cast(decision_date AS DATE) END AS day, party_norms FROM practice WHERE decision_number IS NOT NULL),
   c AS (SELECT hit.doc_id, ps.rec_id, ps.day, {_PADDED} AS pad, form, list_filter(coalesce(party_norms, []), lambda p: p <> '' AND NOT regexp_matches(p, '^(?:особа *\\d+|інформація.*|назва.*)$')) AS named FROM hit JOIN ps USING (number) JOIN t ON t.doc_id = hit.doc_id),
   s AS (SELECT doc_id, rec_id, coalesce(contains(pad, ' ' || strftime(day, '%d %m %Y') || ' ') OR contains(pad, ' ' || day(day) || ' ' || month(day) || ' ' || year(day) || ' ') OR contains(pad, ' ' || strftime(day, '%Y-%m-%d') || ' ') OR contains(pad, ' ' || day(day) || ' ' || ['січня', 'лютого', 'березня', 'квітня', 'травня', 'червня', 'липня', 'серпня', 'вересня', 'жовтня', 'листопада', 'грудня'][month(day)] || ' ' || year(day) || ' '), false) AS date_hit,
     len(list_filter(named, lambda p: (length(p) >= 8 AND contains(form, p)) OR (len(list_filter(string_split(p, ' '), lambda w: length(w) >= 4 AND NOT list_contains(['товариство', 'обмеженою', 'відповідальністю', 'приватне', 'акціонерне', 'публічне', 'підприємство', 'компанія', 'фірма', 'державне', 'комунальне', 'приватний', 'акціонерний', 'тов', 'пат', 'прат', 'ат', 'пп', 'дп'], w) AND NOT regexp_matches(w, '^\\d+$'))) > 0
       AND len(list_filter(list_filter(string_split(p, ' '), lambda w: length(w) >= 4 AND NOT list_contains(['товариство', 'обмеженою', 'відповідальністю', 'приватне', 'акціонерне', 'публічне', 'підприємство', 'компанія', 'фірма', 'державне', 'комунальне', 'приватний', 'акціонерний', 'тов', 'пат', 'прат', 'ат', 'пп', 'дп'], w) AND NOT regexp_matches(w, '^\\d+$'))[1:4], lambda w: NOT contains(form, w))) = 0))) > 0 AS party_hit FROM c)
   SELECT doc_id, rec_id, date_hit, party_hit, CASE WHEN party_hit THEN 'number+party' ELSE 'number_only' END AS strength, NOT date_hit AND NOT party_hit AS weak_yes FROM s""")
def q60_signals(spark: SparkSession, sf: str) -> DataFrame:
    """What supports a candidate besides its number: the day and a party in the text; with neither a yes is weak."""
    p = table(spark, sf, "practice").filter("decision_number is not null").select("rec_id", X.identifier_form(fold_digits(F.col("decision_number"))).alias("number"), F.when(F.col("decision_date").rlike(r"^\d{4}-\d\d-\d\d$"), F.try_to_date("decision_date", "yyyy-MM-dd")).alias("day"), F.coalesce("party_norms", F.array().cast("array<string>")).alias("norms"))
    forms = table(spark, sf, "court_texts").filter("text is not null").select("doc_id", Q._form(F.col("text")).alias("form"))
    # merged, as in containment: by the size of their file the forms would be broadcast
    c = Q.held_numbers(spark, sf).join(p, "number").join(forms.hint("merge"), "doc_id")
    c = c.select("doc_id", "rec_id", V.holds_date(F.col("form"), F.col("day")).alias("date_hit"), V.party_needle(F.col("form"), F.col("norms")).isNotNull().alias("party_hit"))
    return c.withColumn("strength", K.strength(F.col("party_hit"))).withColumn("weak_yes", K.weak(F.lit("YES"), F.col("date_hit"), F.col("party_hit")))


@query(f"""WITH k AS (SELECT DISTINCT {_CASE.replace('cause_num', 'case_number')} AS cause FROM registry_snapshots), c AS (SELECT category_code FROM cause_categories WHERE regexp_matches(lower(name), '{Q._ALT}'))
   SELECT doc_id, {_CASE} AS cause, category_code IN (SELECT category_code FROM c) AS in_category FROM court_docs WHERE status = '1' AND {_CASE} IN (SELECT cause FROM k WHERE cause IS NOT NULL)""")
def q61_known_case_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of known cases in all categories, in the same scan as the search by category."""
    known = table(spark, sf, "registry_snapshots").select(clean_case_number(F.col("case_number")).alias("cause")).filter("cause is not null").distinct()
    d = table(spark, sf, "court_docs").filter(F.col("status") == "1").select("doc_id", "category_code", clean_case_number(F.col("cause_num")).alias("cause")).join(known, "cause", "left_semi")
    return d.join(Q.relevant(spark, sf).withColumn("hit", F.lit(True)), "category_code", "left").select("doc_id", "cause", F.coalesce("hit", F.when(F.col("category_code").isNotNull(), F.lit(False))).alias("in_category"))


@query(f"""WITH {_YEARS} SELECT decision_key, case_number, 'known_case_history' AS strength, 'YES' AS classification, 'registry_confirmed' AS confidence, 'known_case_registry' AS cache_source, trim(challenger) AS challenger, CASE WHEN status IN ('ongoing', 'upheld', 'overturned', 'partially_overturned') THEN status ELSE 'ongoing' END AS case_outcome, false AS resolves, false AS invalidates FROM fin""")
def q61_history_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Work rows for known cases, with what the registry carries."""
    return K.known_case_rows(merged(spark, sf))


@query(f"""WITH {_YEARS}, sd AS (SELECT DISTINCT decision_key, {_CASE.replace('cause_num', 'case_number')} AS case_number FROM registry_snapshots WHERE year(snapshot_on) = 2025 AND source_years[1] = 2025)
   SELECT f.decision_key, f.case_number, CASE WHEN sd.case_number IS NOT NULL THEN 'YES' END AS classification, CASE WHEN sd.case_number IS NOT NULL THEN 'ongoing' END AS case_outcome, sd.case_number IS NOT NULL AS seeded FROM fin f LEFT JOIN sd ON sd.decision_key = f.decision_key AND sd.case_number = f.case_number""")
def q62_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates with approved answers of the same year only (here: what the registry of 2025 held)."""
    seeds = table(spark, sf, "registry_snapshots").select("decision_key", clean_case_number(F.col("case_number")).alias("case_number"), F.year("snapshot_on").alias("year"), F.get("source_years", F.lit(0)).alias("dataset_year"))
    c = merged(spark, sf).select("decision_key", "case_number")
    return K.seeded(c, seeds, ["decision_key", "case_number"], {"year": 2025, "dataset_year": 2025}).select("decision_key", "case_number", "classification", "case_outcome", "seeded")
