"""Queries over rows made from annotations, case starts, sorts and state; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.functions.registry_text import clean_case_number
from lexmill.operators import best
from lexmill.operators import decisions as V
from lexmill.operators import resources as R
from lexmill.operators import rows as W
from lexmill.operators import search as S
from lexmill.operators import timeline as L
from lexmill.plans import court_queries as Q
from lexmill.plans import practice_queries as P
from lexmill.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_DAY_OF = "coalesce(nullif(regexp_extract(decision_date, '(20\\d{2}-\\d{2}-\\d{2})', 1), ''), CASE WHEN regexp_matches(decision_date, '\\d{1,2}[.\\-/]\\d{1,2}[.\\-/]20\\d{2}') THEN regexp_extract(decision_date, '(\\d{1,2})[.\\-/](\\d{1,2})[.\\-/](20\\d{2})', 3) || '-' || lpad(regexp_extract(decision_date, '(\\d{1,2})[.\\-/](\\d{1,2})[.\\-/](20\\d{2})', 2), 2, '0') || '-' || lpad(regexp_extract(decision_date, '(\\d{1,2})[.\\-/](\\d{1,2})[.\\-/](20\\d{2})', 1), 2, '0') END)"


@query(f"""WITH a AS (SELECT *, {_DAY_OF} AS d, nullif(decision_number, '') AS n, CASE WHEN decision_outcome IN ('proceeding_closed_no_violation', 'permit_granted', 'other') THEN decision_outcome ELSE 'violation_found' END AS o FROM practice_batches)
  SELECT rec_id, coalesce(d, 'unknown-date') || '|' || coalesce(n, file_sha256) AS decision_key, n AS decision_number, d AS decision_date, CAST(substr(d, 1, 4) AS INT) AS year, CAST(substr(d, 6, 2) AS INT) AS month, o AS decision_outcome,
   coalesce(nullif(outcome_label, ''), CASE o WHEN 'proceeding_closed_no_violation' THEN 'Провадження закрито / порушення не доведено' WHEN 'permit_granted' THEN 'Дозвіл надано' WHEN 'other' THEN 'Інший результат' ELSE 'Порушення встановлено' END) AS outcome_label,
   len(list_filter(coalesce(liable_parties, []), lambda x: x <> '')) AS parties, len(list_distinct(list_filter(list_transform(coalesce(search_keywords, []), lambda x: trim(x)), lambda x: x <> ''))) AS keywords, coalesce(d || '|' || n, 'unknown-date|' || n, 'file-hash|' || file_sha256) AS state_key, coalesce(d, '9999-99-99') || '|' || coalesce(n, '') AS sort_key FROM a""")
def q63_analysed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Practice rows made from arriving annotations: keys, calendar, outcome, lists."""
    a = table(spark, sf, "practice_batches")
    none_i, none_s = F.array().cast("array<int>"), F.array().cast("array<string>")
    c = V.classification(F.lit(None).cast("string"), F.col("primary_code"), F.col("law_area"), none_i, none_s, W.listed("legal_basis"))
    null = F.lit(None).cast("string")
    rows = W.analysed(a, null, null, c, V.outcome_code(F.col("decision_outcome")), F.col("file_sha256"))
    return rows.select("rec_id", "decision_key", "decision_number", "decision_date", "year", "month", "decision_outcome", "outcome_label", F.size("liable_parties").cast("bigint").alias("parties"), F.size("search_keywords").cast("bigint").alias("keywords"), "state_key", "sort_key")


def _placed(df: DataFrame, order: list, n: int, name: str, key: str) -> DataFrame:
    """The first ``n`` rows in an order with their places (a top list)."""
    top = S.page(df, order, n)
    return top.select(F.lit(name).alias("sort_name"), F.row_number().over(Window.orderBy(*order)).alias("place"), F.col(key).cast("string").alias("id"))


_NEWEST = Q._desc(Q._order_sql())


@query(Q._DOCS + f""", n AS (SELECT cause, max(CASE WHEN category_code IN (SELECT category_code FROM cause_categories WHERE regexp_matches(lower(name), 'оскаржен[а-яіїєґ]* рішен[а-яіїєґ]* антимонопольн')) THEN 1 ELSE 0 END) AS main FROM d WHERE cause IS NOT NULL GROUP BY 1), c AS (SELECT n.cause, main, row_number() OVER (ORDER BY main DESC, {_NEWEST}, n.cause) AS k FROM n JOIN o ON o.cause = n.cause AND newest = 1)
   SELECT 'cases' AS sort_name, CAST(k AS INT) AS place, cause AS id FROM c WHERE k <= 50
   UNION ALL SELECT 'rows', CAST(k AS INT), CAST(rec_id AS VARCHAR) FROM (SELECT rec_id, row_number() OVER (ORDER BY trim(coalesce(decision_date, '')) DESC, trim(coalesce(decision_number, '')) DESC, rec_id) AS k FROM practice) WHERE k <= 50
   UNION ALL SELECT 'categories', CAST(k AS INT), category_code FROM (SELECT category_code, row_number() OVER (ORDER BY count(DISTINCT {Q._CASE}) DESC, count(*) FILTER (justice_kind = '2') DESC, category_code) AS k FROM court_docs WHERE status = '1' AND category_code IS NOT NULL GROUP BY 1) WHERE k <= 50
   UNION ALL SELECT 'justice', CAST(k AS INT), justice_kind FROM (SELECT justice_kind, row_number() OVER (ORDER BY count(*) DESC, justice_kind) AS k FROM court_docs WHERE status = '1' AND justice_kind IS NOT NULL GROUP BY 1) WHERE k <= 50
   UNION ALL SELECT 'feed', CAST(k AS INT), CAST(event_id AS VARCHAR) FROM (SELECT event_id, row_number() OVER (ORDER BY strftime(ts, '%Y-%m-%dT%H:%M:%S') DESC, event_id) AS k FROM events) WHERE k <= 50""")
def q64_top_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The first 50 of the result lists: cases by category and newest act, rows, categories, kinds of justice, feed items (top lists)."""
    docs = table(spark, sf, "court_docs").filter(F.col("status") == "1")
    main = table(spark, sf, "cause_categories").filter(F.lower("name").rlike("оскаржен[а-яіїєґ]* рішен[а-яіїєґ]* антимонопольн")).select("category_code", F.lit(1).alias("main"))
    cause = clean_case_number(F.col("cause_num"))
    cases = docs.join(main, "category_code", "left").select(cause.alias("cause"), F.coalesce("main", F.lit(0)).alias("main"), Q.doc_order().alias("o")).filter("cause is not null").groupBy("cause").agg(F.max("main").alias("main"), F.max("o").alias("o"))
    rows = table(spark, sf, "practice").select("rec_id", *[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in ("decision_date", "decision_number")])
    cats = docs.filter("category_code is not null").groupBy("category_code").agg(F.countDistinct(cause).alias("cases"), F.count_if(F.col("justice_kind") == "2").alias("commercial"))
    kinds = docs.filter("justice_kind is not null").groupBy("justice_kind").agg(F.count("*").alias("n"))
    feed = table(spark, sf, "events").select("event_id", F.collate(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "uk").alias("at"))
    d = lambda *cs: [F.col(c).desc() for c in cs]
    out = _placed(cases, [*d("main", "o"), F.col("cause")], 50, "cases", "cause")
    for part in (
        _placed(rows, [*d("decision_date", "decision_number"), F.col("rec_id")], 50, "rows", "rec_id"),
        _placed(cats, [*d("cases", "commercial"), F.col("category_code")], 50, "categories", "category_code"),
        _placed(kinds, [*d("n"), F.col("justice_kind")], 50, "justice", "justice_kind"),
        _placed(feed, [*d("at"), F.col("event_id")], 50, "feed", "event_id"),
    ):
        out = out.unionByName(part)
    return out


@query(f"""WITH {P._PLAN_SQL} SELECT id, period, CAST(row_number() OVER (ORDER BY period DESC NULLS LAST, updated DESC NULLS LAST, id) AS INT) AS place, period IS NOT NULL AND period BETWEEN '2023-02' AND '2024-09' AS in_range FROM plan""")
def q66_resource_order(spark: SparkSession, sf: str) -> DataFrame:
    """Archives by period, newest first (a fixed catalogue of archives), and those within two months."""
    p = R.planned(table(spark, sf, "resources"))
    w = Window.orderBy(F.col("period").desc_nulls_last(), F.col("updated").desc_nulls_last(), "id")
    return p.select("id", "period", F.row_number().over(w).alias("place"), R.in_months(F.col("month_number"), "2023-02", "2024-09").alias("in_range"))


@query("""WITH w AS (SELECT id, row_number() OVER (ORDER BY name, id) - 1 AS place FROM resources WHERE lower(format) LIKE '%zip%' UNION ALL SELECT 'no-such-id', 1000000) SELECT w.id, CASE WHEN r.id IS NULL THEN 'missing' WHEN NOT (lower(coalesce(r.format, '')) LIKE '%zip%' OR lower(coalesce(r.url, '')) LIKE '%.zip') THEN 'not_zip' END AS problem FROM w LEFT JOIN resources r USING (id)""")
def q66_chosen_resources(spark: SparkSession, sf: str) -> DataFrame:
    """A list of archives to take again, in its order, with what is wrong with an entry."""
    r = table(spark, sf, "resources")
    ids = [x.id for x in r.filter(F.lower("format").contains("zip")).orderBy("name", "id").select("id").collect()]  # a fixed catalogue
    return R.chosen(r, [*ids, "no-such-id"]).select("id", "problem")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """Announcements written out from practice: a title with case numbers, a body that names norms, and an annotation for some."""
    p = table(spark, sf, "practice")
    number = F.regexp_replace(F.coalesce("decision_number", F.lit("")), r"\D", "")
    case = F.concat(F.lit("справи № 1"), F.lpad(number, 2, "0"), F.lit("–26.13/"), F.greatest(F.length(number), F.lit(1)), F.lit("-24"))
    norm = F.when(F.col("law_area") == "unfair_competition", F.concat(F.lit("стаття "), F.replace(F.coalesce(F.get("legal_basis", F.lit(0)), F.lit("")), F.lit("пункт "), F.lit("")), F.lit(" Закону України «Про захист від недобросовісної конкуренції»"))).otherwise(F.concat(F.get("legal_basis", F.lit(0)), F.lit(" статті 50 Закону України «Про захист економічної конкуренції»")))
    title = F.concat(F.lit("Розпочато розгляд "), case)
    body = F.concat_ws("\n", title, norm, "violation_summary", "market_or_sector")
    return p.select("rec_id", F.concat(F.lit("https://feed.example.invalid/"), "rec_id", F.lit("//")).alias("url"), title.alias("title"), F.lit("").alias("page_title"), F.col("decision_date").alias("date_from"), body.alias("text"),
        F.array().cast("array<string>").alias("case_numbers"), F.when(F.col("confidence") == "high", F.col("market_or_sector")).alias("sector"), F.lit(None).cast("string").alias("law"), F.lit("").alias("short_description"))


_PAGES = """pg AS (SELECT rec_id, decision_date, confidence, market_or_sector, 'Розпочато розгляд справи № 1' || lpad(num, 2, '0') || '–26.13/' || CAST(greatest(length(num), 1) AS VARCHAR) || '-24' AS title, num, law_area,
   concat_ws(chr(10), 'Розпочато розгляд справи № 1' || lpad(num, 2, '0') || '–26.13/' || CAST(greatest(length(num), 1) AS VARCHAR) || '-24', CASE WHEN law_area = 'unfair_competition' THEN 'стаття ' || replace(coalesce(legal_basis[1], ''), 'пункт ', '') || ' Закону України «Про захист від недобросовісної конкуренції»' ELSE legal_basis[1] || ' статті 50 Закону України «Про захист економічної конкуренції»' END, violation_summary, market_or_sector) AS text, legal_basis
   FROM (SELECT *, regexp_replace(coalesce(decision_number, ''), '[^0-9]', '', 'g') AS num FROM practice))"""


@query(f"""WITH {_PAGES} SELECT 'https://feed.example.invalid/' || rec_id AS case_start_key, nullif(substr(decision_date, 1, 10), '') AS publication_date, title, coalesce(nullif(CASE WHEN confidence = 'high' THEN market_or_sector END, ''), 'other') AS sector, '1' || lpad(num, 2, '0') || '-26.13/' || CAST(greatest(length(num), 1) AS VARCHAR) || '-24' AS case_numbers,
   CASE WHEN regexp_matches(text, 'пункт \\d{{1,2}} статті 50 Закону') THEN 'Закон України «Про захист економічної конкуренції»' WHEN regexp_matches(text, 'стаття (15-1|\\d{{1,2}}) Закону') THEN 'Закон України «Про захист від недобросовісної конкуренції»' END AS law,
   CASE WHEN regexp_matches(text, 'пункт \\d{{1,2}} статті 50 Закону') THEN 'п. ' || regexp_extract(text, 'пункт (\\d{{1,2}}) статті 50', 1) || ' ст. 50 Закону України «Про захист економічної конкуренції»' WHEN regexp_matches(text, 'стаття (15-1|\\d{{1,2}}) Закону') THEN 'ст. ' || regexp_extract(text, 'стаття (15-1|\\d{{1,2}}) Закону', 1) || ' Закону України «Про захист від недобросовісної конкуренції»' ELSE 'Не зазначено в повідомленні' END AS qualification,
   regexp_matches(lower(text), 'фармац|лікарськ|препарат|аптек|медичн|медвироб|дієтичн|добавк|фарма[a-z0-9_]|[a-z0-9_]бад[a-z0-9_]|вироб[аи]\\s+медичного\\s+призначення|активн[іи]\\s+фармацевтичн[іи]\\s+інгредієнт') AS signal, sha256(text) AS page_text_sha256 FROM pg""")
def q65_case_starts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of announced cases: numbers, norm, sector signal, keys."""
    p = pages(spark, sf)
    rows = W.case_start(p, ["розпочато розгляд"]).join(p.select(F.sha2("text", 256).alias("page_text_sha256"), "text").distinct(), "page_text_sha256")
    return rows.select("case_start_key", "publication_date", "title", "sector", F.array_join("case_numbers", ",").alias("case_numbers"), "law", "qualification", L.sector_signal(F.col("text")).alias("signal"), "page_text_sha256")


@query(f"""WITH {_PAGES} SELECT count(*) AS items, count(*) FILTER (regexp_matches(lower(text), 'фармац|лікарськ|препарат|аптек|медичн|медвироб|дієтичн|добавк')) AS candidates, count(*) FILTER (confidence = 'high' AND market_or_sector IS NOT NULL) AS relevant FROM pg""")
def q65_run_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of a run over announcements."""
    p = pages(spark, sf)
    return p.agg(F.count("*").alias("items"), F.count_if(L.sector_signal(F.col("text"))).alias("candidates"), F.count_if(F.col("sector").isNotNull()).alias("relevant"))


@query("""WITH b AS (SELECT *, coalesce(decision_date || '|' || decision_number, 'unknown-date|' || decision_number, 'file-hash|' || file_sha256) AS k, CASE WHEN decision_outcome IS NOT DISTINCT FROM 'proceeding_closed_no_violation' THEN 'skipped' WHEN confidence = 'low' THEN 'skipped_by_gemini' ELSE 'analyzed' END AS st FROM practice_batches),
   a AS (SELECT k, arg_max(st, rec_id) AS status, arg_max(file_sha256, rec_id) AS file_sha256, max(rec_id) AS rec_id FROM b GROUP BY 1) SELECT k AS decision_key, status, file_sha256, NOT EXISTS (SELECT 1 FROM practice p WHERE p.file_sha256 = a.file_sha256) AS new_file FROM a""")
def q67_decision_state(spark: SparkSession, sf: str) -> DataFrame:
    """State of each arriving decision after its last document: analysed, skipped by rule, skipped by annotation; unchanged files are known."""
    b = table(spark, sf, "practice_batches")
    status = F.when(~may_be_contested(), "skipped").when(F.col("confidence") == "low", "skipped_by_gemini").otherwise("analyzed")
    rows = b.select(X.decision_key(F.col("decision_date"), F.col("decision_number"), F.col("file_sha256")).alias("decision_key"), status.alias("status"), "file_sha256", "rec_id")
    state = best.upsert(rows.limit(0), rows, ["decision_key"], "rec_id").drop("rec_id")
    known = table(spark, sf, "practice").select("file_sha256", F.lit(True).alias("_k")).distinct()
    return state.join(known, "file_sha256", "left").select("decision_key", "status", "file_sha256", F.col("_k").isNull().alias("new_file"))


def may_be_contested():
    """Decisions that may be contested: all but those closed without a violation; a null passes."""
    return ~F.trim("decision_outcome").eqNullSafe("proceeding_closed_no_violation")


@query("""SELECT CAST(sum(checked) AS BIGINT) AS resources_checked, CAST(sum(seen) AS BIGINT) AS docs_seen, CAST(sum(relevant) AS BIGINT) AS docs_relevant, CAST(sum(seen) - sum(relevant) AS BIGINT) AS docs_skipped, CAST(sum(errors) AS BIGINT) AS errors FROM (
   SELECT 1 AS checked, count(*) AS seen, count(*) FILTER (decision_outcome IS DISTINCT FROM 'proceeding_closed_no_violation') AS relevant, count(*) FILTER (decision_number IS NULL) AS errors FROM practice GROUP BY source_resource_id)""")
def q67_run_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of all archives added up."""
    one = table(spark, sf, "practice").groupBy("source_resource_id").agg(F.lit(1).alias("checked"), F.count("*").alias("seen"), F.count_if(may_be_contested()).alias("relevant"), F.count_if(F.col("decision_number").isNull()).alias("errors"))
    return one.agg(F.sum("checked").alias("resources_checked"), F.sum("seen").alias("docs_seen"), F.sum("relevant").alias("docs_relevant"), (F.sum("seen") - F.sum("relevant")).alias("docs_skipped"), F.sum("errors").alias("errors"))


@query("""WITH r AS (SELECT decision_key, sort_key, rec_id FROM practice WHERE classification.law_family = 'unfair_competition'), s AS (SELECT arg_max(decision_key, (coalesce(sort_key, ''), rec_id)) AS first FROM r), w AS (SELECT DISTINCT decision_key AS selected FROM registry_snapshots)
   SELECT w.selected, CASE WHEN w.selected IN (SELECT decision_key FROM r WHERE decision_key IS NOT NULL) THEN w.selected ELSE s.first END AS shown FROM w, s""")
def q68_selection(spark: SparkSession, sf: str) -> DataFrame:
    """A selected row stays selected if the list still has it, else the first of the list is."""
    r = table(spark, sf, "practice").filter(F.col("classification.law_family") == "unfair_competition")
    first = r.agg(F.max_by("decision_key", F.struct(F.coalesce("sort_key", F.lit("")), "rec_id"))).first()[0]
    w = table(spark, sf, "registry_snapshots").select(F.col("decision_key").alias("selected")).distinct()
    have = r.select(F.col("decision_key").alias("selected"), F.lit(True).alias("_h")).distinct()
    return w.join(have, "selected", "left").select("selected", F.when(F.col("_h"), F.col("selected")).otherwise(F.lit(first)).alias("shown"))
