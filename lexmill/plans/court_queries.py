"""Queries over the court register: scans, funnels, picks, containment, fallbacks, status; each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import decoders as D
from lexmill.functions import text as X
from lexmill.functions.chars import fold_digits
from lexmill.functions.registry_text import clean_case_number
from lexmill.operators import best, containment as C, court_documents as V, registry as G
from lexmill.plans.practice_queries import _fold_sql
from lexmill.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Codes of judgments on the merits and of commercial justice in the test register; parameters of the operators.
MERITS, COMMERCIAL = ("2", "3"), ("2",)
RELEVANT = ["антимонопольн", "конкуренц", "монопольн"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_ALT = "|".join(RELEVANT)
_CATEGORY = f"SELECT category_code FROM cause_categories WHERE regexp_matches(lower(name), '{_ALT}')"


def relevant(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of the categories whose names match (a fixed dimension); the rule runs on names, never on code prefixes."""
    return table(spark, sf, "cause_categories").filter(F.lower("name").rlike(_ALT)).select("category_code")


@query(f"SELECT doc_id, cause_num, status FROM court_docs WHERE status = '1' AND justice_kind = '2' AND category_code IN ({_CATEGORY})")
def q14_dimension_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    """Active commercial documents of the relevant categories: the rule on the dimension, a semi-join on the facts."""
    docs = table(spark, sf, "court_docs").filter((F.col("status") == "1") & F.col("justice_kind").isin(*COMMERCIAL))
    return docs.join(relevant(spark, sf), "category_code", "left_semi").select("doc_id", "cause_num", "status")


_CASE = f"nullif(regexp_extract(regexp_replace(translate({_fold_sql('cause_num')}, '∕⁄', '//'), '[^0-9/]', '', 'g'), '(\\d+/\\d+/\\d+)', 1), '')"


@query(f"""WITH d AS (SELECT status = '1' AS active, category_code IN ({_CATEGORY}) AS related, justice_kind = '2' AS commercial, {_CASE} AS cause FROM court_docs)
  SELECT count(*) AS rows_total, count(*) FILTER (active) AS active, count(*) FILTER (active AND related) AS related, count(*) FILTER (active AND related AND commercial) AS commercial,
  count(*) FILTER (active AND related AND commercial AND cause IS NOT NULL) AS with_case, count(DISTINCT cause) FILTER (active AND related AND commercial) AS cases FROM d""")
def q15_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """Nested counters of the scan in one pass."""
    d = table(spark, sf, "court_docs").join(relevant(spark, sf).withColumn("related", F.lit(True)), "category_code", "left")
    a = F.col("status") == "1"
    r = a & F.coalesce("related", F.lit(False))
    c = r & F.col("justice_kind").isin(*COMMERCIAL)
    d = d.select(a.alias("a"), r.alias("r"), c.alias("c"), clean_case_number(F.col("cause_num")).alias("cause"))
    return d.agg(F.count("*").alias("rows_total"), F.count_if("a").alias("active"), F.count_if("r").alias("related"), F.count_if("c").alias("commercial"), F.count_if(F.col("c") & F.col("cause").isNotNull()).alias("with_case"), F.countDistinct(F.when(F.col("c"), F.col("cause"))).alias("cases"))


@query(f"""SELECT c.category_code, c.name, coalesce(n.active, 0) AS active, coalesce(n.commercial, 0) AS commercial, coalesce(n.cases, 0) AS cases FROM cause_categories c LEFT JOIN (
  SELECT category_code, count(*) AS active, count(*) FILTER (justice_kind = '2') AS commercial, count(DISTINCT CASE WHEN justice_kind = '2' THEN {_CASE} END) AS cases FROM court_docs WHERE status = '1' GROUP BY 1) n USING (category_code)""")
def q16_category_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by category; categories without a document keep a row of zeros."""
    d = table(spark, sf, "court_docs").filter(F.col("status") == "1")
    n = d.groupBy("category_code").agg(F.count("*").alias("active"), F.count_if(F.col("justice_kind") == "2").alias("commercial"), F.countDistinct(F.when(F.col("justice_kind") == "2", clean_case_number(F.col("cause_num")))).alias("cases"))
    return table(spark, sf, "cause_categories").join(n, "category_code", "left").select("category_code", "name", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("active", "commercial", "cases")])


@query("SELECT justice_kind, count(*) AS docs, count(DISTINCT court_code) AS courts FROM court_docs WHERE status = '1' GROUP BY 1")
def q16_justice_kinds(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "court_docs").filter(F.col("status") == "1").groupBy("justice_kind").agg(F.count("*").alias("docs"), F.countDistinct("court_code").alias("courts"))


def _clean_sql(c: str) -> str:
    return f"regexp_replace(replace({c}, chr(65279), ''), '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g')"


def _order_sql() -> str:
    def one(c: str) -> str:
        h = f"substr({_clean_sql(c)}, 1, 10)"
        d = f"coalesce(CASE WHEN regexp_matches({h}, '^\\d{{4}}-\\d\\d-\\d\\d$') THEN try_strptime({h}, '%Y-%m-%d') END, CASE WHEN regexp_matches({h}, '^\\d\\d\\.\\d\\d\\.\\d{{4}}$') THEN try_strptime({h}, '%d.%m.%Y') END)"
        return f"CASE WHEN {d} IS NULL THEN 0 ELSE 1 END, coalesce(strftime({d}, '%Y-%m-%d'), coalesce({_clean_sql(c)}, ''))"

    return f"{one('adjudication_date')}, {one('receipt_date')}, coalesce(try_cast(doc_id AS BIGINT), 0)"


def doc_order() -> Column:
    return F.struct(X.document_order(F.col("adjudication_date"), F.col("receipt_date"), F.col("doc_id")).alias("o"), F.col("status").alias("s"))


def _desc(order: str) -> str:
    return ", ".join(f"{p} DESC" for p in _split_top(order))


def _split_top(s: str) -> list[str]:
    out, depth, now = [], 0, ""
    for ch in s:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(now.strip())
            now = ""
        else:
            now += ch
    return [*out, now.strip()]


_DOCS = f"WITH d AS (SELECT *, {_CASE} AS cause FROM court_docs WHERE status = '1'), o AS (SELECT *, row_number() OVER (PARTITION BY cause ORDER BY {_desc(_order_sql())}) AS newest, row_number() OVER (PARTITION BY cause ORDER BY {_order_sql()}) AS oldest, row_number() OVER (PARTITION BY cause, judgment_code IN ('2', '3') ORDER BY {_desc(_order_sql())}) AS newest_kind FROM d WHERE cause IS NOT NULL)"


@query(_DOCS + """ SELECT cause, max(doc_id) FILTER (newest = 1) AS latest_active, max(doc_id) FILTER (oldest = 1) AS earliest_active, max(doc_id) FILTER (newest_kind = 1 AND judgment_code IN ('2', '3')) AS latest_merits,
   coalesce(max(doc_id) FILTER (newest_kind = 1 AND judgment_code IN ('2', '3')), max(doc_id) FILTER (newest = 1)) AS primary_doc FROM o GROUP BY 1""")
def q17_case_picks(spark: SparkSession, sf: str) -> DataFrame:
    """The newest judgment on the merits, the newest and the oldest document of each case, and the one to read first."""
    return picks(table(spark, sf, "court_docs").filter(F.col("status") == "1"))


def picks(docs: DataFrame) -> DataFrame:
    d = docs.select(clean_case_number(F.col("cause_num")).alias("cause"), "doc_id", F.col("judgment_code").isin(*MERITS).alias("m"), doc_order().alias("o")).filter("cause is not null")
    g = d.groupBy("cause").agg(F.max_by("doc_id", "o").alias("latest_active"), F.min_by("doc_id", "o").alias("earliest_active"), F.max_by(F.when(F.col("m"), F.col("doc_id")), F.when(F.col("m"), F.col("o"))).alias("latest_merits"))
    return g.withColumn("primary_doc", F.coalesce("latest_merits", "latest_active"))


def _form(c: Column) -> Column:
    return X.match_form(fold_digits(c))


_FORM_SQL = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(lower(replace({c}, '№', ' ')), 'ґ', 'г'), '[’''`ʼ«»“”„]', ' ', 'g'), '[‐‑‒–—−]', '-', 'g'), '[^0-9a-zа-яіїєг/-]+', ' ', 'g'), ' +', ' ', 'g'))"
_IDENT_SQL = "regexp_replace(regexp_replace(replace(replace(lower({c}), '№', ''), 'ґ', 'г'), '[‐‑‒–—−]', '-', 'g'), '[^0-9a-zа-яіїєг/-]', '', 'g')"
_CONTAINED = f"""WITH t AS (SELECT doc_id, {_FORM_SQL.format(c=_fold_sql('text'))} AS form FROM court_texts WHERE text IS NOT NULL),
  n AS (SELECT DISTINCT {_IDENT_SQL.format(c=_fold_sql('decision_number'))} AS number FROM practice WHERE decision_number IS NOT NULL),
  hit AS (SELECT doc_id, number FROM t, n WHERE number <> '' AND regexp_matches(form, '(^|[^0-9a-zа-яіїєг/])' || replace(replace(number, '/', '\\s*/\\s*'), '-', '\\s*-?\\s*') || '($|[^0-9a-zа-яіїєг/])'))"""


def held_numbers(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "court_texts").filter("text is not null").select("doc_id", _form(F.col("text")).alias("form"))
    numbers = table(spark, sf, "practice").filter("decision_number is not null").select(X.identifier_form(fold_digits(F.col("decision_number"))).alias("number")).distinct()
    return C.contained(texts, "doc_id", "form", numbers, "number")


@query(_CONTAINED + " SELECT doc_id, number FROM hit")
def q18_containment(spark: SparkSession, sf: str) -> DataFrame:
    """Court texts and the decision numbers that they hold, boundary-safe; the SQL is the nested loop."""
    return held_numbers(spark, sf)


@query(_CONTAINED + f""", p AS ({_DOCS} SELECT cause, coalesce(max(doc_id) FILTER (newest_kind = 1 AND judgment_code IN ('2', '3')), max(doc_id) FILTER (newest = 1)) AS primary_doc, max(doc_id) FILTER (oldest = 1) AS earliest FROM o GROUP BY 1)
  SELECT DISTINCT cause, number, 'primary' AS source FROM p JOIN hit ON hit.doc_id = p.primary_doc UNION ALL
  SELECT DISTINCT cause, number, 'earliest_fallback' FROM p JOIN hit ON hit.doc_id = p.earliest WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.doc_id = p.primary_doc)""")
def q19_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates from the first document to read; only cases without any are looked up in their oldest document."""
    hit = held_numbers(spark, sf)
    p = picks(table(spark, sf, "court_docs").filter(F.col("status") == "1"))
    first = p.join(hit, F.col("primary_doc") == F.col("doc_id")).select("cause", "number", F.lit("primary").alias("source")).distinct()
    second = p.join(hit, F.col("earliest_active") == F.col("doc_id")).select("cause", "number", F.lit("earliest_fallback").alias("source")).distinct()
    return best.with_fallback(first, second, ["cause"])


@query(f"""WITH s AS (SELECT decision_key, {_CASE.replace('cause_num', 'case_number')} AS case_number, snapshot_on FROM registry_snapshots) SELECT DISTINCT decision_key, case_number, snapshot_on::VARCHAR AS snapshot_on FROM s a WHERE snapshot_on = DATE '2026-06-01' AND NOT EXISTS (SELECT 1 FROM s b WHERE b.decision_key = a.decision_key AND b.case_number = a.case_number AND b.snapshot_on = DATE '2025-01-01')""")
def q20_known_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of decision and case that a snapshot has and an earlier one did not: known pairs are removed before anything costly."""
    s = table(spark, sf, "registry_snapshots").select("decision_key", clean_case_number(F.col("case_number")).alias("case_number"), "snapshot_on")
    new, old = s.filter(F.col("snapshot_on") == F.lit("2026-06-01").cast("date")), s.filter(F.col("snapshot_on") == F.lit("2025-01-01").cast("date"))
    return new.join(old.select("decision_key", "case_number"), ["decision_key", "case_number"], "left_anti").select("decision_key", "case_number", F.col("snapshot_on").cast("string").alias("snapshot_on")).distinct()




@query("""SELECT doc_id, regexp_matches(lower(substr(text, 1, 12000)), 'до (?:амку|антимонопольного комітету)') AS authority_sued, regexp_matches(lower(substr(text, 1, 30000)), 'апеляц|касаці') AS higher_court,
  coalesce(regexp_matches(lower(substr(text, 1, 12000)), 'до (?:амку|антимонопольного комітету)') AND NOT regexp_matches(lower(substr(text, 1, 30000)), 'апеляц|касаці'), false) AS dropped FROM court_texts""")
def q21_prefilter(spark: SparkSession, sf: str) -> DataFrame:
    """A negative prefilter: one pattern near the start of a text and none of another in a longer part."""
    t = F.col("text")
    sued = F.lower(F.substring(t, 1, 12000)).rlike("до (?:амку|антимонопольного комітету)")
    higher = F.lower(F.substring(t, 1, 30000)).rlike("апеляц|касаці")
    return table(spark, sf, "court_texts").select("doc_id", sued.alias("authority_sued"), higher.alias("higher_court"), F.coalesce(sued & ~higher, F.lit(False)).alias("dropped"))


@query(f"""WITH t AS (SELECT doc_id, sha256('challenge' || chr(31) || doc_id || chr(31) || sha256(text)) AS cache_key FROM court_texts), k AS (SELECT doc_id FROM court_docs WHERE {_CASE} IN (SELECT {_CASE.replace('cause_num', 'case_number')} FROM registry_snapshots)), c AS (SELECT DISTINCT cache_key FROM t WHERE doc_id IN (SELECT doc_id FROM k))
  SELECT t.doc_id, t.cache_key, c.cache_key IS NOT NULL AS cached FROM t LEFT JOIN c ON t.cache_key = c.cache_key""")
def q22_annotation_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates against a cache by the hash of all that an answer depends on (the cache here holds the texts of the cases in the registry)."""
    key = F.sha2(F.concat_ws("\x1f", F.lit("challenge"), "doc_id", F.sha2("text", 256)), 256)
    t = table(spark, sf, "court_texts").select("doc_id", key.alias("cache_key"))
    known = table(spark, sf, "registry_snapshots").select(clean_case_number(F.col("case_number")).alias("cause"))
    docs = table(spark, sf, "court_docs").select("doc_id", clean_case_number(F.col("cause_num")).alias("cause")).join(known, "cause", "left_semi")
    cache = t.join(docs, "doc_id", "left_semi").select("cache_key", F.lit(True).alias("hit")).distinct()
    return t.join(cache, "cache_key", "left").select("doc_id", "cache_key", F.col("hit").isNotNull().alias("cached"))


_SNAP = f"SELECT decision_key, {_CASE.replace('cause_num', 'case_number')} AS case_number, snapshot_on, updated_at, lower(trim(replace(status, chr(160), ' '))) AS status, challenger, source_years FROM registry_snapshots"


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "registry_snapshots")
    return s.select("decision_key", clean_case_number(F.col("case_number")).alias("case_number"), "snapshot_on", "updated_at", F.lower(F.trim(F.translate("status", " ", " "))).alias("status"), "challenger", "source_years")


@query(f"""WITH s AS ({_SNAP}) SELECT decision_key, case_number, arg_max(status, (snapshot_on, updated_at, status)) FILTER (status IN ('overturned', 'partially_overturned', 'upheld')) AS status,
   CAST(max(snapshot_on) FILTER (status IN ('overturned', 'partially_overturned', 'upheld')) AS VARCHAR) AS decided_on, count(*) AS events FROM s GROUP BY 1, 2""")
def q24_first_decisive(spark: SparkSession, sf: str) -> DataFrame:
    """The newest decisive event of each case, without a walk over its events."""
    s = snapshots(spark, sf).withColumn("decided_on", F.col("snapshot_on").cast("string"))
    return G.first_decisive(s, ["decision_key", "case_number"], F.struct("snapshot_on", "updated_at", "status"), F.col("status").isin(*G.FINAL), ["status", "decided_on"])


@query(f"""WITH s AS ({_SNAP}), g AS (SELECT decision_key, case_number, max(snapshot_on) FILTER (status IN ('overturned', 'partially_overturned', 'upheld')) AS final_on, max(snapshot_on) FILTER (status = 'ongoing') AS open_on FROM s GROUP BY 1, 2)
  SELECT decision_key, case_number, CASE WHEN final_on IS NULL THEN 'pending' WHEN open_on > final_on THEN 'reopened' ELSE 'final' END AS state FROM g""")
def q25_later_act(spark: SparkSession, sf: str) -> DataFrame:
    """A later open state after a final one overrides it."""
    g = snapshots(spark, sf).groupBy("decision_key", "case_number").agg(F.max(F.when(F.col("status").isin(*G.FINAL), F.col("snapshot_on"))).alias("f"), F.max(F.when(F.col("status") == "ongoing", F.col("snapshot_on"))).alias("o"))
    return g.select("decision_key", "case_number", F.when(F.col("f").isNull(), "pending").when(F.col("o") > F.col("f"), "reopened").otherwise("final").alias("state"))


@query(f"""WITH s AS ({_SNAP}), b AS (SELECT *, coalesce(list_contains(source_years, 2026), false) AS incoming FROM s), y AS (SELECT decision_key, case_number, list_sort(list(DISTINCT v)) AS years FROM (SELECT decision_key, case_number, unnest(source_years) AS v FROM s) GROUP BY 1, 2)
  SELECT b.decision_key, b.case_number, arg_max(challenger, (updated_at, incoming, coalesce(challenger, ''))) FILTER (challenger IS NOT NULL) AS challenger, coalesce(array_to_string(any_value(y.years), ','), '') AS years, max(updated_at) AS updated_at FROM b LEFT JOIN y ON y.decision_key IS NOT DISTINCT FROM b.decision_key AND y.case_number IS NOT DISTINCT FROM b.case_number GROUP BY 1, 2""")
def q26_registry_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two years of the registry merged: fields of the fresher side, union of years, latest update."""
    s = snapshots(spark, sf).select("decision_key", "case_number", "challenger", "source_years", "updated_at")
    incoming = F.coalesce(F.array_contains("source_years", 2026), F.lit(False))
    old, new = s.filter(~incoming), s.filter(incoming)
    # rows without a challenger say nothing about it
    fresh = F.when(F.col("challenger").isNotNull(), F.struct("updated_at", incoming.alias("y"), F.coalesce("challenger", F.lit("")).alias("c")))
    m = G.merge(old, new, ["decision_key", "case_number"], F.struct(F.col("challenger").isNotNull().alias("has"), fresh.alias("f")))
    return m.select("decision_key", "case_number", "challenger", F.array_join("source_years", ",").alias("years"), "updated_at")


_LAST = f"""WITH s AS ({_SNAP}), l AS (SELECT decision_key, case_number, arg_max(status, (snapshot_on, updated_at, status)) AS status, max(updated_at) AS updated_at FROM s WHERE status IN ('ongoing', 'overturned', 'partially_overturned', 'upheld') GROUP BY 1, 2)"""


@query(_LAST + """, r AS (SELECT *, list_position(['ongoing', 'overturned', 'partially_overturned', 'upheld'], status) AS r FROM l)
  SELECT decision_key, arg_min(status, r) AS display_status, count(*) AS cases_count, arg_max(case_number, (updated_at, case_number)) FILTER (r = m) AS primary_case FROM (SELECT *, min(r) OVER (PARTITION BY decision_key) AS m FROM r) GROUP BY 1""")
def q27_status_precedence(spark: SparkSession, sf: str) -> DataFrame:
    """The status of a decision by precedence over its cases, with the freshest case that has it."""
    return G.decisions(last_cases(spark, sf), "decision_key", "case_number", "status", F.struct("updated_at", "case_number"))


def last_cases(spark: SparkSession, sf: str) -> DataFrame:
    s = snapshots(spark, sf).filter(F.col("status").isin(*G.PRECEDENCE))
    return s.groupBy("decision_key", "case_number").agg(F.max_by("status", F.struct("snapshot_on", "updated_at", "status")).alias("status"), F.max("updated_at").alias("updated_at"))


@query(_LAST + """ SELECT l.decision_key, l.case_number, coalesce(p.status, l.status) AS status, p.status IS NOT NULL AS overridden FROM l LEFT JOIN (
   SELECT decision_key, 'overturned' AS status FROM practice WHERE decision_key IS NOT NULL GROUP BY decision_key HAVING count(*) > 1) p USING (decision_key)""")
def q28_override(spark: SparkSession, sf: str) -> DataFrame:
    """Manual patches by key, applied where a row is there (here: decisions recorded more than once)."""
    patches = table(spark, sf, "practice").filter("decision_key is not null").groupBy("decision_key").count().filter("count > 1").select("decision_key", F.lit("overturned").alias("status"))
    return G.override(last_cases(spark, sf), patches, ["decision_key"], ["status"]).select("decision_key", "case_number", "status", "overridden")


@query("SELECT doc_id, text AS decoded FROM court_texts WHERE body IS NOT NULL")
def q32_html_text(spark: SparkSession, sf: str) -> DataFrame:
    """HTML bodies decoded to the text that the register gives."""
    return table(spark, sf, "court_texts").filter("body is not null").select("doc_id", D.document_text("body", "content_type", "url").alias("decoded"))


@query("SELECT doc_id, regexp_replace(doc_url, '/+$', '') AS url_key, regexp_extract(doc_url, '^https?://([^/]+)', 1) AS host FROM court_docs")
def q33_url_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "court_docs").select("doc_id", X.url_key(F.col("doc_url")).alias("url_key"), F.regexp_extract("doc_url", "^https?://([^/]+)", 1).alias("host"))


@query(f"""WITH c AS ({_CASE.join(['SELECT ', ' AS cause, doc_id FROM court_docs'])}), t AS (SELECT cause, count(DISTINCT c.doc_id) AS docs, count(DISTINCT x.doc_id) AS texts FROM c LEFT JOIN court_texts x ON x.doc_id = c.doc_id WHERE cause IS NOT NULL GROUP BY 1)
  SELECT count(*) AS cases, count(*) FILTER (texts > 0) AS with_text, count(*) FILTER (texts = docs) AS complete, greatest(0, count(*) - count(*) FILTER (texts > 0)) AS coverage_gap, count(*) FILTER (texts = 0) = 0 AS may_write FROM t""")
def q39_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """The gate before a write: what is checked, what is missing."""
    c = table(spark, sf, "court_docs").select(clean_case_number(F.col("cause_num")).alias("cause"), "doc_id").filter("cause is not null").distinct()
    t = c.join(table(spark, sf, "court_texts").select("doc_id", F.lit(1).alias("has")).distinct(), "doc_id", "left").groupBy("cause").agg(F.count("*").alias("docs"), F.count("has").alias("texts"))
    w = F.count_if(F.col("texts") > 0)
    return t.agg(F.count("*").alias("cases"), w.alias("with_text"), F.count_if(F.col("texts") == F.col("docs")).alias("complete"), F.greatest(F.lit(0), F.count("*") - w).alias("coverage_gap"), (F.count_if(F.col("texts") == 0) == 0).alias("may_write"))


@query("SELECT court_code, name, row_number() OVER (ORDER BY name COLLATE uk, court_code) AS place FROM (SELECT DISTINCT court_code, name FROM courts)")
def q41_courts_collated(spark: SparkSession, sf: str) -> DataFrame:
    """Courts with their place in the order of the Ukrainian alphabet (a fixed dimension, so one window over all of it)."""
    w = Window.orderBy(F.collate(F.col("name"), "uk"), "court_code")
    return table(spark, sf, "courts").select("court_code", "name").distinct().withColumn("place", F.row_number().over(w))


@query(f"""WITH s AS ({_SNAP}), g AS (SELECT decision_key, case_number, list_sort(list(DISTINCT y)) AS years FROM (SELECT decision_key, case_number, unnest(source_years) AS y FROM s) GROUP BY 1, 2)
  SELECT decision_key, case_number, array_to_string(list_filter(years, lambda y: y <> 2025), ',') AS years FROM g WHERE len(list_filter(years, lambda y: y <> 2025)) > 0""")
def q42_replace_year(spark: SparkSession, sf: str) -> DataFrame:
    """One source year taken out; cases without any year left go."""
    g = snapshots(spark, sf).groupBy("decision_key", "case_number").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("source_years")))).alias("source_years"))
    return best.replace_year(g, 2025).select("decision_key", "case_number", F.array_join("source_years", ",").alias("years"))


_CASE_IN_TEXT = "regexp_matches(form, '(^|[^0-9a-zа-яіїєг/])' || cause || '($|[^0-9a-zа-яіїєг/])')"


@query(f"""WITH d AS (SELECT DISTINCT doc_id, {_CASE} AS cause FROM court_docs), t AS (SELECT t.doc_id, {_FORM_SQL.format(c=_fold_sql('text'))} AS form, max(d.cause) AS cause FROM court_texts t LEFT JOIN d USING (doc_id) GROUP BY 1, 2),
  v AS (SELECT doc_id, length(form) AS n, coalesce({_CASE_IN_TEXT}, false) AS hit, regexp_matches(form, '(?:^|\\s)(?:{'|'.join(V.JUDGMENTS)})(?:\\s|$)') AS j, regexp_matches(form, '{'|'.join(V.COURTS)}') AS c, regexp_matches(form, '(?:^|\\s)справ[аиіою](?:\\s|$)') AS w FROM t)
  SELECT doc_id, (n >= 300 AND hit) OR (n >= 1000 AND w AND j AND c) AS valid, CASE WHEN n < 300 THEN 'too_short' WHEN NOT ((n >= 300 AND hit) OR (n >= 1000 AND w AND j AND c)) THEN 'case_number_or_court_markers_missing' ELSE 'ok' END AS reason FROM v""")
def q46_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Which court texts are whole documents, and why not."""
    d = table(spark, sf, "court_docs").select("doc_id", clean_case_number(F.col("cause_num")).alias("cause")).groupBy("doc_id").agg(F.max("cause").alias("cause"))
    t = table(spark, sf, "court_texts").select("doc_id", _form(F.col("text")).alias("form")).join(d, "doc_id", "left")
    hit = F.coalesce(F.regexp_like("form", F.concat(F.lit(f"(?<![{C.EDGE}])"), F.col("cause"), F.lit(f"(?![{C.EDGE}])"))), F.lit(False))
    valid, reason = V.validation(F.col("form"), hit)
    return t.select("doc_id", valid.alias("valid"), reason.alias("reason"))


_MARKS = f"regexp_matches(form, '(?:^|\\s)(?:{'|'.join(V.JUDGMENTS)})(?:\\s|$)') AS j, regexp_matches(form, '{'|'.join(V.COURTS)}') AS c, regexp_matches(form, '(?:^|\\s)справ[аиіою](?:\\s|$)') AS w"


@query(f"""WITH d AS (SELECT doc_id, max({_CASE}) AS cause FROM court_docs GROUP BY 1), a AS (SELECT doc_id, 1 AS attempt, substr(text, 1, 250) AS t FROM court_texts WHERE text IS NOT NULL UNION ALL SELECT doc_id, 2, text FROM court_texts), f AS (SELECT a.*, {_FORM_SQL.format(c=_fold_sql('t'))} AS form, cause FROM a LEFT JOIN d USING (doc_id)),
  v AS (SELECT doc_id, attempt, t, length(form) AS n, coalesce({_CASE_IN_TEXT}, false) AS hit, {_MARKS} FROM f), k AS (SELECT *, coalesce((n >= 300 AND hit) OR (n >= 1000 AND w AND j AND c), false) AS ok FROM v)
  SELECT doc_id, min(attempt) FILTER (ok) AS attempt, arg_min(length(t), attempt) FILTER (ok) AS chars, count(*) AS attempts FROM k GROUP BY 1""")
def q46_first_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Of several attempts to get a text (here a torn one and the whole) the first that is a valid document."""
    d = table(spark, sf, "court_docs").select("doc_id", clean_case_number(F.col("cause_num")).alias("cause")).groupBy("doc_id").agg(F.max("cause").alias("cause"))
    t = table(spark, sf, "court_texts")
    a = t.filter("text is not null").select("doc_id", F.lit(1).alias("attempt"), F.substring("text", 1, 250).alias("t")).unionByName(t.select("doc_id", F.lit(2).alias("attempt"), F.col("text").alias("t")))
    a = a.withColumn("form", _form(F.col("t"))).join(d, "doc_id", "left")
    hit = F.coalesce(F.regexp_like("form", F.concat(F.lit(f"(?<![{C.EDGE}])"), F.col("cause"), F.lit(f"(?![{C.EDGE}])"))), F.lit(False))
    a = a.select("doc_id", "attempt", F.length("t").alias("chars"), V.validation(F.col("form"), hit)[0].alias("valid"), F.col("attempt").alias("n"))
    return V.first_valid(a, "doc_id", "n", "valid", ["attempt", "chars"])


@query(f"""WITH m AS (SELECT DISTINCT {_CASE} AS cause FROM court_docs WHERE judgment_code IN ('2', '3')), s AS ({_SNAP}), g AS (SELECT decision_key, case_number, max(list_max(source_years)) AS y, coalesce(bool_or(status IN ('overturned', 'partially_overturned', 'upheld')), false) AS fin FROM s GROUP BY 1, 2)
  SELECT decision_key, case_number, CASE WHEN y >= 2026 THEN 'current_refresh' WHEN NOT fin AND case_number IN (SELECT cause FROM m WHERE cause IS NOT NULL) THEN 'backfill' ELSE 'skip' END AS mode FROM g""")
def q61_history_mode(spark: SparkSession, sf: str) -> DataFrame:
    """How each known case is looked at again: refreshed in its newest year, filled in from older acts, or left."""
    m = table(spark, sf, "court_docs").filter(F.col("judgment_code").isin(*MERITS)).select(clean_case_number(F.col("cause_num")).alias("case_number"), F.lit(True).alias("docs")).filter("case_number is not null").distinct()
    g = snapshots(spark, sf).groupBy("decision_key", "case_number").agg(F.max(F.array_max("source_years")).alias("y"), F.coalesce(F.max(F.col("status").isin(*G.FINAL)), F.lit(False)).alias("fin"))
    mode = V.history_mode(F.col("y"), F.lit(2026), F.col("fin"), F.lit(False), F.coalesce("docs", F.lit(False)))
    return g.join(m, "case_number", "left").select("decision_key", "case_number", mode.alias("mode"))


@query(_CONTAINED + f""", p AS (SELECT rec_id, {_IDENT_SQL.format(c=_fold_sql('decision_number'))} AS number, decision_date FROM practice WHERE decision_number IS NOT NULL), d AS (SELECT doc_id, min(adjudication_date) AS day FROM court_docs WHERE regexp_matches(adjudication_date, '^\\d{{4}}-\\d\\d-\\d\\d$') GROUP BY 1)
  SELECT hit.doc_id, p.rec_id, coalesce(d.day >= CASE WHEN regexp_matches(p.decision_date, '^\\d{{4}}-\\d\\d-\\d\\d$') THEN p.decision_date END, true) AS possible FROM hit JOIN p USING (number) LEFT JOIN d ON d.doc_id = hit.doc_id""")
def q47_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Texts and all records of the numbers that they hold, with the test of chronology."""
    iso = lambda c: F.when(F.col(c).rlike(r"^\d{4}-\d\d-\d\d$"), F.col(c))
    p = table(spark, sf, "practice").filter("decision_number is not null").select("rec_id", X.identifier_form(fold_digits(F.col("decision_number"))).alias("number"), iso("decision_date").alias("decided"))
    d = table(spark, sf, "court_docs").groupBy("doc_id").agg(F.min(iso("adjudication_date")).alias("day"))
    # one row for each document of the register: merged, whatever its file's size says
    return held_numbers(spark, sf).join(p, "number").join(d.hint("merge"), "doc_id", "left").select("doc_id", "rec_id", F.coalesce(F.col("day") >= F.col("decided"), F.lit(True)).alias("possible"))


@query(f"""WITH s AS ({_SNAP}), k AS (SELECT DISTINCT decision_key, case_number FROM s), p AS (SELECT decision_key, min(rec_id) AS rec_id FROM practice GROUP BY 1)
  SELECT k.decision_key, k.case_number, p.rec_id, CASE WHEN p.rec_id IS NULL THEN 'not_in_practice' ELSE 'linked' END AS reason FROM k LEFT JOIN p USING (decision_key)""")
def q48_registry_links(spark: SparkSession, sf: str) -> DataFrame:
    """Known cases of the registry against practice; a miss keeps its row with the reason."""
    k = snapshots(spark, sf).select("decision_key", "case_number").distinct()
    p = table(spark, sf, "practice").groupBy("decision_key").agg(F.min("rec_id").alias("rec_id"))
    return k.join(p, "decision_key", "left").withColumn("reason", F.when(F.col("rec_id").isNull(), "not_in_practice").otherwise("linked"))


@query("""SELECT rec_id, coalesce(lower(trim(confidence)) = 'high', false) AND coalesce(decision_outcome, '') <> 'other' AS resolves, CASE WHEN confidence IN ('high', 'medium', 'low') THEN confidence ELSE 'low' END AS confidence,
   CASE WHEN confidence = 'high' AND coalesce(decision_outcome, '') <> 'other' THEN CASE WHEN decision_outcome = 'violation_found' THEN 'upheld' ELSE 'overturned' END ELSE 'ongoing' END AS outcome FROM practice""")
def q49_coercion(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations brought to their closed form (here made of practice columns)."""
    r = F.when(F.lower(F.trim("confidence")) == "high", "Yes").otherwise("no")
    inv = F.when(F.col("decision_outcome") == "other", "1").otherwise("0")
    outcome = F.when(F.col("decision_outcome") == "violation_found", "upheld").when(F.col("decision_outcome") == "other", "x").otherwise("overturned")
    c = V.coerced(r, inv, outcome, F.col("confidence"))
    return table(spark, sf, "practice").select("rec_id", c["resolves"].alias("resolves"), c["confidence"].alias("confidence"), c["outcome"].alias("outcome"))


@query("SELECT doc_id, true AS same FROM court_texts WHERE text IS NOT NULL")
def q43_rtf(spark: SparkSession, sf: str) -> DataFrame:
    """Court texts wrapped as RTF and decoded again; ``same`` says that nothing was lost."""
    t = table(spark, sf, "court_texts").filter("text is not null").select("doc_id", F.trim(X.compact(F.col("text"))).alias("t"))
    unit = lambda v: F.concat(F.lit("\\u"), v.cast("string"), F.lit("?"))
    high = lambda v: v - 65536

    def written(c: Column) -> Column:
        v = F.ascii(c)
        pair = F.concat(unit(F.shiftright(high(v), 10) + 55296), unit(high(v) % 1024 + 56320))
        return F.when(v > 65535, pair).when(v > 127, unit(v)).otherwise(F.regexp_replace(c, r"([\\{}])", r"\\$1"))

    body = F.array_join(F.transform(F.split("t", ""), written), "")
    rtf = F.concat(F.lit("{\\rtf1\\ansi\\ansicpg1251\\uc1{\\fonttbl{\\f0 Arial;}}\\f0 "), body, F.lit("}"))
    return t.select("doc_id", (D.rtf_text(rtf.cast("binary")) == F.col("t")).alias("same"))
