"""Queries over practice and the catalogue: normalisation, rules, search, merging, aggregates; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.functions.chars import digit_pairs, width_pairs
from lexmill.functions.chars import fold_digits
from lexmill.operators import best, decisions, resources as R, rules, search as S
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


def _sql(text: str) -> str:
    return text.replace("'", "''")


_SEARCH_SQL = "trim(regexp_replace(regexp_replace(replace(translate(lower(coalesce({c}, '')), chr(160) || '’ʼ`´–—', ' ''''''''--'), '¹', '-1'), '[^0-9a-zа-яіїєґ''-]+', ' ', 'g'), ' +', ' ', 'g'))"
_PHRASE_FIELDS = "[" + ", ".join(S.EXACT_TEXTS) + "] || " + " || ".join(f"coalesce({a}, [])" for a in S.EXACT_ARRAYS)
SEARCHES = [('"лікарські засоби" штраф', None, None), ("«природний газ» торгів", "economic_competition", None), ("тендер змова", None, 2023), ("", "unfair_competition", 2021)]


def _search_sql(i: int) -> str:
    q, family, year = SEARCHES[i]
    p = S.parse(q)
    tests = [f"contains(blob, '{_sql(t)}')" for t in p.terms] + [f"len(list_filter(fields, lambda f: contains(' ' || f || ' ', ' {_sql(x)} '))) > 0" for x in p.phrases]
    tests += [f"classification.law_family = '{family}'"] * bool(family) + [f"year = {year}"] * bool(year)
    return f"""SELECT {i} AS search_no, rec_id FROM (SELECT *, {_SEARCH_SQL.format(c='search_blob')} AS blob,
        list_transform({_PHRASE_FIELDS}, lambda x: {_SEARCH_SQL.format(c='x')}) AS fields FROM practice) t WHERE {' AND '.join(tests) or 'true'}"""


@query(" UNION ALL ".join(_search_sql(i) for i in range(len(SEARCHES))))
def q01_search(spark: SparkSession, sf: str) -> DataFrame:
    """Four searches: quoted phrases in single fields, words in the blob, facets."""
    return S.search_all(table(spark, sf, "practice"), SEARCHES, "rec_id")


_TOTAL = "coalesce(list_sum(list_transform(sanction_amounts, lambda s: coalesce(s.amount_uah, 0.0))), 0.0)"


def total_sanction():
    return F.aggregate(F.coalesce("sanction_amounts", F.expr("cast(array() as array<struct<party:string,amount_uah:double,note:string>>)")), F.lit(0.0), lambda a, s: a + F.coalesce(s["amount_uah"], F.lit(0.0)))




def _sort_sql(name: str, order: str) -> str:
    return f"SELECT '{name}' AS sort_name, CAST(k AS INT) AS place, rec_id FROM (SELECT rec_id, row_number() OVER (ORDER BY {order}, rec_id) AS k FROM f) WHERE k <= 25"


_FACETS = "SELECT rec_id, coalesce(sort_key, '') AS sk, coalesce(decision_date, 'null') || '|' || coalesce(decision_number, 'null') AS title, " + _TOTAL + " AS total FROM practice WHERE classification.law_family = 'economic_competition' AND primary_code = 'zek:50:1'"


@query(f"WITH f AS ({_FACETS}) " + " UNION ALL ".join(_sort_sql(*x) for x in [("date_desc", "sk COLLATE uk DESC"), ("date_asc", "sk COLLATE uk"), ("sanction_desc", "total DESC, sk COLLATE uk DESC"), ("title_asc", "title COLLATE uk")]))
def q02_faceted_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The first page of 25 of each of the four sorts within two facets (a top list)."""
    rows = S.search(table(spark, sf, "practice"), "", "economic_competition", None, "zek:50:1").withColumn("total", total_sanction()).select("rec_id", F.coalesce("sort_key", F.lit("")).alias("sort_key"), "decision_date", "decision_number", "total")
    out = None
    for name, order in S.orders(F.col("total")).items():
        p = S.page(rows, order, 25)
        p = p.select(F.lit(name).alias("sort_name"), F.row_number().over(_over(order)).alias("place"), "rec_id")
        out = p if out is None else out.unionByName(p)
    return out


def _over(order):
    from pyspark.sql import Window

    return Window.orderBy(*order)  # over one page only


@query("SELECT rec_id, place FROM (SELECT rec_id, row_number() OVER (ORDER BY " + f"{_TOTAL} DESC, rec_id) AS place FROM practice) WHERE place <= 50")
def q02_top_sanctions(spark: SparkSession, sf: str) -> DataFrame:
    """The 50 greatest sums of sanctions (a top list)."""
    order = [F.col("total").desc(), F.col("rec_id")]
    top = S.page(table(spark, sf, "practice").select("rec_id", total_sanction().alias("total")), order, 50)
    return top.select("rec_id", F.row_number().over(_over(order)).alias("place"))


@query("""SELECT rec_id, lower(concat_ws(' || ', nullif(decision_number, ''), nullif(decision_date, ''), nullif(primary_code, ''), nullif(primary_label, ''), nullif(outcome_label, ''),
    nullif(array_to_string(list_filter(liable_parties, lambda x: x <> ''), ' | '), ''), nullif(violation_summary, ''), nullif(amcu_reasoning, ''), nullif(sanction, ''),
    nullif(array_to_string(search_keywords, ' | '), ''), nullif(market_or_sector, ''))) AS blob FROM practice""")
def q03_search_blob(spark: SparkSession, sf: str) -> DataFrame:
    """One lower-case text of the fields that have something in them."""
    c = lambda n: F.when(F.col(n) != "", F.col(n))
    listed = lambda n: F.expr(f"nullif(array_join(filter({n}, x -> x <> ''), ' | '), '')")
    p = table(spark, sf, "practice")
    parts = [c("decision_number"), c("decision_date"), c("primary_code"), c("primary_label"), c("outcome_label"), listed("liable_parties"), c("violation_summary"), c("amcu_reasoning"), c("sanction"), listed("search_keywords"), c("market_or_sector")]
    return p.select("rec_id", F.lower(F.concat_ws(" || ", *parts)).alias("blob"))


_COMPACT = "regexp_replace(regexp_replace({c}, '[\\t\\n\\x0B\\f\\r \\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}\\x{{FEFF}}]+', ' ', 'g'), '^ | $', '', 'g')"


@query(f"SELECT doc_id, {_COMPACT.format(c='text')} AS compacted, {_SEARCH_SQL.format(c='text')} AS search_form, length(text) AS chars FROM documents WHERE text IS NOT NULL")
def q04_text_forms(spark: SparkSession, sf: str) -> DataFrame:
    """White space made plain, and the form in which search compares."""
    t = F.col("text")
    return table(spark, sf, "documents").filter(t.isNotNull()).select("doc_id", X.compact(t).alias("compacted"), X.search_form(t).alias("search_form"), F.length(t).cast("bigint").alias("chars"))


def _fold_sql(c: str) -> str:
    d, w = digit_pairs(), width_pairs()
    seen = dict(zip(w[0], w[1])) | dict(zip(d[0], d[1]))
    return f"translate({c}, '{_sql(''.join(seen))}', '{_sql(''.join(seen.values()))}')"


_IDENT = "regexp_replace(regexp_replace(replace(replace(lower({c}), '№', ''), 'ґ', 'г'), '[‐‑‒–—−]', '-', 'g'), '[^0-9a-zа-яіїєг/-]', '', 'g')"


@query(f"SELECT rec_id, {_IDENT.format(c=_fold_sql('decision_number'))} AS identifier, coalesce(decision_date, '') || '|' || coalesce(decision_number, '') AS merge_key, coalesce(decision_date || '|' || decision_number, 'unknown-date|' || decision_number, 'file-hash|' || file_sha256) AS act_key FROM practice")
def q05_identifiers(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers in one form, and the three keys of a decision."""
    n, d = F.col("decision_number"), F.col("decision_date")
    return table(spark, sf, "practice").select("rec_id", X.identifier_form(fold_digits(n)).alias("identifier"), X.result_key(d, n).alias("merge_key"), X.decision_key(d, n, F.col("file_sha256")).alias("act_key"))


RULES = {
    "closed": ["провадження у справі закрито", "proceedings were closed", "производство по делу прекращено"],
    "appeal": ["може бути оскаржен", "может быть обжаловано", "appeal"],
    "fine": ["штраф", "fine", "geldbuße", "karę"],
}


def _rule_sql(name: str) -> str:
    return f"coalesce(regexp_matches(lower(text), '{'|'.join(RULES[name])}'), false)"


@query(f"""SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN {_rule_sql('closed')} AND NOT {_rule_sql('fine')} THEN 'closed' WHEN {_rule_sql('fine')} THEN 'fine'
    WHEN {_rule_sql('appeal')} THEN 'appeal' ELSE 'other' END AS tag FROM documents""")
def q06_rule_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """An ordered cascade of rule families: the first that holds names the document."""
    t = F.lower(F.col("text"))
    hit = {n: rules.any_of(t, p) for n, p in RULES.items()}
    empty = F.coalesce(F.col("text") == "", F.lit(True))
    return table(spark, sf, "documents").select("doc_id", rules.cascade([(empty, "empty"), (hit["closed"] & ~hit["fine"], "closed"), (hit["fine"], "fine"), (hit["appeal"], "appeal")], "other").alias("tag"))


@query("""WITH t AS (SELECT rec_id, lower(array_to_string(list_transform(legal_basis, lambda b: b || ' статті 50'), '; ')) AS t FROM practice),
  p AS (SELECT rec_id, list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(t, 'пункт(?:ом|у|а|і)?\\s*(\\d{1,2})\\s+статті\\s*50', 1), lambda x: CAST(x AS INT)), lambda n: n BETWEEN 1 AND 21))) AS points FROM t)
  SELECT rec_id, array_to_string(points, ',') AS points, points[1] AS primary_point FROM p""")
def q07_extract_points(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered references in texts: bounded, without repeats, ascending; the smallest is the primary one."""
    t = F.array_join(F.transform("legal_basis", lambda b: F.concat(b, F.lit(" статті 50"))), "; ")
    p = table(spark, sf, "practice").select("rec_id", decisions.points(t).alias("p"))
    return p.select("rec_id", F.array_join("p", ",").alias("points"), F.get("p", F.lit(0)).alias("primary_point"))


@query("""WITH c AS (SELECT rec_id, legal_basis, translate(regexp_replace(lower(primary_code), '\\s+', '', 'g'), '–—', '--') AS c, classification.article_50_points AS pts, law_area FROM practice),
  k AS (SELECT *, CASE WHEN regexp_matches(c, '^zek:50:\\d{1,2}$') AND CAST(regexp_extract(c, '(\\d+)$', 1) AS INT) BETWEEN 1 AND 21 THEN c
     WHEN regexp_extract(c, '^unfair:(15-?1|\\d{1,2})$', 1) IN ('4','5','6','7','8','10','11','13','14','15','15-1','16','17','18','19') THEN c END AS code FROM c)
  SELECT rec_id, coalesce(code, 'other') AS code, CASE WHEN code LIKE 'zek:%' THEN 'economic_competition' WHEN code LIKE 'unfair:%' THEN 'unfair_competition' ELSE coalesce(law_area, 'other') END AS family,
     array_to_string(list_sort(list_distinct(coalesce(pts, []))), ',') AS points FROM k""")
def q08_classification(spark: SparkSession, sf: str) -> DataFrame:
    """One canonical classification: a known code decides the family, anything else is other."""
    code = rules.primary_code(F.col("primary_code"))
    family = F.when(code.startswith("zek:"), "economic_competition").when(code.startswith("unfair:"), "unfair_competition").otherwise(F.coalesce("law_area", F.lit("other")))
    pts = F.array_sort(F.array_distinct(F.coalesce("classification.article_50_points", F.array().cast("array<int>"))))
    return table(spark, sf, "practice").select("rec_id", F.coalesce(code, F.lit("other")).alias("code"), family.alias("family"), F.array_join(pts, ",").alias("points"))


def _period_sql() -> str:
    t, year = "lower(coalesce(nullif(title, ''), nullif(name, ''), ''))", "CAST(year(coalesce(try_cast(last_modified AS TIMESTAMP), try_cast(revision_timestamp AS TIMESTAMP), try_cast(created AS TIMESTAMP))) AS VARCHAR)"
    whens = []
    for i, names in enumerate(R.MONTHS):
        alt = "|".join(names)
        whens.append(f"WHEN regexp_matches({t}, '(?:{alt})(?:[^а-яіїєґ]|$)') THEN coalesce(nullif(regexp_extract({t}, '(?:{alt})\\s+(20\\d{{2}})', 1), ''), nullif(regexp_extract({t}, '(20\\d{{2}})', 1), ''), {year}) || '-{i + 1:02d}'")
    d = r"(\d{1,2})[.\s-]+(\d{1,2})[.\s-]+(20\d{2})"
    whens.append(f"WHEN try_cast(regexp_extract({t}, '{d}', 1) AS INT) BETWEEN 1 AND 31 AND try_cast(regexp_extract({t}, '{d}', 2) AS INT) BETWEEN 1 AND 12 THEN regexp_extract({t}, '{d}', 3) || '-' || lpad(CAST(CAST(regexp_extract({t}, '{d}', 2) AS INT) AS VARCHAR), 2, '0')")
    return "CASE " + " ".join(whens) + " END"


_PLAN_SQL = f"""plan AS (SELECT *, {_period_sql()} AS period, coalesce(try_cast(last_modified AS TIMESTAMP), try_cast(revision_timestamp AS TIMESTAMP), try_cast(created AS TIMESTAMP)) AS updated,
  coalesce(try_cast(regexp_extract(title, '№+\\s*(\\d{{1,5}})', 1) AS INT), 0) AS high FROM resources)"""


@query(f"""WITH {_PLAN_SQL} SELECT period, id, high, strftime(updated, '%Y-%m-%d') AS updated_on FROM plan WHERE period IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY period ORDER BY high DESC, CASE WHEN high > 0 THEN 1 ELSE 0 END DESC, updated DESC NULLS LAST, coalesce(try_cast(size AS BIGINT), 0) DESC, coalesce(nullif(title, ''), nullif(name, ''), '') COLLATE uk DESC, ord) = 1""")
def q09_best_per_month(spark: SparkSession, sf: str) -> DataFrame:
    """The best archive of each month by range, date, size; the first of equals."""
    return R.best_per_month(R.planned(table(spark, sf, "resources"))).select("period", "id", "high", F.date_format("updated", "yyyy-MM-dd").alias("updated_on"))


@query("""WITH s AS (SELECT *, coalesce(decision_date, '') || '|' || coalesce(decision_number, '') AS k,
    coalesce(length(violation_summary), 0) + coalesce(length(amcu_reasoning), 0) + coalesce(length(respondent_position), 0) + coalesce(length(sanction), 0)
    + coalesce(length(array_to_string(liable_parties, ' ')), 0) + coalesce(length(array_to_string(legal_basis, ' ')), 0) + CASE confidence WHEN 'high' THEN 1000 WHEN 'medium' THEN 500 ELSE 0 END AS score FROM practice)
  SELECT k AS merge_key, rec_id, score FROM s WHERE k <> '|' QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, rec_id DESC) = 1""")
def q10_dedupe_quality(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each key, of the greatest quality; the last of equals; rows without a key go."""
    n = lambda c: F.coalesce(F.length(c), F.lit(0))
    words = lambda c: F.coalesce(F.length(F.array_join(c, " ")), F.lit(0))
    score = words("liable_parties") + words("legal_basis") + n("violation_summary") + n("amcu_reasoning") + n("respondent_position") + n("sanction") + F.when(F.col("confidence") == "high", 1000).when(F.col("confidence") == "medium", 500).otherwise(0)
    rows = table(spark, sf, "practice").select(X.result_key(F.col("decision_date"), F.col("decision_number")).alias("merge_key"), "rec_id", score.alias("score")).filter("merge_key <> '|'")
    return best.keep_best(rows, ["merge_key"], F.struct("score", "rec_id"))


@query("""SELECT decision_key, rec_id, outcome_label, source_file FROM (SELECT decision_key, rec_id, outcome_label, source_file FROM practice UNION ALL SELECT decision_key, rec_id, outcome_label, source_file FROM practice_batches)
  QUALIFY decision_key IS NULL OR row_number() OVER (PARTITION BY decision_key ORDER BY rec_id DESC) = 1""")
def q11_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Arriving decisions over the accepted ones: the last writer wins."""
    cols = ["decision_key", "rec_id", "outcome_label", "source_file"]
    return best.upsert(table(spark, sf, "practice").select(*cols), table(spark, sf, "practice_batches").select(*cols), ["decision_key"], "rec_id")


@query("""SELECT id, concat_ws('|', nullif(id, ''), nullif(hash, ''), nullif(size, ''), nullif(last_modified, '')) AS signature FROM resources r WHERE NOT EXISTS (SELECT 1 FROM (
    SELECT source_resource_id AS id, count(*) AS n FROM practice GROUP BY 1) s WHERE s.id = r.id AND s.n >= 10 AND r.hash IS NOT NULL)""")
def q12_not_done(spark: SparkSession, sf: str) -> DataFrame:
    """Archives that are not clean in the state: here clean is a hash and at least ten decisions taken from it."""
    r = table(spark, sf, "resources").select("id", "hash", X.signature(*[F.col(c) for c in ("id", "hash", "size", "last_modified")]).alias("sig"))
    n = table(spark, sf, "practice").groupBy(F.col("source_resource_id").alias("id")).count()
    known = n.join(r, "id").select("id", F.when(F.col("hash").isNotNull(), F.col("sig")).otherwise("").alias("signature"), F.lit(3).alias("state_version"), F.when(F.col("count") >= 10, 0).otherwise(1).alias("errors"), F.lit(False).alias("incomplete"))
    return best.without_clean(r.drop("hash"), known, "id", "sig", 3).select("id", F.col("sig").alias("signature"))


@query(f"WITH {_PLAN_SQL}, m AS (SELECT id, period, CAST(substr(period, 1, 4) AS INT) * 12 + CAST(substr(period, 6, 2) AS INT) AS n FROM plan WHERE lower(trim(format)) LIKE '%zip%' AND regexp_matches(lower(title), 'рішен') AND NOT regexp_matches(lower(title), 'рекомендац|список|розпоряджен')) SELECT id, period FROM m WHERE 2024 * 12 + 6 - n BETWEEN 0 AND 18")
def q13_lookback(spark: SparkSession, sf: str) -> DataFrame:
    """Eligible archives of the 18 months before a given one."""
    p = R.planned(table(spark, sf, "resources")).filter(R.eligible(["рішен"], ["рекомендац", "список", "розпоряджен"]) & R.within(F.col("month_number"), 2024, 6, 18))
    return p.select("id", "period")


@query(f"SELECT count(*) AS decisions, round(sum({_TOTAL}), 2) AS sanctions_total, count(*) FILTER (classification.law_family = 'economic_competition') AS economic, count(*) FILTER (classification.law_family = 'unfair_competition') AS unfair, count(*) FILTER (classification.law_family = 'mixed') AS mixed, array_to_string(list_reverse(list_sort(list(DISTINCT year) FILTER (year IS NOT NULL AND year > 0))), ',') AS years, arg_min(coalesce(decision_date, ''), (coalesce(sort_key, ''), rec_id)) AS oldest, arg_max(coalesce(decision_date, ''), (coalesce(sort_key, ''), rec_id)) AS newest, count(DISTINCT primary_code) AS codes FROM practice")
def q29_index(spark: SparkSession, sf: str) -> DataFrame:
    """The aggregates of an overview: totals, families, years, ends of the sort order."""
    fam = lambda f: F.count_if(F.col("classification.law_family") == f)
    return table(spark, sf, "practice").withColumn("total", total_sanction()).agg(
        F.count("*").alias("decisions"), F.round(F.sum("total"), 2).alias("sanctions_total"), fam("economic_competition").alias("economic"), fam("unfair_competition").alias("unfair"), fam("mixed").alias("mixed"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("year") > 0, F.col("year"))), asc=False), ",").alias("years"),
        *[f(F.coalesce("decision_date", F.lit("")), F.struct(F.coalesce("sort_key", F.lit("")), "rec_id")).alias(n) for f, n in ((F.min_by, "oldest"), (F.max_by, "newest"))], F.countDistinct("primary_code").alias("codes"),
    )


CODE_ORDER = [f"zek:50:{n}" for n in range(1, 22)] + [f"unfair:{a}" for a in rules.UNFAIR_ARTICLES]


@query(f"""WITH c AS (SELECT primary_code AS code, count(*) AS n, arg_min(coalesce(primary_label, ''), (coalesce(sort_key, ''), rec_id)) AS label FROM practice GROUP BY 1)
  SELECT code, n, label, coalesce(nullif(list_position({CODE_ORDER!r}, code), 0), 2147483647) AS place FROM c""")
def q30_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by code with the label of the first row in sort order and the place in the fixed order of codes."""
    order = F.create_map(*[F.lit(x) for i, c in enumerate(CODE_ORDER) for x in (c, i + 1)])
    g = table(spark, sf, "practice").groupBy(F.col("primary_code").alias("code")).agg(F.count("*").alias("n"), F.min_by(F.coalesce("primary_label", F.lit("")), F.struct(F.coalesce("sort_key", F.lit("")), "rec_id")).alias("label"))
    return g.withColumn("place", F.coalesce(F.try_element_at(order, "code"), F.lit(2147483647)))


@query("""SELECT rec_id, round(coalesce(list_sum(list_transform(sanction_amounts, lambda s: coalesce(s.amount_uah, 0.0))), 0.0), 2) AS listed,
  CASE WHEN try_cast(regexp_replace(regexp_replace(sanction, '[^0-9.,]', '', 'g'), '^([^,]*),', '\\1.') AS DOUBLE) <> 0 THEN try_cast(regexp_replace(regexp_replace(sanction, '[^0-9.,]', '', 'g'), '^([^,]*),', '\\1.') AS DOUBLE) END AS written FROM practice""")
def q31_sanctions(spark: SparkSession, sf: str) -> DataFrame:
    """Sum of the listed amounts, and the amount that the text names."""
    return table(spark, sf, "practice").select("rec_id", F.round(total_sanction(), 2).alias("listed"), X.amount(F.col("sanction")).alias("written"))


@query("""SELECT DISTINCT p.decision_key, p.rec_id FROM practice_batches p WHERE NOT EXISTS (SELECT 1 FROM practice q WHERE q.decision_key = p.decision_key) AND NOT EXISTS (SELECT 1 FROM practice q WHERE q.file_sha256 = p.file_sha256)""")
def q27_new_only(spark: SparkSession, sf: str) -> DataFrame:
    """Add-only intake: arriving rows whose key and file are both unknown."""
    known = table(spark, sf, "practice")
    new = table(spark, sf, "practice_batches").select("decision_key", "rec_id", "file_sha256")
    return new.join(known.select("decision_key"), "decision_key", "left_anti").join(known.select("file_sha256"), "file_sha256", "left_anti").select("decision_key", "rec_id").distinct()


@query("""WITH asked AS (SELECT DISTINCT decision_key FROM practice WHERE decision_key IS NOT NULL), a AS (SELECT decision_key, confidence, rec_id FROM practice_batches b WHERE decision_key IN (SELECT decision_key FROM asked)
    QUALIFY row_number() OVER (PARTITION BY decision_key ORDER BY rec_id) = 1)
  SELECT asked.decision_key, confidence, CASE WHEN a.decision_key IS NULL THEN 'not_processed' ELSE 'processed' END AS outcome FROM asked LEFT JOIN a USING (decision_key)""")
def q23_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Answers against what was asked: unknown ones dropped, the first of repeated ones taken, the missing marked."""
    asked = table(spark, sf, "practice").select("decision_key").filter("decision_key is not null").distinct()
    return best.reconcile(asked, table(spark, sf, "practice_batches"), "decision_key", F.col("rec_id"), ["confidence"])
