"""Queries over the texts of decisions: relevance, outcome, number and day, norms, classification; each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import decisions as V
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


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions as texts, written out from the fields of practice: head, subject, legal basis, findings."""
    p = table(spark, sf, "practice")
    unfair = F.col("law_area") == "unfair_competition"

    def norm(b: Column) -> Column:
        article = F.concat(F.lit("стаття "), F.replace(b, F.lit("пункт "), F.lit("")), F.lit(" Закону України «Про захист від недобросовісної конкуренції»"))
        return F.when(unfair, article).otherwise(F.concat(b, F.lit(" статті 50 Закону України «Про захист економічної конкуренції»")))

    o = F.col("decision_outcome")
    subject = F.when(o == "proceeding_closed_no_violation", "Про ЗАКРИТТЯ провадження").when(o == "permit_granted", "Про надання дозволу на концентрацію").when(o == "other", "Про перегляд рішення")
    matter = F.when(o == "permit_granted", None).when(unfair, "про порушення законодавства про захист від недобросовісної конкуренції").when(F.col("law_area") == "economic_competition", "Про порушення законодавства про захист економічної конкуренції")
    basis = F.when((o != "permit_granted") | o.isNull(), F.array_join(F.transform("legal_basis", norm), "; "))
    extra = F.when(F.col("primary_code") == "zek:50:1", "пункт 4 частини другої статті 6, антиконкурентні узгоджені дії").when(F.col("primary_code") == "zek:50:12", "набуття контролю без отримання відповідного дозволу")
    day = F.concat(F.lit("Рішення від "), F.col("decision_date"), F.lit(" № "), F.col("decision_number"))
    return p.select("rec_id", "source_file", "legal_basis", "law_area", "primary_code", "classification", F.concat_ws("\n", day, subject, matter, basis, extra, "violation_summary", "amcu_reasoning", "sanction").alias("text"))


#: The same texts in SQL, and white space of any kind.
_TEXTS = """t0 AS (SELECT *, concat_ws(chr(10), 'Рішення від ' || decision_date || ' № ' || decision_number,
  CASE decision_outcome WHEN 'proceeding_closed_no_violation' THEN 'Про ЗАКРИТТЯ провадження' WHEN 'permit_granted' THEN 'Про надання дозволу на концентрацію' WHEN 'other' THEN 'Про перегляд рішення' END,
  CASE WHEN decision_outcome = 'permit_granted' THEN NULL WHEN law_area = 'unfair_competition' THEN 'про порушення законодавства про захист від недобросовісної конкуренції' WHEN law_area = 'economic_competition' THEN 'Про порушення законодавства про захист економічної конкуренції' END,
  CASE WHEN decision_outcome IS DISTINCT FROM 'permit_granted' THEN array_to_string(list_transform(legal_basis, lambda b: CASE WHEN law_area = 'unfair_competition' THEN 'стаття ' || replace(b, 'пункт ', '') || ' Закону України «Про захист від недобросовісної конкуренції»' ELSE b || ' статті 50 Закону України «Про захист економічної конкуренції»' END), '; ') END,
  CASE primary_code WHEN 'zek:50:1' THEN 'пункт 4 частини другої статті 6, антиконкурентні узгоджені дії' WHEN 'zek:50:12' THEN 'набуття контролю без отримання відповідного дозволу' END, violation_summary, amcu_reasoning, sanction) AS text FROM practice),
  t AS (SELECT *, lower(trim(regexp_replace(replace(text, chr(160), ' '), '[ \\t\\r\\f\\x0B]+', ' ', 'g'))) AS x FROM t0)"""
_W = "[\\s\\x0B\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]"


def _re(pattern: str) -> str:
    """A pattern whose blanks stand for white space of any kind."""
    return pattern.replace(" ", _W + "+").replace("~", _W + "*")


def _says(x: str, *patterns: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, '{_re(p)}')" for p in patterns) + ")"


def _points_sql(x: str) -> str:
    named = " || ".join(f"regexp_extract_all({x}, '{_re(p)}', 1)" for p in ("пункт(?:ом|у|а|і)?~(\\d{1,2}) статті~50", "п\\.?~(\\d{1,2})~ст\\.?~50", "пункт(?:ом|у|а|і)?~(\\d{1,2}) частини першої статті~50"))
    one = f"CASE WHEN {_says(x, 'пункт(?:ом|у|а|і)?~4 частини другої статті~6')} AND {_says(x, 'антиконкурентн[іи] узгоджен[іи] ді[їй]')} THEN [1] ELSE [] END"
    two = f"CASE WHEN {_says(x, 'частин[аи] перш[аої]+ статті~13')} AND contains({x}, 'зловживан') THEN [2] ELSE [] END"
    return f"list_sort(list_distinct(list_filter(list_transform({named}, lambda v: CAST(v AS INT)) || {one} || {two}, lambda n: n BETWEEN 1 AND 21)))"


def _articles_sql(x: str) -> str:
    law = " закону україни «?про захист від недобросовісної конкуренції»?"
    number = "(15~[-–—]?~1|15~¹|\\d{1,2})"
    found = " || ".join(f"regexp_extract_all({x}, '{_re(p)}', 1)" for p in (f"статт(?:і|ею|я)~{number}{law}", f"ст\\.?~{number}{law}"))
    plain = f"list_transform({found}, lambda v: regexp_replace(regexp_replace(replace(v, '¹', '-1'), '{_W}', '', 'g'), '^15[-–—]?1$', '15-1'))"
    known = "['4', '5', '6', '7', '8', '10', '11', '13', '14', '15', '15-1', '16', '17', '18', '19']"
    return f"list_filter({known}, lambda a: list_contains({plain}, a))"


def _norm_sql(x: str) -> str:
    p12 = f"{_says(x, 'пункт(?:ом|у)?~12 статті~50', 'п\\.?~12~ст\\.?~50')} AND {_says(x, 'здійснення концентрації', 'концентраці[яї] без отримання', 'набуття контролю', 'придбання акці[йї]', 'придбання активів')} AND {_says(x, f'без отримання (?:відповідного{_W}+)?дозволу', 'наявність такого дозволу необхідна')}"
    return f"(len({_points_sql(x)}) > 0 OR len({_articles_sql(x)}) > 0 OR ({p12}) OR {_says(x, 'законодавства про захист економічної конкуренції', 'законодавства про захист від недобросовісної конкуренції')})"


def _closed_sql(x: str) -> str:
    h = f"substr({x}, 1, 45000)"
    return f"({_says(h, 'закрит(?:и|тя) провадження', 'не доведено вчинення[\\s\\S]{0,180}?порушення', 'порушення[\\s\\S]{0,180}?не доведено')} AND {_norm_sql(h)})"


def _permit_sql(x: str, closed: str) -> str:
    h = f"substr({x}, 1, 18000)"
    no = _says(h, "справ[аи] про порушення", "провадженн[яі] у справ[іи]", "пункт(?:ом|у)?~\\d{1,2} статті~50", "п\\.~\\d{1,2}~ст\\.~50")
    return f"({_says(h, 'про надання дозволу на концентраці[юї]', 'надати дозвіл[\\s\\S]{0,250}?на концентраці[юї]', 'надати дозвіл[\\s\\S]{0,250}?на створення')} AND NOT {closed} AND NOT {no})"


_OUTCOME = f"CASE WHEN {_closed_sql('e')} THEN 'proceeding_closed_no_violation' WHEN {_permit_sql('e', _closed_sql('e'))} THEN 'permit_granted' ELSE 'violation_found' END"


@query(f"""WITH {_TEXTS}, b AS (SELECT rec_id, x, substr(x, 1, 45000) || chr(10) || right(x, 18000) AS e, {_closed_sql('x')} AS closed FROM t), r AS (SELECT *, {_permit_sql('x', 'closed')} AS permit,
   {_says('substr(x, 1, 25000)', 'про порушення законодавства про захист економічної конкуренції', 'порушення законодавства про захист від недобросовісної конкуренції')} OR closed AS included,
   {_says('substr(x, 1, 25000)', 'про розстрочення сплати штрафу', 'про відстрочення сплати штрафу', 'про перевірку рішення', 'про перегляд рішення', 'про внесення змін')} AS procedural FROM b),
   c AS (SELECT *, CASE WHEN permit THEN 'permit_only_concentration_or_clearance' WHEN NOT included THEN 'not_violation_decision' WHEN procedural AND NOT closed THEN 'procedural_decision' WHEN closed THEN 'closure_practice' ELSE 'included_by_regex' END AS reason FROM r)
   SELECT rec_id, reason IN ('closure_practice', 'included_by_regex') AS relevant, reason, CASE WHEN reason IN ('closure_practice', 'included_by_regex') THEN CASE WHEN {_says('substr(x, 1, 25000)', 'недобросовісної конкуренції')} THEN 'unfair_competition' ELSE 'economic_competition' END END AS law_area,
   CASE WHEN reason IN ('closure_practice', 'included_by_regex') THEN CASE WHEN closed THEN 'proceeding_closed_no_violation' ELSE {_OUTCOME} END END AS outcome FROM c""")
def q50_relevance(spark: SparkSession, sf: str) -> DataFrame:
    """The relevance cascade over whole decisions: reason, law area and outcome."""
    t = texts(spark, sf).select("rec_id", V.normalize_spaces(F.col("text")).alias("x"))
    return t.select("rec_id", V.relevance(F.col("x")).alias("r")).select("rec_id", "r.*")


@query(f"""WITH {_TEXTS} SELECT rec_id, CASE lower(trim(coalesce(outcome_label, ''))) WHEN 'порушення встановлено' THEN 'violation_found' WHEN 'провадження закрито' THEN 'proceeding_closed_no_violation' WHEN 'дозвіл надано' THEN 'permit_granted' WHEN 'other' THEN 'other'
   ELSE (SELECT {_OUTCOME} FROM (SELECT substr(x, 1, 45000) || chr(10) || right(x, 18000) AS e)) END AS outcome,
   CASE WHEN decision_outcome IN ('proceeding_closed_no_violation', 'permit_granted', 'other') THEN decision_outcome ELSE 'violation_found' END AS row_outcome, coalesce(nullif(outcome_label, ''), CASE decision_outcome WHEN 'proceeding_closed_no_violation' THEN 'Провадження закрито / порушення не доведено' WHEN 'permit_granted' THEN 'Дозвіл надано' WHEN 'other' THEN 'Інший результат' ELSE 'Порушення встановлено' END) AS label FROM t""")
def q51_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Annotated outcomes in one code: by alias, else from the text; for finished rows by code alone, with a label."""
    labels = table(spark, sf, "practice").select("rec_id", "decision_outcome", "outcome_label")
    code = V.outcome_code(F.col("decision_outcome"))
    return texts(spark, sf).join(labels, "rec_id").select("rec_id", V.outcome_of(F.col("outcome_label"), F.col("text")).alias("outcome"), code.alias("row_outcome"), V.outcome_label(code, F.col("outcome_label")).alias("label"))


_MONTHS_SQL = "['січня', 'лютого', 'березня', 'квітня', 'травня', 'червня', 'липня', 'серпня', 'вересня', 'жовтня', 'листопада', 'грудня']"
_DAY_SQL = _re("(\\d{1,2}) (січня|лютого|березня|квітня|травня|червня|липня|серпня|вересня|жовтня|листопада|грудня) (20\\d{2})")
_NUMBER_SQL = _re("№~([0-9]{1,5}~[-–—]?~[а-яіїєґa-z]*)")


@query(f"""WITH {_TEXTS}, d AS (SELECT doc_id AS id, 'doc' AS kind, coalesce(text, '') AS text, source AS file FROM documents UNION ALL SELECT rec_id, 'act', text, source_file FROM t),
   s AS (SELECT *, substr(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(160), ' '), '[ \\t\\r\\f\\x0B]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^{_W}+|{_W}+$', '', 'g'), 1, 6000) AS h FROM d),
   m AS (SELECT *, lower(h) AS l, regexp_extract(lower(h), '{_DAY_SQL}', 0) AS day FROM s), n AS (SELECT *, CASE WHEN day <> '' THEN substr(h, position(day IN l)) ELSE h END AS rest FROM m),
   f AS (SELECT *, coalesce(nullif(regexp_extract(rest, '(?i){_NUMBER_SQL}', 1), ''), nullif(regexp_extract(h, '(?i){_NUMBER_SQL}', 1), ''), nullif(regexp_extract(file, '(?i){_NUMBER_SQL}', 1), ''), nullif(regexp_extract(file, '(?i){_re('(\\d{1,5})~[-–—]~р')}', 1), '')) AS num FROM n), g AS (SELECT *, regexp_replace(regexp_replace(num, '{_W}', '', 'g'), '[–—]', '-', 'g') AS p FROM f)
   SELECT kind, id, CASE WHEN day <> '' THEN regexp_extract(day, '{_DAY_SQL}', 3) || '-' || lpad(CAST(list_position({_MONTHS_SQL}, regexp_extract(day, '{_DAY_SQL}', 2)) AS VARCHAR), 2, '0') || '-' || lpad(CAST(CAST(regexp_extract(day, '{_DAY_SQL}', 1) AS INT) AS VARCHAR), 2, '0') END AS decision_date,
   CASE WHEN regexp_matches(p, '^[0-9]+$') THEN p || '-р' ELSE p END AS decision_number FROM g""")
def q52_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Day and number at the start of documents and decisions."""
    docs = table(spark, sf, "documents").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.col("source").alias("file"))
    acts = texts(spark, sf).select(F.lit("act").alias("kind"), F.col("rec_id").alias("id"), "text", F.col("source_file").alias("file"))
    return docs.unionByName(acts).select("kind", "id", V.meta(F.col("text"), F.col("file")).alias("m")).select("kind", "id", "m.*")




@query(f"""WITH {_TEXTS}, p AS (SELECT rec_id, law_area, primary_code, classification, {_points_sql('x')} AS pts, {_articles_sql('x')} AS arts, legal_basis FROM t),
   c AS (SELECT *, coalesce('zek:50:' || pts[1], 'unfair:' || arts[1]) AS inferred, CASE WHEN regexp_matches(primary_code, '^(zek:50:(1\\d|2[01]|[1-9])|unfair:(4|5|6|7|8|10|11|13|14|15|15-1|16|17|18|19))$') THEN primary_code END AS annotated FROM p)
   SELECT rec_id, array_to_string(pts, ',') AS points, array_to_string(arts, ',') AS articles, coalesce(inferred, annotated, 'other') AS code, CASE WHEN coalesce(inferred, annotated) LIKE 'zek%' THEN 'economic_competition' WHEN coalesce(inferred, annotated) LIKE 'unfair%' THEN 'unfair_competition' ELSE coalesce(law_area, 'other') END AS family,
   CASE WHEN coalesce(inferred, annotated) LIKE 'zek%' THEN 'п. ' || substr(coalesce(inferred, annotated), 8) || ' ст. 50' WHEN coalesce(inferred, annotated) LIKE 'unfair%' THEN 'ст. ' || substr(coalesce(inferred, annotated), 8) END AS article,
   CASE coalesce(inferred, annotated) WHEN 'zek:50:1' THEN 'п. 1 ст. 50 — антиконкурентні узгоджені дії' WHEN 'zek:50:2' THEN 'п. 2 ст. 50 — зловживання монопольним (домінуючим) становищем' WHEN 'zek:50:4' THEN 'п. 4 ст. 50 — невиконання рішення, попереднього рішення органів АМКУ або їх виконання не в повному обсязі' WHEN 'zek:50:12' THEN 'п. 12 ст. 50 — концентрація без отримання відповідного дозволу органів АМКУ'
     WHEN 'zek:50:13' THEN 'п. 13 ст. 50 — неподання інформації у встановлені строки' WHEN 'zek:50:14' THEN 'п. 14 ст. 50 — подання інформації в неповному обсязі у встановлені строки' WHEN 'zek:50:15' THEN 'п. 15 ст. 50 — подання недостовірної інформації' WHEN 'zek:50:16' THEN 'п. 16 ст. 50 — створення перешкод працівникам АМКУ у проведенні перевірок, огляду, вилученні чи накладенні арешту'
     WHEN 'unfair:4' THEN 'ст. 4 — неправомірне використання позначень' WHEN 'unfair:7' THEN 'ст. 7 — порівняльна реклама' WHEN 'unfair:8' THEN 'ст. 8 — дискредитація суб’єкта господарювання' WHEN 'unfair:15' THEN 'ст. 15 — досягнення неправомірних переваг у конкуренції' WHEN 'unfair:15-1' THEN 'ст. 15-1 — поширення інформації, що вводить в оману' ELSE 'Інше / потребує перевірки' END AS label,
   CASE WHEN law_area = 'unfair_competition' OR regexp_matches(lower(array_to_string(legal_basis, '; ')), '15 *[¹1]') THEN 'ст. 15¹' WHEN regexp_matches(lower(array_to_string(legal_basis, '; ')), '(пункт|п\\.?) *12') THEN 'п. 12 ст. 50' WHEN regexp_matches(lower(array_to_string(legal_basis, '; ')), '(пункт|п\\.?) *13') THEN 'п. 13 ст. 50'
     WHEN regexp_matches(lower(array_to_string(legal_basis, '; ')), '(пункт|п\\.?) *14') THEN 'п. 14 ст. 50' WHEN regexp_matches(lower(array_to_string(legal_basis, '; ')), '(пункт|п\\.?) *4') THEN 'п. 4 ст. 50' WHEN law_area = 'economic_competition' THEN 'Захист економічної конкуренції' ELSE 'Інше / потребує перевірки' END AS badge FROM c""")
def q53_classification(spark: SparkSession, sf: str) -> DataFrame:
    """Norms in whole texts, the code inferred from them over the annotated one, its labels and badge."""
    t = texts(spark, sf).withColumn("x", V.normalize_spaces(F.col("text")))
    t = t.select("rec_id", "law_area", "legal_basis", V.points(F.col("x")).alias("pts"), V.articles(F.col("x")).alias("arts"), "primary_code", V.inferred_code(F.col("x"), F.col("x")).alias("inferred"))
    c = V.classification(F.col("inferred"), F.col("primary_code"), F.col("law_area"), F.col("pts"), F.col("arts"), F.col("legal_basis"))
    t = t.withColumn("c", c)
    return t.select("rec_id", F.array_join("pts", ",").alias("points"), F.array_join("arts", ",").alias("articles"), F.col("c.primary_code").alias("code"), F.col("c.law_family").alias("family"), F.col("c.primary_article").alias("article"), F.col("c.primary_label").alias("label"), V.badge(F.col("law_area"), F.col("legal_basis")).alias("badge"))
