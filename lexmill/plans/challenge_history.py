"""History of court challenges from the monthly registry snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.chars import CYRILLIC_ALIKE, LATIN_ALIKE, plain_spaces, to_cyrillic, to_latin
from lexmill.functions.registry_text import clean_case_number
from lexmill.operators.history import Satellite, SatelliteTable, observations
from lexmill.session import table

#: The clean label and code pairs; the first label of a code stands for a null label.
LABELS = {
    "Оскарження триває": "ongoing",
    "Справу направлено на новий розгляд": "ongoing",
    "Рішення АМКУ залишено чинним": "upheld",
    "Рішення АМКУ скасовано": "overturned",
    "Рішення АМКУ скасовано частково": "partially_overturned",
}


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for p in pairs.items() for x in p])


def status_and_label(code: Column, label: Column) -> tuple[Column, Column]:
    """Clean code and label; each fills a null of the other. Unknown codes and labels stay, in their plain form."""
    fold = str.maketrans(LATIN_ALIKE, CYRILLIC_ALIKE)
    known = _literal_map({k.translate(fold).lower(): k for k in LABELS})
    code_of = _literal_map(LABELS)
    first = {}
    for k, v in LABELS.items():
        first.setdefault(v, k)
    plain_label = F.regexp_replace(plain_spaces(label), r"[\s.]+$", "")
    plain_label = F.when(plain_label != "", plain_label)
    c = F.regexp_replace(F.lower(to_latin(plain_spaces(code))), r"[\s-]+", "_")
    c = F.when(c != "", c)
    lab = F.coalesce(F.try_element_at(known, F.lower(to_cyrillic(plain_label))), plain_label)
    return F.coalesce(c, F.try_element_at(code_of, lab)), F.coalesce(lab, F.try_element_at(_literal_map(first), c))




def status_satellite() -> Satellite:
    """The attributes that change together and often."""
    code, label = status_and_label(F.col("status"), F.col("status_label"))
    return Satellite("status", {"status": code, "status_label": label})


def challenger_satellite() -> Satellite:
    """The attribute that hardly ever changes."""
    name = plain_spaces(F.col("challenger"))
    return Satellite("challenger", {"challenger": F.when(name != "", name)})


KEYS = ["decision_key", "case_number"]


def observed(snapshots: DataFrame, satellite: Satellite) -> DataFrame:
    keys = {"decision_key": F.col("decision_key"), "case_number": clean_case_number(F.col("case_number"))}
    return observations(snapshots, keys, F.col("snapshot_on"), F.try_to_timestamp(F.col("updated_at")), satellite, [F.col("delivered_at")])


def history(deliveries: list[DataFrame], satellite: Satellite) -> DataFrame:
    """All versions of a satellite's attributes for each challenge, after loading the deliveries one after the other."""
    held = SatelliteTable(deliveries[0].sparkSession)
    for number, d in enumerate(deliveries):
        obs = observed(d, satellite)
        held.load(obs, KEYS, number)
    return held.view(obs, KEYS)


def by_month(snapshots: DataFrame) -> list[DataFrame]:
    """Snapshots in the order of delivery, one part for each month; the first also holds the rows without a date of delivery."""
    month = F.coalesce(F.date_format("delivered_at", "yyyy-MM"), F.lit(""))
    months = sorted(r.m for r in snapshots.select(month.alias("m")).distinct().collect())  # as many as months
    return [snapshots.filter(month == m) for m in months] or [snapshots]


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history([table(spark, sf_dir, "registry_snapshots")], status_satellite())


def p5_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history by one load for each month of delivery."""
    return history(by_month(table(spark, sf_dir, "registry_snapshots")), status_satellite())


def p5_challengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history([table(spark, sf_dir, "registry_snapshots")], challenger_satellite())


def _sql(attributes: dict[str, str], ask: str) -> str:
    from lexmill.functions.chars import SLASHES, digit_pairs, width_pairs

    d, w = digit_pairs(), width_pairs()
    seen = dict(zip(w[0], w[1])) | dict(zip(d[0], d[1])) | {c: "/" for c in SLASHES}
    src, dst = "".join(seen).replace("'", "''"), "".join(seen.values()).replace("'", "''")
    plain = "trim(regexp_replace(regexp_replace({c}, '[\\x{{AD}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}-\\x{{2064}}\\x{{FEFF}}]', '', 'g'), '[\\s\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', ' ', 'g'))"
    case = f"nullif(regexp_extract(regexp_replace(translate(case_number, '{src}', '{dst}'), '[^0-9/]', '', 'g'), '(\\d+/\\d+/\\d+)', 1), '')"
    fold = str.maketrans(LATIN_ALIKE, CYRILLIC_ALIKE)
    label = f"regexp_replace({plain.format(c='status_label')}, '[\\s.]+$', '')"
    known = " ".join(f"WHEN '{k.translate(fold).lower()}' THEN '{k}'" for k in LABELS)
    own = f"CASE lower(translate({label}, '{LATIN_ALIKE}', '{CYRILLIC_ALIKE}')) {known} ELSE nullif({label}, '') END"
    code = f"nullif(regexp_replace(lower(translate({plain.format(c='status')}, '{CYRILLIC_ALIKE}', '{LATIN_ALIKE}')), '[\\s-]+', '_', 'g'), '')"
    first = {}
    for k, v in LABELS.items():
        first.setdefault(v, k)
    from_label = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items())
    from_code = " ".join(f"WHEN '{v}' THEN '{k}'" for v, k in first.items())
    names = ", ".join(attributes)
    exprs = ", ".join(f"{e.format(challenger=plain.format(c='challenger'))} AS {a}" for a, e in attributes.items())
    return f"""WITH c AS (SELECT *, {case} AS cn, {code} AS c0, {own} AS l0 FROM registry_snapshots),
      f AS (SELECT *, coalesce(c0, CASE l0 {from_label} END) AS code, coalesce(l0, CASE c0 {from_code} END) AS label FROM c),
      o AS (SELECT decision_key, cn AS case_number, snapshot_on, try_cast(updated_at AS TIMESTAMPTZ) AS u, delivered_at, {exprs} FROM f WHERE cn IS NOT NULL AND decision_key IS NOT NULL),
      b AS (SELECT * FROM o WHERE {ask} QUALIFY row_number() OVER (PARTITION BY decision_key, case_number, snapshot_on ORDER BY u DESC, delivered_at DESC) = 1),
      h AS (SELECT *, md5(concat_ws(chr(31), {names})) AS hash FROM b),
      v AS (SELECT * FROM h QUALIFY lag(hash) OVER (PARTITION BY decision_key, case_number ORDER BY snapshot_on) IS DISTINCT FROM hash)
      SELECT decision_key, case_number, {names}, strftime(snapshot_on, '%Y-%m-%d') AS valid_from, coalesce(strftime(lead(snapshot_on) OVER (PARTITION BY decision_key, case_number ORDER BY snapshot_on), '%Y-%m-%d'), '9999-12-31') AS valid_to FROM v"""


SQL = {
    "p5_found": _sql({"status": "code", "status_label": "label"}, "coalesce(status, status_label) IS NOT NULL"),
    "p5_appended": _sql({"status": "code", "status_label": "label"}, "coalesce(status, status_label) IS NOT NULL"),
    "p5_challengers": _sql({"challenger": "nullif({challenger}, '')"}, "challenger IS NOT NULL"),
}
