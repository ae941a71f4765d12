"""Queries over feeds, events and documents: flattening, periods, sightings, windows, excerpts; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import best, timeline as L
from lexmill.session import table
from lexmill.streaming.state import run_seen

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, len(json_keys(props)) AS fields FROM events")
def q34_json(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of JSON texts."""
    m = F.from_json("props", "map<string,string>")
    return table(spark, sf, "events").select("event_id", F.element_at(m, "k").alias("k"), F.size(F.map_keys(m)).cast("bigint").alias("fields"))


_ITEMS = """d AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2), i AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY event_type) - 1 AS place FROM d)"""


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """Landed pages of a timeline as JSON texts, one for each month: days with their items, and a day that holds no list."""
    e = table(spark, sf, "events")
    d = e.groupBy(F.col("ts").cast("date").cast("string").alias("day"), "event_type").agg(F.count("*").alias("n"))
    item = F.struct(F.col("event_type").alias("title"), F.concat(F.lit("https://feed.example.invalid/"), "day", F.lit("/"), "event_type", F.lit("/")).alias("url"), F.array(F.struct(F.col("n").cast("string").alias("name"))).alias("tags"))
    days = d.groupBy("day").agg(F.array_sort(F.collect_list(item)).alias("items"))
    months = days.groupBy(F.substring("day", 1, 7).alias("page")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("day", "items")))).alias("data"))
    return months.select("page", F.concat(F.lit('{"current_page": 1, "last_page": 1, "data": '), F.regexp_replace("data", r"\}$", ', "none": "no list"}'), F.lit("}")).alias("value"))


@query(f"WITH {_ITEMS} SELECT substr(day, 1, 7) AS page, day, CAST(place AS INT) AS place, event_type AS title, CAST(n AS VARCHAR) AS tags, 'https://feed.example.invalid/' || day || '/' || event_type AS url_key FROM i")
def q34_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """Landed pages of days and items, one row for each item; days without a list are skipped."""
    return L.flatten(pages(spark, sf)).select("page", "day", "place", "title", F.array_join("tags", ",").alias("tags"), X.url_key(F.col("url")).alias("url_key"))


_CUES = ["штраф", "fine", "порушен"]


@query("""WITH p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\\n+'), lambda x: regexp_replace(x, '^[\\s\\x0B\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]+|[\\s\\x0B\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]+$', '', 'g')), lambda x: length(x) > 80) AS p, regexp_matches(lower(text), 'паливо|пальне|fuel|топлив') AS signal FROM documents WHERE text IS NOT NULL)
  SELECT doc_id, signal, substr(coalesce(list_filter(p, lambda x: regexp_matches(lower(x), 'штраф|fine|порушен'))[1], p[1], ''), 1, 900) AS summary FROM p""")
def q35_signal_and_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A sector signal, and the first telling paragraph as a summary."""
    t = F.col("text")
    return table(spark, sf, "documents").filter(t.isNotNull()).select("doc_id", F.lower(t).rlike("паливо|пальне|fuel|топлив").alias("signal"), L.summary(t, _CUES).alias("summary"))


@query("""SELECT 'weekly:' || strftime(date_trunc('week', ts), '%Y-%m-%d') || ':' || strftime(date_trunc('week', ts) + INTERVAL 6 DAY, '%Y-%m-%d') AS digest, count(*) AS items, count(DISTINCT user_id) AS users FROM events
  WHERE date_trunc('week', ts) <> TIMESTAMP '2024-01-08' GROUP BY 1""")
def q36_digests(spark: SparkSession, sf: str) -> DataFrame:
    """Digests by week, without those already sent."""
    d = table(spark, sf, "events").select(L.week_key(F.col("ts")).alias("digest"), "user_id")
    sent = spark.createDataFrame([("weekly:2024-01-08:2024-01-14",)], "digest string")
    return d.groupBy("digest").agg(F.count("*").alias("items"), F.countDistinct("user_id").alias("users")).join(sent, "digest", "left_anti")


_SEEN = "SELECT user_id, event_type, CAST(min(ts) AS VARCHAR) AS first_seen, CAST(max(ts) AS VARCHAR) AS last_seen, count(*) AS times FROM events GROUP BY 1, 2"


def _texts(df: DataFrame) -> DataFrame:
    at = lambda c: F.regexp_replace(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0*$", "")
    cut = lambda c: F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd HH:mm:ss")).otherwise(at(c))
    return df.select("user_id", "event_type", cut("first_seen_at").alias("first_seen"), cut("last_seen_at").alias("last_seen"), "times")


@query(_SEEN)
def q37_seen(spark: SparkSession, sf: str) -> DataFrame:
    """First and last sight of each key."""
    return _texts(best.seen(table(spark, sf, "events"), ["user_id", "event_type"], "ts"))


@query(_SEEN)
def q44_stream_seen(spark: SparkSession, sf: str) -> DataFrame:
    """The same state by a stream over the files, merged batch by batch."""
    schema = table(spark, sf, "events").schema
    return _texts(run_seen(spark, f"{sf}/events.parquet", schema, ["user_id", "event_type"], "ts"))


@query("""SELECT event_id, count(*) OVER w AS requests, round(sum(value) OVER w, 4) AS tokens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW)""")
def q38_rolling(spark: SparkSession, sf: str) -> DataFrame:
    """Requests and tokens of the last sixty seconds of each user."""
    e = table(spark, sf, "events").select("event_id", "user_id", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return L.rolling(e, "user_id", "us", 60_000_000, [F.count("*"), F.sum("value")], ["requests", "tokens"]).select("event_id", "requests", F.round("tokens", 4).alias("tokens"))


@query("""SELECT doc_id, CASE WHEN length(text) > 1000 THEN substr(text, 1, 700) || chr(10) || chr(10) || '[...]' || chr(10) || chr(10) || right(text, 300) ELSE text END AS fitted, greatest(1, CAST(ceil(length(text) / 2.0) AS INT)) AS estimate FROM documents WHERE text IS NOT NULL""")
def q40_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Long texts cut to their head and tail (the operator's feature), and an estimate of tokens."""
    t = F.col("text")
    return table(spark, sf, "documents").filter(t.isNotNull()).select("doc_id", X.fit(t, 1000).alias("fitted"), X.token_estimate(t).alias("estimate"))


@query("""SELECT source, count(*) AS docs, count(text) AS with_text, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(min(added_at) AS VARCHAR) AS first_added FROM documents GROUP BY 1""")
def q45_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Run report: counters by source."""
    at = F.date_format(F.min("added_at"), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("docs"), F.count("text").alias("with_text"), F.sum(F.length("text")).alias("chars"), at.alias("first_added"))
