"""Feeds: paged timelines flattened, periods, digests, sector signals, summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.text import WS, trim_all
from lexmill.operators.rules import any_of

ITEM = T.StructType([T.StructField(n, T.StringType()) for n in ("time", "date_from", "title", "url", "source")] + [T.StructField("tags", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))), T.StructField("excerpt", T.StringType())])


def flatten(pages: DataFrame, text: str = "value", page: str = "page") -> DataFrame:
    """Pages of ``day -> items`` as one row for each item, with its place; days that hold no list are skipped."""
    data = F.from_json(F.get_json_object(text, "$.data"), T.MapType(T.StringType(), T.StringType()))
    days = pages.select(page, F.explode(F.map_entries(data)).alias("d"))
    items = days.select(page, F.col("d.key").alias("day"), F.posexplode(F.from_json("d.value", T.ArrayType(ITEM))).alias("place", "item"))
    return items.select(page, "day", "place", "item.*").withColumn("tags", F.transform("tags", lambda t: t["name"]))


def period(mode: str, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """``weekly``: Monday to Sunday of the week before; ``monthly``: the month before."""
    if mode == "weekly":
        monday = as_of - dt.timedelta(days=as_of.weekday() + 7)
        return monday, monday + dt.timedelta(days=6)
    if mode == "monthly":
        last = as_of.replace(day=1) - dt.timedelta(days=1)
        return last.replace(day=1), last
    raise ValueError(mode)


def rolling(rows: DataFrame, key: str, at: str, span: int, aggregates: list[Column], names: list[str], per_task: int = 60) -> DataFrame:
    """Rows with aggregates over the last ``span`` (microseconds, exclusive) of their key, themselves included.

    Time is cut into pieces of ``per_task`` spans; a row near the end of a piece is seen by the next one as well, so a key of any size is split over
    many tasks and no window reaches beyond its piece.
    """
    piece = F.floor(F.col(at) / (span * per_task))
    near_end = F.col(at) - piece * (span * per_task) > span * (per_task - 1)
    both = rows.withColumn("_piece", F.explode(F.when(near_end, F.array(piece, piece + 1)).otherwise(F.array(piece)))).withColumn("_own", F.col("_piece") == piece)
    w = Window.partitionBy(key, "_piece").orderBy(at).rangeBetween(-(span - 1), 0)
    return both.select("*", *[a.over(w).alias(n) for a, n in zip(aggregates, names)]).filter("_own").drop("_piece", "_own")


def week_key(at: Column) -> Column:
    """``weekly:monday:sunday`` of a time: the key of its digest."""
    monday = F.date_trunc("week", at).cast("date")
    return F.concat_ws(":", F.lit("weekly"), F.date_format(monday, "yyyy-MM-dd"), F.date_format(F.date_add(monday, 6), "yyyy-MM-dd"))


def summary(text: Column, cues: list[str], least: int = 80, most: int = 900) -> Column:
    """The first paragraph over ``least`` characters with a cue, else the first that long, cut at ``most``."""
    paragraphs = F.filter(F.transform(F.split(text, r"\n+"), trim_all), lambda p: F.length(p) > least)
    cued = F.filter(paragraphs, lambda p: F.lower(p).rlike("|".join(cues)))
    return F.substring(F.coalesce(F.get(cued, F.lit(0)), F.get(paragraphs, F.lit(0)), F.lit("")), 1, most)


def case_numbers(text: Column) -> Column:
    """Case numbers of announcements (``№ 127-26.4/116-26``), those after the word for a case first, dashes made one, without repeats."""
    t = F.translate(text, "–—", "--")
    number = rf"№{WS}*(\d{{2,4}}-\d{{1,3}}(?:\.\d{{1,3}})?/\d{{1,4}}-\d{{2}})"
    return F.array_distinct(F.concat(*[F.regexp_extract_all(t, F.lit("(?iu)" + p), F.lit(1)) for p in (f"справ[аи]{WS}*" + number, number)]))


#: The two laws that announcements name, and what is said where none is named.
ECONOMIC_LAW, UNFAIR_LAW, NOT_NAMED = "Закон України «Про захист економічної конкуренції»", "Закон України «Про захист від недобросовісної конкуренції»", "Не зазначено в повідомленні"


def qualification(text: Column) -> Column:
    """``law, article, point, text`` that an announcement names: a point of the article on violations, else an article on unfair competition, else nothing."""
    law = lambda words: f"{WS}+".join(["Закону", "України", "«?Про", "захист", *words]) + "»?"
    first = lambda p: F.regexp_extract(text, "(?iu)" + p, 1)
    eco, unf = law(["економічної", "конкуренції"]), law(["від", "недобросовісної", "конкуренції"])
    points = [first(rf"пункт(?:ом|у)?{WS}*(\d{{1,2}}){WS}+статті{WS}*50{WS}+{eco}"), first(rf"п\.?{WS}*(\d{{1,2}}){WS}*ст\.?{WS}*50{WS}+{eco}")]
    point = F.coalesce(*[F.when(p != "", p) for p in points])
    raw = first(rf"статт(?:і|ею|я){WS}*(15{WS}*[-–—]?{WS}*1|15{WS}*¹|\d{{1,2}}){WS}+{unf}")
    article = F.regexp_replace(F.translate(F.regexp_replace(raw, WS, ""), "–—", "--"), "¹", "-1")
    of = lambda law_name: F.regexp_replace(F.lit(law_name), "^Закон ", " Закону ")
    none = F.lit(None).cast("string")
    by_point = F.struct(F.lit(ECONOMIC_LAW).alias("law"), F.lit("ст. 50").alias("article"), F.concat(F.lit("п. "), point).alias("point"), F.concat(F.lit("п. "), point, F.lit(" ст. 50"), of(ECONOMIC_LAW)).alias("text"))
    by_article = F.struct(F.lit(UNFAIR_LAW).alias("law"), F.concat(F.lit("ст. "), article).alias("article"), none.alias("point"), F.concat(F.lit("ст. "), article, of(UNFAIR_LAW)).alias("text"))
    nothing = F.struct(none.alias("law"), none.alias("article"), none.alias("point"), F.lit(NOT_NAMED).alias("text"))
    return F.when(point.isNotNull(), by_point).when(article != "", by_article).otherwise(nothing)


#: Words of announcements about medicines; two of them count only inside or beside a word of ASCII letters and digits.
SECTOR_WORDS = ["фармац", "лікарськ", "препарат", "аптек", "медичн", "медвироб", "дієтичн", "добавк"]
SECTOR_EDGES = ["фарма(?=[A-Za-z0-9_])", "(?<=[A-Za-z0-9_])бад(?=[A-Za-z0-9_])"]
SECTOR_PHRASES = [("вироб[аи]", "медичного", "призначення"), ("активн[іи]", "фармацевтичн[іи]", "інгредієнт")]


def sector_signal(text: Column) -> Column:
    """A text speaks of medicines. (Longer phrases with a word of the list are covered by the word.)"""
    return any_of(text, [*SECTOR_WORDS, *SECTOR_EDGES, *[f"{WS}+".join(p) for p in SECTOR_PHRASES]])
