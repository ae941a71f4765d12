"""Best row of a group, upserts and reconciliation. All combine on the map side (``max_by``/``min_by``): no group is collected or sorted as a whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_best(df: DataFrame, keys: list[str], order: Column, columns: list[str] | None = None) -> DataFrame:
    """One whole row for each key, the one with the greatest ``order``. Rows with a null key make a group of their own."""
    rest = columns or [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_best"))
    return best.select(*keys, "_best.*")


def keep_first(df: DataFrame, keys: list[str], order: Column, columns: list[str] | None = None) -> DataFrame:
    rest = columns or [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_best"))
    return best.select(*keys, "_best.*")


def upsert(base: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Base and changes by key; a change wins over the base, the last of several wins (by ``order``). Rows with a null in their key replace nothing and all stay."""
    both = base.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    columns = base.columns
    return keep_best(both.filter(known), keys, F.struct("_new", order)).select(*columns).unionByName(both.filter(~known).select(*columns))


def last_value_first_place(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Repeated keys: the values of the last row at the place of the first."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_v"), F.min(order).alias(order))
    return g.select(*keys, "_v.*", order)


def reconcile(asked: DataFrame, answers: DataFrame, key: str, order: Column, columns: list[str]) -> DataFrame:
    """Answers to what was asked: unknown keys dropped, the first of repeated answers taken, the unanswered marked."""
    first = keep_first(answers.join(asked.select(key).distinct(), key, "left_semi").select(key, *columns, order.alias("_o")), [key], F.col("_o"), columns)
    got = first.withColumn("_got", F.lit(True))
    return asked.join(got, key, "left").withColumn("outcome", F.when(F.col("_got"), "processed").otherwise("not_processed")).drop("_got")


def seen(base: DataFrame, keys: list[str], at: str) -> DataFrame:
    """First and last sight of each key; updates of two tables merge by ``min``/``max`` again."""
    return base.groupBy(*keys).agg(F.min(at).alias("first_seen_at"), F.max(at).alias("last_seen_at"), F.count("*").alias("times"))


def without_clean(rows: DataFrame, state: DataFrame, key: str, signature: str, version: int) -> DataFrame:
    """Rows that are not done yet: done are those in ``state`` with the version, without errors, not incomplete, and an equal non-empty signature."""
    done = state.filter((F.col("state_version") == version) & (F.col("errors") == 0) & ~F.coalesce(F.col("incomplete"), F.lit(False)) & (F.col("signature") != "")).select(key, "signature")
    return rows.join(done, (rows[key] == done[key]) & (rows[signature] == done["signature"]), "left_anti")


def replace_year(cases: DataFrame, year: int, years: str = "source_years") -> DataFrame:
    """A year taken out of the source years; cases without any year left go."""
    return cases.withColumn(years, F.array_remove(years, year)).filter(F.size(years) > 0)


def with_fallback(primary: DataFrame, fallback: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``primary``, and those of ``fallback`` whose key has no row in it."""
    return primary.unionByName(fallback.join(primary.select(*keys).distinct(), keys, "left_anti"))
