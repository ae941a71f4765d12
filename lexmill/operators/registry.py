"""The registry of court challenges: merging years, status precedence, overrides, decisive events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Status codes by precedence: the first that any case has is the status of the decision.
PRECEDENCE = ["ongoing", "overturned", "partially_overturned", "upheld"]
FINAL = PRECEDENCE[1:]


def merge(existing: DataFrame, incoming: DataFrame, keys: list[str], fresh: Column, years: str = "source_years", updated: str = "updated_at") -> DataFrame:
    """Full outer merge: all fields of the fresher side (the incoming one on a tie), the union of years sorted, the latest update."""
    rest = [c for c in existing.columns if c not in keys]
    both = existing.withColumn("_in", F.lit(0)).unionByName(incoming.withColumn("_in", F.lit(1)))
    g = both.groupBy(*keys).agg(
        F.max_by(F.struct(*[c for c in rest if c not in (years, updated)]), F.struct(fresh, F.col("_in"))).alias("_b"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(years)))).alias(years),
        F.max(updated).alias(updated),
    )
    return g.select(*keys, "_b.*", years, updated)


def rank(status: Column) -> Column:
    out = F.lit(len(PRECEDENCE))
    for i in reversed(range(len(PRECEDENCE))):
        out = F.when(status == PRECEDENCE[i], i).otherwise(out)
    return out


def decisions(cases: DataFrame, decision: str, case: str, status: str, fresh: Column) -> DataFrame:
    """``decision, display_status, primary_case, cases_count``: precedence over all cases, the freshest case that has that status."""
    r = rank(F.col(status))
    g = cases.groupBy(decision).agg(
        F.min(F.struct(r.alias("r"), F.col(status).alias("s"))).alias("_s"),
        *[F.max_by(F.when(F.col(status) == s, F.col(case)), F.when(F.col(status) == s, fresh)).alias(f"_c{i}") for i, s in enumerate(PRECEDENCE)],
        F.count("*").alias("cases_count"),
    )
    primary = F.coalesce(*[F.when(F.col("_s.r") == i, F.col(f"_c{i}")) for i in range(len(PRECEDENCE))])
    return g.select(decision, F.col("_s.s").alias("display_status"), primary.alias("primary_case"), "cases_count")


def override(rows: DataFrame, patches: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows whose key has a patch take its columns; patches without a row change nothing. Broadcast is left to the optimizer, by size."""
    p = patches.select(*keys, *[F.col(c).alias(f"_p_{c}") for c in columns], F.lit(True).alias("_hit"))
    out = rows.join(p, keys, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.col(f"_p_{c}"), F.col(c)))
    return out.withColumn("overridden", F.coalesce("_hit", F.lit(False))).drop("_hit", *[f"_p_{c}" for c in columns])


def first_decisive(events: DataFrame, keys: list[str], order: Column, decisive: Column, columns: list[str]) -> DataFrame:
    """The newest decisive event of each key (null columns if it has none): what a walk from newest to oldest would stop at."""
    g = events.groupBy(*keys).agg(F.max_by(F.when(decisive, F.struct(*columns)), F.when(decisive, order)).alias("_e"), F.count("*").alias("events"))
    return g.select(*keys, "_e.*", "events")


def label(status: Column, detail: Column, labels: dict[str, str], returned: str) -> Column:
    """Label of a status; an open case whose detail tells of sending it for a new hearing has a label of its own."""
    d = F.lower(detail)
    sent = (status == "ongoing") & d.contains("направ") & d.contains("нов") & d.contains("розгляд")
    table = F.create_map(*[F.lit(x) for p in labels.items() for x in p])
    return F.when(F.coalesce(sent, F.lit(False)), returned).otherwise(F.coalesce(F.try_element_at(table, status), status))
