"""History of changing attributes: insert-only satellites split by change rate, end dates in lead-based views.

A hub row is an entity key. A satellite holds the attributes of one change rate; a row is appended only
when the hash over the attributes differs from that of the row before it, and no row is ever updated.
The period of validity is not stored: the view computes its end as the start of the next version.

Defined results: rows with a null in a key column or in the snapshot column are no versions; rows with no
attribute at all (every attribute null) say nothing and end nothing; of several rows for one key and
snapshot the one with the greatest ``updated`` counts (nulls least; then the greatest by ``tie`` columns,
then by hash, so that the result never depends on row order); repeated rows change nothing; an empty input
gives an empty history; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.session import scratch_path, written

OPEN_END = "9999-12-31"


@dataclass(frozen=True)
class Satellite:
    """Attributes of one change rate. ``attributes``: output name to expression over the snapshot table."""

    name: str
    attributes: dict[str, Column] = field(hash=False)


def hash_diff(columns: list[str]) -> Column:
    """One 64-bit hash that tells nulls from values and neighbours apart."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def observations(snapshots: DataFrame, keys: dict[str, Column], snapshot: Column, updated: Column, satellite: Satellite, tie: list[Column] = ()) -> DataFrame:
    """One row for each key and snapshot: keys, ``_at``, the attributes, ``_hash``, ``_order`` (what decides among several). Map-side combined, so a hot key costs no large task."""
    attrs = list(satellite.attributes)
    rows = snapshots.select(
        *[e.alias(k) for k, e in keys.items()],
        snapshot.alias("_at"),
        updated.alias("_updated"),
        *[e.alias(f"_tie{i}") for i, e in enumerate(tie)],
        *[e.alias(a) for a, e in satellite.attributes.items()],
    )
    for c in [*keys, "_at"]:
        rows = rows.filter(F.col(c).isNotNull())
    rows = rows.filter(F.coalesce(*[F.col(a).cast("string") for a in attrs]).isNotNull()).withColumn("_hash", hash_diff(attrs))
    order = F.struct("_updated", *[f"_tie{i}" for i in range(len(tie))], "_hash")
    best = rows.groupBy(*keys, "_at").agg(F.max_by(F.struct(*attrs, "_hash", order.alias("_order")), order).alias("_best"))
    return best.select(*keys, "_at", "_best.*")


def changed(obs: DataFrame, keys: list[str]) -> DataFrame:
    """The observations that differ from the one before them: the rows of a satellite."""
    w = Window.partitionBy(*keys).orderBy("_at")
    return obs.withColumn("_before", F.lag("_hash").over(w)).filter(~F.col("_hash").eqNullSafe(F.col("_before"))).drop("_before")


def rows_to_append(observed: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to append to a satellite: ``observed`` holds all current observations of some keys, ``stored`` the satellite's valid rows.

    A change that is not stored yet, and a stored row whose observation was corrected. A late row inside a run splits it: then the
    row after it has become a change and is appended as well. No row is updated.
    """
    w = Window.partitionBy(*keys).orderBy("_at")
    now = observed.withColumn("_change", ~F.col("_hash").eqNullSafe(F.lag("_hash").over(w)))
    old = stored.select(*keys, "_at", F.col("_hash").alias("_stored"))
    take = F.when(F.col("_stored").isNull(), F.col("_change")).otherwise(F.col("_stored") != F.col("_hash"))
    return now.join(old, [*keys, "_at"], "left").filter(take).drop("_change", "_stored")


class SatelliteTable:
    """A satellite in a folder: what was observed and the rows of changes, both insert-only, each load after the other.

    A load looks only at the keys that it delivers.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "satellite")

    def _read(self, name: str, like: DataFrame) -> DataFrame:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
        return self.spark.read.schema(like.schema).parquet(f"{self.path}/{name}") if there else like.limit(0)

    @staticmethod
    def _last(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
        rest = [c for c in rows.columns if c not in (*keys, "_at")]
        return rows.groupBy(*keys, "_at").agg(F.max_by(F.struct(*rest), order).alias("_best")).select(*keys, "_at", "_best.*")

    def load(self, delivered: DataFrame, keys: list[str], number: int) -> None:
        """Append a delivery (see :func:`observations`) as load ``number``."""
        new = written(delivered, "delivery")
        seen, rows = self._read("observed", new), self._read("rows", new.drop("_order").withColumn("_load", F.lit(number)))
        touched = new.select(*keys).distinct()
        observed = self._last(seen.join(touched, keys, "left_semi").unionByName(new), keys, F.col("_order")).drop("_order") if number else new.drop("_order")
        stored = self._last(rows.join(touched, keys, "left_semi"), keys, F.col("_load"))
        rows_to_append(observed, stored, keys).withColumn("_load", F.lit(number)).write.mode("append").parquet(f"{self.path}/rows")
        new.write.mode("append").parquet(f"{self.path}/observed")

    def view(self, like: DataFrame, keys: list[str]) -> DataFrame:
        """The versions with their periods; of rows for one snapshot the last loaded is valid."""
        rows = self._read("rows", like.drop("_order").withColumn("_load", F.lit(0)))
        return versions(self._last(rows, keys, F.col("_load")).drop("_load"), keys)


def versions(rows: DataFrame, keys: list[str], end: str = OPEN_END) -> DataFrame:
    """The view over a satellite: ``valid_from``, ``valid_to`` (start of the next version, ``end`` for the last) as strings.

    Rows that repeat the version before them (late appends) are folded into it.
    """
    w = Window.partitionBy(*keys).orderBy("_at")
    own = changed(rows, keys)
    nxt = F.lead("_at").over(w)
    return own.withColumn("valid_from", F.date_format("_at", "yyyy-MM-dd")).withColumn("valid_to", F.coalesce(F.date_format(nxt, "yyyy-MM-dd"), F.lit(end))).drop("_at", "_hash", "_order")
