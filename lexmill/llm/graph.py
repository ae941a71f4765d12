"""Connected components of a link table, for links that are far fewer than rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links``; ``root`` is the least node of its component.

    Alternates large-star and small-star steps (logarithmically many rounds) until a round changes
    nothing. Each round is written to the shared folder, so lineage stays short and a lost executor
    costs no recomputation; only a count per round reaches the driver. Null ends are no links; loops and
    repeated links change nothing; no links give no rows.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges = written(edges, "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: each greater neighbour goes to the least of the node and its neighbours
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        # small star: each neighbour that is less, and the node, goes to the least
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        edges = written(edges, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return star.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
