"""Connected components of an undirected graph as Spark joins (large-star / small-star).

Every step is a ``min`` aggregate (map-side combined) and an equi-join, so a hub
with a third of all links is neither gathered in one task nor sent to the
driver.  The edges shrink to one star per component; every round is written to the
shared folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import staged


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(low, "u").filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = (down.join(low, "u").filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return rest.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; component is the smallest node reachable.

    ``edges`` has two columns of one orderable integer type.  Self links and NULLs
    are ignored; an empty table gives an empty result.  Ends when a round leaves
    the links as they were (a fingerprint of the links is compared).
    """
    u, v = edges.columns
    e = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u <> v").distinct()
    e = staged(e, "edges")
    mark = None
    while True:
        now = e.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == mark or not now["n"]:
            break
        mark = now
        e = staged(_small_star(_large_star(e)), "stars")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select("v", "v").distinct()))
