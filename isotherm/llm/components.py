"""Connected components of a link table by alternating large-star and small-star rounds.

Each round is two aggregates (map-side minima, so a hub is never gathered) and two joins on the
node, which AQE may split; rounds are cut by reliable checkpoints.  The number of rounds grows
with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import cut


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r.n, r.s


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has a link to another; ``root`` is the component's least node."""
    edges = cut(links.where(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = _fingerprint(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        # large star: every larger neighbour of x is tied to the least node around x
        around = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = around.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = (around.where("y > x").join(least, "x")
                 .select(F.col("y").alias("u"), F.col("m").alias("v")).distinct())
        # small star: every smaller neighbour of u, and u itself, is tied to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = cut(small)
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
