"""Connected components by alternating large-star and small-star steps
(Kiveris et al., 2014). Every step is one pre-aggregated ``min`` and one join,
so a node with very many links is split by the map-side aggregation and by
AQE's skew join; nothing is gathered per node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence.llm.common import stored

MAX_ROUNDS = 64


def _least(edges: DataFrame) -> DataFrame:
    """u -> the least of u and its linked nodes v."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _digest(edges: DataFrame) -> tuple[int, str]:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], str(row["h"])


def components(links: DataFrame) -> DataFrame:
    """Links (u, v) -> one row (node, root) per linked node, root being the
    least node of its component. Self-links and repeated links are ignored;
    no links give no rows. Only a row count and one sum reach the driver."""
    edges = stored(links.select("u", "v").where("u <> v").distinct(), "links")
    seen = _digest(edges)
    if not seen[0]:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(MAX_ROUNDS):
        edges = stored(_small_star(_large_star(edges)), "stars")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
