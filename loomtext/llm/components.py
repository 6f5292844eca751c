"""Connected components by alternating large-star and small-star, with DataFrames only.

Each round sends a vertex's neighbours to the smallest one seen, as combined minima and joins that AQE can split;
no neighbourhood is gathered. Rounds are written to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges run from the larger (u) to the smaller (v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch, name: str, *, max_rounds: int = 60) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (u, v) that is not its component's smallest."""
    now = scratch.put(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    sign = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    last = sign(now)
    for n in range(1, max_rounds + 1):
        now = scratch.put(_small_star(_large_star(now)), f"{name}-{n}")
        scratch.drop(f"{name}-{n - 1}")
        new = sign(now)
        if new == last:
            return now.select(F.col("u").alias("v"), F.col("v").alias("root"))
        last = new
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
