"""Top-k, keep-first, latest-wins and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark prunes to n rows a group and task before the shuffle."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key: the first in order. A combined minimum, so hot keys are reduced before the shuffle."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r"))
    return best.select(key, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def latest(df: DataFrame, key: str, version: str) -> DataFrame:
    """One row for each key: the last version (upsert)."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r"))
    return best.select(key, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def merge_hits(primary: DataFrame, related: DataFrame, *, doc: str = "document_id", score: str = "score") -> DataFrame:
    """Primary hits before related ones, one row for each document, best score first."""
    both = primary.withColumn("_src", F.lit(0)).unionByName(related.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    first = W.partitionBy(doc).orderBy("_src", F.desc(score))
    return both.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_src").orderBy(F.desc(score), doc)


def pending(found: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return found.join(done.select(key).distinct(), key, "left_anti")


def quota(df: DataFrame, key: str, limit: int, done: int) -> DataFrame:
    """What is left of a limit, in order of the key."""
    return df.orderBy(key).limit(max(limit - done, 0))
