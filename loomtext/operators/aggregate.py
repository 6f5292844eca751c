"""Summaries. Every one is a combined aggregate; several groupings are made in one pass by grouping sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histograms(df: DataFrame, columns: list[str]) -> DataFrame:
    """(dimension, value, n) for several columns in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))


def length_stats(df: DataFrame, by: list[str], text: Column) -> DataFrame:
    n = F.length(text)
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.coalesce(F.avg(n), F.lit(0.0)).alias("avg_length"), F.min(n).alias("min_length"), F.coalesce(F.max(n), F.lit(0)).alias("max_length")
    )


def qa_summary(df: DataFrame) -> DataFrame:
    """question, answer, act, file in; totals and averages out."""
    return df.agg(
        F.count("*").alias("n"), F.countDistinct("act").alias("acts"), F.countDistinct("file").alias("files"),
        F.avg(F.length("question")).alias("avg_question"), F.avg(F.length("answer")).alias("avg_answer"),
    )


def rates(df: DataFrame, by: str, ok: Column) -> DataFrame:
    """Rows, hits and rate for each group and, with a null group, in all."""
    sums = df.groupBy(by, ok.alias("_ok")).agg(F.count("*").alias("c"))
    totals = sums.rollup(by).agg(F.sum("c").alias("n"), F.sum(F.when(F.col("_ok"), F.col("c")).otherwise(0)).alias("hits"))
    return totals.withColumn("rate", F.col("hits") / F.col("n"))


def reconcile(expected: DataFrame, found: DataFrame, key: str, size: str, *, min_size: int = 50) -> DataFrame:
    """expected, present, missing, unexpected and corrupted counts of two lists."""
    both = expected.select(key, F.lit(1).alias("e")).join(found.select(key, F.col(size).alias("s"), F.lit(1).alias("f")), key, "full")
    return both.agg(
        F.count("e").alias("expected"), F.count_if(F.col("e").isNotNull() & F.col("f").isNotNull()).alias("present"),
        F.count_if(F.col("f").isNull()).alias("missing"), F.count_if(F.col("e").isNull()).alias("unexpected"),
        F.count_if(F.col("s") < min_size).alias("corrupted"),
    )


def term_frequency(df: DataFrame, text: Column, terms: list[str]) -> DataFrame:
    """(term, n): documents that contain each term; one pass, summed before the shuffle."""
    low = F.lower(text)
    found = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in terms]))
    return df.select(F.explode(found).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def resolve_licenses(df: DataFrame) -> DataFrame:
    """name, source, license, text in; for each name the longest text if all agree on the licence, else the best source."""
    priority = F.when(F.col("source") == "local", 0).when(F.col("source") == "pypi", 1).when(F.col("source") == "github_api", 2).otherwise(3)
    best = df.groupBy("name").agg(
        F.countDistinct("license").alias("kinds"), F.max_by("license", F.length("text")).alias("a"), F.max_by("text", F.length("text")).alias("ta"),
        F.min_by("license", priority).alias("b"), F.min_by("text", priority).alias("tb"),
    )
    one = F.col("kinds") <= 1
    return best.select("name", F.when(one, F.col("a")).otherwise(F.col("b")).alias("license"), F.when(one, F.col("ta")).otherwise(F.col("tb")).alias("text"))


def training_config(counts: DataFrame) -> DataFrame:
    """(specialist, phase, n) in; epochs and batch size by the number of training rows."""
    n = F.col("n")
    return counts.select(
        "specialist", "phase", "n",
        F.when(n < 100, 5).when(n < 1000, 3).otherwise(2).alias("epochs"), F.when(n < 100, 2).when(n < 1000, 4).otherwise(8).alias("batch_size"),
    )


def citation_analysis(hits: DataFrame) -> DataFrame:
    """(dimension, value, n) of hits by level, jurisdiction and area, and the landmarks (score above 0.8, boost above 1.2)."""
    marked = hits.withColumn("landmark", F.when((F.col("score") > 0.8) & (F.col("citation_boost") > 1.2), F.col("title")))
    return histograms(marked, ["authority_level", "jurisdiction", "area", "landmark"]).where("value is not null")


def run_statistics(runs: DataFrame) -> DataFrame:
    """Means and success rate (score above 0.6) over runs, by query type and in all."""
    return runs.rollup("query_type").agg(
        F.count("*").alias("n"), F.avg("score").alias("avg_score"), F.avg("n_authorities").alias("avg_authorities"), F.avg((F.col("score") > 0.6).cast("int")).alias("success_rate")
    )


def corpus_summary(docs: DataFrame) -> DataFrame:
    """One pass over tax records: counts by domain, type and level as rows, and the four conditional totals."""
    counts = histograms(docs, ["tax_domain", "document_type", "authority_level"])
    flags = docs.agg(*[F.count_if(F.col(c)).alias(c) for c in ("has_examples", "has_calculations", "affects_individuals", "affects_companies")])
    long = flags.select(F.explode(F.array(*[F.struct(F.lit("total").alias("dimension"), F.lit(c).alias("value"), F.col(c).alias("n")) for c in flags.columns])).alias("p"))
    return counts.unionByName(long.select("p.*"))
