"""Mixing sources to target weights (native).

Sizes are summed per source, targets are shared out by weight with a ceiling of ``max_repeat`` times
the source, and each document is emitted floor(rate) times plus one more time with probability equal
to the rate's fraction, decided by a seeded hash of its id: reruns and retries agree.

Documents are not shuffled: their sizes are summed per source, combined before they are sent. The table of sources
is sorted and summed over all tasks, however many sources there are; it is written to the shared folder and counted;
up to ``broadcast_sources`` rows it is broadcast, beyond that the join is an ordinary one, which AQE can split for a
hot source.

Defined results: null text has size 0; a null source is a source of its own, last in order; sources
without words get target 0 and no copies; repeated rows share their id's decision; a null id is decided
as the text ``null``; an empty table gives an empty table; extra columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, fresh, words

WIDE = "decimal(38,0)"


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of a seeded MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def numbered(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``n``, the place of a source in order of code points, null last, from 0.

    Sources are sorted by range over all tasks; places count up inside a range, from the sum of the ranges before.
    """
    dealt = scratch.put(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "ordered")
    counts = dealt.groupBy("part").agg(F.count("*").alias("k"))
    before = counts.select("part", (F.sum("k").over(W.orderBy("part")) - F.col("k")).alias("before"))  # a row for each range
    place = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return dealt.withColumn("place", place).join(before, "part").select("source", "source_size", (F.col("place") + F.col("before")).alias("n"))


def source_targets(sizes: DataFrame, *, weights=(1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """From (source, source_size): weight, target and rate per source.

    Targets rise with weight until they meet ``max_repeat`` times the source; what is cut off is shared among the rest
    by weight. The share for a unit of weight is found by sharing out again until no further source is capped: every
    round is one combined sum over the sources, and as the sum of targets is concave in that share, rounds are few.
    """
    scratch = Scratch(sizes.sparkSession)
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = numbered(sizes, scratch).select("source", "source_size", F.get(cycle, (F.col("n") % len(weights)).cast("int")).alias("weight"))
    table = scratch.put(weighed, "weighed")
    w, s = F.col("weight").cast("double"), F.col("source_size").cast("double")
    total = lambda x, on: F.sum(F.when(on, x.cast(WIDE)).otherwise(F.lit(0).cast(WIDE))).cast("double")
    num, den, n_capped = 0.0, 1.0, -1
    capped = F.lit(False)
    while True:
        state = table.agg(
            F.count_if(capped).alias("n"), total(F.col("source_size"), F.lit(True)).alias("all_s"), total(F.col("source_size"), capped).alias("cut_s"),
            total(F.col("weight"), F.lit(True)).alias("all_w"), total(F.col("weight"), capped).alias("cut_w"),
        ).first()
        if state["n"] == n_capped or not state["all_w"] or state["all_w"] == state["cut_w"]:
            break
        n_capped, num, den = state["n"], state["all_s"] - max_repeat * state["cut_s"], state["all_w"] - state["cut_w"]
        capped = capped | (w * num > max_repeat * s * den)
    target = F.when(capped | (s == 0), max_repeat * s).otherwise(F.least(w * num / den, max_repeat * s))
    return table.withColumn("target", target).select(
        "source", "source_size", "weight", "target", F.when(s > 0, F.least(F.col("target") / s, F.lit(float(max_repeat)))).otherwise(0.0).alias("rate")
    )


def plan_mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: str = "mix",
    weights=(1, 2, 3),
    max_repeat: int = 3,
    broadcast_sources: int = 100_000,
) -> tuple[DataFrame, dict[str, str]]:
    """The input with one struct column: size, source_size, target, rate and copies; and that column's name."""
    name = fresh(docs.columns, "_mix")
    size = F.size(words(F.col(text_col))).cast("long")
    sums = docs.select(F.col(source_col).alias("source"), size.alias("n")).groupBy("source").agg(F.sum("n").alias("source_size"))
    targets = Scratch(docs.sparkSession).put(source_targets(sums, weights=weights, max_repeat=max_repeat), "targets")
    few = targets.limit(broadcast_sources + 1).count() <= broadcast_sources
    lookup = targets.select(F.col("source").alias(f"{name}_source"), F.struct("source_size", "target", "rate").alias(f"{name}_plan"))
    joined = docs.withColumn(f"{name}_size", size).join(
        F.broadcast(lookup) if few else lookup, F.col(source_col).eqNullSafe(F.col(f"{name}_source")), "left"
    )
    rate = F.col(f"{name}_plan")["rate"]
    copies = F.floor(rate) + (uniform(F.col(id_col), seed) < rate - F.floor(rate)).cast("long")
    out = joined.withColumn(name, F.struct(F.col(f"{name}_size").alias("size"), F.col(f"{name}_plan")["source_size"].alias("source_size"), F.col(f"{name}_plan")["target"].alias("target"), rate.alias("rate"), copies.alias("copies")))
    return out.select(*docs.columns, name), name


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as many times as planned, with ``copy`` counting from 0."""
    planned, name = plan_mix(docs, **options)
    copy = fresh(docs.columns, "copy")
    repeats = F.when(F.col(name)["copies"] > 0, F.sequence(F.lit(0), (F.col(name)["copies"] - 1).cast("int")))
    return planned.withColumn(copy, F.explode(repeats)).select(*docs.columns, copy)
