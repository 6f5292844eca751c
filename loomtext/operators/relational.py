"""Relational operators beyond plain SQL: as-of, range and salted joins, and windows over events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def as_of_join(left: DataFrame, right: DataFrame, *, on: str, left_time: str, right_time: str, values: list[str], cut: float = 86_400.0) -> DataFrame:
    """Each left row with the latest right row of its key at or before its time (nulls where there is none).

    Both sides are put into one stream for each key and stretch of ``cut`` (seconds of time, or units of a number), and
    the last right row is carried forward inside it; the last one of earlier stretches comes from a table of one row for
    each key and stretch. So a hot key is many tasks, and no pair of rows is ever made.
    """
    struct = lambda cols: F.struct(*[F.col(c) for c in cols])


    def stretch(df: DataFrame, c: str) -> Column:
        is_time = df.schema[c].dataType.simpleString().startswith(("timestamp", "date"))
        return F.floor((F.col(c).cast("timestamp") if is_time else F.col(c)).cast("double") / cut)

    lcols = [c for c in left.columns if c != on]
    a = left.select(F.col(on).alias("_k"), stretch(left, left_time).alias("_b"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), struct(lcols).alias("_l"))
    b = right.select(F.col(on).alias("_k"), stretch(right, right_time).alias("_b"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), struct([right_time, *values]).alias("_r"))
    both = a.unionByName(b, allowMissingColumns=True)
    ends = both.groupBy("_k", "_b").agg(F.max_by("_r", F.when(F.col("_side") == 0, F.col("_t"))).alias("_end"))
    before = F.last("_end", ignorenulls=True).over(W.partitionBy("_k").orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    entering = ends.select(F.col("_k").alias("_ek"), F.col("_b").alias("_eb"), before.alias("_before")).where("_before is not null")
    carried = F.last("_r", ignorenulls=True).over(W.partitionBy("_k", "_b").orderBy("_t", "_side").rowsBetween(W.unboundedPreceding, 0))
    out = both.withColumn("_m", carried).where("_side = 1").join(entering, (F.col("_k") == F.col("_ek")) & (F.col("_b") == F.col("_eb")), "left")
    found = out.withColumn("_m", F.coalesce("_m", "_before"))
    return found.select(F.col("_k").alias(on), *[F.col("_l")[c].alias(c) for c in lcols], *[F.col("_m")[c].alias(f"matched_{c}") for c in (right_time, *values)])


def numbered(df: DataFrame, by: list[str], order: list[Column], name: str, *, durable) -> DataFrame:
    """Adds ``name``, the place of a row in its group in a total order, from 1, also where a group holds most of the rows.

    Rows are sorted by range over all tasks and written; places count up inside a range, from the sum of the group's
    rows in the ranges before, which is one row for each group and range.
    """
    dealt = durable(df.orderBy(*by, *order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy(*by, "_part").agg(F.count("*").alias("k"))
    before = F.sum("k").over(W.partitionBy(*by).orderBy("_part")) - F.col("k")
    start = counts.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)], F.col("_part").alias("_p"), before.alias("_before"))
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_b{i}"))
    place = F.row_number().over(W.partitionBy(*by, "_part").orderBy(*order))
    return dealt.withColumn("_place", place).join(start, same).select(*df.columns, (F.col("_place") + F.col("_before")).alias(name))


def range_join(points: DataFrame, ranges: DataFrame, *, point: str, low: str, high: str, width: float) -> DataFrame:
    """Points within [low, high] of a range, by buckets of ``width``: an equality join on bucket numbers."""
    bucketed = points.withColumn("_b", F.floor(F.col(point) / width))
    spread = ranges.withColumn("_b", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    return bucketed.join(spread, "_b").where((F.col(point) >= F.col(low)) & (F.col(point) <= F.col(high))).drop("_b")


def salted_join(big: DataFrame, small: DataFrame, on: str, *, salts: int = 16, hot: list | None = None) -> DataFrame:
    """Inner join that spreads hot keys (all keys if ``hot`` is None) of the big side over ``salts`` tasks."""
    is_hot = F.lit(True) if hot is None else F.col(on).isin(*hot)
    left = big.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int")).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.withColumn("_salt", F.explode(copies))
    return left.join(right, [on, "_salt"]).drop("_salt")


def sliding_counts(events: DataFrame, *, by: str, time: str, seconds: int) -> DataFrame:
    """Adds ``in_window``: events of the same key in the ``seconds`` up to and including each event."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    span = W.partitionBy(by).orderBy(micros).rangeBetween(-seconds * 1_000_000, 0)
    return events.withColumn("in_window", F.count("*").over(span))


def rate_violations(events: DataFrame, *, by: str, time: str, limit: int, seconds: int) -> DataFrame:
    """Events beyond ``limit`` in a sliding window."""
    return sliding_counts(events, by=by, time=time, seconds=seconds).where(F.col("in_window") > limit)


def tumbling(events: DataFrame, *, time: str, width: str, aggregates: dict[str, Column], by: list[str] | None = None, slide: str | None = None) -> DataFrame:
    """Aggregates over tumbling or sliding windows; batch and streaming alike."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    out = events.groupBy(window.alias("w"), *(by or [])).agg(*[c.alias(k) for k, c in aggregates.items()])
    return out.select(F.col("w")["start"].alias("window_start"), F.col("w")["end"].alias("window_end"), *(by or []), *aggregates)


def sessions(events: DataFrame, *, by: str, time: str, gap: str) -> DataFrame:
    out = events.groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count("*").alias("n"))
    return out.select(by, F.col("w")["start"].alias("session_start"), F.col("w")["end"].alias("session_end"), "n")
