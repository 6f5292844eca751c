"""Approximate aggregates as states that are stored for each part of a table and merged later.

A state is a sketch: distinct values (HLL), quantiles (KLL), frequent items (top k). States of parts, days or batches are
written as ordinary columns; merging them gives the state of the whole, so that old parts are never read again and a
part that changes is replaced alone.

Defined results: nulls count for nothing; a key whose values are all null has 0 distinct values, a null quantile and no
items; an empty table has no states; the error of a merged state is that of one state over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of a distinct state (relative error about 1.04 / sqrt(2^k)) and size of a quantile state.
LOG_REGISTERS, QUANTILE_SIZE, ITEMS = 12, 400, 1000


def states(df: DataFrame, by: list[str], *, distinct: dict[str, str] | None = None, quantiles: dict[str, str] | None = None, frequent: dict[str, str] | None = None, items: int = ITEMS) -> DataFrame:
    """One row for each key: rows, and a state for each named column of ``distinct``, ``quantiles`` and ``frequent``."""
    made = [F.count("*").alias("rows")]
    made += [F.hll_sketch_agg(c, LOG_REGISTERS).alias(name) for name, c in (distinct or {}).items()]
    made += [F.kll_sketch_agg_double(F.col(c).cast("double"), QUANTILE_SIZE).alias(name) for name, c in (quantiles or {}).items()]
    made += [F.expr(f"approx_top_k_accumulate(`{c}`, {items})").alias(name) for name, c in (frequent or {}).items()]
    return df.groupBy(*by).agg(*made)


def merged(parts: DataFrame, by: list[str], *, distinct: list[str] = (), quantiles: list[str] = (), frequent: list[str] = (), items: int = ITEMS) -> DataFrame:
    """States of coarser keys from stored ones."""
    made = [F.sum("rows").alias("rows")]
    made += [F.hll_union_agg(c).alias(c) for c in distinct]
    made += [F.kll_merge_agg_double(c, QUANTILE_SIZE).alias(c) for c in quantiles]
    made += [F.expr(f"approx_top_k_combine(`{c}`, {items})").alias(c) for c in frequent]
    return parts.groupBy(*by).agg(*made)


def distinct_of(state: str) -> Column:
    return F.hll_sketch_estimate(state)


def quantile_of(state: str, share: float) -> Column:
    """The value at a share of the rows; null where there are none."""
    n = F.kll_sketch_get_n_double(state)
    return F.when(n > 0, F.kll_sketch_get_quantile_double(F.when(n > 0, F.col(state)), F.lit(share)))


def top_of(state: str, k: int) -> Column:
    """array<struct<item, count>>, most frequent first."""
    return F.expr(f"approx_top_k_estimate(`{state}`, {k})")
