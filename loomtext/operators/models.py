"""Models in tasks: ordered fallback when loading, and failed rows sent again.

A model is a function of a list of texts and the number of the attempt, from 0, to a list of results, None where a row
failed. It is loaded once in each Python worker, by the first loader that works. Each round is written, so rows that have
a result are never sent again, whatever happens later.

Defined results: a null text is sent as an empty one; what a model answers with None, or raises on for a whole batch, is
sent again, ``retries`` times at most, and then takes the default; rows are independent, so repeated ids are fine; an
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.sources.scratch import durable as written

Model = Callable[[list[str], int], list]
Loader = Callable[[], Model]
#: Loaded models of a Python worker by the name of their family.
_LOADED: dict[str, tuple[int, Model]] = {}


def first_that_loads(family: str, loaders: Sequence[Loader]) -> tuple[int, Model]:
    """(place of the loader, model); kept for the worker. If none works, the last error is raised."""
    if family not in _LOADED:
        error: Exception | None = None
        for place, load in enumerate(loaders):
            try:
                _LOADED[family] = (place, load())
                break
            except Exception as e:  # noqa: BLE001
                error = e
        else:
            raise RuntimeError(f"no model of {family} loads") from error
    return _LOADED[family]


def apply_model(
    df: DataFrame, text: str, out: str, kind: str, *, family: str, loaders: Sequence[Loader], default: Column | None = None, retries: int = 2, batch: int = 64, durable=None
) -> DataFrame:
    """Adds ``out`` (of type ``kind``), ``{out}_attempts`` and ``{out}_model``, the place of the loader that gave it (null: the default)."""
    keep = durable or written(df.sparkSession)
    tries, by = f"{out}_attempts", f"{out}_model"
    wanted = [c for c in df.columns if c not in (out, tries, by)]
    result = f"struct<value:{kind},model:int>"

    def attempt(number: int) -> Callable[[Column], Column]:
        @F.pandas_udf(result)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            place, model = first_that_loads(family, loaders)
            for texts in batches:
                values: list = []
                listed = texts.fillna("").tolist()
                for i in range(0, len(listed), batch):
                    part = listed[i : i + batch]
                    try:
                        got = list(model(part, number))
                    except Exception:  # noqa: BLE001  the rows of this call have failed
                        got = [None] * len(part)
                    if len(got) != len(part):
                        raise ValueError(f"{len(got)} results for {len(part)} texts")
                    values += got
                yield pd.DataFrame({"value": pd.Series(values, dtype=object), "model": [place if v is not None else None for v in values]})

        return lambda c: run(c)

    open_rows, done = df.select(*wanted), None
    for number in range(retries + 1):
        sent = keep(open_rows.withColumn("_r", attempt(number)(F.col(text))))
        last = number == retries
        value = F.coalesce(F.col("_r.value"), default.cast(kind) if default is not None else F.lit(None).cast(kind)) if last else F.col("_r.value")
        kept = sent if last else sent.where("_r.value is not null")
        rows = kept.select(*wanted, value.alias(out), F.lit(number + 1).alias(tries), F.col("_r.model").alias(by))
        done = rows if done is None else done.unionByName(rows)
        open_rows = sent.where("_r.value is null").select(*wanted)
    return done
