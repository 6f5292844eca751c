"""Pandas UDFs that are made when they are used, so that modules import without a session."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow_udf(schema: str):
    """Decorate a function of pandas series; the result takes and returns columns."""

    def wrap(fn):
        @functools.wraps(fn)
        def call(*cols: Column | str) -> Column:
            return F.pandas_udf(fn, schema)(*cols)

        return call

    return wrap
