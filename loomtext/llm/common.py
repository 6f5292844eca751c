"""Shared pieces of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.sources.scratch import Scratch, shared_dir
from loomtext.sources.tables import load as table

__all__ = ["SPACES", "Scratch", "ascii_lower", "fresh", "let", "shared_dir", "table", "words"]

#: ASCII white space of the operators' word definition: space, TAB, LF, VT, FF, CR.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[ \t-\r]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body) -> Column:
    """Bind ``value`` once and evaluate ``body`` on it.

    A plain column that a higher-order function reads may be inlined into the lambda by the
    optimizer and evaluated per element; a lambda variable is evaluated once.
    """
    return F.transform(F.array(value), body).getItem(0)


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null and blank text give an empty array."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN, -1)
    )


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, so that every engine agrees on the result."""
    return F.translate(text, UPPER, UPPER.lower())


def fresh(taken, base: str) -> str:
    """A column name that clashes with none of ``taken`` (case-insensitively)."""
    lowered = {c.lower() for c in taken}
    name, n = base, 0
    while name.lower() in lowered:
        n += 1
        name = f"{base}_{n}"
    return name
