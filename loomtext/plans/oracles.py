"""Pieces of the ANSI SQL that checks the registered queries on another engine."""

from __future__ import annotations

from collections.abc import Sequence

from loomtext.functions import lexicons as L
from loomtext.sources.tables import LEGAL_CORPUS

CORPUS = "WITH legal_corpus AS (" + LEGAL_CORPUS.replace("{documents}", "documents") + ")"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_of(col: str, terms: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, {quote(t)})" for t in terms) + ")"


def count_of(col: str, terms: Sequence[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({col}, {quote(t)}) AS INTEGER)" for t in terms) + ")"


def matches_of(col: str, patterns: Sequence[str], flag: str = "(?i)") -> str:
    return "(" + " + ".join(f"CAST(regexp_matches({col}, {quote(flag + p)}) AS INTEGER)" for p in patterns) + ")"


def first_of(col: str, lexicon, default: str | None) -> str:
    end = "NULL" if default is None else quote(default)
    return "CASE " + " ".join(f"WHEN {any_of(col, terms)} THEN {quote(label)}" for label, terms in lexicon) + f" ELSE {end} END"


def best_of(col: str, lexicon, default: str | None) -> str:
    """Most terms, ties to the earliest: scores compared in order."""
    scores = [(label, count_of(col, terms)) for label, terms in lexicon]
    top = "greatest(" + ", ".join(s for _, s in scores) + ")"
    end = "NULL" if default is None else quote(default)
    return f"CASE WHEN {top} = 0 THEN {end} " + " ".join(f"WHEN {s} = {top} THEN {quote(label)}" for label, s in scores) + " END"


def found_rows(col: str, terms: Sequence[str], source: str, keep: str) -> str:
    """One row for each term found: keep, term."""
    return " UNION ALL ".join(f"SELECT {keep}, {quote(t)} AS term FROM {source} WHERE contains({col}, {quote(t)})" for t in terms)


def labelled_rows(col: str, lexicon, source: str, keep: str) -> str:
    return " UNION ALL ".join(f"SELECT {keep}, {quote(label)} AS label FROM {source} WHERE {any_of(col, terms)}" for label, terms in lexicon)


def opening(n: int) -> str:
    return f"lower(concat(title, ' ', substr(content, 1, {n})))"


SOURCE_TYPE = (
    f"coalesce({first_of('lower(title)', L.SOURCE_TYPE_TITLE_RULES, None)}, CASE WHEN {any_of('lower(content)', L.SI_TERMS)} "
    f"THEN 'statutory_instrument' END, {first_of('lower(title)', L.SOURCE_TYPE_LATE_RULES, 'commentary')})"
)
