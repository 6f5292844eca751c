"""Column helpers of the text operators. "Contains" means a substring of the lower-cased text, not a word."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Lexicon = Sequence[tuple[str, Sequence[str]]]


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])


def count_terms(text: Column, terms: Sequence[str]) -> Column:
    """How many of the terms occur at least once."""
    return reduce(lambda a, b: a + b, [F.contains(text, F.lit(t)).cast("int") for t in terms])


def count_patterns(text: Column, patterns: Sequence[str], *, ignore_case: bool = True) -> Column:
    flag = "(?i)" if ignore_case else ""
    return reduce(lambda a, b: a + b, [text.rlike(flag + p).cast("int") for p in patterns])


def matches_any(text: Column, patterns: Sequence[str], *, ignore_case: bool = True) -> Column:
    flag = "(?i)" if ignore_case else ""
    return reduce(lambda a, b: a | b, [text.rlike(flag + p) for p in patterns])


def terms_found(text: Column, terms: Sequence[str], limit: int | None = None) -> Column:
    """The terms that occur, in the list's order."""
    found = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(t)), F.lit(t)) for t in terms]))
    return F.slice(found, 1, limit) if limit else found


def first_label(text: Column, lexicon: Lexicon, default: str | None) -> Column:
    """The first label with any of its terms."""
    out = None
    for label, terms in lexicon:
        hit = contains_any(text, terms)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.lit(default))


def labels_found(text: Column, lexicon: Lexicon) -> Column:
    """All labels with any of their terms, in order."""
    return F.array_compact(F.array(*[F.when(contains_any(text, terms), F.lit(label)) for label, terms in lexicon]))


def best_label(text: Column, lexicon: Lexicon, default: str | None) -> Column:
    """The label with most terms; ties go to the earliest, no hit to the default."""
    scored = F.array(
        *[
            F.struct(count_terms(text, terms).alias("n"), F.lit(-i).alias("o"), F.lit(label).alias("label"))
            for i, (label, terms) in enumerate(lexicon)
        ]
    )
    best = F.array_max(scored)
    return F.when(best["n"] > 0, best["label"]).otherwise(F.lit(default))


def bound(value: Column, body) -> Column:
    """Evaluate ``value`` once and ``body`` on it."""
    return F.transform(F.array(value), body).getItem(0)


def opening(title: Column, text: Column, n: int) -> Column:
    """Lower-cased title and first ``n`` characters."""
    return F.lower(F.concat(title, F.lit(" "), F.substring(text, 1, n)))


def content_id(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the parts put together."""
    joined = parts[0] if len(parts) == 1 else F.concat(*parts)
    return F.substring(F.sha2(joined, 256), 1, 16)


def lookup(key: Column, pairs: Sequence[tuple], default: Column) -> Column:
    """A CASE over (key, value) pairs."""
    out = None
    for k, v in pairs:
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out.otherwise(default)
