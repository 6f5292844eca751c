"""Many lexicons in one pass over a text.

A chain of ``contains`` reads the text again for every term. ``TermIndex`` puts the terms of any number of lexicons into
one automaton and reads each text once, in Arrow batches; what it gives are the numbers of the terms that occur in named
parts of the text, as short arrays, and labels are worked out from those in the JVM.

Defined results: as of ``contains`` on the same part: a null text gives null arrays, and with them the default labels; an
empty text has no terms; terms may overlap and lie inside each other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import Lexicon

#: Automata of a Python worker by their terms: they outlive a task.
_AUTOMATA: dict[tuple[str, ...], object] = {}


def _automaton(terms: tuple[str, ...]):
    if terms not in _AUTOMATA:
        import ahocorasick

        made = ahocorasick.Automaton()
        for i, t in enumerate(terms):
            made.add_word(t, (i, len(t)))
        made.make_automaton()
        _AUTOMATA[terms] = made
    return _AUTOMATA[terms]


class TermIndex:
    """Terms with numbers; lexicons are sequences of terms, or of (label, terms)."""

    def __init__(self, *lexicons: Sequence):
        terms = dict.fromkeys(t for lexicon in lexicons for t in _terms(lexicon))
        if "" in terms:
            raise ValueError("an empty term is in every text")
        self.terms = tuple(terms)
        self.number = {t: i for i, t in enumerate(self.terms)}

    def scan(self, text: Column, parts: Mapping[str, tuple[Column | int, Column | int | None]]) -> Column:
        """struct of array<int>: for each part (first character, end or None) the numbers of the terms inside it, rising."""
        names, terms, end = list(parts), self.terms, F.length(text)
        bounds = [c for a, b in parts.values() for c in (_int(a), end if b is None else F.least(_int(b), end))]

        @F.pandas_udf(", ".join(f"{n} array<int>" for n in names))
        def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            found = _automaton(terms).iter
            for texts, *at in batches:
                columns = [c.tolist() for c in at]
                rows: list[list] = []
                for i, t in enumerate(texts):
                    if t is None:
                        rows.append([None] * len(names))
                        continue
                    spans = [(columns[2 * k][i], columns[2 * k + 1][i], set()) for k in range(len(names))]
                    for last, (number, length) in found(t):
                        for first, stop, have in spans:
                            if last < stop and last - length + 1 >= first:
                                have.add(number)
                    rows.append([sorted(have) for _, _, have in spans])
                yield pd.DataFrame(rows, columns=names)

        return run(text, *bounds)

    def _numbers(self, terms: Iterable[str]) -> Column:
        return F.array(*[F.lit(self.number[t]) for t in terms])

    def any_of(self, hits: Column, terms: Sequence[str]) -> Column:
        return F.arrays_overlap(hits, self._numbers(terms))

    def count_of(self, hits: Column, terms: Sequence[str]) -> Column:
        """How many of the terms occur; a term that is listed twice counts twice."""
        twice = len(set(terms)) < len(terms)
        if not twice:
            return F.size(F.array_intersect(hits, self._numbers(terms)))
        return F.size(F.filter(self._numbers(terms), lambda n: F.array_contains(hits, n)))

    def found(self, hits: Column, terms: Sequence[str], limit: int | None = None) -> Column:
        """The terms that occur, in the list's order."""
        pairs = F.array(*[F.struct(F.lit(self.number[t]).alias("n"), F.lit(t).alias("t")) for t in terms])
        out = F.transform(F.filter(pairs, lambda p: F.array_contains(hits, p["n"])), lambda p: p["t"])
        return F.slice(out, 1, limit) if limit else out

    def first_label(self, hits: Column, lexicon: Lexicon, default: str | None) -> Column:
        out = None
        for label, terms in lexicon:
            hit = self.any_of(hits, terms)
            out = F.when(hit, label) if out is None else out.when(hit, label)
        return out.otherwise(F.lit(default))

    def labels_found(self, hits: Column, lexicon: Lexicon) -> Column:
        return F.array_compact(F.array(*[F.when(self.any_of(hits, terms), F.lit(label)) for label, terms in lexicon]))

    def best_label(self, hits: Column, lexicon: Lexicon, default: str | None) -> Column:
        """The label with most terms; ties go to the earliest, no hit to the default."""
        scored = [
            F.struct(self.count_of(hits, terms).alias("n"), F.lit(-i).alias("o"), F.lit(label).alias("label"))
            for i, (label, terms) in enumerate(lexicon)
        ]
        best = F.array_max(F.array(*scored))
        return F.when(best["n"] > 0, best["label"]).otherwise(F.lit(default))


def _terms(lexicon: Sequence) -> Iterator[str]:
    for entry in lexicon:
        if isinstance(entry, str):
            yield entry
        else:
            yield from entry[1]


def _int(c: Column | int) -> Column:
    return F.lit(c) if isinstance(c, int) else c.cast("int")
