"""Metrics of predictions against references; each is a column between 0 and 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.functions import lexicons as L
from loomtext.functions.text import count_patterns, count_terms


def _capped(x: Column) -> Column:
    return F.least(F.lit(1.0), x)


def _citations(text: Column) -> Column:
    kinds = (
        (L.NEUTRAL_CITATION_CASED, 0), (L.LAW_REPORT_CASED, 0), (L.TAX_ACT_CASED, 0), (L.SECTION_NUMBER, 0),
    )
    return F.array_distinct(F.concat(*[F.regexp_extract_all(text, F.lit(k), F.lit(g)) for k, g in kinds]))


def citation_recall(prediction: Column, reference: Column) -> Column:
    p, r = _citations(prediction), _citations(reference)
    empty = F.when(F.size(p) == 0, 1.0).otherwise(0.8)
    return F.when(F.size(r) == 0, empty).otherwise(F.size(F.array_intersect(p, r)) / F.greatest(F.size(r), F.lit(1)).cast("double"))


def structure(prediction: Column) -> Column:
    return count_patterns(prediction, L.STRUCTURE_PATTERNS) / 4.0


def hierarchy(prediction: Column) -> Column:
    return _capped(count_patterns(prediction, L.HIERARCHY_PATTERNS) * 0.25)


def coherence(prediction: Column) -> Column:
    return _capped(count_patterns(prediction, L.COHERENCE_PATTERNS) * 0.25)


def formal_language(prediction: Column) -> Column:
    return _capped(count_terms(F.lower(prediction), L.EVALUATION_FORMAL_TERMS) * 0.1)


def citation_style(prediction: Column) -> Column:
    return _capped(count_patterns(prediction, L.STYLE_PATTERNS, ignore_case=False) * 0.33)


def disclaimer(prediction: Column) -> Column:
    return _capped(count_patterns(prediction, L.EVALUATION_DISCLAIMERS) * 0.25)


def word_recall(prediction: Column, reference: Column) -> Column:
    """Share of the reference's distinct words (split at white space) that the prediction has; 0.8 if it has none."""
    ws = lambda t: F.array_distinct(F.filter(F.split(F.lower(t), r"\s+"), lambda x: x != ""))
    p, r = ws(prediction), ws(reference)
    return F.when(F.size(r) == 0, 0.8).otherwise(F.size(F.array_intersect(p, r)) / F.greatest(F.size(r), F.lit(1)).cast("double"))


METRICS = {
    "citation_recall": citation_recall, "structure": structure, "hierarchy": hierarchy, "coherence": coherence,
    "formal_language": formal_language, "citation_style": citation_style, "disclaimer": disclaimer, "word_recall": word_recall,
}


def all_metrics(prediction: Column, reference: Column) -> dict[str, Column]:
    """The eight metrics and their mean, ``overall``."""
    two = ("citation_recall", "word_recall")
    out = {k: f(prediction, reference) if k in two else f(prediction) for k, f in METRICS.items()}
    return out | {"overall": sum(out.values(), F.lit(0.0)) / 8.0}
