"""Numeric scores of documents, references, edges and hits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.functions import lexicons as L
from loomtext.functions.text import count_terms, lookup


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _mean(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.least(F.lit(1.0), _sum(values) / F.size(values))).otherwise(0.0)


def citation_accuracy(cites: Column) -> Column:
    """Mean over citations of 0.3 for a year, 0.3 for a court and 0.4 for a neutral one; 0 if there are none."""
    one = lambda c: F.when(c["year"].isNotNull(), 0.3).otherwise(0.0) + F.when(c["court"].isNotNull(), 0.3).otherwise(0.0) + F.when(c["is_neutral"], 0.4).otherwise(0.0)
    return _mean(F.transform(cites, one))


def content_quality(text: Column) -> Column:
    low = F.lower(text)
    length = F.when(F.length(text) > 1000, 0.3).when(F.length(text) > 500, 0.2).otherwise(0.0)
    sections = F.when(F.contains(low, F.lit("section")), 0.2).otherwise(0.0)
    numbered = F.when(text.rlike(r"\(\d+\)"), 0.2).otherwise(0.0)
    return F.least(F.lit(1.0), length + sections + numbered + F.least(count_terms(low, L.QUALITY_TERMS) * 0.1, F.lit(0.3)))


def _share(present: list[Column]) -> Column:
    total = sum((F.coalesce(p, F.lit(False)).cast("int") for p in present), F.lit(0))
    return total / float(len(present))


def legal_completeness() -> Column:
    """Over the columns of the legal record: six essentials and five more, as a share of eleven."""
    filled = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    known = lambda c, *empty: filled(c) & ~F.col(c).isin(*empty)
    return _share(
        [
            filled("title"), filled("citation"), known("source_type", "unknown"), known("jurisdiction", "unknown"),
            known("legal_area", "general", "unknown"), F.col("authority_level") > 0,
            F.lit(False), F.size("subject_matter") > 0, F.size("keywords") > 0, F.size("citations") > 0,
            F.size("cross_references") > 0,
        ]
    )


def tax_completeness() -> Column:
    """Four essentials and five more, as a share of nine; the general domain does not count."""
    filled = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    return _share(
        [
            filled("title"), F.col("document_type").isNotNull(), filled("tax_domain") & (F.col("tax_domain") != "general"), F.col("authority_level") > 0,
            filled("manual_code"), F.size("legislation_references") > 0, F.size("keywords") > 0, F.size("tax_concepts") > 0, F.size("manual_refs") > 0,
        ]
    )


def reference_accuracy(legislation: Column, manuals: Column) -> Column:
    """Acts 0.5, with section 0.3, with full name 0.2; manuals 0.6 and a name 0.4."""
    acts = F.transform(
        legislation,
        lambda r: F.lit(0.5) + F.when(r["section"].isNotNull(), 0.3).otherwise(0.0) + F.when(r["full_name"].isNotNull(), 0.2).otherwise(0.0),
    )
    books = F.transform(manuals, lambda m: F.lit(0.6) + F.when(m["name"].isNotNull(), 0.4).otherwise(0.0))
    return _mean(F.concat(acts, books))


def edge_strength(context: Column, relation: Column) -> Column:
    low = F.lower(context)
    moved = lookup(relation, L.BASE_STRENGTH, F.lit(0.5)) + (count_terms(low, L.STRENGTH_WORDS) - count_terms(low, L.WEAKNESS_WORDS)) * 0.1
    return F.greatest(F.lit(0.1), F.least(F.lit(1.0), moved))


def court_score(level: Column) -> Column:
    return (F.lit(L.MAX_LEVEL + 1) - level) / float(L.MAX_LEVEL)


def temporal_score(effective: Column, as_of: Column) -> Column:
    years = F.datediff(as_of, effective) / 365.25
    return F.when(effective.isNull(), 0.5).when(years < 5, 1.0).when(years < 15, 0.9).when(years < 30, 0.8).when(years < 50, 0.7).otherwise(0.6)


def authority_score(court: Column, cited: Column, positive: Column, temporal: Column, judicial: Column) -> Column:
    citing = F.when(cited > 0, 0.7 * positive / cited + 0.3 * F.least(cited / 10.0, F.lit(1.0))).otherwise(0.0)
    return 0.4 * court + 0.3 * citing + 0.15 * temporal + 0.15 * judicial


def chunk_authority_weight(level: Column) -> Column:
    """1 / level; 0.1 for level 0, 0.5 where it is unknown."""
    return F.when(level.isNull(), 0.5).when(level == 0, 0.1).otherwise(1.0 / F.nullif(level, F.lit(0)))


def authority_boost(weight: Column) -> Column:
    return 1.0 + weight


def temporal_boost(effective: Column, as_of: Column) -> Column:
    days = F.datediff(as_of, effective)
    return F.when(effective.isNull(), 0.8).when(days < 365, 1.2).when(days < 1825, 1.1).when(days < 3650, 1.0).otherwise(0.9)


def citation_boost(score: Column) -> Column:
    return F.coalesce(1.0 + 0.5 * score, F.lit(1.0))


def query_relevance(terms: Column, title: Column, keywords: Column) -> Column:
    """0.3 for each term in the title, 0.1 for each (term, keyword) pair in which one holds the other; at most 1."""
    low = F.lower(title)
    in_title = F.size(F.filter(terms, lambda t: F.contains(low, F.lower(t)))) * 0.3
    pairs = F.aggregate(
        terms,
        F.lit(0),
        lambda a, t: a + F.size(F.filter(keywords, lambda k: F.contains(F.lower(k), F.lower(t)) | F.contains(F.lower(t), F.lower(k)))),
    )
    return F.least(F.lit(1.0), in_title + pairs * 0.1)


def hit_explanation(authority: Column, temporal: Column, citation: Column) -> Column:
    parts = F.concat_ws(
        "; ",
        F.when(authority > 1.5, "high authority source"), F.when(temporal > 1.0, "recent"), F.when(citation > 1.2, "frequently cited"),
    )
    return F.coalesce(F.nullif(parts, F.lit("")), F.lit("content match"))


def rag_confidence(mean_hit: Column, citations_: Column, compliance: Column, response: Column, wanted: Column, matching: Column) -> Column:
    """Mean of five factors; see ``confidence_band`` for its label."""
    low = F.lower(response)
    concluded = F.contains(low, F.lit("analysis")) | F.contains(low, F.lit("conclusion")) | F.contains(low, F.lit("recommendation"))
    complete = F.when((F.length(response) > 500) & concluded, 0.8).when(F.length(response) > 200, 0.6).otherwise(0.3)
    place = F.when(wanted.isNull(), 0.8).when(matching, 1.0).otherwise(0.5)
    return (mean_hit + citations_ + compliance + complete + place) / 5.0


def confidence_band(score: Column) -> Column:
    return F.when(score > 0.8, "high").when(score > 0.6, "medium").otherwise("low")


def risk_level(risks: Column) -> Column:
    return F.when(F.size(risks) > 3, "high").when(F.size(risks) == 0, "low").otherwise("medium")


def response_citations(response: Column) -> Column:
    """struct<n, score>: citations of four kinds, and 0.8 if there are any, else 0.5."""
    kinds = (L.NEUTRAL_CITATION_CASED, L.LAW_REPORT_CASED, L.TAX_ACT_CASED, L.SECTION_NUMBER)
    n = sum((F.regexp_count(response, F.lit(k)) for k in kinds), F.lit(0))
    return F.struct(n.alias("n"), F.when(n > 0, 0.8).otherwise(0.5).alias("score"))


def income_tax_base(income: Column, pension: Column, allowance: int = 12570) -> Column:
    return F.greatest(F.lit(0), income - pension - allowance)
