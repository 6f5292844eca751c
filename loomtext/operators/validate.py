"""Checks of generated answers: disclaimers, citations, professional standards, ethics, and a weighted verdict."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.udf import arrow_udf
from loomtext.functions import lexicons as L
from loomtext.functions.text import count_patterns, count_terms, lookup, matches_any

from .extract import neutral_citations

DISCLAIMERS = {
    "general_legal": "This text was produced by an AI system for informational purposes only and is not legal advice. "
    "Consult a qualified legal professional about your specific circumstances; it may not reflect the most recent law.",
    "tax_advice": "This text was produced by an AI system for informational purposes only and is not tax advice. "
    "Consult a qualified tax advisor or HMRC about your specific circumstances; it may not reflect the most recent rules.",
    "litigation_advice": "This text was produced by an AI system for informational purposes only. Consult a qualified "
    "solicitor or barrister about your specific circumstances before any proceedings.",
}
AREA_NOTES = {
    "criminal": "Criminal matters call for immediate professional representation.",
    "immigration": "Immigration law changes often; professional advice is essential.",
    "family": "Family matters call for professional guidance and representation.",
    "employment": "Employment disputes may be subject to short time limits; take qualified advice.",
}


def disclaimer_hits(text: Column) -> Column:
    return count_patterns(text, L.DISCLAIMER_PATTERNS)


def has_disclaimer(text: Column) -> Column:
    return disclaimer_hits(text) >= 3


def disclaimer_issues(text: Column, kind: Column) -> Column:
    low = F.lower(text)
    return F.array_compact(
        F.array(
            F.when(~has_disclaimer(text), "too few disclaimer elements"),
            F.when((kind == "tax_advice") & ~(F.contains(low, F.lit("hmrc")) | F.contains(low, F.lit("tax advisor"))), "no tax authority or advisor named"),
            F.when((kind == "litigation_advice") & ~(F.contains(low, F.lit("solicitor")) | F.contains(low, F.lit("barrister"))), "no solicitor or barrister named"),
            *[F.when(text.rlike("(?i)" + p), F.lit(f"overconfident: {p}")) for p in L.OVERCONFIDENT_PATTERNS],
        )
    )


def required_disclaimer(kind: Column, area: Column) -> Column:
    base = lookup(kind, list(DISCLAIMERS.items()), F.lit(DISCLAIMERS["general_legal"]))
    note = lookup(F.lower(area), list(AREA_NOTES.items()), F.lit(None).cast("string"))
    return F.concat_ws("\n\n", base, note)


def citation_accuracy(text: Column, *, this_year: int) -> Column:
    """Valid citations over all of five kinds; 1 if there are none. Only neutral ones can fail, by their year."""
    neutral = neutral_citations(text)
    good = F.size(F.filter(neutral, lambda c: (c["year"] >= 1900) & (c["year"] <= this_year)))
    # the manual pattern is case-sensitive
    kinds = (L.LAW_REPORT_PAGE, L.TAX_ACT, L.SECTION_WITH_PARTS, L.MANUAL_CODE_CASED)
    others = sum((F.regexp_count(text, F.lit(k)) for k in kinds), F.lit(0))
    total = F.size(neutral) + others
    return F.when(total == 0, 1.0).otherwise((good + others) / F.nullif(total, F.lit(0)).cast("double"))


@arrow_udf("array<string>")
def dangling_citations(texts: pd.Series) -> pd.Series:
    """Neutral-looking citations without a context word within 50 characters. Needs match positions."""
    import re

    pattern = re.compile(L.ANY_NEUTRAL_FORM)

    def find(text: str | None) -> list[str]:
        text = text or ""
        near = lambda m: text[max(0, m.start() - 50) : m.end() + 50].lower()
        return [m[0] for m in pattern.finditer(text) if not any(w in near(m) for w in L.CONTEXT_WORDS)]

    return texts.map(find)


def hierarchy_ordered(text: Column) -> Column:
    """True if the levels of the neutral citations never fall from lower to higher courts."""
    levels = F.transform(neutral_citations(text), lambda c: c["level"])
    after = F.slice(levels, F.lit(2), F.size(levels))
    return F.forall(F.zip_with(levels, after, lambda a, b: b.isNull() | (a <= b)), lambda ok: ok)


def professional_issues(text: Column) -> Column:
    low = F.lower(text)
    return F.array_compact(
        F.array(
            *[F.when(text.rlike("(?i)" + p), F.lit(f"wording: {p}")) for p in L.UNPROFESSIONAL_PATTERNS],
            F.when(count_terms(low, L.REASONING_TERMS) < 3, "too few reasoning elements"),
            F.when((F.length(text) > 500) & (count_terms(low, L.FORMAL_TERMS) == 0), "no formal language"),
        )
    )


def ethical(text: Column) -> Column:
    return ~matches_any(F.lower(text), L.UNETHICAL_PATTERNS, ignore_case=False)


def overall_score(disclaimer: Column, citations: Column, standards: Column, ethics: Column, facts: Column) -> Column:
    w = dict(L.COMPLIANCE_WEIGHTS)
    point = lambda ok, low: F.when(ok, 1.0).otherwise(low)
    return point(disclaimer, 0.0) * w["disclaimer"] + citations * w["citations"] + point(standards, 0.5) * w["standards"] + point(ethics, 0.0) * w["ethics"] + point(facts, 0.5) * w["facts"]


def compliance_level(score: Column, critical: Column, high: Column) -> Column:
    return F.when(critical > 0, "non_compliant").when((high > 0) | (score < 0.6), "warning").when(score < 0.8, "requires_review").otherwise("compliant")


def confidence_level(score: Column, violations: Column) -> Column:
    return F.when((score >= 0.8) & (violations == 0), "high").when((score >= 0.6) & (violations <= 2), "medium").when(score >= 0.4, "low").otherwise("uncertain")


def validate(df: DataFrame, text_col: str = "text", *, this_year: int, kind: str = "general_legal") -> DataFrame:
    """Adds struct ``validation``: the five criteria, violations, score, compliance and confidence levels.

    Facts count as consistent here; ``factual_issues`` gives the criterion where there is source metadata.
    """
    t = F.col(text_col)
    violation = lambda name, sev, cond: F.when(cond, F.struct(F.lit(name).alias("violation_type"), F.lit(sev).alias("severity")))
    parts = df.withColumn(
        "_v",
        F.struct(
            has_disclaimer(t).alias("disclaimer"), citation_accuracy(t, this_year=this_year).alias("citations"),
            professional_issues(t).alias("issues"), ethical(t).alias("ethics"),
        ),
    )
    v = F.col("_v")
    issues = F.transform(v["issues"], lambda x: F.struct(F.lit("professional_standards").alias("violation_type"), F.lit("medium").alias("severity")))
    violations = F.concat(
        F.array_compact(F.array(violation("missing_disclaimer", "high", ~v["disclaimer"]), violation("citation_accuracy", "high", v["citations"] < 0.8))), issues
    )
    score = overall_score(v["disclaimer"], v["citations"], F.size(v["issues"]) == 0, v["ethics"], F.lit(True))
    scored = parts.withColumn("_s", F.struct(violations.alias("violations"), score.alias("score")))
    s = F.col("_s")
    high = F.size(F.filter(s["violations"], lambda x: x["severity"] == "high"))
    return scored.withColumn(
        "validation",
        F.struct(
            v["disclaimer"].alias("disclaimer_compliance"), v["citations"].alias("citation_accuracy"),
            (F.size(v["issues"]) == 0).alias("professional_standards"), v["ethics"].alias("ethical_compliance"),
            s["violations"].alias("violations"), s["score"].alias("overall_score"),
            compliance_level(s["score"], F.lit(0), high).alias("compliance_level"),
            confidence_level(s["score"], F.size(s["violations"])).alias("confidence_level"),
        ),
    ).drop("_v", "_s")


def factual_issues(text: Column, area: Column, jurisdiction: Column, mentioned: Column, consistent: Column) -> Column:
    return F.array_compact(
        F.array(
            F.when(area.isNotNull() & ~consistent, "area does not fit the text"),
            F.when(jurisdiction.isNotNull() & (F.size(mentioned) > 0) & ~F.array_contains(mentioned, jurisdiction), "jurisdiction not mentioned"),
        )
    )


def suggestions(validation: Column) -> Column:
    v = validation
    return F.array_distinct(
        F.array_compact(
            F.array(
                F.when(v["citation_accuracy"] < 0.8, "check the form of citations"),
                F.when(~v["professional_standards"], "use more formal structure and language"),
                F.when(~v["disclaimer_compliance"], "add a full disclaimer"),
            )
        )
    )


def auto_fixes(validation: Column, disclaimer: Column) -> Column:
    missing = F.exists(validation["violations"], lambda x: x["violation_type"] == "missing_disclaimer")
    return F.array_compact(F.array(F.when(missing, F.concat(F.lit("Add disclaimer: "), disclaimer))))


def wrapped(response: Column, validation: Column, disclaimer: Column) -> Column:
    """The response with its disclaimer and compliance level."""
    return F.concat_ws("\n\n", response, disclaimer, F.concat(F.lit("Compliance: "), validation["compliance_level"]))
