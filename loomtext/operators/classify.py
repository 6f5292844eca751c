"""Lexicon classifiers: text columns in, label columns out. All are projections without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.functions import lexicons as L
from loomtext.functions.text import (
    best_label,
    bound,
    contains_any,
    count_terms,
    first_label,
    labels_found,
    lookup,
    matches_any,
    opening,
    terms_found,
)


def source_type(title: Column, text: Column) -> Column:
    """Ordered rules on the title; the text counts for statutory instruments only."""
    t, body = F.lower(title), F.lower(text)
    early = first_label(t, L.SOURCE_TYPE_TITLE_RULES, None)
    late = first_label(t, L.SOURCE_TYPE_LATE_RULES, "commentary")
    return F.coalesce(early, F.when(contains_any(body, L.SI_TERMS), "statutory_instrument"), late)


def jurisdiction(title: Column, text: Column) -> Column:
    return first_label(opening(title, text, 1000), L.JURISDICTIONS, "england_wales")


def legal_area(title: Column, text: Column) -> Column:
    return first_label(opening(title, text, 2000), L.LEGAL_AREAS, "general")


def legal_keywords(text: Column) -> Column:
    return terms_found(F.lower(text), L.LEGAL_KEYWORDS, 10)


def subject_tags(title: Column, text: Column) -> Column:
    return labels_found(opening(title, text, 1000), L.SUBJECTS)


def authority_level(kind: Column, lowest_cited: Column) -> Column:
    """1 is the highest. For cases the best level cited, 8 where none is known."""
    return (
        F.when(kind == "statute", 1)
        .when(kind.isin("regulation", "statutory_instrument"), 2)
        .when(kind == "case", F.coalesce(lowest_cited, F.lit(L.MAX_LEVEL)))
        .when(kind == "hmrc_guidance", 3)
        .otherwise(7)
    )


def tax_document_type(title: Column, url: Column) -> Column:
    t, u = F.lower(title), F.lower(url)
    has = lambda col, *terms: contains_any(col, terms)
    return (
        F.when(has(t, "manual") | has(u, "/hmrc-internal-manuals/"), "internal_manual")
        .when(has(t, "revenue and customs brief") | has(u, "brief"), "revenue_and_customs_brief")
        .when(has(t, "technical note"), "technical_note")
        .when(has(t, "consultation") | has(u, "consultation"), "consultation")
        .when(has(t, "policy paper"), "policy_paper")
        .when(has(t, "form", "return", "p45", "p46", "p60"), "form")
        .when(has(t, "bulletin"), "bulletin")
        .otherwise("guidance")
    )


def tax_authority(document_type: Column) -> Column:
    levels = (("internal_manual", 4), ("revenue_and_customs_brief", 6), ("technical_note", 7), ("guidance", 5), ("practice_note", 5))
    return lookup(document_type, levels, F.lit(9))


def tax_domain(title: Column, text: Column) -> Column:
    return bound(opening(title, text, 2000), lambda low: best_label(low, L.TAX_DOMAINS, "general"))


def entity_flags(text: Column) -> dict[str, Column]:
    low = F.lower(text)
    return {f"affects_{name}": contains_any(low, terms) for name, terms in L.ENTITIES}


def tax_concepts(title: Column, text: Column) -> Column:
    return bound(opening(title, text, 3000), lambda low: labels_found(low, L.TAX_CONCEPTS))


def has_examples(text: Column) -> Column:
    return contains_any(F.lower(text), L.EXAMPLE_TERMS)


def has_calculations(text: Column) -> Column:
    """Case-sensitive by definition."""
    return contains_any(text, L.CALCULATION_TERMS)


def tax_keywords(text: Column) -> Column:
    return bound(F.lower(text), lambda low: terms_found(low, L.TAX_TERMS, 15))


def housing_category(text: Column) -> Column:
    low = F.lower(text)
    return F.coalesce(best_label(low, L.HOUSING_CATEGORIES, None), first_label(low, L.HOUSING_FALLBACKS, "tenant_rights"))


def housing_url_category(url: Column) -> Column:
    return first_label(F.lower(url), [(label, (term,)) for label, term in L.HOUSING_URL_CATEGORIES], "Other Housing Legislation")


def key_concepts(text: Column) -> Column:
    return F.array_sort(terms_found(F.lower(text), L.KEY_CONCEPTS))


def relationship_type(context: Column, *, mode: str = "pattern") -> Column:
    """Ordered patterns; ``mode="literal"`` gives the default for every context."""
    if mode == "literal":
        return F.lit("considers")
    low, out = F.lower(context), None
    for name, patterns in L.RELATIONSHIPS:
        hit = matches_any(low, patterns)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("considers")


def mentioned_jurisdictions(text: Column) -> Column:
    return F.array_sort(labels_found(F.lower(text), L.MENTIONED_JURISDICTIONS))


def significance(score: Column) -> Column:
    return F.when(score > 0.8, "very high").when(score > 0.7, "high").when(score > 0.6, "significant").when(score > 0.4, "moderate").otherwise("limited")


def prompt_type(query_text: Column, area: Column) -> Column:
    """Which of the three answer templates a question takes."""
    low = F.lower(query_text)
    return (
        F.when((area == "tax") | contains_any(low, ("tax", "hmrc", "vat", "compliance")), "tax_compliance")
        .when(contains_any(low, ("argue", "counter", "opposing", "challenge", "defend")), "adversarial")
        .otherwise("legal_analysis")
    )


def reasoning_type(query_text: Column, area: Column) -> Column:
    low = F.lower(query_text)
    return F.when((area == "tax") | contains_any(low, ("tax", "hmrc")), "tax_analysis").when(
        contains_any(low, ("litigation", "court", "dispute")), "litigation_analysis"
    ).otherwise("legal_analysis")


def area_consistent(text: Column, area: Column) -> Column:
    """True where the area has no check list, or the text holds one of its terms."""
    low, out = F.lower(text), None
    for name, terms in L.AREA_CHECKS:
        hit = contains_any(low, terms)
        out = F.when(F.lower(area) == name, hit) if out is None else out.when(F.lower(area) == name, hit)
    return out.otherwise(F.lit(True))


#: Licence names and phrases (fixed values).
LICENSE_NAMES = (
    ("mit license", "MIT"), ("mit", "MIT"), ("apache license 2.0", "Apache-2.0"), ("apache 2.0", "Apache-2.0"),
    ("apache software license", "Apache-2.0"), ("bsd license", "BSD"), ("bsd-3-clause", "BSD-3-Clause"),
    ("gnu general public license v3.0", "GPL-3.0"), ("gpl-3.0", "GPL-3.0"), ("mozilla public license 2.0", "MPL-2.0"),
)
LICENSE_FUZZY = (
    ("Apache-2.0", ("apache",)), ("BSD-3-Clause", ("bsd-3", "3-clause")), ("BSD-2-Clause", ("bsd-2", "2-clause")),
    ("BSD", ("bsd",)), ("LGPL", ("lgpl", "lesser general public")), ("AGPL", ("agpl", "affero")),
    ("GPL", ("gpl", "gnu general public")), ("MPL-2.0", ("mozilla", "mpl")), ("MIT", ("mit",)),
)
LICENSE_TEXTS = (
    ("MIT", ("permission is hereby granted, free of charge", "without warranty of any kind")),
    ("Apache-2.0", ("apache license", "version 2.0")),
    ("AGPL-3.0", ("gnu affero general public license",)),
    ("LGPL-3.0", ("gnu lesser general public license",)),
    ("GPL-3.0", ("gnu general public license", "version 3")),
    ("GPL-2.0", ("gnu general public license", "version 2")),
    ("BSD-3-Clause", ("redistribution and use in source and binary forms", "neither the name")),
    ("BSD-2-Clause", ("redistribution and use in source and binary forms",)),
    ("MPL-2.0", ("mozilla public license",)),
    ("CC0-1.0", ("cc0", "public domain")),
    ("CC-BY", ("creative commons", "attribution")),
)


def license_name(name: Column) -> Column:
    """Exact names first, then the first fuzzy rule; otherwise the name as it is."""
    low = F.lower(F.trim(name))
    return F.coalesce(lookup(low, LICENSE_NAMES, F.lit(None)), first_label(low, LICENSE_FUZZY, None), name)


def license_of_text(text: Column) -> Column:
    """The first licence all of whose phrases occur."""
    low, out = F.lower(text), None
    for label, phrases in LICENSE_TEXTS:
        hit = count_terms(low, phrases) == len(phrases)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.lit(None))


def licenses_agree(one: Column, other: Column) -> Column:
    """Same normalised name, or one is missing."""
    return F.coalesce(license_name(one) == license_name(other), F.lit(True))
