"""All lexicon classifiers of a document by one pass over its title and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions import lexicons as L
from loomtext.functions.terms import TermIndex

#: The lexicons that are looked up in lower-cased text.
INDEX = TermIndex(
    L.SOURCE_TYPE_TITLE_RULES, L.SOURCE_TYPE_LATE_RULES, L.SI_TERMS, L.JURISDICTIONS, L.LEGAL_AREAS, L.LEGAL_KEYWORDS, L.SUBJECTS,
    L.TAX_DOMAINS, L.TAX_CONCEPTS, L.TAX_TERMS, L.ENTITIES, L.EXAMPLE_TERMS, L.HOUSING_CATEGORIES, L.HOUSING_FALLBACKS,
    L.KEY_CONCEPTS, L.MENTIONED_JURISDICTIONS,
)
HITS = "_hits"


def scan(df: DataFrame, *, title: str = "title", text: str = "content", whole: bool = True) -> DataFrame:
    """Adds ``_hits``: the terms in the title, in the first 1000, 2000 and 3000 characters after it, and in the text.

    Without ``whole`` only the first 3000 characters are read, and the text's part is missing.
    """
    t, body = F.col(title), F.col(text)
    read = body if whole else F.substring(body, 1, 3000)
    joined = F.lower(F.concat(t, F.lit(" "), read))
    size = F.length(F.lower(t))
    opening = lambda n: size + 1 + F.length(F.lower(F.substring(body, 1, n)))
    parts = {"title": (0, size), "first_1000": (0, opening(1000)), "first_2000": (0, opening(2000)), "first_3000": (0, opening(3000))}
    if whole:
        parts["body"] = (size + 1, None)
    return df.withColumn(HITS, INDEX.scan(joined, parts))


def _in(part: str) -> Column:
    return F.col(HITS)[part]


def source_type() -> Column:
    early = INDEX.first_label(_in("title"), L.SOURCE_TYPE_TITLE_RULES, None)
    late = INDEX.first_label(_in("title"), L.SOURCE_TYPE_LATE_RULES, "commentary")
    return F.coalesce(early, F.when(INDEX.any_of(_in("body"), L.SI_TERMS), "statutory_instrument"), late)


def labels() -> dict[str, Column]:
    """The label columns of a scanned table, by name; the same values as the functions of ``classify``."""
    body = _in("body")
    return {
        "legal_area": INDEX.first_label(_in("first_2000"), L.LEGAL_AREAS, "general"),
        "source_type": source_type(),
        "jurisdiction": INDEX.first_label(_in("first_1000"), L.JURISDICTIONS, "england_wales"),
        "tax_domain": INDEX.best_label(_in("first_2000"), L.TAX_DOMAINS, "general"),
        "subject_tags": INDEX.labels_found(_in("first_1000"), L.SUBJECTS),
        "tax_concepts": INDEX.labels_found(_in("first_3000"), L.TAX_CONCEPTS),
        "legal_keywords": INDEX.found(body, L.LEGAL_KEYWORDS, 10),
        "tax_keywords": INDEX.found(body, L.TAX_TERMS, 15),
        "housing_category": F.coalesce(INDEX.best_label(body, L.HOUSING_CATEGORIES, None), INDEX.first_label(body, L.HOUSING_FALLBACKS, "tenant_rights")),
        "key_concepts": F.array_sort(INDEX.found(body, L.KEY_CONCEPTS)),
        "mentioned_jurisdictions": F.array_sort(INDEX.labels_found(body, L.MENTIONED_JURISDICTIONS)),
        "has_examples": INDEX.any_of(body, L.EXAMPLE_TERMS),
        **{f"affects_{name}": INDEX.any_of(body, terms) for name, terms in L.ENTITIES},
    }


def classified(df: DataFrame, names: list[str], *, title: str = "title", text: str = "content") -> DataFrame:
    """Adds the named label columns; the text is read once, however many there are."""
    made = labels()
    return scan(df, title=title, text=text).select(*df.columns, *[made[n].alias(n) for n in names])
