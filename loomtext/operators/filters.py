"""Relevance predicates over titles, summaries, texts and addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions import lexicons as L
from loomtext.functions.text import contains_any, count_terms, matches_any


def tax_related(title: Column, summary: Column) -> Column:
    return contains_any(F.lower(F.concat_ws(" ", title, summary)), L.RELEVANCE_TERMS)


def search_quality(title: Column, description: Column, fmt: Column) -> Column:
    """Points: priority format 10 (else 1), 2 for each actionable term, 3 for each specific area."""
    text = F.lower(F.concat_ws(" ", title, description))
    base = F.when(fmt.isin(*L.PRIORITY_FORMATS), 10).otherwise(1)
    return base + count_terms(text, L.ACTIONABLE_TERMS) * 2 + count_terms(text, L.SPECIFIC_AREAS) * 3


def high_quality(title: Column, description: Column, fmt: Column, *, least: int = 3) -> Column:
    allowed = ~fmt.isin(*L.EXCLUDED_FORMATS)
    return tax_related(title, description) & allowed & (search_quality(title, description, fmt) >= least)


def housing_case(title: Column, summary: Column, text: Column) -> Column:
    """Three housing terms, or a core term, in title, summary and the text's first 1,000 characters."""
    window = F.lower(F.concat_ws(" ", title, summary, F.substring(text, 1, 1000)))
    return (count_terms(window, L.HOUSING_CASE_TERMS) >= 3) | contains_any(window, (*L.HOUSING_CORE, "tenant", "lease", "possession order", "property tribunal", "residential property"))


def housing_legislation(title: Column, summary: Column) -> Column:
    text = F.lower(F.concat_ws(" ", title, summary))
    foreign = contains_any(text, L.HOUSING_EXCLUDED) & ~contains_any(text, L.HOUSING_PRIMARY)
    named = contains_any(text, L.HOUSING_ACTS)
    terms = count_terms(text, (*L.HOUSING_PRIMARY, *L.HOUSING_TENANCY, *L.HOUSING_EVICTION, *L.HOUSING_RIGHTS))
    return ~foreign & (named | (terms >= 2) | contains_any(text, (*L.HOUSING_CORE, *L.HOUSING_EVICTION)))


def copyright_related(title: Column, summary: Column) -> Column:
    text = F.lower(F.concat_ws(" ", title, summary))
    return contains_any(text, L.COPYRIGHT_TERMS) | matches_any(text, L.COPYRIGHT_PATTERNS)


def case_url(url: Column, database_paths: list[str]) -> Column:
    return F.endswith(url, F.lit(".html")) & contains_any(url, database_paths)


def valid_host(url: Column, hosts: list[str], prefix: str) -> Column:
    return F.try_parse_url(url, F.lit("HOST")).isin(*hosts) & F.startswith(F.try_parse_url(url, F.lit("PATH")), F.lit(prefix))


def tax_router(source_dir: Column, title: Column, content: Column) -> Column:
    terms = ("hmrc", "tax", "vat", "revenue", "paye")
    return contains_any(F.lower(source_dir), terms) | contains_any(F.lower(F.concat_ws(" ", title, F.substring(content, 1, 1000))), terms)


def min_length(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.where(F.length(col) >= n)


def search_filter(
    chunks: DataFrame, *, area: str | None = None, jurisdiction: str | None = None, min_authority: float = 0.0, as_of: str | None = None
) -> DataFrame:
    """Chunks with authority_weight, area, jurisdiction and effective_date that pass all given conditions."""
    out = chunks.where(F.col("authority_weight") >= min_authority)
    if area is not None:
        out = out.where(F.col("area") == area)
    if jurisdiction is not None:
        out = out.where(F.col("jurisdiction").isin(jurisdiction, "uk_wide"))
    if as_of is not None:
        out = out.where(F.col("effective_date").isNull() | (F.col("effective_date") <= F.lit(as_of).cast("date")))
    return out


def complexity_gate(df: DataFrame, phase_complexity: str) -> DataFrame:
    """Rows of a phase's complexity (missing: basic); the basic phase takes all."""
    if phase_complexity == "basic":
        return df
    return df.where(F.coalesce("complexity", F.lit("basic")) == phase_complexity)


def complete_downloads(files: DataFrame, *, min_bytes: int = 50) -> DataFrame:
    """Items (item, kind, length) with text, metadata and html, of which text and metadata exceed ``min_bytes``."""
    sizes = files.groupBy("item").pivot("kind", ["text", "metadata", "html"]).agg(F.max("length"))
    return sizes.where((F.col("text") > min_bytes) & (F.col("metadata") > min_bytes) & F.col("html").isNotNull()).select("item")
