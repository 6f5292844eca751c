"""Reference extraction by regular expressions, and other text projections."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.udf import arrow_udf
from loomtext.functions import lexicons as L
from loomtext.functions.text import bound, contains_any, content_id, lookup


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def neutral_citations(text: Column) -> Column:
    """array<struct<citation, year, court, level, number>> in text order."""
    found = F.arrays_zip(
        _all(text, L.NEUTRAL_CITATION).alias("citation"), _all(text, L.NEUTRAL_CITATION, 1).alias("year"),
        _all(text, L.NEUTRAL_CITATION, 2).alias("court"), _all(text, L.NEUTRAL_CITATION, 3).alias("number"),
    )
    return F.transform(
        found,
        lambda c: F.struct(
            c["citation"].alias("citation"),
            c["year"].cast("int").alias("year"),
            lookup(F.upper(c["court"]), [(a, n) for a, n, _ in L.COURTS], c["court"]).alias("court"),
            lookup(F.upper(c["court"]), [(a, v) for a, _, v in L.COURTS], F.lit(None).cast("int")).alias("level"),
            c["number"].alias("number"),
        ),
    )


def law_reports(text: Column) -> Column:
    """array<struct<citation, year, volume, report>> in text order."""
    found = F.arrays_zip(
        _all(text, L.LAW_REPORT).alias("citation"), _all(text, L.LAW_REPORT, 1).alias("year"),
        _all(text, L.LAW_REPORT, 2).alias("volume"), _all(text, L.LAW_REPORT, 3).alias("report"),
    )
    return F.transform(
        found,
        lambda c: F.struct(c["citation"].alias("citation"), c["year"].cast("int").alias("year"), c["volume"].alias("volume"), c["report"].alias("report")),
    )


def citations(text: Column) -> Column:
    """Neutral citations, then law reports: array<struct<citation, court, year, number, is_neutral, level>>; no dedupe."""
    kind = "struct<citation:string,court:string,year:int,number:string,is_neutral:boolean,level:int>"
    one = F.transform(
        neutral_citations(text), lambda c: F.struct(c["citation"], c["court"], c["year"], c["number"], F.lit(True), c["level"]).cast(kind)
    )
    two = F.transform(
        law_reports(text), lambda c: F.struct(c["citation"], c["report"], c["year"], c["volume"], F.lit(False), F.lit(None)).cast(kind)
    )
    return F.concat(one, two)


#: The act pattern tried only where a run of letters and white space begins: the same matches, in time linear in the text.
ACT_FROM_RUN_START = r"(?i)(?:^|\G|[^A-Za-z\s])\s*+" + L.ACT_REFERENCE.removeprefix("(?i)")


def statutory_references(text: Column) -> Column:
    """Sorted distinct references to sections, acts, instruments and guidance."""
    tagged = lambda pattern, prefix: F.transform(_all(text, pattern, 1), lambda x: F.concat(F.lit(prefix), x))
    every = F.concat(tagged(L.SECTION_REFERENCE, "Section "), tagged(ACT_FROM_RUN_START, ""), tagged(L.SI_REFERENCE, "SI "), tagged(L.GUIDANCE_REFERENCE, ""))
    return F.array_sort(F.array_distinct(every))


def primary_citation(title: Column, text: Column) -> Column:
    first = F.get(citations(text), 0)["citation"]
    return F.coalesce(first, F.nullif(title, F.lit("")), F.lit("Unknown Citation"))


def manual_references(text: Column) -> Column:
    """array<struct<code, name>>, upper case, no dedupe."""
    codes = F.arrays_zip(_all(text, L.MANUAL_REFERENCE, 1).alias("prefix"), _all(text, L.MANUAL_REFERENCE, 2).alias("rest"))
    return F.transform(
        codes,
        lambda c: F.struct(
            F.upper(F.concat(c["prefix"], c["rest"])).alias("code"),
            lookup(F.upper(c["prefix"]), L.MANUAL_NAMES, F.concat(F.upper(c["prefix"]), F.lit(" Manual"))).alias("name"),
        ),
    )


#: What every case reference holds; a text without it is not searched from each of its words on.
CASE_MARK = r"(?i)[a-z]\s++v\.?\s++[a-z][a-z\s]*+\[\d{4}\]"


def case_references(text: Column) -> Column:
    """Sorted distinct ``A v B [year]``."""

    def named(pattern: str) -> Column:
        # possessive repeats match the same (a single letter v or a bracket is no part of a name) without deep recursion
        pattern = pattern.replace("[a-z]+", "[a-z]++").replace(")*)", ")*+)")
        part = lambda found, n: F.regexp_extract(found, pattern, n)
        return F.transform(_all(text, pattern), lambda m: F.concat(part(m, 1), F.lit(" v "), part(m, 2), F.lit(" ["), part(m, 3), F.lit("]")))

    found = F.array_sort(F.array_distinct(F.concat(named(L.CASE_NAME), named(L.CASE_AGAINST_AUTHORITY))))
    return F.when(text.isNull(), F.lit(None).cast("array<string>")).when(text.rlike(CASE_MARK), found).otherwise(F.array().cast("array<string>"))


#: White space at either end.
EDGE_SPACE = r"(?U)^\s+|\s+$"


def match_spans(text: Column, pattern: str) -> Column:
    """array<struct<first, end, found>>: the matches of a pattern with their places (characters from 0, end not included).

    Places come from the lengths of what lies between and of the matches, each summed up once.
    """
    lengths = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), _all(text, pattern, 0).alias("found"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,end:int,found:string>>").alias("spans"))

    def step(done: Column, x: Column) -> Column:
        first = done["at"] + x["gap"]
        end = first + F.length(x["found"])
        return F.struct(F.coalesce(end, first).alias("at"), F.concat(done["spans"], F.array(F.struct(first.alias("first"), end.alias("end"), x["found"].alias("found")))).alias("spans"))

    spans = F.aggregate(lengths, start, step, lambda done: done["spans"])
    return F.filter(spans, lambda x: x["found"].isNotNull())


def legislation_references(text: Column | str) -> Column:
    """array<struct<act, section, full_name, kind, context>>: acts with the sections within 100 characters of them.

    The first mention of an act without a section near it is a reference to the act itself.
    """
    text = F.col(text) if isinstance(text, str) else text

    def named(x: Column) -> Column:
        near_from = F.greatest(x["first"] - 100, F.lit(0))
        near = F.substring(text, near_from + 1, x["end"] + 100 - near_from)
        return F.struct(F.upper(F.regexp_extract(x["found"], L.TAX_ACT, 1)).alias("act"), near.alias("near"), F.transform(_all(near, L.TAX_SECTION, 1), lambda s: F.concat(F.lit("s."), s)).alias("sections"))

    def refs(hits: Column) -> Column:
        acts = F.transform(hits, lambda h: h["act"])

        def one(h: Column, i: Column, seen: Column) -> Column:
            entry = lambda section, kind: F.struct(
                h["act"].alias("act"), section.alias("section"), lookup(h["act"], L.ACT_NAMES, h["act"]).alias("full_name"), F.lit(kind).alias("kind"), F.regexp_replace(h["near"], EDGE_SPACE, "").alias("context")
            )
            whole = F.array(entry(F.lit(None).cast("string"), "act"))
            return F.when(F.size(h["sections"]) > 0, F.transform(h["sections"], lambda s: entry(s, "section"))).when(F.array_position(seen, h["act"]) == i + 1, whole).otherwise(F.slice(whole, 1, 0))

        return bound(acts, lambda seen: F.flatten(F.transform(hits, lambda h, i: one(h, i, seen))))

    return bound(F.transform(match_spans(F.coalesce(text, F.lit("")), L.TAX_ACT), named), refs)


def manual_code(url: Column, title: Column, content: Column) -> Column:
    """First manual code in the address, else the title, else the first 500 characters."""
    pattern = r"(?i)\b([A-Z]{2,4}\d{5}[A-Z]*)\b"
    found = lambda c: F.nullif(F.upper(F.regexp_extract(c, pattern, 1)), F.lit(""))
    return F.coalesce(found(url), found(title), found(F.substring(content, 1, 500)))


def clean_lines(text: Column) -> Column:
    """Strip lines, cut at double spaces, drop empties, join by line feed."""
    parts = F.flatten(F.transform(F.split(text, "\n"), lambda x: F.split(F.trim(x), "  ")))
    # a lambda, as transform would hand the place of an element to F.trim as the characters to strip
    return F.array_join(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""), "\n")


def api_url(url: Column, base: str) -> Column:
    return F.concat(F.lit(base + "/api/content/"), F.regexp_replace(F.try_parse_url(url, F.lit("PATH")), "^/", ""))


def file_name(url: Column) -> Column:
    """Last path segment with unsafe characters replaced; the whole path if that is empty."""
    path = F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "/+$", "")
    last = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(F.when(last != "", last).otherwise(path), r"[^\w\-_.]", "_")


def act_name(text: Column) -> Column:
    """First of the first ten lines that names an act, regulation or order."""
    lines = F.slice(F.split(text, "\n"), 1, 10)
    hit = F.filter(lines, lambda x: contains_any(F.lower(x), ("act", "regulation", "order")))
    return F.coalesce(F.trim(F.get(hit, 0)), F.lit("UK Legislation"))


def citation_context(content: Column, citation: Column, around: int = 100) -> Column:
    """The first occurrence of the citation with ``around`` characters on both sides."""
    at = F.position(citation, content)
    start = F.greatest(F.lit(1), at - around)
    return F.when(at > 0, F.substring(content, start, at + F.length(citation) + around - start)).otherwise(F.lit(""))


def context_prefix(jurisdiction: Column, area: Column, authority: Column, section: Column) -> Column:
    """``[jurisdiction] [area] [authority:n] [section]``, without what is missing."""
    wrap = lambda c, label="": F.when(c.isNotNull(), F.concat(F.lit("[" + label), c.cast("string"), F.lit("]")))
    return F.concat_ws(" ", wrap(jurisdiction), wrap(area), wrap(authority, "authority:"), wrap(section))


def json_rows(response: Column, schema: str) -> Column:
    """Rows of the first bracketed list in a free text; empty if it does not parse."""
    body = F.regexp_extract(response, r"(?s)\[.*?\]", 0)
    return F.coalesce(F.from_json(body, f"array<{schema}>"), F.array().cast(f"array<{schema}>"))


def amendments(text: Column) -> Column:
    return _all(text, L.AMENDMENT)


def section_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(L.SECTION_START))


def links(html: Column) -> Column:
    """Targets of all anchors, in order."""
    return _all(html, r'<a[^>]+href="([^"]+)"', 1)


def page_title(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1), F.lit(""))


def legal_metadata(docs: DataFrame) -> DataFrame:
    """doc_id, title, content in; the document's extracted record out."""
    from . import classify, score

    title, text = F.col("title"), F.col("content")
    first = docs.select(
        F.col("doc_id"), content_id(text).alias("content_id"), title, text,
        classify.source_type(title, text).alias("source_type"), classify.jurisdiction(title, text).alias("jurisdiction"),
        classify.legal_area(title, text).alias("legal_area"), classify.subject_tags(title, text).alias("subject_matter"),
        classify.legal_keywords(text).alias("keywords"), citations(text).alias("citations"),
        statutory_references(text).alias("cross_references"), F.length(text).alias("document_length"),
        section_count(text).alias("section_count"), amendments(text).alias("amendment_history"),
    )
    lowest = F.array_min(F.transform("citations", lambda c: c["level"]))
    out = first.withColumns(
        {
            "citation": primary_citation(title, text),
            "authority_level": classify.authority_level(F.col("source_type"), lowest),
            "has_amendments": F.size("amendment_history") > 0,
            "citation_accuracy_score": score.citation_accuracy(F.col("citations")),
            "content_quality_score": score.content_quality(text),
        }
    )
    return out.withColumn("completeness_score", score.legal_completeness()).drop("content")


def tax_metadata(docs: DataFrame) -> DataFrame:
    """doc_id, title, url, content in; the tax record out."""
    from . import classify, score

    title, text, url = F.col("title"), F.col("content"), F.col("url")
    first = docs.select(
        F.col("doc_id"), content_id(text).alias("content_id"), title, text,
        classify.tax_document_type(title, url).alias("document_type"), manual_code(url, title, text).alias("manual_code"),
        classify.tax_domain(title, text).alias("tax_domain"), legislation_references(text).alias("legislation_references"),
        case_references(text).alias("case_references"), manual_references(text).alias("manual_refs"),
        F.length(text).alias("document_length"), classify.has_examples(text).alias("has_examples"),
        classify.has_calculations(text).alias("has_calculations"), classify.tax_keywords(text).alias("keywords"),
        classify.tax_concepts(title, text).alias("tax_concepts"),
        *[c.alias(k) for k, c in classify.entity_flags(text).items()],
    )
    out = first.withColumn("authority_level", classify.tax_authority(F.col("document_type"))).withColumn(
        "reference_accuracy_score", score.reference_accuracy(F.col("legislation_references"), F.col("manual_refs"))
    )
    return out.withColumn("completeness_score", score.tax_completeness()).drop("content")


QA_SECTIONS = (
    r"(?ms)^(?:Section|SECTION)\s+\d+.*?(?=^(?:Section|SECTION)\s+\d+|\z)",
    r"(?ms)^\d+\.\s.*?(?=^\d+\.\s|\z)",
    r"(?ms)^\(\d+\)\s.*?(?=^\(\d+\)\s|\z)",
    r"(?ms)^(?:Article|ARTICLE)\s+\d+.*?(?=^(?:Article|ARTICLE)\s+\d+|\z)",
)


def qa_sections(text: Column) -> Column:
    """array<struct<number, text>>: matches of the first form with more than one, else paragraphs (at most 20); those of
    100 characters or less are left out and keep their number."""
    out = None
    name = lambda label: lambda x, i: F.struct(F.concat(F.lit(label), (i + 1).cast("string")).alias("number"), F.btrim(x, F.lit(" \t\n\x0b\x0c\r")).alias("text"))
    long = lambda a: F.filter(a, lambda x: F.length(x["text"]) > 100)
    for pattern in QA_SECTIONS:
        found = _all(text, pattern)
        value = long(F.transform(found, name("")))
        out = F.when(F.size(found) > 1, value) if out is None else out.when(F.size(found) > 1, value)
    return out.otherwise(F.slice(long(F.transform(F.split(text, "\n\n"), name("Para "))), 1, 20))


def call_model(df: DataFrame, prompt: str, fn, out: str = "response") -> DataFrame:
    """Apply an injected text function (a language model) to a prompt column, a batch at a time."""
    schema = df.withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(**{out: [fn(p) for p in b[prompt]]})

    return df.mapInPandas(run, schema)


@arrow_udf("array<string>")
def imported_names(sources: pd.Series) -> pd.Series:
    """Top-level names that a Python source imports, sorted; none if it does not parse."""
    import ast

    def names(source: str | None) -> list[str]:
        try:
            tree = ast.parse(source or "")
        except (SyntaxError, ValueError):
            return []
        found = {a.name.split(".")[0] for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names}
        found |= {n.module.split(".")[0] for n in ast.walk(tree) if isinstance(n, ast.ImportFrom) and n.module and not n.level}
        return sorted(found)

    return sources.map(names)


def third_party_imports(files: DataFrame) -> DataFrame:
    """(name, files) of the modules that sources (path, source) import and that are neither among them nor in the standard library."""
    import sys

    used = files.select("path", F.explode(imported_names("source")).alias("name"))
    own = files.select(F.explode(F.split(F.regexp_replace("path", r"(/__init__)?\.py$", ""), "/")).alias("name"))
    outside = used.where(~F.col("name").isin(*sys.stdlib_module_names)).join(own.distinct(), "name", "left_anti")
    return outside.groupBy("name").agg(F.count("*").alias("files"))
