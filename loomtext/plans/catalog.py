"""The registered queries: name, plan, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomtext.functions import lexicons as L
from loomtext.functions.text import content_id
from loomtext.operators import aggregate, chunk, classify, evaluate, extract, filters, generate, graph, lexicon_scan, rank, relational, score, validate, vector
from loomtext.plans import oracles as O
from loomtext.sources import web
from loomtext.sources.scratch import durable
from loomtext.sources.tables import legal_corpus, load
from loomtext.streaming import events as stream_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as a query under its name, with its SQL."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


C = O.CORPUS

# --- classification -------------------------------------------------------------------------------------------


@query(f"{C} SELECT dimension, value, count(*) AS n FROM (SELECT 'legal_area' AS dimension, {O.first_of(O.opening(2000), L.LEGAL_AREAS, 'general')} AS value FROM legal_corpus UNION ALL SELECT 'source_type', {O.SOURCE_TYPE} FROM legal_corpus UNION ALL SELECT 'jurisdiction', {O.first_of(O.opening(1000), L.JURISDICTIONS, 'england_wales')} FROM legal_corpus UNION ALL SELECT 'tax_domain', {O.best_of(O.opening(2000), L.TAX_DOMAINS, 'general')} FROM legal_corpus) GROUP BY dimension, value")
def class_histograms(spark, sf_dir):
    names = ["legal_area", "source_type", "jurisdiction", "tax_domain"]
    return aggregate.histograms(lexicon_scan.classified(legal_corpus(spark, sf_dir).select("title", "content"), names), names)


@query(f"{C} SELECT doc_id, {O.SOURCE_TYPE} AS source_type, {O.first_of(O.opening(1000), L.JURISDICTIONS, 'england_wales')} AS jurisdiction, {O.first_of(O.opening(2000), L.LEGAL_AREAS, 'general')} AS legal_area FROM legal_corpus")
def legal_classes(spark, sf_dir):
    found = lexicon_scan.classified(legal_corpus(spark, sf_dir).select("doc_id", "title", "content"), ["source_type", "jurisdiction", "legal_area"])
    return found.select("doc_id", "source_type", "jurisdiction", "legal_area")


# the document types and their words (fixed values)
_DOCTYPE = (
    "CASE WHEN contains(lower(title), 'manual') THEN 'internal_manual' WHEN contains(lower(title), 'revenue and customs brief') THEN 'revenue_and_customs_brief' "
    "WHEN contains(lower(title), 'technical note') THEN 'technical_note' WHEN contains(lower(title), 'consultation') THEN 'consultation' "
    "WHEN contains(lower(title), 'policy paper') THEN 'policy_paper' WHEN " + O.any_of("lower(title)", ("form", "return", "p45", "p46", "p60")) + " THEN 'form' "
    "WHEN contains(lower(title), 'bulletin') THEN 'bulletin' ELSE 'guidance' END"
)


@query(f"{C}, t AS (SELECT doc_id, {_DOCTYPE} AS document_type, {O.best_of(O.opening(2000), L.TAX_DOMAINS, 'general')} AS tax_domain FROM legal_corpus) SELECT doc_id, document_type, CASE document_type WHEN 'internal_manual' THEN 4 WHEN 'revenue_and_customs_brief' THEN 6 WHEN 'technical_note' THEN 7 WHEN 'guidance' THEN 5 WHEN 'practice_note' THEN 5 ELSE 9 END AS authority, tax_domain FROM t")
def tax_classes(spark, sf_dir):
    kind = classify.tax_document_type(F.col("title"), F.lit(""))
    return legal_corpus(spark, sf_dir).select("doc_id", kind.alias("document_type"), classify.tax_authority(kind).alias("authority"), classify.tax_domain(F.col("title"), F.col("content")).alias("tax_domain"))


@query(f"{C} SELECT doc_id, " + ", ".join(f"{O.any_of('lower(content)', terms)} AS affects_{name}" for name, terms in L.ENTITIES) + f", {O.any_of('lower(content)', L.EXAMPLE_TERMS)} AS has_examples, {O.any_of('content', L.CALCULATION_TERMS)} AS has_calculations FROM legal_corpus")
def entity_flags(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select(
        "doc_id", *[c.alias(k) for k, c in classify.entity_flags(F.col("content")).items()], classify.has_examples(F.col("content")).alias("has_examples"), classify.has_calculations(F.col("content")).alias("has_calculations")
    )


@query(f"{C}, c AS (SELECT doc_id, {O.opening(3000)} AS t FROM legal_corpus) {O.labelled_rows('t', L.TAX_CONCEPTS, 'c', 'doc_id')}")
def tax_concepts_long(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select("doc_id", F.explode(classify.tax_concepts(F.col("title"), F.col("content"))).alias("label"))


@query(f"{C}, c AS (SELECT doc_id, {O.opening(1000)} AS t FROM legal_corpus) {O.labelled_rows('t', L.SUBJECTS, 'c', 'doc_id')}")
def subject_tags_long(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select("doc_id", F.explode(classify.subject_tags(F.col("title"), F.col("content"))).alias("label"))


@query(f"{C}, c AS (SELECT doc_id, lower(content) AS t FROM legal_corpus), f AS (" + " UNION ALL ".join(f"SELECT doc_id, {i} AS o, {O.quote(t)} AS term FROM c WHERE contains(t, {O.quote(t)})" for i, t in enumerate(L.LEGAL_KEYWORDS)) + ") SELECT doc_id, term FROM (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY o) AS k FROM f) WHERE k <= 10")
def legal_keywords_long(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select("doc_id", F.explode(classify.legal_keywords(F.col("content"))).alias("term"))


@query(f"{C}, c AS (SELECT doc_id, lower(content) AS t FROM legal_corpus), f AS (" + " UNION ALL ".join(f"SELECT doc_id, {i} AS o, {O.quote(t)} AS term FROM c WHERE contains(t, {O.quote(t)})" for i, t in enumerate(L.TAX_TERMS)) + ") SELECT doc_id, term FROM (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY o) AS k FROM f) WHERE k <= 15")
def tax_keywords_long(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select("doc_id", F.explode(classify.tax_keywords(F.col("content"))).alias("term"))


@query(f"{C} SELECT doc_id, coalesce({O.best_of('lower(content)', L.HOUSING_CATEGORIES, None)}, {O.first_of('lower(content)', L.HOUSING_FALLBACKS, 'tenant_rights')}) AS category FROM legal_corpus")
def housing_categories(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select("doc_id", classify.housing_category(F.col("content")).alias("category"))


@query(f"SELECT category, count(*) AS n FROM (SELECT {O.first_of('lower(url)', [(a, (b,)) for a, b in L.HOUSING_URL_CATEGORIES], 'Other Housing Legislation')} AS category FROM pages) GROUP BY category")
def housing_url_summary(spark, sf_dir):
    return load(spark, sf_dir, "pages").groupBy(classify.housing_url_category(F.col("url")).alias("category")).agg(F.count("*").alias("n"))


@query(f"{C}, c AS (SELECT doc_id, lower(content) AS t FROM legal_corpus) {O.found_rows('t', L.KEY_CONCEPTS, 'c', 'doc_id')}")
def key_concepts_long(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select("doc_id", F.explode(classify.key_concepts(F.col("content"))).alias("term"))


@query(f"{C}, c AS (SELECT doc_id, lower(content) AS t FROM legal_corpus) {O.labelled_rows('t', L.MENTIONED_JURISDICTIONS, 'c', 'doc_id')}")
def jurisdictions_mentioned(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select("doc_id", F.explode(classify.mentioned_jurisdictions(F.col("content"))).alias("label"))


# --- filters --------------------------------------------------------------------------------------------------

_T = "lower(concat_ws(' ', title, substr(content, 1, 300)))"
_HOUSING_TERMS = (*L.HOUSING_PRIMARY, *L.HOUSING_TENANCY, *L.HOUSING_EVICTION, *L.HOUSING_RIGHTS)
_CORE_CASE = (*L.HOUSING_CORE, "tenant", "lease", "possession order", "property tribunal", "residential property")


@query(
    f"{C}, t AS (SELECT doc_id, {_T} AS t, lower(concat_ws(' ', title, substr(content, 1, 300), substr(content, 1, 1000))) AS w FROM legal_corpus) SELECT doc_id, {O.any_of('t', L.RELEVANCE_TERMS)} AS tax_related, "
    f"({O.count_of('w', L.HOUSING_CASE_TERMS)} >= 3 OR {O.any_of('w', _CORE_CASE)}) AS housing_case, "
    f"(NOT ({O.any_of('t', L.HOUSING_EXCLUDED)} AND NOT {O.any_of('t', L.HOUSING_PRIMARY)}) AND ({O.any_of('t', L.HOUSING_ACTS)} OR {O.count_of('t', _HOUSING_TERMS)} >= 2 OR {O.any_of('t', (*L.HOUSING_CORE, *L.HOUSING_EVICTION))})) AS housing_law, "
    f"({O.any_of('t', L.COPYRIGHT_TERMS)} OR {O.matches_of('t', L.COPYRIGHT_PATTERNS)} > 0) AS copyright_law FROM t"
)
def relevance_flags(spark, sf_dir):
    summary = F.substring(F.col("content"), 1, 300)
    return legal_corpus(spark, sf_dir).select(
        "doc_id", filters.tax_related(F.col("title"), summary).alias("tax_related"), filters.housing_case(F.col("title"), summary, F.col("content")).alias("housing_case"),
        filters.housing_legislation(F.col("title"), summary).alias("housing_law"), filters.copyright_related(F.col("title"), summary).alias("copyright_law"),
    )


_FORMAT = "CASE doc_id % 4 WHEN 0 THEN 'guide' WHEN 1 THEN 'press_release' WHEN 2 THEN 'manual' ELSE 'other' END"
_POINTS = f"(CASE WHEN format IN ('guide', 'detailed_guide', 'manual', 'answer', 'form', 'publication', 'consultation_outcome') THEN 10 ELSE 1 END + {O.count_of('t', L.ACTIONABLE_TERMS)} * 2 + {O.count_of('t', L.SPECIFIC_AREAS)} * 3)"


@query(f"{C}, t AS (SELECT doc_id, {_FORMAT} AS format, {_T} AS t FROM legal_corpus) SELECT doc_id, format, {_POINTS} AS points FROM t WHERE {O.any_of('t', L.RELEVANCE_TERMS)} AND format NOT IN ('press_release', 'news_story', 'speech') AND {_POINTS} >= 3")
def high_quality_results(spark, sf_dir):
    docs = legal_corpus(spark, sf_dir).withColumn("format", F.expr(_FORMAT)).withColumn("summary", F.substring(F.col("content"), 1, 300))
    args = (F.col("title"), F.col("summary"), F.col("format"))
    return docs.where(filters.high_quality(*args)).select("doc_id", "format", filters.search_quality(*args).alias("points"))


# --- extraction -----------------------------------------------------------------------------------------------


@query(f"{C}, m AS (SELECT doc_id, unnest(regexp_extract_all(content, {O.quote(L.NEUTRAL_CITATION)})) AS citation FROM legal_corpus), p AS (SELECT doc_id, citation, upper(regexp_extract(citation, {O.quote(L.NEUTRAL_CITATION)}, 2)) AS abbreviation, CAST(regexp_extract(citation, {O.quote(L.NEUTRAL_CITATION)}, 1) AS INTEGER) AS year FROM m) SELECT doc_id, citation, year, CASE abbreviation " + " ".join(f"WHEN {O.quote(a)} THEN {O.quote(n)}" for a, n, _ in L.COURTS) + " END AS court, CASE abbreviation " + " ".join(f"WHEN {O.quote(a)} THEN {v}" for a, _, v in L.COURTS) + " END AS level FROM p")
def neutral_citations(spark, sf_dir):
    out = legal_corpus(spark, sf_dir).select("doc_id", F.explode(extract.neutral_citations(F.col("content"))).alias("c"))
    return out.select("doc_id", "c.citation", "c.year", "c.court", "c.level")


@query(f"{C}, m AS (SELECT doc_id, unnest(regexp_extract_all(content, {O.quote(L.LAW_REPORT)})) AS citation FROM legal_corpus) SELECT doc_id, citation, CAST(regexp_extract(citation, {O.quote(L.LAW_REPORT)}, 1) AS INTEGER) AS year, regexp_extract(citation, {O.quote(L.LAW_REPORT)}, 3) AS report FROM m")
def law_report_citations(spark, sf_dir):
    out = legal_corpus(spark, sf_dir).select("doc_id", F.explode(extract.law_reports(F.col("content"))).alias("c"))
    return out.select("doc_id", "c.citation", "c.year", "c.report")


@query(f"{C}, r AS (SELECT doc_id, concat('Section ', unnest(regexp_extract_all(content, {O.quote(L.SECTION_REFERENCE)}, 1))) AS reference FROM legal_corpus UNION ALL SELECT doc_id, unnest(regexp_extract_all(content, {O.quote(L.ACT_REFERENCE)}, 1)) FROM legal_corpus UNION ALL SELECT doc_id, concat('SI ', unnest(regexp_extract_all(content, {O.quote(L.SI_REFERENCE)}, 1))) FROM legal_corpus UNION ALL SELECT doc_id, unnest(regexp_extract_all(content, {O.quote(L.GUIDANCE_REFERENCE)}, 1)) FROM legal_corpus) SELECT DISTINCT doc_id, reference FROM r")
def statutory_references(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select("doc_id", F.explode(extract.statutory_references(F.col("content"))).alias("reference"))


@query(f"{C}, m AS (SELECT doc_id, upper(unnest(regexp_extract_all(content, {O.quote(L.MANUAL_REFERENCE)}))) AS code FROM legal_corpus), p AS (SELECT doc_id, code, regexp_extract(code, '^[A-Z]+') AS prefix FROM m) SELECT doc_id, code, CASE prefix " + " ".join(f"WHEN {O.quote(a)} THEN {O.quote(b)}" for a, b in L.MANUAL_NAMES) + " ELSE concat(prefix, ' Manual') END AS name FROM p")
def manual_references(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select("doc_id", F.explode(extract.manual_references(F.col("content"))).alias("m")).select("doc_id", "m.code", "m.name")


@query(
    f"{C}, m AS (SELECT doc_id, content, strpos(content, 'TCGA 1992') AS p FROM legal_corpus), n AS (SELECT doc_id, substr(content, greatest(1, p - 100), p + 109 - greatest(1, p - 100)) AS near FROM m), "
    "s AS (SELECT doc_id, unnest(regexp_extract_all(near, '(?i)\\b(?:section|s\\.|sec\\.|§)\\s*(\\d+(?:\\([A-Za-z0-9]+\\))*(?:[A-Z]*)?)', 1)) AS x FROM n) SELECT doc_id, 'TCGA 1992' AS act, concat('s.', x) AS section, 'Taxation of Chargeable Gains Act 1992' AS full_name, 'section' AS kind FROM s"
)
def legislation_references(spark, sf_dir):
    refs = legal_corpus(spark, sf_dir).select("doc_id", F.explode(extract.legislation_references(F.col("content"))).alias("r"))
    return refs.select("doc_id", "r.act", "r.section", "r.full_name", "r.kind")


@query(f"{C}, t AS (SELECT doc_id, concat('Brown v Smith [', CAST(1990 + doc_id % 30 AS VARCHAR(20)), '] and White v HMRC [2001]. ', content) AS content FROM legal_corpus), m AS (SELECT doc_id, unnest(regexp_extract_all(content, {O.quote(L.CASE_NAME)})) AS f FROM t), n AS (SELECT doc_id, concat(regexp_extract(f, {O.quote(L.CASE_NAME)}, 1), ' v ', regexp_extract(f, {O.quote(L.CASE_NAME)}, 2), ' [', regexp_extract(f, {O.quote(L.CASE_NAME)}, 3), ']') AS reference FROM m) SELECT DISTINCT doc_id, reference FROM n")
def case_references(spark, sf_dir):
    named = F.concat(F.lit("Brown v Smith ["), (1990 + F.col("doc_id") % 30).cast("string"), F.lit("] and White v HMRC [2001]. "), F.col("content"))
    return legal_corpus(spark, sf_dir).select("doc_id", F.explode(extract.case_references(named)).alias("reference"))


@query(f"{C}, m AS (SELECT doc_id, title, regexp_extract(content, {O.quote(L.NEUTRAL_CITATION)}) AS n, regexp_extract(content, {O.quote(L.LAW_REPORT)}) AS l FROM legal_corpus) SELECT doc_id, CASE WHEN n <> '' THEN n WHEN l <> '' THEN l WHEN title <> '' THEN title ELSE 'Unknown Citation' END AS citation FROM m")
def primary_citations(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select("doc_id", extract.primary_citation(F.col("title"), F.col("content")).alias("citation"))


@query("SELECT doc_id, substr(sha256(text), 1, 16) AS content_id FROM documents")
def content_ids(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", content_id(F.col("text")).alias("content_id"))


@query("WITH x AS (SELECT substr(sha256(text), 1, 16) AS content_id, doc_id, lang FROM documents) SELECT content_id, doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY doc_id) AS k FROM x) WHERE k = 1")
def keep_first_by_content(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(content_id(F.col("text")).alias("content_id"), "doc_id", "lang")
    return rank.keep_first(docs, "content_id", "doc_id")


@query("SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages")
def page_titles(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", F.coalesce(extract.page_title(F.col("html")), F.lit("")).alias("title"))


@query("""SELECT page_id, unnest(regexp_extract_all(html, '<a[^>]+href="([^"]+)"', 1)) AS href FROM pages""")
def page_links(spark, sf_dir):
    return web.link_table(load(spark, sf_dir, "pages")).select("page_id", "href")


def _plain_pieces(html: str) -> str:
    """SQL list of the texts between tags, without entities and outer white space."""
    piece = "x"
    for entity, char in (("middot", "'·'"), ("copy", "'©'"), ("quot", "chr(34)"), ("amp", "'&'")):
        piece = f"regexp_replace({piece}, '&{entity};?', {char}, 'g')"
    return f"list_filter(list_transform(string_split_regex(regexp_replace({html}, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '<>', 'g'), '<[^>]*>'), lambda x: trim({piece}, ' ' || chr(9) || chr(10) || chr(13))), lambda y: y <> '')"


_PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"


@query(
    f"WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, array_to_string({_plain_pieces(chr(34) + 'head' + chr(34))}, ' ') AS title, array_to_string({_plain_pieces('body')}, chr(10)) AS content FROM "
    "(SELECT *, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS head, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body FROM pages)) "
    f"SELECT page_id, url, host, title, content, CASE WHEN contains({_PATH}, '/guidance/') THEN 'guidance' WHEN contains({_PATH}, '-manuals/') THEN 'manual' WHEN contains({_PATH}, '/publications/') THEN 'publication' WHEN contains(lower(title), 'form') THEN 'form' ELSE 'page' END AS content_type FROM p"
)
def page_contents(spark, sf_dir):
    return web.pages(load(spark, sf_dir, "pages"))


@query(
    f"WITH p AS (SELECT url, string_split(array_to_string({_plain_pieces('body')}, chr(10)), chr(10)) AS l FROM (SELECT url, regexp_replace(html, '(?s)<title>.*?</title>', '<>', 'g') AS body FROM pages)) "
    "SELECT url, l[1] AS title, array_to_string(l, chr(10)) AS content, array_to_string(l[2:5], ' ') AS summary FROM p"
)
def case_pages(spark, sf_dir):
    return web.case_page(load(spark, sf_dir, "pages"))


@query("SELECT doc_id, array_to_string(list_filter(list_transform(flatten(list_transform(string_split(text, chr(10)), lambda x: string_split(trim(x, ' '), '  '))), lambda y: trim(y, ' ')), lambda z: z <> ''), chr(10)) AS text FROM documents")
def clean_line_texts(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", extract.clean_lines(F.col("text")).alias("text"))


@query("SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages")
def page_hosts(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", F.try_parse_url("url", F.lit("HOST")).alias("host"))


# --- records and scores ---------------------------------------------------------------------------------------


@query()
def legal_records(spark, sf_dir):
    return extract.legal_metadata(legal_corpus(spark, sf_dir))


@query()
def tax_records(spark, sf_dir):
    return extract.tax_metadata(legal_corpus(spark, sf_dir).withColumn("url", F.lit("")))


@query(f"{C} SELECT doc_id, least(1.0, (CASE WHEN length(content) > 1000 THEN 0.3 WHEN length(content) > 500 THEN 0.2 ELSE 0.0 END) + (CASE WHEN contains(lower(content), 'section') THEN 0.2 ELSE 0.0 END) + (CASE WHEN regexp_matches(content, '\\(\\d+\\)') THEN 0.2 ELSE 0.0 END) + least({O.count_of('lower(content)', L.QUALITY_TERMS)} * 0.1, 0.3))::DOUBLE AS quality FROM legal_corpus")
def quality_scores(spark, sf_dir):
    return legal_corpus(spark, sf_dir).select("doc_id", F.round(score.content_quality(F.col("content")), 6).alias("quality"))


@query(f"{C}, k AS (SELECT {O.best_of(O.opening(2000), L.TAX_DOMAINS, 'general')} AS domain, doc_id, length(content) AS n FROM legal_corpus) SELECT domain, docs, avg_length, top_doc FROM (SELECT domain, count(*) OVER (PARTITION BY domain) AS docs, round(avg(n) OVER (PARTITION BY domain), 3) AS avg_length, doc_id AS top_doc, row_number() OVER (PARTITION BY domain ORDER BY n DESC, doc_id) AS r FROM k) WHERE r = 1")
def domain_report(spark, sf_dir):
    """Flagship: documents, average length and longest document of each tax domain."""
    docs = legal_corpus(spark, sf_dir).select("doc_id", classify.tax_domain(F.col("title"), F.col("content")).alias("domain"), F.length(F.col("content")).alias("n"))
    return docs.groupBy("domain").agg(
        F.count("*").alias("docs"), F.round(F.avg("n"), 3).alias("avg_length"), F.min_by("doc_id", F.struct(-F.col("n"), F.col("doc_id"))).alias("top_doc")
    )


# --- citation graph -------------------------------------------------------------------------------------------

_REL = "CASE doc_id % 5 WHEN 0 THEN 'follows' WHEN 1 THEN 'distinguishes' WHEN 2 THEN 'overrules' WHEN 3 THEN 'applies' ELSE 'considers' END"
_BASE = "CASE doc_id % 5 WHEN 0 THEN 1.0 WHEN 1 THEN 0.4 WHEN 2 THEN 1.0 WHEN 3 THEN 0.9 ELSE 0.6 END"
_MOVE = "CASE doc_id % 3 WHEN 0 THEN 0.1 WHEN 1 THEN -0.1 ELSE 0.0 END"
_EDGES = f"e AS (SELECT doc_id AS src, CAST(floor(doc_id / 2.0) AS BIGINT) AS dst, {_REL} AS relation, greatest(0.1, least(1.0, {_BASE} + {_MOVE}))::DOUBLE AS strength FROM documents WHERE doc_id > 0)"
_NODES = "n AS (SELECT doc_id AS id, CAST(1 + doc_id % 4 AS INTEGER) AS level, make_date(CAST(1990 + doc_id % 30 AS INTEGER), 1, 1) AS effective_date FROM documents)"


def _edges(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("doc_id > 0")
    strength = f"cast(greatest(0.1, least(1.0, {_BASE} + {_MOVE})) as double)"
    return docs.select(F.col("doc_id").alias("src"), F.floor(F.col("doc_id") / 2).alias("dst"), F.expr(_REL).alias("relation"), F.expr(strength).alias("strength"))


def _nodes(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), (1 + F.col("doc_id") % 4).cast("int").alias("level"), F.make_date((1990 + F.col("doc_id") % 30).cast("int"), F.lit(1), F.lit(1)).alias("effective_date")
    )


_CITED = f"m AS (SELECT doc_id, content, unnest(regexp_extract_all(content, {O.quote(L.NEUTRAL_CITATION)})) AS citation FROM legal_corpus), x AS (SELECT doc_id, citation, substr(content, greatest(1, strpos(content, citation) - 100), strpos(content, citation) + length(citation) + 100 - greatest(1, strpos(content, citation) - 100)) AS context FROM m)"
_RELATION = "CASE " + " ".join(f"WHEN {O.matches_of('lower(context)', ps)} > 0 THEN {O.quote(n)}" for n, ps in L.RELATIONSHIPS) + " ELSE 'considers' END"
_STRENGTH = f"greatest(0.1, least(1.0, CASE relation WHEN 'follows' THEN 1.0 WHEN 'applies' THEN 0.9 WHEN 'considers' THEN 0.6 WHEN 'distinguishes' THEN 0.4 ELSE 1.0 END + ({O.count_of('lower(context)', L.STRENGTH_WORDS)} - {O.count_of('lower(context)', L.WEAKNESS_WORDS)}) * 0.1))::DOUBLE"


@query(f"{C}, {_CITED}, r AS (SELECT *, {_RELATION} AS relation FROM x) SELECT doc_id AS citing_doc, citation, relation, round({_STRENGTH}, 6) AS strength FROM r")
def citation_edges(spark, sf_dir):
    return graph.edges_from_texts(legal_corpus(spark, sf_dir)).select("citing_doc", "citation", "relation", F.round("strength", 6).alias("strength"))


@query(f"{C}, m AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(content, {O.quote(L.NEUTRAL_CITATION)})) AS citation FROM legal_corpus) SELECT DISTINCT m.doc_id AS citing_doc, c.doc_id AS cited_doc FROM m JOIN legal_corpus c ON m.citation = c.own_citation")
def resolved_citations(spark, sf_dir):
    docs = legal_corpus(spark, sf_dir)
    names = docs.select(F.col("own_citation").alias("citation"), "doc_id")
    return graph.resolved_edges(graph.edges_from_texts(docs), names).select("citing_doc", "cited_doc")


@query(f"WITH {_EDGES} SELECT doc_id AS id, (SELECT count(*) FROM e WHERE e.dst = d.doc_id) AS in_degree, (SELECT count(*) FROM e WHERE e.src = d.doc_id) AS out_degree FROM documents d")
def citation_degrees(spark, sf_dir):
    return graph.degrees(_nodes(spark, sf_dir), _edges(spark, sf_dir))


_SENT = "s AS (SELECT dst AS id, count(*) AS cites, sum(CASE WHEN relation IN ('follows', 'applies') THEN 1.0 WHEN relation IN ('distinguishes', 'overrules') THEN 0.0 ELSE 0.5 END) AS positive, sum(CASE WHEN relation IN ('distinguishes', 'overrules') THEN 1.0 ELSE 0.0 END) AS negative, avg(strength) AS judicial FROM e GROUP BY dst)"
_YEARS = "date_diff('day', effective_date, DATE '2024-01-01') / 365.25"
_SCORED = f"a AS (SELECT n.id, (9 - level) / 8.0 AS court, CASE WHEN {_YEARS} < 5 THEN 1.0 WHEN {_YEARS} < 15 THEN 0.9 WHEN {_YEARS} < 30 THEN 0.8 WHEN {_YEARS} < 50 THEN 0.7 ELSE 0.6 END AS temporal, coalesce(cites, 0) AS cites, coalesce(positive, 0.0) AS positive, coalesce(negative, 0.0) AS negative, coalesce(judicial, 0.0) AS judicial FROM n LEFT JOIN s ON n.id = s.id), f AS (SELECT *, 0.4 * court + 0.3 * (CASE WHEN cites > 0 THEN 0.7 * positive / cites + 0.3 * least(cites / 10.0, 1.0) ELSE 0.0 END) + 0.15 * temporal + 0.15 * judicial AS authority FROM a)"


def _authority(spark, sf_dir):
    return graph.authority(_nodes(spark, sf_dir), _edges(spark, sf_dir), as_of=F.lit("2024-01-01").cast("date"))


@query(f"WITH {_EDGES}, {_NODES}, {_SENT}, {_SCORED} SELECT id, cites, round(authority, 6)::DOUBLE AS authority, round(positive, 3)::DOUBLE AS positive, round(negative, 3)::DOUBLE AS negative FROM f")
def authority_scores(spark, sf_dir):
    return _authority(spark, sf_dir).select("id", "cites", F.round("authority", 6).alias("authority"), F.round("positive", 3).alias("positive"), F.round("negative", 3).alias("negative"))


@query(f"WITH {_EDGES}, {_NODES}, {_SENT}, {_SCORED} SELECT id, cites FROM f WHERE authority >= 0.3 ORDER BY round(authority, 9) DESC, id LIMIT 10")
def precedent_top(spark, sf_dir):
    return graph.precedents(_authority(spark, sf_dir).withColumn("authority", F.round("authority", 9))).select("id", "cites")


@query(f"WITH RECURSIVE {_EDGES}, p(source, node, path) AS (SELECT doc_id, doc_id, CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 100 = 0 AND doc_id > 0 UNION ALL SELECT p.source, e.dst, concat(p.path, ' ', CAST(e.dst AS VARCHAR)) FROM p JOIN e ON e.src = p.node) SELECT source, path FROM p WHERE node = 0")
def citation_path(spark, sf_dir):
    """Shortest citation paths from every hundredth document to document 0."""
    edges = _edges(spark, sf_dir)
    sources = load(spark, sf_dir, "documents").where("doc_id % 100 = 0 and doc_id > 0").select(F.col("doc_id").alias("source"), F.lit(0).cast("long").alias("target"))
    return graph.shortest_paths(edges, sources, durable=durable(spark)).select("source", F.array_join("path", " ").alias("path"))


@query("WITH RECURSIVE w(id, depth) AS (SELECT doc_id, 0 FROM documents WHERE doc_id IN (100, 777) UNION ALL SELECT CAST(floor(id / 2.0) AS BIGINT), depth + 1 FROM w WHERE id > 0 AND depth < 3) SELECT id, min(depth) AS depth FROM w GROUP BY id")
def crawl_within(spark, sf_dir):
    seeds = load(spark, sf_dir, "documents").where(F.col("doc_id").isin(100, 777)).select(F.col("doc_id").alias("id"))
    return web.crawl(_edges(spark, sf_dir), seeds, max_depth=3, durable=durable(spark))


@query()
def page_rank(spark, sf_dir):
    """Until it settles; ``page_rank_rounds`` has the SQL of a fixed number of rounds."""
    return graph.page_rank(_nodes(spark, sf_dir), _edges(spark, sf_dir), tolerance=1e-3, durable=durable(spark)).select("id", F.round("rank", 9).alias("rank"))


# --- chunks and splits ----------------------------------------------------------------------------------------


def _chunk_sql(size: int, overlap: int) -> str:
    step = size - overlap
    return f"SELECT doc_id, CAST(i * {step} AS INTEGER) AS start, md5(substr(text, CAST(i * {step} + 1 AS BIGINT), {size})) AS digest FROM (SELECT doc_id, text, unnest(range(0, greatest(1, CAST(ceil((length(text) - {overlap}) / {step}.0) AS BIGINT)))) AS i FROM documents)"


def _chunk_rows(spark, sf_dir, size, overlap):
    chunks = load(spark, sf_dir, "documents").select("doc_id", F.explode(chunk.chunks_until_end(F.col("text"), size, overlap)).alias("c"))
    return chunks.select("doc_id", F.col("c")["start"].alias("start"), F.md5(F.col("c")["text"]).alias("digest"))


@query(_chunk_sql(1000, 100))
def chunks_1000_100(spark, sf_dir):
    return _chunk_rows(spark, sf_dir, 1000, 100)


@query(_chunk_sql(1000, 150))
def chunks_1000_150(spark, sf_dir):
    return _chunk_rows(spark, sf_dir, 1000, 150)


@query("SELECT doc_id, CAST(i AS INTEGER) AS start, md5(trim(substr(text, i + 1, 8192))) AS digest FROM (SELECT doc_id, text, unnest(range(0, length(text), 7792)) AS i FROM documents) WHERE trim(substr(text, i + 1, 8192)) <> ''")
def chunks_8192_400(spark, sf_dir):
    chunks = load(spark, sf_dir, "documents").select("doc_id", F.explode(chunk.chunks_every(F.col("text"))).alias("c"))
    return chunks.select("doc_id", F.col("c")["start"].alias("start"), F.md5(F.col("c")["text"]).alias("digest"))


@query("WITH w AS (SELECT doc_id, length(text) AS n, text, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS ws FROM documents) SELECT doc_id, CAST(i * 170 AS INTEGER) AS start, md5(array_to_string(ws[i * 170 + 1 : i * 170 + 200], ' ')) AS digest FROM (SELECT doc_id, ws, unnest(range(0, greatest(1, CAST(ceil((len(ws) - 30) / 170.0) AS BIGINT)))) AS i FROM w WHERE n > 1000) UNION ALL SELECT doc_id, 0, md5(text) FROM w WHERE n <= 1000")
def chunks_words(spark, sf_dir):
    chunks = load(spark, sf_dir, "documents").select("doc_id", F.explode(chunk.word_chunks(F.col("text"))).alias("c"))
    return chunks.select("doc_id", F.col("c")["start"].alias("start"), F.md5(F.col("c")["text"]).alias("digest"))


@query(f"{C} SELECT doc_id, title, n FROM (SELECT doc_id, 'Section 1' AS title, strpos(content, chr(10) || 'Section 2') - 1 AS n FROM legal_corpus UNION ALL SELECT doc_id, 'Section 2', strpos(content, chr(10) || 'Section 3') - strpos(content, chr(10) || 'Section 2') - 1 FROM legal_corpus UNION ALL SELECT doc_id, 'Section 3', length(content) - strpos(content, chr(10) || 'Section 3') FROM legal_corpus)")
def section_split(spark, sf_dir):
    parts = legal_corpus(spark, sf_dir).select("doc_id", F.explode(chunk.sections(F.col("content"))).alias("s"))
    return parts.select("doc_id", F.col("s")["title"].alias("title"), F.length(F.col("s")["text"]).alias("n"))


_SECTIONS = (
    "p AS (SELECT doc_id, 0 AS i, 'Section 1' AS section, substr(content, 1, strpos(content, chr(10) || 'Section 2') - 1) AS t FROM legal_corpus UNION ALL "
    "SELECT doc_id, 1, 'Section 2', substr(content, strpos(content, chr(10) || 'Section 2') + 1, strpos(content, chr(10) || 'Section 3') - strpos(content, chr(10) || 'Section 2') - 1) FROM legal_corpus UNION ALL "
    "SELECT doc_id, 2, 'Section 3', substr(content, strpos(content, chr(10) || 'Section 3') + 1) FROM legal_corpus), w AS (SELECT *, list_filter(string_split_regex(t, '\\s+'), lambda x: x <> '') AS ws FROM p)"
)


@query(
    f"{C}, {_SECTIONS}, k AS (SELECT *, unnest(range(0, greatest(1, CAST(ceil((len(ws) - 30) / 170.0) AS BIGINT)))) AS j FROM w WHERE length(t) > 1000) SELECT concat(doc_id, '_s', i, '_c', j) AS chunk_id, doc_id, section, CAST(j * 170 AS INTEGER) AS start, length(array_to_string(ws[j * 170 + 1 : j * 170 + 200], ' ')) AS n FROM k "
    "UNION ALL SELECT concat(doc_id, '_s', i, '_c0'), doc_id, section, 0, length(t) FROM w WHERE length(t) <= 1000"
)
def routed_chunks(spark, sf_dir):
    return chunk.route_chunks(legal_corpus(spark, sf_dir)).select("chunk_id", "doc_id", "section", "start", F.length("text").alias("n"))


@query("SELECT doc_id, CASE WHEN k <= ceil(n * 0.1) THEN 'test' ELSE 'train' END AS split FROM (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY sha256(concat('42:', CAST(doc_id AS VARCHAR))), doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents)")
def split_90_10(spark, sf_dir):
    return chunk.hash_split(load(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", by=["lang"]).select("doc_id", "split")


@query("SELECT doc_id, CASE WHEN k <= floor(n * 0.8) THEN 'train' ELSE 'validation' END AS split FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY source) AS n FROM documents)")
def split_80_20_ordered(spark, sf_dir):
    return chunk.ordered_split(load(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", by=["source"]).select("doc_id", "split")


# --- generated rows -------------------------------------------------------------------------------------------


def _items(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"), F.col("source").alias("type"), (1990 + F.col("doc_id") % 30).alias("year"), "text"
    )


_ITEMS = "i AS (SELECT doc_id AS id, concat('Document ', CAST(doc_id AS VARCHAR)) AS title, source AS type, 1990 + doc_id % 30 AS year, text FROM documents)"
_LONG = "l AS (SELECT id, title, text, unnest(range(0, length(text), 7792)) AS s FROM i WHERE length(text) > 2048), c AS (SELECT id, title, trim(substr(text, s + 1, 8192)) AS part, row_number() OVER (PARTITION BY id ORDER BY s) AS k FROM l WHERE trim(substr(text, s + 1, 8192)) <> '')"


@query(
    f"WITH {_ITEMS}, {_LONG}, r AS (SELECT id, concat('What is ', title, '?') AS instruction, concat(title, ' is a ', type, ' from ', CAST(year AS VARCHAR), '. It reads:', chr(10), chr(10), text) AS output FROM i "
    "UNION ALL SELECT id, concat('Explain the content of ', title), text FROM i "
    "UNION ALL SELECT id, concat('What does document ', CAST(id AS VARCHAR), ' contain?'), concat('Document ', CAST(id AS VARCHAR), ', titled ''', title, ''', contains:', chr(10), chr(10), text) FROM i "
    "UNION ALL SELECT id, concat('What type of document is ', title, '?'), concat(title, ' is a ', type, ' of ', CAST(year AS VARCHAR), '.') FROM i "
    "UNION ALL SELECT id, concat('When was ', title, ' made?'), concat(title, ' was made in ', CAST(year AS VARCHAR), '.') FROM i "
    "UNION ALL SELECT id, concat('Give section ', CAST(k AS VARCHAR), ' of ', title), part FROM c) SELECT id, instruction, length(output) AS n, md5(output) AS digest FROM r"
)
def instruction_rows(spark, sf_dir):
    return generate.instructions(_items(spark, sf_dir)).select("id", "instruction", F.length("output").alias("n"), F.md5("output").alias("digest"))


@query("SELECT doc_id AS id, md5(trim(substr(text, s + 1, 8192))) AS digest FROM (SELECT doc_id, text, unnest(range(0, length(text), 7792)) AS s FROM documents) WHERE trim(substr(text, s + 1, 8192)) <> ''")
def completion_rows(spark, sf_dir):
    return generate.completions(_items(spark, sf_dir)).select("id", F.md5("text").alias("digest"))


@query(f"WITH {_ITEMS}, p AS (SELECT id, title, unnest(string_split(text, chr(10) || chr(10))[1:5]) AS p, generate_subscripts(string_split(text, chr(10) || chr(10))[1:5], 1) AS k FROM i) SELECT id, question, md5(answer) AS digest FROM (SELECT id, concat('What is ', title, '?') AS question, concat(title, ' is a ', type, ' from ', CAST(year AS VARCHAR), '.') AS answer FROM i UNION ALL SELECT id, concat('What is the purpose of ', title, '?'), substr(text, 1, 500) FROM i UNION ALL SELECT id, concat('Where does ', title, ' come from?'), concat('It is document ', CAST(id AS VARCHAR), '.') FROM i UNION ALL SELECT id, concat('What does paragraph ', CAST(k AS VARCHAR), ' of ', title, ' say?'), trim(p) FROM p WHERE length(trim(p)) > 100)")
def qa_rows(spark, sf_dir):
    return generate.question_answers(_items(spark, sf_dir)).select("id", "question", F.md5("answer").alias("digest"))


@query(f"{C}, t AS (" + " UNION ALL ".join(f"SELECT doc_id, '{lv}' AS level, '{c}' AS complexity, concat({O.quote(i)}, title) AS instruction, concat(title, ': ', substr(content, 1, {n})) AS output FROM legal_corpus" for lv, c, starts, n in generate.LEVELS for i in starts) + ") SELECT doc_id, level, complexity, instruction, md5(output) AS digest FROM t")
def level_examples(spark, sf_dir):
    return generate.training_examples(legal_corpus(spark, sf_dir)).select("doc_id", "level", "complexity", "instruction", F.md5("output").alias("digest"))


def _start_sql(kind: str, starts) -> str:
    return " UNION ALL ".join(f"SELECT doc_id, '{kind}' AS kind, concat({O.quote(s)}, title, '? ', CASE WHEN length(content) > 200 THEN concat(substr(content, 1, 200), '...') ELSE content END) AS question FROM legal_corpus WHERE length(content) >= 100" for s in starts)


@query(f"{C} SELECT * FROM ({_start_sql('multi_step', generate.MULTI_STEP_STARTS)} UNION ALL {_start_sql('adversarial', generate.ADVERSARIAL_STARTS)} UNION ALL {_start_sql('practical', generate.PRACTICE_STARTS)}) WHERE kind <> 'adversarial' OR doc_id % 8 NOT IN (2, 3, 6)")
def advanced_questions(spark, sf_dir):
    docs = legal_corpus(spark, sf_dir)
    is_tax = F.col("doc_id") % 8
    return generate.advanced(docs.where(~is_tax.isin(2, 3, 6)), docs.where(is_tax.isin(2, 3, 6)))


@query(f"{C} " + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, concat({O.quote(a.split('{t}')[0])}, title, {O.quote(a.split('{t}')[1])}) AS question FROM legal_corpus" for k, two in generate.REASONING_KINDS.items() for a in two))
def reasoning_rows(spark, sf_dir):
    return generate.reasoning_rows(legal_corpus(spark, sf_dir))


@query(
    f"{C} SELECT doc_id, 'the facts differ' AS argument, concat('Answer the objection to ', title, ' that the facts differ') AS question FROM legal_corpus UNION ALL SELECT doc_id, 'the authority is weak', concat('How would the losing side of ', title, ' argue that the authority is weak') FROM legal_corpus "
    "UNION ALL SELECT doc_id, 'the remedy is out of proportion', concat('Defend ', title, ' against the charge that the remedy is out of proportion') FROM legal_corpus UNION ALL SELECT doc_id, 'the public interest points elsewhere', concat('On appeal from ', title, ' it is said that the public interest points elsewhere') FROM legal_corpus"
)
def counter_rows(spark, sf_dir):
    return generate.counter_rows(legal_corpus(spark, sf_dir))


_DOMAINS = f"k AS (SELECT {O.best_of(O.opening(2000), L.TAX_DOMAINS, 'general')} AS domain, count(*) AS docs FROM legal_corpus GROUP BY 1)"


def _domain_counts(spark, sf_dir):
    """(kind, docs): documents of each tax domain."""
    found = lexicon_scan.classified(legal_corpus(spark, sf_dir).select("title", "content"), ["tax_domain"])
    return found.groupBy(F.col("tax_domain").alias("kind")).agg(F.count("*").alias("docs"))


@query(f"{C}, {_DOMAINS} SELECT kind, n * docs AS n FROM (VALUES ('income_tax', 3), ('vat', 2), ('corporation_tax', 2)) t(kind, n) JOIN k ON domain = kind")
def tax_calculation_kinds(spark, sf_dir):
    """Worked calculations beside each document of their domain."""
    rows = generate.tax_calculations(spark).join(_domain_counts(spark, sf_dir), "kind")
    return rows.groupBy("kind").agg(F.sum("docs").alias("n"))


def _turns(spark, sf_dir):
    turns = load(spark, sf_dir, "conversations")
    w = W.partitionBy("conv_id").orderBy("turn")
    paired = turns.withColumn("asked", F.lag("text").over(w)).withColumn("by", F.lag("role").over(w))
    return paired.where("role = 'assistant' and by = 'user'").select("conv_id", "turn", F.col("asked").alias("instruction"), F.lit("").alias("input"), F.col("text").alias("output"), F.lit("basic").alias("complexity"))


_TURNS = "t AS (SELECT conv_id, turn, role, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS asked, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS by_role FROM conversations), p AS (SELECT * FROM t WHERE role = 'assistant' AND by_role = 'user')"


@query(f"WITH {_TURNS} SELECT md5(asked) AS instruction, CASE WHEN length(text) > 1024 THEN concat(substr(text, 1, 1024), '...') ELSE text END AS response FROM p")
def chat_training_rows(spark, sf_dir):
    rows = generate.chat_rows(_turns(spark, sf_dir), "legal_specialist", "phase_1_foundation")
    return rows.select(F.md5("instruction").alias("instruction"), "response")


# --- summaries ------------------------------------------------------------------------------------------------


@query("SELECT lang, count(*) AS n, round(avg(length(text)), 3) AS avg_length, min(length(text)) AS min_length, max(length(text)) AS max_length FROM documents GROUP BY lang")
def length_statistics(spark, sf_dir):
    return aggregate.length_stats(load(spark, sf_dir, "documents"), ["lang"], F.col("text")).withColumn("avg_length", F.round("avg_length", 3))


@query("SELECT lang, source, count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY GROUPING SETS ((lang), (source), (lang, source), ())")
def corpus_rollup(spark, sf_dir):
    return spark.sql("SELECT lang, source, count(*) AS n, sum(n_chars) AS chars FROM {d} GROUP BY GROUPING SETS ((lang), (source), (lang, source), ())", d=load(spark, sf_dir, "documents"))


@query("SELECT source, count(*) AS n, count_if(lang = 'en') AS hits, round(count_if(lang = 'en') / count(*)::DOUBLE, 6) AS rate FROM documents GROUP BY ROLLUP (source)")
def english_rates(spark, sf_dir):
    return aggregate.rates(load(spark, sf_dir, "documents"), "source", F.col("lang") == "en").withColumn("rate", F.round("rate", 6))


@query("WITH e AS (SELECT doc_id FROM documents), f AS (SELECT doc_id + 50 AS doc_id, n_chars FROM documents) SELECT count(e.doc_id) AS expected, count_if(e.doc_id IS NOT NULL AND f.doc_id IS NOT NULL) AS present, count_if(f.doc_id IS NULL) AS missing, count_if(e.doc_id IS NULL) AS unexpected, count_if(n_chars < 50) AS corrupted FROM e FULL JOIN f ON e.doc_id = f.doc_id")
def reconciliation(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return aggregate.reconcile(docs.select("doc_id"), docs.select((F.col("doc_id") + 50).alias("doc_id"), "n_chars"), "doc_id", "n_chars")


@query(f"{C}, c AS (SELECT doc_id, lower(content) AS t FROM legal_corpus) SELECT term, count(*) AS n FROM ({O.found_rows('t', L.TAX_TERMS, 'c', 'doc_id')}) GROUP BY term")
def term_frequencies(spark, sf_dir):
    return aggregate.term_frequency(legal_corpus(spark, sf_dir), F.col("content"), list(L.TAX_TERMS))


# --- validation and evaluation --------------------------------------------------------------------------------

_AUG = "concat(text, CASE conv_id % 4 WHEN 0 THEN ' This is not legal advice; for informational purposes only; a disclaimer from an AI system.' WHEN 1 THEN ' You will always win. [1850] UKSC 1 applies.' WHEN 2 THEN ' The analysis and conclusion apply the relevant law, an applicable principle, pursuant to section 5.' ELSE ' Help to evade tax.' END)"
_ANSWERS = f"a AS (SELECT conv_id, turn, {_AUG} AS text FROM conversations WHERE role = 'assistant')"


def _answers(spark, sf_dir):
    return load(spark, sf_dir, "conversations").where("role = 'assistant'").select("conv_id", "turn", F.expr(_AUG).alias("text"))


_NCITE = f"len(regexp_extract_all(text, {O.quote(L.NEUTRAL_CITATION)}))"
_NGOOD = f"len(list_filter(regexp_extract_all(text, {O.quote(L.NEUTRAL_CITATION)}, 1), lambda y: CAST(y AS INTEGER) BETWEEN 1900 AND 2024))"
_NREST = "(" + " + ".join(f"len(regexp_extract_all(text, {O.quote(p)}))" for p in (L.LAW_REPORT_PAGE, L.TAX_ACT, r"(?i)\b(?:section|s\.|§)\s*(\d+(?:\([^)]+\))*)", r"\b([A-Z]{2,4}\d{5}[A-Z]*)\b")) + ")"
_ISSUES = f"({O.matches_of('text', L.UNPROFESSIONAL_PATTERNS)} + CAST({O.count_of('lower(text)', L.REASONING_TERMS)} < 3 AS INTEGER) + CAST(length(text) > 500 AND {O.count_of('lower(text)', L.FORMAL_TERMS)} = 0 AS INTEGER))"
_CHECKS = (
    f"b AS (SELECT conv_id, turn, {O.matches_of('text', L.DISCLAIMER_PATTERNS)} >= 3 AS has_disclaimer, CASE WHEN {_NCITE} + {_NREST} = 0 THEN 1.0 ELSE ({_NGOOD} + {_NREST}) / ({_NCITE} + {_NREST})::DOUBLE END AS accuracy, "
    f"{_ISSUES} AS issues, {O.matches_of('lower(text)', L.UNETHICAL_PATTERNS, '')} = 0 AS ethical FROM a), "
    "s AS (SELECT *, (CASE WHEN has_disclaimer THEN 0.25 ELSE 0.0 END + accuracy * 0.2 + CASE WHEN issues = 0 THEN 0.2 ELSE 0.1 END + CASE WHEN ethical THEN 0.15 ELSE 0.0 END + 0.2) AS total, "
    "CAST(NOT has_disclaimer AS INTEGER) + CAST(accuracy < 0.8 AS INTEGER) AS high FROM b)"
)
_LEVEL = "CASE WHEN high > 0 OR total < 0.6 THEN 'warning' WHEN total < 0.8 THEN 'requires_review' ELSE 'compliant' END"


@query(f"WITH {_ANSWERS}, {_CHECKS} SELECT conv_id, turn, has_disclaimer, ethical, round(total, 6)::DOUBLE AS total, high + issues AS violations, {_LEVEL} AS level FROM s")
def compliance_scores(spark, sf_dir):
    v = F.col("validation")
    return validate.validate(_answers(spark, sf_dir), this_year=2024).select(
        "conv_id", "turn", v["disclaimer_compliance"].alias("has_disclaimer"), v["ethical_compliance"].alias("ethical"), F.round(v["overall_score"], 6).alias("total"),
        F.size(v["violations"]).alias("violations"), v["compliance_level"].alias("level"),
    )


@query(f"WITH {_ANSWERS}, {_CHECKS} SELECT {_LEVEL} AS level, count(*) AS n FROM s GROUP BY 1")
def compliance_histogram(spark, sf_dir):
    return validate.validate(_answers(spark, sf_dir), this_year=2024).groupBy(F.col("validation")["compliance_level"].alias("level")).agg(F.count("*").alias("n"))


def _ws(col: str) -> str:
    return f"list_distinct(list_filter(string_split_regex(lower({col}), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> ''))"


@query(
    f"WITH {_TURNS}, w AS (SELECT conv_id, turn, text, {_ws('text')} AS pw, {_ws('asked')} AS rw FROM p) SELECT conv_id, turn, round(CASE WHEN len(rw) = 0 THEN 0.8 ELSE len(list_intersect(pw, rw)) / len(rw)::DOUBLE END, 6) AS word_recall, "
    f"{O.matches_of('text', L.STRUCTURE_PATTERNS)} / 4.0::DOUBLE AS structure, round({O.matches_of('text', L.COHERENCE_PATTERNS)} * 0.25::DOUBLE, 6) AS coherence FROM w"
)
def answer_metrics(spark, sf_dir):
    p, r = F.col("output"), F.col("instruction")
    return _turns(spark, sf_dir).select("conv_id", "turn", F.round(evaluate.word_recall(p, r), 6).alias("word_recall"), evaluate.structure(p).alias("structure"), F.round(evaluate.coherence(p), 6).alias("coherence"))


_METRIC_SQL = (
    "r AS (SELECT text AS p, asked AS r FROM p), l AS (SELECT *, lower(p) AS lp, lower(r) AS lr FROM r), "
    "c AS (SELECT *, list_distinct(list_concat(list_concat(regexp_extract_all(p, '\\[(\\d{4})\\]\\s+(UKSC|UKHL|UKPC|EWCA|EWHC|EWCOP|CSIH|CSOH|NICA|NIQB)\\s+(\\d+)'), regexp_extract_all(p, '\\[(\\d{4})\\]\\s+(\\d+)\\s+(AC|WLR|All\\s+ER|QB|Ch|Fam)')), list_concat(regexp_extract_all(p, '\\b((?:TCGA|ITA|ITTOIA|CTA|IHTA|FA|VATA|TMA)\\s+\\d{4})\\b'), regexp_extract_all(p, '(?i)\\b(?:section|s\\.|§)\\s*(\\d+)')))) AS cp, "
    "list_distinct(list_concat(list_concat(regexp_extract_all(r, '\\[(\\d{4})\\]\\s+(UKSC|UKHL|UKPC|EWCA|EWHC|EWCOP|CSIH|CSOH|NICA|NIQB)\\s+(\\d+)'), regexp_extract_all(r, '\\[(\\d{4})\\]\\s+(\\d+)\\s+(AC|WLR|All\\s+ER|QB|Ch|Fam)')), list_concat(regexp_extract_all(r, '\\b((?:TCGA|ITA|ITTOIA|CTA|IHTA|FA|VATA|TMA)\\s+\\d{4})\\b'), regexp_extract_all(r, '(?i)\\b(?:section|s\\.|§)\\s*(\\d+)')))) AS cr, "
    "list_distinct(list_filter(string_split_regex(lp, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS wp, list_distinct(list_filter(string_split_regex(lr, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS wr FROM l), "
    "m AS (SELECT CASE WHEN len(cr) = 0 THEN CASE WHEN len(cp) = 0 THEN 1.0 ELSE 0.8 END ELSE len(list_intersect(cp, cr)) / len(cr)::DOUBLE END AS citation_recall, "
    "(CAST(regexp_matches(p, '(?i)Introduction|Background|Legal Framework|Analysis|Conclusion') AS INT) + CAST(regexp_matches(p, '(?i)pursuant to|in accordance with|as provided by') AS INT) + CAST(regexp_matches(p, '(?i)(s\\.|section)\\s*\\d+') AS INT) + CAST(regexp_matches(p, '(?i)(para\\.|paragraph)\\s*\\d+') AS INT)) / 4.0::DOUBLE AS structure, "
    "least(1.0, (CAST(regexp_matches(p, '(?i)Supreme Court|UKSC') AS INT) + CAST(regexp_matches(p, '(?i)Court of Appeal|EWCA') AS INT) + CAST(regexp_matches(p, '(?i)High Court|EWHC') AS INT) + CAST(regexp_matches(p, '(?i)authority|precedent|binding') AS INT)) * 0.25::DOUBLE) AS hierarchy, "
    "least(1.0, (CAST(regexp_matches(p, '(?i)therefore|thus|consequently|accordingly') AS INT) + CAST(regexp_matches(p, '(?i)however|nevertheless|notwithstanding') AS INT) + CAST(regexp_matches(p, '(?i)furthermore|moreover|additionally') AS INT) + CAST(regexp_matches(p, '(?i)step \\d+|firstly|secondly|finally') AS INT)) * 0.25::DOUBLE) AS coherence, "
    "least(1.0, (CAST(contains(lp, 'notwithstanding') AS INT) + CAST(contains(lp, 'pursuant') AS INT) + CAST(contains(lp, 'whereas') AS INT) + CAST(contains(lp, 'hereby') AS INT) + CAST(contains(lp, 'therein') AS INT) + CAST(contains(lp, 'aforementioned') AS INT) + CAST(contains(lp, 'inter alia') AS INT) + CAST(contains(lp, 'prima facie') AS INT) + CAST(contains(lp, 'ultra vires') AS INT) + CAST(contains(lp, 'obiter dicta') AS INT) + CAST(contains(lp, 'ratio decidendi') AS INT)) * 0.1::DOUBLE) AS formal_language, "
    "least(1.0, (CAST(regexp_matches(p, '\\[(\\d{4})\\]\\s+[A-Z]+\\s+\\d+') AS INT) + CAST(regexp_matches(p, '[A-Z][a-z]+\\s+v\\s+[A-Z][a-z]+') AS INT) + CAST(regexp_matches(p, '\\(\\d{4}\\)\\s+\\d+\\s+[A-Z]+') AS INT)) * 0.33::DOUBLE) AS citation_style, "
    "least(1.0, (CAST(contains(lp, 'professional legal advice') AS INT) + CAST(contains(lp, 'qualified legal professional') AS INT) + CAST(contains(lp, 'specific circumstances') AS INT) + CAST(contains(lp, 'disclaimer') AS INT)) * 0.25::DOUBLE) AS disclaimer, "
    "CASE WHEN len(wr) = 0 THEN 0.8 ELSE len(list_intersect(wp, wr)) / len(wr)::DOUBLE END AS word_recall FROM c), o AS (SELECT *, (citation_recall + structure + hierarchy + coherence + formal_language + citation_style + disclaimer + word_recall) / 8.0::DOUBLE AS overall FROM m)"
)


@query(f"WITH {_TURNS}, {_METRIC_SQL} SELECT " + ", ".join(f"round(avg({k}), 6)::DOUBLE AS {k}" for k in ("citation_recall", "structure", "hierarchy", "coherence", "formal_language", "citation_style", "disclaimer", "word_recall", "overall")) + " FROM o")
def evaluation_means(spark, sf_dir):
    m = evaluate.all_metrics(F.col("output"), F.col("instruction"))
    return _turns(spark, sf_dir).select(*[c.alias(k) for k, c in m.items()]).agg(*[F.round(F.avg(k), 6).alias(k) for k in m])


# --- vectors --------------------------------------------------------------------------------------------------

_V = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), u AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v)"


@query(f"WITH {_V}, s AS (SELECT q.vec_id AS query_id, i.vec_id AS vec_id, list_dot_product(i.e, q.e) AS score FROM u i, u q WHERE q.vec_id % 20 = 0) SELECT query_id, vec_id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s) WHERE k <= 10")
def vector_topk(spark, sf_dir):
    items = load(spark, sf_dir, "embeddings")
    queries = items.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vector.search(items, queries, 10).select("query_id", "vec_id", F.round("score", 6).alias("score"))


@query(f"WITH {_V}, s AS (SELECT q.vec_id AS query_id, i.vec_id, list_dot_product(i.e, q.e) * (1.0 + 1.0 / (1 + i.label % 8)) * 0.8 AS final FROM u i, u q WHERE q.vec_id % 20 = 0 AND i.label % 2 = 0) SELECT query_id, vec_id, round(final, 6) AS final FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY final DESC, vec_id) AS k FROM s) WHERE k <= 10")
def vector_boosted(spark, sf_dir):
    items = load(spark, sf_dir, "embeddings").where("label % 2 = 0")
    queries = load(spark, sf_dir, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    weight = score.chunk_authority_weight(1 + F.col("label") % 8)
    boost = score.authority_boost(weight) * score.temporal_boost(F.lit(None).cast("date"), F.lit("2024-01-01").cast("date"))
    out = vector.search(items, queries, 10, boost=boost)
    return out.select("query_id", "vec_id", F.round("final", 6).alias("final"))


# --- set operations, upserts ----------------------------------------------------------------------------------


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unlabelled(spark, sf_dir):
    return rank.pending(load(spark, sf_dir, "documents").select("doc_id"), load(spark, sf_dir, "labels"), "doc_id")


@query("SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer")
def source_intersect(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).intersect(load(spark, sf_dir, "customer").select("c_custkey"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def upsert_latest(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.struct("ts", "event_id").alias("version"))
    return rank.latest(ev, "user_id", "version").select("user_id", "event_id", "event_type")


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::INTEGER AS nation FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier")
def append_aligned(spark, sf_dir):
    a = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT c_nationkey AS nation, c_custkey AS id, c_acctbal AS balance FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer) WHERE k <= 3")
def top_three_per_nation(spark, sf_dir):
    out = rank.top_per_group(load(spark, sf_dir, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 3)
    return out.select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))


# --- events ---------------------------------------------------------------------------------------------------


@query("SELECT event_id, n AS in_window FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS n FROM events) WHERE n > 2")
def rate_window(spark, sf_dir):
    return relational.rate_violations(load(spark, sf_dir, "events"), by="user_id", time="ts", limit=2, seconds=86_400).select("event_id", "in_window")


@query("SELECT epoch_us(date_trunc('hour', ts)) AS start_us, event_type, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY 1, 2")
def tumbling_hours(spark, sf_dir):
    out = stream_events.windowed(load(spark, sf_dir, "events"))
    return out.select(F.unix_micros(F.col("window_start").cast("timestamp")).alias("start_us"), "event_type", "n", F.round("total", 3).alias("total"))


@query("WITH w AS (SELECT event_type, value, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS s FROM events) SELECT epoch_us(s) AS start_us, event_type, count(*) AS n FROM w GROUP BY 1, 2")
def sliding_hours(spark, sf_dir):
    out = stream_events.windowed(load(spark, sf_dir, "events"), width="2 hours", slide="1 hour")
    return out.select(F.unix_micros(F.col("window_start").cast("timestamp")).alias("start_us"), "event_type", "n")


@query("WITH g AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) < 1800000000 THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n FROM s GROUP BY user_id, k")
def session_windows(spark, sf_dir):
    out = stream_events.session_counts(load(spark, sf_dir, "events"))
    return out.select("user_id", F.unix_micros(F.col("session_start").cast("timestamp")).alias("start_us"), "n")


@query("SELECT e.event_id, e.user_id, e.event_type, m.event_id AS matched_event_id FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY user_id, ts) m ON e.user_id = m.user_id AND e.ts >= m.ts")
def as_of_views(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    views = ev.where("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("event_id").alias("event_id"))
    out = relational.as_of_join(ev.where("event_type = 'purchase'").select("event_id", "user_id", "event_type", "ts"), views, on="user_id", left_time="ts", right_time="ts", values=["event_id"])
    return out.select("event_id", "user_id", "event_type", "matched_event_id")


# --- star schema ----------------------------------------------------------------------------------------------


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def star_pricing(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return items.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY n_name")
def star_revenue(spark, sf_dir):
    t = lambda n: load(spark, sf_dir, n)
    nations = t("nation").join(t("region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    items = t("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey")).join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    return items.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def star_anti(spark, sf_dir):
    return load(spark, sf_dir, "customer").join(load(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT c_mktsegment, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY CUBE (c_mktsegment, o_orderpriority)")
def star_cube(spark, sf_dir):
    joined = load(spark, sf_dir, "customer").join(load(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    return joined.cube("c_mktsegment", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT o_orderkey, round(avg(o_totalprice) OVER w, 4) AS moving, rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")
def star_windows(spark, sf_dir):
    moving = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(-2, 0)
    placed = relational.numbered(load(spark, sf_dir, "orders"), ["o_orderstatus"], [F.desc("o_totalprice"), F.col("o_orderkey")], "place", durable=durable(spark))
    return placed.select("o_orderkey", F.round(F.avg("o_totalprice").over(moving), 4).alias("moving"), "place")


@query("SELECT p_partkey, b AS band FROM part JOIN (SELECT unnest(range(0, 20)) * 100.0 + 900 AS lo, unnest(range(0, 20)) AS b) r ON p_retailprice >= lo AND p_retailprice <= lo + 99.99")
def star_price_bands(spark, sf_dir):
    bands = spark.range(20).select(F.col("id").alias("band"), (F.col("id") * 100.0 + 900).alias("lo"), (F.col("id") * 100.0 + 999.99).alias("hi"))
    return relational.range_join(load(spark, sf_dir, "part"), bands, point="p_retailprice", low="lo", high="hi", width=100.0).select("p_partkey", "band")


@query("SELECT s_nationkey, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey")
def star_salted_join(spark, sf_dir):
    small = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    joined = relational.salted_join(load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"), small, "l_suppkey", salts=4)
    return joined.groupBy("s_nationkey").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query()
def star_approximate(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem")
    return items.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey").alias("parts"), F.approx_percentile("l_quantity", 0.5).alias("median_qty"))


# the queries of the other modules are registered by their import
from loomtext.plans import catalog_answers as catalog_answers  # noqa: E402
from loomtext.plans import catalog_connectors as catalog_connectors  # noqa: E402
from loomtext.plans import catalog_sources as catalog_sources  # noqa: E402
