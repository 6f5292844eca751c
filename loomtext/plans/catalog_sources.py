"""Registered queries on acquisition and records: listings, feeds, searches, discovery, downloads, progress, sinks' tables.

Pages, feeds and records are made from ``documents`` by expressions, so that their SQL needs no files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions.terms import TermIndex
from loomtext.operators import extract, rank, vector
from loomtext.plans.catalog import C, query
from loomtext.sources import files, sinks, web
from loomtext.sources.tables import legal_corpus, load
from loomtext.streaming import events as stream_events


def _id():
    return F.col("doc_id").cast("string")


def _text(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


@query("SELECT concat('ukpga_', y, '_', doc_id) AS id, 'ukpga' AS type, y AS year, CAST(doc_id AS VARCHAR) AS number, concat('/ukpga/', y, '/', doc_id, '/contents') AS href FROM (SELECT doc_id, 1990 + doc_id % 30 AS y FROM documents)")
def listing_items(spark, sf_dir):
    year = (1990 + F.col("doc_id") % 30).cast("string")
    html = _text('<ul><li><a href="/ukpga/', year, "/", _id(), '/contents">A</a> <a href="/ukpga/', year, "/", _id(), '/notes">B</a> <a href="/uksi/', year, '/9">C</a></li></ul>')
    pages = load(spark, sf_dir, "documents").select(F.lit("ukpga").alias("type"), (1990 + F.col("doc_id") % 30).alias("year"), html.alias("html"))
    return web.listing_items(pages).select("id", "type", "year", "number", "href")


@query("SELECT DISTINCT concat('http://feed.example/', doc_id % 300) AS url FROM documents")
def feed_items(spark, sf_dir):
    xml = _text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><link rel="self" href="http://feed.example/self"/><link rel="alternate" href="http://feed.example/', (F.col("doc_id") % 300).cast("string"), '"/></entry></feed>')
    return web.feed_links(load(spark, sf_dir, "documents").select(xml.alias("xml")))


@query("SELECT DISTINCT concat('/guidance/', lang, '-', doc_id % 40) AS link FROM documents WHERE doc_id % 4 = 0 AND (doc_id % 3 = 0 OR doc_id % 5 = 0)")
def discovered_forms(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(
        F.expr("CASE WHEN doc_id % 3 = 0 THEN 'Tax FORM 12' WHEN doc_id % 5 = 0 THEN 'Annual return' ELSE 'News' END").alias("title"),
        F.when(F.col("doc_id") % 4 == 0, _text("/guidance/", F.col("lang"), "-", (F.col("doc_id") % 40).cast("string"))).otherwise("/news/x").alias("link"),
    )
    return web.discovered(docs, prefix="/guidance/", title_terms=["form", "return"])


@query("SELECT url, min_by(found, n) AS found FROM (SELECT concat('u', doc_id % 50) AS url, 'api' AS found, 0 AS n FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT concat('u', doc_id % 90), 'feed', 1 FROM documents WHERE doc_id % 3 = 0) GROUP BY url")
def merged_discoveries(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    part = lambda m, n, name: docs.where(F.col("doc_id") % m == 0).select(_text("u", (F.col("doc_id") % n).cast("string")).alias("url"), F.lit(name).alias("found"))
    return web.merged_discovery(part(2, 50, "api"), part(3, 90, "feed"))


@query("SELECT t.type, y.year, count(d.doc_id) AS known FROM (VALUES ('ukpga'), ('uksi')) t(type), (SELECT unnest(range(1980, 2025)) AS year) y LEFT JOIN documents d ON 1980 + d.doc_id % 45 = y.year AND CASE WHEN d.doc_id % 2 = 0 THEN 'ukpga' ELSE 'uksi' END = t.type GROUP BY 1, 2")
def listing_requests(spark, sf_dir):
    """Kinds and years to be listed, with the documents known of each."""
    known = load(spark, sf_dir, "documents").groupBy(F.when(F.col("doc_id") % 2 == 0, "ukpga").otherwise("uksi").alias("type"), (1980 + F.col("doc_id") % 45).cast("int").alias("year")).agg(F.count("*").alias("known"))
    return web.requests(["ukpga", "uksi"], 1980, 2024, spark).join(known, ["type", "year"], "left").select("type", "year", F.coalesce("known", F.lit(0)).alias("known"))


def _searched(docs, group, asked):
    """``asked`` (group, term) with the documents of the group whose text holds the term, by one pass over each text."""
    index = TermIndex([r["term"] for r in asked.select("term").distinct().collect()])  # terms of a fixed list
    hits = docs.select(group, index.scan(F.lower("text"), {"all": (0, None)})["all"].alias("h"))
    met = hits.select(group, F.explode("h").alias("n")).groupBy(group, "n").agg(F.count("*").alias("found"))
    names = F.array(*[F.lit(t) for t in index.terms])
    return asked.join(met.select(group, F.get(names, F.col("n")).alias("term"), "found"), [group, "term"], "left").select(group, "term", F.coalesce("found", F.lit(0)).alias("found"))


@query(f"{C} SELECT court, term, count(doc_id) AS found FROM (VALUES ('EWCA'), ('UKSC')) c(court), (VALUES ('housing'), ('tenancy'), ('landlord'), ('tenant'), ('rent'), ('eviction'), ('possession'), ('assured shorthold'), ('section 21'), ('section 8'), ('deposit'), ('leasehold'), ('service charge'), ('disrepair'), ('harassment'), ('illegal eviction'), ('notice to quit')) t(term) LEFT JOIN (SELECT doc_id, lower(content) AS body, CASE doc_id % 4 WHEN 0 THEN 'UKSC' WHEN 1 THEN 'EWCA' ELSE 'other' END AS heard FROM legal_corpus) d ON heard = court AND contains(body, term) GROUP BY 1, 2")
def court_searches(spark, sf_dir):
    """Housing terms searched in the documents of two courts."""
    heard = F.when(F.col("doc_id") % 4 == 0, "UKSC").when(F.col("doc_id") % 4 == 1, "EWCA").otherwise("other")
    docs = legal_corpus(spark, sf_dir).select(heard.alias("court"), F.col("content").alias("text"))
    return _searched(docs, "court", web.court_searches(spark, ["EWCA", "UKSC"]))


@query("SELECT category, term, count(d.doc_id) AS found FROM (SELECT DISTINCT lang AS category FROM documents WHERE lang IS NOT NULL) c, (VALUES ('and'), ('pour'), ('licen'), ('copyright'), ('cookie')) t(term) LEFT JOIN documents d ON d.lang = category AND contains(lower(d.text), term) GROUP BY 1, 2")
def category_searches(spark, sf_dir):
    """Terms searched in each language that the documents have."""
    docs = load(spark, sf_dir, "documents").select(F.col("lang").alias("category"), "text")
    categories = sorted(r["category"] for r in docs.where("category is not null").select("category").distinct().collect())  # as many as there are languages
    return _searched(docs, "category", web.searches(categories, ["and", "pour", "licen", "copyright", "cookie"], spark))


@query("SELECT DISTINCT concat('search_ukpga_', 1990 + doc_id % 30) AS id, 'ukpga' AS type, concat('https://x.example/ukpga/', 1990 + doc_id % 30) AS url FROM documents")
def search_result_items(spark, sf_dir):
    html = _text('<a href="/ukpga/', (1990 + F.col("doc_id") % 30).cast("string"), '">A</a><a href="/help/me">B</a><a href="/ukx">C</a>')
    return web.search_items(load(spark, sf_dir, "documents").select(html.alias("html")), base="https://x.example/")


@query("SELECT type, count(*) AS n, min(year) AS first_year, max(year) AS last_year, CAST(coalesce(sum(docs), 0) AS BIGINT) AS docs FROM (VALUES ('ukpga', 1985), ('ukpga', 1988), ('ukpga', 1996), ('ukpga', 2004), ('ukpga', 1977), ('ukpga', 1965), ('ukpga', 1985), ('ukpga', 1987), ('ukpga', 1954), ('ukpga', 1967), ('ukpga', 1993), ('ukpga', 2002), ('ukpga', 2016), ('ukpga', 2019), ('ukpga', 2017), ('ukpga', 1977), ('ukpga', 1972), ('ukpga', 2013), ('ukpga', 1983), ('ukpga', 1968), ('ukpga', 2020), ('ukpga', 1988), ('ukpga', 2014), ('uksi', 1988), ('uksi', 1997), ('uksi', 2006), ('uksi', 2007), ('uksi', 2019), ('uksi', 2020), ('uksi', 2021)) t(type, year) LEFT JOIN (SELECT 1965 + doc_id % 57 AS y, count(*) AS docs FROM documents GROUP BY 1) d ON y = year GROUP BY type")
def seed_acts(spark, sf_dir):
    """Seeds of each type, and the documents of their years."""
    years = load(spark, sf_dir, "documents").groupBy((1965 + F.col("doc_id") % 57).cast("int").alias("year")).agg(F.count("*").alias("docs"))
    seeds = web.seed_items(spark, "https://x.example").join(years, "year", "left")
    return seeds.groupBy("type").agg(F.count("*").alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"))


@query("SELECT concat('https://x.example/ukpga/', 1990 + doc_id % 30, '/', doc_id) AS url, concat('Act ', doc_id) AS title, 'ukpga' AS type, CAST(1990 + doc_id % 30 AS VARCHAR) AS year, CAST(doc_id AS VARCHAR) AS number FROM documents")
def law_properties(spark, sf_dir):
    url = _text("https://x.example/ukpga/", (1990 + F.col("doc_id") % 30).cast("string"), "/", _id())
    xml = _text('<l xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>Act ', _id(), "</dc:title><dc:type>other</dc:type></l>")
    return web.document_properties(load(spark, sf_dir, "documents").select(url.alias("url"), xml.alias("xml")))


@query("WITH c AS (SELECT CASE doc_id % 3 WHEN 0 THEN 'UKUT' ELSE 'EWCA' END AS court, concat('u', CAST(floor(doc_id / 2) AS BIGINT)) AS url, doc_id AS seq FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY court ORDER BY seq) AS k FROM c) SELECT url, min_by(court, seq) AS court, min(seq) AS seq FROM r WHERE k <= CASE court WHEN 'UKUT' THEN 40 ELSE 10 END GROUP BY url")
def capped_cases(spark, sf_dir):
    """The cap for each court is the feature."""
    cases = load(spark, sf_dir, "documents").select(F.expr("CASE doc_id % 3 WHEN 0 THEN 'UKUT' ELSE 'EWCA' END").alias("court"), _text("u", F.floor(F.col("doc_id") / 2).cast("string")).alias("url"), F.col("doc_id").alias("seq"))
    return web.capped_per_court(cases, 40, first_court="UKUT").select("url", "court", "seq")


@query("SELECT DISTINCT CASE doc_id % 2 WHEN 0 THEN concat('http://a/', doc_id % 70) ELSE concat('http://base/', doc_id % 70) END AS url FROM documents UNION SELECT concat('http://base/', lang) FROM documents WHERE doc_id % 5 > 0")
def downloaded_urls(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    one = docs.select(F.when(F.col("doc_id") % 2 == 0, _text("http://a/", (F.col("doc_id") % 70).cast("string"))).otherwise((F.col("doc_id") % 70).cast("string")).alias("url"))
    two = docs.select(F.when(F.col("doc_id") % 5 > 0, F.col("lang")).alias("link"))
    return files.existing_urls((one, "url"), (two, "link"), base="http://base/")


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN concat('body ', doc_id, chr(10), chr(10), 'one', chr(10), chr(10), 'two') WHEN 1 THEN concat('intro ', lang) ELSE 'plain' END AS text FROM documents")
def content_records(spark, sf_dir):
    record = F.when(F.col("doc_id") % 3 == 0, _text('{"details": {"body": "body ', _id(), '", "parts": [{"body": "one"}, {"body": "two"}]}}')).when(F.col("doc_id") % 3 == 1, _text('{"details": {"introduction": "intro ', F.col("lang"), '"}}')).otherwise('{"details": "plain"}')
    return load(spark, sf_dir, "documents").select("doc_id", files.content_record(record).alias("text"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat('api ', doc_id) ELSE concat('html ', doc_id) END AS text FROM documents")
def api_or_html(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", web.api_first(F.when(F.col("doc_id") % 2 == 0, _text("api ", _id())), _text("html ", _id())).alias("text"))


@query("SELECT doc_id, concat('a ', doc_id, ' b ', lang, ' c') AS text FROM documents WHERE doc_id % 4 > 0 UNION ALL SELECT doc_id, NULL FROM documents WHERE doc_id % 4 = 0")
def xml_texts(spark, sf_dir):
    """Texts and tails in order; what does not parse gives null."""
    xml = F.when(F.col("doc_id") % 4 == 0, "<broken").otherwise(_text("<r>a <i>", _id(), "</i> b<x/> <y> ", F.col("lang"), " </y>\n c </r>"))
    return load(spark, sf_dir, "documents").select("doc_id", files.xml_text(xml).alias("text"))


@query("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'case' WHEN 1 THEN 'legislation' WHEN 2 THEN 'case' WHEN 3 THEN 'legislation' WHEN 4 THEN 'case' ELSE NULL END AS kind FROM documents")
def routed_records(spark, sf_dir):
    n = F.col("doc_id") % 6
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", F.when(n == 2, "UKSC").alias("court"), F.when(n == 4, "[2001] UKSC 1").alias("citation"), F.lit(None).cast("string").alias("judges"),
        F.when(n == 3, "c. 5").alias("chapter"), F.lit(None).cast("string").alias("sections"), F.lit(None).cast("string").alias("year"), F.when(n == 0, "x/case_law").when(n == 1, "x/acts").otherwise("x/other").alias("dir"),
    )
    return docs.select("doc_id", files.route_record(F.col("dir")).alias("kind"))


@query("SELECT k AS table_key, lang, n FROM (SELECT 'a' AS k, lang, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'b', lang, count(*) FROM documents WHERE doc_id % 2 = 0 GROUP BY lang)")
def keyed_tables(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang")
    return files.keyed_union({"a": docs, "b": docs.where("doc_id % 2 = 0")}, distinct=False).groupBy("table_key", "lang").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT CAST(doc_id AS VARCHAR) AS src, lang AS dst, 'HEARD_IN' AS kind FROM documents WHERE doc_id % 2 = 0 UNION SELECT CAST(doc_id AS VARCHAR), source, 'RELATES_TO' FROM documents UNION SELECT CAST(doc_id AS VARCHAR), 'act', 'RELATES_TO' FROM documents")
def case_edges(spark, sf_dir):
    cases = load(spark, sf_dir, "documents").select(_id().alias("id"), _text("T", _id()).alias("title"), F.col("text").alias("content"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("court"), F.array("source", F.lit("act"), F.lit("act")).alias("legislation"))
    return sinks.case_records(cases)["edges"]


@query("SELECT CAST(doc_id AS VARCHAR) AS id, concat('T', doc_id) AS title, 'Act' AS label FROM documents UNION ALL SELECT concat(doc_id, '_section_', n), NULL, 'Section' FROM documents, (VALUES ('1'), ('2')) s(n)")
def law_nodes(spark, sf_dir):
    sections = F.array(*[F.struct(F.lit(n).alias("number"), F.lit("t").alias("text")) for n in ("1", "2")])
    acts = load(spark, sf_dir, "documents").select(_id().alias("id"), _text("T", _id()).alias("title"), F.col("text").alias("content"), sections.alias("sections"))
    return sinks.legislation_records(acts)["nodes"]


@query("SELECT concat(doc_id, '_chunk_', i) AS vector_id, length(substr(text, CAST(i * 900 + 1 AS BIGINT), 1000)) AS n, md5(substr(text, CAST(i * 900 + 1 AS BIGINT), 500)) AS digest FROM (SELECT doc_id, text, unnest(range(0, greatest(1, CAST(ceil((length(text) - 100) / 900.0) AS BIGINT)))) AS i FROM documents)")
def vector_texts(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(_id().alias("id"), F.col("text").alias("content"))
    return sinks.vector_texts(docs).select("vector_id", F.length("text").alias("n"), F.md5("preview").alias("digest"))


@query("SELECT CAST(doc_id AS VARCHAR) AS url, CASE WHEN doc_id % 3 = 0 THEN 'downloaded' WHEN doc_id % 2 = 0 THEN 'failed' ELSE 'discovered' END AS state FROM documents")
def download_states(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", _id().alias("url"))
    return stream_events.progress(docs, docs.where("doc_id % 3 = 0"), docs.where("doc_id % 2 = 0"))


@query("SELECT CAST(doc_id AS VARCHAR) AS url FROM documents WHERE doc_id % 3 > 0 OR doc_id % 12 = 0")
def downloads_left(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", _id().alias("url"))
    states = stream_events.progress(docs, docs.where("doc_id % 3 = 0"), docs.where("doc_id % 2 = 0"))
    return stream_events.remaining(states, docs.where("doc_id % 12 = 0").select("url"))


@query("SELECT doc_id FROM documents ORDER BY doc_id LIMIT 30")
def download_quota(spark, sf_dir):
    """The quota is the feature: 100 less 70 that are done."""
    return rank.quota(load(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100, 70)


@query("SELECT event_id, user_id FROM events")
def events_once(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return stream_events.deduplicated(ev.unionByName(ev.where("event_id % 3 = 0"))).select("event_id", "user_id")


@query(f"{C} SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '1' ELSE 'Para 1' END AS number, CASE WHEN doc_id % 2 = 0 THEN 133 ELSE 120 END AS n FROM legal_corpus UNION ALL SELECT doc_id, '3', 121 FROM legal_corpus WHERE doc_id % 2 = 0")
def question_sections(spark, sf_dir):
    """Numbered sections of which the second is too short; else paragraphs."""
    numbered = _text("1. ", F.repeat(F.lit("a"), F.lit(130)), "\n2. short\n3. ", F.repeat(F.lit("b"), F.lit(118)))
    plain = _text(F.repeat(F.lit("p"), F.lit(120)), "\n\nshort")
    docs = legal_corpus(spark, sf_dir).select("doc_id", F.explode(extract.qa_sections(F.when(F.col("doc_id") % 2 == 0, numbered).otherwise(plain))).alias("s"))
    return docs.select("doc_id", F.col("s")["number"].alias("number"), F.length(F.col("s")["text"]).alias("n"))


@query(
    "WITH h AS (SELECT doc_id AS d, (doc_id % 100) / 100.0::DOUBLE AS final FROM documents WHERE doc_id % 10 = 0), b AS (SELECT d FROM h ORDER BY final DESC, d LIMIT 5), e AS (SELECT doc_id AS x, doc_id + 1 AS y FROM documents WHERE doc_id % 3 > 0), "
    "w AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e), l AS (SELECT DISTINCT y AS d FROM w WHERE x IN (SELECT d FROM b) AND y NOT IN (SELECT d FROM h) ORDER BY d LIMIT 5) SELECT d AS document_id, concat(d, '_b') AS chunk_id FROM l WHERE d IN (SELECT doc_id FROM documents)"
)
def related_chunks(spark, sf_dir):
    """Documents beside the best hits, by their heaviest chunk."""
    docs = load(spark, sf_dir, "documents")
    hits = docs.where("doc_id % 10 = 0").select(F.col("doc_id").alias("document_id"), ((F.col("doc_id") % 100) / 100.0).alias("final"))
    edges = docs.select(F.col("doc_id").alias("src"), (F.col("doc_id") + 1).alias("dst"), F.when(F.col("doc_id") % 3 > 0, 0.9).otherwise(0.5).alias("score"))
    two = F.explode(F.array(F.struct(F.lit("_a").alias("k"), F.lit(0.4).alias("w")), F.struct(F.lit("_b").alias("k"), F.lit(0.8).alias("w"))))
    chunks = docs.select(F.col("doc_id").alias("document_id"), two.alias("c")).select("document_id", F.concat(F.col("document_id").cast("string"), "c.k").alias("chunk_id"), F.col("c.w").alias("authority_weight"))
    return vector.expand_related(hits, edges, chunks).select("document_id", "chunk_id")
