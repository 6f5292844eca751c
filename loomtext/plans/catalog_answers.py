"""Further registered queries: answers and their checks, hits, licences, filters, addresses, records kept in catalogues.

Their SQL states terms and values itself, so that a wrong list in the library shows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.operators import aggregate, classify, extract, filters, generate, graph, rank, score, validate, vector
from loomtext.plans.catalog import C, _ANSWERS, _CHECKS, _DOMAINS, _EDGES, _LEVEL, _NODES, _TURNS, _answers, _domain_counts, _edges, _nodes, _turns, query
from loomtext.plans.tables_catalogue import Catalogue
from loomtext.sources.scratch import Scratch
from loomtext.sources.tables import legal_corpus, load

# --- questions ------------------------------------------------------------------------------------------------

_QUESTION = "concat(CASE conv_id % 7 WHEN 0 THEN 'How does HMRC see this? ' WHEN 1 THEN 'Challenge this view. ' WHEN 2 THEN 'What will the court say? ' WHEN 3 THEN 'Is VAT due on this contract? ' WHEN 4 THEN 'Defend an appeal. ' WHEN 5 THEN 'A dispute on compliance. ' ELSE '' END, substr(text, 1, 40))"
_AREA = "CASE conv_id % 5 WHEN 0 THEN 'tax' WHEN 1 THEN 'employment' WHEN 2 THEN 'housing' WHEN 3 THEN 'criminal' ELSE NULL END"
_PLACE = "CASE turn % 3 WHEN 0 THEN 'scotland' WHEN 1 THEN 'england_wales' ELSE NULL END"
_QUESTIONS = f"q AS (SELECT conv_id, turn, {_QUESTION} AS query, {_AREA} AS area, {_PLACE} AS place FROM conversations WHERE role = 'user')"


def _questions(spark, sf_dir):
    users = load(spark, sf_dir, "conversations").where("role = 'user'")
    return users.select("conv_id", "turn", F.expr(_QUESTION).alias("query"), F.expr(_AREA).alias("area"), F.expr(_PLACE).alias("place"))


@query(
    f"WITH {_QUESTIONS}, l AS (SELECT *, lower(query) AS t FROM q) SELECT conv_id, turn, CASE WHEN area = 'tax' OR contains(t, 'tax') OR contains(t, 'hmrc') OR contains(t, 'vat') OR contains(t, 'compliance') THEN 'tax_compliance' "
    "WHEN contains(t, 'argue') OR contains(t, 'counter') OR contains(t, 'opposing') OR contains(t, 'challenge') OR contains(t, 'defend') THEN 'adversarial' ELSE 'legal_analysis' END AS prompt, "
    "CASE WHEN area = 'tax' OR contains(t, 'tax') OR contains(t, 'hmrc') THEN 'tax_analysis' WHEN contains(t, 'litigation') OR contains(t, 'court') OR contains(t, 'dispute') THEN 'litigation_analysis' ELSE 'legal_analysis' END AS reasoning FROM l"
)
def question_types(spark, sf_dir):
    q = (F.col("query"), F.col("area"))
    return _questions(spark, sf_dir).select("conv_id", "turn", classify.prompt_type(*q).alias("prompt"), classify.reasoning_type(*q).alias("reasoning"))


_STEPS = (
    "CASE reasoning WHEN 'tax_analysis' THEN ['Identify the taxes', 'Find the legislation', 'Check the guidance', 'Compute the effect', 'Look for reliefs', 'Check compliance duties', 'Conclude'] "
    "WHEN 'litigation_analysis' THEN ['Identify the claims', 'Check procedure', 'Assess evidence', 'Set out the authorities', 'Estimate prospects', 'Consider settlement', 'Conclude'] "
    "ELSE ['Identify the issue', 'Find the governing law', 'Set out the authorities', 'Apply the law to the facts', 'Weigh the counter-arguments', 'Note uncertainty', 'Conclude'] END"
)


@query(
    f"WITH {_QUESTIONS}, l AS (SELECT *, lower(query) AS t FROM q), r AS (SELECT *, CASE WHEN area = 'tax' OR contains(t, 'tax') OR contains(t, 'hmrc') THEN 'tax_analysis' WHEN contains(t, 'litigation') OR contains(t, 'court') OR contains(t, 'dispute') THEN 'litigation_analysis' ELSE 'legal_analysis' END AS reasoning FROM l), "
    f"s AS (SELECT *, {_STEPS} AS steps FROM r) SELECT conv_id, turn, array_to_string(list_concat(list_concat(steps[1:1], [CASE WHEN place IS NOT NULL THEN concat(steps[2], ' in ', place) ELSE steps[2] END]), steps[3:7]), '|') AS chain FROM s"
)
def reasoning_chains(spark, sf_dir):
    chain = generate.reasoning_chain(classify.reasoning_type(F.col("query"), F.col("area")), F.col("place"))
    return _questions(spark, sf_dir).select("conv_id", "turn", F.array_join(chain, "|").alias("chain"))


@query(
    f"WITH {_QUESTIONS}, l AS (SELECT *, lower(query) AS t FROM q) SELECT conv_id, turn, "
    "array_to_string(list_filter(['The authorities may be read differently', CASE WHEN contains(t, 'contract') THEN 'The claim may lie in tort as well' END, CASE WHEN contains(t, 'tax') THEN 'Another tax treatment may apply' END, 'Settlement may serve better than a decision'], lambda x: x IS NOT NULL)[1:3], '|') AS others, "
    "array_to_string(list_filter(['Check time limits', CASE WHEN contains(t, 'court') THEN 'Check the court''s rules' END, CASE WHEN contains(t, 'appeal') THEN 'Check whether leave is needed' END, CASE WHEN area = 'tax' THEN 'Check the review and appeal route' END, CASE WHEN area = 'employment' THEN 'Check early conciliation' END, CASE WHEN area = 'housing' THEN 'Check notice requirements' END], lambda x: x IS NOT NULL)[1:5], '|') AS steps, "
    "CASE WHEN area IS NULL AND place IS NULL THEN 'General question' ELSE concat_ws(chr(10), 'Area: ' || area, 'Jurisdiction: ' || place) END AS context FROM l"
)
def question_points(spark, sf_dir):
    two = F.array(F.lit("a"), F.lit("b"))
    return _questions(spark, sf_dir).select(
        "conv_id", "turn", F.array_join(generate.alternatives(F.col("query"), two), "|").alias("others"), F.array_join(generate.procedural_points(F.col("query"), F.col("area")), "|").alias("steps"),
        generate.query_context(F.col("area"), F.col("place"), F.lit(None).cast("string")).alias("context"),
    )


# --- checks of answers ----------------------------------------------------------------------------------------


@query(
    f"WITH {_ANSWERS}, {_CHECKS}, x AS (SELECT *, high + issues AS violations, {_LEVEL} AS level FROM s) SELECT conv_id, turn, CASE WHEN total >= 0.8 AND violations = 0 THEN 'high' WHEN total >= 0.6 AND violations <= 2 THEN 'medium' WHEN total >= 0.4 THEN 'low' ELSE 'uncertain' END AS confidence, "
    "array_to_string(list_filter([CASE WHEN accuracy < 0.8 THEN 'check the form of citations' END, CASE WHEN issues > 0 THEN 'use more formal structure and language' END, CASE WHEN NOT has_disclaimer THEN 'add a full disclaimer' END], lambda x: x IS NOT NULL), '|') AS suggestions, "
    "CASE WHEN has_disclaimer THEN '' ELSE 'Add disclaimer: D' END AS fixes, concat('Compliance: ', level) AS last_line FROM x"
)
def answer_advice(spark, sf_dir):
    v, disclaimer = F.col("validation"), F.lit("D")
    checked = validate.validate(_answers(spark, sf_dir), this_year=2024)
    return checked.select(
        "conv_id", "turn", v["confidence_level"].alias("confidence"), F.array_join(validate.suggestions(v), "|").alias("suggestions"),
        F.array_join(validate.auto_fixes(v, disclaimer), "|").alias("fixes"), F.substring_index(validate.wrapped(F.col("text"), v, disclaimer), "\n\n", -1).alias("last_line"),
    )


@query(
    f"WITH {_ANSWERS}, k AS (SELECT *, CASE conv_id % 3 WHEN 0 THEN 'general_legal' WHEN 1 THEN 'tax_advice' ELSE 'litigation_advice' END AS kind, lower(text) AS t FROM a), "
    "h AS (SELECT *, CAST(regexp_matches(t, 'not\\s+(?:formal\\s+)?legal\\s+advice') AS INT) + CAST(regexp_matches(t, 'informational\\s+purposes?\\s+only') AS INT) + CAST(regexp_matches(t, 'consult\\s+(?:with\\s+)?(?:a\\s+)?qualified\\s+(?:legal\\s+professional|solicitor|barrister)') AS INT) + CAST(regexp_matches(t, 'professional\\s+legal\\s+advice') AS INT) "
    "+ CAST(regexp_matches(t, 'specific\\s+(?:to\\s+your\\s+)?circumstances') AS INT) + CAST(regexp_matches(t, 'may\\s+not\\s+reflect\\s+(?:the\\s+)?(?:most\\s+)?(?:current|recent)') AS INT) + CAST(regexp_matches(t, 'ai\\s+system') AS INT) + CAST(contains(t, 'disclaimer') AS INT) AS n FROM k) "
    "SELECT conv_id, turn, n AS hits, CAST(n < 3 AS INT) + CAST(kind = 'tax_advice' AND NOT (contains(t, 'hmrc') OR contains(t, 'tax advisor')) AS INT) + CAST(kind = 'litigation_advice' AND NOT (contains(t, 'solicitor') OR contains(t, 'barrister')) AS INT) "
    "+ CAST(regexp_matches(t, 'definitely\\s+will') AS INT) + CAST(regexp_matches(t, 'guaranteed\\s+(?:to\\s+)?(?:win|succeed)') AS INT) + CAST(regexp_matches(t, 'certain\\s+(?:to\\s+)?(?:win|succeed)') AS INT) + CAST(regexp_matches(t, 'no\\s+chance\\s+of\\s+(?:losing|failing)') AS INT) + CAST(regexp_matches(t, 'absolutely\\s+certain') AS INT) AS issues FROM h"
)
def disclaimer_checks(spark, sf_dir):
    kind = F.expr("CASE conv_id % 3 WHEN 0 THEN 'general_legal' WHEN 1 THEN 'tax_advice' ELSE 'litigation_advice' END")
    t = F.col("text")
    return _answers(spark, sf_dir).select("conv_id", "turn", validate.disclaimer_hits(t).alias("hits"), F.size(validate.disclaimer_issues(t, kind)).alias("issues"))


@query(
    f"WITH {_QUESTIONS} SELECT DISTINCT kind, area, concat_ws(chr(10) || chr(10), concat('This text was produced by an AI system for informational purposes only', CASE kind WHEN 'tax_advice' THEN ' and is not tax advice. Consult a qualified tax advisor or HMRC about your specific circumstances; it may not reflect the most recent rules.' "
    "WHEN 'litigation_advice' THEN '. Consult a qualified solicitor or barrister about your specific circumstances before any proceedings.' ELSE ' and is not legal advice. Consult a qualified legal professional about your specific circumstances; it may not reflect the most recent law.' END), "
    "CASE area WHEN 'criminal' THEN 'Criminal matters call for immediate professional representation.' WHEN 'immigration' THEN 'Immigration law changes often; professional advice is essential.' WHEN 'family' THEN 'Family matters call for professional guidance and representation.' WHEN 'employment' THEN 'Employment disputes may be subject to short time limits; take qualified advice.' END) AS disclaimer "
    "FROM (SELECT area, CASE conv_id % 4 WHEN 0 THEN 'general_legal' WHEN 1 THEN 'tax_advice' WHEN 2 THEN 'litigation_advice' ELSE 'other' END AS kind FROM q)"
)
def required_disclaimers(spark, sf_dir):
    kinds = _questions(spark, sf_dir).select("area", F.expr("CASE conv_id % 4 WHEN 0 THEN 'general_legal' WHEN 1 THEN 'tax_advice' WHEN 2 THEN 'litigation_advice' ELSE 'other' END").alias("kind"))
    return kinds.select("kind", "area", validate.required_disclaimer(F.col("kind"), F.col("area")).alias("disclaimer")).distinct()


_CITING = "concat(CASE doc_id % 4 WHEN 0 THEN 'It was held in ' WHEN 1 THEN 'See ' WHEN 2 THEN 'A ruling of note is ' ELSE 'Compare ' END, '[2010] ', CASE doc_id % 3 WHEN 0 THEN 'UKSC' WHEN 1 THEN 'EWHC' ELSE 'EWCA' END, ' 12, then [2011] ', CASE doc_id % 2 WHEN 0 THEN 'EWHC' ELSE 'UKSC' END, ' 7.')"


@query(
    f"WITH t AS (SELECT doc_id, {_CITING} AS text FROM documents) SELECT doc_id, CASE WHEN contains(lower(text), 'held') OR contains(lower(text), 'ruling') THEN '' ELSE array_to_string(regexp_extract_all(text, '\\[\\d{{4}}\\]\\s+[A-Z]+\\s+\\d+'), '|') END AS dangling, "
    "CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 2 END <= CASE doc_id % 2 WHEN 0 THEN 3 ELSE 1 END AS ordered FROM t"
)
def citation_contexts(spark, sf_dir):
    """Citations without a word of context near them, and whether levels never fall."""
    texts = load(spark, sf_dir, "documents").select("doc_id", F.expr(_CITING).alias("text"))
    return texts.select("doc_id", F.array_join(validate.dangling_citations("text"), "|").alias("dangling"), validate.hierarchy_ordered(F.col("text")).alias("ordered"))


@query(
    f"{C}, t AS (SELECT doc_id, lower(content) AS t, CASE doc_id % 7 WHEN 0 THEN 'criminal' WHEN 1 THEN 'tax' WHEN 2 THEN 'employment' WHEN 3 THEN 'property' WHEN 4 THEN 'contract' WHEN 5 THEN 'family' ELSE NULL END AS area FROM legal_corpus), "
    "c AS (SELECT *, CASE area WHEN 'criminal' THEN contains(t, 'crime') OR contains(t, 'criminal') OR contains(t, 'prosecution') OR contains(t, 'defendant') OR contains(t, 'guilty') WHEN 'tax' THEN contains(t, 'tax') OR contains(t, 'hmrc') OR contains(t, 'revenue') OR contains(t, 'vat') OR contains(t, 'duty') "
    "WHEN 'employment' THEN contains(t, 'employment') OR contains(t, 'worker') OR contains(t, 'employer') OR contains(t, 'dismissal') WHEN 'property' THEN contains(t, 'property') OR contains(t, 'land') OR contains(t, 'conveyancing') OR contains(t, 'lease') WHEN 'contract' THEN contains(t, 'contract') OR contains(t, 'agreement') OR contains(t, 'breach') OR contains(t, 'terms') ELSE true END AS fits FROM t) "
    "SELECT doc_id, fits, CAST(area IS NOT NULL AND NOT fits AS INT) + CAST(doc_id % 2 = 0 AND doc_id % 3 = 0 AS INT) AS issues FROM c"
)
def factual_checks(spark, sf_dir):
    """Areas against texts, and a jurisdiction against those that are mentioned."""
    area = F.expr("CASE doc_id % 7 WHEN 0 THEN 'criminal' WHEN 1 THEN 'tax' WHEN 2 THEN 'employment' WHEN 3 THEN 'property' WHEN 4 THEN 'contract' WHEN 5 THEN 'family' ELSE NULL END")
    place = F.expr("CASE WHEN doc_id % 2 = 0 THEN 'scotland' END")
    mentioned = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("wales"))).otherwise(F.array().cast("array<string>"))
    docs = legal_corpus(spark, sf_dir).select("doc_id", "content", area.alias("area"), place.alias("place"), mentioned.alias("mentioned"))
    fits = classify.area_consistent(F.col("content"), F.col("area"))
    return docs.select("doc_id", fits.alias("fits"), F.size(validate.factual_issues(F.col("content"), F.col("area"), F.col("place"), F.col("mentioned"), fits)).alias("issues"))


@query(
    f"WITH {_ANSWERS} SELECT conv_id, turn, n, CASE WHEN n > 0 THEN 0.8::DOUBLE ELSE 0.5::DOUBLE END AS score FROM (SELECT conv_id, turn, "
    "len(regexp_extract_all(text, '(?i)\\[(\\d{4})\\]\\s+(UKSC|UKHL|UKPC|EWCA|EWHC|UKUT|UKFTT|CSIH|CSOH|NICA|NIQB)\\s+(\\d+)')) * 0 + CASE WHEN contains(text, '[1850] UKSC 1') THEN 1 ELSE 0 END + CASE WHEN contains(text, 'section 5') THEN 1 ELSE 0 END AS n FROM a)"
)
def response_citations(spark, sf_dir):
    c = score.response_citations(F.col("text"))
    return _answers(spark, sf_dir).select("conv_id", "turn", c["n"].alias("n"), c["score"].alias("score"))


@query(f"WITH {_TURNS}, m AS (SELECT conv_id, turn, length(text) AS n, (conv_id % 10) / 10.0::DOUBLE AS hit, (turn % 4) / 4.0::DOUBLE AS cites, lower(text) AS t FROM p), c AS (SELECT *, (hit + cites + 0.7::DOUBLE + CASE WHEN n > 500 AND (contains(t, 'analysis') OR contains(t, 'conclusion') OR contains(t, 'recommendation')) THEN 0.8 WHEN n > 200 THEN 0.6 ELSE 0.3 END::DOUBLE + CASE conv_id % 3 WHEN 0 THEN 0.8 WHEN 1 THEN 1.0 ELSE 0.5 END::DOUBLE) / 5.0::DOUBLE AS confidence FROM m) SELECT conv_id, turn, round(confidence, 6) AS confidence, CASE WHEN confidence > 0.8 THEN 'high' WHEN confidence > 0.6 THEN 'medium' ELSE 'low' END AS band, CASE WHEN conv_id % 6 > 3 THEN 'high' WHEN conv_id % 6 = 0 THEN 'low' ELSE 'medium' END AS risk FROM c")
def answer_confidence(spark, sf_dir):
    wanted = F.when(F.col("conv_id") % 3 == 0, F.lit(None).cast("string")).otherwise("x")
    value = score.rag_confidence((F.col("conv_id") % 10) / 10.0, (F.col("turn") % 4) / 4.0, F.lit(0.7), F.col("output"), wanted, F.col("conv_id") % 3 == 1)
    risks = F.slice(F.array(*[F.lit(i) for i in range(6)]), F.lit(1), (F.col("conv_id") % 6).cast("int"))
    turns = _turns(spark, sf_dir).select("conv_id", "turn", value.alias("confidence"), score.risk_level(risks).alias("risk"))
    return turns.select("conv_id", "turn", F.round("confidence", 6).alias("confidence"), score.confidence_band(F.col("confidence")).alias("band"), "risk")


@query(f"WITH {_TURNS}, s AS (SELECT CASE conv_id % 3 WHEN 0 THEN 'tax' WHEN 1 THEN 'court' ELSE 'other' END AS query_type, (conv_id % 11) / 10.0::DOUBLE AS score, turn % 5 AS n_authorities FROM p) SELECT query_type, count(*) AS n, round(avg(score), 6) AS avg_score, round(avg(n_authorities), 6) AS avg_authorities, round(avg(CAST(score > 0.6 AS INT)), 6) AS success_rate FROM s GROUP BY ROLLUP (query_type)")
def run_statistics(spark, sf_dir):
    kind = F.expr("CASE conv_id % 3 WHEN 0 THEN 'tax' WHEN 1 THEN 'court' ELSE 'other' END")
    runs = _turns(spark, sf_dir).select(kind.alias("query_type"), ((F.col("conv_id") % 11) / 10.0).alias("score"), (F.col("turn") % 5).alias("n_authorities"))
    out = aggregate.run_statistics(runs)
    return out.select("query_type", "n", *[F.round(c, 6).alias(c) for c in ("avg_score", "avg_authorities", "success_rate")])


# --- hits and precedents --------------------------------------------------------------------------------------

_HITS = "h AS (SELECT doc_id, concat('Rent and tax note ', CAST(doc_id AS VARCHAR(20))) AS title, 1.0 + (doc_id % 9) / 10.0::DOUBLE AS a, 0.8 + (doc_id % 5) / 10.0::DOUBLE AS t, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE (doc_id % 10) / 10.0::DOUBLE END AS s FROM documents)"


@query(
    f"WITH {_HITS} SELECT doc_id, round(coalesce(1.0 + 0.5 * s, 1.0), 6)::DOUBLE AS citation, round(least(1.0, 0.3 + 0.3 + CASE doc_id % 3 WHEN 0 THEN 0.1 WHEN 1 THEN 0.2 ELSE 0.0 END), 6)::DOUBLE AS relevance, "
    "coalesce(nullif(concat_ws('; ', CASE WHEN a > 1.5 THEN 'high authority source' END, CASE WHEN t > 1.0 THEN 'recent' END, CASE WHEN coalesce(1.0 + 0.5 * s, 1.0) > 1.2 THEN 'frequently cited' END), ''), 'content match') AS explanation, "
    "CASE WHEN coalesce(s, 0) > 0.8 THEN 'very high' WHEN coalesce(s, 0) > 0.7 THEN 'high' WHEN coalesce(s, 0) > 0.6 THEN 'significant' WHEN coalesce(s, 0) > 0.4 THEN 'moderate' ELSE 'limited' END AS significance FROM h"
)
def hit_scores(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("Rent and tax note "), F.col("doc_id").cast("string")).alias("title"), (1.0 + (F.col("doc_id") % 9) / 10.0).alias("a"), (0.8 + (F.col("doc_id") % 5) / 10.0).alias("t"),
        F.when(F.col("doc_id") % 4 != 0, (F.col("doc_id") % 10) / 10.0).alias("s"),
        F.expr("CASE doc_id % 3 WHEN 0 THEN array('Rents') WHEN 1 THEN array('rent act', 'Taxes') ELSE array('other') END").alias("keywords"),
    )
    citation = score.citation_boost(F.col("s"))
    return docs.select(
        "doc_id", F.round(citation, 6).alias("citation"), F.round(score.query_relevance(F.array(F.lit("Rent"), F.lit("TAX")), F.col("title"), F.col("keywords")), 6).alias("relevance"),
        score.hit_explanation(F.col("a"), F.col("t"), citation).alias("explanation"), classify.significance(F.coalesce("s", F.lit(0.0))).alias("significance"),
    )


def _cases(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.concat(F.lit("Lease case "), F.col("source")).alias("title"), ((F.col("doc_id") % 97) / 97.0).alias("authority"), (F.col("doc_id") % 9).alias("cites"),
        (F.col("doc_id") % 5).alias("positive"), (F.col("doc_id") % 3).alias("negative"), F.expr("CASE doc_id % 3 WHEN 0 THEN 'housing' ELSE 'tax' END").alias("area"),
        F.expr("CASE doc_id % 4 WHEN 0 THEN 'uk_wide' WHEN 1 THEN 'scotland' ELSE 'england_wales' END").alias("jurisdiction"), F.array(F.lit("rent"), F.col("lang")).alias("keywords"),
    )


_CASES = "c AS (SELECT doc_id AS id, (doc_id % 97) / 97.0::DOUBLE AS authority, doc_id % 9 AS cites, doc_id % 5 AS positive, doc_id % 3 AS negative, CASE doc_id % 3 WHEN 0 THEN 'housing' ELSE 'tax' END AS area, CASE doc_id % 4 WHEN 0 THEN 'uk_wide' WHEN 1 THEN 'scotland' ELSE 'england_wales' END AS jurisdiction, lang FROM documents)"


@query(f"WITH {_CASES} SELECT id FROM c WHERE authority > 0.7 AND cites > 3 AND positive > negative ORDER BY authority + 0.1::DOUBLE * cites DESC, id LIMIT 20")
def landmark_cases(spark, sf_dir):
    return graph.landmarks(_cases(spark, sf_dir)).select("id")


@query(
    f"WITH {_CASES}, p AS (SELECT * FROM c WHERE authority >= 0.3 AND area = 'housing' AND jurisdiction IN ('scotland', 'uk_wide') ORDER BY authority DESC, id LIMIT 20), r AS (SELECT *, least(1.0::DOUBLE, 0.3::DOUBLE + CAST(CASE WHEN lang = 'en' THEN 4 ELSE 2 END AS DOUBLE) * 0.1::DOUBLE) AS relevance FROM p) "
    "SELECT id, round(0.7::DOUBLE * authority + 0.3::DOUBLE * relevance, 6) AS combined FROM r ORDER BY 0.7::DOUBLE * authority + 0.3::DOUBLE * relevance DESC, id LIMIT 10"
)
def precedent_hits(spark, sf_dir):
    out = graph.precedent_search(_cases(spark, sf_dir), ["lease", "rent", "en"], area="housing", jurisdiction="scotland")
    return out.select("id", F.round("combined", 6).alias("combined"))


@query(f"WITH {_EDGES}, citing AS (SELECT DISTINCT src AS id FROM e WHERE dst = 1 ORDER BY id LIMIT 10) SELECT 'citing' AS kind, id FROM citing")
def citing_cases(spark, sf_dir):
    """Each document here cites one other, so those that cite document 1 cite nothing else."""
    return graph.neighbours(_edges(spark, sf_dir), 1)


@query(
    "WITH a AS (SELECT doc_id % 50 AS document_id, doc_id / 1000.0::DOUBLE AS score FROM documents WHERE doc_id % 2 = 0), b AS (SELECT doc_id % 80 AS document_id, doc_id / 1000.0::DOUBLE AS score FROM documents WHERE doc_id % 2 = 1), "
    "u AS (SELECT document_id, score, 0 AS k FROM a UNION ALL SELECT document_id, score, 1 FROM b) SELECT document_id, score FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY k, score DESC) AS r FROM u) WHERE r = 1"
)
def merged_hits(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    part = lambda n, m: docs.where(F.col("doc_id") % 2 == n).select((F.col("doc_id") % m).alias("document_id"), (F.col("doc_id") / 1000.0).alias("score"))
    return rank.merge_hits(part(0, 50), part(1, 80))


@query(
    "WITH h AS (SELECT CAST(doc_id % 8 AS VARCHAR) AS authority_level, lang AS jurisdiction, source AS area, CASE WHEN (doc_id % 10) / 10.0 > 0.8 AND doc_id % 4 = 3 THEN concat('t', CAST(doc_id AS VARCHAR)) END AS landmark FROM documents) "
    "SELECT dimension, value, count(*) AS n FROM (SELECT 'authority_level' AS dimension, authority_level AS value FROM h UNION ALL SELECT 'jurisdiction', jurisdiction FROM h UNION ALL SELECT 'area', area FROM h UNION ALL SELECT 'landmark', landmark FROM h) WHERE value IS NOT NULL GROUP BY 1, 2"
)
def hit_analysis(spark, sf_dir):
    hits = load(spark, sf_dir, "documents").select(
        ((F.col("doc_id") % 10) / 10.0).alias("score"), F.when(F.col("doc_id") % 4 == 3, 1.3).otherwise(1.0).alias("citation_boost"), F.concat(F.lit("t"), F.col("doc_id").cast("string")).alias("title"),
        (F.col("doc_id") % 8).alias("authority_level"), F.col("lang").alias("jurisdiction"), F.col("source").alias("area"),
    )
    return aggregate.citation_analysis(hits)


_NODE_RANK = "r0 AS (SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM n) AS rank FROM n)" + "".join(
    f", g{k} AS (SELECT n.id, coalesce(sum(r{k - 1}.rank / o.k), 0.0::DOUBLE) AS got FROM n LEFT JOIN e ON e.dst = n.id LEFT JOIN r{k - 1} ON r{k - 1}.id = e.src LEFT JOIN o ON o.src = e.src GROUP BY n.id), "
    f"r{k} AS (SELECT id, 0.15::DOUBLE / (SELECT count(*) FROM n) + 0.85::DOUBLE * (got + (1.0::DOUBLE - (SELECT sum(got) FROM g{k})) / (SELECT count(*) FROM n)) AS rank FROM g{k})"
    for k in range(1, 9)
)


@query(f"WITH {_EDGES}, {_NODES}, o AS (SELECT src, count(*)::DOUBLE AS k FROM e GROUP BY src), {_NODE_RANK} SELECT id, round(rank, 9) AS rank FROM r8")
def page_rank_rounds(spark, sf_dir):
    """Eight rounds, as SQL has no loop that ends by a tolerance."""
    from loomtext.sources.scratch import durable

    return graph.page_rank(_nodes(spark, sf_dir), _edges(spark, sf_dir), rounds=8, tolerance=0.0, durable=durable(spark)).select("id", F.round("rank", 9).alias("rank"))


@query()
def vector_cells_topk(spark, sf_dir):
    """The inverted file: every vector indexed, every twentieth id a query, half of the cells probed."""
    items = load(spark, sf_dir, "embeddings")
    centres = vector.train_cells(items, 32)
    index = Scratch(spark).put(vector.cell_index(items, centres), "cells")
    queries = items.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vector.search_cells(index, queries, centres, 10, probes=16).select("query_id", "vec_id", F.round("score", 6).alias("score"))


# --- licences -------------------------------------------------------------------------------------------------

_NAMES = "CASE doc_id % 12 WHEN 0 THEN ' MIT License ' WHEN 1 THEN 'Apache 2.0' WHEN 2 THEN 'apache licence v2' WHEN 3 THEN 'New BSD 3-Clause' WHEN 4 THEN 'BSD 2-clause' WHEN 5 THEN 'bsd' WHEN 6 THEN 'LGPL v3' WHEN 7 THEN 'Affero GPL' WHEN 8 THEN 'gpl-3.0' WHEN 9 THEN 'MPL 1.1' WHEN 10 THEN 'Proprietary' ELSE NULL END"
_NAMED = "CASE doc_id % 12 WHEN 0 THEN 'MIT' WHEN 1 THEN 'Apache-2.0' WHEN 2 THEN 'Apache-2.0' WHEN 3 THEN 'BSD-3-Clause' WHEN 4 THEN 'BSD-2-Clause' WHEN 5 THEN 'BSD' WHEN 6 THEN 'LGPL' WHEN 7 THEN 'AGPL' WHEN 8 THEN 'GPL-3.0' WHEN 9 THEN 'MPL-2.0' WHEN 10 THEN 'Proprietary' ELSE NULL END"
_GRANTS = "CASE doc_id % 9 WHEN 0 THEN 'Permission is hereby granted, free of charge, WITHOUT WARRANTY OF ANY KIND' WHEN 1 THEN 'Apache License Version 2.0' WHEN 2 THEN 'GNU Affero General Public License' WHEN 3 THEN 'gnu general public license, Version 2' WHEN 4 THEN 'Redistribution and use in source and binary forms' WHEN 5 THEN 'Mozilla Public License' WHEN 6 THEN 'CC0 public domain' WHEN 7 THEN 'Creative Commons Attribution' ELSE 'none' END"
_GRANTED = "CASE doc_id % 9 WHEN 0 THEN 'MIT' WHEN 1 THEN 'Apache-2.0' WHEN 2 THEN 'AGPL-3.0' WHEN 3 THEN 'GPL-2.0' WHEN 4 THEN 'BSD-2-Clause' WHEN 5 THEN 'MPL-2.0' WHEN 6 THEN 'CC0-1.0' WHEN 7 THEN 'CC-BY' ELSE NULL END"


@query(f"SELECT doc_id, {_NAMED} AS license, {_GRANTED} AS inferred, coalesce({_NAMED} = 'MIT', true) AS agree FROM documents")
def license_checks(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", F.expr(_NAMES).alias("name"), F.expr(_GRANTS).alias("text"))
    return docs.select("doc_id", classify.license_name(F.col("name")).alias("license"), classify.license_of_text(F.col("text")).alias("inferred"), classify.licenses_agree(F.col("name"), F.lit("mit")).alias("agree"))


@query(
    "WITH d AS (SELECT source AS name, CASE doc_id % 3 WHEN 0 THEN 'local' WHEN 1 THEN 'pypi' ELSE 'github_api' END AS origin, doc_id % 3 AS priority, CASE WHEN source < 'src15' THEN 'MIT' WHEN doc_id % 3 = 0 THEN 'BSD' ELSE 'GPL' END AS license FROM documents) "
    "SELECT name, CASE WHEN count(DISTINCT license) = 1 THEN any_value(license) ELSE min_by(license, priority) END AS license FROM d GROUP BY name"
)
def license_conflicts(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(
        F.col("source").alias("name"), F.expr("CASE doc_id % 3 WHEN 0 THEN 'local' WHEN 1 THEN 'pypi' ELSE 'github_api' END").alias("source"),
        F.expr("CASE WHEN source < 'src15' THEN 'MIT' WHEN doc_id % 3 = 0 THEN 'BSD' ELSE 'GPL' END").alias("license"), "text",
    )
    return aggregate.resolve_licenses(docs).select("name", "license")


# --- filters and addresses ------------------------------------------------------------------------------------

_CHUNKS = "k AS (SELECT doc_id, (doc_id % 10) / 10.0::DOUBLE AS w, lang AS area, CASE doc_id % 3 WHEN 0 THEN 'uk_wide' WHEN 1 THEN 'scotland' ELSE 'england_wales' END AS place, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE make_date(CAST(2000 + doc_id % 30 AS INT), 1, 1) END AS since, text FROM documents)"


@query(f"WITH {_CHUNKS} SELECT doc_id FROM k WHERE w >= 0.5 AND area = 'en' AND place IN ('scotland', 'uk_wide') AND (since IS NULL OR since <= DATE '2015-06-01') AND length(text) >= 100")
def filtered_chunks(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", "text", ((F.col("doc_id") % 10) / 10.0).alias("authority_weight"), F.col("lang").alias("area"), F.expr("CASE doc_id % 3 WHEN 0 THEN 'uk_wide' WHEN 1 THEN 'scotland' ELSE 'england_wales' END").alias("jurisdiction"),
        F.when(F.col("doc_id") % 5 != 0, F.make_date((2000 + F.col("doc_id") % 30).cast("int"), F.lit(1), F.lit(1))).alias("effective_date"),
    )
    kept = filters.search_filter(docs, area="en", jurisdiction="scotland", min_authority=0.5, as_of="2015-06-01")
    return filters.min_length(kept, "text", 100).select("doc_id")


@query("WITH d AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'advanced' WHEN 1 THEN 'basic' ELSE NULL END AS c FROM documents) SELECT 'advanced' AS phase, doc_id FROM d WHERE c = 'advanced' UNION ALL SELECT 'basic', doc_id FROM d")
def phase_gates(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", F.expr("CASE doc_id % 3 WHEN 0 THEN 'advanced' WHEN 1 THEN 'basic' ELSE NULL END").alias("complexity"))
    one = lambda p: filters.complexity_gate(docs, p).select(F.lit(p).alias("phase"), "doc_id")
    return one("advanced").unionByName(one("basic"))


@query("WITH d AS (SELECT doc_id, length(text) AS n FROM documents) SELECT CAST(doc_id AS VARCHAR) AS item FROM d WHERE n > 50 AND n % 60 > 50 AND doc_id % 3 <> 1")
def complete_items(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("item"), F.length("text").alias("n"), "doc_id")
    files = docs.select("item", F.lit("text").alias("kind"), F.col("n").alias("length")).unionByName(docs.select("item", F.lit("metadata").alias("kind"), (F.col("n") % 60).alias("length")))
    return filters.complete_downloads(files.unionByName(docs.where("doc_id % 3 <> 1").select("item", F.lit("html").alias("kind"), F.lit(1).alias("length"))))


@query(
    f"{C}, r AS (SELECT doc_id, lower(concat(title, ' ', substr(content, 1, 1000))) AS t, CASE doc_id % 4 WHEN 0 THEN '/data/HMRC/x' ELSE '/data/cases' END AS dir FROM legal_corpus) SELECT doc_id, doc_id % 4 = 0 OR contains(t, 'hmrc') OR contains(t, 'tax') OR contains(t, 'vat') OR contains(t, 'revenue') OR contains(t, 'paye') AS is_tax FROM r"
)
def routed_tax(spark, sf_dir):
    folder = F.expr("CASE doc_id % 4 WHEN 0 THEN '/data/HMRC/x' ELSE '/data/cases' END")
    return legal_corpus(spark, sf_dir).select("doc_id", filters.tax_router(folder, F.col("title"), F.col("content")).alias("is_tax"))


_CASE_URL = "concat('https://', CASE doc_id % 3 WHEN 0 THEN 'www.example.org' WHEN 1 THEN 'example.org' ELSE 'other.net' END, '/', CASE doc_id % 2 WHEN 0 THEN 'ew' ELSE 'scot' END, '/cases/EWCA%20Civ/', CAST(doc_id AS VARCHAR(20)), CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '/' ELSE '.html' END)"


@query(
    f"WITH u AS (SELECT doc_id, {_CASE_URL} AS url FROM documents) SELECT doc_id, doc_id % 5 > 1 AND doc_id % 2 = 0 AS is_case, doc_id % 3 < 2 AND doc_id % 2 = 0 AS is_valid, concat(CAST(doc_id AS VARCHAR), CASE WHEN doc_id % 5 > 1 THEN '.html' ELSE '' END) AS file, "
    "concat('https://api.example/api/content/', CASE doc_id % 2 WHEN 0 THEN 'ew' ELSE 'scot' END, '/cases/EWCA%20Civ/', CAST(doc_id AS VARCHAR), CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '/' ELSE '.html' END) AS api FROM u"
)
def case_addresses(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", F.expr(_CASE_URL).alias("url"))
    u = F.col("url")
    return docs.select("doc_id", filters.case_url(u, ["/ew/cases/", "/eu/"]).alias("is_case"), filters.valid_host(u, ["www.example.org", "example.org"], "/ew/").alias("is_valid"), extract.file_name(u).alias("file"), extract.api_url(u, "https://api.example").alias("api"))


# --- records --------------------------------------------------------------------------------------------------


@query(f"{C} SELECT doc_id, concat_ws(' ', '[' || lang || ']', CASE WHEN doc_id % 3 > 0 THEN '[' || source || ']' END, concat('[authority:', CAST(doc_id % 8 AS VARCHAR), ']'), CASE WHEN doc_id % 2 = 0 THEN '[Section 2]' END) AS prefix, CASE doc_id % 8 WHEN 0 THEN title WHEN 2 THEN title ELSE 'UK Legislation' END AS act FROM legal_corpus")
def context_prefixes(spark, sf_dir):
    docs = legal_corpus(spark, sf_dir)
    prefix = extract.context_prefix(F.col("lang"), F.when(F.col("doc_id") % 3 > 0, F.col("source")), F.col("doc_id") % 8, F.when(F.col("doc_id") % 2 == 0, F.lit("Section 2")))
    return docs.select("doc_id", prefix.alias("prefix"), extract.act_name(F.concat(F.lit("\n"), F.when(F.col("doc_id") % 8 < 3, F.col("title")).otherwise("a note"))).alias("act"))


@query("SELECT doc_id, concat('q', CAST(doc_id AS VARCHAR)) AS question, source AS answer FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 'second', NULL FROM documents WHERE doc_id % 3 = 0")
def json_answers(spark, sf_dir):
    """Lists inside free text; what is no list gives no rows."""
    body = F.concat(F.lit('Sure: [{"question": "q'), F.col("doc_id").cast("string"), F.lit('", "answer": "'), F.col("source"), F.lit('"}, {"question": "second"}] and more [1]'))
    docs = load(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, body).when(F.col("doc_id") % 3 == 1, "no list").otherwise("[not json]").alias("response"))
    return docs.select("doc_id", F.inline(extract.json_rows(F.col("response"), "struct<question:string,answer:string>")))


@query(f"{C} SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS amendments, 3 AS sections, concat('BIM', CAST(10000 + doc_id % 500 AS VARCHAR)) AS code FROM legal_corpus")
def record_counts(spark, sf_dir):
    docs = legal_corpus(spark, sf_dir)
    noted = F.when(F.col("doc_id") % 2 == 0, F.concat(F.col("content"), F.lit(" [as Amended by SI 2001/5] "))).otherwise(F.col("content"))
    return docs.select("doc_id", F.size(extract.amendments(noted)).alias("amendments"), extract.section_count(F.col("content")).alias("sections"), extract.manual_code(F.lit("/x"), F.lit("Note"), F.col("content")).alias("code"))


@query(f"{C} SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN coalesce(CASE doc_id % 4 WHEN 0 THEN NULL ELSE doc_id % 4 END, 8) WHEN 3 THEN 3 ELSE 7 END AS level FROM legal_corpus")
def authority_levels(spark, sf_dir):
    kind = F.expr("CASE doc_id % 5 WHEN 0 THEN 'statute' WHEN 1 THEN 'regulation' WHEN 2 THEN 'case' WHEN 3 THEN 'hmrc_guidance' ELSE 'commentary' END")
    return load(spark, sf_dir, "documents").select("doc_id", classify.authority_level(kind, F.when(F.col("doc_id") % 4 > 0, F.col("doc_id") % 4)).alias("level"))


@query("SELECT count(*) AS n, count(DISTINCT lang) AS acts, count(DISTINCT source) AS files, round(avg(length(source)), 6) AS avg_question, round(avg(length(text)), 6) AS avg_answer FROM documents")
def question_totals(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").select(F.col("source").alias("question"), F.col("text").alias("answer"), F.col("lang").alias("act"), F.col("source").alias("file"))
    out = aggregate.qa_summary(rows)
    return out.select("n", "acts", "files", F.round("avg_question", 6).alias("avg_question"), F.round("avg_answer", 6).alias("avg_answer"))


@query(
    "WITH d AS (SELECT lang AS tax_domain, source AS document_type, CAST(doc_id % 9 AS VARCHAR) AS authority_level, doc_id % 2 = 0 AS has_examples, doc_id % 3 = 0 AS has_calculations, doc_id % 5 = 0 AS affects_individuals, doc_id % 7 = 0 AS affects_companies FROM documents) "
    "SELECT dimension, value, count(*) AS n FROM (SELECT 'tax_domain' AS dimension, tax_domain AS value FROM d UNION ALL SELECT 'document_type', document_type FROM d UNION ALL SELECT 'authority_level', authority_level FROM d) GROUP BY 1, 2 UNION ALL SELECT 'total', 'has_examples', count_if(has_examples) FROM d UNION ALL SELECT 'total', 'has_calculations', count_if(has_calculations) FROM d UNION ALL SELECT 'total', 'affects_individuals', count_if(affects_individuals) FROM d UNION ALL SELECT 'total', 'affects_companies', count_if(affects_companies) FROM d"
)
def corpus_totals(spark, sf_dir):
    i = F.col("doc_id")
    docs = load(spark, sf_dir, "documents").select(
        F.col("lang").alias("tax_domain"), F.col("source").alias("document_type"), (i % 9).alias("authority_level"),
        (i % 2 == 0).alias("has_examples"), (i % 3 == 0).alias("has_calculations"), (i % 5 == 0).alias("affects_individuals"), (i % 7 == 0).alias("affects_companies"),
    )
    return aggregate.corpus_summary(docs)


@query("SELECT source AS specialist, lang AS phase, count(*) AS n, CASE WHEN count(*) < 100 THEN 5 WHEN count(*) < 1000 THEN 3 ELSE 2 END AS epochs, CASE WHEN count(*) < 100 THEN 2 WHEN count(*) < 1000 THEN 4 ELSE 8 END AS batch_size FROM documents GROUP BY 1, 2")
def training_configs(spark, sf_dir):
    counts = load(spark, sf_dir, "documents").groupBy(F.col("source").alias("specialist"), F.col("lang").alias("phase")).agg(F.count("*").alias("n"))
    return aggregate.training_config(counts)


@query("SELECT c_custkey AS id, CAST(greatest(0, CAST(floor(abs(c_acctbal) * 10) AS BIGINT) - CAST(c_custkey % 5000 AS BIGINT) - 12570) AS BIGINT) AS taxable FROM customer")
def taxable_incomes(spark, sf_dir):
    income, pension = F.floor(F.abs("c_acctbal") * 10), F.col("c_custkey") % 5000
    return load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), score.income_tax_base(income, pension).cast("long").alias("taxable"))


@query(f"{C}, {_DOMAINS} SELECT kind, n, coalesce(docs, 0) AS docs FROM (VALUES ('income_tax', 3), ('vat', 2), ('corporation_tax', 2), ('optimisation', 6), ('compliance', 5)) t(kind, n) LEFT JOIN k ON domain = kind")
def tax_scenario_kinds(spark, sf_dir):
    """Scenarios of each kind, and the documents of its domain."""
    kinds = generate.tax_scenarios(spark).groupBy("kind").agg(F.count("*").alias("n"))
    return kinds.join(_domain_counts(spark, sf_dir), "kind", "left").select("kind", "n", F.coalesce("docs", F.lit(0)).alias("docs"))


@query(
    "WITH d AS (SELECT doc_id, text, string_split(text, chr(10) || chr(10)) AS p FROM documents WHERE length(text) >= 100) SELECT doc_id, md5(concat('On ''T', CAST(doc_id AS VARCHAR), ''':', chr(10), chr(10), CASE WHEN len(p) > 1 THEN p[1] ELSE substr(text, 1, 500) END, chr(10), chr(10), CASE WHEN len(p) > 1 THEN array_to_string(p[2:3], chr(10) || chr(10)) ELSE substr(text, 501, 1000) END)) AS digest FROM d"
)
def content_answers(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"), F.col("text").alias("content"))
    return generate.content_rows(docs, "legal_specialist").select("doc_id", F.md5("output").alias("digest"))


@query(
    "WITH s AS (SELECT conv_id, list(struct_pack(t := turn, r := role, x := text) ORDER BY turn) AS l FROM conversations GROUP BY conv_id) SELECT conv_id, array_to_string(list_transform(range(1, len(l) + 1), lambda i: concat(CAST(i AS VARCHAR), '. ', l[i].r, chr(10), 'Level: ', CAST(l[i].t AS VARCHAR), chr(10), substr(l[i].x, 1, 300))), chr(10) || chr(10)) AS listing FROM s"
)
def numbered_authorities(spark, sf_dir):
    turns = load(spark, sf_dir, "conversations")
    one = F.struct("turn", F.lit(None).cast("string").alias("citation"), F.col("role").alias("title"), F.col("turn").alias("level"), "text")
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("a"))  # the turns of one conversation
    return grouped.select("conv_id", generate.numbered_authorities(F.col("a")).alias("listing"))


# --- catalogues of tables -------------------------------------------------------------------------------------


@query("SELECT c_custkey AS id, upper(c_name) AS name, c_acctbal AS balance, NULL::INTEGER AS nation, 'new' AS state FROM customer UNION ALL SELECT s_suppkey, upper(s_name), NULL, s_nationkey, 'new' FROM supplier")
def catalogue_changes(spark, sf_dir):
    """A table saved, appended to with other columns, changed in a column, given a new one, and relieved of one."""
    books = Catalogue(spark, Scratch(spark).path("catalogue"))
    customers, suppliers = load(spark, sf_dir, "customer"), load(spark, sf_dir, "supplier")
    books.save("parties", customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")), {"kind": "parties"})
    books.append("parties", suppliers.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")))
    books.update_column("parties", "name", "upper(name)")
    books.add_column("parties", "state", F.lit("new"))
    books.drop_column("parties", "segment")
    return books.load("parties")


@query("SELECT 'parties' AS name, count(*) AS rows, 3 AS columns, 'b' AS kind, 'kept' AS note FROM customer")
def catalogue_records(spark, sf_dir):
    """Rows, columns and merged metadata of a table, as its record has them; a deleted table is not listed."""
    books = Catalogue(spark, Scratch(spark).path("catalogue"))
    parties = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    books.save("parties", parties, {"kind": "a", "note": "kept"})
    books.update_metadata("parties", {"kind": "b"})
    books.save("other", parties.limit(1))
    books.delete("other", confirm=True)
    m = F.col("metadata")
    return books.records().select("name", "rows", F.size("columns").alias("columns"), m["kind"].alias("kind"), m["note"].alias("note"))
