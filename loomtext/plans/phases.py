"""The named pipelines: lists of steps over given inputs, run by ``steps.Pipeline`` with skips, resume and hooks.

What touches a network or a model is a function that the caller gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.operators import aggregate, chunk, classify, extract, filters, generate, graph, validate
from loomtext.plans.steps import Pipeline
from loomtext.sources import web

Fetch = Callable[[str], tuple[int, str]]
Model = Callable[[str], str]


def _item_rows(docs: DataFrame) -> DataFrame:
    """doc_id, title, content to the columns of the row generators."""
    kind = classify.source_type(F.col("title"), F.col("content"))
    return docs.select(F.col("doc_id").alias("id"), "title", kind.alias("type"), F.lit(None).cast("int").alias("year"), F.col("content").alias("text"))


def _tables(docs: DataFrame) -> list[tuple[str, Callable]]:
    """Instruction, completion and question tables of documents, each split 90 / 10."""
    split = lambda df, key: chunk.hash_split(df.withColumn("_key", F.sha2(F.concat_ws("|", *key), 256)), "_key").drop("_key")
    return [
        ("instructions", lambda spark, done: split(generate.instructions(_item_rows(docs)), ["id", "instruction", "output"])),
        ("completions", lambda spark, done: split(generate.completions(_item_rows(docs)), ["id", "text"])),
        ("questions", lambda spark, done: split(generate.question_answers(_item_rows(docs)), ["id", "question", "answer"])),
    ]


def all_tables(docs: DataFrame) -> Pipeline:
    """Every table of a corpus."""
    return Pipeline("all_tables", _tables(docs))


def complete(items: DataFrame, fetch: Fetch, model: Model | None = None) -> Pipeline:
    """Acquisition of items (id, url), tables, and model-written questions, which are optional."""

    def documents(spark: SparkSession, done: dict[str, DataFrame]) -> DataFrame:
        texts = web.download_items(items, fetch).where("format = 'text'")
        return texts.select(F.col("id").alias("doc_id"), F.get(F.split("content", "\n"), 0).alias("title"), "content")

    tables = lambda n: lambda spark, done: _tables(done["documents"])[n][1](spark, done)
    steps = [("documents", documents), *[(name, tables(n)) for n, name in enumerate(("instructions", "completions", "questions"))]]
    return Pipeline("complete", [*steps, ("written", lambda spark, done: _written(done["documents"], model))], optional={"written"})


def _written(docs: DataFrame, model: Model | None) -> DataFrame | None:
    if model is None:
        return None
    sections = docs.select("doc_id", F.coalesce("title", F.lit("")).alias("title"), F.explode(extract.qa_sections(F.col("content"))).alias("s"))
    return generate.model_questions(sections.select("doc_id", "title", F.col("s")["number"].alias("number"), F.col("s")["text"].alias("text")), model)


def housing(legislation: DataFrame, cases: DataFrame, model: Model | None = None) -> Pipeline:
    """Housing law and housing cases (doc_id, title, content), what they are about, their questions, and a summary."""
    start = F.substring("content", 1, 300)
    law = lambda spark, done: legislation.where(filters.housing_legislation(F.col("title"), start)).withColumn("kind", F.lit("legislation"))
    heard = lambda spark, done: cases.where(filters.housing_case(F.col("title"), start, F.col("content"))).withColumn("kind", F.lit("case"))
    both = lambda done: done["legislation"].unionByName(done["cases"]).withColumn("category", classify.housing_category(F.col("content")))
    summary = lambda spark, done: aggregate.histograms(both(done), ["kind", "category"])
    return Pipeline("housing", [("legislation", law), ("cases", heard), ("written", lambda spark, done: _written(both(done), model)), ("summary", summary)], optional={"written"})


def copyright_law(docs: DataFrame, model: Model | None = None) -> Pipeline:
    """Copyright law of a corpus (doc_id, title, content), its tables, and questions."""
    chosen = lambda spark, done: docs.where(filters.copyright_related(F.col("title"), F.substring("content", 1, 300)))
    summary = lambda spark, done: done["chosen"].agg(F.count("*").alias("documents"), F.sum(F.length("content")).alias("characters"))
    tables = lambda spark, done: generate.instructions(_item_rows(done["chosen"]))
    return Pipeline("copyright", [("chosen", chosen), ("instructions", tables), ("written", lambda spark, done: _written(done["chosen"], model)), ("summary", summary)], optional={"written"})


def dynamic(urls: DataFrame, fetch: Fetch, *, specialist: str = "legal_specialist", batches: int | None = None, documents: int | None = None) -> Pipeline:
    """Pages by address (id, url): fetched, read, classed, and made into chat rows of a specialist's first phase.

    ``batches`` of 100 addresses and ``documents`` bound a quick run.
    """
    asked = urls if batches is None else urls.orderBy("id").limit(100 * batches)

    def fetched(spark: SparkSession, done: dict[str, DataFrame]) -> DataFrame:
        page = web.download_items(asked, fetch, formats=(("html", ""),)).where("format = 'html'")
        read = page.select(F.col("id").alias("doc_id"), web.page_content("content").alias("p")).select("doc_id", "p.title", F.col("p.text").alias("content"))
        return read if documents is None else read.orderBy("doc_id").limit(documents)

    classed = lambda spark, done: done["pages"].withColumn("domain", classify.tax_domain(F.col("title"), F.col("content")))
    rows = lambda spark, done: generate.chat_rows(generate.content_rows(done["classed"], specialist), specialist, "phase_1_foundation")
    return Pipeline("dynamic", [("pages", fetched), ("classed", classed), ("rows", rows)])


def quick(urls: DataFrame, fetch: Fetch) -> Pipeline:
    """A bounded run: 20 batches, 100 documents."""
    return dynamic(urls, fetch, specialist="tax_specialist", batches=20, documents=100)


def training(rows: DataFrame, *, domains: dict[str, list[str]], key: str) -> Pipeline:
    """Chat rows of both specialists and all phases, and a configuration for each."""
    made = lambda spark, done: generate.all_phases(rows, domains=domains, key=key)
    counts = lambda done: done["rows"].groupBy(F.col("specialist_type").alias("specialist"), F.col("training_phase").alias("phase")).agg(F.count("*").alias("n"))
    return Pipeline("training", [("rows", made), ("configs", lambda spark, done: aggregate.training_config(counts(done)))])


def enrichment(docs: DataFrame, names: DataFrame, *, as_of: str, this_year: int, max_documents: int | None = None) -> Pipeline:
    """Records, citation graph, authority, training examples, compliance and the final report of a corpus.

    ``docs`` has doc_id, title and content, ``names`` the citation of each document (citation, doc_id).
    """
    chosen = docs if max_documents is None else docs.orderBy("doc_id").limit(max_documents)

    def authority(spark: SparkSession, done: dict[str, DataFrame]) -> DataFrame:
        nodes = done["records"].select(F.col("doc_id").alias("id"), F.col("authority_level").alias("level"), F.lit(None).cast("date").alias("effective_date"))
        edges = done["edges"].select(F.col("citing_doc").alias("src"), F.col("cited_doc").alias("dst"), "relation", "strength")
        return graph.authority(nodes, edges, as_of=F.lit(as_of).cast("date"))

    def compliance(spark: SparkSession, done: dict[str, DataFrame]) -> DataFrame:
        checked = validate.validate(done["examples"].select("level", F.col("output").alias("text")), this_year=this_year)
        return checked.groupBy("level", F.col("validation")["compliance_level"].alias("compliance")).agg(F.count("*").alias("n"))

    return Pipeline(
        "enrichment",
        [
            ("documents", lambda spark, done: chosen),
            ("records", lambda spark, done: extract.legal_metadata(done["documents"])),
            ("edges", lambda spark, done: graph.resolved_edges(graph.edges_from_texts(done["documents"]), names)),
            ("authority", authority),
            ("examples", lambda spark, done: generate.training_examples(done["documents"])),
            ("compliance", compliance),
            ("report", lambda spark, done: final_report(done)),
        ],
    )


def final_report(done: dict[str, DataFrame]) -> DataFrame:
    """(section, dimension, value, n) of the tables of ``enrichment``: what was read, found, scored, written and checked."""
    part = lambda name, df: df.select(F.lit(name).alias("section"), "dimension", "value", F.col("n").cast("double").alias("n"))
    total = lambda name: done[name].agg(F.count("*").alias("n")).select(F.lit("total").alias("dimension"), F.lit(name).alias("value"), "n")
    scores = done["authority"].agg(F.avg("authority").alias("mean_authority"), F.max("authority").alias("highest_authority"), F.sum("cites").alias("citations"))
    long = scores.select(F.explode(F.array(*[F.struct(F.lit("score").alias("dimension"), F.lit(c).alias("value"), F.col(c).cast("double").alias("n")) for c in scores.columns])).alias("p")).select("p.*")
    parts = [
        part("documents", total("documents")), part("records", aggregate.histograms(done["records"], ["source_type", "legal_area", "jurisdiction"])),
        part("graph", total("edges")), part("graph", aggregate.histograms(done["edges"], ["relation"])), part("authority", long),
        part("examples", aggregate.histograms(done["examples"], ["level"])),
        part("compliance", done["compliance"].groupBy(F.lit("compliance").alias("dimension"), F.col("compliance").alias("value")).agg(F.sum("n").alias("n"))),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def training_readme(rows: list[dict], configs: list[dict], *, title: str = "Training data") -> str:
    """A short text on the rows of each specialist and phase and how to train on them.

    ``rows`` have specialist, phase and n, ``configs`` also epochs and batch_size: a line for each, not for each row.
    """
    lines = [f"# {title}", "", "| specialist | phase | rows |", "|---|---|---|"]
    lines += [f"| {r['specialist']} | {r['phase']} | {r['n']} |" for r in sorted(rows, key=lambda r: (r["specialist"], r["phase"]))]
    lines += ["", "Train the phases in order, each on its own rows:", ""]
    lines += [f"- {c['specialist']}, {c['phase']}: {c['epochs']} epochs, batches of {c['batch_size']}" for c in sorted(configs, key=lambda c: (c["specialist"], c["phase"]))]
    return "\n".join([*lines, ""])
