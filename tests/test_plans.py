"""Retrieval, answering, model-written rows, limits."""

import datetime

import pytest
from pyspark.sql import functions as F

from loomtext.operators import aggregate, extract, generate
from loomtext.plans import phases, rag
from loomtext.sources.limits import RateLimiter, with_retries


def test_retrieve_and_answer(spark):
    chunks = spark.createDataFrame(
        [("c1", "d1", "rent and lease", 1.0, "housing", "uk_wide", datetime.date(2023, 6, 1)), ("c2", "d2", "rent", 0.5, "housing", "scotland", None), ("c3", "d3", "tax", 1.0, "tax", "uk_wide", None)],
        "chunk_id string, document_id string, text string, authority_weight double, area string, jurisdiction string, effective_date date",
    )
    embed = lambda texts: [[float("rent" in t), float("tax" in t), 0.1] for t in texts]
    index = rag.build_index(chunks, "text", embed)
    queries = spark.createDataFrame([(1, "May rent rise?", "housing", "scotland", None, [1.0, 0.0, 0.0])], "query_id int, query string, area string, jurisdiction string, client string, embedding array<double>")
    as_of = F.lit("2024-01-01").cast("date")
    hits = rag.retrieve(index, queries, 2, as_of=as_of, area="housing", scenario="litigation")
    assert [r["chunk_id"] for r in hits.orderBy(F.desc("final")).collect()] == ["c1", "c2"]
    assert rag.retrieve(index, queries, 2, as_of=as_of, area="housing", min_authority=0.9).count() == 1
    good = "The analysis applies the relevant law and an applicable principle; conclusion: yes."
    got = rag.answer(hits, queries, lambda p: good if "May rent rise?" in p else "", this_year=2024).first()
    assert got["response"] == good and "rent and lease" in got["prompt"] and 0 <= got["confidence"] <= 1
    empty = rag.answer(hits, queries, lambda p: " ", this_year=2024).first()
    assert empty["response"].startswith("No answer")


def test_model_questions(spark):
    df = spark.createDataFrame([("T", "text"), ("U", "other")], ["title", "text"])
    reply = lambda p: 'Here: [{"question": "q", "answer": "a"}, {"question": "r", "answer": "b"}]' if " T:" in p else "sorry"
    got = generate.model_questions(df, reply).collect()
    assert [(r["title"], r["question"]) for r in got] == [("T", "q"), ("T", "r")]


def test_scenarios_and_phases(spark):
    assert generate.tax_scenarios(spark).count() == 18
    rows = spark.createDataFrame([(f"i{i}", "", "o", "basic", "legal") for i in range(10)], "instruction string, input string, output string, complexity string, domain string")
    out = generate.all_phases(rows, domains={"legal_specialist": ["legal"], "tax_specialist": ["tax"]}, key="row_key")
    assert out.count() == 10 and out.where("split = 'test'").count() == 2


def test_qa_sections(spark):
    text = "1. " + "a" * 120 + "\n2. short\n3. " + "b" * 120
    got = spark.range(1).select(extract.qa_sections(F.lit(text)).alias("x")).first()["x"]
    assert [s["number"] for s in got] == ["1", "3"]
    got = spark.range(1).select(extract.qa_sections(F.lit("p" * 101 + "\n\nq")).alias("x")).first()["x"]
    assert [s["number"] for s in got] == ["Para 1"]


def test_statistics(spark):
    runs = spark.createDataFrame([("a", 0.9, 2), ("a", 0.5, 4), ("b", 0.7, 3)], "query_type string, score double, n_authorities int")
    got = {r["query_type"]: (r["n"], round(r["success_rate"], 3)) for r in aggregate.run_statistics(runs).collect()}
    assert got == {"a": (2, 0.5), "b": (1, 1.0), None: (3, 0.667)}


@pytest.mark.parametrize("limit, window, gap, n", [(10, 1, 0.05, 20), (2, 1, 0.1, 10), (5, 2, 0.1, 10)])
def test_rate_limiter(limit, window, gap, n):
    now = [0.0]
    at = []

    def sleep(s):
        now[0] += s

    limiter = RateLimiter(limit, window, gap, clock=lambda: now[0], sleep=sleep)
    for _ in range(n):
        limiter.wait()
        at.append(now[0])
    assert all(b - a >= gap - 1e-9 for a, b in zip(at, at[1:], strict=False))
    assert all(at[i + limit] - at[i] >= window - 1e-9 for i in range(n - limit))


def test_retries():
    calls, pauses = [], []

    def fails():
        calls.append(1)
        raise OSError

    with pytest.raises(OSError):
        with_retries(fails, sleep=pauses.append)
    assert len(calls) == 3 and pauses == [1.0, 2.0]


DOCS = [
    ("a", "Housing Act 1988", "Section 1 The landlord and tenant follow [2001] UKSC 2 on rent and lease.\n" + "word " * 60),
    ("b", "Smith v Jones", "A tenant and landlord in England before the court on rent, lease, possession and eviction. " + "more " * 60),
    ("c", "Copyright note", "The copyright of performers. " + "text " * 60),
]


def test_named_pipelines(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id string, title string, content string")
    names = spark.createDataFrame([("[2001] UKSC 2", "b")], "citation string, doc_id string")
    done = phases.enrichment(docs, names, as_of="2024-01-01", this_year=2024).run(spark, str(tmp_path))
    report = {(r["section"], r["dimension"], r["value"]): r["n"] for r in done["report"].collect()}
    assert report[("documents", "total", "documents")] == 3 and report[("graph", "total", "edges")] == 1 and report[("examples", "level", "foundation")] == 9
    assert sum(n for (s, _, _), n in report.items() if s == "compliance") == 18 and report[("authority", "score", "citations")] == 1
    assert phases.enrichment(docs, names, as_of="2024-01-01", this_year=2024, max_documents=1).run(spark, str(tmp_path / "one"))["documents"].count() == 1
    made = phases.all_tables(docs).run(spark, str(tmp_path))
    assert made["instructions"].count() == 15 and {r["split"] for r in made["questions"].collect()} == {"test", "train"}
    housed = phases.housing(docs.where("doc_id = 'a'"), docs.where("doc_id <> 'a'")).run(spark, str(tmp_path))
    assert {(r["dimension"], r["value"]): r["n"] for r in housed["summary"].collect() if r["dimension"] == "kind"} == {("kind", "legislation"): 1, ("kind", "case"): 1}
    assert phases.copyright_law(docs).run(spark, str(tmp_path))["summary"].first()["documents"] == 1


def test_acquiring_pipelines(spark, tmp_path):
    page = lambda u: (200, f"<h1>On {u}</h1><p>{'1. ' + 'long text ' * 20}</p>") if u.startswith("u") else (404, "")
    items = spark.createDataFrame([("1", "u1"), ("2", "gone"), ("3", "u3")], "id string, url string")
    done = phases.complete(items, page).run(spark, str(tmp_path))
    assert {r["doc_id"] for r in done["documents"].collect()} == {"1", "3"} and done["instructions"].count() == 10 and "written" not in done
    reply = lambda p: '[{"question": "q", "answer": "a"}]'
    written = phases.complete(items, page, reply).run(spark, str(tmp_path / "model"))["written"]
    assert written.select("question").distinct().count() == 1
    rows = phases.quick(items, page).run(spark, str(tmp_path))["rows"]
    assert rows.count() == 2 and rows.first()["specialist_type"] == "tax_specialist"
    rows = spark.createDataFrame([(f"i{i}", "", "o", "basic", "legal") for i in range(10)], "instruction string, input string, output string, complexity string, domain string")
    trained = phases.training(rows, domains={"legal_specialist": ["legal"]}, key="row_key").run(spark, str(tmp_path))
    configs = [r.asDict() for r in trained["configs"].collect()]
    assert [(c["n"], c["epochs"]) for c in configs] == [(10, 5)]
    assert "| legal_specialist | phase_1_foundation | 10 |" in phases.training_readme(configs, configs)


def test_smoke_run(spark):
    chunks = spark.createDataFrame([("c1", "d1", "rent and lease", 1.0, "housing", "uk_wide", None), ("c2", "d2", "tax", 0.5, "tax", "uk_wide", None)], "chunk_id string, document_id string, text string, authority_weight double, area string, jurisdiction string, effective_date date")
    embed = lambda texts: [[float("rent" in t or "landlord" in t), float("tax" in t), 0.1] for t in texts]
    got = rag.smoke(rag.build_index(chunks, "text", embed), embed, lambda p: "" if "contract" in p else "The analysis applies the law.", as_of=F.lit("2024-01-01").cast("date"), this_year=2024).collect()
    assert {r["query_id"]: r["answered"] for r in got} == {1: True, 2: True, 3: False}


def test_imports_and_version(spark):
    import loomtext

    rows = [("pkg/__init__.py", "import os, numpy as np"), ("pkg/tool.py", "from pkg.core import x\nfrom . import y\nfrom numpy.linalg import norm\nimport duckdb.sql"), ("bad.py", "def"), ("none.py", None)]
    got = {r["name"]: r["files"] for r in extract.third_party_imports(spark.createDataFrame(rows, "path string, source string")).collect()}
    assert got == {"numpy": 2, "duckdb": 1}
    assert loomtext.version() == "0.2.0" and loomtext.version(1700000000) == "0.2.0.1700000000"
