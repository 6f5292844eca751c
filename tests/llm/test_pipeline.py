"""The pipeline over small tables, stage by stage against plain versions."""

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from loomtext.llm import line_dedup


@pytest.fixture(scope="module")
def folder(spark, docs, rows, tmp_path_factory):
    root = tmp_path_factory.mktemp("sf")
    leak = " ".join(f"leak{i}" for i in range(30))
    planted = spark.createDataFrame([(900, " ".join(f"p{i}" for i in range(80)) + " " + leak, "en", "a", 0, "clash", 1, 7, "clash")], docs.schema)
    docs.unionByName(planted).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root)


def test_stages(spark, folder):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, fn in corpus_pipeline.STAGES:
        before = docs.cache()
        docs = fn(spark, before, folder).cache()
        seen[name] = (before, docs)
        if name != "mixing":
            assert docs.columns == columns
    pairs = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    before, after = seen["quality_rules"]
    kept = {d for d, t in pairs(before) if (q := brute.quality_counts(t))[0] >= 50 and q[4] * 2 <= q[0]}
    assert {d for d, _ in pairs(after)} <= kept and 900 in {d for d, _ in pairs(after)}
    before, after = seen["line_dedup"]
    assert dict(pairs(after)) == {d: t for d, t in brute.maximal_runs(pairs(before), line_dedup.MIN_WORDS).items() if t and t.split()}
    before, after = seen["near_dedup"]
    assert {d for d, _ in pairs(after)} == {c for _, c in brute.components(pairs(before), 5, 80).values()}
    before, after = seen["decontamination"]
    assert {d for d, _ in pairs(before)} - {d for d, _ in pairs(after)} == {900}
    before, after = seen["mixing"]
    assert {d for d, _ in pairs(after)} <= {d for d, _ in pairs(before)}
    assert after.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 3").count() == 0
    assert all(t and t.split() for _, t in pairs(after))
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_empty_corpus(spark, folder, empty, tmp_path):
    for _, fn in corpus_pipeline.STAGES:
        assert fn(spark, empty, folder).count() == 0


def test_repeated_rows_and_null_ids(spark, folder, repeated):
    """Each stage alone on rows that come twice and rows without an id: repeated rows fare alike, and none is invented."""
    before = {(r["doc_id"], r["text"]): r["count"] for r in repeated.groupBy("doc_id", "text").count().collect()}
    for name, fn in corpus_pipeline.STAGES:
        got = fn(spark, repeated, folder)
        counts = {(r["doc_id"], r["text"]): r["count"] for r in got.groupBy("doc_id", "text").count().collect()}
        assert counts, name
        ids = {d for d, _ in before}
        assert {d for d, _ in counts} <= ids, name
        if name not in ("quality_rules", "line_dedup", "mixing"):  # these leave texts as they are
            assert all(before[key] == n for key, n in counts.items()), name
        if name != "mixing":
            assert all(n % 2 == 0 for (d, _), n in counts.items() if d is not None), name
