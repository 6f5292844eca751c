"""The registered queries on small tables: columns and types, splits, SQL, and plain versions of what SQL does not give."""

import hashlib
import os
import sys
import zlib

import brute
import duckdb
import pytest
from compare import compare
from pyspark.sql import functions as F

from loomtext.llm import line_dedup, token_counts
from loomtext.llm.queries import ORACLES, QUERIES, URL_RULES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COLUMNS = {
    "op1_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op2_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op3_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op4_quality_ranker": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_removed": "bigint", "n_runs": "bigint", "kept_md5": "string"},
    "op6_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op7_near_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op8_decontaminate": {"doc_id": "bigint", "item_id": "bigint", "n_windows": "bigint", "n_matched": "bigint", "n_slots": "bigint", "n_consistent": "bigint"},
    "op9_token_counts": {"source": "string", "lang": "string", "tokenizer_version": "string", "n_docs": "bigint", "n_tokens": "bigint"},
    "op10_substring_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op11_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op12_phrases": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
    "op13_importance_resample": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
}


@pytest.fixture(scope="module")
def tables(spark, rows, tmp_path_factory):
    """A folder of small tables: the odd texts, labels, pages and a benchmark, in the columns of the real ones."""
    root = tmp_path_factory.mktemp("tables")
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    docs = [(r[0], r[1], r[2], r[3], r[4]) for r in rows if r[1] is None or len(r[1]) < 20_000]
    docs += [(500 + i, f"The question was put: {t}", "en", "a", 0) for i, t in enumerate(["A train travels 7 miles in 2 hours at this speed.", "Nothing of note here."])]
    spark.createDataFrame(docs, kinds).repartition(3).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame([(d[0], d[0] % 2, int(d[0] % 5 == 0)) for d in docs] + [(0, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    urls = ["http://a.example.com/en/x", "http://b.net/es/1", "http://b.net/fr/2", "http://c.org/", "http://d.com/q?u", None]
    spark.createDataFrame([(i, u, "<p>x</p>") for i, u in enumerate(urls)], "page_id long, url string, html string").write.parquet(str(root / "pages.parquet"))
    spark.createDataFrame([(1, "A train travels 120 miles in 3 hours at this speed.")], "item_id long, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root), docs


@pytest.fixture(scope="module")
def results(spark, tables):
    return {name: query(spark, tables[0]).cache() for name, query in QUERIES.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(results, tables, name):
    assert dict(results[name].dtypes) == COLUMNS[name]
    per_row = {"op2_url_filter": 6}.get(name, len(tables[1]))
    assert name in ("op8_decontaminate", "op9_token_counts", "op12_phrases") or results[name].count() == per_row


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, tables, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables[0]}/{t}.parquet/*.parquet')")
    assert compare(spark, con, QUERIES[name], ORACLES[name], tables[0]) == ""


def test_splits(results):
    for name, parts, value in (("op4_quality_ranker", 3, 1), ("op6_language_id", 4, 2)):
        for r in results[name].collect():
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % parts == value)
            assert 0 <= r["score"] <= 1
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in results["op4_quality_ranker"].collect())


def test_line_dedup_as_by_hand(results, tables):
    docs = [(d[0], d[1]) for d in tables[1]]
    want = {d: hashlib.md5((t or "").encode()).hexdigest() for d, t in brute.maximal_runs(docs, line_dedup.MIN_WORDS).items()}
    assert {r["doc_id"]: r["kept_md5"] for r in results["op5_line_dedup"].collect()} == want


def test_substring_dedup_as_by_hand(results, tables):
    want = brute.substring_dedup([(d[0], d[1]) for d in tables[1]], 100)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in results["op10_substring_dedup"].collect()} == want


def test_leaks_as_by_hand(results, tables):
    want = brute.leaks([(d[0], d[1]) for d in tables[1]], [(1, "A train travels 120 miles in 3 hours at this speed.")])
    assert want and {(r["doc_id"], r["item_id"]): (r["n_windows"], r["n_matched"], r["n_slots"], r["n_consistent"]) for r in results["op8_decontaminate"].collect()} == want


def test_token_totals_as_by_hand(results, tables):
    import tiktoken

    make = lambda path: tiktoken.Encoding("x", pat_str=token_counts.PATTERN, mergeable_ranks=token_counts.load_ranks(path), special_tokens={})
    one, multi = make(token_counts.RANKS), make(token_counts.MULTI_RANKS)
    want = {}
    for d, text, lang, source, _ in tables[1]:
        if d % 5:
            foreign = lang not in (None, "en")
            key = (source, lang, "byte_bpe_multi_50k" if foreign else "byte_bpe_50k")
            n, tokens = want.get(key, (0, 0))
            want[key] = (n + 1, tokens + len((multi if foreign else one).encode_ordinary(text or "")))
    assert {(r["source"], r["lang"], r["tokenizer_version"]): (r["n_docs"], r["n_tokens"]) for r in results["op9_token_counts"].collect()} == want


def test_byte_bpe_as_the_library(results, tables):
    import tiktoken

    library = tiktoken.Encoding("x", pat_str=token_counts.PATTERN, mergeable_ranks=token_counts.load_ranks(token_counts.RANKS), special_tokens={})
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = {}
    for d, text, *_ in tables[1]:
        ids = library.encode_ordinary(text or "")
        want[d] = (len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha((text or "").encode()))
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in results["op11_byte_bpe"].collect()} == want


def test_pages_as_by_hand(results):
    got = {r["page_id"]: r for r in results["op2_url_filter"].collect()}
    assert len(URL_RULES) == 5 and [got[i]["rule"] for i in range(6)] == ["example.com/en/", "net/es/", "net/fr/", None, "com/", None]
    assert [got[i]["verdict"] for i in (0, 1, 2, 4)] == ["block", "block", "block", "allow"]
    assert (got[0]["host"], got[0]["path"], got[4]["path"], got[5]["host"]) == ("a.example.com", "/en/x", "/q", "")


def test_mix_shares_all_words(results):
    totals = results["op1_mix_sources"].agg(F.sum("size").alias("s")).first()["s"]
    per_source = results["op1_mix_sources"].select("source_size", "target").distinct()
    assert per_source.agg(F.sum("target").alias("t")).first()["t"] == pytest.approx(totals)
    assert results["op1_mix_sources"].where("taken > 3 * size").count() == 0
