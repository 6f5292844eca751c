"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontaminate, importance, language_id, line_dedup, mixing, near_dedup, oracle, phrases, quality_ranker, quality_rules, substring_dedup, token_counts, url_filter
from .common import Scratch, table

URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned, plan = mixing.plan_mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    p = F.col(plan)
    return planned.select(
        "doc_id", p["size"].alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"),
        (p["size"] * p["copies"]).alias("taken"),
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _crc_part(col: str, parts: int, value: int):
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % parts == value, F.lit(False))


def op4_quality_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = Scratch(spark).put(quality_ranker.featured(table(spark, sf_dir, "documents")), "features")
    held = _crc_part("doc_id", 3, 1)
    ranker = quality_ranker.fit(seen.where(~held), table(spark, sf_dir, "labels").where(~held))
    score = ranker.score(F.col("features"))
    return seen.select("doc_id", held.alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), counts_col="_lines")
    n = F.col("_lines")
    return done.select(
        "doc_id", n["lines"].cast("long").alias("n_lines"), n["removed"].cast("long").alias("n_removed"), n["runs"].cast("long").alias("n_runs"),
        F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"),
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.group(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = _crc_part("doc_id", 4, 2)
    model = language_id.learn(docs.where(~held))
    return language_id.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after a history of all documents: loaded in four batches, one of them sent twice; documents in other languages
    than English counted anew by the multilingual vocabulary; and documents that are labelled toxic taken out."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark)
    ledger = token_counts.Ledger(spark, scratch.path("ledger"))
    counted = scratch.put(token_counts.count_tokens(docs, version="byte_bpe_50k"), "counted")
    for n in (0, 1, 2, 3, 0):
        part = counted.where(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4, F.lit(0)) == n)
        ledger.commit(f"load-{n}", token_counts.inserts(part))
    foreign = F.col("lang").isNotNull() & (F.col("lang") != "en")
    anew = scratch.put(token_counts.count_tokens(docs.where(foreign), version="byte_bpe_multi_50k", ranks_path=token_counts.MULTI_RANKS), "anew")
    ledger.commit("multilingual", token_counts.revisions(counted.where(foreign), anew))
    ledger.compact()
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    now = counted.where(~foreign).unionByName(anew)
    ledger.commit("toxic", token_counts.deletes(now.join(toxic, "doc_id", "left_semi")))
    return ledger.totals()


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.dedup(table(spark, sf_dir, "documents"), length=100)
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), packed=True, keep=["doc_id"])
    n_tokens = F.floor(F.octet_length("ids") / 4).alias("n_tokens")
    return byte_bpe.decode(encoded).select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"), max_words=4, min_count=30, covered_percent=80, top=2000)


def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    drawn = importance.resample(docs, benchmark, ngrams=1, buckets=10_000, percent=10, min_words=20, seed="2024", keep=["doc_id"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op12_phrases": op12_phrases,
    "op13_importance_resample": op13_importance_resample,
    "op11_byte_bpe": op11_byte_bpe,
    "op10_substring_dedup": op10_substring_dedup,
    "op4_quality_ranker": op4_quality_ranker,
    "op5_line_dedup": op5_line_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op6_language_id": op6_language_id,
    "op9_token_counts": op9_token_counts,
    "op1_mix_sources": op1_mix_sources,
    "op2_url_filter": op2_url_filter,
    "op3_quality_rules": op3_quality_rules,
}

ORACLES: dict[str, str] = {
    "op1_mix_sources": oracle.MIX,
    "op3_quality_rules": oracle.QUALITY,
    "op5_line_dedup": oracle.LINES,
    "op7_near_dedup": oracle.NEAR,
    "op10_substring_dedup": oracle.SUBSTRINGS,
    "op12_phrases": oracle.PHRASES,
    "op13_importance_resample": oracle.IMPORTANCE,
}
