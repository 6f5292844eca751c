"""Importance resampling against a plain version that puts every run of words together."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomtext.llm import importance

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def features(text, n):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, UPPER.lower())))
    return len(words), [" ".join(words[i : i + k]) for i in range(len(words)) for k in range(1, n + 1) if i + k <= len(words)]


def plain(docs, target, n, buckets, percent, min_words, seed):
    """{row number: (features, weight, score, rank)} for rows (id, text)."""
    hashed = lambda f: zlib.crc32(f.encode()) % buckets
    source = Counter(hashed(f) for _, t in docs for f in features(t, n)[1])
    wanted = Counter(hashed(f) for t in target for f in features(t, n)[1])
    s, t = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((source[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out, ranked = {}, []
    for i, (d, text) in enumerate(docs):
        words, fs = features(text, n)
        weight = sum(gain[hashed(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out[i] = [len(fs), weight, score, None]
        if words >= min_words:
            ranked.append((-score, d is None, d or 0, i))
    for rank, (*_, i) in enumerate(sorted(ranked)[: percent * len(ranked) // 100], 1):
        out[i][3] = rank
    return out


@pytest.mark.parametrize("ngrams", [1, 2, 3])
def test_as_plain(spark, docs, rows, ngrams):
    target = [rows[8][1], None, "", "la la la"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(docs, bench, ngrams=ngrams, buckets=997, percent=30, min_words=5)
    want = plain([(r[0], r[1]) for r in rows], target, ngrams, 997, 30, 5, "2024")
    assert got.columns == [*docs.columns, *importance.RESULTS]
    assert {r["doc_id"]: [r["n_features"], r["weight"], r["score"], r["rank"]] for r in got.collect()} == want


def test_long_texts_are_counted_in_stretches(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(importance, "HELD", 7)
    text = " ".join(f"w{i}" for i in range(50))
    assert importance.Ring(3).scan(text, seen.append) == (50, 50 + 49 + 48)
    assert sorted(x for part in seen for x in part) == sorted(zlib.crc32(f.encode()) for f in features(text, 3)[1])


def test_repeated_rows_and_null_ids(spark, repeated, rows):
    """Rows that tie take ranks one after the other; every row is there."""
    bench = spark.createDataFrame([(1, rows[9][1])], "item_id long, text string")
    got = importance.resample(repeated, bench, percent=50, min_words=5, keep=["doc_id"]).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert len(got) == repeated.count() and ranks == list(range(1, len(ranks) + 1))
    assert len({(r["doc_id"], r["weight"], r["score"]) for r in got if r["doc_id"] is not None}) == len(rows)
    assert sum(r["doc_id"] is None for r in got) == 5


def test_clashing_columns_and_empty_tables(spark, docs, empty):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    clash = docs.withColumn("Weight", F.lit("clash")).withColumn("rank", F.lit("clash")).withColumn("bucket", F.lit("stays"))
    got = importance.resample(clash, bench)
    assert got.columns == [*docs.columns, "bucket", *importance.RESULTS] and {r["bucket"] for r in got.select("bucket").distinct().collect()} == {"stays"}
    assert importance.resample(empty, bench).count() == 0
    nothing = importance.resample(docs, bench.limit(0), keep=["doc_id"])
    assert nothing.count() == docs.count() and nothing.where("rank is not null").count() > 0
