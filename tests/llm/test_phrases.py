"""Phrase mining against a plain version that counts every run of words."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomtext.llm import phrases

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def pieces(text):
    for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(str.maketrans(UPPER, UPPER.lower()))):
        yield re.findall(r"[^ \t]+", piece)


def plain(docs, max_words=4, min_count=30, covered=80, top=2000):
    counts, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            for k in range(1, max_words + 1):
                for i in range(len(ws) - k + 1):
                    counts[lang, tuple(ws[i : i + k])] += 1
    f = {key: c for key, c in counts.items() if c >= min_count}
    longer = Counter()
    for (lang, p), a in f.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                longer[lang, p[i : i + k]] = max(longer[lang, p[i : i + k]], a)
    out = []
    for lang in n:
        found = []
        for (other, p), a in f.items():
            if other != lang or len(p) < 2 or (longer[lang, p] and 100 * longer[lang, p] >= covered * a):
                continue
            score, _, l, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["A", "b", "Cc", "é", "ß", "x y", "d\x00", "İ", "z9"]
    docs = [(None, "en"), ("", None), (" \t\n ,.;", "en"), ("a\tb  A b\rA\x0bb\x0cA b", "en"), ("A b A b " * 300, None), ("A b! " * 200, "en")]
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ", ", "\n", "?"]) for _ in range(rng.randrange(120)))
        docs.append((text, rng.choice([None, "und", "en", "fr"])))
    return docs


def mined(spark, docs, **options):
    rows = spark.createDataFrame([(t, g, "clash", 1) for t, g in docs], "text string, lang string, phrase string, n int").repartition(3)
    return sorted(tuple(r) for r in phrases.mine(rows, **options).collect())


@pytest.mark.parametrize("options", [{}, {"max_words": 2, "min_count": 10}, {"max_words": 5, "min_count": 5, "covered": 60, "top": 7}], ids=["dealt", "pairs", "five"])
def test_as_plain(spark, options):
    docs = corpus(1)
    want = plain(docs, **options)
    given = {"covered_percent" if k == "covered" else k: v for k, v in options.items()}
    assert len(want) > 10 and mined(spark, docs, **given) == want


def test_small_segments_and_ordinary_joins(spark, monkeypatch):
    """Texts cut into many stretches and segments, and dictionaries too large to broadcast, give the same."""
    monkeypatch.setattr(phrases, "SEGMENT_WORDS", 50)
    monkeypatch.setattr(phrases, "STRETCH_BYTES", 40)
    docs = corpus(2, 40)
    segments = [s for t, _ in docs for s in phrases._stretches((t or "").encode().translate(phrases._BYTES))]
    assert len(segments) > len(docs) and b"\n".join(phrases._stretches(b"a b\n" * 99)) == b"a b\n" * 99
    assert mined(spark, docs, min_count=8, broadcast_rows=0) == plain(docs, min_count=8)


def test_lists_hold_the_places(spark):
    docs = spark.createDataFrame([("b a, a b a", "en")], "text string, lang string").coalesce(1)
    found = {r["word"]: (r["n"], [int.from_bytes(r["positions"][i : i + 4], "little") for i in range(0, len(r["positions"]), 4)]) for r in phrases.word_lists(docs).collect()}
    assert found == {"b": (2, [0, 4]), "a": (3, [1, 3, 5])}


def test_arithmetic_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    row = spark.range(1).select(F.lit(big).alias("a"), F.lit(big).alias("l"), F.lit(big).alias("r"))
    score = F.expr(f"(2000000BD * {phrases._wide('a')}) DIV ({phrases._wide('l')} + {phrases._wide('r')})")
    assert row.select(score).first()[0] == 1_000_000


def test_empty_and_repeated_rows(spark, empty, docs, repeated, rows):
    assert phrases.mine(empty).count() == 0
    assert phrases.mine(docs.where("text is null")).count() == 0
    texts = [(r[1], r[2]) for r in rows]
    assert sorted(tuple(r) for r in phrases.mine(repeated, min_count=60).collect()) == plain(texts + texts + texts[7:12], min_count=60)
