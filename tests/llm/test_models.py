"""Quality ranker, language identification and token counts."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.llm import language_id, quality_ranker, token_counts

EN = "the quick brown fox jumps over the lazy dog and then sleeps under a warm tree near the river"
DE = "der schnelle braune fuchs springt über den faulen hund und schläft dann unter einem warmen baum"


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    ws = EN.split() + [f"word{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(240):
        good = i % 4 != 0
        t = " ".join(rng.choice(ws) for _ in range(rng.randrange(60, 200)))
        rows.append((i, t if good else " ".join(x.upper() + "!!" for x in t.split()), "clash"))
        labels.append((i, int(good), "clash"))
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, "word " * 50_000, "x"), (None, "hello", "x")]
    labels += [(1, 1, "again"), (2, None, "none"), (None, 1, "none"), (5000, 0, "absent")]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, text string")


def test_ranker(labelled):
    docs, labels = labelled
    train = F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False))
    ranker = quality_ranker.learn(docs.where(train), labels.where(train))
    got = quality_ranker.score(docs, ranker).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    test = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 240 and r["doc_id"] % 3 == 1]
    assert sum(r["predicted"] == int(r["doc_id"] % 4 != 0) for r in test) >= 0.97 * len(test)


def test_ranker_without_a_class(labelled):
    docs, labels = labelled
    ranker = quality_ranker.learn(docs, labels.where("quality = 1"))
    assert {r["score"] for r in quality_ranker.score(docs, ranker).collect()} == {0.5}
    ranker = quality_ranker.learn(docs.limit(0), labels.limit(0))
    assert quality_ranker.score(docs.limit(0), ranker).count() == 0


def test_pair_gradient():
    """The learned weights are a stationary point of the pairwise logistic loss."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, len(quality_ranker.FEATURES)))
    y = (x[:, 0] + 0.5 * rng.normal(size=200) > 0).astype(int)
    r = quality_ranker.fit_pairs(x, y, bad_share=0.5, n_pairs=5000)
    z = (x - r.mean) / r.scale
    pick = np.random.default_rng(7)
    diff = z[pick.choice(np.flatnonzero(y == 1), 5000)] - z[pick.choice(np.flatnonzero(y == 0), 5000)]
    w = np.array(r.weights)
    assert np.abs(diff.T @ (1 / (1 + np.exp(diff @ w))) / 5000 - 1e-3 * w).max() < 1e-6


def brute_word(word, probs):
    """Sum over all segmentations, by recursion."""
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, len(word) + 1):
        p = probs.get(word[:n], 0.0)
        if n == 1:
            p = max(p, language_id.FLOOR)
        total += p * brute_word(word[n:], probs) if p else 0.0
    return total


def test_forward_sums_all_segmentations():
    pieces = sorted({"a", "b", "ab", "ba", "aba", "é", "bab", "abcabc"})
    probs = np.random.default_rng(1).random((len(pieces) + 1, 2))
    probs[-1] = 0
    ws = ["a", "abab", "ababab", "xyz", "éa", "abcabcab", "b" * 20]
    got = language_id.log_likelihoods(ws, language_id.Pieces(pieces), probs)
    for i, w in enumerate(ws):
        for k in (0, 1):
            assert math.isclose(got[i, k], math.log(brute_word(w, {p: probs[j, k] for j, p in enumerate(pieces)})), rel_tol=1e-9)


def plain_log(word, probs):
    """log of the sum over all segmentations, by exact fractions."""
    alpha = [Fraction(1)]
    for t in range(1, len(word) + 1):
        alpha.append(sum(alpha[t - n] * Fraction(max(probs.get(word[t - n : t], 0.0), language_id.FLOOR if n == 1 else 0.0)) for n in range(1, t + 1)))
    return math.log(alpha[-1].numerator) - math.log(alpha[-1].denominator)


def test_long_words_lose_no_segmentation():
    """Words over the length that needs no rescaling, pieces of many letters, and letters that no piece has."""
    rng = random.Random(3)
    pieces = sorted({"a", "b", "ab", "abba", "abababababab", "babababababababababa", "bb", "b" * 25})
    probs = np.random.default_rng(2).random((len(pieces) + 1, 2)) / 50
    probs[-1] = 0
    ws = ["ab" * 20, "".join(rng.choice("ab") for _ in range(90)), "b" * 64, "x" * 40, "abx" * 120]
    got = language_id.log_likelihoods(ws, language_id.Pieces(pieces), probs)
    for i, w in enumerate(ws):
        for k in (0, 1):
            assert math.isclose(got[i, k], plain_log(w, {p: probs[j, k] for j, p in enumerate(pieces)}), rel_tol=1e-9)
    uses = language_id.expected_counts(ws[:2], np.array([1.0, 2.0]), language_id.Pieces(pieces), probs[:, :1])
    assert math.isclose(sum(u * len(p) for u, p in zip(uses, pieces)), 40 + 2 * 90)


def test_words_are_letters():
    assert language_id.text_words("½ ² ³ ① Ⅷ 123 _") == []
    assert language_id.text_words("Straße x²y naïve_日本語") == ["straße", "x", "y", "naïve", "日本語"]
    model = language_id.em({"de": Counter(DE.split()), "en": Counter(EN.split())}, list("abcdefghijklmnopqrstuvwxyz"))
    assert language_id.Scorer(model).score(["½ ² ³", "①"])[0] == ["und", "und"]


def test_ties_go_to_the_first_language():
    same = Counter(EN.split())
    model = language_id.em({"b": same, "a": same, "c": same}, sorted(set("".join(EN.split()))))
    assert language_id.Scorer(model).score([EN])[0] == ["a"]


def test_expected_counts_add_up():
    pieces = language_id.Pieces(["a", "b", "ab"])
    probs = np.array([[0.4], [0.3], [0.3], [0.0]])
    uses = language_id.expected_counts(["ab", "aab"], np.array([2.0, 1.0]), pieces, probs)
    # every letter belongs to exactly one piece
    assert math.isclose(uses[0] + uses[1] + 2 * uses[2], 2 * 2 + 3)


def test_em_learns(tmp_path):
    counts = {"de": Counter(DE.split()), "en": Counter(EN.split())}
    model = language_id.em(counts, sorted({w[i : i + n] for t in (EN, DE) for w in t.split() for n in (1, 2, 3) for i in range(len(w) - n + 1)}))
    assert np.allclose(model.probs[:-1].sum(0), 1.0)
    names, scores = language_id.Scorer(model).score([EN, DE, None, "123 !?", "", "x" * 5000])
    assert names[:5] == ["en", "de", "und", "und", "und"] and scores[2] == 0.0 and all(0 <= s <= 1 for s in scores)


needs_vocabulary = pytest.mark.skipif(not __import__("os").path.exists(language_id.VOCABULARY), reason="no vocabulary")


@needs_vocabulary
def test_language_held_out(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice((EN if i % 2 else DE).split()) for _ in range(40)), "en" if i % 2 else "de", "clash") for i in range(60)]
    rows += [(100, None, "en", "x"), (101, "42", None, "x"), (None, EN, None, "x"), (2**53 + 1, DE, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = language_id.learn(df.where("doc_id % 3 <> 0"))
    got = {r["doc_id"]: r for r in language_id.identify(df, model).collect()}
    assert all(got[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(60))
    assert got[100]["lang_pred"] == got[101]["lang_pred"] == "und" and got[None]["lang_pred"] == "en" and got[2**53 + 1]["lang_pred"] == "de"
    # the same sums in one process and over Spark; repeated rows are judged alike
    words = {k: Counter() for k in ("de", "en")}
    for r in rows:
        if r[0] is not None and r[0] % 3 and r[2]:
            words[r[2]].update(language_id.text_words(r[1]))
    assert np.allclose(language_id.em(words, model.pieces).probs, model.probs)
    clash = df.unionByName(df).withColumn("lang_pred", F.lit("clash"))
    again = language_id.identify(clash, model)
    assert again.columns == ["doc_id", "lang_pred", "score"] and again.count() == 2 * len(rows)
    assert {(r["doc_id"], r["lang_pred"]) for r in again.collect()} == {(k, r["lang_pred"]) for k, r in got.items()}
    nothing = language_id.learn(df.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(df, nothing).collect()} == {"und"}
    assert language_id.identify(df.limit(0), model).count() == 0


@pytest.mark.skipif(not __import__("os").path.exists(token_counts.RANKS), reason="no vocabulary")
def test_token_counts(spark, docs, rows, repeated, empty, tmp_path):
    import tiktoken

    enc = tiktoken.Encoding("x", pat_str=token_counts.PATTERN, mergeable_ranks=token_counts.load_ranks(), special_tokens={})
    counted = token_counts.count_tokens(docs, version="v1")
    got = {r["doc_id"]: r["n_tokens"] for r in counted.collect()}
    assert got == {r[0]: len(enc.encode_ordinary(r[1] or "")) for r in rows}
    assert token_counts.count_tokens(empty, version="v1").count() == 0
    assert token_counts.count_tokens(repeated, version="v1").count() == repeated.count()


def test_ledger(spark, tmp_path):
    schema = "doc_id long, source string, lang string, tokenizer_version string, n_tokens long"
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    ledger = token_counts.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.totals().count() == 0
    a, b, c = (1, "s", "en", "v1", 10), (2, None, "en", "v1", 5), (3, "s", None, "v1", 7)
    assert ledger.commit("1", token_counts.inserts(make(a, b, c)))
    assert not ledger.commit("1", token_counts.inserts(make(a, b, c)))  # a retry changes nothing
    assert ledger.commit("2", token_counts.deletes(make(b)))
    assert ledger.commit("3", token_counts.revisions(make(a), make((1, "s", "fr", "v2", 12))))
    assert ledger.commit("4", token_counts.inserts(make()))
    # a batch that was written but never committed does not count
    token_counts.inserts(make(a)).write.parquet(str(tmp_path / "ledger/data/stray"))
    got = {tuple(r) for r in ledger.totals().collect()}
    assert got == {("s", None, "v1", 1, 7), ("s", "fr", "v2", 1, 12)}
    assert ledger.committed() == ["1", "2", "3", "4"]
    with pytest.raises(ValueError):
        ledger.commit("../x", token_counts.inserts(make(a)))
    # a compaction changes no total, and what it covers stays committed
    assert ledger.compact() and not ledger.compact()
    assert {tuple(r) for r in ledger.totals().collect()} == got and not ledger.commit("2", token_counts.inserts(make(a)))
    assert ledger.commit("5", token_counts.deletes(make((1, "s", "fr", "v2", 12)))) and ledger.compact()
    assert {tuple(r) for r in ledger.totals().collect()} == {("s", None, "v1", 1, 7)}


def test_ledger_race(spark, tmp_path):
    """Of two writers of a batch the later one is told so, and its numbers do not count."""
    schema = "doc_id long, source string, lang string, tokenizer_version string, n_tokens long"
    rows = token_counts.inserts(spark.createDataFrame([(1, "s", "en", "v1", 10)], schema))
    ledger, other = (token_counts.Ledger(spark, str(tmp_path / "ledger")) for _ in range(2))
    write = ledger._write
    ledger._write = lambda deltas: (other.commit("b", rows), write(deltas))[1]  # the other one comes in between
    assert not ledger.commit("b", rows)
    assert [tuple(r) for r in ledger.totals().collect()] == [("s", "en", "v1", 1, 10)]


def test_ranker_features_as_by_hand(spark, docs, rows):
    from brute import ranker_features

    got = {r["doc_id"]: r["f"] for r in docs.select("doc_id", quality_ranker.features(F.col("text")).alias("f")).collect()}
    for doc, text, *_ in rows:
        assert got[doc] == pytest.approx(ranker_features(text, quality_ranker.ODD_MARKS), rel=1e-12), doc


def test_ranker_scores_as_by_hand(labelled):
    """Scores from plain features and the fitted numbers; repeated rows score alike."""
    from brute import ranker_features

    docs, labels = labelled
    ranker = quality_ranker.learn(docs, labels)
    got = quality_ranker.score(docs.unionByName(docs).withColumn("predicted", F.lit("clash")), ranker).collect()
    seen = {}
    for r in got:
        assert seen.setdefault(r["doc_id"], r["score"]) == r["score"]
    assert len(got) == 2 * docs.count()
    for r in docs.collect():
        f = ranker_features(r["text"], quality_ranker.ODD_MARKS)
        z = sum((x - m) / s * w for x, m, s, w in zip(f, ranker.mean, ranker.scale, ranker.weights)) - ranker.threshold
        assert seen[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9)


def test_ranker_takes_every_pair(spark, labelled):
    """The gradient over all pairs of labelled rows vanishes, and as many training rows are rejected as are labelled bad."""
    docs, labels = labelled
    marked = labels.where("quality is not null").select("doc_id", "quality")
    ranker = quality_ranker.learn(docs, labels)
    rows = quality_ranker.featured(docs).join(marked, "doc_id").collect()
    x, y = np.array([r["features"] for r in rows]), np.array([r["quality"] for r in rows])
    w = np.array(ranker.weights)
    z = (x - x.mean(0)) / np.where(x.std(0) < 1e-9, 1.0, x.std(0))
    diff = (z[y == 1][:, None, :] - z[y == 0][None, :, :]).reshape(-1, len(w))
    assert np.abs(diff.T @ (1 / (1 + np.exp(diff @ w))) / len(diff) - 1e-3 * w).max() < 2e-5
    assert (z @ w < ranker.threshold).sum() == (y == 0).sum()


def test_value_at(spark):
    values = [0.25] * 400 + [1e-9 * i for i in range(300)] + [-7.5, 1e6, 1e6]
    scores = spark.createDataFrame([(v,) for v in values], "s double")
    for place in (1, 2, 151, 300, 301, 302, 701, 702, 703):
        assert quality_ranker.value_at(scores, place, few=4) == sorted(values)[place - 1], place
