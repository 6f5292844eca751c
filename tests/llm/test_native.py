"""Mixing, URL filter, quality rules and decontamination."""

import math
import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from loomtext.llm import decontaminate, mixing, quality_rules, url_filter
from loomtext.llm.queries import URL_RULES


def test_quality_counts(docs, rows):
    got = {r["doc_id"]: r for r in quality_rules.assess(docs).collect()}
    for doc, text, *_ in rows:
        r = got[doc]
        want = brute.quality_counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])


def test_quality_lines(spark):
    prose = " ".join(f"w{i}" for i in range(100))
    df = spark.createDataFrame([(1, prose + "\nhome | news | about | more\nAll rights reserved.\n\nend"), (2, "\n".join(f"#{i} *{i} %{i}" for i in range(20)) + "\n" + " ".join(f"w{i}" for i in range(60)))], ["doc_id", "text"])
    a, b = quality_rules.assess(df).orderBy("doc_id").collect()
    assert a["kept"] and a["clean_text"] == prose + "\n\nend"
    assert not b["base_failed"] and not b["kept"] and b["n_lost_words"] == 60


def test_quality_phrases_of_other_languages(spark):
    lines = ["Tous droits réservés.", "Alle Rechte vorbehalten", "Todos los derechos reservados", "Ein gewöhnlicher Satz."]
    df = spark.createDataFrame([(1, "\n".join([*lines, " ".join(f"w{i}" for i in range(100))]))], ["doc_id", "text"])
    assert quality_rules.assess(df).first()["clean_text"].startswith("Ein gewöhnlicher Satz.\nw0 ")


def test_quality_counts_of_a_very_long_text(spark):
    """Over 2^20 words: windows are compared by pairs, with the same counts."""
    text = " ".join(f"w{i}" for i in range(2**20 + 20)) + " w5 w6 w7 w8"
    r = quality_rules.assess(spark.createDataFrame([(1, text)], ["doc_id", "text"])).first()
    assert (r["n_words"], r["n_repeat_words"], r["base_failed"]) == (2**20 + 24, 8, False)


def test_clean_keeps_columns(docs, repeated, empty):
    out = quality_rules.clean(docs)
    assert out.columns == docs.columns
    assert out.where("n_chars <> length(text)").count() == 0 and out.where("kept <> 'clash'").count() == 0
    assert quality_rules.clean(repeated).where("doc_id is not null").count() == 2 * out.count()
    assert quality_rules.assess(empty).count() == 0


def _check_mix(df, rows):
    planned, plan = mixing.plan_mix(df)
    got = [(r["doc_id"], r["source"], r[plan]) for r in planned.collect()]
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(brute.words(r[1]))
    want = brute.targets(sizes)
    for _, source, p in got:
        assert p["source_size"] == sizes[source] and math.isclose(p["target"], want[source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= p["copies"] <= 3 and math.floor(p["rate"]) <= p["copies"] <= math.ceil(p["rate"])
    return got


def test_mixing(docs, rows, empty):
    first = _check_mix(docs, rows)
    assert sorted(map(str, first)) == sorted(map(str, _check_mix(docs.repartition(7), rows)))
    assert mixing.plan_mix(empty)[0].count() == 0
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "copy_1"]  # the input has a column copy
    assert out.count() == sum(p["copies"] for _, _, p in first)


def test_mixing_repeated_rows(repeated):
    planned, plan = mixing.plan_mix(repeated)
    per_id = planned.groupBy("doc_id").agg(F.countDistinct(F.col(plan)["copies"]).alias("n")).where("doc_id is not null and n > 1")
    assert per_id.count() == 0


def test_mixing_meets_targets(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 3).cast("string"))).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"))
    planned, plan = mixing.plan_mix(df)
    for r in planned.groupBy("source").agg(F.max(F.col(plan)["target"]).alias("t"), F.sum(F.col(plan)["size"] * F.col(plan)["copies"]).alias("n")).collect():
        assert abs(r["n"] - r["t"]) < 0.1 * r["t"]


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1, "c": 1, "d": 100}, {"a": 0, "b": 5, None: 5}, {"a": 7}, {"a": 0}, {"a": 1, "b": 1000, "c": 1000, "d": 3, None: 2}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    want = brute.targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-6) for k in want)


URLS = [
    None, "", "no scheme", "http://example.com", "http://example.com?x=/en/", "https://EXAMPLE.com/en/a", "http://www.example.com/en/",
    "http://a.www.example.com/en/b#c", "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/fr/", "http://x.net/de/", "http://net/fr/q?z",
    "http://x.org/en/1", "ftp://x.com:80/", "http://ÜBER.com/", "a://b://c/d", "http://x.net/fr", "http://" + "h" * 5000 + ".net/es/" + "p" * 5000,
]


def brute_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, None)


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS + URLS)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(df, URL_RULES, epochs=20).collect()}
    assert len(got) == 2 * len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = brute_url(u)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["score"] > 0.5 else "allow"))
        assert r["verdict"] == got[i + len(URLS)]["verdict"]
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(none, URL_RULES, epochs=2).count() == 0
    alone = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    assert url_filter.judge_urls(alone, URL_RULES, epochs=2).first()["verdict"] == "allow"


def test_url_model_separates(spark):
    df = spark.createDataFrame([(i, f"http://h{i}.{'casino' if i % 2 else 'library'}.org/{'win' if i % 2 else 'read'}/{i}") for i in range(300)], "id long, url string")
    parts = df.select("id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"), (F.col("id") % 2).cast("int").alias("blocked"))
    model = url_filter.fit(parts.where("id < 200").select("host", "path", "blocked"), epochs=40)
    scored = parts.where("id >= 200").withColumn("model", model.scalar()).withColumn("s", url_filter.blocked_score(F.col("host"), F.col("path"), F.col("model")))
    assert scored.where((F.col("s") > 0.5) == (F.col("blocked") == 1)).count() == 100


BENCH = [(1, "A train travels 120 miles in 3 hours. How many miles does it cover in one hour at that speed?"), (2, "Yesterday Alice gave Bob 5 apples, and Bob gave Alice 2 pears in return for them."), (3, None), (4, ""), (5, "tiny item")]


def test_leaks(spark):
    filler = " ".join(f"w{i}" for i in range(200))
    docs = [
        (1, f"{filler} {BENCH[0][1]} {filler}"), (2, "Intro. A TRAIN travels 75 km in 4 hours!! How many km does it cover in one hour, at that speed? End."),
        (3, "so Yesterday Carol gave Dan 7 apples, and Dan gave Carol 9 pears in return for them."), (4, "so Yesterday Carol gave Dan 7 apples, and Eve gave Frank 9 pears in return for them."),
        (5, filler), (6, None), (7, ""), (8, "Tiny, item!"), (9, "A train travels far. How many miles does it cover"), (10, (filler + " ") * 300 + BENCH[0][1]),
    ]
    df = spark.createDataFrame([(d, t, "clash") for d, t in docs + docs[:1]], "doc_id long, text string, item string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(df, bench).collect()}
    assert got == {(1, 1), (2, 1), (3, 2), (8, 5), (10, 1)}
    # the same by ordinary joins
    assert got == {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(df, bench, broadcast_windows=0).collect()}
    left = decontaminate.drop_leaks(df, bench)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {4, 5, 6, 7, 9}
    assert decontaminate.find_leaks(df.limit(0), bench).count() == 0 and decontaminate.find_leaks(df, bench.limit(0)).count() == 0


def test_leaks_with_other_names_at_sentence_starts(spark):
    items = [
        (1, "Tom has 3 apples. Sara gives him 4 more apples. Sara keeps 2 for herself. How many apples does Tom have now?"),
        (2, "'Nina' (Omar) sold 12 old books: Nina kept 5 of them. Omar sold the rest. How many books did Omar sell?"),
    ]
    docs = [
        (1, "Ben has 7 apples. Lily gives him 2 more apples. Lily keeps 5 for herself. How many apples does Ben have now?"),
        (2, "Intro text first. Ben has 7 apples. Lily gives him 2 more apples. Lily keeps 5 for herself. how many apples does Ben have now? And more."),
        (3, "'Ruth' (Saul) sold 30 old books: Ruth kept 8 of them. Saul sold the rest. How many books did Saul sell?"),
        (4, items[0][1].lower()), (5, items[1][1]),
        (6, "Ben has 7 apples. Lily gives him 2 more pears. They keep 5 for a friend. How many apples does Ben have now?"),
        (7, "Ben walks to school. Lily gives him a book. Lily keeps it for herself. How many pages does Ben read now?"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for rows in (1_000_000, 0):
        got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find_leaks(df, bench, broadcast_windows=rows).collect()}
        assert set(got) == {(1, 1), (2, 1), (3, 2), (4, 1), (5, 2)}
        assert all(r["n_matched"] <= r["n_windows"] and r["n_consistent"] <= r["n_slots"] for r in got.values())
    # names at sentence starts must stand for one name each, too
    mixed = [(1, "Ann saw Bob. Bob met Ann. Ann likes Bob. Bob thanks Ann. Ann helps Bob. Bob calls Ann. Ann hugs Bob.")]
    other = [(1, "Cid saw Dora. Ewan met Fay. Gus likes Hal. Ian thanks Jo. Kim helps Leo. Max calls Ned. Oz hugs Pam."), (2, mixed[0][1].replace("Ann", "Gus").replace("Bob", "Hal"))]
    got = decontaminate.find_leaks(spark.createDataFrame(other, df.schema), spark.createDataFrame(mixed, bench.schema)).collect()
    assert [r["doc_id"] for r in got] == [2]


def _leak_rows(df):
    return {(r["doc_id"], r["item_id"]): (r["n_windows"], r["n_matched"], r["n_slots"], r["n_consistent"]) for r in df.collect()}


def test_leaks_as_by_hand(spark, docs, rows):
    """All counts as a plain version gives them, on re-worded questions and on odd texts."""
    rng = random.Random(12)
    names, units = ["Alice", "Bob", "Carol", "Dan", "Éva", "Ottó"], ["miles", "km", "hours", "apples", "pears"]
    items = []
    for i in range(12):
        ws = [rng.choice([*names, *units, str(rng.randrange(200)), "1,200.5", "two hundred", "Seven", "the", "of", "gives", "how", "many", "does", "he", "get."]) for _ in range(rng.randrange(3, 25))]
        items.append((i, " ".join(ws) + rng.choice([".", "?", ""])))
    texts = [(r[0], r[1]) for r in rows if r[1] is None or len(r[1]) < 4000]
    for n, (_, t) in enumerate(items * 4):
        swap = {a: rng.choice(names) for a in names} if n % 2 else dict(zip(names, rng.sample(names, len(names))))
        t = " ".join(swap.get(w, str(rng.randrange(99)) if w.isdigit() else w) for w in t.split(" "))
        t = [t, t.lower(), f"Well, {t} and more.", f"({t})", t.replace("two hundred", "three thousand")][n % 5]
        texts.append((1000 + n, t))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (52, "tiny item")], "item_id long, text string")
    want = brute.leaks(texts, items + [(52, "tiny item")])
    assert len(want) > 30
    assert _leak_rows(decontaminate.find_leaks(df, bench)) == want
    assert _leak_rows(decontaminate.find_leaks(df, bench, broadcast_windows=0, broadcast_bytes=0)) == want


def test_leaks_that_are_written_otherwise(spark):
    item = "Alice drove one hundred miles in three hours with her friend Bob. How many miles did Alice drive in one hour?"
    docs = [
        (1, item.lower()), (2, "Alice drove two hundred miles in four hours with her friend Bob. How many miles did Alice drive in one hour?"),
        (3, "Carol drove 250 km in 4 hours with her friend Dan. How many km did Carol drive in one hour?"), (4, "It was late. alice drove two hundred miles in four hours with her friend bob. how many miles did alice drive in one hour?"),
        (5, "Alice drove home with her friend. How many hours did it take?"),
    ]
    df = spark.createDataFrame([*docs, *docs[:2], (None, item)], "doc_id long, text string")
    got = decontaminate.find_leaks(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r["doc_id"] for r in got.collect()} == {1, 2, 3, 4, None} and got.count() == 5


def test_url_training_keeps_a_rare_class(spark):
    urls = [f"http://h{i}.com/page{i}" for i in range(3000)] + [f"http://x{i}.net/es/{i}" for i in range(5)] + [f"http://x{i}.net/es" for i in range(5)] + [f"http://h{i}.org/page{i}" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(df, URL_RULES).collect()}
    assert all(got[i]["verdict"] == "block" for i in range(3000, 3010))
    assert sum(got[i]["verdict"] == "allow" for i in range(3010, 3030)) >= 18


def test_url_model_is_logistic_regression(spark):
    """The weights are those of plain gradient descent on the same grams."""
    import numpy as np

    rows = [(f"{w}{i}.org", f"/{p}/{i}", int(w == "bad")) for i, (w, p) in enumerate([("bad", "win"), ("good", "read"), ("good", "win")] * 30)]
    df = spark.createDataFrame(rows, "host string, path string, blocked int")
    model = url_filter.fit(df, buckets=128, epochs=25, max_training_urls=1000).first()["model"]
    data = df.select("blocked", url_filter.gram_buckets(F.col("host"), F.col("path"), n=3, buckets=128).alias("g")).collect()
    x = np.zeros((len(data), 128))
    for i, r in enumerate(data):
        x[i, r["g"]] = 1 / math.sqrt(len(r["g"]))
    y = np.array([r["blocked"] for r in data], dtype=float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, b = np.zeros(128), 0.0
    for _ in range(25):
        e = (y - 1 / (1 + np.exp(-(x @ w + b)))) * weight
        w, b = w * (1 - 4.0 * 1e-4) + 4.0 * x.T @ e, b + 4.0 * e.sum()
    assert np.allclose(model["w"], w) and math.isclose(model["b"], b, abs_tol=1e-9)


def test_scattered_windows_are_no_leak(spark):
    """Windows of an item that stand apart, in any order, each with other names and numbers, are chance; a copy with words put in is not."""
    rng = random.Random(12)
    item = "On Monday the baker Anna sold 12 loaves for 3 dollars each, and on Tuesday the baker Anna sold 7 loaves for 5 dollars each, so how many dollars more did she take?"
    words = item.split()
    other = lambda w: rng.choice(["Berta", "Clara", "Doris"]) if w == "Anna" else str(rng.randrange(90)) if w.strip(",").isdigit() else w
    pieces = [" ".join(map(other, words[i : i + 5])) for i in range(len(words) - 4)]
    filler = lambda: " ".join(f"f{rng.randrange(10**6)}x" for _ in range(6))
    scattered = " ".join(f"{p} {filler()}" for p in pieces)
    rng.shuffle(pieces)
    shuffled = " ".join(f"{p} {filler()}" for p in pieces)
    renamed = item.replace("Anna", "Berta").replace("12", "40").replace("7", "9")
    inside = " ".join([*renamed.split()[:9], filler(), *renamed.split()[9:]])
    twice = f"{renamed} {filler()} {item.replace('Anna', 'Clara')}"
    inconsistent = " ".join(map(other, words))
    texts = [(1, scattered), (2, shuffled), (3, inside), (4, renamed), (5, item), (6, twice), (7, inconsistent.replace("3 ", "8 ", 1))]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"] for r in decontaminate.find_leaks(spark.createDataFrame(texts, "doc_id long, text string"), bench).collect()}
    assert got - {7} == {3, 4, 5, 6}
    assert _leak_rows(decontaminate.find_leaks(spark.createDataFrame(texts, "doc_id long, text string"), bench)) == brute.leaks(texts, [(1, item)])
