"""Line, near-duplicate and substring dedup, and connected components."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.llm import anchors, components, line_dedup, near_dedup, substring_dedup
from loomtext.llm.common import Scratch


@pytest.mark.parametrize("min_words", [1, 10, 25])
def test_line_dedup(docs, rows, min_words):
    got = {r["doc_id"]: r for r in line_dedup.dedup(docs, min_words=min_words).collect()}
    want = brute.line_dedup([(r[0], r[1]) for r in rows], min_words)
    assert {k: v["text"] for k, v in got.items()} == want
    assert all(v["n_chars"] == (None if v["text"] is None else len(v["text"])) and v["kept"] == "clash" for v in got.values())


def test_line_dedup_edges(docs, repeated, empty):
    assert line_dedup.dedup(empty).columns == empty.columns and line_dedup.dedup(empty).count() == 0
    once = {r["doc_id"]: r["text"] for r in line_dedup.dedup(docs).collect()}
    twice = line_dedup.dedup(repeated).collect()
    assert len(twice) == repeated.count()
    assert all(r["text"] == once[r["doc_id"]] for r in twice if r["doc_id"] is not None and r["doc_id"] not in range(7, 16))


def test_runs_are_maximal(spark):
    lines = [f"line {i} " + "x " * 10 for i in range(12)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(["new " * 20, *lines[2:9], "other " * 20])), (3, None)], ["doc_id", "text"])
    got = line_dedup.repeated_runs(df, min_words=20).collect()
    assert [(r["doc_id"], [(x["from"], x["to"]) for x in r["runs"]]) for r in got] == [(2, [(1, 8)])]


def test_runs_keep_no_tail(spark):
    """Last lines of a repeated run go too, also where fewer than min_words words are left from them on."""
    a, b, c = "a " * 30, "b " * 20, "c " * 4
    texts = [(1, f"{a}\n{b}\nx"), (2, f"new\n{a}\n{b}\ny"), (3, f"{a}\n{b}\n{c}"), (4, f"{a}\n\n{b}\n{c}"), (5, f"{b}\n{c}\nz")]
    df = spark.createDataFrame(texts, ["doc_id", "text"])
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(df, min_words=25).collect()}
    assert got == {1: texts[0][1], 2: "new\ny", 3: c, 4: "", 5: texts[4][1]}
    rng = random.Random(8)
    lines = [f"{i} " * n for i, n in enumerate((1, 2, 3, 5, 8, 11, 24, 25, 26, 40))]
    pool = [[rng.choice(lines) for _ in range(rng.randrange(1, 12))] for _ in range(8)]
    texts = [(i, "\n".join(x for _ in range(4) for x in [*rng.choice(pool), *rng.choices(lines, k=rng.randrange(3))])) for i in range(40)]
    df = spark.createDataFrame(texts, ["doc_id", "text"]).repartition(3)
    for least in (1, 7, 25, 60):
        got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(df, min_words=least).collect()}
        assert got == brute.maximal_runs(texts, least)


def test_short_repeated_lines_go(spark):
    """A short line that recurs alone goes from every document but the first; one or two words are too few."""
    line = "all eight words of this line come back"
    texts = [(i, f"own{i} text of document {i}\n{line}\nBye now\nlast{i} of {i}") for i in range(50)]
    df = spark.createDataFrame(texts, ["doc_id", "text"]).repartition(4)
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(df).collect()}
    # together with the line before it, the two-word line belongs to the repeated run
    assert got == {0: texts[0][1]} | {i: f"own{i} text of document {i}\nlast{i} of {i}" for i in range(1, 50)}
    alone = [(i, f"own{i} text of document {i}\nBye now\nlast{i} of {i}") for i in range(9)]
    df = spark.createDataFrame(alone, ["doc_id", "text"])
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup(df).collect()} == dict(alone)
    assert line_dedup.MIN_WORDS == 3


def test_maximal_runs_and_their_sources(spark):
    """Touching copies of different documents are two maximal runs and one span; runs in others are not listed."""
    a, b = [f"first {i} in one text" for i in range(5)], [f"other {i} in two text" for i in range(3)]
    df = spark.createDataFrame([(1, "\n".join([*a, "x"])), (2, "\n".join(["y", *b])), (3, "\n".join([*a[1:], *b, "z", *b[:2]]))], ["doc_id", "text"])
    got = [r for r in line_dedup.repeated_runs(df).collect()]
    assert [(r["doc_id"], [tuple(x) for x in r["runs"]], [tuple(x) for x in r["spans"]]) for r in got] == [
        (3, [(0, 4, 1, 1), (4, 7, 2, 1), (8, 10, 2, 1)], [(0, 7), (8, 10)])
    ]


def test_line_dedup_column_names(spark):
    df = spark.createDataFrame([(1, "one two three four\nx", 5), (2, "one two three four\ny", 6)], "doc_id long, text string, _lines int")
    out = line_dedup.dedup(df, counts_col="_lines")
    assert out.columns == ["doc_id", "text", "_lines", "_lines_1"]
    assert sorted((r["doc_id"], r["_lines"], tuple(r["_lines_1"])) for r in out.collect()) == [(1, 5, (2, 0, 0)), (2, 6, (2, 1, 1))]


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80), (1, 50)])
def test_near_dedup(docs, rows, k, percent):
    got = {r["doc_id"]: r for r in near_dedup.group(docs, shingle=k, percent=percent, tuples=16 if percent < 80 else 8, width=1 if percent < 80 else 2).collect()}
    want = brute.components([(r[0], r[1]) for r in rows], k, percent)
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == d) for d, r in got.items())


def test_near_dedup_chain_and_group(spark):
    """A large group of mutated copies: links must be those of brute force, also across components."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    pool, texts = [base], []
    for _ in range(120):
        v = list(rng.choice(pool))
        for i in rng.sample(range(len(v)), rng.randrange(1, 8)):
            v[i] = f"x{rng.randrange(10**6)}"
        pool.append(v)
    texts = [(i, " ".join(v)) for i, v in enumerate(pool)]
    rng.shuffle(texts)
    df = spark.createDataFrame(texts, ["doc_id", "text"])
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.group(df, shingle=3, percent=85).collect()}
    assert got == {d: c for d, (_, c) in brute.components(texts, 3, 85).items()}


def test_near_dedup_edges(docs, repeated, empty):
    assert near_dedup.group(empty).count() == 0
    out = near_dedup.group(repeated, shingle=3, percent=85)
    assert out.count() == repeated.count() and out.where("doc_id is null and not kept").count() == 0
    assert out.groupBy("doc_id").agg(F.countDistinct("component_id").alias("n")).where("n > 1").count() == 0
    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in near_dedup.group(docs).where("kept").collect()}
    assert near_dedup.keep_first(docs.limit(1)).count() == 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(90)] + [(7, 7)]
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    got = components.components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark), "t")
    assert {(r["v"], r["root"]) for r in got.collect()} == {(v, find(v)) for v in parent if find(v) != v}
    assert components.components(spark.createDataFrame([], "u long, v long"), Scratch(spark), "e").count() == 0


@pytest.mark.parametrize("length", [8, 30, 100])
def test_substring_dedup(docs, rows, length):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["h"]) for r in substring_dedup.dedup(docs, length=length).withColumn("h", F.sha2("kept", 256)).collect()}
    small = [(r[0], r[1]) for r in rows]
    assert got == brute.substring_dedup(small, length)


def test_substring_dedup_periodic(spark):
    rng = random.Random(2)
    texts = [(i, "".join(rng.choice("ab") * rng.randrange(1, 60) for _ in range(40))) for i in range(12)] + [(20, "ab" * 300), (21, "ba" * 200), (22, "é" * 150)]
    df = spark.createDataFrame(texts, ["doc_id", "text"]).repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["h"]) for r in substring_dedup.dedup(df, length=40).withColumn("h", F.sha2("kept", 256)).collect()}
    assert got == brute.substring_dedup(texts, 40)


def test_anchors_do_not_depend_on_the_text_around():
    """The strings of a stretch have the same anchors in a short and in a very long text."""
    rng = np.random.default_rng(4)
    stretch, long = rng.integers(97, 101, 400).astype(np.uint8), rng.integers(97, 101, 3_000_000).astype(np.uint8)
    long[1_500_000:1_500_400] = stretch
    find = anchors.Anchorer(100)
    short, far = find(stretch), find(long)
    inside = lambda a, base: {int(x) - base for x, lo, hi in zip(a.at, a.low, a.high) if x - hi >= base and x - lo + 100 <= base + 400}
    # all but the first and the last run of strings lie wholly inside
    assert len(set(short.at.tolist()) & inside(far, 1_500_000)) >= len(short.at) - 2


def test_substring_dedup_of_a_long_text(spark):
    """A text of over 2^20 bytes, parts of which come back in short ones and in itself."""
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefghij ") for _ in range(2**20 + 5000))
    texts = [(1, long), (2, "x" + long[700_000:700_250] + "y"), (3, long[-120:]), (4, "z" * 50 + long[10:105])]
    texts[0] = (1, long + "#" + long[5:200])
    df = spark.createDataFrame(texts, ["doc_id", "text"]).repartition(2)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["h"]) for r in substring_dedup.dedup(df, length=100).withColumn("h", F.sha2("kept", 256)).collect()}
    assert got == brute.substring_dedup(texts, 100) and [got[i][1] for i in (1, 2, 3, 4)] == [195, 250, 120, 0]


def test_substring_dedup_edges(docs, repeated, empty):
    assert substring_dedup.dedup(empty).count() == 0
    out = substring_dedup.dedup(repeated, length=100)
    assert out.count() == repeated.count()
    assert out.groupBy("doc_id").agg(F.countDistinct("n_removed").alias("n")).where("doc_id is not null and n > 1").count() == 0


def test_line_rounds_by_either_join_and_in_few_tasks(spark, monkeypatch, request):
    """Small tables are sent, large ones shuffled; what a round reads more than once is not worked out again."""
    rng = random.Random(12)
    lines = [f"line {i} of the text" for i in range(60)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(30))) for _ in range(60)]
    texts += ["\n".join(lines[k : k + 25]) for k in range(0, 30, 5)] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tracker, found, tasks = spark.sparkContext.statusTracker(), [], []
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        before = spark.conf.get(name)
        spark.conf.set(name, value)
        request.addfinalizer(lambda name=name, before=before: spark.conf.set(name, before))
    for few in (line_dedup.FEW, 0):
        monkeypatch.setattr(line_dedup, "FEW", few)
        spark.sparkContext.setJobGroup(f"few-{few}", "")
        try:
            found.append(sorted(map(str, line_dedup.repeated_runs(docs).collect())))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        stages = {i for job in tracker.getJobIdsForGroup(f"few-{few}") for i in tracker.getJobInfo(job).stageIds}
        tasks.append(sum(info.numCompletedTasks for i in stages if (info := tracker.getStageInfo(i))))
    assert found[0] and found[0] == found[1]
    assert tasks[0] < tasks[1], tasks
