"""Small cases worked out by hand."""

import datetime
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomtext.functions import lexicons
from loomtext.sources.scratch import durable
from loomtext.operators import aggregate, chunk, classify, evaluate, extract, filters, generate, graph, rank, relational, score, sketches, validate, vector


def one(spark, value):
    return spark.range(1).select(value.alias("x")).first()["x"]


def lit(text):
    return F.lit(text)


@pytest.mark.parametrize(
    "title, text, area",
    [("Note", "The landlord gave notice", "housing"), ("Note", "nothing here", "general"), ("Tax and crime", "", "criminal"), ("", "x" * 2000 + " divorce", "general")],
)
def test_first_area_wins(spark, title, text, area):
    assert one(spark, classify.legal_area(lit(title), lit(text))) == area


def test_domain_argmax_and_tie(spark):
    assert one(spark, classify.tax_domain(lit(""), lit("vat input tax and payroll"))) == "value_added_tax"
    # one hit each: the earlier domain
    assert one(spark, classify.tax_domain(lit(""), lit("disposal, payroll"))) == "capital_gains_tax"
    assert one(spark, classify.tax_domain(lit(""), lit("zzz"))) == "general"


def test_citations_in_order(spark):
    text = "see [2001] 2 WLR 100, then [2010] uksc 5 and [2011] EWHC 7"
    got = one(spark, extract.citations(lit(text)))
    assert [c["citation"] for c in got] == ["[2010] uksc 5", "[2011] EWHC 7", "[2001] 2 WLR"]
    assert [c["level"] for c in got] == [1, 3, None]
    assert one(spark, extract.primary_citation(lit(""), lit("none"))) == "Unknown Citation"


def test_authority_of_a_case_without_neutral_citations(spark):
    assert one(spark, classify.authority_level(lit("case"), F.lit(None).cast("int"))) == 8


def test_legislation_references_near_an_act(spark):
    df = spark.createDataFrame([("TCGA 1992 s.12(2) applies. " + "x" * 300 + " ITA 2007 alone",)], ["t"])
    got = df.select(extract.legislation_references("t").alias("r")).first()["r"]
    assert [(r["act"], r["section"], r["kind"]) for r in got] == [("TCGA 1992", "s.12(2)", "section"), ("ITA 2007", None, "act")]


def test_spans_and_references_as_a_plain_version_gives_them(spark):
    """Places of matches, and references with their contexts, against Python's own regular expressions."""
    L, rng = lexicons, random.Random(5)
    bits = ["TCGA 1992", "tcga 1992", "ITA  2007", "FA 2010x", "section 3", "s.12(2)(a)B", "§ 9", "x" * 40, "é🙂 word", "\n", " ", ". ", "S. 5A", "VATA 1994"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(30))) for _ in range(200)] + [None, "", "ITA 2007"]
    names = dict(L.ACT_NAMES)

    def plain(text):
        out, seen = [], set()
        for hit in re.finditer(L.TAX_ACT, text or ""):
            act, near = hit[1].upper(), text[max(0, hit.start() - 100) : hit.end() + 100]
            found = [(act, f"s.{x[1]}", names.get(act, act), "section", near.strip()) for x in re.finditer(L.TAX_SECTION, near)]
            out += found or ([(act, None, names.get(act, act), "act", near.strip())] if act not in seen else [])
            seen.add(act)
        return out

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r for r in df.select("i", extract.legislation_references("t").alias("r"), extract.match_spans(F.col("t"), L.TAX_ACT).alias("m")).collect()}
    for i, t in enumerate(texts):
        assert [tuple(x) for x in got[i]["r"]] == plain(t)
        if t is not None:
            assert [tuple(x) for x in got[i]["m"]] == [(m.start(), m.end(), m[0]) for m in re.finditer(L.TAX_ACT, t)]


def test_case_references_as_a_plain_version_gives_them(spark):
    rng = random.Random(9)
    bits = ["Ab v Cd [1999]", "Gh V. HMRC  [2001]", "Re", "Ab", "v", "V.", "v.", "HMRC", "Inspector of Taxes", "[1999]", "[99]", "X", "–", ",", ".", "\n", "a1b", "[2001] v"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randrange(40))) for _ in range(600)] + ["Re Ab v. Cd Ef [1999] and Gh v HMRC [2001]", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", extract.case_references(F.col("t")).alias("r")).collect()
    hits = lambda t: {f"{m[1]} v {m[2]} [{m[3]}]" for p in (lexicons.CASE_NAME, lexicons.CASE_AGAINST_AUTHORITY) for m in re.finditer(p, t, re.ASCII)}
    assert {r["i"]: r["r"] for r in got} == {i: None if t is None else sorted(hits(t)) for i, t in enumerate(texts)}
    assert sum(bool(r["r"]) for r in got) > 50


def test_long_runs_of_words_without_a_case_are_not_searched_from_each_word(spark):
    began = time.monotonic()
    rows = spark.range(4).repartition(4).select(extract.case_references(F.concat(F.repeat(F.lit("word "), 60_000), F.col("id").cast("string"))).alias("found")).collect()
    assert [r["found"] for r in rows] == [[]] * 4 and time.monotonic() - began < 15


def test_communities(spark):
    """Cliques that hang together by single edges, loops, repeated edges, and a node without any."""
    edges = [(a, b) for c in range(3) for a in range(c * 5, c * 5 + 5) for b in range(c * 5, a)] + [(4, 5), (9, 10), (1, 0), (7, 7)]
    nodes = spark.createDataFrame([(i,) for i in range(16)], "id long")
    table = spark.createDataFrame(edges, "src long, dst long")
    labels, at_rest = graph.communities(nodes, table)
    groups = {}
    for r in labels.collect():
        groups.setdefault(r["label"], set()).add(r["id"])
    assert at_rest and sorted(map(sorted, groups.values())) == [list(range(5)), list(range(5, 10)), list(range(10, 15)), [15]]
    got = graph.modularity(labels, table).first()
    assert got["n_communities"] == 3 and abs(got["modularity"] - (30 / 32 - (21**2 + 22**2 + 21**2) / 64**2)) < 1e-12
    alone, _ = graph.communities(nodes, table.limit(0))
    assert {(r["id"], r["label"]) for r in alone.collect()} == {(i, i) for i in range(16)}
    _, at_rest = graph.communities(nodes, table, max_rounds=1)
    assert not at_rest


def test_stored_sketches(spark):
    rows = [(i % 3, i % 4, i % 50, float(i)) for i in range(3000)] + [(9, 0, None, None)]
    df = spark.createDataFrame(rows, "k int, part int, x int, v double")
    parts = sketches.states(df, ["k", "part"], distinct={"d": "x"}, quantiles={"q": "v"}, frequent={"t": "x"})
    whole = sketches.merged(parts, ["k"], distinct=["d"], quantiles=["q"], frequent=["t"])
    got = {r["k"]: r for r in whole.select("k", "rows", sketches.distinct_of("d").alias("d"), sketches.quantile_of("q", 0.5).alias("q"), sketches.top_of("t", 2).alias("t")).collect()}
    assert got[0]["rows"] == 1000 and abs(got[0]["d"] - 50) <= 2 and abs(got[0]["q"] - 1500) < 60 and [x["count"] for x in got[0]["t"]] == [20, 20]
    assert (got[9]["rows"], got[9]["d"], got[9]["q"]) == (1, 0, None)
    assert sketches.states(df.limit(0), ["k"], distinct={"d": "x"}).count() == 0


def test_xml_records(spark, tmp_path):
    from loomtext.sources import files

    (tmp_path / "a.xml").write_text("<r><d n='a'><v>1</v></d><d n='b'><v>x</v></d><d/></r>")
    got = files.xml_records(spark, str(tmp_path), "d", "_n string, v long")
    assert sorted((r["v"] or 0, r[files.CORRUPT] is None) for r in got.collect()) == [(0, False), (0, True), (1, True)]
    df = spark.createDataFrame([("<d><v>3</v></d>",), ("<d><v>",), (None,)], "x string")
    assert [r["v"] and r["v"]["v"] for r in df.select(files.parsed_xml(F.col("x"), "v long").alias("v")).collect()] == [3, None, None]


def test_long_capitalised_text_does_not_overflow(spark):
    text = "Word " * 20_000 + "Brown v Smith [1999] end"
    assert one(spark, F.size(extract.case_references(lit(text)))) == 1


@pytest.mark.parametrize("n, starts", [(0, [0]), (1000, [0]), (1001, [0, 900]), (1900, [0, 900]), (1901, [0, 900, 1800])])
def test_chunk_boundaries(spark, n, starts):
    got = one(spark, chunk.chunks_until_end(F.lit("a" * n)))
    assert [c["start"] for c in got] == starts
    assert got[-1]["start"] + len(got[-1]["text"]) == n


@pytest.mark.parametrize("n, count", [(0, 0), (8192, 2), (7792, 1), (8193, 2)])
def test_fallback_chunks(spark, n, count):
    assert len(one(spark, chunk.chunks_every(F.lit("a" * n)))) == count


def test_wrapped_chunks_keep_words(spark):
    df = spark.createDataFrame([("word " * 2000,), (None,)], ["t"])
    got = [r["c"] for r in df.select(chunk.wrapped_chunks("t").alias("c")).collect()]
    assert sum(len(x.split()) for x in got[0]) == 2000 and got[1] == []


def test_splits_are_exact(spark):
    df = spark.range(25).withColumn("g", F.lit(1))
    assert chunk.hash_split(df, "id").where("split = 'test'").count() == 3
    train = {r["id"] for r in chunk.ordered_split(df, "id", by=["g"]).where("split = 'train'").collect()}
    assert train == set(range(20))


def test_scores(spark):
    assert one(spark, score.court_score(F.lit(1))) == 1.0
    assert one(spark, score.temporal_score(F.lit(None).cast("date"), F.lit("2024-01-01").cast("date"))) == 0.5
    assert one(spark, score.edge_strength(lit("clearly and directly"), lit("follows"))) == 1.0
    assert one(spark, score.edge_strength(lit("arguably might"), lit("distinguishes"))) == pytest.approx(0.2)
    assert one(spark, score.authority_score(F.lit(1.0), F.lit(0), F.lit(0.0), F.lit(0.5), F.lit(0.0))) == pytest.approx(0.475)
    assert one(spark, score.chunk_authority_weight(F.lit(0))) == 0.1
    assert one(spark, score.query_relevance(F.array(lit("rent")), lit("Rent Act"), F.array(lit("rental")))) == pytest.approx(0.4)
    assert one(spark, score.reference_accuracy(F.array().cast("array<struct<section:string,full_name:string>>"), F.array().cast("array<struct<name:string>>"))) == 0.0


@pytest.fixture(scope="module")
def tiny_graph(spark):
    # a cycle 1-2-3, a branch to 4, an isolated 6
    edges = spark.createDataFrame([(1, 2, "follows", 1.0), (2, 3, "overrules", 0.9), (3, 1, "considers", 0.6), (1, 4, "applies", 0.8)], "src long, dst long, relation string, strength double")
    nodes = spark.createDataFrame([(i, 1, datetime.date(2020, 1, 1)) for i in (1, 2, 3, 4, 6)], "id long, level int, effective_date date")
    return nodes, edges


def test_graph(spark, tiny_graph):
    nodes, edges = tiny_graph
    deg = {r["id"]: (r["in_degree"], r["out_degree"]) for r in graph.degrees(nodes, edges).collect()}
    assert deg == {1: (1, 2), 2: (1, 1), 3: (1, 1), 4: (1, 0), 6: (0, 0)}
    assert graph.shortest_path(edges, 2, 4).first()["path"] == ["2", "3", "1", "4"]
    assert graph.shortest_path(edges, 4, 1).count() == 0
    assert graph.shortest_path(edges, 2, 2).first()["path"] == ["2"]
    # a dense layered graph has many paths; nodes of equal distance, the least first; and more than 20 hops
    dense = spark.createDataFrame([(10 * i + a, 10 * (i + 1) + b) for i in range(25) for a in range(4) for b in range(4)], "src long, dst long")
    pairs = spark.createDataFrame([(1, 252), (3, 43), (251, 1)], "source long, target long")
    found = {(r["source"], r["target"]): r["path"] for r in graph.shortest_paths(dense, pairs, durable=durable(spark)).collect()}
    assert found == {(1, 252): [1, *range(10, 250, 10), 252], (3, 43): [3, 10, 20, 30, 43]}
    seen = {r["id"]: r["depth"] for r in graph.reachable(edges, spark.createDataFrame([(2,)], "id long"), max_depth=2).collect()}
    assert seen == {2: 0, 3: 1, 1: 2}
    auth = {r["id"]: r for r in graph.authority(nodes, edges, as_of=F.lit("2024-01-01").cast("date")).collect()}
    assert auth[6]["authority"] == pytest.approx(0.4 + 0.15) and auth[3]["negative"] == 1.0
    ranks = [r["rank"] for r in graph.page_rank(nodes, edges, rounds=5).collect()]
    assert sum(ranks) == pytest.approx(1.0)
    settled = [{r["id"]: r["rank"] for r in graph.page_rank(nodes, edges, rounds=30, tolerance=t, durable=durable(spark)).collect()} for t in (0.02, 0.0)]
    assert settled[0] == pytest.approx(settled[1], abs=0.05)
    labels = {r["id"]: r["label"] for r in graph.label_propagation(nodes, edges, rounds=3).collect()}
    assert labels[6] == 6


def test_relationship_modes(spark):
    assert one(spark, classify.relationship_type(lit("it overruled [1999] AC."))) == "overrules"
    assert one(spark, classify.relationship_type(lit("it overruled [1999] AC."), mode="literal")) == "considers"


def test_validation_levels(spark):
    good = "This is not legal advice, for informational purposes only, from an AI system. The analysis and conclusion rest on the applicable principle."
    bad = "You will always win; evade tax."
    df = spark.createDataFrame([(good,), (bad,), ("",)], ["text"])
    got = [r["validation"] for r in validate.validate(df, this_year=2024).collect()]
    assert [v["compliance_level"] for v in got] == ["compliant", "warning", "warning"]
    assert got[0]["confidence_level"] == "high" and not got[1]["ethical_compliance"]
    assert one(spark, validate.citation_accuracy(lit("[1850] UKSC 1"), this_year=2024)) == 0.0
    assert one(spark, validate.hierarchy_ordered(lit("[2010] EWHC 1 and [2011] UKSC 2"))) is False
    df = spark.createDataFrame([("[2010] UKSC 1 stands", ), ("as held in [2010] UKSC 1",)], ["t"])
    assert [len(r["d"]) for r in df.select(validate.dangling_citations("t").alias("d")).collect()] == [1, 0]


def test_evaluation(spark):
    assert one(spark, evaluate.word_recall(lit("A b c"), lit("b c d e"))) == 0.5
    assert one(spark, evaluate.word_recall(lit("a"), lit("  "))) == 0.8
    assert one(spark, evaluate.citation_recall(lit(""), lit(""))) == 1.0


def test_filters(spark):
    assert one(spark, filters.housing_legislation(lit("Criminal Justice Act"), lit(""))) is False
    assert one(spark, filters.housing_legislation(lit("Rent Act 1977"), lit(""))) is True
    assert one(spark, filters.copyright_related(lit("Performers and their rights"), lit(""))) is True
    files = spark.createDataFrame([("a", "text", 60), ("a", "metadata", 60), ("a", "html", 1), ("b", "text", 10), ("b", "metadata", 60), ("b", "html", 1)], ["item", "kind", "length"])
    assert [r["item"] for r in filters.complete_downloads(files).collect()] == ["a"]


def test_statutory_references_of_long_texts(spark):
    """The same references as the plain pattern gives, and time in proportion to the length."""
    rng = random.Random(1)
    bits = ["Act 1988", "act\t1990 ", "Housing", "x", " ", "\n", "5", ".", "the Rent Act 1977", "aAct 1999", "Act Act 20011"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 14))) for _ in range(400)] + ["word " * 100_000 + "Rent Act 1977", "word " * 100_000]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", extract.statutory_references(F.col("t")).alias("r")).collect()
    for i, refs in got:
        want = re.findall(lexicons.ACT_REFERENCE, texts[i]) if i < 400 else ["word " * 100_000 + "Rent Act 1977"][: 401 - i]
        assert refs == sorted(set(want)), texts[i]


def test_splits_are_exact(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") < 400, "a").when(F.col("id") < 1000, "b").alias("g"))
    for by in (None, ["g"]):
        sizes = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count("*").alias("n")).collect()} if by else {None: 1003}
        tests = chunk.hash_split(df, "id", by=by).where("split = 'test'")
        assert {r["g"]: r["n"] for r in (tests if by else tests.withColumn("g", F.lit(None).cast("string"))).groupBy("g").agg(F.count("*").alias("n")).collect()} == {g: math.ceil(0.1 * n) for g, n in sizes.items()}
        train = chunk.ordered_split(df, "id", by=by).where("split = 'train'").collect()
        assert len(train) == sum(int(0.8 * n) for n in sizes.values())
    assert {r["id"] for r in chunk.ordered_split(df, "id").where("split = 'train'").collect()} == set(range(802))
    ties = spark.range(100).select("id", F.lit(7).alias("k"))
    assert chunk.ordered_split(ties, "k").where("split = 'train'").count() == 80


def test_numbered_rows(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("g")).repartition(5)
    got = relational.numbered(df, ["g"], [F.desc("id")], "n", durable=durable(spark))
    assert got.columns == ["id", "g", "n"]
    for g in (None, 0, 1):
        assert [r["id"] for r in got.where(F.col("g").eqNullSafe(F.lit(g).cast("long"))).orderBy("n").collect()] == sorted((i for i in range(500) if (None if i % 10 == 0 else i % 2) == g), reverse=True)
        assert got.where(F.col("g").eqNullSafe(F.lit(g).cast("long"))).agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()[:2] == (1, sum(1 for i in range(500) if (None if i % 10 == 0 else i % 2) == g))


def test_rank_and_set_operations(spark):
    df = spark.createDataFrame([("u", 2, "b"), ("u", 1, "a"), ("w", 5, "c")], ["url", "seq", "v"])
    assert {r["v"] for r in rank.keep_first(df, "url", "seq").collect()} == {"a", "c"}
    assert {r["v"] for r in rank.latest(df, "url", "seq").collect()} == {"b", "c"}
    assert rank.quota(df, "seq", 3, 2).count() == 1 and rank.quota(df, "seq", 1, 2).count() == 0
    a = spark.createDataFrame([("d1", 0.5), ("d1", 0.9)], ["document_id", "score"])
    b = spark.createDataFrame([("d1", 1.0), ("d2", 0.7)], ["document_id", "score"])
    assert [(r["document_id"], r["score"]) for r in rank.merge_hits(a, b).collect()] == [("d1", 0.9), ("d2", 0.7)]


def test_joins(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), ("b", 1)], ["k", "t"])
    right = spark.createDataFrame([("a", 0, "x"), ("a", 5, "y"), ("a", 9, "z")], ["k", "t", "v"])
    got = {(r["k"], r["t"]): r["matched_v"] for r in relational.as_of_join(left, right, on="k", left_time="t", right_time="t", values=["v"]).collect()}
    assert got == {("a", 1): "x", ("a", 5): "y", ("b", 1): None}
    # a cut between the row and its match, and keys that have no match in earlier stretches
    for cut in (1.0, 2.0, 100.0):
        got = {(r["k"], r["t"]): r["matched_v"] for r in relational.as_of_join(left, right, on="k", left_time="t", right_time="t", values=["v"], cut=cut).collect()}
        assert got == {("a", 1): "x", ("a", 5): "y", ("b", 1): None}
    big, small = spark.range(100).withColumn("k", F.lit(1)), spark.createDataFrame([(1, "v")], "k int, v string")
    assert relational.salted_join(big, small, "k").count() == 100
    assert relational.salted_join(big, small, "k", hot=[1]).count() == 100


def test_vector_search(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0]), (5, None)], "vec_id int, embedding array<double>")
    queries = spark.createDataFrame([(0, [3.0, 0.0])], "query_id int, embedding array<double>")
    got = [(r["vec_id"], round(r["score"], 3)) for r in vector.search(items, queries, 2).orderBy("score", ascending=False).collect()]
    assert got == [(1, 1.0), (3, 0.707)]
    assert one(spark, vector.nearest_cell(F.array(F.lit(0.0), F.lit(1.0)), [[1.0, 0.0], [0.0, 1.0]])) == 1


def test_generators(spark):
    docs = spark.createDataFrame([(7, "T", "statute", 1990, "x" * 3000)], "id int, title string, type string, year int, text string")
    assert generate.instructions(docs).count() == 6
    rows = spark.createDataFrame([("i", "c", "o" * 2000, None), ("i", "", "o", "advanced")], "instruction string, input string, output string, complexity string")
    basic = generate.chat_rows(rows, "tax_specialist", "phase_1_foundation").orderBy("length").collect()
    assert len(basic) == 2 and basic[1]["response"] == "o" * 1024 + "..." and "Context: c" in basic[1]["instruction"]
    assert generate.chat_rows(rows, "tax_specialist", "phase_3_expertise").count() == 1
    assert generate.tax_calculations(spark).count() == 7


def test_cleaned_lines_lose_blanks_only(spark):
    assert one(spark, extract.clean_lines(lit("0997 x\n 1219 E 1  22  3 \n\n 4 "))) == "0997 x\n1219 E 1\n22\n3\n4"


def test_licenses(spark):
    df = spark.createDataFrame([("p", "pypi", "MIT", "short"), ("p", "local", "MIT", "a longer text"), ("q", "pypi", "BSD", "xxxx"), ("q", "local", "MIT", "x")], ["name", "source", "license", "text"])
    got = {r["name"]: (r["license"], r["text"]) for r in aggregate.resolve_licenses(df).collect()}
    assert got == {"p": ("MIT", "a longer text"), "q": ("MIT", "x")}
    assert one(spark, classify.license_name(lit(" Apache 2.0 "))) == "Apache-2.0"
    assert one(spark, classify.license_of_text(lit("Apache License, Version 2.0"))) == "Apache-2.0"


def test_search_in_blocks_and_boosts_before_cut(spark):
    items = spark.createDataFrame([(0, [1.0, 0.0], 1.0), (1, [0.9, 0.1], 1.0), (2, [0.6, 0.8], 5.0)], "vec_id long, embedding array<double>, w double")
    queries = items.select(F.col("vec_id").alias("query_id"), "embedding")
    got = vector.search(items, queries, 1, max_queries=1).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in got) == [(0, 0), (1, 1), (2, 2)]
    assert [r["vec_id"] for r in vector.search(items, queries.where("query_id = 0"), 1, boost=F.col("w")).collect()] == [2]


def test_inverted_file(spark):
    """Every vector with a direction is indexed; all cells give the exact answer, half of them nine tenths of it."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(rng.normal(size=(600, 8)))] + [(900, [0.0] * 8, 0), (901, None, 0)]
    items = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    queries = items.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    centres = vector.train_cells(items, 12)
    index = vector.cell_index(items, centres)
    assert index.count() == 600
    pairs = lambda df: {(r["query_id"], r["vec_id"]) for r in df.collect()}
    exact = pairs(vector.search(items, queries, 10))
    assert pairs(vector.search_cells(index, queries, centres, 10, probes=12)) == exact
    assert len(pairs(vector.search_cells(index, queries, centres, 10, probes=6, broadcast_queries=0)) & exact) >= 0.9 * len(exact)


def _odd_vectors(spark):
    """Many copies, near copies, vectors without a direction, of another length, with a NaN, and weights that are null or large."""
    rng = random.Random(11)
    plain = [[rng.gauss(0.0, 1.0) for _ in range(5)] for _ in range(40)]
    vectors = [plain[rng.randrange(40)] for _ in range(300)] + [[x * (1 + rng.choice((0, 1e-9, 1e-15))) for x in plain[0]] for _ in range(60)]
    vectors += [None, [0.0] * 5, [1.0, 2.0], [1.0, float("nan"), 0.0, 0.0, 0.0], [None, 1.0, 1.0, 1.0, 1.0], [float("inf"), 1.0, 0.0, 0.0, 0.0]]
    rows = [(f"k{i}" if i % 50 else None, i, v, [None, 1.0, 0.5, 2.0, -1.0, 1e31][rng.randrange(6)]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "name string, vec_id long, embedding array<double>, w double")


def _plainly(items, queries, k, item, boost=None):
    """Every pair by column expressions."""
    left = items.select(item, vector.unit(F.col("embedding")).alias("v"), (F.lit(1.0) if boost is None else boost).alias("b")).where("v is not null")
    right = queries.select("query_id", vector.unit(F.col("embedding")).alias("q")).where("q is not null")
    scored = left.crossJoin(right).select("query_id", item, vector.dot(F.col("v"), F.col("q")).alias("score"), "b").withColumn("final", F.col("score") * F.col("b"))
    best = scored.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("final"), item))).where(F.col("n") <= k)
    return best.select("query_id", item, "score", *(["final"] if boost is not None else []))


def _same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("item, boosted, k", [("vec_id", False, 7), ("name", True, 7), ("vec_id", True, 1000)])
def test_search_by_matrix_products_is_exact(spark, monkeypatch, item, boosted, k):
    monkeypatch.setattr(vector, "PAIRS", 50)
    items = _odd_vectors(spark)
    queries = items.where("vec_id % 9 = 0 or vec_id >= 355").select(F.col("vec_id").alias("query_id"), "embedding")
    boost = F.col("w") if boosted else None
    got = vector.search(items.repartition(3), queries, k, item=item, boost=boost)
    _same(got, _plainly(items, queries, k, item, boost))
    assert "MapInArrow" in got._jdf.queryExecution().toString()  # no row for each pair


def test_cells_are_searched_without_a_row_for_each_pair(spark):
    items = _odd_vectors(spark).where("vec_id < 360")
    queries = items.where("vec_id % 9 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    centres = vector.train_cells(items, 6)
    got = vector.search_cells(vector.cell_index(items, centres), queries, centres, 7, probes=6, broadcast_queries=0)
    assert "Join" not in got._jdf.queryExecution().toString()
    exact = {(r["query_id"], r["vec_id"]) for r in _plainly(items, queries, 7, "vec_id").collect()}
    assert {(r["query_id"], r["vec_id"]) for r in got.collect()} == exact
