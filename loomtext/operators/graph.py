"""Citation graph: edges from texts, degrees, authority, paths, neighbourhoods, ranks and communities.

Nodes and edges are tables. Degrees and scores are combined aggregates; searches join a frontier to the edges and
write each round, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomtext.sources.scratch import durable as written

from . import classify, extract, score


def edges_from_texts(docs: DataFrame) -> DataFrame:
    """doc_id and content in; one row for each neutral citation: citing_doc, citation, context, relation, strength, confidence."""
    cited = docs.select("doc_id", "content", F.explode(extract.neutral_citations(F.col("content"))).alias("c"))
    placed = cited.select(F.col("doc_id").alias("citing_doc"), F.col("c")["citation"].alias("citation"), extract.citation_context(F.col("content"), F.col("c")["citation"]).alias("context"))
    typed = placed.withColumn("relation", classify.relationship_type(F.col("context")))
    return typed.withColumn("strength", score.edge_strength(F.col("context"), F.col("relation"))).withColumn("confidence", F.lit(0.8))


def resolved_edges(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Edges whose citation names a document (citation, doc_id): the last of parallel edges counts, context cut to 100."""
    joined = edges.join(names.select("citation", F.col("doc_id").alias("cited_doc")), "citation")
    last = W.partitionBy("citing_doc", "cited_doc").orderBy(F.desc("citation"), F.desc("context"))
    kept = joined.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    return kept.withColumn("context", F.substring("context", 1, 100))


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, in_degree, out_degree for every node (id); edges are (src, dst)."""
    both = edges.select(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")).unionAll(edges.select(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")))
    sums = both.groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    zero = F.lit(0).cast("long")
    return nodes.select("id").join(sums, "id", "left").select("id", F.coalesce("in_degree", zero).alias("in_degree"), F.coalesce("out_degree", zero).alias("out_degree"))


def sentiment(edges: DataFrame) -> DataFrame:
    """cited, cites, positive, negative, judicial over edges (src, dst, relation, strength)."""
    one = edges.groupBy("dst", "src").agg(F.min("relation").alias("relation"), F.avg("strength").alias("strength"))
    good, bad = F.col("relation").isin("follows", "applies"), F.col("relation").isin("distinguishes", "overrules")
    return one.groupBy(F.col("dst").alias("cited")).agg(
        F.count("*").alias("cites"),
        F.sum(F.when(good, 1.0).when(bad, 0.0).otherwise(0.5)).alias("positive"),
        F.sum(F.when(bad, 1.0).otherwise(0.0)).alias("negative"),
        F.avg("strength").alias("judicial"),
    )


def authority(nodes: DataFrame, edges: DataFrame, *, as_of: Column) -> DataFrame:
    """Scores of every node (id, level, effective_date): court, temporal, cites, positive, negative, judicial, authority."""
    joined = nodes.join(sentiment(edges).withColumnRenamed("cited", "id"), "id", "left")
    filled = joined.select(
        "id", score.court_score(F.col("level")).alias("court"), score.temporal_score(F.col("effective_date"), as_of).alias("temporal"),
        F.coalesce("cites", F.lit(0).cast("long")).alias("cites"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("positive", "negative", "judicial")],
    )
    total = score.authority_score(F.col("court"), F.col("cites"), F.col("positive"), F.col("temporal"), F.col("judicial"))
    return filled.withColumn("authority", total)


def precedents(scored: DataFrame, *, area: str = "general", jurisdiction: str = "uk_wide", least: float = 0.3, n: int = 10) -> DataFrame:
    """Best nodes of an area and jurisdiction; ``general`` and ``uk_wide`` mean any, documents that are uk_wide always pass."""
    out = scored.where(F.col("authority") >= least)
    if area != "general":
        out = out.where(F.col("area") == area)
    if jurisdiction != "uk_wide":
        out = out.where(F.col("jurisdiction").isin(jurisdiction, "uk_wide"))
    return out.orderBy(F.desc("authority"), "id").limit(n)


def landmarks(scored: DataFrame, *, n: int = 20) -> DataFrame:
    chosen = scored.where("authority > 0.7 and cites > 3 and positive > negative")
    return chosen.orderBy(F.desc(F.col("authority") + 0.1 * F.col("cites")), "id").limit(n)


def precedent_search(scored: DataFrame, terms: list[str], *, n: int = 10, **conditions) -> DataFrame:
    """Of 2n precedents, those relevant to the terms, by 0.7 authority + 0.3 relevance. ``scored`` has title, keywords."""
    words = F.array(*[F.lit(t) for t in terms])
    found = precedents(scored, n=2 * n, **conditions).withColumn("relevance", score.query_relevance(words, F.col("title"), F.col("keywords")))
    ranked = found.where("relevance > 0.1").withColumn("combined", 0.7 * F.col("authority") + 0.3 * F.col("relevance"))
    return ranked.orderBy(F.desc("combined"), "id").limit(n)


def neighbours(edges: DataFrame, node, *, citing: int = 10, related: int = 5) -> DataFrame:
    """Up to ``citing`` documents that cite a node and ``related`` others cited by those: (kind, id)."""
    into = edges.where(F.col("dst") == node).select(F.col("src").alias("id")).distinct().orderBy("id").limit(citing)
    beside = edges.join(into.withColumnRenamed("id", "src"), "src", "left_semi").where(F.col("dst") != node).select(F.col("dst").alias("id")).distinct().orderBy("id").limit(related)
    return into.select(F.lit("citing").alias("kind"), "id").unionByName(beside.select(F.lit("related").alias("kind"), "id"))


def reachable(edges: DataFrame, seeds: DataFrame, *, max_depth: int = 3, durable=None) -> DataFrame:
    """Breadth-first search from seeds (id): (id, depth) with the least depth, at most ``max_depth``.

    ``durable`` writes a round's table and reads it back (for long searches); without it lineage grows by a join a round.
    """
    keep = durable or (lambda df: df)
    seen = keep(seeds.select("id", F.lit(0).alias("depth")).distinct())
    front = seen
    for depth in range(1, max_depth + 1):
        step = edges.join(front.select(F.col("id").alias("src")), "src").select(F.col("dst").alias("id")).distinct()
        front = keep(step.join(seen.select("id"), "id", "left_anti").withColumn("depth", F.lit(depth)))
        seen = keep(seen.unionByName(front))
    return seen


def shortest_paths(edges: DataFrame, pairs: DataFrame, *, durable=None) -> DataFrame:
    """(source, target, path) for pairs (source, target) with a way: the path with the fewest hops, the least in order among equals.

    One search runs backwards from each distinct target, a frontier a round, until nothing new is met; then every pair
    walks forwards, at each node to the least neighbour that is one hop nearer. No path is enumerated.
    """
    keep = durable or (lambda df: df)
    steps = keep(edges.select("src", "dst").distinct())
    met = keep(pairs.select("target", F.col("target").alias("id"), F.lit(0).alias("hops")).distinct())
    front, hops = met, 0
    while not front.isEmpty():
        hops += 1
        back = steps.join(front.select("target", F.col("id").alias("dst")), "dst").select("target", F.col("src").alias("id")).distinct()
        front = keep(back.join(met.select("target", "id"), ["target", "id"], "left_anti").withColumn("hops", F.lit(hops)))
        met = met.unionByName(front)
    met = keep(met)
    walk = keep(pairs.distinct().join(met.withColumnRenamed("id", "source"), ["target", "source"]).select("source", "target", F.col("source").alias("at"), F.array("source").alias("path"), "hops"))
    arrived = walk.where("hops = 0")
    going = walk.where("hops > 0")
    while not going.isEmpty():
        onward = going.join(steps.withColumnRenamed("src", "at"), "at").join(met.select("target", F.col("id").alias("dst"), F.col("hops").alias("left")), ["target", "dst"])
        nearest = onward.where(F.col("left") == F.col("hops") - 1).groupBy("source", "target").agg(F.min("dst").alias("to"))
        walk = keep(going.join(nearest, ["source", "target"]).select("source", "target", F.col("to").alias("at"), F.concat("path", F.array("to")).alias("path"), (F.col("hops") - 1).alias("hops")))
        arrived, going = arrived.unionByName(walk.where("hops = 0")), walk.where("hops > 0")
    return arrived.select("source", "target", "path")


def shortest_path(edges: DataFrame, source, target, *, durable=None) -> DataFrame:
    """One row (path, array of strings) from source to target; none if it is unreachable."""
    kind = edges.schema["src"].dataType
    pair = edges.sparkSession.range(1).select(F.lit(source).cast(kind).alias("source"), F.lit(target).cast(kind).alias("target"))
    return shortest_paths(edges, pair, durable=durable).select(F.col("path").cast("array<string>").alias("path"))


def page_rank(nodes: DataFrame, edges: DataFrame, *, rounds: int = 50, tolerance: float = 1e-9, damping: float = 0.85, durable=None) -> DataFrame:
    """(id, rank): power iteration with uniform restart until what nodes receive changes by less than ``tolerance`` in all,
    ``rounds`` times at most; rank of nodes without links out is spread evenly."""
    keep = durable or (lambda df: df)
    n = nodes.count()
    out = edges.groupBy("src").agg(F.count("*").alias("k"))
    weighted = keep(edges.join(out, "src").select("src", "dst", (1.0 / F.col("k")).alias("w")))
    zero = F.lit(0.0)
    ranks = nodes.select("id", zero.alias("got"), F.lit(1.0 / max(n, 1)).alias("rank"))
    for _ in range(rounds):
        sent = weighted.join(ranks.select(F.col("id").alias("src"), "rank"), "src").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("w")).alias("new"))
        flows = keep(ranks.join(sent, "id", "left").select("id", F.coalesce("new", zero).alias("got"), F.abs(F.coalesce("new", zero) - F.col("got")).alias("moved")))
        state = flows.agg((1.0 - F.sum("got")).alias("lost"), F.sum("moved").alias("moved")).first()
        spread = (1 - damping) / max(n, 1) + damping * (state["lost"] or 0.0) / max(n, 1)
        ranks = flows.select("id", "got", (F.lit(spread) + damping * F.col("got")).alias("rank"))
        if (state["moved"] or 0.0) < tolerance:
            break
    return ranks.select("id", "rank")


def label_propagation(nodes: DataFrame, edges: DataFrame, *, rounds: int = 5, durable=None) -> DataFrame:
    """(id, label): each round takes the most frequent label among neighbours, the least among equals."""
    keep = durable or (lambda df: df)
    both = keep(edges.select("src", "dst").unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = keep(nodes.select("id", F.col("id").alias("label")))
    for _ in range(rounds):
        votes = both.join(labels.select(F.col("id").alias("dst"), "label"), "dst").groupBy("src", "label").agg(F.count("*").alias("n"))
        best = votes.groupBy(F.col("src").alias("id")).agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("new"))
        labels = keep(labels.join(best, "id", "left").select("id", F.coalesce("new", "label").alias("label")))
    return labels


def communities(nodes: DataFrame, edges: DataFrame, *, max_rounds: int = 40, durable=None) -> tuple[DataFrame, bool]:
    """(id, label) by label propagation until nobody wants to move, and whether that was reached.

    A node takes the most frequent label among its neighbours, keeps its own if that is as frequent as any, and else the
    least. In each round a half of the nodes, another one by a hash of node and round, may move, so that neighbours do not
    swap labels for ever. Loops and repeated edges count for nothing; a node without an edge is a community of its own.
    """
    keep = durable or written(nodes.sparkSession)
    both = keep(edges.where("src <> dst").select("src", "dst").unionAll(edges.where("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = keep(nodes.select("id", F.col("id").alias("label")).distinct())
    calm = False
    for n in range(max_rounds):
        votes = both.join(labels.select(F.col("id").alias("dst"), "label"), "dst").groupBy("src", "label").agg(F.count("*").alias("n"))
        own = labels.select(F.col("id").alias("src"), F.col("label").alias("own"))
        order = F.struct(-F.col("n"), (F.col("label") != F.col("own")).alias("other"), F.col("label"))
        best = votes.join(own, "src").groupBy(F.col("src").alias("id")).agg(F.min_by("label", order).alias("new"))
        wants = labels.join(best, "id", "left").withColumn("moves", F.coalesce(F.col("new") != F.col("label"), F.lit(False)))
        turn = F.pmod(F.xxhash64("id", F.lit(n // 2)), F.lit(2)) == n % 2
        moved = keep(wants.select("id", F.when(F.col("moves") & turn, F.col("new")).otherwise(F.col("label")).alias("label"), "moves"))
        labels = moved.select("id", "label")
        calm = not moved.where("moves").limit(1).count()
        if calm:
            break
    return labels, calm


def modularity(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(n_communities, modularity) of undirected edges: the share inside communities less what chance would give."""
    pairs = edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    la, lb = labels.select(F.col("id").alias("a"), F.col("label").alias("la")), labels.select(F.col("id").alias("b"), F.col("label").alias("lb"))
    known = pairs.join(la, "a").join(lb, "b")
    ends = known.select(F.explode(F.array("la", "lb")).alias("label"), (F.col("la") == F.col("lb")).alias("inside"))
    each = ends.groupBy("label").agg(F.count("*").alias("degree"), F.count_if("inside").alias("within"))
    total = F.sum("degree").cast("double")
    return each.agg(F.count("*").alias("n_communities"), (F.sum("within") / total - F.sum(F.col("degree").cast("double") * F.col("degree")) / (total * total)).alias("modularity"))
