"""Line dedup: suffix array over line-ID sequences by distributed prefix doubling.

A document is a sequence of line IDs (128-bit hashes of its lines; blank lines are skipped and always stay). Its
suffixes are ranked by prefix doubling: the rank at level k orders suffixes by their first 2^k lines, and the rank at
level k + 1 is the place of the pair (own rank, rank 2^k lines on) in the sorted table of all such pairs. A suffix
that is alone in its bucket is decided and leaves, as does one with fewer than 2^(k + 1) lines left; only the others
are carried, so that most lines leave in the first round and the last round is the longest repeat's.

Longest-common-prefix intervals are found from the ranks, without comparing neighbours one by one. A suffix is a copy
to depth 2^k if its bucket there has an earlier member (smaller id, then line). For each suffix the deepest such
level is taken; below it the bucket is split at depths of 2^k + 2^(k-1), 2^k + 2^(k-1) + 2^(k-2) and so on by the
ranks of the lines that follow. The earliest suffix of a part stands for it in what is left of the parent, the
others go on into the part. What is reached is the deepest interval in which the suffix is not the earliest one: the
interval's depth is the length of the longest run from there that also starts earlier. Runs that lie in no other one
are the maximal repeated runs; those with ``min_words`` words are deleted, and the earliest start stays.

Everything is a sort, a combined aggregate or an equality join whose hot keys AQE can split; nothing per line or per
bucket is gathered. Each round is written to the shared folder, and what it reads more than once is written before. A
join with a table of at most ``FEW`` rows, by a count, sends that table to all tasks. Text is shuffled once, for the cut.

Defined results: null text stays null with no lines; text without a qualifying run is kept as it is; rows that share
id and text are one document, so they do not make each other copies; rows that share an id only are documents of
their own, in order of their text's hash; a null id orders first; an empty table gives an empty table; extra columns
pass through ``dedup``, and its count column takes a name that none of them has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import SPACES, Scratch, fresh, let, words

MIN_WORDS = 3
#: Rows of a table that a join sends to all tasks.
FEW = 100_000


def full_lines(text: Column) -> Column:
    """The non-blank lines."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def line_table(docs: DataFrame, *, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(d, u, at, rest, need, a, b): document, hash of its text, line number, lines from there on, the number of lines
    that have ``min_words`` words (null if the document ends before), and the line's ID."""

    def needs(counts: Column) -> Column:
        def reach(i: Column) -> Column:
            zero = F.struct(F.lit(0).alias("w"), F.lit(0).alias("m"))
            end = F.aggregate(
                F.slice(counts, i + 1, F.lit(min_words)),
                zero,
                lambda s, c: F.when(s["w"] >= min_words, s).otherwise(F.struct((s["w"] + c).alias("w"), (s["m"] + 1).alias("m"))),
            )
            return let(end, lambda e: F.when(e["w"] >= min_words, e["m"]))

        return F.transform(counts, lambda c, i: F.when(c >= min_words, F.lit(1)).otherwise(reach(i)))

    def listed(lines: Column) -> Column:
        return let(
            F.transform(lines, lambda x: F.size(words(x))),
            lambda counts: F.zip_with(
                lines,
                needs(counts),
                lambda x, m: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x, F.length(x)).alias("b"), m.alias("need"), F.size(lines).alias("n")),
            ),
        )

    text = F.col(text_col)
    each = docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("u"), F.posexplode(let(full_lines(text), listed)).alias("at", "x"))
    return each.select("d", "u", "at", (F.col("x.n") - F.col("at")).alias("rest"), "x.need", "x.a", "x.b")


def _sent(table: DataFrame) -> DataFrame:
    """A written table to join with: sent to all tasks if it has at most ``FEW`` rows, so that the other side stays where it is."""
    return F.broadcast(table) if table.count() <= FEW else table


def _ranked(pairs: DataFrame, scratch: Scratch, level: int) -> DataFrame:
    """Suffixes (doc, at, rest, need, x, y) that share (x, y) with another one, with rank ``r`` and the bucket's earliest (fd, fa)."""
    pairs = scratch.put(pairs, f"pairs-{level}")  # read twice
    place = F.struct("doc", "at")
    shared = pairs.groupBy("x", "y").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    # numbers that rise along a global sort: ranks need order, not gaps of one
    ordered = shared.orderBy("x", "y").select("x", "y", F.col("first.doc").alias("fd"), F.col("first.at").alias("fa"), F.monotonically_increasing_id().alias("r"))
    buckets = scratch.put(ordered, f"buckets-{level}")
    ranks = scratch.put(pairs.join(_sent(buckets), ["x", "y"]).select("doc", "at", "rest", "need", "r", "fd", "fa"), f"ranks-{level}")
    scratch.drop(f"pairs-{level}")
    scratch.drop(f"buckets-{level}")
    return ranks


def suffix_ranks(lines: DataFrame, scratch: Scratch) -> tuple[DataFrame, list[DataFrame]]:
    """(d, u, doc) for documents with shared lines, ``doc`` in their order; and by level the ranks of undecided suffixes."""
    # written, so that the join is of two plain shuffles, whose hot lines AQE can split
    keys = scratch.put(lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b"), "line-ids")
    shared = scratch.put(lines.join(keys, ["a", "b"]), "shared")
    order = scratch.put(shared.select("d", "u").distinct().orderBy("d", "u").withColumn("doc", F.monotonically_increasing_id()), "order")
    of = _sent(order.select(F.col("d").alias("od"), F.col("u").alias("ou"), "doc"))
    suffixes = shared.join(of, F.col("d").eqNullSafe(F.col("od")) & (F.col("u") == F.col("ou"))).dropDuplicates(["doc", "at"])
    levels = [_ranked(suffixes.select("doc", "at", "rest", "need", F.col("a").alias("x"), F.col("b").alias("y")), scratch, 0)]
    while not levels[-1].isEmpty():
        step = 2 ** (len(levels) - 1)
        here = levels[-1].where(F.col("rest") >= 2 * step).select("doc", "at", "rest", "need", F.col("r").alias("x"))
        there = levels[-1].select("doc", (F.col("at") - step).alias("at"), F.col("r").alias("y"))
        levels.append(_ranked(here.join(_sent(there), ["doc", "at"]), scratch, len(levels)))
    return order, levels[:-1]


def copied_lengths(levels: list[DataFrame], scratch: Scratch) -> DataFrame | None:
    """(doc, at, need, gd, ga, m): the longest run of ``m`` lines from a suffix that also starts earlier, at (gd, ga)."""
    copies = None
    for k, ranks in enumerate(levels):
        later = ranks.where("doc <> fd or at <> fa").select("doc", "at", F.struct(F.lit(k).alias("k"), "fd", "fa", "need").alias("s"))
        copies = later if copies is None else copies.unionByName(later)
    if copies is None:
        return None
    deepest = copies.groupBy("doc", "at").agg(F.max("s").alias("s"))
    start = deepest.select("doc", "at", "s.need", "s.k", F.col("s.fd").alias("gd"), F.col("s.fa").alias("ga"), F.expr("shiftleft(1, s.k)").alias("m"))
    start = scratch.put(start, "copies")
    found = start.where(F.col("k") == len(levels) - 1)
    for s in reversed(range(len(levels) - 1)):
        step = 2**s
        ahead = levels[s].select(F.col("doc").alias("xd"), F.col("at").alias("xa"), F.col("r").alias("x"))
        ahead_of_first = ahead.select(F.col("xd").alias("yd"), F.col("xa").alias("ya"), F.col("x").alias("y"))
        if levels[s].count() <= FEW:
            ahead, ahead_of_first = F.broadcast(ahead), F.broadcast(ahead_of_first)
        looked = (
            found.join(ahead, (F.col("doc") == F.col("xd")) & (F.col("at") + F.col("m") == F.col("xa")), "left")
            .join(ahead_of_first, (F.col("gd") == F.col("yd")) & (F.col("ga") + F.col("m") == F.col("ya")), "left")
            .select("doc", "at", "need", "k", "gd", "ga", "m", "x", F.col("x").eqNullSafe(F.col("y")).alias("same"))
        )
        looked = scratch.put(looked, f"looked-{s}")  # read three times
        # with the interval's earliest suffix or with none: no other one is needed, and these may be many
        plain = looked.where("x is null or same").withColumn("m", F.col("m") + F.when(F.col("x").isNotNull(), step).otherwise(0))
        # parts of the interval that its earliest suffix is not in have an earliest one of their own, which stays behind
        part, apart = ["gd", "ga", "m", "x"], looked.where("x is not null and not same")
        heads = apart.groupBy(*part).agg(F.min(F.struct("doc", "at")).alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
        heads = scratch.put(heads, f"heads-{s}")
        split = apart.join(_sent(heads), part, "left")
        away = F.col("head").isNotNull() & (F.struct("doc", "at") != F.col("head"))
        names = ["doc", "at", "need", "k", "gd", "ga", "m"]
        moved = split.select(
            "doc", "at", "need", "k",
            F.when(away, F.col("head.doc")).otherwise(F.col("gd")).alias("gd"),
            F.when(away, F.col("head.at")).otherwise(F.col("ga")).alias("ga"),
            F.when(away, F.col("m") + step).otherwise(F.col("m")).alias("m"),
        ).unionByName(plain.select(*names))
        found = scratch.put(moved, f"copies-{s}").unionByName(start.where(F.col("k") == s))
        scratch.drop(f"looked-{s}")
        scratch.drop(f"heads-{s}")
    return found.select("doc", "at", "need", "gd", "ga", "m")


def repeated_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, text_hash, runs, spans) for documents with copies, by number among the document's non-blank lines.

    ``runs`` are the maximal repeated runs, array<struct<from, to, like, like_from>>: ``to`` is exclusive, ``like`` is the
    id of the earliest document with that run and ``like_from`` its line there. ``spans`` are the lines that they cover,
    array<struct<from, to>> apart from each other.
    """
    scratch = Scratch(docs.sparkSession)
    lines = scratch.put(line_table(docs, id_col=id_col, text_col=text_col, min_words=min_words), "lines")
    order, levels = suffix_ranks(lines, scratch)
    copied = copied_lengths(levels, scratch)
    if copied is None:
        kind = docs.schema[id_col].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"`{id_col}` {kind}, text_hash bigint, runs array<struct<from:int,to:int,like:{kind},like_from:int>>, spans array<struct<from:int,to:int>>")
    by_start = W.partitionBy("doc").orderBy("at")  # one document's lines
    before = by_start.rowsBetween(W.unboundedPreceding, -1)
    runs = copied.where("m >= need").select("doc", "at", (F.col("at") + F.col("m")).alias("to"), "gd", "ga")
    maximal = runs.withColumn("reached", F.max("to").over(before)).where("reached is null or to > reached")
    marked = maximal.withColumn("opens", F.coalesce(F.col("at") > F.col("reached"), F.lit(True)).cast("int"))
    spans = marked.withColumn("span", F.sum("opens").over(by_start.rowsBetween(W.unboundedPreceding, W.currentRow)))
    sources = order.select(F.col("doc").alias("gd"), F.col("d").alias("like"))
    run = F.struct(F.col("at").alias("from"), "to", "like", F.col("ga").alias("like_from"))
    per_span = spans.join(sources, "gd").groupBy("doc", "span").agg(F.min("at").alias("from"), F.max("to").alias("to"), F.collect_list(run).alias("rs"))
    per_doc = per_span.groupBy("doc").agg(F.sort_array(F.flatten(F.collect_list("rs"))).alias("runs"), F.sort_array(F.collect_list(F.struct("from", "to"))).alias("spans"))
    return order.join(per_doc, "doc").select(F.col("d").alias(id_col), F.col("u").alias("text_hash"), "runs", "spans")


def dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", counts_col: str | None = None, min_words: int = MIN_WORDS, keep_empty: bool = True
) -> DataFrame:
    """Documents without the later copies of repeated runs, in the input's columns.

    Without ``keep_empty`` those go that have no word, or that the cuts leave without one.
    ``counts_col`` adds a struct of lines, removed and runs under that name, or the next free one.
    """
    runs = repeated_runs(docs, id_col=id_col, text_col=text_col, min_words=min_words)
    key, mark, found, out = (fresh(docs.columns, c) for c in ("_id", "_hash", "_runs", "_lines"))
    runs = runs.select(F.col(id_col).alias(key), F.col("text_hash").alias(mark), F.struct("spans", F.size("runs").alias("n")).alias(found))
    joined = docs.join(runs, F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(F.col(text_col)) == F.col(mark)), "left")

    if not keep_empty:  # told from the spans, so that texts are not cut twice
        s = F.col(found)["spans"]
        all_gone = (F.size(s) == 1) & (F.get(s, 0)["from"] == 0) & (F.get(s, 0)["to"] == F.size(full_lines(F.col(text_col))))
        joined = joined.where(F.col(text_col).rlike("[^ \\t-\\r]") & ~F.coalesce(all_gone, F.lit(False)))

    def cut(text: Column, spans: Column) -> Column:
        def by_number(lines: Column) -> Column:
            numbered = F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
            full = F.filter(numbered, lambda x: F.btrim(x["x"], F.lit(SPACES)) != "")
            return let(full, lambda f: without(lines, f))

        def without(lines: Column, full: Column) -> Column:
            gone = F.flatten(F.transform(spans, lambda r: F.transform(F.slice(full, r["from"] + 1, r["to"] - r["from"]), lambda x: x["i"])))
            stay = lambda g: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), g)
            return let(
                gone,
                lambda g: F.struct(
                    F.array_join(F.transform(stay(g), lambda i: F.get(lines, i)), "\n").alias("text"),
                    F.size(full).alias("lines"),
                    F.size(g).alias("removed"),
                ),
            )

        return let(F.split(text, "\n", -1), by_number)

    text = F.col(text_col)
    plain = F.struct(text.alias("text"), F.size(full_lines(text)).alias("lines"), F.lit(0).alias("removed"))
    done = let(F.col(found)["spans"], lambda s: cut(text, s))
    result = joined.withColumn(out, F.when(F.col(found).isNull() | text.isNull(), plain).otherwise(done))
    result = result.withColumn(text_col, F.col(out)["text"])
    if length_col in docs.columns:
        result = result.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    if counts_col is None:
        return result.select(*docs.columns)
    counts = F.struct(F.col(out)["lines"].alias("lines"), F.col(out)["removed"].alias("removed"), F.coalesce(F.col(found)["n"], F.lit(0)).alias("runs"))
    return result.select(*docs.columns, counts.alias(fresh(docs.columns, counts_col)))
