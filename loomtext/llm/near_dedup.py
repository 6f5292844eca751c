"""MinHash near-dedup with tensored banding.

A document's set is its distinct word shingles. Two small collections of minhash tuples are computed, ``tuples``
left and ``tuples`` right ones of ``width`` hashes; every (left, right) pair forms a table key, so tuples^2 keys
cost 2 * tuples * width minhashes. At similarity s a pair shares a key with probability
(1 - (1 - s^width)^tuples)^2. By default the tuples are as few as give 0.9999 at the threshold: 8 for 0.85, 10 for 0.8.

Work stays linear in the size of a group of copies:
1. Equal sets are one class, stood for by its smallest id.
2. A class needs a left and a right tuple in common with another class before its keys are made (exact).
3. Each bucket links its members to one of them, chosen by hash, so a group meets as many centres as it has
   tables; links are confirmed on the full sets.
4. Links that no centre has shown can only run between different components of one bucket of three classes or
   more. Classes of such buckets are joined across components by prefix filter: of a class of n shingles only the
   rarest floor((1 - t) n) + 1 can hold the first common one, and only members outside a shingle's largest
   component look for partners. This is exact and has no cap; links are confirmed on the full sets.

All state is in written tables: signatures, then sets of the classes that met another one. Groups are combined
minima and joins; nothing per group is gathered and nothing comes to the driver but counts.

Defined results: null text and text without words have an empty set, are linked with nothing and kept; fewer
words than the shingle make one shingle; rows that share an id are one vertex (all kept or dropped together);
rows with a null id have a null component and are kept; an empty table gives an empty table; extra columns are
ignored by ``group`` and pass through ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import RollingHash, mix
from .common import Scratch, fresh
from .components import components


#: Classes of one shingle that meet a seeking class in one task.
SLOT = 64


class Shingler:
    def __init__(self, size: int):
        self.size, self.hash = size, RollingHash(71)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the word shingles; A-Z count as a-z."""
        ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not ws:
            return np.zeros(0, dtype=np.uint64)
        data = np.frombuffer(b" ".join(ws), dtype=np.uint8)
        ends = np.cumsum(np.fromiter(map(len, ws), dtype=np.int64, count=len(ws)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        k = min(self.size, len(ws))
        first, last = starts[: len(ws) - k + 1], ends[k - 1 :]
        return np.unique(self.hash.stretches(self.hash.prefix(data), first, last))


def _factors(n: int) -> np.ndarray:
    return np.random.default_rng(1009).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def tuples_for(similarity: float, width: int, *, recall: float = 0.9999) -> int:
    """The fewest tuples on each side with which a pair of that similarity shares a table key with probability ``recall``."""
    tuples = 1
    while (1 - (1 - similarity**width) ** tuples) ** 2 < recall:
        tuples += 1
    return tuples


def minhash_tuples(shingles: np.ndarray, tuples: int, width: int, factors: np.ndarray) -> np.ndarray:
    """2 * tuples numbers: the left collection, then the right one; each stands for ``width`` minhashes."""
    mins = np.empty(len(factors), dtype=np.uint64)
    for i, f in enumerate(factors):
        h = shingles * f
        mins[i] = (h ^ (h >> np.uint64(32))).min()
    out = np.zeros(2 * tuples, dtype=np.uint64)
    for row in mins.reshape(2 * tuples, width).T:
        out = mix(out * np.uint64(31) + row + np.arange(2 * tuples, dtype=np.uint64))
    return out


def signatures(docs: DataFrame, *, id_col: str, text_col: str, shingle: int, tuples: int, width: int) -> DataFrame:
    """(d, n, ka, kb, sig): id, set size, 128-bit name of the set, and the tuples."""
    factors = _factors(2 * tuples * width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(shingle)
        for b in batches:
            n, ka, kb, sigs = [], [], [], []
            for text in b.column(1):
                s = shingles(text.as_py())
                n.append(len(s))
                with np.errstate(over="ignore"):
                    ka.append(int(mix(s).sum(dtype=np.uint64)) - 2**63 if len(s) else 0)
                    kb.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) - 2**63 if len(s) else 0)
                sigs.append(minhash_tuples(s, tuples, width, factors).view(np.int64).tolist() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ka, pa.int64()), pa.array(kb, pa.int64()), pa.array(sigs, pa.list_(pa.int64()))],
                ["d", "n", "ka", "kb", "sig"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"))
    return named.mapInArrow(run, f"d {kind}, n long, ka long, kb long, sig array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, few: bool, *, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(d, s) for the ids (column d) wanted: the sorted shingle hashes."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(shingle)
        for b in batches:
            sets = pa.array([shingles(t.as_py()).view(np.int64) for t in b.column(1)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), sets], ["d", "s"])

    named = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"))
    wanted = named.join(F.broadcast(ids) if few else ids, "d", "left_semi")
    return wanted.mapInArrow(run, f"d {kind}, s array<long>").dropDuplicates(["d"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("d").alias("u"), F.col("s").alias("su"))
    right = sets.select(F.col("d").alias("v"), F.col("s").alias("sv"))
    both = pairs.join(left, "u").join(right, "v")
    common = F.size(F.array_intersect("su", "sv"))
    return both.where(common * 100 >= (F.size("su") + F.size("sv") - common) * percent).select("u", "v")


def _across(open_ids: DataFrame, sets: DataFrame, roots: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Candidate pairs between different components by prefix filter (exact)."""
    mine = open_ids.join(sets, "d").join(roots.select(F.col("v").alias("d"), "root"), "d", "left").select("d", F.coalesce("root", "d").alias("c"), F.size("s").alias("n"), "s")
    mine = scratch.put(mine, "open_sets")
    terms = mine.select("d", "c", "n", F.explode("s").alias("x"))
    often = terms.groupBy("x").agg(F.count("*").alias("df"))
    # a shingle of one class cannot be common: it fills prefixes but is never joined
    ranked = terms.join(often, "x").groupBy("d", "c", "n").agg(F.sort_array(F.collect_list(F.struct("df", "x"))).alias("o"))
    longest = F.floor((F.col("n") * (100 - percent)) / 100).cast("int") + 1
    placed = F.transform(F.slice("o", F.lit(1), longest), lambda y, i: F.struct(y["df"].alias("df"), y["x"].alias("x"), i.alias("at")))
    prefix = scratch.put(
        ranked.select("d", "c", "n", F.explode(F.filter(placed, lambda y: y["df"] > 1)).alias("y")).select("d", "c", "n", F.col("y")["x"].alias("x"), F.col("y")["at"].alias("at")),
        "prefixes",
    )
    shares = prefix.groupBy("x", "c").agg(F.count("*").alias("k"))
    largest = shares.groupBy("x").agg(F.max(F.struct("k", "c")).alias("top"), F.count("*").alias("parts"), F.sum("k").alias("k")).where("parts > 1")
    # a shingle of many classes is dealt out: who holds it by a hash of the class, who seeks it to each of these parts
    slots = F.ceil(F.col("k") / SLOT).cast("int")
    # written, so that the join below is of two plain shuffles, whose hot keys AQE can split
    largest = scratch.put(largest.select("x", F.col("top")["c"].alias("main"), slots.alias("slots")), "shared_shingles")
    mixed = scratch.put(prefix.join(largest, "x"), "mixed")
    seek = mixed.where("c <> main").select(
        "x", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"), F.col("d").alias("u"), F.col("c").alias("cu"), F.col("n").alias("nu"), F.col("at").alias("pu")
    )
    hold = mixed.select(
        "x", F.pmod(F.xxhash64("d"), F.col("slots")).cast("int").alias("slot"), F.col("d").alias("v"), F.col("c").alias("cv"), F.col("n").alias("nv"), F.col("at").alias("pv")
    )
    # if x is the first common shingle, no more can be common than the fewer of those that follow it
    rest = F.least(F.col("nu") - F.col("pu"), F.col("nv") - F.col("pv"))
    near = rest * (100 + percent) >= (F.col("nu") + F.col("nv")) * percent
    met = seek.join(hold, ["x", "slot"]).where((F.col("cu") != F.col("cv")) & near)
    return met.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def group(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    tuples: int | None = None,
    width: int = 2,
    broadcast_ids: int = 100_000,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row."""
    tuples = tuples or tuples_for(percent / 100, width)
    scratch = Scratch(docs.sparkSession)
    sigs = scratch.put(signatures(docs, id_col=id_col, text_col=text_col, shingle=shingle, tuples=tuples, width=width), "signatures")
    full = sigs.where("n > 0 and d is not null")
    classes = scratch.put(full.groupBy("ka", "kb").agg(F.min("d").alias("d"), F.first("sig").alias("sig")), "classes")

    half = classes.select("d", F.posexplode("sig").alias("p", "h"))
    shared = half.groupBy("p", "h").agg(F.count("*").alias("k"), F.min("d").alias("one")).where("k > 1").select("p", "h")
    met = half.join(shared, ["p", "h"]).groupBy("d").agg(F.min("p").alias("lo"), F.max("p").alias("hi"))
    alive = met.where((F.col("lo") < tuples) & (F.col("hi") >= tuples)).select("d")
    left, right = F.slice("sig", 1, tuples), F.slice("sig", tuples + 1, tuples)
    table_keys = F.flatten(F.transform(left, lambda a, i: F.transform(right, lambda b, j: F.xxhash64(i, j, a, b))))
    keys = scratch.put(classes.join(alive, "d", "left_semi").select("d", F.explode(table_keys).alias("key")), "keys")

    buckets = keys.groupBy("key").agg(F.count("*").alias("k"), F.min(F.struct(F.xxhash64("d", "key").alias("h"), F.col("d").alias("d"))).alias("c")).where("k > 1")
    star = keys.join(buckets.select("key", F.col("c")["d"].alias("centre")), "key").where("d <> centre")
    pairs = scratch.put(star.select(F.greatest("d", "centre").alias("u"), F.least("d", "centre").alias("v")).distinct(), "star_pairs")
    ids = scratch.put(pairs.select(F.col("u").alias("d")).unionAll(pairs.select("v")).distinct(), "met")
    few = ids.limit(broadcast_ids + 1).count() <= broadcast_ids
    sets = scratch.put(full_sets(docs, ids, few, id_col=id_col, text_col=text_col, shingle=shingle), "sets")
    links = scratch.put(confirmed(pairs, sets, percent), "star_links")
    roots = components(links, scratch, "star")

    member = keys.join(buckets.where("k > 2").select("key"), "key").join(roots.select(F.col("v").alias("d"), "root"), "d", "left").select("key", "d", F.coalesce("root", "d").alias("c"))
    open_keys = member.groupBy("key").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a <> b").select("key")
    open_ids = scratch.put(member.join(open_keys, "key").select("d").distinct(), "open")
    more = scratch.put(confirmed(_across(open_ids, sets, roots, scratch, percent), sets, percent), "cross_links")
    if not more.isEmpty():
        # components so far stand for their links
        roots = components(roots.select(F.col("v").alias("u"), F.col("root").alias("v")).unionByName(more), scratch, "all")

    of_class = classes.select("ka", "kb", F.col("d").alias("rep")).join(roots.select(F.col("v").alias("rep"), "root"), "rep", "left")
    of_class = of_class.select(F.col("ka").alias("xa"), F.col("kb").alias("xb"), F.coalesce("root", "rep").alias("root"))
    found = sigs.join(of_class, (F.col("ka") == F.col("xa")) & (F.col("kb") == F.col("xb")) & (F.col("n") > 0), "left")
    component = F.when(F.col("d").isNotNull(), F.coalesce("root", "d"))
    return found.select(
        F.col("d").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("d") == component, F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One document of each group (its smallest id), in the input's columns."""
    key = fresh(docs.columns, "_gone")
    gone = group(docs, id_col=id_col, **options).where("not kept").select(F.col(id_col).alias(key)).distinct()
    gone = Scratch(docs.sparkSession).put(gone, "gone")
    few = gone.limit(100_001).count() <= 100_000
    return docs.join(F.broadcast(gone) if few else gone, F.col(id_col) == F.col(key), "left_anti")
