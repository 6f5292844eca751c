"""Suffix-array dedup of byte texts by bucket-pointer refinement.

Every byte that lies in a string of ``length`` bytes which also starts earlier (smaller id, or same document and
earlier start) is removed; strings are judged on the input and never cross documents.

A suffix for every byte would need over 16 bytes of disk for each byte of text, so suffixes are entered in runs: the
starts of consecutive strings that share an anchor (see ``anchors``) are one entry, about 1 for 30 bytes, which holds
the anchor's place and the least and greatest distance of its starts before the anchor.

1. Initial buckets: entries are bucketed by the q-gram at the anchor; a bucket's identifier is its place in the sorted
   table of shared q-grams. An entry alone in its bucket is decided and leaves.
2. In a bucket, entries whose strings cover equal bytes (equal hulls) are copies of the earliest of them and leave. If
   a bucket holds one hull only, it is done; else the earliest entry of every hull is undecided.
3. Refinement: an undecided entry's starts are split into ``PARTS`` parts. Two pointers lead to the initial q-gram
   buckets at later offsets of these strings, which stand next to the bytes that the bucket has settled already.
   Sorting on (bucket, part, pointer, pointer) gives the refined buckets and their identifiers, which are the first
   sort key of the next round: updates are reused recursively, on the undecided entries only. With 64 starts to an
   entry three rounds settle every single string.

Groups are never gathered: bucket sizes and earliest entries are combined aggregates, the joins back are open to AQE's
split of hot keys, and equal entries inside a batch are combined before the first shuffle. Texts are shuffled twice
(for the entries to refine, and for the final cut), and only in documents' order of ids. A decision of equality rests
on 128 bits of hash or more.

Defined results: null counts as empty; texts shorter than ``length`` lose nothing; rows that share an id are one
document, so equal places in them are no copies of each other; a null id orders first; an empty table gives an
empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import Anchorer
from .common import Scratch

PARTS = 4


def _bytes(text) -> bytes:
    if text is None:
        return b""
    return text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")


def _entries(docs: DataFrame, length: int) -> DataFrame:
    """(core, hull, d, p, copy): p packs place, low and high; copy marks entries equal to an earlier one of the batch."""
    reach = Anchorer(length).reach

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchorer = Anchorer(length)
        for b in batches:
            ids = b.column(0).to_pylist()
            known = sorted({i for i in ids if i is not None})
            rank = {None: 0} | {v: k + 1 for k, v in enumerate(known)}
            core, hull, row, packed = [], [], [], []
            for i, text in enumerate(b.column(1)):
                a = anchorer(np.frombuffer(_bytes(text.as_py()), dtype=np.uint8))
                if len(a.at):
                    core.append(a.core)
                    hull.append(a.hull)
                    row.append(np.full(len(a.at), i))
                    packed.append((a.at * reach + a.low) * reach + a.high)
            if not core:
                continue
            c, h, r, p = (np.concatenate(x) for x in (core, hull, row, packed))
            order = np.lexsort((p, np.array([rank[x] for x in ids])[r], h, c))
            c, h, r, p = c[order], h[order], r[order], p[order]
            d = np.array([rank[x] for x in ids])[r]
            same_class = np.concatenate([[False], (c[1:] == c[:-1]) & (h[1:] == h[:-1])])
            head = np.maximum.accumulate(np.where(same_class, 0, np.arange(len(c))))
            copy = same_class & ((d != d[head]) | (p != p[head]))
            stay = ~same_class | copy
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[stay].view(np.int64)), pa.array(h[stay].view(np.int64)), b.column(0).take(pa.array(r[stay])), pa.array(p[stay]), pa.array(copy[stay])],
                ["core", "hull", "d", "p", "copy"],
            )

    kind = docs.schema["d"].dataType.simpleString()
    return docs.mapInArrow(run, f"core long, hull long, d {kind}, p long, copy boolean")


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(d, p, off, ctx): the bytes that an entry's strings cover, and the anchor's place in them."""
    reach = Anchorer(length).reach
    kind = docs.schema["d"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, places, offs, ctxs = [], [], [], []
            for i, (text, ps) in enumerate(zip(b.column(1), b.column(2), strict=True)):
                data = _bytes(text.as_py())
                for p in ps.as_py():
                    at, low, high = p // (reach * reach), p // reach % reach, p % reach
                    ids.append(i)
                    places.append(p)
                    offs.append(high)
                    ctxs.append(data[at - high : at - low + length])
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(ids)), pa.array(places, pa.int64()), pa.array(offs, pa.int32()), pa.array(ctxs, pa.binary())], ["d", "p", "off", "ctx"]
                )

    lists = wanted.groupBy(F.col("d").alias("wd")).agg(F.collect_set("p").alias("ps"))  # one document's own entries
    return docs.join(lists, F.col("d").eqNullSafe(F.col("wd"))).select("d", "t", "ps").mapInArrow(run, f"d {kind}, p long, off int, ctx binary")


def _refined(entries: DataFrame, key: list[str], scratch: Scratch, step: int, done: list[str]) -> tuple[DataFrame, DataFrame]:
    """(copies, undecided) of entries (*key, s, hull, d, p, low, high) after one sort on ``key``.

    copies: (d, p, low, high) that equal an earlier entry; undecided: (b, s, d, p), b being the identifier of the new
    bucket. ``done`` names written tables that nothing reads after this step.
    """
    sizes = entries.groupBy(*key).agg(F.count("*").alias("k")).where("k > 1")
    buckets = scratch.put(sizes.orderBy(*key).select(*[F.col(c).alias(f"k_{c}") for c in key], F.monotonically_increasing_id().alias("nb")), f"buckets-{step}")
    same = [F.col(c) == F.col(f"k_{c}") for c in key]
    shared = scratch.put(entries.join(buckets, same).select("nb", "s", "hull", "d", "p", "low", "high"), f"shared-{step}")
    for name in [*done, f"buckets-{step}"]:
        scratch.drop(name)
    place = F.struct("d", "p")
    classes = scratch.put(shared.groupBy("nb", "s", "hull").agg(F.min(place).alias("least"), F.count("*").alias("n")), f"classes-{step}")
    copied = shared.join(classes.where("n > 1").select("nb", "hull", "least"), ["nb", "hull"]).where(~place.eqNullSafe(F.col("least")))
    copies = scratch.put(copied.select("d", "p", "low", "high"), f"copies-{step}")
    scratch.drop(f"shared-{step}")
    mixed = classes.groupBy("nb").agg(F.count("*").alias("k")).where("k > 1").select("nb")
    undecided = classes.join(mixed, "nb").select(F.col("nb").alias("b"), "s", F.col("least.d").alias("d"), F.col("least.p").alias("p"))
    return copies, scratch.put(undecided, f"undecided-{step}")


def _pointers(start: Column, width: int, part: int, q: int) -> list[Column]:
    """Identifiers of the q-gram buckets that take the settled bytes from starts ``start`` .. + width - 1 to .. + part - 1.

    All strings that begin ``o`` bytes before the anchor, o in start .. start + width - 1, share the bytes from
    -start to q + reach - width - start beside the anchor. Halving the width adds half of it to the left (the upper
    half of the starts) or to the right of them; a q-gram is long enough to bridge that.
    """
    found, half = [], width // 2
    while half >= part:
        upper = F.col("s") % (2 * half) >= half  # in the upper half of its interval of starts
        base = F.col("s") - F.col("s") % half
        found.append(F.xxhash64(F.lit(half), F.substring("ctx", F.col("off") + F.when(upper, -base).otherwise(start - base - (half - 1)) + 1, F.lit(q))))
        half //= 2
    return found


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """(d, spans): for documents with copies, array<struct<from, to>> of byte places that cover what is removed."""
    anchorer = Anchorer(length)
    reach, q = anchorer.reach, anchorer.q
    scratch = Scratch(docs.sparkSession)
    named = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"))
    low, high = (F.floor(F.col("p") / reach) % reach).cast("int"), (F.col("p") % reach).cast("int")
    entries = scratch.put(_entries(named, length), "entries").withColumn("low", low).withColumn("high", high)
    copies = [scratch.put(entries.where("copy").select("d", "p", "low", "high"), "copies-batch")]

    own = entries.where("not copy").withColumn("s", F.lit(0))
    copied, undecided = _refined(own, ["core"], scratch, 0, ["entries"])
    copies.append(copied)
    contexts = scratch.put(_contexts(named, undecided, length), "contexts").select(F.col("d").alias("cd"), F.col("p").alias("cp"), "off", "ctx")
    width, step = reach, 0
    while width > 1:
        part, step = max(1, width // PARTS), step + 1
        live = undecided.join(contexts, F.col("d").eqNullSafe(F.col("cd")) & (F.col("p") == F.col("cp"))).withColumn("low", low).withColumn("high", high)
        split = live.withColumn("s", F.explode(F.sequence(F.col("s"), F.col("s") + F.lit(width - part), F.lit(part)))).where(f"s <= high and s + {part - 1} >= low")
        split = split.withColumn("low", F.greatest("low", "s")).withColumn("high", F.least("high", F.col("s") + (part - 1)))
        pointers = _pointers(F.lit(length - q), width, part, q)
        hull = F.xxhash64("low", "high", F.substring("ctx", F.col("off") - F.col("high") + 1, F.col("high") - F.col("low") + length))
        keyed = split.select("b", "s", *[x.alias(f"pointer{i}") for i, x in enumerate(pointers)], hull.alias("hull"), "d", "p", "low", "high")
        copied, undecided = _refined(keyed, ["b", "s", *[f"pointer{i}" for i in range(len(pointers))]], scratch, step, [f"undecided-{step - 1}"])
        copies.append(copied)
        width = part
    every = copies[0]
    for more in copies[1:]:
        every = every.unionByName(more)
    at = F.floor(F.col("p") / (reach * reach))
    span = F.struct((at - F.col("high")).cast("int").alias("from"), (at - F.col("low") + length).cast("int").alias("to"))
    return every.groupBy("d").agg(F.collect_set(span).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs: overlapping and touching spans are joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept): spans are the maximal removed runs, kept the remaining bytes."""
    named = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"))
    spans = repeated_spans(docs, id_col=id_col, text_col=text_col, length=length).withColumnRenamed("d", "sd")
    kind = named.schema["d"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, runs, kept = [], [], [], []
            for text, found in zip(b.column(1), b.column(2), strict=True):
                data = _bytes(text.as_py())
                out = merged([(x["from"], x["to"]) for x in found.as_py() or ()])
                pieces, at = [], 0
                for x, y in out:
                    pieces.append(data[at:x])
                    at = y
                pieces.append(data[at:])
                kept.append(b"".join(pieces))
                n.append(len(data))
                removed.append(len(data) - len(kept[-1]))
                runs.append([{"from": x, "to": y} for x, y in out])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, span_type), pa.array(kept, pa.binary())], ["d", "n_bytes", "n_removed", "spans", "kept"]
            )

    joined = named.join(spans, F.col("d").eqNullSafe(F.col("sd")), "left").select("d", "t", "spans")
    out = joined.mapInArrow(run, f"d {kind}, n_bytes long, n_removed long, spans array<struct<from:int,to:int>>, kept binary")
    return out.withColumnRenamed("d", id_col)
