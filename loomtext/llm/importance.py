"""Target-distribution importance resampling on hashed word n-grams.

Every run of 1 to ``ngrams`` consecutive words, joined by one space, is a feature; its bucket is the crc32 of its bytes
modulo ``buckets``. Each text is scanned once: a ring keeps the running checksum of the runs that began at the last
``ngrams`` words, and a new word extends each of them by a space and the word, so that no run is ever put together.
Buckets are counted over all documents and all target texts; a task sends one row for each bucket that it met. The log
ratio of both counts is the gain of a bucket, a document's weight is the floored mean of its features' gains, and the
weight plus Gumbel noise from a hash of the id is its score. The highest scores of all documents with enough words are
a draw without replacement; they are numbered by a sort over all tasks.

Defined results: null texts and texts without words have no feature and weight 0; a null id is hashed as the text
"null"; rows that share an id have the same noise, and rows that tie in all of score and id are ranked in any order,
one after the other; the table of gains has ``buckets`` rows and is the only thing broadcast; empty tables give an
empty table, and an empty target gives gains by the documents' counts alone; columns pass through, those of the names of
the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import Scratch, fresh

#: Bytes of words: digits, a-z after lower-casing A-Z, and all of characters beyond ASCII.
_AS_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
#: Features that are held before they are counted.
HELD = 1 << 18
RESULTS = ("n_words", "n_features", "weight", "score", "rank")


class Ring:
    """Checksums of all runs of 1 to ``n`` words, by the running state of the runs that began at the last ``n`` words."""

    def __init__(self, n: int):
        self.n = n

    def scan(self, text: str | None, take) -> tuple[int, int]:
        """Hands lists of checksums to ``take`` and returns the numbers of words and of features."""
        n, states, held, words, features = self.n, [0] * self.n, [], 0, 0
        for found in _WORD.finditer((text or "").encode().translate(_AS_WORDS)):
            word = found.group()
            if n > 1 and words:
                longer = b" " + word
                for start in range(max(words - n + 1, 0), words):
                    state = states[start % n] = crc32(longer, states[start % n])
                    held.append(state)
            state = states[words % n] = crc32(word)
            held.append(state)
            words += 1
            if len(held) >= HELD:
                take(held)
                features += len(held)
                held = []
        if held:
            take(held)
        return words, features + len(held)


def bucket_counts(texts: DataFrame, *, text_col: str = "text", ngrams: int = 2, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): the features of all texts; one row for each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring, counts = Ring(ngrams), np.zeros(buckets, "int64")

        def take(sums: list[int]) -> None:
            counts[:] += np.bincount(np.array(sums, "uint32") % buckets, minlength=buckets)

        for b in batches:
            for text in b.column(0):
                ring.scan(text.as_py(), take)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(counts[met])], ["bucket", "n"])

    per_task = texts.select(F.col(text_col).alias("t")).mapInArrow(run, "bucket int, n long")
    return per_task.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, *, buckets: int = 10_000) -> DataFrame:
    """(bucket, gain) of every bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))."""
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    s = source.select("bucket", F.col("n").alias("s"))
    t = target.select("bucket", F.col("n").alias("t"))
    both = every.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"])
    totals = both.agg(F.sum("s").alias("s_all"), F.sum("t").alias("t_all"))  # one row
    d = lambda c: F.col(c).cast("double")
    ratio = ((d("t") + 1) * (d("s_all") + buckets)) / ((d("s") + 1) * (d("t_all") + buckets))
    return both.join(F.broadcast(totals)).select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def weigh(docs: DataFrame, gain: list[int], *, text_col: str = "text", ngrams: int = 2, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) and the numbers of words and features, and the floored mean of the features' gains."""
    shipped = docs.sparkSession.sparkContext.broadcast(np.array(gain, "int64"))  # one number for each bucket
    names = RESULTS[:3]
    rest = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    read = fresh([*docs.columns, *names], "_read")
    named = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text_col}`").alias(read))
    schema = StructType([*named.drop(read).schema.fields, *[StructField(n, LongType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring, table = Ring(ngrams), shipped.value
        sums: list[int] = []

        def take(crcs: list[int]) -> None:
            sums.append(int(table[np.array(crcs, "uint32") % len(table)].sum()))

        for b in batches:
            out: list[tuple[int, int, int]] = []
            for text in b.column(len(rest)):
                sums.clear()
                words, features = ring.scan(text.as_py(), take)
                out.append((words, features, sum(sums) // features if features else 0))
            made = [pa.array([row[i] for row in out], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *made], [*rest, *names])

    return named.mapInArrow(run, schema)


def noise(id_: Column, seed: str) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))), h the first 32 bits of sha256("seed:id")."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    ngrams: int = 2,
    buckets: int = 10_000,
    percent: int = 10,
    min_words: int = 20,
    seed: str = "2024",
    keep: list[str] | None = None,
) -> DataFrame:
    """The documents (columns ``keep``, else all) with n_words, n_features, weight, score and rank (null: not drawn)."""
    scratch = Scratch(docs.sparkSession)
    counted = [
        scratch.put(bucket_counts(texts, text_col=col, ngrams=ngrams, buckets=buckets), name)
        for texts, col, name in ((docs, text_col, "source"), (target, target_text_col, "target"))
    ]
    table = gains(*counted, buckets=buckets)
    gain = [r["gain"] for r in table.orderBy("bucket").collect()]
    columns = [c for c in (docs.columns if keep is None else keep) if c.lower() not in RESULTS]
    weighed = weigh(docs, gain, text_col=text_col, ngrams=ngrams, keep=list(dict.fromkeys([*columns, id_col])))
    scored = scratch.put(weighed.withColumn("score", F.col("weight") + noise(F.col(id_col), seed)), "scored")
    return _ranked(scored, scratch, id_col, min_words, percent).select(*columns, *RESULTS)


def _ranked(scored: DataFrame, scratch: Scratch, id_col: str, min_words: int, percent: int) -> DataFrame:
    """Ranks by ranges of the sorted scores: place in the range plus the sizes of the ranges before."""
    part, place = fresh(scored.columns, "_part"), fresh(scored.columns, "_place")
    enough = F.col("n_words") >= min_words
    order = [F.desc("score"), F.asc_nulls_last(id_col)]
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranged = scored.where(enough).orderBy(*order).select("*", F.spark_partition_id().alias(part), within.alias(place))
    dealt = scratch.put(ranged, "ranged")
    sizes = dealt.groupBy(part).agg(F.count("*").alias("_n"))  # one row for each range
    before = (F.sum("_n").over(Window.orderBy(part)) - F.col("_n")).alias("_before")
    starts = sizes.select(F.col(part).alias("_p"), before, F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_all"))
    rank = F.col("_before") + F.col(place) + 1
    drawn = dealt.join(F.broadcast(starts), F.col(part) == F.col("_p"))
    drawn = drawn.withColumn("rank", F.when(rank * 100 <= F.col("_all") * percent, rank)).drop(part, place, "_p", "_before", "_all")
    return drawn.unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))
