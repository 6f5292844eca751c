"""Chunkers and deterministic splits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomtext.functions.udf import arrow_udf


def _pieces(text: Column, starts: Column, size: int) -> Column:
    return F.transform(starts, lambda s: F.struct(s.cast("int").alias("start"), F.substring(text, s + 1, F.lit(size)).alias("text")))


def chunks_every(text: Column, size: int = 8192, overlap: int = 400) -> Column:
    """array<struct<start, text>>: a chunk at every ``size - overlap`` characters, stripped, blank ones dropped."""
    n, step = F.length(text), size - overlap
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    stripped = F.transform(_pieces(text, starts, size), lambda c: F.struct(c["start"].alias("start"), F.trim(c["text"]).alias("text")))
    return F.filter(stripped, lambda c: c["text"] != "")


def chunks_until_end(text: Column, size: int = 1000, overlap: int = 100) -> Column:
    """array<struct<start, text>>: chunks until one reaches the end; a text within ``size`` is one chunk, even if empty."""
    n, step = F.length(text), size - overlap
    count = F.greatest(F.lit(1), F.ceil((n - overlap) / float(step))).cast("int")
    return _pieces(text, F.transform(F.sequence(F.lit(0), count - 1), lambda i: i * step), size)


def word_chunks(text: Column, size: int = 1000, overlap: int = 150) -> Column:
    """array<struct<start, text>>: the whole text if it fits, else windows of size/5 words that overlap by overlap/5;
    ``start`` counts words."""
    width, step = size // 5, size // 5 - overlap // 5
    ws = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    count = F.greatest(F.lit(1), F.ceil((F.size(ws) - overlap // 5) / float(step))).cast("int")
    windows = F.transform(
        F.transform(F.sequence(F.lit(0), count - 1), lambda i: i * step),
        lambda s: F.struct(s.cast("int").alias("start"), F.array_join(F.slice(ws, s + 1, F.lit(width)), " ").alias("text")),
    )
    return F.when(F.length(text) <= size, F.array(F.struct(F.lit(0).alias("start"), text.alias("text")))).otherwise(windows)


@arrow_udf("array<string>")
def wrapped_chunks(texts: pd.Series) -> pd.Series:
    """Lines of up to 4,000 characters, broken at white space only."""
    import textwrap

    return texts.map(lambda t: textwrap.wrap(t or "", 4000, break_long_words=False, replace_whitespace=False))


SECTION_BODY = r"(?s)(?:^|\n)((?:Section|SECTION)\s+\d+(?:\.\d+)*.*?)(?=\n(?:Section|SECTION)\s+\d|\z)"
NUMBERED_BODY = r"(?s)(?:^|\n)(\d+\.\s+.*?)(?=\n\d+\.\s|\z)"
HEADED_BODY = r"(?s)(?:^|\n)([A-Z][A-Z ]{4,}\n.*?)(?=\n[A-Z][A-Z ]{4,}\n|\z)"


def sections(text: Column) -> Column:
    """array<struct<title, text>>: the first of three section forms with more than two matches; else paragraphs if
    more than three; else the whole document. Blank paragraphs keep their number and are left out."""
    out = None
    for pattern in (SECTION_BODY, NUMBERED_BODY, HEADED_BODY):
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        named = F.transform(found, lambda x, i: F.struct(F.concat(F.lit("Section "), (i + 1).cast("string")).alias("title"), x.alias("text")))
        out = F.when(F.size(found) > 2, named) if out is None else out.when(F.size(found) > 2, named)
    paragraphs = F.split(text, "\n\n")
    numbered = F.filter(
        F.transform(paragraphs, lambda x, i: F.struct(F.concat(F.lit("Paragraph "), (i + 1).cast("string")).alias("title"), x.alias("text"))),
        lambda p: F.trim(p["text"]) != "",
    )
    whole = F.array(F.struct(F.lit("Full Document").alias("title"), text.alias("text")))
    return out.when(F.size(paragraphs) > 3, numbered).otherwise(whole)


def route_chunks(docs: DataFrame, *, size: int = 1000, overlap: int = 150) -> DataFrame:
    """doc_id, content in; chunks by section in word windows, or by characters where there is one section only."""
    split = docs.select("doc_id", "content", sections(F.col("content")).alias("s"))
    many = split.where(F.size("s") > 1).select("doc_id", F.posexplode("s").alias("i", "sec"))
    by_section = many.select("doc_id", "i", F.col("sec")["title"].alias("section"), F.posexplode(word_chunks(F.col("sec")["text"], size, overlap)).alias("j", "c"))
    one = split.where(F.size("s") <= 1).select("doc_id", F.posexplode(chunks_until_end(F.col("content"), size, overlap)).alias("j", "c"))
    name = lambda *p: F.concat(F.col("doc_id").cast("string"), *p)
    left = by_section.select(name(F.lit("_s"), F.col("i").cast("string"), F.lit("_c"), F.col("j").cast("string")).alias("chunk_id"), "doc_id", "section", F.col("c")["start"].alias("start"), F.col("c")["text"].alias("text"))
    right = one.select(name(F.lit("_c"), F.col("j").cast("string")).alias("chunk_id"), "doc_id", F.lit(None).cast("string").alias("section"), F.col("c")["start"].alias("start"), F.col("c")["text"].alias("text"))
    return left.unionByName(right)


def hash_split(df: DataFrame, key: str, *, by: list[str] | None = None, test_share: float = 0.1, seed: int = 42) -> DataFrame:
    """Adds ``split`` of exact size: the ceil(share * n) rows of each group that come first by a seeded hash are ``test``.

    Rows are counted by the first 16 bits of the hash; only those of the one range that holds the cut are sorted.
    """
    groups = by or []
    hashed = df.withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)).withColumn("_b", F.substring("_h", 1, 4))
    counts = hashed.groupBy(*groups, "_b").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(W.partitionBy(*groups).orderBy("_b").rowsBetween(W.unboundedPreceding, 0))
    wanted = F.ceil(F.sum("c").over(W.partitionBy(*groups)) * test_share)
    return _cut(hashed, counts.select(*groups, F.col("_b").alias("_cut"), "c", upto.alias("upto"), wanted.alias("wanted")), groups, F.col("_b"), ["_h", key], ("test", "train")).drop("_h", "_b")


def ordered_split(df: DataFrame, key: str, *, by: list[str] | None = None, train_share: float = 0.8, ranges: int = 1000) -> DataFrame:
    """Adds ``split``: the first int(share * n) rows of each group in order of ``key``, a number or a time, are ``train``.

    Rows are counted by range of the key between approximate quantiles; only those of the range that holds the cut are sorted.
    """
    groups = by or []
    bounds = df.groupBy(*groups).agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 10 * ranges).alias("_q"))
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    bounds = bounds.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], "_q")
    # the number of quantiles below the key, by binary search
    middle = lambda s: F.floor((s["a"] + s["z"]) / 2).cast("int")
    state = lambda a, z: F.struct(a.alias("a"), z.alias("z"))
    halved = lambda s, _: F.when(s["a"] >= s["z"], s).when(F.get("_q", middle(s)) < F.col(key), state(middle(s) + 1, s["z"])).otherwise(state(s["a"], middle(s)))
    below = F.aggregate(F.sequence(F.lit(1), F.lit(ranges.bit_length())), state(F.lit(0), F.size("_q")), halved)["a"]
    placed = df.join(bounds, same, "left").withColumn("_b", below).drop("_q", *[f"_g{i}" for i in range(len(groups))])
    counts = placed.groupBy(*groups, "_b").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(W.partitionBy(*groups).orderBy("_b").rowsBetween(W.unboundedPreceding, 0))
    wanted = F.floor(F.sum("c").over(W.partitionBy(*groups)) * train_share)
    return _cut(placed, counts.select(*groups, F.col("_b").alias("_cut"), "c", upto.alias("upto"), wanted.alias("wanted")), groups, F.col("_b"), [key], ("train", "validation")).drop("_b")


def _cut(df: DataFrame, counts: DataFrame, groups: list[str], bucket: Column, order: list[str], labels: tuple[str, str]) -> DataFrame:
    """Adds ``split``: the first label for the first ``wanted`` rows of a group. counts: one row for each group and bucket."""
    edge = counts.where("wanted > upto - c and wanted <= upto").select(*[F.col(g).alias(f"_e{i}") for i, g in enumerate(groups)], "_cut", (F.col("wanted") - F.col("upto") + F.col("c")).alias("_rest"))
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_e{i}"))
    marked = df.join(edge, same, "left")
    first, second = (F.lit(x) for x in labels)
    at_edge = bucket.eqNullSafe(F.col("_cut"))
    clear = marked.where(~at_edge).withColumn("split", F.when(bucket < F.col("_cut"), first).otherwise(second))
    ranked = marked.where(at_edge).withColumn("_n", F.row_number().over(W.partitionBy(*groups).orderBy(*order)))
    tied = ranked.withColumn("split", F.when(F.col("_n") <= F.col("_rest"), first).otherwise(second)).drop("_n")
    return clear.unionByName(tied).select(*df.columns, "split")


def shuffled(df: DataFrame, key: str, *, seed: int = 0) -> DataFrame:
    """A repeatable shuffle."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)
