"""URL filters (native): rules first, then logistic regression on hashed character n-grams.

Host and path are cut from the URL; the longest fitting rule decides. A URL without a rule goes to a
logistic regression on hashed character n-grams of host and path. Its small labelled URL table is a
bounded sample of URLs that a rule decides: of each class at most half of ``max_training_urls``, the first by a
hash of the URL, so that a rare class is learned as well as a frequent one. Training is
full-batch gradient descent inside one SQL expression over that bounded table; the weights (``buckets``
numbers) reach the scoring projection as a scalar subquery, so no join and no Python touch the URLs.

Defined results: a null URL, or one without ``://``, has empty host and path, no rule, and is scored on
the bias alone; ties between rules of equal length cannot occur as rules are distinct texts; repeated rows
count once in training and are judged alike; with no labelled URL the model is all zero and the verdict is
allow; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, ascii_lower, let

Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null."""
    cases = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        cases = F.when(fits, value) if cases is None else cases.when(fits, value)
    return cases if cases is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def gram_buckets(host: Column, path: Column, *, n: int, buckets: int) -> Column:
    """Hash buckets of the distinct character n-grams of host and path, each part with its own marks."""

    def part(text: Column, mark: str) -> Column:
        marked = F.concat(F.lit("^"), text, F.lit("$"))
        return let(
            marked,
            lambda t: F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(t) - (n - 1), F.lit(1))),
                lambda i: F.pmod(F.xxhash64(F.lit(mark), F.substring(t, i, F.lit(n))), F.lit(buckets)).cast("int"),
            ),
        )

    return F.array_distinct(F.concat(part(host, "h"), part(path, "p")))


def _sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit(
    labelled: DataFrame,
    *,
    n: int = 3,
    buckets: int = 2048,
    max_training_urls: int = 1000,
    epochs: int = 60,
    rate: float = 4.0,
    ridge: float = 1e-4,
) -> DataFrame:
    """One row, one column ``model``: struct(w array<double>, b double).

    ``labelled`` has host, path and blocked (0/1); ``max_training_urls`` bounds what is used, half of it for each
    class. Each example is scaled to unit length and both classes weigh the same. Posting lists (bucket -> examples) make an epoch
    linear in the number of grams.
    """
    scratch = Scratch(labelled.sparkSession)
    grams = gram_buckets(F.col("host"), F.col("path"), n=n, buckets=buckets)
    order = [F.xxhash64("host", "path"), "host", "path"]
    known = labelled.distinct()
    allowed, blocked = (known.where(F.col("blocked") == v).orderBy(*order).limit(max_training_urls // 2) for v in (0, 1))
    sample = allowed.unionByName(blocked).select("host", "path", grams.alias("g"), F.col("blocked").cast("double").alias("y"))
    # at most max_training_urls rows from here on
    numbered = scratch.put(
        sample.coalesce(1).select(
            (F.row_number().over(W.orderBy("host", "path", "y")) - 1).alias("e"),
            "g", "y",
            (0.5 / F.count("*").over(W.partitionBy("y"))).alias("wt"),
            (1.0 / F.sqrt(F.size("g").cast("double"))).alias("v"),
        ), "training_urls",
    )
    lists = numbered.select("e", F.explode("g").alias("b")).groupBy("b").agg(F.sort_array(F.collect_list("e")).alias("es"))
    every = labelled.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b")).join(lists, "b", "left")
    none = F.array().cast("array<int>")
    posted = every.agg(
        F.transform(F.sort_array(F.collect_list(F.struct("b", F.coalesce("es", none).alias("es")))), lambda x: x["es"]).alias("p")
    )
    rows = numbered.agg(F.sort_array(F.collect_list(F.struct("e", "g", "y", "wt", "v"))).alias("rows"))
    start = F.struct(F.array_repeat(F.lit(0.0), buckets).alias("w"), F.lit(0.0).alias("b"))

    def epoch(rs: Column, ps: Column, m: Column) -> Column:
        residual = F.transform(
            rs,
            lambda r: (r["y"] - _sigmoid(m["b"] + r["v"] * F.aggregate(r["g"], F.lit(0.0), lambda a, g: a + F.get(m["w"], g)))) * r["wt"],
        )
        return let(
            residual,
            lambda e: let(
                F.zip_with(e, rs, lambda x, r: x * r["v"]),
                lambda ev: F.struct(
                    F.zip_with(
                        m["w"], ps,
                        lambda w, es: w * (1.0 - rate * ridge) + F.lit(rate) * F.aggregate(es, F.lit(0.0), lambda a, i: a + F.get(ev, i)),
                    ).alias("w"),
                    (m["b"] + F.lit(rate) * F.aggregate(e, F.lit(0.0), lambda a, x: a + x)).alias("b"),
                ),
            ),
        )

    model = let(
        F.col("ps"),
        lambda ps: let(
            F.col("rows"), lambda rs: F.aggregate(F.sequence(F.lit(1), F.lit(epochs)), start, lambda m, t: epoch(rs, ps, m))
        ),
    )
    both = rows.select("rows", posted.scalar().alias("ps"))
    return scratch.put(both.select(model.alias("model")), "model")


def blocked_score(host: Column, path: Column, model: Column, *, n: int = 3, buckets: int = 2048) -> Column:
    """Probability that a URL belongs with the blocked ones; ``n`` and ``buckets`` as in ``fit``."""
    grams = gram_buckets(host, path, n=n, buckets=buckets)
    return let(
        model,
        lambda m: let(
            grams,
            lambda g: _sigmoid(
                m["b"] + F.aggregate(g, F.lit(0.0), lambda a, i: a + F.get(m["w"], i)) / F.sqrt(F.size(g).cast("double"))
            ),
        ),
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url", n: int = 3, buckets: int = 2048, **training
) -> DataFrame:
    """id, host, path, rule, score and verdict (allow or block) for every row."""
    parts = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    ruled = parts.withColumn("hit", matched_rule(F.col("host"), F.col("path"), rules))
    labelled = ruled.where("hit is not null").select("host", "path", (F.col("hit")["verdict"] == "block").cast("int").alias("blocked"))
    model = fit(labelled, n=n, buckets=buckets, **training)
    scored = ruled.withColumn("model", model.scalar()).withColumn(
        "score", blocked_score(F.col("host"), F.col("path"), F.col("model"), n=n, buckets=buckets)
    )
    verdict = F.coalesce(F.col("hit")["verdict"], F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return scored.select(id_col, "host", "path", F.col("hit")["rule"].alias("rule"), "score", verdict.alias("verdict"))
