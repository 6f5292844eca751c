"""Quality classifier: Bradley-Terry pairwise ranking, then a threshold at a score quantile.

Every pair of a good and a bad labelled document is a preference; the score is linear in text features and is learned by
logistic loss on feature differences, over all pairs. In a Newton step the rows meet the other class by score: they are
summed up by class and score bin, and the bins, each at its mean score, meet each other on the driver. So a step is one
pass over the labelled rows and gives the driver a table of fixed size. The threshold is the quantile of all training
scores at the share of bad labels, so that as many are rejected as the labels reject; the published score is the logistic
of the distance to it. Features and scoring are SQL expressions.

Defined results: null text counts as empty; an empty text gets the score of all-zero counts; rows without a
label are scored and not learned from; null labels are ignored; a document with several labels counts once
for each; if either class is missing the score is 0.5 everywhere; repeated rows score alike; an empty table
gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Scratch, let, words
from .quality_rules import ODD_MARKS

FEATURES = (
    "log_words", "word_length", "upper_share", "mark_share", "bang_share", "bar_share", "stop_share",
    "digit_share", "distinct_share", "log_distinct_share", "line_dup_share", "neighbour_share", "short_text",
)


def features(text: Column) -> Column:
    """An array of doubles, one for each name in ``FEATURES``."""

    def share(t: Column, chars: str, solid: Column) -> Column:
        return F.regexp_count(t, F.lit(chars)) / solid

    def build(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")

        def from_words(w: Column) -> Column:
            chars = F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x))
            return let(F.greatest(chars, F.lit(1)).cast("double"), lambda solid: from_counts(w, solid))

        def from_counts(w: Column, solid: Column) -> Column:
            n = F.greatest(F.size(w), F.lit(1)).cast("double")
            same = F.size(F.filter(F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda a, b: a == b), lambda x: x)) / n
            line_dup = let(lines, lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))) / F.greatest(F.size(ls), F.lit(1)))

            def values(d: Column) -> Column:
                found = (
                    F.log1p(F.size(w).cast("double")), solid / n, share(t, "[A-Z]", solid), share(t, ODD_MARKS, solid),
                    share(t, "!", solid), share(t, "[|]", solid), share(t, "[.,;:]", solid), share(t, "[0-9]", solid),
                    d, F.log(d + 0.01), line_dup, same, (F.size(w) < 20).cast("double"),
                )
                return F.array(*[v.cast("double") for v in found])

            return let(F.size(F.array_distinct(w)) / n, values)

        return let(words(t), from_words)

    return let(F.coalesce(text, F.lit("")), build)


@dataclass(frozen=True)
class Ranker:
    mean: list[float]
    scale: list[float]
    weights: list[float]
    threshold: float

    def distance(self, feats: Column) -> Column:
        """How far the weighted features are above the threshold."""
        z = F.lit(-self.threshold)
        return let(
            feats,
            lambda f: sum(
                ((F.get(f, i) - m) * (w / s) for i, (m, s, w) in enumerate(zip(self.mean, self.scale, self.weights, strict=True))),
                z,
            ),
        )

    def score(self, feats: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-self.distance(feats)))


def fit_pairs(x: np.ndarray, y: np.ndarray, *, bad_share: float, n_pairs: int = 40_000, ridge: float = 1e-3, seed: int = 7) -> Ranker:
    """Newton steps on the mean logistic loss of ``n_pairs`` seeded preference pairs, for rows in memory; ``fit`` takes all pairs."""
    d = len(FEATURES)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranker([0.0] * d, [1.0] * d, [0.0] * d, 0.0)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    diff = z[rng.choice(good, n_pairs)] - z[rng.choice(bad, n_pairs)]
    w = np.zeros(d)
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(diff @ w, -30, 30)))
        grad = diff.T @ (1.0 - p) / n_pairs - ridge * w
        hess = (diff * (p * (1.0 - p))[:, None]).T @ diff / n_pairs + ridge * np.eye(d)
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    s = z @ w
    # classes were sampled apart: weigh them back to their shares before taking the quantile
    weight = np.where(y == 0, bad_share / len(bad), (1.0 - bad_share) / len(good))
    order = np.argsort(s, kind="stable")
    k = int(np.searchsorted(np.cumsum(weight[order]), bad_share))
    k = min(max(k, 1), len(s) - 1)
    threshold = float((s[order][k - 1] + s[order][k]) / 2)
    return Ranker(mean.tolist(), scale.tolist(), w.tolist(), threshold)


#: Score bins of a class in a Newton step, over six standard deviations to each side; what lies beyond is in the last ones.
BINS = 1024


def _sums(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, spread: float) -> tuple[np.ndarray, np.ndarray]:
    """By bin of the score, bad ones first: (numbers of the bins, sums of 1, score, features and products of two features)."""
    upper = np.triu_indices(len(w))
    width = max(12.0 * spread / BINS, 1e-12)
    out = 2 + len(w) + len(upper[0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2 * BINS, out))
        for b in batches:
            if not len(b):
                continue
            z = (np.stack(b["f"].to_numpy()) - mean) / scale
            s = z @ w
            at = b["y"].to_numpy() * BINS + np.clip(np.floor(s / width) + BINS // 2, 0, BINS - 1).astype(int)
            values = np.column_stack([np.ones(len(z)), s, z, z[:, upper[0]] * z[:, upper[1]]])
            for i in range(out):
                total[:, i] += np.bincount(at, values[:, i], 2 * BINS)
        used = np.flatnonzero(total[:, 0])
        yield pd.DataFrame({"bin": used, "sums": list(total[used])})

    parts = rows.mapInPandas(run, "bin int, sums array<double>")
    found = parts.groupBy("bin").agg(F.array(*[F.sum(F.get("sums", i)) for i in range(out)]).alias("sums")).collect()
    found.sort(key=lambda r: r["bin"])
    return np.array([r["bin"] for r in found]), np.array([r["sums"] for r in found])


def _newton(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, *, ridge: float, steps: int = 20) -> np.ndarray:
    """Weights with the least mean logistic loss over all pairs of a good and a bad row."""
    d = len(mean)
    upper = np.triu_indices(d)
    w, cov = np.zeros(d), np.eye(d)
    for _ in range(steps):
        bins, sums = _sums(rows, mean, scale, w, float(np.sqrt(max(w @ cov @ w, 0.0))))
        square = np.zeros((len(sums), d, d))
        square[:, upper[0], upper[1]] = square[:, upper[1], upper[0]] = sums[:, 2 + d :]
        n, s, x = sums[:, 0], sums[:, 1] / sums[:, 0], sums[:, 2 : 2 + d]
        cov = square.sum(0) / n.sum()
        good, bad = bins >= BINS, bins < BINS
        pairs = n[good].sum() * n[bad].sum()
        wrong = 1.0 / (1.0 + np.exp(np.clip(s[good][:, None] - s[bad][None, :], -30, 30)))
        grad = (x[good].T @ (wrong @ n[bad]) - x[bad].T @ (n[good] @ wrong)) / pairs - ridge * w
        bend = wrong * (1.0 - wrong)
        cross = x[good].T @ bend @ x[bad]
        own = np.tensordot(bend @ n[bad], square[good], 1) + np.tensordot(n[good] @ bend, square[bad], 1)
        step = np.linalg.solve((own - cross - cross.T) / pairs + ridge * np.eye(d), grad)
        w = w + step
        if np.abs(step).max() < 1e-4 * max(1.0, np.abs(w).max()):
            break
    return w


def value_at(scores: DataFrame, place: int, *, few: int = 10_000) -> float:
    """The ``place``-th smallest (from 1) of the column ``s``: counts of bins narrow it down to ``few`` rows or to one value."""
    s = F.col("s")
    ends = [F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")]
    n, lo, hi = scores.agg(*ends).first()
    while lo < hi and n > few:
        number = F.floor((s - lo) / (hi - lo) * 1024)
        for r in sorted(scores.groupBy(number.alias("b")).agg(*ends).collect()):
            if place <= r["n"]:
                break
            place -= r["n"]
        n, lo, hi = r["n"], r["lo"], r["hi"]
        scores = scores.where(s.between(lo, hi))
    return lo if lo == hi else sorted(r["s"] for r in scores.select("s").collect())[place - 1]


def featured(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features)."""
    return docs.select(id_col, features(F.col(text_col)).alias("features"))


def fit(seen: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", ridge: float = 1e-3) -> Ranker:
    """Fit on every labelled row of ``seen`` (id, features)."""
    d = len(FEATURES)
    scratch = Scratch(seen.sparkSession)
    marked = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y"))
    rows = scratch.put(seen.select(F.col(id_col).alias("_id"), F.col("features").alias("f")).join(marked, "_id").select("y", "f"), "training")
    each = [F.get("f", i) for i in range(d)]
    facts = rows.agg(F.count("*"), F.count_if(F.col("y") == 0), *[F.avg(x) for x in each], *[F.stddev_pop(x) for x in each]).first()
    total, n_bad = facts[:2]
    if n_bad in (0, total):
        return Ranker([0.0] * d, [1.0] * d, [0.0] * d, 0.0)
    mean, scale = np.array(facts[2 : 2 + d]), np.array(facts[2 + d :])
    scale[scale < 1e-9] = 1.0
    w = _newton(rows, mean, scale, ridge=ridge)
    plain = Ranker(mean.tolist(), scale.tolist(), w.tolist(), 0.0)
    scores = scratch.put(rows.select(plain.distance(F.col("f")).alias("s")), "scores")
    threshold = (value_at(scores, n_bad) + value_at(scores, n_bad + 1)) / 2
    return Ranker(plain.mean, plain.scale, plain.weights, threshold)


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", ridge: float = 1e-3) -> Ranker:
    """Fit on every labelled row."""
    return fit(featured(docs, id_col=id_col, text_col=text_col), labels, id_col=id_col, label_col=label_col, ridge=ridge)


def score(docs: DataFrame, ranker: Ranker, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score in (0, 1) and predicted (1 if score >= 0.5)."""
    scored = docs.select(F.col(id_col), ranker.score(features(F.col(text_col))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
