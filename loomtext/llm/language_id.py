"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's likelihood is the sum
over all its segmentations into pieces (forward algorithm); a text's is the product over its words. Piece
probabilities are learned by expectation maximisation (forward-backward expected counts) from a sample of at
most ``max_training_docs`` documents per language, the first by a hash of the id; expected counts are summed over the
sample's words by Spark, and only one number for each piece and language reaches the driver.

The forward pass is vectorised over the distinct words of a batch and shared through a bounded per-task word
table, so memory does not grow with the input; texts are always read whole. Words are runs of letters (Unicode
category L) in lower case, of any length: all pieces of the vocabulary count, and in words of over ``SHORT`` letters the
sums are rescaled as they go, so that no segmentation is lost.

Defined results: null text, or one without a letter, is ``und`` with score 0; ties go to the language first
in order; without any training row everything is ``und``; repeated rows are judged alike; an empty table gives
an empty table; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
WORD_LIKE = re.compile(r"[^\W\d_]+")
#: Letters of a word that double precision takes without rescaling, and words in a task's table.
SHORT, MAX_TABLE = 32, 300_000
FLOOR = 1e-7
_BASE = np.uint64(0x9E3779B97F4A7C15)


def load_pieces(path: str = VOCABULARY) -> list[str]:
    """The distinct letter pieces, lower case, of a ranks file (base64 token, rank)."""
    found = set()
    with open(path, "rb") as lines:
        for line in lines:
            try:
                piece = base64.b64decode(line.split()[0]).decode().strip().lower()
            except (UnicodeDecodeError, IndexError):
                continue
            if piece.isalpha():
                found.add(piece)
    return sorted(found)


def text_words(text: str | None) -> list[str]:
    """Runs of letters in lower case; other characters that count as word characters divide them."""
    out = []
    for w in WORD_LIKE.findall((text or "").lower()):
        if w.isalpha():
            out.append(w)
        else:
            out.extend("".join(c if c.isalpha() else " " for c in w).split())
    return out


class Pieces:
    """Piece numbers of all substrings of many words at once, through a hash of the code points."""

    def __init__(self, pieces: list[str]):
        hashes = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        self.size = len(pieces)
        self.longest = max(map(len, pieces), default=1)

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return (h * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF

    def numbers(self, points: np.ndarray) -> list[np.ndarray]:
        """points: words of one length by code point. For each piece length: numbers by start, ``size`` if none."""
        n = points.shape[1]
        codes = points.astype(np.uint64) + np.uint64(1)
        out, h = [], np.zeros_like(codes)
        for length in range(1, min(self.longest, n) + 1):
            h = h[:, : n - length + 1] * _BASE + codes[:, length - 1 :]
            mixed = (h * np.uint64(0xD6E8FEB86659FD93)).ravel()
            ids = np.full(mixed.shape, self.size, dtype=np.int64)
            maybe = np.flatnonzero(self.seen[(mixed >> np.uint64(44)).astype(np.int64)])
            at = np.searchsorted(self.hashes, mixed[maybe])
            at[at == self.size] = 0
            hit = self.hashes[at] == mixed[maybe]
            ids[maybe[hit]] = self.order[at[hit]]
            out.append(ids.reshape(h.shape))
        return out


def by_length(ws: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in ws, code points) for each word length."""
    lengths = np.fromiter(map(len, ws), dtype=np.int64, count=len(ws))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        joined = "".join(ws[i] for i in at).encode("utf-32-le", "surrogatepass")
        yield at, np.frombuffer(joined, dtype=np.uint32).reshape(len(at), int(n))


def forward(ids: list[np.ndarray], n: int, probs: np.ndarray) -> list[np.ndarray]:
    """alpha[t][word, language]: total probability of all segmentations of the first t letters."""
    words = ids[0].shape[0]
    alpha = [np.ones((words, probs.shape[1]))]
    for t in range(1, n + 1):
        total = alpha[t - 1] * np.maximum(probs[ids[0][:, t - 1]], FLOOR)
        for length in range(2, min(len(ids), t) + 1):
            col = ids[length - 1][:, t - length]
            some = np.flatnonzero(col < probs.shape[0] - 1)
            if len(some):
                total[some] += alpha[t - length][some] * probs[col[some]]
        alpha.append(total)
    return alpha


def log_forward(ids: list[np.ndarray], n: int, probs: np.ndarray) -> np.ndarray:
    """log alpha[t, language] of one word of any length; ``ids`` by start. Sums are rescaled before they underflow."""
    reach, k = len(ids), probs.shape[1]
    out, scale = np.zeros((n + 1, k)), np.zeros(k)
    recent = np.zeros((reach, k))  # alpha[t - 1], alpha[t - 2], ... at the scale so far
    recent[0] = 1.0
    for lo in range(0, n, 4096):
        ends = np.arange(lo + 1, min(lo + 4096, n) + 1)
        steps = np.zeros((len(ends), reach, k))
        for length in range(1, reach + 1):
            fits = np.flatnonzero(ends >= length)
            p = probs[ids[length - 1][ends[fits] - length]]
            steps[fits, length - 1] = np.maximum(p, FLOOR) if length == 1 else p
        for t, step in zip(ends, steps, strict=True):
            value = (recent * step).sum(0)
            small = value < 1e-150
            if small.any():
                by = np.where(small, value, 1.0)
                value, recent, scale = value / by, recent / by, scale + np.log(by)
            recent[1:] = recent[:-1].copy()
            recent[0] = value
            out[t] = np.log(value) + scale
    return out


def log_likelihoods(ws: list[str], pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Natural logarithm of each word's marginal probability, by language."""
    out = np.zeros((len(ws), probs.shape[1]))
    for at, points in by_length(ws):
        n = points.shape[1]
        if n > SHORT:
            for i, row in zip(at, points, strict=True):
                out[i] = log_forward([x[0] for x in pieces.numbers(row[None])], n, probs)[-1]
            continue
        for lo in range(0, len(at), 20_000):
            part = points[lo : lo + 20_000]
            out[at[lo : lo + 20_000]] = np.log(forward(pieces.numbers(part), n, probs)[-1])
    return out


def _long_word_counts(ids: list[np.ndarray], n: int, count: float, probs: np.ndarray, size: int) -> np.ndarray:
    """Expected uses in one long word: forward sums of the word and of its reverse meet at every piece."""
    total = np.zeros(size + 1)
    ahead = log_forward(ids, n, probs)[:, 0]
    behind = log_forward([x[::-1] for x in ids], n, probs)[::-1, 0]
    for length, col in enumerate(ids, 1):
        p = np.maximum(probs[col, 0], FLOOR) if length == 1 else probs[col, 0]
        some = np.flatnonzero(p)
        weight = np.exp(ahead[some] + np.log(p[some]) + behind[some + length] - ahead[n]) * count
        total += np.bincount(col[some], weights=weight, minlength=size + 1)
    return total


def expected_counts(ws: list[str], counts: np.ndarray, pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations; probs has one column."""
    total = np.zeros(pieces.size + 1)
    for at, points in by_length(ws):
        n = points.shape[1]
        if n > SHORT:
            for i, row in zip(at, points, strict=True):
                total += _long_word_counts([x[0] for x in pieces.numbers(row[None])], n, counts[i], probs, pieces.size)
            continue
        ids = pieces.numbers(points)
        alpha = forward(ids, n, probs)
        beta = [np.zeros(0)] * (n + 1)
        beta[n] = np.ones((len(at), 1))
        for t in range(n - 1, -1, -1):
            acc = beta[t + 1] * np.maximum(probs[ids[0][:, t]], FLOOR)
            for length in range(2, min(len(ids), n - t) + 1):
                acc = acc + beta[t + length] * probs[ids[length - 1][:, t]]
            beta[t] = acc
        scale = counts[at] / alpha[n][:, 0]
        for length in range(1, len(ids) + 1):
            for start in range(n - length + 1):
                col = ids[length - 1][:, start]
                p = probs[col, 0] if length > 1 else np.maximum(probs[col, 0], FLOOR)
                total += np.bincount(col, weights=alpha[start][:, 0] * p * beta[start + length][:, 0] * scale, minlength=pieces.size + 1)
    return total


@dataclass(frozen=True)
class Model:
    languages: list[str]
    pieces: list[str]
    probs: np.ndarray  # (len(pieces) + 1, languages); the last row is for substrings that are no piece: zeros


def uniform(languages: list[str], vocabulary: list[str]) -> Model:
    """The model before learning: all pieces are alike."""
    probs = np.full((len(vocabulary) + 1, len(languages)), 1.0 / max(len(vocabulary), 1))
    probs[-1] = 0.0
    return Model(languages, vocabulary, probs)


def maximised(model: Model, uses: np.ndarray, smoothing: float) -> Model:
    """The model whose probabilities are the shares of the expected uses (len(pieces), languages)."""
    shares = uses + smoothing
    probs = np.zeros_like(model.probs)
    probs[:-1] = shares / shares.sum(0)
    return Model(model.languages, model.pieces, probs)


def em(word_counts: dict[str, Counter], vocabulary: list[str], *, rounds: int = 3, smoothing: float = 0.05) -> Model:
    """Piece probabilities per language from counted words, in one process."""
    model, pieces = uniform(sorted(word_counts), vocabulary), Pieces(vocabulary)
    for _ in range(rounds):
        uses = np.zeros((pieces.size, len(model.languages)))
        for k, lang in enumerate(model.languages):
            ws = sorted(word_counts[lang])
            n = np.array([word_counts[lang][w] for w in ws], dtype=float)
            uses[:, k] = expected_counts(ws, n, pieces, model.probs[:, k : k + 1])[:-1]
        model = maximised(model, uses, smoothing)
    return model


def word_table(docs: DataFrame, rates: dict[str, float], *, max_training_docs: int) -> DataFrame:
    """(l, w, n): counted words of the sample. docs: i, l, t; rates: the share of each language's rows to look at."""
    cut = F.create_map(*[x for k, v in sorted(rates.items()) for x in (F.lit(k), F.lit(int(v * 2**31)))])
    near = docs.withColumn("h", F.pmod(F.xxhash64("i"), F.lit(2**31))).where(F.col("h") < F.try_element_at(cut, F.col("l")))
    # the window sees little more than the rows that it keeps
    order = W.partitionBy("l").orderBy("h", "i", F.xxhash64("t"))
    sample = near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= max_training_docs).select("l", "t")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, texts in b.groupby("l")["t"]:
                found: Counter = Counter()
                for text in texts:
                    found.update(text_words(text))
                yield pd.DataFrame({"l": lang, "w": list(found), "n": list(found.values())})

    return sample.mapInPandas(count, "l string, w string, n long").groupBy("l", "w").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_training_docs: int = 600, vocabulary: str = VOCABULARY, rounds: int = 3, smoothing: float = 0.05) -> Model:
    """Learn from the rows of ``docs`` with a language; at most ``max_training_docs`` of each are read."""
    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(lang_col).alias("l"), F.col(text_col).alias("t"))
    counts = {r["l"]: r["n"] for r in known.groupBy("l").agg(F.count("*").alias("n")).collect()}
    model = uniform(sorted(counts), load_pieces(vocabulary))
    if not counts:
        return model
    rates = {k: min(1.0, 1.3 * max_training_docs / n) for k, n in counts.items()}
    words = Scratch(docs.sparkSession).put(word_table(known, rates, max_training_docs=max_training_docs), "words")
    for _ in range(rounds):
        shipped = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary times languages: fixed size

        def expect(batches: Iterator[pd.DataFrame], shipped=shipped) -> Iterator[pd.DataFrame]:
            now = shipped.value
            pieces = Pieces(now.pieces)
            for b in batches:
                for lang, rows in b.groupby("l"):
                    k = now.languages.index(lang)
                    uses = expected_counts(rows["w"].tolist(), rows["n"].to_numpy(dtype=float), pieces, now.probs[:, k : k + 1])[:-1]
                    some = np.flatnonzero(uses)
                    yield pd.DataFrame({"k": k, "piece": some, "uses": uses[some]})

        summed = words.mapInPandas(expect, "k int, piece int, uses double").groupBy("k", "piece").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.zeros((len(model.pieces), len(model.languages)))
        uses[summed["piece"].to_numpy(dtype=int), summed["k"].to_numpy(dtype=int)] = summed["uses"].to_numpy()
        model = maximised(model, uses, smoothing)
        shipped.destroy()
    return model


class Scorer:
    """Scores texts with a bounded table of words already scored."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, Pieces(model.pieces)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.values = np.zeros((0, len(self.model.languages)))

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, k = self.model.languages, len(self.model.languages)
        if len(self.known) > MAX_TABLE:
            self.forget()
        known, new = self.known, []
        doc_ids = []
        for text in texts:
            ids = []
            for w in text_words(text):
                at = known.get(w)
                if at is None:
                    at = known[w] = len(known)
                    new.append(w)
                ids.append(at)
            doc_ids.append(ids)
        if new and k:
            self.values = np.concatenate([self.values, log_likelihoods(new, self.pieces, self.model.probs)])
        names, scores = [], []
        for ids in doc_ids:
            if not ids or not k:
                names.append("und")
                scores.append(0.0)
                continue
            total = self.values[np.array(ids)].sum(0)
            best = int(total.argmax())
            odds = np.exp((total - total[best]) * min(1.0, 20.0 / len(ids)))
            names.append(langs[best])
            scores.append(float(1.0 / odds.sum()))
        return names, scores


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score (posterior per 20 words) for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary times languages: fixed size
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shipped.value)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                names, scores = scorer.score(part.column("t").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("i"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["i", "lang_pred", "score"])

    named = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    return named.mapInArrow(run, f"i {kind}, lang_pred string, score double").withColumnRenamed("i", id_col)
