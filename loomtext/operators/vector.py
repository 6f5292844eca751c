"""Vector search by inner product of unit vectors, with filters, boosts and reranking.

Exact search: the queries go to the tasks in blocks of bounded size, a task scores a batch of vectors against a tile of
queries by one matrix product and keeps the k best of each query, so k rows for each query and task are shuffled. The
product is in single precision and finds all that may count; these are scored again in double precision, term by term
from the first, as SQL does it. Beyond that there is an inverted file: centres are learned from a bounded sample, every
vector is put into its nearest cell, and a query is compared with the cells nearest to it.

Defined results: null and zero vectors, in items and queries, are left out; ties go to the smaller id; items of another
length than the query's, or without a boost, come last, and those that hold a NaN first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType, StructField, StructType

from loomtext.functions.text import bound

#: Queries of one matrix product; vectors that give a query its first bound; pairs that are scored again at once.
TILE, FIRST, PAIRS = 1024, 1024, 500_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """The vector scaled to length 1; a null or zero vector gives null. The length is worked out once, not for each element."""
    return bound(norm(v), lambda n: F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n)))


def directed(df: DataFrame, col: str) -> DataFrame:
    """The rows whose vector has a direction, scaled to length 1."""
    length = df.withColumn("_len", norm(F.col(col))).where("_len > 0")  # not a test of the result, which would be worked out in the filter too
    return length.withColumn(col, F.when(F.col("_len") > 0, F.transform(col, lambda x: x.cast("double") / F.col("_len")))).drop("_len")


def search(items: DataFrame, queries: DataFrame, k: int, *, item: str = "vec_id", query: str = "query_id", vector: str = "embedding", max_queries: int = 10_000, boost: Column | None = None) -> DataFrame:
    """(query, item, score): the k best items for each query; ties by item; more than ``max_queries`` go in blocks of about that size.

    ``boost``, a column over ``items``, adds ``final``, score times boost, and the k best are those by it.
    """
    blocks = -(-queries.count() // max_queries)
    if blocks > 1:
        number = F.pmod(F.xxhash64(query), F.lit(blocks))
        parts = [_search(items, queries.where(number == b), k, item, query, vector, boost) for b in range(blocks)]
        return reduce(DataFrame.unionByName, parts)
    return _search(items, queries, k, item, query, vector, boost)


def _search(items: DataFrame, queries: DataFrame, k: int, item: str, query: str, vector: str, boost: Column | None) -> DataFrame:
    extra = [] if boost is None else [boost.cast("double").alias("_boost")]
    left = directed(items.select(item, F.col(vector).alias("_v"), *extra), "_v")
    names, asked = _asked(queries, query, vector)
    return _best(left, names, asked, k, item, queries.schema[query], {None: np.arange(len(asked))})


def _asked(queries: DataFrame, query: str, vector: str) -> tuple[pa.ChunkedArray, list[np.ndarray]]:
    """Ids and unit vectors of a block of queries."""
    known = directed(queries.select(query, F.col(vector).alias("_q")), "_q").toArrow()
    return known.column(query), [q for chunk in known.column("_q").chunks for q in _rows(chunk)]


def _rows(lists: pa.ListArray) -> list[np.ndarray]:
    values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _best(left: DataFrame, names: pa.ChunkedArray, asked: list[np.ndarray], k: int, item: str, query: StructField, meeting: dict[int | None, np.ndarray]) -> DataFrame:
    """(query, item, score[, final]): the k best rows of ``left`` (item, _v[, _boost][, cell]) for each query; ``meeting`` has
    the queries that meet the vectors of a cell, or of the whole table under None."""
    boosted, celled = "_boost" in left.columns, None not in meeting
    doubles = ["score", "final"] if boosted else ["score"]
    out = StructType([StructField(query.name, query.dataType), StructField(item, left.schema[item].dataType), *[StructField(n, DoubleType()) for n in doubles]])
    shipped = left.sparkSession.sparkContext.broadcast((names.combine_chunks(), asked, meeting))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, asked, meeting = shipped.value
        lengths = np.array([len(q) for q in asked], dtype=int)
        tiles = [Hits(own[i : i + TILE], asked, k) for d in np.unique(lengths) for own in [np.flatnonzero(lengths == d)] for i in range(0, len(own), TILE)]
        places = {cell: [np.flatnonzero(np.isin(t.who, who)) for t in tiles] for cell, who in meeting.items()}
        kind = None
        for b in batches:
            kind = b.schema.field(item).type
            cells = b.column("cell").to_numpy(zero_copy_only=False) if celled else None
            for cell, mine in places.items():
                part = b.filter(pa.array(cells == cell)) if celled else b
                blocks = {} if part.num_rows else None
                for tile, own in zip(tiles, mine, strict=True):
                    if len(own) and blocks is not None:
                        if tile.d not in blocks:
                            blocks[tile.d] = Vectors(part.column(item), part.column("_v"), part.column("_boost") if boosted else None, tile.d, k)
                        tile.meet(own, blocks[tile.d])
        for tile in tiles:
            who, ids, score, final, lack = tile.found()
            if len(who):
                columns = [names.take(pa.array(who)), pa.array(ids if ids.dtype != object else ids.tolist(), kind), pa.array(score, mask=lack == 2), pa.array(final, mask=lack > 0)]
                if not boosted:
                    columns = columns[:3]
                yield pa.RecordBatch.from_arrays(columns, out.names)

    found = left.select(item, "_v", *(["_boost"] if boosted else []), *(["cell"] if celled else [])).mapInArrow(run, out)
    order = W.partitionBy(query.name).orderBy(F.desc(doubles[-1]), item)
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")


def _codes(ids: np.ndarray) -> np.ndarray:
    """Numbers in the order of the ids, nulls first."""
    return ids if ids.dtype != object else pd.factorize(ids, sort=True)[0]


class Vectors:
    """A batch of vectors for queries of length ``d``: ``plain`` ones go through the matrix product, all others are few.

    Of equal vectors of one weight only the k smallest ids can be hits. ``lack`` is 1 where the weight is null, 2 where the
    length is another one.
    """

    def __init__(self, ids: pa.Array, lists: pa.ListArray, weights: pa.Array | None, d: int, k: int):
        whole = pa.types.is_integer(ids.type) and not ids.null_count
        self.ids = ids.to_numpy(zero_copy_only=False).astype(np.int64) if whole else np.array([*ids.to_pylist(), None], dtype=object)[:-1]
        codes, n = _codes(self.ids), len(ids)
        same = pc.list_value_length(lists).to_numpy(zero_copy_only=False) == d
        self.rows = np.zeros((n, d))
        self.rows[same] = (lists if same.all() else lists.filter(pa.array(same))).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        self.weights = None if weights is None else weights.to_numpy(zero_copy_only=False).astype(float)
        self.lack = np.where(same, 0 if weights is None else weights.is_null().to_numpy(zero_copy_only=False).astype(int), 2)
        ordered = np.argsort(codes, kind="stable")
        broken = np.isnan(self.rows).any(1)
        wild = np.zeros(n, dtype=bool) if weights is None else ~broken & ~(np.abs(self.weights) <= 1e30)  # infinite or not a number
        of = lambda which, most: ordered[which[ordered]][:most]
        self.any, self.broken, self.wild, self.last = of(self.lack == 0, k), of(broken & (self.lack == 0), k), of(wild & (self.lack == 0), n), of(self.lack > 0, k)
        plain = of(~broken & ~wild & (self.lack == 0), n)
        if len(plain) > k:
            key = np.ascontiguousarray(self.rows[plain] if weights is None else np.column_stack([self.rows, self.weights])[plain])
            _, group = np.unique(key.view(np.dtype((np.void, key.shape[1] * 8))).ravel(), return_inverse=True)
            by = np.argsort(group, kind="stable")
            place = np.arange(len(by)) - np.searchsorted(group[by], group[by])
            plain = plain[np.sort(by[place < k])]
        self.plain, self.single = plain, self.rows[plain].astype(np.float32)
        self.columns = np.ascontiguousarray(self.rows.T)
        self.factors = None if weights is None else self.weights[plain].astype(np.float32)
        self.most = 1.0 if weights is None else float(np.abs(self.weights[plain]).max(initial=0.0))


class Hits:
    """The k best vectors so far of the queries ``who``, which have one length."""

    def __init__(self, who: np.ndarray, asked: list[np.ndarray], k: int):
        self.who, self.k = who, max(k, 1)
        rows = np.stack([asked[i] for i in who]).astype(float)
        self.d = rows.shape[1]
        self.single, self.columns, self.broken = rows.astype(np.float32), np.ascontiguousarray(rows.T), np.isnan(rows).any(1)
        self.error = 2 * (self.d + 4) * 2.0**-24  # of a product of unit vectors in single precision, doubled
        shape = (len(who), self.k)
        self.n, self.least = np.zeros(len(who), dtype=int), np.full(len(who), -np.inf)
        self.held = {"ids": np.zeros(shape, dtype=np.int64), "rank": np.zeros(shape), "score": np.zeros(shape), "final": np.zeros(shape), "lack": np.zeros(shape, dtype=int)}

    def meet(self, own: np.ndarray, v: Vectors) -> None:
        """Score the vectors against the queries at the places ``own``."""
        broken, whole = self.broken[own], own
        self._cross(own[broken], v.any, v)
        own = own[~broken]
        self._cross(own, v.broken, v)
        self._cross(own, v.wild, v)
        if len(own) and len(v.plain):
            near = self.single[own] @ v.single.T
            if v.factors is not None:
                near *= v.factors
            least = self.least[own] - self.error * v.most
            fresh, some = np.flatnonzero(np.isneginf(least)), min(len(v.plain), FIRST)
            if len(fresh) and some >= self.k:
                least[fresh] = np.partition(near[fresh, :some], some - self.k, axis=1)[:, some - self.k].astype(float) - 2 * self.error * v.most
            found = np.flatnonzero(near >= np.nextafter(least.astype(np.float32), np.float32(-np.inf))[:, None])
            for i in range(0, len(found), PAIRS):
                q, place = np.divmod(found[i : i + PAIRS], len(v.plain))
                self._keep(own[q], v.plain[place], v)
        self._cross(whole[self.n[whole] < self.k], v.last, v)

    def _cross(self, own: np.ndarray, places: np.ndarray, v: Vectors) -> None:
        step = max(1, PAIRS // max(1, len(own)))
        for i in range(0, len(places) if len(own) else 0, step):
            some = places[i : i + step]
            self._keep(np.repeat(own, len(some)), np.tile(some, len(own)), v)

    def _keep(self, q: np.ndarray, place: np.ndarray, v: Vectors) -> None:
        """Score pairs in double precision and keep the best."""
        score = np.zeros(len(q))
        for a, b in zip(self.columns, v.columns, strict=True):
            score += b[place] * a[q]
        final = score if v.weights is None else score * v.weights[place]
        lack = v.lack[place]
        rank = np.where(lack > 0, -np.inf, np.where(np.isnan(final), np.inf, final))
        if v.ids.dtype == object:
            self.held["ids"] = self.held["ids"].astype(object)
        new = {"ids": v.ids[place].astype(self.held["ids"].dtype), "rank": rank, "score": score, "final": final, "lack": lack}
        may = rank >= self.least[q]
        q, new = q[may], {name: x[may] for name, x in new.items()}
        own = np.unique(q)
        old = np.arange(self.k) < self.n[own][:, None]
        q = np.concatenate([np.repeat(own, self.n[own]), q])
        both = {name: np.concatenate([self.held[name][own][old], x]) for name, x in new.items()}
        order = np.lexsort((_codes(both["ids"]), -both["rank"], q))
        starts = np.searchsorted(q[order], own)
        counts = np.diff(np.append(starts, len(order)))
        at = np.arange(len(order)) - np.repeat(starts, counts)
        order, at = order[at < self.k], at[at < self.k]
        for name, x in both.items():
            self.held[name][q[order], at] = x[order]
        self.n[own] = np.minimum(counts, self.k)
        self.least[own] = np.where(self.n[own] == self.k, self.held["rank"][own, -1], -np.inf)

    def found(self) -> tuple[np.ndarray, ...]:
        """Numbers of queries, ids, scores, finals and what is lacking, of all hits."""
        have = np.arange(self.k) < self.n[:, None]
        return np.repeat(self.who, self.n), *[self.held[name][have] for name in ("ids", "score", "final", "lack")]


def boosted(hits: DataFrame, *, authority: Column, temporal: Column, citation: Column, weights=(1.0, 1.0, 1.0)) -> DataFrame:
    """Adds ``final``: score times the three boosts, each by its weight."""
    a, t, c = weights
    return hits.withColumn("final", F.col("score") * (authority * a) * (temporal * t) * (citation * c))


def expand_related(hits: DataFrame, edges: DataFrame, chunks: DataFrame, *, top: int = 5, limit: int = 5, least: float = 0.6) -> DataFrame:
    """Documents linked to the best hits (document_id, final), each by its best chunk: document_id, chunk_id, score, boost."""
    best = hits.orderBy(F.desc("final"), "document_id").limit(top).select(F.col("document_id").alias("a")).distinct()
    ways = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"), "score").unionByName(edges.select(F.col("dst").alias("a"), F.col("src").alias("b"), "score"))
    linked = ways.where(F.col("score") > least).join(F.broadcast(best), "a").select(F.col("b").alias("document_id")).distinct()
    docs = linked.join(hits.select("document_id"), "document_id", "left_anti").orderBy("document_id").limit(limit)
    chosen = chunks.join(F.broadcast(docs), "document_id").groupBy("document_id").agg(F.min_by("chunk_id", F.struct(-F.col("authority_weight"), F.col("chunk_id"))).alias("chunk_id"))
    return chosen.select("document_id", "chunk_id", F.lit(0.7).alias("score"), F.lit(1.2).alias("boost"))


def nearest_cell(vector: Column, centres: list[list[float]]) -> Column:
    """Number of the centre with the largest inner product; for a partition column of an inverted file."""
    scores = F.array(*[F.struct(dot(vector, F.array(*[F.lit(float(x)) for x in c])).alias("s"), F.lit(-i).alias("i")) for i, c in enumerate(centres)])
    return -F.array_max(scores)["i"]


def train_cells(items: DataFrame, cells: int, *, item: str = "vec_id", vector: str = "embedding", sample: int = 20_000, rounds: int = 15) -> np.ndarray:
    """Centres of an inverted file by spherical k-means on at most ``sample`` vectors, the first by a hash of the id."""
    known = directed(items.select(item, F.col(vector).alias("_v")), "_v")
    rows = known.orderBy(F.xxhash64(item), item).limit(sample).select("_v").toArrow().column(0)
    x = np.array([v for chunk in rows.chunks for v in _rows(chunk)], dtype=float)
    if not len(x):
        return np.zeros((0, 0))
    centres = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1.0), centres)
    return centres


def cell_index(items: DataFrame, centres: np.ndarray, *, item: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(item, embedding, cell): every vector that has a direction, as a unit vector, with its nearest cell; written partitioned
    by ``cell``, a search reads the cells that it probes only."""
    known = directed(items.select(item, F.col(vector).alias("embedding")), "embedding")
    return known.withColumn("cell", F.get(nearest_cells(centres, 1)("embedding"), 0))


def nearest_cells(centres: np.ndarray, n: int):
    """A function of a vector: the numbers of the ``n`` centres with the largest inner products, best first."""

    @F.pandas_udf("array<int>")
    def run(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        near = np.argsort(-(np.stack(vectors.to_numpy()) @ centres.T), axis=1, kind="stable")[:, :n]
        return pd.Series(list(near.astype(np.int32)))

    return run


def search_cells(index: DataFrame, queries: DataFrame, centres: np.ndarray, k: int, *, probes: int = 8, item: str = "vec_id", query: str = "query_id", vector: str = "embedding", broadcast_queries: int = 10_000, folders: bool = False) -> DataFrame:
    """(query, item, score): the k best items of the ``probes`` cells nearest to each query; all cells make it exact.

    ``index`` has unit vectors, as ``cell_index`` gives them; with ``folders`` it is written by cell, and folders that no
    query probes are not listed. More than ``broadcast_queries`` queries, 1,000 at least, go in blocks of about that size.
    """
    blocks = max(1, -(-queries.count() // max(broadcast_queries, 1_000)))
    number = F.pmod(F.xxhash64(query), F.lit(blocks))
    parts = []
    for b in range(blocks):
        names, asked = _asked(queries.where(number == b) if blocks > 1 else queries, query, vector)
        near = np.argsort(-(np.stack(asked) @ centres.T), axis=1, kind="stable")[:, :probes] if asked else np.zeros((0, 0), dtype=int)
        meeting = {int(c): np.flatnonzero((near == c).any(axis=1)) for c in np.unique(near)}
        held = index.where(F.col("cell").isin(list(meeting))) if folders else index
        parts.append(_best(held.withColumnRenamed(vector, "_v"), names, asked, k, item, queries.schema[query], meeting))
    return reduce(DataFrame.unionByName, parts)


def embed(df: DataFrame, text: str, fn, out: str = "embedding") -> DataFrame:
    """Apply an injected embedding function (list of texts to list of vectors), a batch at a time."""
    @F.pandas_udf("array<float>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([list(map(float, v)) for v in fn(texts.fillna("").tolist())])

    return df.withColumn(out, run(F.col(text)))
