"""Phrase collocation mining on vertical positional inverted lists.

Texts are cut into pieces and words, and runs of pieces into segments of about ``SEGMENT_WORDS`` words. A word has one list
of positions in each segment, and the lengths of its lists add up to its exact frequency. Frequent words and phrases are
extended level by level: in each segment the list of a phrase is merge-joined with the lists of the words that stand
next to its occurrences, which gives the lists of the longer phrases; their lengths go to buckets by a hash of the phrase,
are summed there over all segments, and a segment hears which of its phrases are frequent. Between levels a segment keeps
the lists of its words and the phrases, and forms the phrases' lists again. A gap between pieces keeps phrases inside them.
Segments and buckets are groups of bounded size, a hot word or phrase is one list in each segment and never one group.
Lists travel packed, one row for each segment, or segment and bucket.

Every part of a frequent phrase is frequent, so its frequency is known. Cutting a candidate in two gives a score by
exact decimal arithmetic, the lowest cut counts, and candidates that mostly occur inside a longer one are dropped.

Frequent words are counted as written; up to ``broadcast_rows`` they are broadcast to the lists, beyond that it is an
ordinary join.

Defined results: null and empty texts have no words; a null language is ``und``; rows that share an id, and repeated
rows, count each; ties of score and frequency go by the bytes of the phrase; a text may be as long as a row may be,
and a segment may hold a single piece that is longer than it should be; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

SEGMENT_WORDS = 1 << 20
#: Bytes of a text that are cut into words at a time; the cut is at the end of a piece.
STRETCH_BYTES = 1 << 22
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 10 if b in _PIECE_ENDS else 32 if b == 9 else b for b in range(256))
_GAP, _NOTHING = -1, -2
_LISTS = "seg long, lang string, word string, n long, positions binary"
_PACKED = "seg long, level int, a binary, b binary, c binary"
_COUNTED = "bucket long, seg long, a binary, b binary, c binary"
_FOUND = "seg long, level int, a binary, b binary, c binary, left long, right long, id long, f long"
#: Words of the corpus for each bucket of phrases; a bucket has as many rows at most, and the fewest buckets.
BUCKET_WORDS, LEAST_BUCKETS = 1 << 23, 64


def _binaries(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive runs of 32-bit positions, one binary value for each size."""
    offsets = np.zeros(len(sizes) + 1, "int32")
    np.cumsum(sizes * 4, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.astype("<i4").tobytes())])


def _positions(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All positions, list after list, and the size of each list."""
    values = lists.cast(pa.large_binary()).combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], "int64")[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, "int64")
    data = values.buffers()[2]
    held = np.frombuffer(data, "u1")[offsets[0] : offsets[-1]] if data is not None else np.empty(0, "u1")
    return held.view("<i4").astype("int64"), np.diff(offsets) // 4


class _Numbers(dict):
    """Numbers of the words of one language in a segment, in order of their first appearance in all languages."""

    def __init__(self, words: list[tuple[str, bytes]], lang: str):
        super().__init__({b"\n": _GAP, b"": _NOTHING})
        self.words, self.lang = words, lang

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append((self.lang, word))
        return number


class _Segment:
    """Words of one segment as they come; ``lists`` turns them into one list of positions for each word."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.words: list[tuple[str, bytes]] = []
        self.numbers: dict[str, _Numbers] = {}
        self.codes: list[np.ndarray] = []

    def add(self, lang: str, stretch: bytes) -> None:
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = _Numbers(self.words, lang)
        words = stretch.replace(b"\n", b" \n ").split(b" ")
        codes = np.fromiter(map(numbers.__getitem__, words), "int32", len(words))
        codes = codes[codes != _NOTHING]
        self.codes += [codes, np.array([_GAP], "int32")]
        self.size += len(codes) + 1

    def lists(self) -> pa.RecordBatch:
        codes = np.concatenate([np.empty(0, "int32"), *self.codes])
        at = np.flatnonzero(codes >= 0)
        owner = codes[at]
        sizes = np.bincount(owner, minlength=len(self.words)).astype("int64")
        at = at[np.argsort(owner, kind="stable")]
        n = len(self.words)
        langs = pa.array([lang for lang, _ in self.words], pa.string())
        words = pa.array([word for _, word in self.words], pa.binary()).cast(pa.string())
        columns = [pa.array(np.full(n, self.number)), langs, words, pa.array(sizes), _binaries(at, sizes)]
        return pa.RecordBatch.from_arrays(columns, ["seg", "lang", "word", "n", "positions"])


def _stretches(text: bytes) -> Iterator[bytes]:
    """A text in parts that end with a piece."""
    start = 0
    while len(text) - start > STRETCH_BYTES:
        end = text.find(b"\n", start + STRETCH_BYTES)
        if end < 0:
            break
        yield text[start:end]
        start = end + 1
    yield text[start:]


def word_lists(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(seg, lang, word, n, positions): the positional inverted lists, one row for each word and segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        segment = _Segment(first)
        for b in batches:
            for text, lang in zip(b.column(0), b.column(1), strict=True):
                for stretch in _stretches((text.as_py() or "").encode().translate(_BYTES)):
                    segment.add(lang.as_py(), stretch)
                    if segment.size >= SEGMENT_WORDS:
                        yield segment.lists()
                        segment = _Segment(segment.number + 1)
        yield segment.lists()

    return docs.select(F.col(text_col).alias("t"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("l")).mapInArrow(run, _LISTS)


def _pack(values: np.ndarray, kind: str) -> bytes:
    """Numbers as compressed bytes, behind the size that they have without."""
    raw = np.ascontiguousarray(values, kind).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    return np.frombuffer(pa.decompress(packed[8:], size, "zstd", asbytes=True) if size else b"", kind)


def pack_words(lists: DataFrame) -> DataFrame:
    """One row (seg, level 1, ids, sizes, positions) for each segment, from the rows (seg, id, positions) of its words."""

    def one_segment(rows: pa.Table) -> pa.Table:
        positions, sizes = _positions(rows.column("positions"))
        packed = [_pack(rows.column("id").to_numpy(), "<i8"), _pack(sizes, "<i4"), _pack(positions, "<i4")]
        columns = [pa.array([rows.column("seg")[0].as_py()]), pa.array([1], pa.int32()), *[pa.array([x], pa.binary()) for x in packed]]
        return pa.table(columns, ["seg", "level", "a", "b", "c"])

    return lists.groupBy("seg").applyInArrow(one_segment, _PACKED)


class _Lists:
    """Lists of phrases in a segment: their numbers, and all places with the list that each belongs to, by place."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, owner: np.ndarray):
        self.ids, self.at, self.owner = ids, at, owner

    def joined(self, words: _Lists, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merge join of places with the words ``k`` further on: (phrase list, word list, place), by place."""
        place = np.searchsorted(words.at, self.at + k)
        hit = np.flatnonzero(place < len(words.at))
        hit = hit[words.at[place[hit]] == self.at[hit] + k]
        if k > 1:  # the last k words have to be a frequent phrase, too
            suffix = np.searchsorted(self.at, self.at[hit] + 1)
            inside = suffix < len(self.at)
            hit = hit[inside][self.at[suffix[inside]] == self.at[hit[inside]] + 1]
        return self.owner[hit], words.owner[place[hit]], self.at[hit]

    def longer(self, words: _Lists, k: int, left: np.ndarray, right: np.ndarray, ids: np.ndarray) -> _Lists:
        """The lists of the phrases ``ids`` of k + 1 words, each a phrase ``left`` and a word ``right``."""
        head, tail, at = self.joined(words, k)
        order = np.lexsort((right, left))
        left, right, ids = left[order], right[order], ids[order]
        heads, tails = self.ids[head], words.ids[tail]
        known = np.searchsorted(left, heads, "left"), np.searchsorted(left, heads, "right")
        # words are numbered anew, so that phrase and word make one number
        _, codes = np.unique(np.concatenate([right, tails]), return_inverse=True)
        width = int(codes.max(initial=0)) + 1
        starts = np.searchsorted(left, left, "left")
        place = np.searchsorted(starts * width + codes[: len(right)], known[0] * width + codes[len(right) :])
        held = np.flatnonzero((known[0] < known[1]) & (place < len(ids)))
        held = held[(left[place[held]] == heads[held]) & (right[place[held]] == tails[held])]
        return _Lists(ids, at[held], place[held])


def extend(segments: DataFrame, k: int, buckets: int) -> DataFrame:
    """(bucket, seg, left, right, n packed): how often each phrase of k words is followed by a word, in each segment.

    ``segments`` has for each segment the packed lists of words (level 1), and phrases of 2 to k words: left, right, id.
    """

    def one_segment(rows: pa.Table) -> pa.Table:
        level = rows.column("level").to_numpy()
        cells = [rows.column(c).to_pylist() for c in "abc"]
        read = lambda n, c, kind: np.concatenate([np.empty(0, kind), *[_unpack(cells[c][i], kind) for i in np.flatnonzero(level == n)]])
        at, sizes = read(1, 2, "<i4").astype("int64"), read(1, 1, "<i4")
        order = np.argsort(at)
        words = found = _Lists(read(1, 0, "<i8"), at[order], np.repeat(np.arange(len(sizes)), sizes)[order])
        for n in range(2, k + 1):
            found = found.longer(words, n - 1, *[read(n, c, "<i8") for c in range(3)])
        head, tail, _ = found.joined(words, k)
        key, counts = np.unique(head * max(len(words.ids), 1) + tail, return_counts=True)
        left, right = found.ids[key // max(len(words.ids), 1)], words.ids[key % max(len(words.ids), 1)]
        mixed = (left.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) ^ (right.astype("uint64") * np.uint64(0xC2B2AE3D27D4EB4F))
        bucket = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        met, starts = np.unique(bucket[order], return_index=True)
        packed = [[_pack(x[part], kind) for part in np.split(order, starts[1:])] if len(met) else [] for x, kind in ((left, "<i8"), (right, "<i8"), (counts, "<i4"))]
        seg = rows.column("seg")[0].as_py()
        columns = [pa.array(met.astype("int64")), pa.array(np.full(len(met), seg)), *[pa.array(x, pa.binary()) for x in packed]]
        return pa.table(columns, ["bucket", "seg", "a", "b", "c"])

    return segments.groupBy("seg").applyInArrow(one_segment, _COUNTED)


def sum_up(counted: DataFrame, level: int, min_count: int) -> DataFrame:
    """The frequent phrases of each bucket: rows with id and f, and rows that tell a segment which of its phrases they are."""

    def one_bucket(rows: pa.Table) -> pa.Table:
        segs = rows.column("seg").to_pylist()
        parts = [[_unpack(x, kind) for x in rows.column(c).to_pylist()] for c, kind in (("a", "<i8"), ("b", "<i8"), ("c", "<i4"))]
        left, right, n = (np.concatenate(x) for x in parts)
        place = np.repeat(np.arange(len(segs)), [len(x) for x in parts[0]])
        order = np.lexsort((place, right, left))
        left, right, n, place = left[order], right[order], n[order].astype("int64"), place[order]
        opens = np.flatnonzero(np.append(True, (np.diff(left) != 0) | (np.diff(right) != 0)))
        f = np.add.reduceat(n, opens)
        sizes = np.diff(opens, append=len(left))
        often = f >= min_count
        first = (rows.column("bucket")[0].as_py() << 32) + np.arange(int(often.sum()))
        of = np.repeat(often, sizes)
        ids = np.repeat(np.where(often, first[np.minimum(np.cumsum(often) - 1, max(len(first) - 1, 0))] if len(first) else 0, 0), sizes)[of]
        left, right, place = left[of], right[of], place[of]
        one = np.flatnonzero(np.append(True, np.diff(ids) != 0)) if len(ids) else np.empty(0, int)
        told = [(segs[s], [_pack(x[place == s], "<i8") for x in (left, right, ids)]) for s in np.unique(place).tolist()]
        nothing, m = [None] * len(one), len(told)
        columns = [
            pa.array([s for s, _ in told] + nothing, pa.int64()), pa.array([level] * (m + len(one)), pa.int32()),
            *[pa.array([x[i] for _, x in told] + nothing, pa.binary()) for i in range(3)],
            *[pa.array([None] * m + x.tolist(), pa.int64()) for x in (left[one], right[one], ids[one], f[often])],
        ]
        return pa.table(columns, ["seg", "level", "a", "b", "c", "left", "right", "id", "f"])

    return counted.groupBy("bucket").applyInArrow(one_bucket, _FOUND)


def frequent_phrases(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = 4, min_count: int = 30, broadcast_rows: int = 300_000) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of 1 to ``max_words`` words that occur ``min_count`` times, and (lang, n)."""
    scratch = Scratch(docs.sparkSession)
    postings = scratch.put(word_lists(docs, text_col=text_col, lang_col=lang_col), "postings")
    total = F.sum("n").alias("f")
    found = postings.groupBy("lang", F.col("word").alias("phrase")).agg(total).where(F.col("f") >= min_count)
    terms = scratch.put(found.select(F.monotonically_increasing_id().alias("id"), "*"), "terms")
    sizes = scratch.put(postings.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    buckets = max(LEAST_BUCKETS, (sizes.agg(F.sum("n")).first()[0] or 0) // BUCKET_WORDS)
    named = terms.select("id", F.col("lang").alias("of"), "phrase")
    few = named.limit(broadcast_rows + 1).count() <= broadcast_rows
    same = (F.col("lang") == F.col("of")) & (F.col("word") == F.col("phrase"))
    lists = postings.join(F.broadcast(named) if few else named, same).select("seg", "id", "positions")
    segments = scratch.put(pack_words(lists), "words")
    scratch.drop("postings")
    word = terms.select(F.col("id").alias("right"), F.col("phrase").alias("tail"))
    levels = [terms.select("id", "lang", "phrase", "f", F.lit(1).alias("words"))]
    for k in range(1, max_words):
        found = scratch.put(sum_up(extend(segments, k, buckets), k + 1, min_count), f"found-{k + 1}")
        parent = levels[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("head"))
        phrases = found.where("id is not null").join(parent, "left").join(word, "right")
        phrases = phrases.select("id", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "f", F.lit(k + 1).alias("words"))
        levels.append(scratch.put(phrases, f"phrases-{k + 1}"))
        segments = segments.unionByName(found.where("id is null").select("seg", "level", "a", "b", "c"))
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    return every.select("lang", "phrase", "words", "f"), sizes


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, length), " ")


def _wide(c: str) -> str:
    return f"CAST({c} AS DECIMAL(20, 0))"


def mine(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    max_words: int = 4,
    min_count: int = 30,
    covered_percent: int = 80,
    top: int = 2000,
    broadcast_rows: int = 300_000,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` collocations of each language."""
    every, sizes = frequent_phrases(docs, text_col=text_col, lang_col=lang_col, max_words=max_words, min_count=min_count, broadcast_rows=broadcast_rows)
    candidates = every.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.select("*", _part(F.lit(1), F.col("cut")).alias("first"), _part(F.col("cut") + 1, F.col("words")).alias("rest"))
    of = lambda part, f: every.select("lang", F.col("phrase").alias(part), F.col("f").alias(f))
    scored = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    scored = scored.withColumn("score", F.expr(f"(2000000BD * {_wide('a')}) DIV ({_wide('l')} + {_wide('r')})"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("_cut"))
    inner = candidates.where("words > 2").select("lang", "a", "words", "phrase", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("_n"))
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_n") + 1)).alias("_from"))
    inner = inner.groupBy("lang", _part(F.col("_from"), F.col("_n")).alias("inside")).agg(F.max("a").alias("longer"))
    covered = inner.select(F.col("lang").alias("_lang"), "inside", "longer")
    is_inside = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("inside")) & F.expr(f"100BD * {_wide('longer')} >= {covered_percent} * {_wide('a')}")
    left = lowest.join(covered, is_inside, "left_anti").select("lang", "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), F.col("_cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = F.pmod(F.xxhash64("phrase"), F.lit(1 << 10)).cast("int")
    for groups in (1 << 10, 1 << 5, 1):  # a language is cut down in parts of it first
        place = F.row_number().over(Window.partitionBy("lang", F.pmod("_dealt", F.lit(groups))).orderBy(*order))
        left = (left.withColumn("_dealt", dealt) if groups == 1 << 10 else left).withColumn("rank", place).where(F.col("rank") <= top)
    return left.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
