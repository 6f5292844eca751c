"""Byte-level BPE encoding and decoding.

A text is split by the public pre-tokenisation pattern and each pre-token is merged by itself. Its bytes are a linked
list; every adjacent pair that the vocabulary knows lies in the bucket of its rank, and a bitmap of bitmaps tells which
buckets hold something. The lowest rank is found by first set bits from the top bitmap down, its leftmost position is
taken, the pair becomes one token, and the pairs with both neighbours go into the buckets of their own ranks. Entries
whose pair has changed since are skipped when they come up. So a pre-token of n bytes costs n pushes and pops, however
long it is. Pre-tokens met before come from a bounded table.

Defined results: null and empty texts have no tokens and decode to no bytes; rows are encoded each by itself, so
repeated rows and null ids are alike; a pre-token may be as long as its text; an empty table gives an empty table;
columns pass through, and a column of the name of the result is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from .common import fresh
from .token_counts import PATTERN, RANKS

#: Characters of a pre-token that may be kept in the table, and entries of the table.
LONGEST_KNOWN, MAX_KNOWN = 40, 300_000
#: Characters of texts that are encoded together, and bytes of new pre-tokens that are merged together; one text, or
#: pre-token, more is taken whole.
HELD_CHARS, MERGED_BYTES = 1 << 23, 1 << 21
#: Stands for a character that is neither letter, number nor space (private use).
OTHER = "\ue000"
#: One encoder for each vocabulary in a Python worker.
_ENCODERS: dict[str, "Encoder"] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Merger:
    """Encodes pre-tokens, given as bytes, by the ranks of a vocabulary: many at once, as stretches of one linked list.

    A token is known by its rank. All positions of the lowest rank are merged together, but of overlapping pairs every
    other one, from the left, and none behind one in its pre-token that opens a pair of still lower rank.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], "int64")
        size = max(ranks.values(), default=0) + 1
        self.bits = (size.bit_length() + 1) // 2
        self.words = (size >> self.bits) + 1
        found = [(ranks[t[:i]] << 32 | ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        keys, self.pair_ranks = np.array(sorted(found), "int64").reshape(-1, 2).T.copy()
        self.pair_keys = np.append(keys, np.iinfo("int64").max)
        self.pair_ranks = np.append(self.pair_ranks, -1)

    def _rank(self, left: np.ndarray | int, right: np.ndarray | int) -> np.ndarray:
        """Ranks of pairs of tokens, -1 where there is none."""
        key = left << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pre-tokens, one after the other, and how many each has."""
        bits, low = self.bits, (1 << self.bits) - 1
        lengths = np.array([len(p) for p in pieces], "int64")
        n = int(lengths.sum())
        ends = np.cumsum(lengths)
        token = np.append(self.single[np.frombuffer(b"".join(pieces), "u1")], (1 << 31) - 1)  # the last one stands for no token
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = n  # nothing merges across pre-tokens
        before[ends[:-1]] = -1
        pair = np.append(self._rank(token[:n], token[after[:n]]), -1)  # rank of the pair that begins at a position now, or -1

        first = np.argsort(pair[:n], kind="stable")
        first = first[np.searchsorted(pair[first], 0) :]
        found, starts = np.unique(pair[first], return_index=True)
        early = dict(zip(found.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(first)], strict=True), strict=True)) if len(found) else {}
        late: dict[int, list[int]] = {}  # buckets: early ones as stretches of ``first``, later entries as lists
        leaves, top = [0] * self.words, 0  # bit b of leaves[w]: bucket (w << bits) + b holds something; bit w of top: leaves[w] does
        for rank in early:
            leaves[rank >> bits] |= 1 << (rank & low)
            top |= 1 << (rank >> bits)
        while top:
            high = (top & -top).bit_length() - 1  # first set bits give the lowest rank
            bit = leaves[high] & -leaves[high]
            leaves[high] ^= bit
            if not leaves[high]:
                top ^= 1 << high
            rank = (high << bits) + bit.bit_length() - 1
            at = late.pop(rank, None)
            if rank in early:
                a, b = early.pop(rank)
                at = first[a:b] if at is None else np.concatenate([first[a:b], np.array(at)])
            else:
                at = np.array(at)
            at = at[pair[at] == rank]  # entries whose pair has changed are stale
            if not len(at):
                continue
            at.sort()
            at = at[self._apart(at, after[at])]
            gone, left = after[at], before[at]
            end = after[gone]
            right_new, left_new = self._rank(rank, token[end]), self._rank(token[left], rank)
            touching = np.append(end[:-1] == at[1:], False)
            lower = ((right_new >= 0) & (right_new < rank)) | ((left_new >= 0) & (left_new < rank))
            rest = at[:0]
            if touching.any() and -1 < self._rank(rank, np.array([rank]))[0] < rank:
                lower |= touching
            if lower.any():
                piece, behind = np.searchsorted(ends, at, "right"), np.cumsum(lower) - lower
                opens = np.append(True, np.diff(piece) > 0)
                keep = behind == np.maximum.accumulate(np.where(opens, behind, 0))
                rest = at[~keep]
                at, gone, left, end, right_new, left_new, touching = (x[keep] for x in (at, gone, left, end, right_new, left_new, touching))
            token[at], token[gone], pair[gone] = rank, -1, -1
            after[at] = end
            before[end] = at
            if touching.any():  # neighbours have changed
                left = before[at]
                right_new, left_new = self._rank(rank, token[end]), self._rank(token[left], rank)
                left = np.where(np.append(False, left[1:] == at[:-1]), -1, left)
            left_new, left = left_new[left >= 0], left[left >= 0]
            pair[at], pair[left] = right_new, left_new
            new, changed = np.concatenate([right_new, left_new]), np.concatenate([at, left])
            known = new >= 0
            pushed = zip(new[known].tolist(), changed[known].tolist(), strict=True)
            for r, where in (*pushed, *((rank, p) for p in rest.tolist())):
                if r in late:
                    late[r].append(where)
                else:
                    late[r] = [where]
                    leaves[r >> bits] |= 1 << (r & low)
                    top |= 1 << (r >> bits)
        token = token[:n]
        alive = token >= 0
        return token[alive], np.diff(np.append(0, np.cumsum(alive)[ends - 1]))

    @staticmethod
    def _apart(at: np.ndarray, gone: np.ndarray) -> np.ndarray:
        """Of pairs that overlap in a chain, every other one."""
        joined = np.append(False, gone[:-1] == at[1:])
        if not joined.any():
            return ~joined
        place = np.arange(len(at))
        begin = np.maximum.accumulate(np.where(joined, 0, place))
        return (place - begin) % 2 == 0


def splitter() -> Callable[[str], list[str]]:
    """The pre-tokens of a text.

    Letters and numbers are those of the tokenizer library; characters that only the newer tables of the pattern engine
    call letters or numbers are found by asking the library about each one once.
    """
    import unicodedata

    import regex
    import tiktoken

    split = regex.compile(PATTERN).findall
    probe = {bytes([i]): i for i in range(256)} | {b"a" + bytes([i]): 256 + i for i in range(256)}
    asked = tiktoken.Encoding("probe", pat_str=PATTERN, mergeable_ranks=probe, special_tokens={}).encode_ordinary
    new = [chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn"]
    alone = [c for c in new if len(split("a" + c)) == 1 and asked("a" + c)[0] < 256]
    odd = dict.fromkeys(map(ord, alone), OTHER)
    absent = frozenset(alone).isdisjoint

    def pieces(text: str) -> list[str]:
        if text.isascii() or absent(text):
            return split(text)
        parts, at = [], 0
        for shadow in split(text.translate(odd)):
            parts.append(text[at : at + len(shadow)])
            at += len(shadow)
        return parts

    return pieces


class Known(dict):
    """Numbers of the pre-tokens met; a new one gets the next number."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Whole texts to ids, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pieces, self.merge = ranks, splitter(), Merger(ranks)
        self._reset([], [])

    def _reset(self, pieces: list[str], packed: list[bytes]) -> None:
        self.known, self.packed = Known(), packed
        self.known.update(zip(pieces, range(len(pieces)), strict=True))
        self.uses = np.zeros(len(pieces), "int64")

    def __call__(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The packed ids of each text; texts are taken in stretches of bounded size."""
        held: list[np.ndarray] = []
        size = 0
        for text in texts:
            pieces = self.pieces(text or "")
            held.append(np.fromiter(map(self.known.__getitem__, pieces), "int32", len(pieces)))
            size += len(text or "")
            if size >= HELD_CHARS:
                yield from self._packed(held)
                held, size = [], 0
        yield from self._packed(held)

    def _packed(self, held: list[np.ndarray]) -> Iterator[bytes]:
        self._learn()
        for numbers in held:
            yield b"".join(map(self.packed.__getitem__, numbers.tolist()))
        if held and len(self.known) > MAX_KNOWN:
            self._forget(np.bincount(np.concatenate(held), minlength=len(self.known)))

    def _learn(self) -> None:
        """Work out the ids of the new pre-tokens, in the order of their numbers."""
        rows: list[bytes] = []
        size = 0
        for piece in self.known.new:
            rows.append(piece.encode())
            size += len(rows[-1])
            if size >= MERGED_BYTES:
                self._merge(rows)
                rows, size = [], 0
        if rows:
            self._merge(rows)
        self.known.new = []

    def _merge(self, rows: list[bytes]) -> None:
        whole = [self.ranks.get(r) for r in rows]
        apart = [r for r, w in zip(rows, whole, strict=True) if w is None]
        cut: Iterator[bytes] = iter(())
        if apart:
            ids, sizes = self.merge(apart)
            blob, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
            cut = (blob[a:b] for a, b in zip([0, *ends], ends, strict=False))
        self.packed += [next(cut) if w is None else w.to_bytes(4, "little") for w in whole]

    def _forget(self, used: np.ndarray) -> None:
        """Keep the half of the table that is used most and is short."""
        self.uses = used + np.append(self.uses, np.zeros(len(used) - len(self.uses), "int64")) // 2
        pieces = list(self.known)
        best = np.argsort(-self.uses, kind="stable")[: MAX_KNOWN // 2].tolist()
        kept = [i for i in best if len(pieces[i]) <= LONGEST_KNOWN]
        uses = self.uses[kept]
        self._reset([pieces[i] for i in kept], [self.packed[i] for i in kept])
        self.uses = uses


def _mapped(df: DataFrame, source: str, out: str, kind: DataType, keep: list[str] | None, make: Callable[[], Callable[[Iterable], Iterable]]) -> DataFrame:
    """Adds column ``out`` of ``kind``, worked out from the values of ``source`` by the function that ``make`` gives in each task."""
    rest = [c for c in (df.columns if keep is None else keep) if c.lower() != out.lower()]
    read = fresh(df.columns, "_read")
    named = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{source}`").alias(read))
    schema = StructType([*named.drop(read).schema.fields, StructField(out, kind)])
    arrow = pa.large_binary() if isinstance(kind, BinaryType) else pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for b in batches:
            made = pa.array(list(work(x.as_py() for x in b.column(len(rest)))), arrow)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], made], [*rest, out])

    return named.mapInArrow(run, schema)


def encode(docs: DataFrame, *, text_col: str = "text", out_col: str = "ids", packed: bool = False, keep: list[str] | None = None, ranks_path: str = RANKS) -> DataFrame:
    """Adds the token ids of every whole text: array<int>, or binary of little-endian 32-bit integers if ``packed``; ``keep`` names the other columns (all)."""
    shipped = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))  # one vocabulary: fixed size

    def make() -> Callable:
        encoder = _ENCODERS.get(ranks_path)  # a worker that has read tasks before knows their pre-tokens
        if encoder is None:
            encoder = _ENCODERS[ranks_path] = Encoder(shipped.value)
        return encoder if packed else lambda texts: (np.frombuffer(x, "<u4").astype("int32") for x in encoder(texts))

    return _mapped(docs, text_col, out_col, BinaryType() if packed else ArrayType(IntegerType()), keep, make)


def decode(encoded: DataFrame, *, ids_col: str = "ids", out_col: str = "decoded", keep: list[str] | None = None, ranks_path: str = RANKS) -> DataFrame:
    """Adds the bytes that the ids stand for (binary); ids outside the vocabulary are an error, null ids are no tokens."""
    shipped = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    packed = isinstance(encoded.schema[ids_col].dataType, BinaryType)

    def make() -> Callable:
        tokens = {i: t for t, i in shipped.value.items()}
        listed = (lambda x: np.frombuffer(x, "<u4").tolist()) if packed else list
        return lambda rows: (b"".join([tokens[i] for i in listed(ids)]) if ids else b"" for ids in rows)

    return _mapped(encoded, ids_col, out_col, BinaryType(), keep, make)
