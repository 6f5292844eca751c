"""Byte-level BPE against the tokenizer library and against a plain version of the merges."""

import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from loomtext.llm import byte_bpe
from loomtext.llm.token_counts import PATTERN, RANKS

try:
    from public_tokenizers import PATTERN as PUBLIC
except ImportError:
    PUBLIC = PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("x", pat_str=PUBLIC, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}).encode_ordinary


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(byte_bpe.read_ranks(RANKS))


def ids(packed):
    return [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]


def plain_merge(piece, ranks):
    """Merge the leftmost pair of lowest rank until there is none."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_random_texts(library, encoder):
    rng = random.Random(3)
    letters = "aaabcdeé漢字Ж🙂\u0558\ua7ce\U000323af\ufffd\u00a0\u3000\n\r\t 's'll1٣²  .-=\x00\x1c\x85_"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(3000)]
    assert [ids(x) for x in encoder(texts)] == [library(t) for t in texts]


def test_every_character(library, encoder):
    texts = ["".join("a" + chr(c) for c in range(start, min(start + 512, 0x110000)) if not 0xD800 <= c < 0xE000) for start in range(0, 0x110000, 512)]
    assert [ids(x) for x in encoder(texts)] == [library(t) for t in texts]


@pytest.mark.parametrize("text", ["a" * 200_000, "ab" * 60_000, " " * 20_000, "=-" * 9_000, "漢字" * 9_000, "x" * 70_000 + " y", "theatre" * 20_000], ids=lambda t: t[:4])
def test_very_long_pre_tokens(library, encoder, text):
    assert ids(next(encoder([text]))) == library(text)


def test_a_new_pair_of_lower_rank_comes_first():
    """Vocabularies in which a merge opens a pair of lower rank than the rest of its bucket."""
    rng = random.Random(8)
    for _ in range(200):
        tokens = {bytes([c]) for c in b"abc"}
        while len(tokens) < 14:
            tokens.add(b"".join(rng.sample(sorted(tokens), 2)))
        order = sorted(tokens)
        rng.shuffle(order)
        ranks = {t: i for i, t in enumerate(order)}
        pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 25))) for _ in range(30)]
        pieces = [p for p in pieces if p not in ranks]
        ids, sizes = byte_bpe.Merger(ranks)(pieces)
        ends = sizes.cumsum()
        assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes, strict=True)] == [plain_merge(p, ranks) for p in pieces]


def test_the_table_of_known_pieces_is_bounded(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_KNOWN", 6)
    monkeypatch.setattr(byte_bpe, "HELD_CHARS", 10)
    monkeypatch.setattr(byte_bpe, "MERGED_BYTES", 8)
    encoder = byte_bpe.Encoder(byte_bpe.read_ranks(RANKS))
    texts = ["one two three zzqx zzqy", None, "", "zzqx zzqy four " + "q" * 60, "zzqx"]
    assert [ids(x) for x in encoder(texts)] == [library(t or "") for t in texts]
    assert len(encoder.known) <= 6 and all(len(p) <= byte_bpe.LONGEST_KNOWN for p in encoder.known) and len(encoder.packed) == len(encoder.known)


def test_columns_rows_and_round_trip(docs, repeated, empty, rows, library):
    done = byte_bpe.decode(byte_bpe.encode(docs.withColumn("ids", F.lit("clash"))))
    assert done.columns == [*docs.columns, "ids", "decoded"]
    for r in done.collect():
        assert bytes(r["decoded"]).decode() == (r["text"] or "") and r["ids"] == library(r["text"] or "") and r["kept"] == "clash"
    twice = byte_bpe.encode(repeated, packed=True, keep=["doc_id"]).groupBy("doc_id", "ids").count().collect()
    assert {r["count"] for r in twice if r["doc_id"] is not None} == {2} and sum(r["count"] for r in twice) == repeated.count()
    assert byte_bpe.decode(byte_bpe.encode(empty)).count() == 0
    nothing = docs.limit(1).select(F.lit(None).cast("array<int>").alias("ids"), F.lit(None).cast("binary").alias("packed"))
    assert bytes(byte_bpe.decode(nothing).first()["decoded"]) == b"" and bytes(byte_bpe.decode(nothing, ids_col="packed").first()["decoded"]) == b""
