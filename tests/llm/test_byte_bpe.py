from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from postlens.llm import byte_bpe, common, queries
from tests.conftest import TESTDATA

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PLAIN = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
BPE = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
TEXTS = [
    None, "", " ", "  ", "\n", " a", "a ", "a  b", "a\n b", "don't I'LL 123abc", "é ü ", "<|endoftext|>",
    "x" * 3000, "ab" * 2000 + "!", " ".join(["the"] * 500), "日本語 テキスト", "\x1c \x1c", "🙂🙂 🙂",
]


def merged_naively(piece, ranks):
    """Lowest rank first, leftmost first, over all pairs again and again."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(found)
        if rank == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return tuple(ranks[p] for p in parts)


@pytest.mark.parametrize("text", [t for t in TEXTS if t])
def test_texts_encode_as_the_library_does(text):
    assert BPE.encode(text) == PLAIN.encode_ordinary(text)
    assert BPE.decode(BPE.encode(text)) == text.encode()


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet="ab' \n\tétT1. 🙂", max_size=60))
def test_random_texts_encode_as_the_library_does(text):
    assert BPE.encode(text) == PLAIN.encode_ordinary(text)


def test_any_rank_table_merges_in_order_of_rank():
    rng = random.Random(1)
    for _ in range(30):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 700:
            tokens.add(bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 6))))
        order = rng.sample(sorted(tokens), len(tokens))
        ranks = {t: r for r, t in enumerate(order)}
        bpe = byte_bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
        for _ in range(20):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40)))
            expected = (ranks[piece],) if piece in ranks else merged_naively(piece, ranks)
            assert bpe.merge(piece) == expected


def test_full_caches_keep_their_younger_half():
    bpe = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN, cache_bytes=6000)
    text = " ".join(f"word{i % 70} it's{i % 9}, ({i % 5})" for i in range(3000))
    assert bpe.encode(text) == PLAIN.encode_ordinary(text)
    for cache, share in ((bpe.words, 5250), (bpe.pieces, 750)):
        assert cache.used <= share // 2 and len(cache) + len(cache.old) <= share // byte_bpe.ENTRY_BYTES


@pytest.mark.parametrize("cache_bytes", [1, 2000, 1 << 20])
def test_cached_words_in_any_company(cache_bytes):
    words = ["a", "don't", "it's!", "x_y", "x_", "²,", "a²,", "é...", "'", "'s", "n't.", "A1,", "日本、", "12345", "@@", "🙂!", "\x1c", "a\tb", "a\nb", "\n"]
    bpe = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN, cache_bytes)
    texts = [f"{a} {b} {c}" for a in words for b in words for c in ("", "end.", *words[:4])]
    for _ in range(2):
        assert [bpe.encode(t) for t in texts] == [PLAIN.encode_ordinary(t) for t in texts]


def expected_rows(rows):
    for doc_id, text in rows:
        ids = PLAIN.encode_ordinary(text or "")
        line = " ".join(map(str, ids)).encode()
        decoded = (text or "").encode()
        yield doc_id, len(ids), hashlib.sha256(line).hexdigest(), hashlib.sha256(decoded).hexdigest()


def test_query_equals_the_library(spark):
    folder = str(TESTDATA / "sf0.001")
    got = queries.byte_bpe(spark, folder).collect()
    docs = queries.documents(spark, folder).select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted(expected_rows(docs))


def test_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "one"), (3, "two"), (3, "two")]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id bigint, text string, n_tokens int, ids string")
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    got = byte_bpe.byte_bpe_round_trip(docs, path, pattern).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected_rows(rows)))
    ids = byte_bpe.encode_texts(docs.select("doc_id", "text"), path, pattern).collect()
    assert sorted(map(repr, (r["ids"] for r in ids))) == sorted(
        repr(PLAIN.encode_ordinary(t or "")) for _, t in rows
    )
    assert byte_bpe.byte_bpe_round_trip(docs.limit(0), path, pattern).collect() == []


def test_tasks_of_other_operators_empty_the_cache():
    name = byte_bpe.__name__
    byte_bpe._encoder(RANKS, public_tokenizers.PATTERN, "test")
    common.release_caches(name)
    assert "test" in byte_bpe._encoders
    common.release_caches("another")
    assert not byte_bpe._encoders
