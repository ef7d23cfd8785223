from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postlens.llm import queries, token_files
from postlens.llm.common import shared_folder
from tests.conftest import TESTDATA

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
COLUMNS = "doc_id bigint, text string, start string, id int"


def expected_rows(rows):
    start = 0
    for doc_id, text in rows:
        ids = [*PLAIN.encode(text or "", add_special_tokens=False).ids, 2]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def coded(ids, size):
    rans = token_files.Rans(token_files.scaled_frequencies(np.bincount(ids, minlength=size)))
    return rans, rans.encode(ids)


def decoded(rans, segments, count):
    full = token_files.LANES * token_files.SEGMENT_STEPS
    sizes = [min(full, count - first) for first in range(0, count, full)]
    assert len(sizes) == len(segments)
    # Last segment first: each decodes from its own checkpoint.
    return np.concatenate([rans.decode(s, n) for s, n in reversed([*zip(segments, sizes)])][::-1])


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=5000))
def test_ids_come_back(ids):
    ids = np.array(ids, "<u2")
    rans, segments = coded(ids, 301)
    assert (decoded(rans, segments, len(ids)) == ids).all()


@pytest.mark.parametrize("n", [1, 4095, 4096, 4097, 1_048_576, 1_048_577, 2_300_000])
def test_segments_decode_alone_and_are_small(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.02, n), 999).astype("<u2")
    rans, segments = coded(ids, 1000)
    assert (decoded(rans, segments, n) == ids).all()
    if n > 100_000:
        p = np.bincount(ids) / n
        bits = -(p[p > 0] * np.log2(p[p > 0])).sum() * n
        assert 8 * sum(len(s["words"]) for s in segments) < 1.01 * bits


def test_one_symbol_and_all_rare_symbols():
    for ids, size in ((np.full(5000, 7, "<u2"), 9), (np.arange(60_000, dtype="<u2"), 60_000)):
        rans, segments = coded(ids, size)
        assert (decoded(rans, segments, len(ids)) == ids).all()


def test_a_changed_segment_is_noticed():
    rans, (segment,) = coded(np.arange(900, dtype="<u2").repeat(19), 900)
    words = bytearray(segment["words"])
    words[0] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.decode({**segment, "words": bytes(words)}, 17100)


def test_query_equals_the_library(spark):
    folder = str(TESTDATA / "sf0.001")
    docs = queries.documents(spark, folder).orderBy("doc_id").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.token_files(spark, folder).collect()))
    assert got == list(expected_rows(docs))


WORDS = ["a", "don't", "it's!", "x_y", "x_", "²,", "a²,", "Ⅷ.", "é...", "'", "'s", "''", "n't.", "A1,", "日本、", "ok\u2028", "@@", "🙂!", "<|endoftext|>.", "nb\u00a0sp", "\x1c", "\x85x"]


def test_words_in_any_company_encode_as_the_library_does(monkeypatch):
    encoder = token_files.WordEncoder(PLAIN.to_str(), "<u2")
    texts = [f"{a} {b} {c}" for a in WORDS for b in WORDS for c in ("", "end.", "a\nb", *WORDS[:4])] + [None, "", " ", "a  b"]
    for _ in range(2):  # through the library, then from the cache
        got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode_all(pa.array(texts))]
        assert got == [PLAIN.encode(t or "", add_special_tokens=False).ids for t in texts]
        monkeypatch.setattr(token_files, "CACHED_WORDS", 3)
        monkeypatch.setattr(token_files, "CACHED_BARES", 1)


def test_special_tokens_are_ids_of_their_own():
    encoder = token_files.WordEncoder(PLAIN.to_str(), "<u2")
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext |>", "hello"]
    got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode_all(pa.array(texts))]
    assert got == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    assert [50256 in ids for ids in got] == [True, True, True, False, False]


def test_odd_rows_in_many_blocks(spark, monkeypatch):
    texts = [None, "", " ", "a  b", "don't stop", "é\n x", "<|endoftext|>", "long " * 3000, "tab\t end\t", " a b ", "same", "same"]
    rows = [(i // 2 if i % 2 else 50 - i, t) for i, t in enumerate(texts * 3)] + [(9, "copy")] * 5
    rows.sort(key=lambda r: r[0])
    # Equal ids stay in the order of the table, so one task reads it here.
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], COLUMNS).coalesce(1)
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 100)
    got = token_files.token_file_round_trip(docs, PATH, 2).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == list(expected_rows(rows))


def test_null_ids_come_first_and_ids_are_kept(spark):
    rows = [(None, "zero"), (3, "three"), (1, "one")]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], COLUMNS)
    path = shared_folder(spark, "test")
    token_files.write_token_files(docs, path, PATH, 2)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    assert [r["id"] for r in got] == [None, 1, 3]
    words = [PLAIN.decode(np.frombuffer(r["ids"], "<u4").tolist()[:-1]) for r in got]
    assert words == ["zero", "one", "three"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert token_files.token_file_round_trip(docs, PATH, 2).collect() == []
