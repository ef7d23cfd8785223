from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st

from postlens.llm import arrays, kneser_ney, queries
from postlens.llm.common import shared_folder
from tests.conftest import TESTDATA

SCHEMA = "doc_id bigint, text string, held_out string, score int"


@pytest.fixture(autouse=True)
def few_turns(monkeypatch):
    """More jobs than these small tables need would only take time; one test has several turns."""
    monkeypatch.setattr(kneser_ney, "TURNS", 1)


def naive_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\v\f\r":
        lowered = lowered.replace(space, " ")
    return [w for w in lowered.split(" ") if w] + [None]


def naive_discounts(values):
    n1, n2, n3, n4 = (sum(v == k for v in values) for k in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0, 2 - 3 * y * n3 / n2 if n2 else 0, 3 - 4 * y * n4 / n3 if n3 else 0]
    return [0, *(d if 0 < d < k + 1 else 0.5 for k, d in enumerate(raw))]


def naive_rows(rows):
    is_held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    words, pairs, after, before = Counter(), Counter(), defaultdict(dict), defaultdict(set)
    for i, text in rows:
        if not is_held(i):
            tokens = naive_words(text)
            words.update(tokens)
            pairs.update(zip(["<s>", *tokens], tokens))
    for (v, w), n in pairs.items():
        after[v][w] = n
        before[w].add(v)
    n, size = sum(words.values()), len(words)
    d2, d1 = naive_discounts(pairs.values()), naive_discounts([len(b) for b in before.values()])

    def unigram(w):
        rest = sum(d1[min(len(b), 3)] for b in before.values()) / len(pairs) if pairs else 1
        own = max(len(before[w]) - d1[min(len(before[w]), 3)], 0) / len(pairs) if w in before else 0
        return own + rest / (size + 1)

    def bigram(v, w):
        if v not in after:
            return unigram(w)
        total = sum(after[v].values())
        rest = sum(d2[min(c, 3)] for c in after[v].values()) / total
        c = after[v].get(w, 0)
        return max(c - d2[min(c, 3)], 0) / total + rest * unigram(w)

    if pairs:  # a distribution: over all words and one unknown
        for v in ["<s>", *list(words)[:5], "never seen"]:
            assert abs(sum(bigram(v, w) for w in [*words, "never seen"]) - 1) < 1e-9
    for i, text in rows:
        tokens = naive_words(text)
        base = sum(math.log10((words[t] + 1) / (n + size + 1)) for t in tokens)
        score = sum(math.log10(bigram(v, w)) for v, w in zip(["<s>", *tokens], tokens))
        yield (i, is_held(i), len(tokens), sum(words[t] > 0 for t in tokens), n, round(base, 6), round(score, 6))


def fixture():
    rng = random.Random(8)
    words = ["the"] * 30 + ["of", "and", "é", "Ü"] * 5 + [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(90)]
    rows += [(100 + i, " ".join(rng.choice(words) + "x" * (i % 2) for _ in range(30))) for i in range(20)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (None, "Null ID the"), (203, "THE the\x0bThe"), (204, "the " * 3000)]
    return rows + [rows[3], rows[3], (205, rows[3][1])]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def rounded(rows):
    return sorted((repr((*r[:5], round(r[5], 6) + 0.0, round(r[6], 6) + 0.0)) for r in rows))


@pytest.mark.parametrize("block_bytes", [500, 1 << 24])
def test_scores_equal_the_formulas(spark, block_bytes, monkeypatch):
    rows = fixture()
    docs = table(spark, rows).repartition(3)
    monkeypatch.setattr(kneser_ney, "BLOCK_BYTES", block_bytes)
    got = kneser_ney.language_model_scores(docs).collect()
    assert rounded(map(tuple, got)) == rounded(naive_rows(rows))


@pytest.mark.parametrize("rows", [1, 5])
def test_values_of_any_size_come_back(spark, rows):
    folder = shared_folder(spark, "test-grams")
    hashes = np.array([5, 6, 1 << 40, (1 << 40) + 9, 1 << 63], np.uint64)
    values = np.array([[1, 254, 255, 70_000, 3], [1, 0, 300, 2, 254], [15, 0, 16, 1, 2], [3, 0, 1, 4, 0], [3, 2, 3, 3, 1]], np.uint64)[:rows]
    kneser_ney.save_grams(folder, 3, 7, hashes, values)
    asked = np.array([1, 5, 6, 7, 1 << 40, (1 << 40) + 9, 1 << 63, (1 << 63) + 1], np.uint64)
    got = kneser_ney.load_values(folder, 3, 7, asked, rows)
    assert got[:, [1, 2, 4, 5, 6]].tolist() == values.tolist() and not got[:, [0, 3, 7]].any()
    assert not kneser_ney.load_values(folder, 3, 8, asked, rows).any()


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50), st.booleans())
def test_packed_numbers_come_back(values, ascending):
    values = np.array(sorted(values) if ascending else values, np.uint64)
    assert (arrays.unpack(arrays.pack(values, ascending)) == values).all()


def test_a_hot_word_makes_no_part_larger():
    hot = np.stack([np.full(20_000, 3, np.uint64), np.arange(20_000, dtype=np.uint64)])
    sizes = [places.stop - places.start for _, places in kneser_ney._in_parts(np.sort(kneser_ney.gram_hashes(hot)), 10)]
    assert len(sizes) == 10 and max(sizes) < 1.2 * min(sizes)


def test_empty_table_and_no_training(spark):
    docs = table(spark, [(0, "a b")])
    assert kneser_ney.language_model_scores(docs.limit(0)).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = kneser_ney.language_model_scores(table(spark, [(held, "a b")])).collect()
    assert tuple(row) == (held, True, 3, 0, 0, 0.0, 0.0)


def test_query_is_better_than_the_base_on_held_out_texts(spark):
    got = queries.kneser_ney(spark, str(TESTDATA / "sf0.01")).collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 100
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_blocks_split_texts_as_plain_python_does():
    texts = [t for _, t in fixture()] + ["\x1c a\x1fb \x85 c\xa0d", " lead", "trail ", "\t\x0b\x0c\r\n", "É É é İ ẞ", "A" * 5000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([False] * len(texts)), pa.array(texts)], ["id", "held_out", "text"])
    for limit in (1, 700, 1 << 20):
        got = []
        for block in kneser_ney.blocks(iter([batch.slice(0, 40), batch.slice(40)]), limit):
            ends = np.cumsum(block.lengths)
            got += [block.hashes[block.tokens[e - n : e]].tolist() for e, n in zip(ends, block.lengths)]
            assert len(set(block.hashes.tolist())) == len(block.hashes)
        expected = [[xxhash.xxh64_intdigest(b" " if w is None else w.encode()) for w in naive_words(t)] for t in texts]
        assert got == expected
