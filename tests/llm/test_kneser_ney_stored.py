from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest

from postlens.llm import arrays, kneser_ney
from postlens.llm.common import shared_folder


def local(folder):
    return Path(folder.removeprefix("file://").removeprefix("file:"))


def size(folder, pattern="*"):
    return sum(path.stat().st_size for path in local(folder).glob(pattern))


@pytest.mark.parametrize(("rows", "most"), [(1, 7.2), (5, 9.2)])
def test_an_ngram_takes_six_bytes_and_its_values(spark, rows, most):
    rng = np.random.default_rng(rows)
    hashes = np.unique(rng.integers(3 << 57, 4 << 57, 50_000, np.uint64))  # of one of 128 parts
    values = rng.integers(0, 4, (rows, len(hashes)), np.uint64)
    folder = shared_folder(spark, "test-stored")
    kneser_ney.save_grams(folder, 3, 0, hashes, values)
    assert size(folder) < most * len(hashes)
    assert (kneser_ney.load_values(folder, 3, 0, hashes, rows) == values).all()
    assert not kneser_ney.load_values(folder, 3, 0, np.setdiff1d(hashes ^ np.uint64(1), hashes), rows).any()


def test_a_word_takes_seventeen_bytes(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j} hot" for j in range(500 * i, 500 * i + 500))) for i in range(40)], "doc_id bigint, text string")
    folder = shared_folder(spark, "test-words")
    model = kneser_ney.fit(kneser_ney.training_rows(docs, "doc_id", "text", 7, 2), 2, folder)
    stored = sum(size(folder, f"{name}-*") for name in ("words", "counts", "small-margins", "large-margins", "margins"))
    assert stored < 17 * model.vocabulary.size + 2000
    hot = np.flatnonzero(arrays.load(folder, "counts-0") > 1)  # and the end
    _, after, _ = model.words(hot)
    assert len(hot) == 2 and after.max() > 10_000


def test_order_of_keys_that_differ_in_their_last_bits():
    rng = np.random.default_rng(2)
    for low in (0, 1 << 63):
        keys = np.uint64(low) + rng.integers(0, 500, 3000, np.uint64)
        order, ordered = kneser_ney._sorted(keys)
        expected = np.argsort(keys, kind="stable")
        assert (order == expected).all() and (ordered == keys[expected]).all()
    order, ordered = kneser_ney._sorted(np.empty(0, np.uint64))
    assert not len(order) and not len(ordered)
