from __future__ import annotations

import numpy as np
import pytest

from postlens.llm import kneser_ney


def test_rows_come_in_small_batches(spark, monkeypatch):
    """The conf holds while the model is learned and scored, and not after."""
    before, seen = spark.conf.get(kneser_ney.MAX_BATCH), []
    stored = kneser_ney.stored

    def noted(*args, **kwargs):
        seen.append(spark.conf.get(kneser_ney.MAX_BATCH))
        return stored(*args, **kwargs)

    monkeypatch.setattr(kneser_ney, "stored", noted)
    docs = spark.createDataFrame([(i, f"a b c{i % 7} d") for i in range(40)], "doc_id bigint, text string")
    assert kneser_ney.language_model_scores(docs, order=3).count() == 40
    assert seen and set(seen) == {f"{kneser_ney.BATCH_BYTES}b"}
    assert spark.conf.get(kneser_ney.MAX_BATCH) == before


@pytest.mark.parametrize("top", [3, 1 << 40, 1 << 63])
@pytest.mark.parametrize("n", [0, 1, 1000])
def test_different_keys(top, n):
    keys = np.random.default_rng(1).integers(0, top, n, np.uint64, endpoint=True)
    order, first, place = kneser_ney._distinct(keys)
    different, own = np.unique(keys, return_inverse=True)
    assert (keys[order][first] == different).all() and (place == own).all() and sorted(order) == list(range(n))
