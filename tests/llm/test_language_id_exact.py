from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from postlens.llm import language_id

SCHEMA = "doc_id bigint, text string, lang string"
SYLLABLES = {"aa": "ba be bi lo la", "bb": "ka ke ki lo la", "cc": "ta te ti ba lo", "dd": "zu zo za ka ta"}


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        word = lambda: "".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randint(1, 4)))
        rows.append((i, " ".join(word() for _ in range(rng.randint(1, 60))), lang))
    return rows


def naive_shares(rows):
    """Exact sets of n-grams by the same rule of rates, without a filter."""
    counts = {}
    for text, lang in {(t, lang) for _, t, lang in rows}:
        counts.setdefault(lang, Counter()).update(language_id.grams(text).tolist())
    rates = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    top = Counter()
    for own in rates.values():
        top |= Counter(own)
    return {
        lang: {g for g, r in own.items() if r >= max(language_id.LEAST_RATE, language_id.MIN_SHARE * top[g])}
        for lang, own in rates.items()
    }


def test_predictions_equal_exact_sets_but_for_false_positives(spark):
    rows = corpus(400)
    model = language_id.fit(spark.createDataFrame(rows, SCHEMA))
    sets = naive_shares(rows)
    assert model.languages == sorted(sets)
    asked = [t for _, t, _ in corpus(300, 2)] + ["lo la", "x", "ba"]
    differ = 0
    for text in asked:
        grams = language_id.grams(text).tolist()
        exact = np.array([sum(g in sets[name] for g in grams) / len(grams) for name in model.languages])
        counted = model.shares(text) * (1 - model.false_rate) + model.false_rate
        # The filter loses no n-gram; what it adds, it adds by false positives.
        assert (counted >= exact - 1e-9).all()
        differ += model.predict(text)[0] != model.languages[int(exact.argmax())]
    assert differ <= 0.01 * len(asked)


@pytest.mark.parametrize("slots", [1 << 10, 1 << 20])
def test_ties_go_to_the_first_language_by_name(spark, slots):
    rows = [(1, "same words here", "zz"), (2, "same words here", "yy"), (3, "same words here", "xx")]
    model = language_id.fit(spark.createDataFrame(rows, SCHEMA), slots=slots)
    assert model.predict("same words here")[0] == "xx"
    assert model.predict("@@ 12")[0] == language_id.UNKNOWN and model.predict("qqqqqq")[0] == "xx"


def test_one_more_text_changes_little(spark):
    """A least count that steps with the number of texts would drop what was seen once."""
    texts = [t for _, t, _ in corpus(200, 5)]
    base = corpus(101 * 4, 7)
    found = []
    for n in (99, 100, 101):
        rows = [r for lang in SYLLABLES for r in [x for x in base if x[2] == lang][:n]]
        model = language_id.fit(spark.createDataFrame(rows, SCHEMA))
        found.append(([model.predict(t)[0] for t in texts], [float(model._bits(model.masks, k).sum()) for k in range(4)]))
    for (names, sizes), (others, other_sizes) in zip(found, found[1:]):
        assert sum(a != b for a, b in zip(names, others)) <= 2
        assert all(abs(a - b) <= 0.05 * a for a, b in zip(sizes, other_sizes))
