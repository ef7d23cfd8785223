from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from pathlib import Path

import pytest

from postlens.llm import kneser_ney, queries
from postlens.llm.common import shared_folder
from tests.conftest import TESTDATA
from tests.llm.test_kneser_ney import fixture, naive_discounts, naive_words, rounded, table


@pytest.fixture(autouse=True)
def few_turns(monkeypatch):
    """More jobs than these small tables need would only take time; one test has several turns."""
    monkeypatch.setattr(kneser_ney, "TURNS", 1)


def naive_scores(rows, order, asked=None):
    """The recursive formulas, with as many begin marks before each text as the context is long."""
    is_held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    words, counts = Counter(), {k: Counter() for k in range(1, order + 1)}

    def grams(tokens):
        padded = ["<s>"] * (order - 1) + tokens
        return [tuple(padded[i : i + order]) for i in range(len(tokens))]

    for i, text in rows:
        if not is_held(i):
            words.update(naive_words(text))
            counts[order].update(grams(naive_words(text)))
    for k in range(order - 1, 0, -1):
        counts[k].update(g[1:] for g in counts[k + 1])
    discounts = {k: naive_discounts(c.values()) for k, c in counts.items()}
    following = {}
    for k, c in counts.items():
        for g, n in c.items():
            following.setdefault(g[:-1] if k > 1 else (), []).append((n, discounts[k][min(n, 3)]))

    def probability(g):
        context, k = g[:-1], len(g)
        below = probability(g[1:]) if k > 1 else 1 / (len(words) + 1)
        if context not in following:
            return below
        total, n = sum(n for n, _ in following[context]), counts[k].get(g, 0)
        rest = sum(d for _, d in following[context])
        return max(n - discounts[k][min(n, 3)], 0) / total + rest / total * below

    for context in list(counts[order])[:3]:
        assert abs(sum(probability((*context[:-1], w)) for w in [*words, "never seen"]) - 1) < 1e-9
    n, size = sum(words.values()), len(words)
    for i, text in rows if asked is None else asked:
        tokens = naive_words(text)
        base = sum(math.log10((words[t] + 1) / (n + size + 1)) for t in tokens)
        score = sum(math.log10(probability(g)) for g in grams(tokens))
        yield (i, is_held(i), len(tokens), sum(words[t] > 0 for t in tokens), n, round(base, 6), round(score, 6))


@pytest.mark.parametrize(("order", "block_bytes"), [(3, 500), (3, 1 << 24), (4, 2000)])
def test_scores_of_higher_orders_equal_the_formulas(spark, order, block_bytes, monkeypatch):
    rows = fixture()
    monkeypatch.setattr(kneser_ney, "BLOCK_BYTES", block_bytes)
    got = kneser_ney.language_model_scores(table(spark, rows).repartition(3), order=order).collect()
    assert rounded(map(tuple, got)) == rounded(naive_scores(rows, order))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_a_stored_model_scores_texts_that_were_not_counted(spark, order):
    rows = fixture()
    model = kneser_ney.fit(kneser_ney.training_rows(table(spark, rows), "doc_id", "text", 7, 2), order, shared_folder(spark, "model"), 400)
    assert model.vocabulary.parts > 5
    rng = random.Random(order)
    words = ["the", "of", "é", "new", "w1", "w2", "w3", "w7", "newer"]
    asked = [(1000 + i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(60)] + [(2000, None), (2001, rows[5][1])]
    for _ in range(2):  # the model stays
        others = kneser_ney.training_rows(table(spark, asked).repartition(3), "doc_id", "text", 7, 2)
        got = [(*r[:4], model.vocabulary.tokens, *r[4:]) for r in kneser_ney.score(others, model).collect()]
        assert rounded(got) == rounded(naive_scores(rows, order, asked))


@pytest.mark.parametrize("order", [2, 3])
def test_small_parts_change_no_score(spark, order, monkeypatch):
    rows = fixture()
    monkeypatch.setattr(kneser_ney, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(kneser_ney, "TURNS", 3)
    whole = kneser_ney.language_model_scores(table(spark, rows), order=order)
    parts = kneser_ney.language_model_scores(table(spark, rows).repartition(4), order=order, part_bytes=300)
    assert rounded(map(tuple, whole.collect())) == rounded(map(tuple, parts.collect()))


def test_parts_follow_the_size_of_the_training_texts(spark):
    rows = kneser_ney.training_rows(table(spark, [(i, "x" * 999) for i in range(50)] + [(None, None)]), "doc_id", "text", 7, 2)
    trained = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in range(50))
    assert kneser_ney.part_number(rows, 1000) == trained
    assert kneser_ney.part_number(rows) == 1 and kneser_ney.part_number(rows.limit(0)) == 1


def test_intermediate_tables_and_the_model_are_deleted(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    scores = kneser_ney.language_model_scores(table(spark, fixture()), order=3)
    assert {p.name.split("-")[1] for p in set(folder.iterdir()) - before} == {"scores"}
    assert scores.count() == len(fixture())


def test_a_very_long_text(spark):
    rng = random.Random(1)
    rows = [(0, " ".join(f"w{rng.randrange(500)}" for _ in range(200_000))), (1, "w1 w2 w3")]
    got = kneser_ney.language_model_scores(table(spark, rows), order=3).collect()
    assert rounded(map(tuple, got)) == rounded(naive_scores(rows, 3))


def test_no_rows_and_no_training_at_order_3(spark):
    docs = table(spark, [(0, "a b")])
    assert kneser_ney.language_model_scores(docs.limit(0), order=3).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = kneser_ney.language_model_scores(table(spark, [(held, "a b")]), order=3).collect()
    assert tuple(row) == (held, True, 3, 0, 0, 0.0, 0.0)


def test_query_sees_two_words_of_context(spark):
    folder = str(TESTDATA / "sf0.01")
    scores = {r["doc_id"]: r["score"] for r in queries.kneser_ney(spark, folder).collect()}
    bigrams = kneser_ney.language_model_scores(queries.documents(spark, folder)).filter("NOT held_out").collect()
    assert sum(scores[r["doc_id"]] for r in bigrams) > sum(r["score"] for r in bigrams)
