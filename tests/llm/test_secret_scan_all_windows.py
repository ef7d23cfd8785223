from __future__ import annotations

import random

import numpy as np

from postlens.llm import secret_scan
from tests.llm.test_secret_scan_few import SCHEMA, corpus, network_finds


def windows_of(rows):
    """All different windows in order, and whether a pattern's match meets them."""
    found = {}
    for _, text in rows:
        base = secret_scan.base_spans(text)
        for c in secret_scan.candidates(text):
            for place in secret_scan.windows(text, *c):
                w = secret_scan.window(text, *place)
                found[w] = found.get(w, False) or secret_scan.overlaps(base, *place)
    made = sorted(found)
    return np.frombuffer(b"".join(made), np.uint8).reshape(len(made), -1), np.array([found[w] for w in made])


def test_the_threshold_comes_from_all_held_out_windows(spark):
    rows = corpus(6000)
    codes, labels = windows_of(rows)
    assert labels.sum() > 5000
    network = secret_scan.fit(spark.createDataFrame(rows, SCHEMA)).network
    held = np.sort(network.probability(codes[labels][::4]))
    assert abs(network.threshold - held[int(0.05 * len(held) + 1e-9)]) < 1e-6
    assert abs(network.recall - (held >= network.threshold).mean()) < 2 / len(held)


def test_parts_learn_together(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "PART_WINDOWS", 64)
    rows = corpus(300)
    codes, labels = windows_of(rows)
    trained = []
    gathered = secret_scan._of_parts

    def of_parts(parts, ranks, work, fields):
        trained.append(parts.select("part", "positive", "negative").collect())
        return gathered(parts, ranks, work, fields)

    monkeypatch.setattr(secret_scan, "_of_parts", of_parts)
    scanner = secret_scan.fit(spark.createDataFrame(rows, SCHEMA))
    assert len(trained[0]) > 4
    assert (sum(r["positive"] for r in trained[0]), sum(r["negative"] for r in trained[0])) == (labels.sum(), (~labels).sum())
    again = secret_scan.fit(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert scanner.network.threshold == again.network.threshold
    rng = random.Random(1)
    assert min(network_finds(scanner, rng, kind, 32) for kind in ("hex", "dashed", "mixed")) >= 0.5
    assert sum(bool(s) for s in scanner.scan_all([t for _, t in corpus(0, 77)])) <= 12


def test_a_kth_logit_is_exact():
    rng = np.random.default_rng(4)
    for x in (rng.normal(0, 3, 5000).astype(np.float32), np.repeat(np.float32([1, 2, 1e6]), [900, 60, 40])):
        labels = rng.random(len(x)) < 0.6
        pieces = [(x[i::3], labels[i::3]) for i in range(3)]
        own = np.sort(x[labels])
        for k in (0, 1, len(own) // 20, len(own) - 1):
            over = lambda work: [work(*piece) for piece in pieces]
            assert secret_scan._kth_positive(over, k, own[0], own[-1]) == own[k]
