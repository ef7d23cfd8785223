from __future__ import annotations

import numpy as np
import pytest

from postlens.llm import secret_scan


def test_recall_holds_where_labels_overlap(monkeypatch):
    rng = np.random.default_rng(5)
    labels = np.arange(2000) % 10 == 0
    net = secret_scan.CharacterNetwork()
    logits = rng.normal(0, 1, len(labels)) + labels
    monkeypatch.setattr(net, "logits", lambda codes: logits[codes[:, 0]])
    codes = np.arange(len(labels))[:, None]
    net.calibrate(codes, labels, 0.95)
    found = net.probability(codes) >= net.threshold
    assert net.threshold < 0.5
    assert 0.95 <= found[labels].mean() < 0.96
    assert net.recall == found[labels].mean() and net.precision == pytest.approx(labels[found].mean())
    net.calibrate(codes, labels, 0.95, (0.5, 1.0))
    right, wrong = found[labels].sum(), found[~labels].sum()
    assert net.precision == pytest.approx(right / (right + 2 * wrong))
