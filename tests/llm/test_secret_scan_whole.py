from __future__ import annotations

import numpy as np

from postlens.llm import secret_scan
from tests.llm.test_secret_scan import fixture, table

KEY = "AKIAQ2W3E4R5T6Y7U8I"  # one character too short for the pattern


def test_the_window_reads_all_of_a_long_candidate(spark):
    scanner = secret_scan.fit(table(spark, fixture()))
    path = "/".join(["usr", "local", "share", "doc", "lists", "more", "pages", "parts", "tables"]) + "/"
    assert len(path) > secret_scan.INSIDE
    for text in (f"see {path}{KEY} there", path * 4 + KEY):
        (spans,) = scanner.scan_all([text])
        assert [(KEY in text[b:e], k) for b, e, k in spans] == [(True, 3)]
    assert scanner.scan_all([f"see {path} there"]) == [[]]


def test_sliding_gives_the_highest_of_all_windows():
    net, rng = secret_scan.CharacterNetwork(3), np.random.default_rng(2)
    net.slope, net.shift = 1.0, 0.0
    for n, before, after in ((41, 0, 0), (100, 7, 3), (9000, 30, 30)):
        body = "".join(map(chr, rng.integers(97, 123, n)))
        text = "é " * before + body + " -" * after
        begin, end = 2 * before, 2 * before + n
        places = range(begin, end - secret_scan.CANDIDATE_CHARS + 1)
        codes = [secret_scan.window(text, at, min(end, at + secret_scan.INSIDE)) for at in places]
        expected = net.probability(np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)).max()
        assert abs(net.highest(text, begin, end) - expected) < 1e-5


def test_training_windows_cover_a_candidate():
    for n in (12, 40, 41, 80, 95):
        places = secret_scan.windows("x" * 200, 10, 10 + n)
        assert {i for b, e in places for i in range(b, e)} == set(range(10, 10 + n))


def judged(text):
    return [text[b:e] for b, e in secret_scan.pieces(text, secret_scan.base_spans(text))]


def test_what_matches_leave_of_a_run_is_judged():
    part = "0123456789abcdef01234567"
    assert judged(f"a XyZ+{part}QQ== b") == ["XyZ+", "QQ=="]
    assert judged(f"Xy{part}/Z/{part}") == ["Xy", "/Z/"]
    assert judged("my_token=abcdef and other1234567890") == ["my_", "other1234567890"]
    assert judged("AKIA" + "B" * 16 + "xy") == ["xy"]
    assert judged(part) == []


def test_long_runs_without_digits_are_candidates():
    found = lambda text: [text[b:e] for b, e in secret_scan.candidates(text)]
    key = "QwErTyUiOpAsDfGhJkLzXcVb"
    assert found(f"a1b2c3d4e5f6g7 {key} {key.lower()} {key.lower()[:-1]}") == ["a1b2c3d4e5f6g7", key, key.lower()]
    assert found("abcDEFghiJKLmnopqr hunter2x9 iPhoneOwner McDonald hunter2 CapitalsOnly PLAINCAPITALS") == [
        "abcDEFghiJKLmnopqr", "hunter2x9", "CapitalsOnly"
    ]
    assert found(f"{key}1 1{key}") == [f"{key}1", f"1{key}"]
