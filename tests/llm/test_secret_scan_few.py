from __future__ import annotations

import random

import pytest

from postlens.llm import secret_scan

SCHEMA = "doc_id bigint, text string"
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def corpus(secrets, seed=3):
    """Prose with dates, numbers and names, and as many texts with a secret that a pattern finds."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9)))
    prose = lambda: " ".join(word() for _ in range(12))
    rows = []
    for i in range(120):
        odd = rng.choice([f"20{rng.randint(10, 99)}-1{rng.randint(0, 2)}-2{rng.randint(0, 9)}", f"room{rng.randint(1000, 99999)}", f"{rng.randint(10**8, 10**9)}"])
        rows.append((i, f"{prose()} {odd} {prose()}"))
    for i in range(secrets):
        low, high, any_case = ("".join(rng.choice(x) for _ in range(32)) for x in ("0123456789abcdef", LETTERS[26:], LETTERS))
        found = rng.choice([f"password={low}", low, f"AKIA{high}", f"token: {any_case}"])
        rows.append((1000 + i, f"{prose()} {found} {prose()}"))
    return rows


def key(rng, kind, n):
    if kind == "mixed":
        return "".join(rng.choice(LETTERS) for _ in range(n))
    if kind == "hex":
        return "".join(rng.choice("0123456789ABCDEF") for _ in range(n))
    return "-".join("".join(rng.choice("0123456789abcdef") for _ in range(8)) for _ in range(n // 8))


def network_finds(scanner, rng, kind, n, tries=100):
    prose = corpus(0, 9)
    hits = 0
    for i in range(tries):
        secret = key(rng, kind, n)
        text = f"{prose[i % 100][1]} key {secret} {prose[(i + 1) % 100][1]}"
        begin = text.index(secret)
        hits += any(b <= begin and e >= begin + n for b, e, _ in scanner.scan_all([text])[0])
    return hits / tries


@pytest.mark.parametrize("secrets", [1, 2, 3, 19, 20, 21])
def test_a_network_learns_from_any_number_of_findings(spark, secrets):
    scanner = secret_scan.fit(spark.createDataFrame(corpus(secrets), SCHEMA))
    assert scanner.network is not None and 0 < scanner.network.threshold <= 1
    again = secret_scan.fit(spark.createDataFrame(corpus(secrets), SCHEMA).repartition(7))
    texts = [t for _, t in corpus(5, 4)]
    assert scanner.scan_all(texts) == again.scan_all(texts)


def test_spans_do_not_jump_between_19_and_21_findings(spark):
    texts = [t for _, t in corpus(40, 5)]
    found = []
    for secrets in (19, 20, 21):
        spans = secret_scan.fit(spark.createDataFrame(corpus(secrets), SCHEMA)).scan_all(texts)
        assert all(s in own for own, t in zip(spans, texts) for s in secret_scan.base_spans(t))
        found.append(sum(s[2] == 3 for own in spans for s in own))
    assert max(found) - min(found) <= 0.25 * len(texts)


def test_no_findings_or_nothing_else_gives_no_network(spark):
    assert secret_scan.fit(spark.createDataFrame(corpus(0), SCHEMA)).network is None
    only = [(1, "password=" + "ab12" * 5)]
    assert secret_scan.fit(spark.createDataFrame(only, SCHEMA)).network is None


def test_planted_keys_are_found(spark):
    scanner = secret_scan.fit(spark.createDataFrame(corpus(300), SCHEMA))
    rng = random.Random(1)
    recall = {kind: network_finds(scanner, rng, kind, 32) for kind in ("hex", "dashed", "mixed")}
    clean = [t for _, t in corpus(0, 77)]
    wrong = sum(bool(s) for s in scanner.scan_all(clean)) / len(clean)
    print(recall, wrong, scanner.network.threshold, scanner.network.precision, scanner.network.recall)
    assert all(share >= 0.5 for share in recall.values()), recall
    assert wrong <= 0.1


@pytest.mark.parametrize("text", ["", "abc1", "é日1_ß", "퟿1\U0001f642²Ⅷx"])
def test_codes_of_characters(text):
    expected = bytes(ord(c) if c < "\x80" else 128 + (not c.isalpha()) for c in text)
    assert secret_scan.codes_of(text) == expected
