from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postlens.llm import line_quality

SCHEMA = "doc_id bigint, text string, words string, row int, n_chars bigint"
PROSE = """The harbour lay quiet under a grey and heavy sky.
Two boats came in before noon, and nobody went out to meet them.
By evening all of the village knew what they had brought."""
FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def naive_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed


def table(spark, texts):
    rows = [(i, t, "x", 1, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def test_base_measures_of_odd_texts(spark):
    texts = [
        None, "", " \t\n", "one", "a b c d e", "a b c d e a b c d e", "a " * 40, "é🙂 # | x\x0by\x1cz\xa0w " * 3,
        "same line.\nsame line.\n\n \nother\nsame line.", PROSE, PROSE + "\n" + PROSE, "w" * 50_000,
        " ".join(f"w{i}" for i in range(20_000)), "x\ry\r\nz\n" * 4, " lead tail ",
    ]
    got = line_quality.line_quality(table(spark, texts)).orderBy("doc_id").collect()
    expected = [naive_base(t) if len(t or "") < 10_000 else None for t in texts]
    for row, base, text in zip(got, expected, texts):
        if base:
            assert tuple(row[f] for f in FIELDS) == base, text
        assert not (row["base_failed"] and row["kept"])
    assert got[12]["n_words"] == 20_000 and got[12]["n_repeat_words"] == 0


@settings(deadline=None, max_examples=3)
@given(st.lists(st.text(alphabet="ab \n#", max_size=60), min_size=20, max_size=40))
def test_base_measures_of_random_texts(spark, texts):
    got = line_quality.line_quality(table(spark, texts)).orderBy("doc_id").collect()
    assert [tuple(r[f] for f in FIELDS) for r in got] == [naive_base(t) for t in texts]


@pytest.mark.parametrize(
    ("line", "passes"),
    [
        ("A sentence that ends as it should.", True), ("Is it so?  ", True), ('He said "so be it."', True),
        ("No end to this line", False), ("Home | About | News | Contact us.", False), ("A | b.", False),
        ("STOP!! NOW!! YOU!!", False), ("What### a*** mess%%% this is.", False), ("Licensed under CC BY-NC 4.0.", False),
        ("He spoke of the privacy policy for a long while, and " * 6 + "so on.", True), ("", False),
    ],
)
def test_line_rules(spark, line, passes):
    df = spark.createDataFrame([(line,)], "x string")
    assert df.select(line_quality.line_passes(df["x"])).first()[0] is passes


def test_documents_that_lose_too_much_go(spark):
    texts = [PROSE, PROSE + "\nMenu | Home | About | More", "a bad line without an end " * 3 + "\n" + "Fine.", PROSE + "\n" + PROSE, None]
    cleaned = line_quality.clean_documents(table(spark, texts))
    assert cleaned.columns == ["doc_id", "text", "words", "row", "n_chars"]
    got = {r["doc_id"]: r for r in cleaned.collect()}
    assert sorted(got) == [0, 1]
    assert got[0]["text"] == got[1]["text"] == PROSE
    assert got[1]["n_chars"] == len(PROSE) and got[1]["words"] == "x" and got[1]["row"] == 1


def test_no_python_and_no_shuffle(spark):
    plan = line_quality.line_quality(table(spark, [PROSE]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_empty_table_and_repeated_rows(spark):
    assert line_quality.line_quality(table(spark, [PROSE]).limit(0)).collect() == []
    assert line_quality.clean_documents(table(spark, [PROSE]).limit(0)).collect() == []
    twice = table(spark, [PROSE]).union(table(spark, [PROSE]))
    assert line_quality.line_quality(twice).count() == 2
