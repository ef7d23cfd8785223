from __future__ import annotations

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from postlens.llm import chat_format as chat
from postlens.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, `a.b` int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def escape(text):
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def naive(rows):
    """conv_id -> (turns, formatted text, loss texts)"""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    result = {}
    for conv, turns in convs.items():
        turns.sort()
        pairs = [(role, text) for *_, role, text in turns]
        out = ""
        for i, (role, text) in enumerate(pairs):
            if i and pairs[i - 1][0] == role:
                out += "<|im_more|>" + escape(text)
            else:
                out += ("<|im_end|>\n" if i else "") + "<|im_start|>" + escape(role) + "<|im_sep|>" + escape(text)
        result[conv] = (pairs, out + "<|im_end|>\n", [t for r, t in pairs if r == "assistant"])
    return result


def rows():
    rng = random.Random(3)
    parts = ["<|", "\\", "<\\|", "|>", "<", "|", "im_end", "<|im_end|>\n", "<|im_more|>", "é", "😀", "\n", " ", "a", "<|im_sep|>"]
    made = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, None, "x"), (1, 3, "", "y"),
        (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (2, 0, "assistant", "b"), (2, None, "user", "first"),
        (None, 1, "assistant", "of nobody"), (None, 0, "user", "q"),
        (3, 5, "role<|im_sep|>", chat.PROBE_TEXT), (4, 0, "assistant", "long " * 50_000),
    ]
    for conv in range(10, 60):
        for turn in range(rng.randint(1, 12)):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
            made.append((conv, turn, rng.choice(["user", "assistant", "system", "<|\\"]), text))
    for turn in range(-40, 260):  # a hot conversation, out of order, with ties and a NULL
        made.append((7, (turn * 7919) % 200 - 20 if turn else None, rng.choice(["user", "assistant"]), f"t{turn} <|"))
    rng.shuffle(made)
    return made


def table(spark, data):
    return spark.createDataFrame([(*r, "no", 1) for r in data], SCHEMA).repartition(4)


@pytest.mark.parametrize("hot_turns, block_turns", [(4096, 1024), (8, 16)])
def test_formatted_texts_and_spans(spark, hot_turns, block_turns):
    data = rows()
    found = chat.format_conversations(table(spark, data), hot_turns=hot_turns, block_turns=block_turns)
    got = {r["conv_id"]: r for r in found.collect()}
    expected = naive(data)
    assert got.keys() == expected.keys()
    for conv, (turns, text, loss) in expected.items():
        row = got[conv]
        assert row["formatted"] == text
        assert [text[s["start"] : s["end"]] for s in row["loss_spans"]] == [escape(x) for x in loss]
        assert all(text[at:].startswith("<|im_start|>") for at in row["message_starts"])
        assert len(row["message_starts"]) == text.count("<|im_start|>")


@pytest.mark.parametrize("hot_turns", [4096, 8])
def test_digest_is_of_the_given_turns(spark, hot_turns):
    data = rows()
    found = chat.chat_digest(chat.format_conversations(table(spark, data), hot_turns=hot_turns, block_turns=16)).collect()
    expected = naive(data)
    assert len(found) == len(expected)
    for row in found:
        turns, text, loss = expected[row["conv_id"]]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len("".join(loss)), sha("".join(loss)))
        assert row["formatted_chars"] == len(text)


def test_query_equals_sql_and_adds_the_probe(spark, tmp_path):
    data = rows()
    path = str(tmp_path / "conversations.parquet")
    table(spark, data).write.parquet(path)
    found = queries.queries()["op12_chat_format"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    names = sorted(found.columns)
    expected = con.sql(f"SELECT {', '.join(names)} FROM ({chat.oracle_sql()})").fetchall()
    got = [tuple(r) for r in found.select(*names).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    probe = found.filter("conv_id = -7").first()
    assert probe["n_turns"] == 2 and probe["loss_sha256"] == sha(r"\### Assistant: </turn> ok")


def test_empty_table_and_other_template(spark):
    none = table(spark, rows()).limit(0)
    assert chat.chat_digest(chat.format_conversations(none)).count() == 0
    template = chat.ChatTemplate("<|turn|>", "<|:|>", "<|+|>", "<|/|>", ("user", "assistant"))
    data = [(1, 0, "user", "a<|+|>"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]
    row = chat.format_conversations(table(spark, data), template=template).first()
    assert row["formatted"] == "<|turn|>user<|:|>a<\\|+|><|+|>b<|/|><|turn|>assistant<|:|>c<|/|>"
    assert len(row["loss_spans"]) == 3
    for wrong in [{"begin": "x"}, {"end": "<|a<|"}, {"more": "<|im_sep|>"}, {"more": "<|im_sep|>x"}, {"end": "<|x<"}]:
        with pytest.raises(ValueError):
            chat.ChatTemplate(**wrong)


def test_escaping_is_reversible(spark):
    texts = ["", "\\", "<|", "<\\|", "\\<|", "<\\\\|", "\\\\<|\\", "<<||", "<|<|", "a\\\\b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for row in df.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert row["u"] == row["t"] and "<|" not in row["e"]
