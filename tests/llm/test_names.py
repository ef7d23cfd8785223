"""Columns whose names hold dots, in every operator that carries whole rows or names columns."""

from __future__ import annotations

import public_tokenizers
import pytest

from postlens.llm import byte_bpe, chat_format, decontamination, html_text, kneser_ney, language_id, line_quality
from postlens.llm import periodic_runs, secret_scan, sharding, simhash, token_files, whitening
from postlens.llm.common import shared_folder
from tests.llm.test_line_quality import PROSE

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "`doc.id` bigint, `the.text` string, lang string, `a.b` string, `row.text` string, n_chars bigint"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, PROSE.replace("boats", f"boats{i} and token=abcdef{i}") if i % 3 else None, "en", "x", "y", 5) for i in range(1, 9)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    "stage",
    [
        lambda docs, bench: line_quality.clean_documents(docs, "the.text"),
        lambda docs, bench: simhash.keep_one_per_group(docs, "doc.id", "the.text"),
        lambda docs, bench: decontamination.drop_contaminated(docs, bench, text="the.text", item="item.id", item_text="the.text"),
        lambda docs, bench: secret_scan.redact_secrets(docs, "the.text"),
    ],
)
def test_whole_rows_stay(spark, docs, stage):
    bench = spark.createDataFrame([(1, "nothing of the kind")], "`item.id` bigint, `the.text` string")
    result = stage(docs, bench)
    assert result.columns == docs.columns
    assert all(r["a.b"] == "x" and r["row.text"] == "y" for r in result.collect()) and result.count() > 0


def test_ids_and_texts_with_dots(spark, docs):
    n = docs.count()
    names = {"id": "doc.id", "text": "the.text"}
    assert line_quality.line_quality(docs, **names).count() == n
    assert simhash.simhash_near_duplicates(docs, **names).count() == n
    assert secret_scan.secret_scan(docs, **names).count() == n
    assert language_id.language_id(docs, lang="lang", **names).count() == n
    assert byte_bpe.byte_bpe_round_trip(docs, RANKS, PATTERN, **names).count() == n
    assert token_files.token_file_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), 2, **names).count() == n
    assert kneser_ney.language_model_scores(docs, **names).count() == n
    assert html_text.page_texts(docs, "doc.id", "a.b", "the.text").count() == n
    assert periodic_runs.periodic_runs(periodic_runs.with_planted_periods(docs, **names)).count() == n
    path = shared_folder(spark, "names")
    sharding.write_shards(docs, path, 3, **names)
    assert sharding.read_shards(spark, path, docs.schema).count() == n
    turns = docs.selectExpr("`doc.id` AS `conv.id`", "n_chars AS `the.turn`", "lang AS `the.role`", "`the.text`")
    formatted = chat_format.format_conversations(turns, "conv.id", "the.turn", "the.role", "the.text")
    assert chat_format.chat_digest(formatted, "conv.id").count() == n
    vectors = docs.selectExpr("`doc.id`", "array(float(`doc.id`), float(`doc.id` % 3)) AS `the.vector`")
    assert whitening.whiten(vectors, "doc.id", "the.vector").count() == 2 * n
