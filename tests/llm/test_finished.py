"""Operators delete the tables that nothing reads any more."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from postlens.llm import decontamination, language_id, secret_scan, simhash, token_files, whitening
from postlens.llm.common import finished, stored
from tests.llm.test_simhash import SCHEMA, corpus


def folders(spark):
    return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}


def test_tables_go_at_the_end_of_the_block(spark):
    before = folders(spark)
    with finished(spark) as keep:
        table = keep(spark.range(5).toDF("id"), "test")
        assert table.count() == 5 and len(folders(spark) - before) == 1
        kept = stored(table.filter("id > 1"), "kept")
    assert len(folders(spark) - before) == 1 and kept.count() == 3
    with pytest.raises(RuntimeError), finished(spark) as keep:
        keep(spark.range(5).toDF("id"), "test")
        raise RuntimeError
    assert len(folders(spark) - before) == 1


def test_stored_restores_the_setting(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    table = stored(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    assert spark.conf.get(name) == before and table.count() == 7


def left_by(spark, run):
    before = folders(spark)
    run()
    return sorted(name.split("-")[1] for name in folders(spark) - before)


def test_what_operators_leave(spark):
    rows = [(*r, "x", 1) for r in corpus()]
    docs = spark.createDataFrame(rows, SCHEMA)
    bench = spark.createDataFrame([(1, "w1 w2"), (2, "one two three four")], "item_id bigint, text string")
    vectors = docs.selectExpr("doc_id", "array(float(doc_id), float(length(text))) AS v")
    assert left_by(spark, lambda: simhash.simhash_near_duplicates(docs)) == ["components", "fingerprints"]
    assert left_by(spark, lambda: decontamination.decontaminate(docs, bench, near=26)) == ["candidates"]
    assert left_by(spark, lambda: whitening.whiten(vectors, "doc_id", "v")) == []
    assert left_by(spark, lambda: language_id.fit(docs, "text", "fingerprint")) == []
    assert left_by(spark, lambda: secret_scan.fit(docs)) == []
    tokens = lambda: token_files.token_file_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert left_by(spark, tokens) == ["token"]
