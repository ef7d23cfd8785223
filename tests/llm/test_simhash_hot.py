from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from postlens.llm import simhash
from tests.llm.test_simhash import SCHEMA, corpus, naive_components


def test_a_hot_fingerprint_is_split(spark):
    keys = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("fingerprint")).repartition(4)
    assert simhash.hot_fingerprints(keys, 100) == [0]
    found = keys.select("fingerprint").distinct().withColumn("root", F.col("fingerprint"))
    joined = simhash.join_by_fingerprint(keys, found, 100)
    assert sorted(joined.columns) == ["fingerprint", "id", "root"]
    assert joined.count() == 3000 and joined.select("id").distinct().count() == 3000
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        parts = simhash.join_by_fingerprint(keys, found, 100).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in parts) == 3000 and max(r["count"] for r in parts) < 1000
    finally:
        for name in settings:
            spark.conf.unset(name)


@pytest.mark.parametrize("hot_rows", [0, 3])
def test_components_with_hot_fingerprints(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(simhash.join_by_fingerprint, "__defaults__", (hot_rows,))
    rows = corpus() + [(1000 + i, None) for i in range(50)] + [(2000 + i, "the same text") for i in range(50)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = sorted(map(repr, map(tuple, simhash.simhash_near_duplicates(docs).collect())))
    assert got == sorted(map(repr, naive_components(rows)))
    kept = simhash.keep_one_per_group(docs).count()
    assert kept == len({name for _, _, name in naive_components(rows)})


def test_a_very_long_text(spark):
    rng = random.Random(4)
    text = " ".join(f"w{rng.randrange(900)}" for _ in range(300_000))
    rows = [(1, text), (2, text + " end"), (3, "short"), (4, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, simhash.simhash_near_duplicates(docs).collect()))
    assert got == sorted(naive_components(rows))
