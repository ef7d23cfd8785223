"""The corpus pipeline: stages from raw documents to token ids.

Each stage takes all documents that the one before kept and returns their columns; the
last returns the token ids.
"""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postlens.llm.byte_bpe import byte_bpe_round_trip
from postlens.llm.common import stored
from postlens.llm.decontamination import drop_contaminated
from postlens.llm.line_quality import clean_documents
from postlens.llm.secret_scan import redact_secrets
from postlens.llm.simhash import keep_one_per_group


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_local_folders: list[tempfile.TemporaryDirectory] = []


def ensure_checkpoint_folder(spark: SparkSession) -> None:
    """A local session without a checkpoint folder, as in tests, gets a temporary one. A cluster names its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.conf.get("spark.master", "").startswith("local"):
        _local_folders.append(tempfile.TemporaryDirectory(prefix="pipeline-"))
        spark.sparkContext.setCheckpointDir(_local_folders[-1].name)


def stage(function: Stage) -> Stage:
    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_checkpoint_folder(spark)
        return function(spark, docs, sf_dir)

    return run


# Executors have grown in the stages before, so their workers get less than for an encoding alone.
WORKER_CACHE_BYTES = 96 << 20


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail go, and documents that fail or lose too much."""
    return clean_documents(docs)


@stage
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return keep_one_per_group(docs)


@stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the table ``benchmark`` go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    return redact_secrets(docs)


@stage
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe_round_trip(docs, ranks, public_tokenizers.PATTERN, with_ids=True, cache_bytes=WORKER_CACHE_BYTES)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

# Fingerprints, a trained network and merges are beyond SQL; tests compare with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over the written result of the one before."""
    ensure_checkpoint_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stored(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
