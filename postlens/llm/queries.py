"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postlens.llm import chat_format as chat
from postlens.llm.byte_bpe import byte_bpe_round_trip
from postlens.llm import decontamination as tests
from postlens.llm import line_quality as lines
from postlens.llm import periodic_runs as periodic
from postlens.llm.common import shared_folder
from postlens.llm.html_text import page_texts
from postlens.llm.kneser_ney import language_model_scores
from postlens.llm.language_id import language_id
from postlens.llm.secret_scan import secret_scan
from postlens.llm.sharding import read_shards, shard_digest, write_shards
from postlens.llm.simhash import simhash_near_duplicates
from postlens.llm.token_files import token_file_round_trip
from postlens.llm.whitening import whiten


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_quality(documents(spark, sf_dir))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    path = shared_folder(spark, "shards")
    write_shards(docs, path, shards=40)
    return shard_digest(read_shards(spark, path, docs.schema))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(documents(spark, sf_dir))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe_round_trip(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_file_round_trip(documents(spark, sf_dir), tokenizer, end_id=2)


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_duplicates(documents(spark, sf_dir))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return tests.decontamination_digest(tests.decontaminate(documents(spark, sf_dir), benchmark, near=tests.NEAR))


def kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(documents(spark, sf_dir), order=3)


def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_probe(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return chat.chat_digest(chat.format_conversations(turns))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = periodic.with_planted_periods(documents(spark, sf_dir))
    return periodic.runs_digest(periodic.periodic_runs(planted))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": languages,
        "op2_html_text": html_text,
        "op3_line_quality": line_quality,
        "op4_sharding": sharding,
        "op5_secret_scan": secrets,
        "op6_byte_bpe": byte_bpe,
        "op7_simhash_near_dedup": simhash,
        "op8_token_files": token_files,
        "op9_decontamination": decontamination,
        "op10_kneser_ney": kneser_ney,
        "op11_whitening": whitening,
        "op12_chat_format": chat_format,
        "op13_periodic_runs": periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_quality": lines.oracle_sql(),
        "op9_decontamination": tests.oracle_sql(),
        "op12_chat_format": chat.oracle_sql(),
    }
