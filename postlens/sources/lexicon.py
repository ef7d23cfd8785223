"""Lexicon files, and the size checks that decide how a lexicon is matched."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import strip_whitespace


@dataclass(frozen=True)
class LexiconLimits:
    """Sizes that decide how a lexicon is matched.

    Up to ``plan_terms`` it is a list in the plan. Up to ``broadcast_bytes`` of text
    it is broadcast; the hash table takes a few times as much. Beyond, it is
    merge-joined; the per-post form first settles the ``frequent_terms`` most
    frequent tokens without a join.
    """

    plan_terms: int = 10_000
    broadcast_bytes: int = 32 * 1024 * 1024
    frequent_terms: int = 10_000


def load_lexicon(
    spark: SparkSession,
    path: str,
    *,
    comment: str | None = None,
    distinct: bool = False,
    normalize: bool = False,
) -> DataFrame:
    """One term per line, stripped of outer whitespace, without blank lines.

    ``comment`` drops lines that start with it, ``distinct`` drops repeated terms
    and ``normalize`` reduces terms to lower-case ASCII letters and digits, as the
    token clean-up does, so that hyphenated terms can match.
    """
    terms = spark.read.text(path).select(strip_whitespace(F.col("value")).alias("term"))
    if comment is not None:
        terms = terms.filter(~F.col("term").startswith(comment))
    if normalize:
        terms = terms.select(F.lower(F.regexp_replace("term", r"\P{Alnum}+", "")).alias("term"))
    terms = terms.filter(F.length("term") > 0)
    return terms.distinct() if distinct else terms


def terms_if_few(terms: DataFrame, limits: LexiconLimits = LexiconLimits()) -> list[str] | None:
    """The terms as a list, or None if the plan should not hold as many.

    Fetches at most one row more than the limit.
    """
    rows = terms.limit(limits.plan_terms + 1).collect()
    return None if len(rows) > limits.plan_terms else [row[0] for row in rows]


def may_broadcast(terms: DataFrame, limits: LexiconLimits = LexiconLimits()) -> bool:
    """Whether the measured size of the terms is under the broadcast limit."""
    size = terms.agg(F.sum(F.octet_length(terms.columns[0]) + F.lit(16))).first()[0]
    return (size or 0) <= limits.broadcast_bytes
