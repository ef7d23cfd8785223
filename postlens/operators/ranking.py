"""Counting and top-k operators.

Each is one map-side partial count, one shuffle of the partial counts and a heap
of k rows per task, so a group that holds most of the rows costs no more than
any other: only one partial row per group leaves each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions import as_list, column_of, columns_of, mentions, words


def top_k(
    df: DataFrame,
    measure: str,
    keys: str | Sequence[str],
    *,
    k: int | None,
    ascending: bool = False,
) -> DataFrame:
    """Order by a measure and keep k rows (all if ``k`` is None); ties go to the lower key."""
    by = column_of(df, measure)
    ordered = df.orderBy(by.asc() if ascending else by.desc(), *[key.asc() for key in columns_of(df, keys)])
    return ordered if k is None else ordered.limit(k)


def top_groups(
    df: DataFrame, group: str | Sequence[str], *, k: int | None = 10, out: str = "count"
) -> DataFrame:
    """The k groups with most rows."""
    keys = as_list(group)
    counted = df.groupBy(*columns_of(df, keys)).agg(F.count("*").alias(out))
    return top_k(counted, out, keys, k=k)


def active_actors(
    df: DataFrame,
    actor: str,
    *,
    sentinel: object = "[deleted]",
    k: int | None = 10,
    out: str = "count",
) -> DataFrame:
    """The k actors with most rows, without the sentinel actor and NULL actors."""
    return top_groups(df.filter(column_of(df, actor) != F.lit(sentinel)), actor, k=k, out=out)


def phrase_trend(
    df: DataFrame,
    text: str,
    pattern: str,
    group: str | Sequence[str],
    *,
    k: int | None = 10,
    out: str = "help_post_count",
) -> DataFrame:
    """The k groups with most rows whose text matches a pattern."""
    return top_groups(df.filter(mentions(column_of(df, text), pattern)), group, k=k, out=out)


def top_words(
    df: DataFrame,
    text: str,
    *,
    min_length: int = 5,
    k: int | None = 15,
    out: str = "count",
) -> DataFrame:
    """The k most frequent words with at least ``min_length`` letters."""
    exploded = df.select(F.explode(words(column_of(df, text), min_length)).alias("word"))
    return top_groups(exploded, "word", k=k, out=out)
