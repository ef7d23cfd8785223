"""Lexicon operators: how many different listed terms a post uses, and group rates.

A lexicon is a list of terms or, when it is too long for the plan, a one-column
DataFrame. A list is matched inside the scan stage. A DataFrame is joined:
broadcast where the caller has checked its size, else by a merge join to which
only the rarer tokens go. Spark's own estimate of its size never decides. All forms
give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import column_of, columns_of, distinct_hits
from postlens.operators.ranking import top_k

COPIES_AT_ONCE = 1_000_000


def lexicon_hits(
    df: DataFrame, terms: Iterable[str | None], *, tokens: str = "content_tokens", out: str = "hits"
) -> DataFrame:
    """Add the number of different terms in each row's tokens; NULL for NULL tokens.

    NULL terms match nothing. The terms become part of the plan; pass a long lexicon
    as a table to ``plans.post_hits``.
    """
    return df.withColumn(out, distinct_hits(column_of(df, tokens), terms))


def explode_terms(
    df: DataFrame,
    tokens: str,
    carry: Mapping[str, Column],
    frequent: Mapping[str, bool] | None = None,
) -> DataFrame:
    """One row per different token, and one with a NULL token that stands for the row.

    ``carry`` names the columns that go along. ``frequent`` tells for some tokens
    whether the lexicon lists them. They are not exploded; ``_known`` has the number of
    listed ones, NULL for NULL tokens. It is computed below the explode, so that no
    exploded row drags the token array along. The exploded array has no column of its
    own: Spark would filter on the column's size below the projection and so build
    the array twice.
    """
    column = F.col("_tokens")
    known = F.when(column.isNotNull(), F.lit(0))
    terms = F.coalesce(column, F.array().cast("array<string>"))
    if frequent:
        known = distinct_hits(column, [term for term, listed in frequent.items() if listed])
        terms = F.filter(terms, lambda term: ~term.isin(sorted(frequent)))
    row_and_terms = F.array_union(F.array(F.lit(None).cast("string")), terms)
    return (
        df.select(column_of(df, tokens).alias("_tokens"), *(c.alias(n) for n, c in carry.items()))
        .select("_tokens", *carry, known.alias("_known"))
        .select(*carry, "_known", F.explode(row_and_terms).alias("_term"))
    )


def listed_terms(lexicon: DataFrame) -> DataFrame:
    return lexicon.toDF("_term").dropna().distinct().withColumn("_listed", F.lit(True))


def vocabulary(df: DataFrame, lexicon: DataFrame, *, tokens: str = "content_tokens") -> DataFrame:
    """Every different token: ``term``, ``n`` (rows that have it) and ``listed``."""
    exploded = df.select(F.explode(F.array_distinct(column_of(df, tokens))).alias("_term"))
    counted = exploded.groupBy("_term").agg(F.count("*").alias("n")).dropna()
    return counted.join(listed_terms(lexicon).hint("merge"), "_term", "left").select(
        F.col("_term").alias("term"), "n", F.col("_listed").isNotNull().alias("listed")
    )


def frequent_terms(counted: DataFrame, k: int) -> DataFrame:
    """The k tokens of a vocabulary that most rows have, and whether they are listed."""
    return top_k(counted, "n", "term", k=k).select("term", "listed")


def lexicon_hits_joined(
    df: DataFrame,
    lexicon: DataFrame,
    *,
    key: str,
    broadcast: bool = False,
    frequent: Mapping[str, bool] | None = None,
    tokens: str = "content_tokens",
    out: str = "hits",
) -> DataFrame:
    """Like ``lexicon_hits`` for a longer lexicon; returns ``key`` and the hits, one row for
    each row of ``df``, whether keys repeat or are NULL.

    One scan: every row yields its different tokens and a NULL that stands for the row.
    They are counted by key and a hash of the tokens: rows that are equal in both have
    equal hits, so the listed tokens of such a cell are shared out evenly among its
    rows. Set ``broadcast`` only for a lexicon of checked size. Otherwise pass the most
    ``frequent`` tokens: they are settled in the scan stage, which leaves no hot join
    key and a small part of the rows to shuffle. The NULLs match nothing; the second
    join key, a hash of the row's key and tokens, spreads them over all partitions.
    """
    cell = {"_key": column_of(df, key), "_cell": F.xxhash64(column_of(df, tokens))}
    exploded = explode_terms(df, tokens, cell, frequent)
    listed = listed_terms(lexicon)
    is_row = F.col("_term").isNull()
    if broadcast:
        joined = exploded.join(F.broadcast(listed), "_term", "left")
    else:
        spread = F.when(is_row, F.hash("_key", "_cell")).otherwise(F.hash("_term"))
        joined = exploded.withColumn("_spread", spread).join(
            listed.withColumn("_spread", F.hash("_term")).hint("merge"),
            ["_term", "_spread"],
            "left",
        )
    # NULL tokens hash like an empty array; only their hits are NULL.
    scored = F.col("_known").isNotNull()
    cells = (
        joined.filter(is_row | F.col("_listed"))
        .groupBy("_key", "_cell", scored.alias("_scored"))
        .agg(
            F.max("_known").alias("_known"),
            F.count("_listed").alias("_found"),
            F.count_if(is_row).alias("_rows"),
        )
    )
    hits = (F.col("_known") + F.expr("_found div _rows")).cast("int")
    counted = cells.select("_key", hits.alias("_hits"), "_rows")
    # As many rows as went in, a bounded number at a time.
    last = F.expr(f"(_rows - 1) div {COPIES_AT_ONCE}")
    parts = counted.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_part"))
    size = F.least(F.lit(COPIES_AT_ONCE).cast("bigint"), F.col("_rows") - F.col("_part") * COPIES_AT_ONCE)
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias("_copy")
    return parts.select("_key", "_hits", copies).select(
        F.col("_key").alias(key), F.col("_hits").alias(out)
    )


def hit_rate_by_group(
    df: DataFrame,
    terms: Iterable[str | None],
    *,
    group: str | Sequence[str],
    min_rows: int,
    tokens: str = "content_tokens",
    rate: str = "avg_hits",
    count: str = "post_count",
) -> DataFrame:
    """Mean hits and row count of every group with more than ``min_rows`` rows.

    ``group`` is a column or several. Rows with NULL tokens count as rows but not
    towards the mean.
    """
    return (
        df.groupBy(*columns_of(df, group))
        .agg(
            F.avg(distinct_hits(column_of(df, tokens), terms)).alias(rate),
            F.count("*").alias(count),
        )
        .filter(F.col(count) > min_rows)
    )


def hit_rate_by_group_joined(
    df: DataFrame,
    lexicon: DataFrame,
    *,
    group: str | Sequence[str],
    min_rows: int,
    broadcast: bool = False,
    salts: int = 16,
    tokens: str = "content_tokens",
    rate: str = "avg_hits",
    count: str = "post_count",
) -> DataFrame:
    """Like ``hit_rate_by_group`` for a longer lexicon, in one scan.

    Every row yields its different tokens and a NULL that stands for the row. Set
    ``broadcast`` only for a lexicon of checked size; the join then runs inside
    the scan stage. Otherwise the tokens are counted per group before the join, so
    a frequent token reaches it once per group and not once per row. The second join
    key spreads the rows of one token over ``salts`` places by their group, and the
    NULLs, which match nothing, over all.
    """
    names = columns_of(df, group)
    groups = [f"_group{i}" for i in range(len(names))]
    exploded = explode_terms(df, tokens, dict(zip(groups, names)))
    listed = listed_terms(lexicon)
    is_row = F.col("_term").isNull()
    scored_row = is_row & F.col("_known").isNotNull()
    if broadcast:
        each = exploded.withColumns({"_n": F.lit(1), "_scored": scored_row.cast("int")})
        joined = each.join(F.broadcast(listed), "_term", "left")
    else:
        counted = exploded.groupBy(*groups, "_term").agg(
            F.count("*").alias("_n"), F.count_if(scored_row).alias("_scored")
        )
        place = F.hash(*groups)
        spread = F.when(is_row, place).otherwise(F.pmod(place, F.lit(salts)))
        places = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_spread")
        joined = counted.withColumn("_spread", spread).join(
            listed.select("*", places).hint("merge"), ["_term", "_spread"], "left"
        )
    n_hits = F.coalesce(F.sum(F.when(F.col("_listed"), F.col("_n"))), F.lit(0))
    rates = joined.groupBy(*groups).agg(
        F.try_divide(n_hits, F.sum("_scored")).alias("_rate"),
        F.sum(F.when(is_row, F.col("_n"))).alias("_count"),
    )
    return rates.filter(F.col("_count") > min_rows).select(
        *(F.col(g).alias(c) for g, c in zip(groups, df.select(*names).columns)),
        F.col("_rate").alias(rate),
        F.col("_count").alias(count),
    )


def rank_by_rate(
    rates: DataFrame,
    *,
    group: str | Sequence[str],
    k: int | None = 10,
    least: bool = False,
    rate: str = "avg_hits",
) -> DataFrame:
    """The k groups with the highest rate, or the lowest with ``least``."""
    return top_k(rates, rate, group, k=k, ascending=least)
