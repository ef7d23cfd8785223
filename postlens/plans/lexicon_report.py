"""Groups that use a lexicon most and least."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from postlens.operators import (
    frequent_terms,
    hit_rate_by_group,
    hit_rate_by_group_joined,
    lexicon_hits,
    lexicon_hits_joined,
    rank_by_rate,
    vocabulary,
)
from postlens.presets import LexiconReport
from postlens.sources import (
    LexiconLimits,
    delete_folder,
    may_broadcast,
    read_parquet,
    scratch_folder,
    terms_if_few,
    write_report,
    write_table,
)

Lexicon = DataFrame | Sequence[str]


@dataclass(frozen=True)
class Matching:
    """How a lexicon is matched: as a list, or as a table with the tokens to settle first."""

    terms: list[str] | None = None
    table: DataFrame | None = None
    broadcast: bool = False
    frequent: dict[str, bool] | None = None


def choose_matching(
    posts: DataFrame, lexicon: Lexicon, tokens: str, limits: LexiconLimits, scratch: str
) -> Matching:
    """The way to match a lexicon, by measured sizes; the result is the same in any case.

    A table is first written to the scratch folder, so that it is computed once and the
    terms that are measured are those that are matched. One that is too long for a list
    is reduced to the terms that occur: one pass counts the vocabulary of the posts,
    and the size of what is listed in it decides again. The most frequent tokens for
    the merge join come from the same vocabulary.
    """
    spark = posts.sparkSession
    if not isinstance(lexicon, DataFrame):
        if len(lexicon) <= limits.plan_terms:
            return Matching(list(lexicon))
        lexicon = spark.createDataFrame([(term,) for term in lexicon], "term string")
    write_table(lexicon.toDF("term").dropna().distinct(), f"{scratch}/lexicon")
    table = read_parquet(spark, f"{scratch}/lexicon")
    terms = terms_if_few(table, limits)
    if terms is not None:
        return Matching(terms)
    write_table(vocabulary(posts, table, tokens=tokens), f"{scratch}/vocabulary")
    counted = read_parquet(spark, f"{scratch}/vocabulary")
    write_table(counted.filter("listed").select("term"), f"{scratch}/occurring")
    occurring = read_parquet(spark, f"{scratch}/occurring")
    terms = terms_if_few(occurring, limits)
    if terms is not None:
        return Matching(terms)
    if may_broadcast(occurring, limits):
        return Matching(table=occurring, broadcast=True)
    rows = frequent_terms(counted, limits.frequent_terms).collect()
    return Matching(table=occurring, frequent={row["term"]: row["listed"] for row in rows})


def post_hits(
    posts: DataFrame,
    lexicon: Lexicon,
    *,
    key: str,
    tokens: str = "content_tokens",
    out: str = "hits",
    limits: LexiconLimits = LexiconLimits(),
    scratch: str | None = None,
) -> DataFrame:
    """Key and hits of every post, one row for each, matched as the measured sizes allow.

    Keys may repeat or be NULL. A lexicon table starts jobs while the plan is built: they
    write its terms, and for a long one the vocabulary of the posts, to a folder under
    ``scratch`` (default: ``spark.checkpoint.dir``), which the result reads. A Python
    list goes through the driver; pass a long lexicon as a table.
    """
    folder = scratch_folder(posts.sparkSession, scratch) if _needs_scratch(lexicon, limits) else ""
    how = choose_matching(posts, lexicon, tokens, limits, folder)
    if how.table is None:
        return lexicon_hits(posts, how.terms, tokens=tokens, out=out).select(key, out)
    return lexicon_hits_joined(
        posts,
        how.table,
        key=key,
        broadcast=how.broadcast,
        frequent=how.frequent,
        tokens=tokens,
        out=out,
    )


def _needs_scratch(lexicon: Lexicon, limits: LexiconLimits) -> bool:
    return isinstance(lexicon, DataFrame) or len(lexicon) > limits.plan_terms


def group_rates(
    posts: DataFrame,
    lexicon: Lexicon,
    report: LexiconReport = LexiconReport(),
    *,
    limits: LexiconLimits = LexiconLimits(),
    scratch: str | None = None,
) -> DataFrame:
    """Rates of all large groups, matched as the measured sizes allow.

    Starts jobs and writes to ``scratch`` as ``post_hits`` does.
    """
    names = {
        "group": report.group,
        "tokens": report.tokens,
        "min_rows": report.min_rows,
        "rate": report.rate_name,
        "count": report.count_name,
    }
    folder = scratch_folder(posts.sparkSession, scratch) if _needs_scratch(lexicon, limits) else ""
    how = choose_matching(posts, lexicon, report.tokens, limits, folder)
    if how.table is None:
        return hit_rate_by_group(posts, how.terms, **names)
    return hit_rate_by_group_joined(posts, how.table, broadcast=how.broadcast, **names)


def run_lexicon_report(
    spark: SparkSession,
    posts: DataFrame,
    lexicon: Lexicon,
    output: str,
    report: LexiconReport = LexiconReport(),
    *,
    scratch: str | None = None,
) -> dict[str, str]:
    """Write both rankings under ``output``; returns their paths by report name.

    The posts are scanned once: the rates, one row per large group, are written
    to a folder under ``scratch`` (default: ``spark.checkpoint.dir``) and both rankings
    read them from there. The folder is deleted at the end.
    """
    folder = scratch_folder(spark, scratch)
    paths = {}
    try:
        write_table(group_rates(posts, lexicon, report, scratch=folder), f"{folder}/rates")
        rates = read_parquet(spark, f"{folder}/rates")
        for name, least in ((report.most_name, False), (report.least_name, True)):
            ranked = rank_by_rate(
                rates, group=report.group, rate=report.rate_name, k=report.k, least=least
            )
            paths[name] = f"{output.rstrip('/')}/{name}"
            write_report(ranked, paths[name])
    finally:
        delete_folder(spark, folder)
    return paths
