"""The six corpus reports: activity, phrase trend, words and the topic deep dive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import column_of, mentions
from postlens.operators import (
    active_actors,
    categorize,
    category_counts_from_summary,
    mention_crosstab_from_summary,
    top_k,
    top_words,
    topic_slice,
)
from postlens.presets import ReportSuite
from postlens.sources import delete_folder, read_parquet, scratch_folder, write_report, write_table


def suite_summary(posts: DataFrame, suite: ReportSuite) -> DataFrame:
    """What the four reports on the body share, in one scan of it.

    One row for each group, and for the topic one for each combination of flags and
    category, at most 36. The topic's patterns run on its own rows only: the body is
    NULL to them elsewhere.
    """
    body = column_of(posts, suite.body)
    group = column_of(posts, suite.group)
    rows = posts.select(
        group.alias("group"),
        column_of(posts, suite.length).alias("length"),
        mentions(body, suite.phrase).alias("has_phrase"),
        F.when(group == F.lit(suite.topic), body).alias("topic_body"),
    )
    labelled = categorize(
        rows, "topic_body", *suite.categories, both=suite.both_label, other=suite.other_label, out="category"
    )
    flags = [mentions(F.col("topic_body"), p).alias(f"flag{i}") for i, (_, p) in enumerate(suite.flags)]
    return labelled.groupBy("group", "category", *flags).agg(
        F.count("*").alias("n_rows"),
        F.count_if("has_phrase").alias("n_phrase"),
        F.sum("length").alias("sum_length"),
        F.count("length").alias("n_length"),
    )


def run_report_suite(
    spark: SparkSession,
    posts: DataFrame,
    output: str,
    suite: ReportSuite = ReportSuite(),
    *,
    scratch: str | None = None,
) -> dict[str, str]:
    """Write all six reports under ``output``; returns their paths by report name.

    The body is scanned once: its four reports come from one summary, written to a folder
    under ``scratch`` (default: ``spark.checkpoint.dir``), which is deleted at the end.
    """
    folder = scratch_folder(spark, scratch)
    paths = {}
    try:
        write_table(suite_summary(posts, suite), folder)
        for name, report in _reports(posts, read_parquet(spark, folder), suite).items():
            paths[name] = f"{output.rstrip('/')}/{name}"
            write_report(report, paths[name])
    finally:
        delete_folder(spark, folder)
    return paths


def _reports(posts: DataFrame, summary: DataFrame, suite: ReportSuite) -> dict[str, DataFrame]:
    flags = dict(suite.flags)
    groups = summary.groupBy(F.col("group").alias(suite.group)).agg(
        F.sum("n_rows").alias("count"), F.sum("n_phrase").alias(suite.phrase_count_name)
    )
    topic = topic_slice(summary, "group", suite.topic).select(
        *(F.col(f"flag{i}").alias(name) for i, name in enumerate(flags)),
        F.col("category").alias(suite.category_name),
        *("n_rows", "sum_length", "n_length"),
    )
    with_phrase = groups.filter(F.col(suite.phrase_count_name) > 0).drop("count")
    return {
        suite.top_groups_name: top_k(
            groups.drop(suite.phrase_count_name), "count", suite.group, k=suite.k
        ),
        suite.active_actors_name: active_actors(
            posts, suite.actor, sentinel=suite.deleted_actor, k=suite.k
        ),
        suite.phrase_name: top_k(with_phrase, suite.phrase_count_name, suite.group, k=suite.k),
        suite.words_name: top_words(
            posts, suite.summary, min_length=suite.min_word_length, k=suite.k_words
        ),
        suite.crosstab_name: mention_crosstab_from_summary(
            topic, flags, count=suite.crosstab_count_name, mean=suite.crosstab_mean_name
        ),
        suite.categories_name: category_counts_from_summary(topic, suite.category_name),
    }
