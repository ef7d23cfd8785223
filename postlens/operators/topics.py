"""Topic deep dive: one group's rows, mention flags, categories and their reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions import column_of, first_label, mentions
from postlens.operators.ranking import top_groups, top_k


def topic_slice(df: DataFrame, group: str, value: object) -> DataFrame:
    """Rows of one group; the filter reaches the Parquet scan."""
    return df.filter(column_of(df, group) == F.lit(value))


def mention_crosstab(
    df: DataFrame,
    text: str,
    length: str,
    flags: Mapping[str, str],
    *,
    count: str = "total_posts",
    mean: str = "avg_post_length",
) -> DataFrame:
    """Rows and truncated mean length for every combination of mention flags.

    NULL text is a third value of a flag.
    """
    names = list(flags)
    return top_k(
        df.groupBy(*[mentions(column_of(df, text), flags[name]).alias(name) for name in names]).agg(
            F.count("*").alias(count), F.avg(column_of(df, length)).cast("int").alias(mean)
        ),
        count,
        names,
        k=None,
    )


def categorize(
    df: DataFrame,
    text: str,
    first: tuple[str, str],
    second: tuple[str, str],
    *,
    both: str = "Both",
    other: str = "General / Other",
    out: str = "discussion_type",
) -> DataFrame:
    """Label rows by two ``(label, pattern)`` rules: both, first, second, else other.

    Each pattern runs once per row: the flags are columns of their own below the label.
    """
    (label_a, pattern_a), (label_b, pattern_b) = first, second
    flags = "_flags"
    while flags in df.columns:
        flags += "_"
    column = column_of(df, text)
    flagged = df.withColumn(
        flags,
        F.struct(mentions(column, pattern_a).alias("a"), mentions(column, pattern_b).alias("b")),
    )
    pair = F.col(flags)
    label = first_label((pair["a"], label_a), (pair["b"], label_b), both=both, other=other)
    return flagged.withColumn(out, label).drop(flags)


def category_counts(
    df: DataFrame, category: str = "discussion_type", *, out: str = "count"
) -> DataFrame:
    """Rows of every category, largest first."""
    return top_groups(df, category, k=None, out=out)


def topic_summary(
    df: DataFrame,
    text: str,
    length: str,
    flags: Mapping[str, str],
    first: tuple[str, str],
    second: tuple[str, str],
    *,
    both: str = "Both",
    other: str = "General / Other",
    category: str = "discussion_type",
) -> DataFrame:
    """One aggregate that holds both topic reports: a row per flags and category.

    At most 9 x 4 rows for two flags, however large the slice. It replaces a
    cached slice, which would hold every column of every row.
    """
    labelled = categorize(df, text, first, second, both=both, other=other, out=category)
    return labelled.groupBy(
        *[mentions(F.col(text), pattern).alias(name) for name, pattern in flags.items()], category
    ).agg(
        F.count("*").alias("n_rows"),
        F.sum(length).alias("sum_length"),
        F.count(length).alias("n_length"),
    )


def mention_crosstab_from_summary(
    summary: DataFrame,
    flags: Mapping[str, str],
    *,
    count: str = "total_posts",
    mean: str = "avg_post_length",
) -> DataFrame:
    """``mention_crosstab`` computed from ``topic_summary``."""
    names = list(flags)
    mean_length = F.try_divide(F.sum("sum_length"), F.sum("n_length")).cast("int")
    counted = summary.groupBy(*names).agg(
        F.sum("n_rows").alias(count), mean_length.alias(mean)
    )
    return top_k(counted, count, names, k=None)


def category_counts_from_summary(
    summary: DataFrame, category: str = "discussion_type", *, out: str = "count"
) -> DataFrame:
    """``category_counts`` computed from ``topic_summary``."""
    counted = summary.groupBy(category).agg(F.sum("n_rows").alias(out))
    return top_k(counted, out, category, k=None)
