"""Cleaning operators. All are narrow: one projection over the scan, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from postlens.functions import (
    alnum_tokens,
    column_of,
    english_stopwords,
    split_tokens,
    without_stopwords,
)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is NULL, such as unreadable JSON lines."""
    plain = [f"c{i}" for i in range(len(df.columns))]  # dropna takes no names with dots
    return df.toDF(*plain).dropna(how="all").toDF(*df.columns)


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim spaces (U+0020 only) from every string column, chosen by type."""
    names = [field.name for field in df.schema.fields if isinstance(field.dataType, StringType)]
    return df.withColumns({name: F.trim(df[f"`{name}`"]) for name in names})


def tokenize(df: DataFrame, text: str, *, out: str = "content_tokens") -> DataFrame:
    """Add the whitespace tokens of the lower-cased text."""
    return df.withColumn(out, split_tokens(column_of(df, text)))


def remove_stopwords(
    df: DataFrame,
    tokens: str,
    *,
    out: str | None = None,
    stopwords: Iterable[str] | None = None,
    lowered: bool = False,
) -> DataFrame:
    """Drop stopwords from a token column, ignoring case. Default: Spark's English list.

    ``lowered`` saves the case conversion of tokens that are in lower case already.
    """
    listed = english_stopwords() if stopwords is None else stopwords
    kept = without_stopwords(column_of(df, tokens), listed, lowered=lowered)
    return df.withColumn(out or tokens, kept)


def normalize_tokens(
    df: DataFrame,
    tokens: str,
    *,
    out: str | None = None,
    drop_empty: bool = False,
    lowered: bool = False,
) -> DataFrame:
    """Reduce tokens to lower-case ASCII letters and digits.

    Tokens without any stay as empty strings unless ``drop_empty`` is set.
    ``lowered`` saves the case conversion of tokens that are in lower case already.
    """
    cleaned = alnum_tokens(column_of(df, tokens), lowered=lowered)
    if drop_empty:
        cleaned = F.filter(cleaned, lambda token: token != "")
    return df.withColumn(out or tokens, cleaned)


def clean_posts(
    df: DataFrame,
    *,
    text: str = "content",
    out: str = "content_tokens",
    stopwords: Iterable[str] | None = None,
) -> DataFrame:
    """Full clean: drop empty rows, trim, tokenise, remove stopwords, normalise tokens.

    Stopwords go before punctuation is stripped, so ``it's`` is removed while
    ``it's,`` stays and becomes ``its``.
    """
    return (
        df.transform(drop_all_null)
        .transform(trim_strings)
        .transform(tokenize, text, out=out)
        .transform(remove_stopwords, out, stopwords=stopwords, lowered=True)
        .transform(normalize_tokens, out, lowered=True)
    )
