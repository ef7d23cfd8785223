"""Column expressions on text and token arrays.

Character classes are written as POSIX classes (``\\P{Alnum}``) and not as ranges
(``[^a-zA-Z0-9]``). Both mean ASCII letters and digits in Java, but the class is one
table lookup per character. ``bench.py compare`` times both.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F


def split_tokens(text: Column) -> Column:
    """Lower-case and split on runs of whitespace; outer whitespace leaves empty tokens."""
    return F.split(F.lower(text), r"\s+")


def english_stopwords() -> list[str]:
    """Spark's default English stopword list."""
    return list(StopWordsRemover.loadDefaultStopWords("english"))


def without_stopwords(
    tokens: Column, stopwords: Iterable[str], *, lowered: bool = False
) -> Column:
    """Drop tokens found in ``stopwords``, ignoring case. NULL tokens stay.

    ``isin`` over a long literal list becomes a hash set that is built once per
    task, so the cost per token does not grow with the list. ``lowered`` says that
    the tokens are in lower case already.
    """
    listed = sorted({word.lower() for word in stopwords})

    def keep(token: Column) -> Column:
        word = token if lowered else F.lower(token)
        return token.isNull() | ~word.isin(listed)

    return F.filter(tokens, keep)


def alnum_tokens(tokens: Column, *, lowered: bool = False) -> Column:
    """Keep only ASCII letters and digits of every token, lower-cased; emptied tokens stay."""

    def clean(token: Column) -> Column:
        kept = F.regexp_replace(token, r"\P{Alnum}+", "")
        return kept if lowered else F.lower(kept)

    return F.transform(tokens, clean)


def distinct_hits(tokens: Column, terms: Iterable[str | None]) -> Column:
    """Number of different ``terms`` among the tokens; NULL for NULL tokens, NULL terms match none."""
    listed = sorted({term for term in terms if term is not None})
    return F.array_size(F.array_distinct(F.filter(tokens, lambda token: token.isin(listed))))


def words(text: Column, min_length: int) -> Column:
    """Lower-cased runs of ASCII letters with at least ``min_length`` letters.

    Equal to splitting on non-letters and keeping the long pieces, but the short
    ones are never built.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(rf"\p{{Alpha}}{{{min_length},}}"), F.lit(0))


def strip_whitespace(text: Column) -> Column:
    """Remove Unicode whitespace and the ASCII separators 0x1c-0x1f from both ends."""
    return F.regexp_replace(text, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")
