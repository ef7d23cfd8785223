"""Column expressions for regex flags and prioritised labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mentions(text: Column, pattern: str) -> Column:
    """True where the pattern occurs in the text; NULL for NULL text."""
    return text.rlike(pattern)


def first_label(
    first: tuple[Column, str], second: tuple[Column, str], *, both: str, other: str
) -> Column:
    """Label by two flags: both, first, second, else other. A NULL flag counts as false."""
    (flag_a, label_a), (flag_b, label_b) = first, second
    return (
        F.when(flag_a & flag_b, F.lit(both))
        .when(flag_a, F.lit(label_a))
        .when(flag_b, F.lit(label_b))
        .otherwise(F.lit(other))
    )
