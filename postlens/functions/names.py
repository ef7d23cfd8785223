"""Columns by name, where names may hold dots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column_of(df: DataFrame, name: str) -> Column:
    """The column of that name; a name that is no column may be a field, as ``a.b``."""
    return F.col(quoted(name) if name in df.columns else name)


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def columns_of(df: DataFrame, names: str | Sequence[str]) -> list[Column]:
    return [column_of(df, name) for name in as_list(names)]
