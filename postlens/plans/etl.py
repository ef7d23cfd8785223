"""Raw JSON lines to the cleaned post table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postlens.functions import column_of
from postlens.operators import clean_posts
from postlens.presets import POST_SCHEMA
from postlens.sources import read_json, write_table


def run_etl(
    spark: SparkSession,
    raw_path: str,
    cleaned_path: str,
    *,
    fmt: str = "parquet",
    schema: StructType = POST_SCHEMA,
    text: str = "content",
    stopwords: Iterable[str] | None = None,
    cluster_by: str | None = None,
    rows_per_file: int = 1_000_000,
) -> None:
    """Read, clean and write in one map-only job: every input split is one output file.

    ``cluster_by`` costs a shuffle and sorts the table by that column, in files of up to
    ``rows_per_file`` rows, so that a filter on it skips files and row groups. Rows of
    one value are spread by a hash of their text, so a value that most rows have fills
    many files and no single task.
    """
    cleaned = clean_posts(read_json(spark, raw_path, schema), text=text, stopwords=stopwords)
    if cluster_by is not None:
        column = column_of(cleaned, cluster_by)
        cleaned = cleaned.repartitionByRange(column, F.xxhash64(column_of(cleaned, text)))
        cleaned = cleaned.sortWithinPartitions(column)
    write_table(cleaned, cleaned_path, fmt, rows_per_file=rows_per_file if cluster_by else None)
