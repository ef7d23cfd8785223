"""Scans of post tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# What the CSV writer and reader agree on: no trimming, doubled quotes, a NULL marker.
CSV_OPTIONS = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
    "nullValue": "\\N",
}


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Line-delimited JSON under a fixed schema; unreadable lines become all-NULL rows."""
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet; the files carry the schema."""
    return spark.read.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    multi_line: bool = False,
) -> DataFrame:
    r"""CSV with a header row. Without a schema, types are inferred by one more pass.

    Reads what ``write_table`` and ``write_report`` write without loss: blanks are kept, ``\N`` is
    NULL and an empty field the empty string. Text with line breaks needs ``multi_line``, which
    makes each file one task, so it is off by default.
    """
    reader = spark.read.options(**CSV_OPTIONS, header=True)
    if multi_line:
        reader = reader.options(multiLine=True, lineSep="\n")
    if schema is not None:
        return reader.csv(path, schema=schema)
    return reader.csv(path, inferSchema=True)
