"""Sinks. All overwrite their target folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, MapType, StructType

from postlens.sources.readers import CSV_OPTIONS

FORMATS = ("parquet", "json", "csv")
TABLE_FORMATS = ("parquet", "json")  # those that hold arrays, as cleaned posts have


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", *, rows_per_file: int | None = None
) -> None:
    r"""Write a table with one file per task, as Parquet, JSON lines or CSV with a header.

    ``rows_per_file`` splits the files of a task further. In CSV a NULL is ``\N``, so a text of just these two characters comes back as NULL.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {', '.join(FORMATS)}")
    writer = df.write.mode("overwrite")
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if fmt == "csv":
        nested = [
            field.name
            for field in df.schema.fields
            if isinstance(field.dataType, (ArrayType, MapType, StructType))
        ]
        if nested:
            raise ValueError(f"CSV cannot hold nested columns: {', '.join(nested)}")
        writer.options(**CSV_OPTIONS).csv(path, header=True)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """Write a report as one CSV file with a header, in report order.

    One task writes the file, so this is for reports of bounded size: a top k or
    a count per category. Whole tables go through ``write_table``.
    """
    write_table(report.coalesce(1), path, "csv")
