"""Profiling operators. Counts and statistics take one scan for all columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from postlens.functions import columns_of

DESCRIBED = (
    "column_name string, count bigint, mean double, stddev double, min string, max string, "
    "min_number double, max_number double"
)


def preview(
    df: DataFrame,
    n: int = 10,
    *,
    order_by: str | Sequence[str] | None = None,
    truncate: int | None = None,
) -> DataFrame:
    """The first n rows: in key order if one is given, else whichever come first.

    Without a key only as many partitions as needed are read. ``truncate`` cuts
    longer strings to that length, the last three characters being dots; a length
    below four leaves no room for them.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by or [])
    rows = (df.orderBy(*columns_of(df, keys)) if keys else df).limit(n)
    if truncate is None:
        return rows
    cut = {}
    for field in rows.schema.fields:
        if isinstance(field.dataType, StringType):
            column = rows[f"`{field.name}`"]
            short = F.substring(column, 1, truncate)
            if truncate > 3:
                short = F.concat(F.substring(column, 1, truncate - 3), F.lit("..."))
            cut[field.name] = F.when(F.length(column) > truncate, short).otherwise(column)
    return rows.withColumns(cut)


def row_count(df: DataFrame, *, out: str = "count") -> DataFrame:
    """Number of rows."""
    return df.agg(F.count("*").alias(out))


def null_counts(df: DataFrame) -> DataFrame:
    """Number of NULLs in every column, as one row.

    Rows less values, two aggregates that Spark can take from Parquet footers
    where the session pushes aggregates down.
    """
    return df.agg(
        *[(F.count("*") - F.count(df[f"`{name}`"])).alias(name) for name in df.columns]
    )


def describe_columns(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of numeric and string columns.

    One row per column. ``min`` and ``max`` are text, exact for every type;
    numeric columns also have them as ``min_number`` and ``max_number``. Mean and
    deviation of a string column cover the values that read as numbers. All
    columns share one aggregate, and only its single row is unfolded. A table without
    such columns gives no row.
    """
    rows = []
    for field in df.schema.fields:
        column = df[f"`{field.name}`"]
        if isinstance(field.dataType, NumericType):
            number = column.cast("double")
            numeric_bounds = (F.min(column).cast("double"), F.max(column).cast("double"))
        elif isinstance(field.dataType, StringType):
            number = column.try_cast("double")
            numeric_bounds = (F.lit(None).cast("double"), F.lit(None).cast("double"))
        else:
            continue
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.count(column).alias("count"),
                F.avg(number).alias("mean"),
                F.stddev_samp(number).alias("stddev"),
                F.min(column).cast("string").alias("min"),
                F.max(column).cast("string").alias("max"),
                numeric_bounds[0].alias("min_number"),
                numeric_bounds[1].alias("max_number"),
            )
        )
    if not rows:
        return df.sparkSession.createDataFrame([], DESCRIBED)
    return df.agg(F.array(*rows).alias("columns")).select(F.inline("columns"))
