"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postlens.functions.names import quoted
from postlens.sources.scratch import delete_folder

ROWS_AT_ONCE = 512
# By module, what its tasks leave in a worker for the next task. Workers outlive stages, so
# tasks of other operators empty it.
caches: dict[str, dict] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """An unused path in the session's checkpoint folder, which all executors can reach."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{shared.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str = "", path: str | None = None) -> DataFrame:
    """The table written to the shared folder and read again, which cuts its lineage.

    Its shuffles are of no more use then, and Spark deletes their files.
    """
    spark = df.sparkSession
    path = path or shared_folder(spark, name)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def finished(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A form of ``stored`` whose tables are deleted at the end of the block. What is read from them
    later has to be stored, or be on the driver, by then."""
    paths = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        paths.append(shared_folder(spark, name))
        return stored(df, path=paths[-1])

    try:
        yield keep
    finally:
        for path in paths:
            delete_folder(spark, path)


def whole_row(df: DataFrame) -> Column:
    """All columns of the table as one struct; names may hold dots."""
    return F.struct(*(F.col(quoted(c)) for c in df.columns)).alias("row")


def filter_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on computed columns where they stand.

    Spark moves a plain filter below the projections and repeats their expressions in
    it, over and over where they build on each other. It moves none past a column
    that depends on the place of a row.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    return placed.filter(condition & (F.col("_place") >= 0)).drop("_place")


def input_tasks(spark: SparkSession) -> int:
    """Partitions for shuffled work that Spark does not merge by itself."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that Python objects of few texts live at once.

    ``ROWS_AT_ONCE`` rows, or as many as have about ``size`` bytes on average.
    """
    for batch in batches:
        rows = ROWS_AT_ONCE
        if size is not None:
            rows = max(1, batch.num_rows * size // max(batch.nbytes, 1))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def release_caches(owner: str) -> None:
    """Empty the caches of all other modules, at the start of a task."""
    for name, cache in caches.items():
        if name != owner:
            cache.clear()


def map_texts(
    rows: DataFrame,
    text: str,
    make: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
    added: str,
) -> DataFrame:
    """Replace the text column by columns computed from it, in one map-only pass.

    ``make`` runs once per task and returns a function from a list of texts to one
    array for each column of the ``added`` schema.
    """
    at = rows.columns.index(text)
    kept = [i for i in range(len(rows.columns)) if i != at]
    schema = StructType([rows.schema[i] for i in kept] + list(StructType.fromDDL(added)))

    def run(batches):
        release_caches(make.__module__)
        work = make()
        for batch in slices(batches):
            arrays = [batch.column(i) for i in kept] + work(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    # Columns go by place, as names may hold dots.
    return rows.toDF(*(f"_{i}" for i in range(len(rows.columns)))).mapInArrow(run, schema)


def ascii_lower(column: Column) -> Column:
    """A-Z lowered, all else kept; plain lower() where the text is ASCII, as it is faster."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(column) == F.length(column), F.lower(column)).otherwise(
        F.translate(column, upper, upper.lower())
    )
