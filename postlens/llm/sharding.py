"""Shuffled shards by a two-pass external shuffle.

The first pass scatters the records over buckets that fit a task's memory, by a
seeded hash of the record. The second shuffles each bucket with the Fisher-Yates
algorithm and writes it. Buckets in order make one shuffled sequence, which is cut
into shards whose row counts differ by one at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from postlens.functions.names import quoted
from postlens.llm.common import whole_row

SEED = 20240917
BUCKET_BYTES = 32 << 20
ROW_BYTES = 16  # what a record takes beside its text


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniformly random order of 0 to n - 1."""
    order = list(range(n))
    picks = rng.integers(0, np.arange(1, n + 1)).tolist() if n else []
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    id: str = "doc_id",
    text: str = "text",
) -> None:
    """Write all rows to ``path/shard=N``, in files sorted by slot.

    A file row holds ``record`` (all columns of ``docs``) and ``slot``, its place in
    the shard, gapless from 0. NULL ids and texts are records like any other, and an
    empty table writes no shard. Equal records are scattered alike; where they make
    a bucket of twice its size, it is split by the records' places in the input, so
    repeated rows fill no task's memory. The driver holds one count for each bucket:
    8 bytes for every ``bucket_bytes`` of text.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length(F.col(quoted(text))), F.lit(0)) + ROW_BYTES
    rows = docs.select(
        F.xxhash64(F.lit(seed), F.col(quoted(id)), F.col(quoted(text))).alias("place"),
        F.hash(F.col(quoted(text))).alias("tie"),
        F.xxhash64(F.lit(seed), F.monotonically_increasing_id()).alias("row_place"),
        size.cast("bigint").alias("size"),
        whole_row(docs).alias("record"),
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    rows = rows.withColumn("bucket", F.pmod("place", F.lit(buckets)))
    sizes = rows.groupBy("bucket").agg(F.sum("size").alias("bytes"), F.max("size").alias("largest"))
    full = sizes.filter(F.col("bytes") > 2 * bucket_bytes + F.col("largest"))
    parts = {r["bucket"]: -(-r["bytes"] // bucket_bytes) for r in full.collect()}
    if parts:
        first = buckets
        table = []
        for bucket, count in sorted(parts.items()):
            table.append((bucket, count, first - 1))
            first += count - 1
        buckets = first
        split = spark.createDataFrame(table, "bucket bigint, parts bigint, base bigint")
        part = F.pmod("row_place", "parts")
        moved = F.when(part > 0, F.col("base") + part).otherwise(F.col("bucket"))
        rows = rows.join(F.broadcast(split), "bucket", "left").withColumn(
            "bucket", F.when(F.col("parts").isNull(), F.col("bucket")).otherwise(moved)
        )
    counts = np.zeros(buckets, np.int64)
    found = rows.groupBy("bucket").count().toArrow()
    counts[found["bucket"].to_numpy()] = found["count"].to_numpy()
    ends = np.cumsum(counts)
    starts = np.arange(shards + 1) * int(ends[-1]) // shards
    plan = spark.sparkContext.broadcast((ends, counts, starts))
    schema = StructType([
        rows.schema["record"], StructField("shard", IntegerType()), StructField("slot", LongType()),
    ])

    def shuffle(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        bucket = TaskContext.get().partitionId()
        ends, counts, starts = plan.value
        held = pa.Table.from_batches(batches)
        if held.num_rows != counts[bucket]:
            raise RuntimeError(f"bucket {bucket} has changed since it was counted")
        known = np.lexsort((held["tie"].to_numpy(), held["place"].to_numpy()))
        order = known[fisher_yates(held.num_rows, np.random.default_rng([seed, bucket]))]
        index = ends[bucket] - counts[bucket] + np.arange(held.num_rows)
        shard = np.searchsorted(starts, index, side="right") - 1
        slot = index - starts[shard]
        for i in range(0, held.num_rows, 1000):
            take = slice(i, i + 1000)
            record = held["record"].take(pa.array(order[take])).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [record, pa.array(shard[take], pa.int32()), pa.array(slot[take])], names=schema.names
            )

    placed = rows.select(F.col("bucket").cast("int").alias("bucket"), "place", "tie", "record")
    scattered = placed.repartitionById(buckets, F.col("bucket")).select("place", "tie", "record")
    shuffled = scattered.mapInArrow(shuffle, schema).sortWithinPartitions("shard", "slot")
    shuffled.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, record: StructType) -> DataFrame:
    """The rows of all shards: ``record``, ``slot`` and ``shard``."""
    schema = StructType([
        StructField("record", record), StructField("slot", LongType()), StructField("shard", IntegerType()),
    ])
    return spark.read.schema(schema).parquet(path)


def shard_digest(placed: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of the shards: id, ``size`` in bytes, ``text_crc32`` (of no bytes for NULL),
    ``law``, ``shard``, ``slot``, and ``grown_shard``, which is NULL under the law ``rows``."""
    body = F.coalesce(F.col("record")[text], F.lit(""))
    return placed.select(
        F.col("record")[id].alias(id),
        (F.octet_length(body).cast("bigint") + ROW_BYTES).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
