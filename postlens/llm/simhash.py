"""Near-duplicates by 64-bit SimHash fingerprints.

Fingerprints are embedded as bit counts of their 4-bit segments. Two fingerprints
that differ in d bits have count vectors at Manhattan distance d at most, so a
range join on the grid of vectors finds every pair, and the exact bit distance
then decides. Half of the radius is walked from either side: two vectors at
distance d have a common grid point within d / 2 of both.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.names import quoted
from postlens.llm.common import finished, map_texts, stored, whole_row

Keep = Callable[[DataFrame, str], DataFrame]  # stores a table, for good or until it is read
SEED = 42
SEGMENT = 4
SEGMENTS = 64 // SEGMENT
DENSE_CELL = 32
HOT_ROWS = 1000
SALTS = 64


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash over the XXH64 of all word shingles; zero for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
    starts = [0, *(end + 1 for end in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    last = ends[min(width, len(words)) - 1 :]
    hashes = np.fromiter(
        (digest(line[s:e], SEED) for s, e in zip(starts, last)), np.uint64, len(last)
    )
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(rows: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """Replace the text by its ``fingerprint`` (bigint, the 64 bits in two's complement).

    NULL and blank texts get zero; a text of fewer words than the shingle has one
    shingle of all its words.
    """

    def make():
        def work(texts):
            values = np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))
            return [pa.array(values.view(np.int64))]

        return work

    return map_texts(rows, text, make, "fingerprint bigint")


def _counts(value: Column) -> list[Column]:
    mask = (1 << SEGMENT) - 1
    return [
        F.bit_count(F.shiftrightunsigned(value, SEGMENT * i).bitwiseAND(F.lit(mask)))
        for i in range(SEGMENTS)
    ]


def _cell(value: Column) -> Column:
    """The vector of segment counts as one number, three bits for each count."""
    total = F.lit(0).cast("bigint")
    for i, count in enumerate(_counts(value)):
        total = total + F.shiftleft(count.cast("bigint"), 3 * i)
    return total


def _cell_neighbours(cell: Column) -> Column:
    """The cell and those one step away."""
    near = [cell]
    for i in range(SEGMENTS):
        count = F.shiftrightunsigned(cell, 3 * i).bitwiseAND(F.lit(7))
        step = F.lit(1 << 3 * i).cast("bigint")
        near += [F.when(count > 0, cell - step), F.when(count < SEGMENT, cell + step)]
    return F.array_compact(F.array(*near))


def _flips(value: Column) -> Column:
    """The value and all values one bit away."""
    bits = [F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint") for b in range(64)]
    return F.array(value, *(value.bitwiseXOR(bit) for bit in bits))


def near_links(
    prints: DataFrame, max_distance: int = 2, dense_cell: int = DENSE_CELL, keep: Keep = stored
) -> DataFrame:
    """Links (``a`` < ``b``) that connect all fingerprints at ``max_distance`` bits or fewer.

    ``prints`` holds distinct values in ``fingerprint``. Cells of at most
    ``dense_cell`` fingerprints are joined pairwise and verified. The members of
    fuller cells meet at the values half the distance away instead: all that share
    such a value are within the distance, and each links to the smallest, so a cell
    of any size costs rows in proportion to its members and loses no connection.
    """
    if max_distance % 2 or max_distance < 0:
        raise ValueError("max_distance must be even")
    cells = prints.select("fingerprint", _cell(F.col("fingerprint")).alias("cell"))
    for step in range(max_distance // 2):
        near = F.explode(_cell_neighbours(F.col("cell"))).alias("cell")
        cells = cells.select("fingerprint", near)
        cells = cells.distinct() if step else cells
    sizes = cells.groupBy("cell").agg(F.count("*").alias("size")).filter("size > 1")
    shared = keep(cells.join(sizes, "cell"), "cells")
    sparse = shared.filter(F.col("size") <= dense_cell)
    left = sparse.select("cell", F.col("fingerprint").alias("a"))
    right = sparse.select("cell", F.col("fingerprint").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    pairs = left.join(right, "cell").filter((F.col("a") < F.col("b")) & close)
    meeting = shared.filter(F.col("size") > dense_cell).select("fingerprint").distinct()
    meeting = meeting.withColumn("at", F.col("fingerprint"))
    for step in range(max_distance // 2):
        meeting = meeting.select("fingerprint", F.explode(_flips(F.col("at"))).alias("at"))
        meeting = meeting.distinct() if step else meeting
    smallest = meeting.groupBy("at").agg(
        F.min("fingerprint").alias("a"), F.count("*").alias("size")
    )
    stars = meeting.join(smallest.filter("size > 1"), "at").select(
        "a", F.col("fingerprint").alias("b")
    )
    return pairs.select("a", "b").union(stars.filter("a < b")).distinct()


def connected_components(links: DataFrame, keep: Keep = stored) -> DataFrame:
    """(``node``, ``root``) for every node of the links, the root being its smallest node.

    Alternating large-star and small-star rounds; each round is written to the
    shared folder, and only a count of changes reaches the driver.
    """
    edges = keep(links.select("a", "b").filter("a <> b"), "links")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(small, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = keep(moved.filter("a <> b").union(small.select("a", "low")).distinct(), "links")
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b"), F.col("b"))).distinct()


def near_duplicates(
    keys: DataFrame, id: str = "doc_id", max_distance: int = 2, dense_cell: int = DENSE_CELL
) -> DataFrame:
    """(``fingerprint``, ``root``, ``component_id``) for every distinct fingerprint of ``keys``.

    ``root`` is the smallest fingerprint of the component, ``component_id`` its
    smallest id, NULL only if all its ids are NULL. Rows with equal fingerprints,
    repeated rows among them, are one node.
    """
    with finished(keys.sparkSession) as keep:
        reps = keep(keys.groupBy("fingerprint").agg(F.min(quoted(id)).alias("rep")), "prints")
        roots = connected_components(near_links(reps.select("fingerprint"), max_distance, dense_cell, keep), keep)
        linked = roots.join(reps, roots["node"] == reps["fingerprint"])
        names = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
        named = roots.join(names, "root").select(F.col("node").alias("fingerprint"), "root", "component_id")
        found = reps.join(named, "fingerprint", "left").select(
            "fingerprint",
            F.coalesce("root", "fingerprint").alias("root"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
        return stored(found, "components")


def hot_fingerprints(keys: DataFrame, hot_rows: int = HOT_ROWS) -> list[int]:
    """Fingerprints of more than ``hot_rows`` rows and a ten-thousandth of all, so at most 10,000."""
    sizes = keys.groupBy("fingerprint").agg(F.count("*").alias("size"))
    least = max(hot_rows, keys.count() // 10_000)
    return sorted(r["fingerprint"] for r in sizes.filter(F.col("size") > least).select("fingerprint").collect())


def join_by_fingerprint(keys: DataFrame, found: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``keys`` (a stored table) with the columns of ``found``, which has one row for each fingerprint.

    The rows of a hot fingerprint, such as that of blank texts, are dealt to ``SALTS`` places, and its row of
    ``found`` to all of them.
    """
    hot = hot_fingerprints(keys, hot_rows)
    if not hot:
        return keys.join(found, "fingerprint")
    table = keys.sparkSession.createDataFrame([(h,) for h in hot], "fingerprint bigint").withColumn("hot", F.lit(True))
    place = F.when(F.col("hot"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    left = keys.join(F.broadcast(table), "fingerprint", "left").withColumn("salt", place).drop("hot")
    places = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = found.join(F.broadcast(table), "fingerprint", "left").withColumn("salt", F.explode(places)).drop("hot")
    return left.join(right, ["fingerprint", "salt"]).drop("salt")


def simhash_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, max_distance: int = 2
) -> DataFrame:
    """Per row: id, ``fingerprint`` as 16 hex digits and ``component_id``.

    NULL and blank texts have fingerprint zero and link like any other. Repeated
    rows come back as often as they occur. An empty table gives an empty result;
    other columns are ignored.
    """
    rows = docs.select(F.col(quoted(id)), F.col(quoted(text)))
    keys = stored(fingerprints(rows, text, width), "fingerprints")
    found = near_duplicates(keys, id, max_distance)
    return join_by_fingerprint(keys, found).select(
        F.col(quoted(id)), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_per_group(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = 3,
    max_distance: int = 2,
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """Drop near-duplicates: of each component the row with its smallest id stays.

    The columns are those of ``docs``. Rows are found again by id and two text
    hashes; of rows equal in these, one stays, so one row of any component is left
    even where ids repeat or are NULL. The list of rows to keep is broadcast up to
    ``broadcast_rows`` rows of 32 bytes, and joined by a shuffle beyond.
    """
    body = F.col(quoted(text))
    hashes = [F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2")]
    rows = docs.select(F.col(quoted(id)).alias("id"), body.alias("text"), *hashes)
    keys = stored(fingerprints(rows, "text", width), "fingerprints")
    found = near_duplicates(keys, "id", max_distance)
    named = join_by_fingerprint(keys, found)
    first = F.struct(F.col("id").isNull(), "id", "h1", "h2")
    keep = named.groupBy("root").agg(F.min(first).alias("first"))
    keep = keep.select(F.col("first.id").alias("id"), "first.h1", "first.h2")
    copies = keys.groupBy("id", "h1", "h2").agg(F.count("*").alias("copies"))
    keep = stored(keep.alias("k").join(copies.alias("c"), _same("k", "c")).select("k.*", "copies"), "kept")
    small = keep.count() <= broadcast_rows
    tagged = docs.select(whole_row(docs), F.col(quoted(id)).alias("id"), *hashes).alias("t")
    side = (F.broadcast(keep) if small else keep).alias("k")
    kept = tagged.join(side, _same("t", "k")).select("t.*", "copies")
    doubled = kept.filter("copies > 1").groupBy("id", "h1", "h2").agg(F.first("row").alias("row"))
    return kept.filter("copies = 1").select("row.*").union(doubled.select("row.*"))


def _same(a: str, b: str) -> Column:
    """Equality of row keys, NULL ids included."""
    return F.expr(f"{a}.id <=> {b}.id AND {a}.h1 = {b}.h1 AND {a}.h2 = {b}.h2")
