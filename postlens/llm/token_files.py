"""Token ids in entropy-coded binary files.

The ids of all documents, in ascending order of their ids, are written in blocks by
a static range asymmetric numeral system (rANS). One frequency table, counted over
all ids, serves all blocks. A block holds whole documents and codes its ids in
interleaved lanes; after every ``SEGMENT_STEPS`` ids of a lane the lane states are
kept as a checkpoint, and each segment has a checksum, so that blocks and the
segments within them decode on their own.

The files are Parquet tables in one folder, so they live in any store that Spark
can write and are committed by task: ``frequencies`` and ``blocks``.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType
from tokenizers import Encoding, Tokenizer

from postlens.functions.names import quoted
from postlens.llm.common import caches, input_tasks, release_caches, shared_folder, slices, stored
from postlens.sources.scratch import delete_folder

LOW = np.uint64(1 << 31)  # states stay in [LOW, LOW << 32)
LANES = 4096
SEGMENT_STEPS = 256
BLOCK_TOKENS = LANES * SEGMENT_STEPS
SLICE_BYTES = 16 << 20
CACHED_WORDS, CACHED_BARES = 1_600_000, 50_000
JOINED = 500
SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]{2}"  # adjacent white space of any kind, for Arrow
STEM = re.compile(r"(\n?[^\W\d_]+)[!-/:-@\[-`{-~]+")

SEGMENT = "struct<states: binary, words: binary, crc32: bigint>"
_encoders: dict[str, WordEncoder] = {}
caches[__name__] = _encoders


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts by symbol scaled to add up to a power of two; what occurs gets 1 at least.

    The power leaves 16 to 32 parts for each symbol that occurs, so that small
    tables, which decode faster, serve small vocabularies.
    """
    if not counts.sum():
        return counts.astype(np.uint64)
    total = 1 << int(np.count_nonzero(counts)).bit_length() + 4
    scaled = np.floor(counts * (total / counts.sum())).astype(np.int64)
    scaled[(counts > 0) & (scaled == 0)] = 1
    spare = total - scaled.sum()
    for symbol in np.argsort(-scaled, kind="stable"):
        change = max(spare, 1 - scaled[symbol])
        scaled[symbol] += change
        spare -= change
        if not spare:
            break
    return scaled.astype(np.uint64)


class Rans:
    """Interleaved rANS over a fixed frequency table."""

    def __init__(self, frequencies: np.ndarray):
        self.frequencies = frequencies.astype(np.uint64)
        self.precision = np.uint64(max(int(frequencies.sum()), 1).bit_length() - 1)
        self.begins = np.cumsum(self.frequencies, dtype=np.uint64) - self.frequencies
        self.symbols = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies.astype(np.int64))
        # For each slot its symbol's frequency and its place within the symbol's slots.
        place = np.arange(len(self.symbols), dtype=np.uint64) - self.begins[self.symbols]
        self.slots = self.frequencies[self.symbols] << np.uint64(32) | place

    def encode(self, ids: np.ndarray) -> list[dict]:
        """Segments of the ids in order; id i is in lane i % LANES."""
        steps = -(-len(ids) // LANES)
        x = np.full(LANES, LOW)
        segments = []
        for first in range((steps - 1) // SEGMENT_STEPS * SEGMENT_STEPS, -1, -SEGMENT_STEPS):
            out = []
            for step in range(min(first + SEGMENT_STEPS, steps) - 1, first - 1, -1):
                symbols = ids[step * LANES : (step + 1) * LANES].astype(np.int64)
                state, f = x[: len(symbols)], self.frequencies[symbols]
                full = np.flatnonzero(state >= f << (np.uint64(63) - self.precision))
                emitted = state[full]
                out.append(emitted.astype("<u4"))
                state[full] = emitted >> np.uint64(32)
                quotient = state // f
                # state - quotient * f is the remainder
                state += (quotient << self.precision) - quotient * f + self.begins[symbols]
            words = np.concatenate(out[::-1]).tobytes()
            states = x.astype("<u8").tobytes()
            segments.append({"states": states, "words": words, "crc32": zlib.crc32(words, zlib.crc32(states))})
        return segments[::-1]

    def decode(self, segment: dict, count: int) -> np.ndarray:
        """The ``count`` ids of one segment, from its checkpoint alone."""
        if zlib.crc32(segment["words"], zlib.crc32(segment["states"])) != segment["crc32"]:
            raise ValueError("checksum of a segment is wrong")
        x = np.frombuffer(segment["states"], "<u8").astype(np.uint64)
        words = np.frombuffer(segment["words"], "<u4").astype(np.uint64)
        ids, at = np.empty(count, np.uint32), 0
        mask = (np.uint64(1) << self.precision) - np.uint64(1)
        half, rest = np.uint64(32), np.uint64(0xFFFFFFFF)
        for first in range(0, count, LANES):
            state = x[: min(LANES, count - first)]
            slot = (state & mask).view(np.int64)
            ids[first : first + len(state)] = self.symbols[slot]
            found = self.slots[slot]
            state = (found >> half) * (state >> self.precision) + (found & rest)
            low = np.flatnonzero(state < LOW)
            state[low] = state[low] << np.uint64(32) | words[at : at + len(low)]
            at += len(low)
            x[: len(state)] = state
        return ids


class WordEncoder:
    """The tokenizer over whole texts, through a bounded cache of their words.

    Byte-level BPE never joins what a lone space or line break between other characters
    separates, so the ids of a text without adjacent white space are those of its
    words, each with the space or line break before it. Any other text, and one that holds a special
    token of the tokenizer, is encoded in one call.
    """

    def __init__(self, definition: str, dtype: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = dtype
        self.line_break = self.encode("\n")
        self.words: dict[str, bytes] = {}
        self.bares: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def batch(self, texts: list[str]) -> list[Encoding]:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def add_joined(self, words: list[str], prefix: str) -> None:
        """Words that neither begin nor end with white space, joined by line breaks, which are
        tokens of their own; as they follow a space or a line break."""
        between, before = ("\n", self.line_break) if prefix else ("\n ", b"")
        joined = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        texts = [between[1:] + between.join(part) for part in joined]
        for part, encoding in zip(joined, self.batch(texts)):
            ids = np.array(encoding.ids, self.dtype)
            breaks = np.flatnonzero(ids == np.frombuffer(self.line_break, self.dtype)) * ids.itemsize
            if len(breaks) != len(part) - 1:
                raise RuntimeError("the tokenizer does not keep line breaks apart")
            blob, begins = ids.tobytes(), [0, *(breaks + ids.itemsize).tolist()]
            for word, begin, end in zip(part, begins, [*breaks.tolist(), None]):
                self.words[prefix + word] = before + blob[begin:end]

    def add(self, words: list[str]) -> None:
        """New different words that follow a space, or a line break if they begin with it.

        Letters before punctuation are a word of their own.
        """
        plain, lines, stems = [], [], {}
        for word in words:
            if not word[-1:].isalnum():
                found = STEM.fullmatch(word)
                if found and found[1].lstrip("\n").isalpha():
                    stems[word] = found[1]
                    continue
                if not word or word[-1].isspace():
                    self.words[word] = self.encode(word if word[:1] == "\n" else " " + word)
                    continue
            if word[0] == "\n":
                lines.append(word[1:])
            else:
                plain.append(word)
        self.add_joined(plain, "")
        self.add_joined(lines, "\n")
        new = [stem for stem in dict.fromkeys(stems.values()) if stem not in self.words]
        self.add_joined([stem for stem in new if stem[0] != "\n"], "")
        self.add_joined([stem[1:] for stem in new if stem[0] == "\n"], "\n")
        for word, stem in stems.items():
            self.words[word] = self.words[stem] + self.bare(word[len(stem) :])

    def bare(self, text: str) -> bytes:
        """A short text by itself: punctuation after a word, or the first word of a text."""
        found = self.bares.get(text)
        if found is None:
            if len(self.bares) >= CACHED_BARES:
                self.bares.clear()
            found = self.bares[text] = self.encode(text)
        return found

    def spaced(self, words: list[str]) -> list[bytes]:
        """Ids of different words with what is before them."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        found = list(map(self.words.get, words))
        if None in found:
            self.add([word for word, ids in zip(words, found) if ids is None])
            found = [ids or self.words[word] for word, ids in zip(words, found)]
        return found

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text. Arrow splits them and finds their different words."""
        texts = pc.fill_null(texts, "")
        whole = pc.or_(pc.equal(pc.binary_length(texts), 0), pc.match_substring_regex(texts, SPACES))
        for content in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, content))
        lines = pc.replace_substring(texts.filter(pc.invert(whole)), "\n", " \n")
        plain = pc.split_pattern(lines, " ")
        coded = plain.flatten().dictionary_encode()
        begins = plain.offsets.to_numpy()
        places = coded.indices.to_numpy().astype(np.int64)
        different = _split_again(coded.dictionary)
        first = [different[i] for i in places[begins[:-1]]]  # these follow no space
        values = pa.array([*self.spaced(different), *map(self.bare, first)], pa.binary())
        places[begins[:-1]] = len(different) + np.arange(len(first))
        ids = values.take(pa.array(places))
        cuts = np.frombuffer(ids.buffers()[1], np.int32)[begins].tolist() if len(ids) else []
        blob = ids.buffers()[2].to_pybytes() if len(ids) else b""
        plain_ids = iter([blob[i:j] for i, j in zip(cuts, cuts[1:])])
        return [
            self.encode(text.as_py()) if alone else next(plain_ids)
            for text, alone in zip(texts, whole.to_pylist())
        ]


def _split_again(words: pa.Array) -> list[str]:
    """Words without spaces, through one text, which is faster than an Arrow scalar for each."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")
    return joined[0].as_py().split(" ") if len(words) else []


def _encoder(definition: str, dtype: str) -> WordEncoder:
    name = hashlib.sha256(definition.encode()).hexdigest()
    if name not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        _encoders.clear()
        _encoders[name] = WordEncoder(definition, dtype)
    return _encoders[name]


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode all texts and write them to the folder ``path``.

    Each document ends with ``end_id``; a NULL or empty text has that id alone.
    Documents come in ascending order of their ids, NULL ids first, and equal ids in
    any fixed order. An empty table gives tables without rows; other columns are
    ignored. The ids are stored once between tokenizing and coding, as the
    frequency table must be known first; that table has the size of the vocabulary.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    size = max(Tokenizer.from_str(definition).get_vocab_size(), end_id + 1)
    dtype = "<u2" if size <= 1 << 16 else "<u4"
    shared = spark.sparkContext.broadcast(definition)

    rows = docs.select(
        F.col(quoted(id)).alias("id"), F.monotonically_increasing_id().alias("tie"), F.col(quoted(text)).alias("text")
    )
    schema = StructType([rows.schema["id"], rows.schema["tie"], *StructType.fromDDL("ids binary, counts binary")])

    def encode(batches):
        """The documents, and at the end of a task one row with its counts of ids."""
        release_caches(__name__)
        encoder = _encoder(shared.value, dtype)
        end = np.array([end_id], dtype).tobytes()
        counts, id_type = np.zeros(size, np.int64), None
        for batch in slices(batches, SLICE_BYTES):
            id_type = batch.schema.field("id").type
            ids = [ids + end for ids in encoder.encode_all(batch.column(2))]
            counts += np.bincount(np.frombuffer(b"".join(ids), dtype), minlength=size)
            columns = [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        if id_type is not None:
            blob = pa.array([counts.astype("<i8").tobytes()], pa.binary())
            columns = [pa.nulls(1, id_type), pa.array([-1]), pa.nulls(1, pa.binary()), blob]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    folder = shared_folder(spark, "tokens")
    # Ids of whole texts do not repeat, so a dictionary of them would be work for nothing.
    options = {"compression": "zstd", "parquet.enable.dictionary": "false"}
    rows.mapInArrow(encode, schema).write.options(**options).parquet(folder)
    stored_rows = spark.read.schema(schema).parquet(folder)
    encoded = stored_rows.filter("ids IS NOT NULL").select("id", "tie", "ids")

    def sum_up(batches):
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                counts += np.frombuffer(blob, "<i8")
        symbols = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(symbols), pa.array(counts[symbols])], ["symbol", "n"])

    counted = stored_rows.filter("counts IS NOT NULL").select("counts").mapInArrow(sum_up, "symbol bigint, n bigint")
    counts = np.zeros(size, np.int64)
    for symbol, n in counted.groupBy("symbol").agg(F.sum("n")).collect():
        counts[symbol] = n
    scaled = scaled_frequencies(counts)
    table = [(int(s), int(scaled[s])) for s in np.flatnonzero(scaled)]
    spark.createDataFrame(table, "symbol bigint, frequency bigint").coalesce(1).write.parquet(f"{path}/frequencies")

    coder = spark.sparkContext.broadcast(scaled)
    id_type = encoded.schema["id"].dataType
    block_schema = StructType([
        StructField("part", LongType()), StructField("start", LongType()),
        StructField("doc_ids", ArrayType(id_type)), StructField("doc_tokens", ArrayType(LongType())),
        *StructType.fromDDL(f"segments array<{SEGMENT}>"),
    ])

    def blocks(batches):
        rans, part, start = Rans(coder.value), TaskContext.get().partitionId(), 0
        names, parts, held = [], [], 0

        def block():
            nonlocal start, names, parts, held
            ids = np.frombuffer(b"".join(parts), dtype)
            row = {
                "part": part, "start": start, "doc_ids": names,
                "doc_tokens": [len(p) // ids.itemsize for p in parts], "segments": rans.encode(ids),
            }
            start += len(ids)
            names, parts, held = [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        arrow = None
        for batch in slices(batches):
            if arrow is None:
                arrow = _arrow_schema(batch.schema.field("id").type)
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(name)
                parts.append(ids)
                held += len(ids)
                if held >= BLOCK_TOKENS * np.dtype(dtype).itemsize:
                    yield block()
        if parts:
            yield block()

    order = [F.col("id").asc_nulls_first(), F.col("tie").asc()]
    placed = encoded.repartitionByRange(input_tasks(spark), *order).sortWithinPartitions(*order)
    stored(placed.select("id", "ids").mapInArrow(blocks, block_schema), path=f"{path}/blocks")
    delete_folder(spark, folder)


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    segment = pa.struct([("states", pa.binary()), ("words", pa.binary()), ("crc32", pa.int64())])
    return pa.schema([
        ("part", pa.int64()), ("start", pa.int64()), ("doc_ids", pa.list_(id_type)),
        ("doc_tokens", pa.list_(pa.int64())), ("segments", pa.list_(segment)),
    ])


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Per document: ``id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (little-endian unsigned 32-bit), or with ``digest`` their ``ids_crc32``.

    Parts are summed by a window over one row for each part; their number is that of
    the writer's tasks, which also bounds what the join broadcasts.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    table = spark.read.parquet(f"{path}/frequencies").collect()
    frequencies = np.zeros(max((r["symbol"] for r in table), default=-1) + 1, np.uint64)
    for row in table:
        frequencies[row["symbol"]] = row["frequency"]
    coder = spark.sparkContext.broadcast(frequencies)
    tokens = F.aggregate("doc_tokens", F.lit(0).cast("bigint"), lambda a, n: a + n)
    totals = blocks.groupBy("part").agg(F.sum(tokens).alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    located = blocks.join(F.broadcast(before), "part").select(
        (F.col("before") + F.col("start")).alias("start"), "doc_ids", "doc_tokens", "segments"
    )
    schema = StructType([
        StructField("id", blocks.schema["doc_ids"].dataType.elementType),
        *StructType.fromDDL("start bigint, n_tokens bigint, " + ("ids_crc32 bigint" if digest else "ids binary")),
    ])

    def decode(batches):
        rans = Rans(coder.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                left = sum(row["doc_tokens"])
                ids = []
                for segment in row["segments"]:
                    count = min(left, LANES * SEGMENT_STEPS)
                    ids.append(rans.decode(segment, count))
                    left -= count
                blob = memoryview(np.concatenate(ids).astype("<u4").tobytes())
                ends = np.cumsum(row["doc_tokens"])
                begins = ends - row["doc_tokens"]
                cut = [blob[4 * b : 4 * e] for b, e in zip(begins, ends)]
                last = pa.array(map(zlib.crc32, cut), pa.int64()) if digest else pa.array(map(bytes, cut), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(i, 1).flatten(), pa.array(row["start"] + begins),
                     pa.array(row["doc_tokens"], pa.int64()), last],
                    names=schema.names,
                )

    return located.mapInArrow(decode, schema)


def token_file_round_trip(
    docs: DataFrame, tokenizer_path: str, end_id: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write the token files of all documents, read them back, and return per row: id,
    ``start``, ``n_tokens`` and ``ids_crc32``. See ``write_token_files`` for NULLs, ties
    and empty tables."""
    path = shared_folder(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_path, end_id, id, text)
    return read_token_files(docs.sparkSession, path, digest=True).withColumnRenamed("id", id)
