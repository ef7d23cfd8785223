"""Interpolated modified Kneser-Ney model of words of any order, counted, stored and applied in Spark.

The model is a folder of sorted arrays that tasks map into memory. Words are known by 64-bit hashes;
the place of a word among all of them, in order of their hashes, is its number. N-grams of each order from 2 are
a sorted array of 64-bit hashes of their numbers with an array of their values. All are in parts of even
ranges of hashes, as many as the measured size of the training texts asks for, so that a part fits
a task whatever the size of the corpus, and no frequent word makes one part larger.

Counting sends the different n-grams of highest order of each block of texts to their parts. A part sums and saves
them, and sends to the order below what precedes each shorter n-gram and what follows each context, and so on down
to words. A text begins with as many begin marks as the context is long.

Scoring takes any texts. Their blocks send the hashes of their different n-grams to the parts, where one task maps
the part's arrays and answers all blocks, so a frequent n-gram costs each block one entry and no
part is mapped more than once for each order.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from postlens.functions.names import quoted
from postlens.llm import arrays
from postlens.llm.arrays import pack, unpack
from postlens.llm.common import finished, input_tasks, release_caches, shared_folder, slices, stored
from postlens.llm.language_id import held_out
from postlens.sources.scratch import delete_folder

END = b" "  # stands for the end of a text; no word holds a blank
BLOCK_BYTES = 8 << 20
PART_BYTES = 16 << 20  # of training text for each part
BATCH_BYTES = 2 << 20
MAX_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
TURNS = 4
FULL = 255  # marks an n-gram whose values stand in the list of large ones


@dataclass
class Block:
    """Tokens of whole texts: numbers of their words within the block, text by text."""

    rows: list[tuple]  # id, whether left out of training
    lengths: np.ndarray
    tokens: np.ndarray
    hashes: np.ndarray  # of the block's words
    training: np.ndarray  # for each token


def blocks(batches: Iterator[pa.RecordBatch], limit: int | None = None) -> Iterator[Block]:
    """Blocks of about ``limit`` (``BLOCK_BYTES``) bytes of text, from columns id, held_out, text."""
    release_caches(__name__)
    limit = limit or BLOCK_BYTES
    rows, texts, size = [], [], 0
    for batch in slices(batches):
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False) + 64)
        begin = 0
        while begin < batch.num_rows:
            done = int(ends[begin - 1]) if begin else 0
            end = min(batch.num_rows, int(np.searchsorted(ends, done + limit - size)) + 1)
            part = batch.slice(begin, end - begin)
            rows += zip(part.column(0).to_pylist(), part.column(1).to_pylist())
            texts.append(part.column(2))
            size += int(ends[end - 1]) - done
            begin = end
            if size >= limit:
                yield _block(rows, pa.concat_arrays(texts))
                rows, texts, size = [], [], 0
    if rows:
        yield _block(rows, pa.concat_arrays(texts))


def _block(rows: list[tuple], texts: pa.Array) -> Block:
    """Arrow splits the texts and finds their different words; each text gets its end."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = words.flatten().cast(pa.binary())
    real = pc.not_equal(flat, b"")  # white space at either end leaves an empty word
    offsets = words.offsets.to_numpy()
    lengths = np.diff(offsets) + 1
    if not pc.all(real).as_py():
        lengths = np.diff(np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[offsets - offsets[0]]) + 1
        flat = flat.filter(real)
    coded = flat.dictionary_encode()
    tokens = np.full(int(lengths.sum()), len(coded.dictionary), np.int64)
    inside = np.ones(len(tokens), bool)
    inside[np.cumsum(lengths) - 1] = False
    tokens[inside] = coded.indices.to_numpy()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, _names(coded.dictionary)), np.uint64, len(coded.dictionary) + 1)
    training = np.repeat(np.array([not held for _, held in rows]), lengths)
    return Block(rows, lengths, tokens, hashes, training)


def _names(dictionary: pa.Array) -> list[bytes]:
    """The words of the dictionary, and the end, without an Arrow scalar for each."""
    if not len(dictionary):
        return [END]
    _, places, data = dictionary.buffers()
    cuts = np.frombuffer(places, np.int32)[dictionary.offset : dictionary.offset + len(dictionary) + 1].tolist()
    data = data.to_pybytes() if data else b""
    return [*(data[begin:end] for begin, end in zip(cuts, cuts[1:])), END]


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of the keys, and the keys in it. Keys and places in one number sort faster than keys apart."""
    bits, room = len(keys).bit_length(), 64 - int(keys.max(initial=0)).bit_length()
    places = np.uint64((1 << bits) - 1)
    ordered = keys << np.uint64(min(bits, room))
    if bits > room:  # the last bits of the keys make room; equal first bits are then put in order
        ordered &= ~places
    ordered |= np.arange(len(keys), dtype=np.uint64)
    ordered.sort()
    order = (ordered & places).view(np.int64)
    if bits <= room:
        ordered >>= np.uint64(bits)
        return order, ordered
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        again = np.argsort(ordered, kind="stable")
        order, ordered = order[again], ordered[again]
    return order, ordered


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each different one of the ordered keys begins."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def _summed(keys: list[np.ndarray], *values: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Different keys in order, and the sums of their values."""
    order, key = _sorted(np.concatenate([np.empty(0, np.uint64), *keys]))
    first = _firsts(key)
    sums = []
    for value in values:
        value = np.concatenate([np.empty(0, np.uint64), *value])[order]
        sums.append(np.add.reduceat(value, first) if len(key) else value)
    return key[first], *sums


def _in_parts(hashes: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """The slice of the sorted hashes that each part gets, for parts that get any."""
    ends = np.searchsorted(_part_of(hashes, parts), np.arange(parts), side="right").tolist()
    for part, (begin, end) in enumerate(zip([0, *ends[:-1]], ends)):
        if begin < end:
            yield part, slice(begin, end)


@dataclass
class Vocabulary:
    """Sorted hashes and counts of all training words, in parts; numbers count through them."""

    folder: str
    offsets: np.ndarray  # of the parts, and the size
    tokens: int

    @property
    def parts(self) -> int:
        return len(self.offsets) - 1

    @property
    def size(self) -> int:
        return int(self.offsets[-1])

    @property
    def unknown(self) -> int:
        return self.size

    @property
    def begin(self) -> int:
        return self.size + 1

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (``unknown`` if not in training) and training counts."""
        numbers, counts = np.full(len(hashes), self.unknown, np.int64), np.zeros(len(hashes), np.int64)
        order = np.argsort(hashes)
        for part, places in _in_parts(hashes[order], self.parts):
            if self.offsets[part] == self.offsets[part + 1]:
                continue
            known = arrays.load(self.folder, f"words-{part}")
            asked = order[places]
            at = np.minimum(np.searchsorted(known, hashes[asked]), len(known) - 1)
            found = known[at] == hashes[asked]
            numbers[asked[found]] = at[found] + self.offsets[part]
            counts[asked[found]] = arrays.load(self.folder, f"counts-{part}")[at[found]]
        return numbers, counts


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python and back in batches of about ``BATCH_BYTES``, which the JVM and the worker hold at once."""
    before = spark.conf.get(MAX_BATCH)
    spark.conf.set(MAX_BATCH, f"{BATCH_BYTES}b")
    try:
        yield
    finally:
        spark.conf.set(MAX_BATCH, before)


def part_number(rows: DataFrame, part_bytes: int | None = None) -> int:
    """Parts for the training texts among rows (id, held_out, text), by their measured size."""
    size = F.sum(F.octet_length("text").cast("bigint") + 1)
    size = rows.filter("NOT held_out").agg(size.alias("size")).first()["size"] or 0
    return max(1, -(-size // (part_bytes or PART_BYTES)))


def count_words(rows: DataFrame, folder: str, parts: int) -> Vocabulary:
    """Count the training words of rows (id, held_out, text) into files of ``folder``."""

    def count(batches):
        for block in blocks(batches):
            counts = np.bincount(block.tokens[block.training], minlength=len(block.hashes))
            seen = np.flatnonzero(counts)
            seen = seen[np.argsort(block.hashes[seen])]
            hashes, counts = block.hashes[seen], counts[seen]
            for part, places in _in_parts(hashes, parts):
                row = [[part], [pack(hashes[places], True)], [pack(counts[places])]]
                yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), *map(pa.array, row[1:])], ["part", "words", "counts"])

    def merge(batches):
        part, words, counts = None, [], []
        for batch in batches:
            part = batch.column(0)[0].as_py()
            words += [unpack(x) for x in batch.column(1).to_pylist()]
            counts += [unpack(x) for x in batch.column(2).to_pylist()]
        if part is None:
            return
        known, sums = _summed(words, counts)
        arrays.save(folder, f"words-{part}", known)
        arrays.save(folder, f"counts-{part}", sums.astype(np.uint32) if sums.max(initial=0) < 1 << 32 else sums)
        row = [[part], [len(known)], [int(sums.sum())]]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in row], ["part", "size", "tokens"])

    sent = rows.filter("NOT held_out").mapInArrow(count, "part int, words binary, counts binary")
    with finished(rows.sparkSession) as keep:
        found = keep(sent.repartitionById(parts, F.col("part")).mapInArrow(merge, "part bigint, size bigint, tokens bigint"), "words")
        found = found.toArrow()
    sizes = np.zeros(parts, np.int64)
    sizes[found["part"].to_numpy()] = found["size"].to_numpy()
    return Vocabulary(folder, np.concatenate([[0], np.cumsum(sizes)]), int(found["tokens"].to_numpy().sum()))


BASE_FIELDS = "n_known array<bigint>, base_score array<double>, held_out array<boolean>"


def _block_row(block: Block, vocabulary: Vocabulary) -> tuple[np.ndarray, dict]:
    """The numbers of a block's words; its tokens, words, and what needs the vocabulary only."""
    total = vocabulary.tokens + vocabulary.size + 1
    numbers, counts = vocabulary.look_up(block.hashes)
    begins = np.cumsum(block.lengths) - block.lengths
    known = (counts > 0).astype(np.int64)[block.tokens]
    base = np.log10((counts + 1) / total)[block.tokens]
    rank = np.empty(len(numbers), np.int64)  # frequent words get small numbers, which pack well
    order = np.argsort(-np.bincount(block.tokens, minlength=len(numbers)), kind="stable")
    rank[order] = np.arange(len(order))
    return numbers, {
        "words": pack(numbers[order]), "tokens": pack(rank[block.tokens]),
        "lengths": block.lengths.tolist(), "n_known": np.add.reduceat(known, begins).tolist(),
        "base_score": np.add.reduceat(base, begins).tolist(),
        "held_out": [held for _, held in block.rows], "ids": [name for name, _ in block.rows],
    }


@dataclass
class Model:
    """The folder of arrays, and the few numbers that hold for all n-grams."""

    vocabulary: Vocabulary
    order: int
    discounts: dict[int, list[float]] = field(default_factory=dict)  # by order, from 2
    word_discounts: list[float] = field(default_factory=list)
    bigrams: int = 0  # different ones in training
    word_mass: float = 1.0  # of the uniform distribution, within the words'

    def words(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For words: their probability, their count as a context, and the mass that the
        context leaves to the words' distribution (1 if it is new)."""
        vocabulary = self.vocabulary
        values = np.zeros((5, len(numbers)))  # contexts of the word; words after it: in all, with count 1, 2, more
        order = np.argsort(numbers)
        cuts = _word_cuts(vocabulary.size + 2, vocabulary.parts)
        ends = np.searchsorted(numbers[order], cuts[1:].astype(np.int64))
        for part, (begin, end) in enumerate(zip([0, *ends[:-1]], ends)):
            if begin < end and self.bigrams and arrays.exists(vocabulary.folder, f"small-margins-{part}"):
                at = numbers[order[begin:end]] - int(cuts[part])
                found = arrays.load(vocabulary.folder, f"small-margins-{part}")[:, at].astype(np.uint64)
                full = np.flatnonzero(found[0] == FULL)
                if len(full):
                    large = arrays.load(vocabulary.folder, f"large-margins-{part}")
                    found[:, full] = large[1:, np.searchsorted(large[0], at[full].astype(np.uint64))]
                values[:, order[begin:end]] = found
        contexts, after, ones, twos, more = values
        probability = self.word_mass / (vocabulary.size + 1) + np.zeros(len(numbers))
        if self.bigrams:
            probability += _discounted(contexts, self.word_discounts) / self.bigrams
        d = self.discounts[2]
        left = (d[0] * ones + d[1] * twos + d[2] * more) / np.maximum(after, 1)
        return probability, after, np.where(after > 0, left, 1.0)


def _discounted(counts: np.ndarray, discounts: list[float]) -> np.ndarray:
    d = np.array([0.0, *discounts])[np.minimum(counts, 3).astype(np.int64)]
    return np.maximum(counts - d, 0)


def _word_cuts(size: int, parts: int) -> np.ndarray:
    return np.arange(parts + 1, dtype=np.int64) * size // parts


def _discounts(n: list[int]) -> list[float]:
    """For counts 1, 2 and 3 or more, from the numbers of keys with count 1 to 4."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = [1 - 2 * y * n2 / n1 if n1 else 0.0, 2 - 3 * y * n3 / n2 if n2 else 0.0, 3 - 4 * y * n4 / n3 if n3 else 0.0]
    # Tiny corpora can give estimates out of range; the plain discount then serves.
    return [d if 0 < d < k + 1 else 0.5 for k, d in enumerate(found)]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the keys, where in it each different key begins, and for each key its place among those."""
    order, ordered = _sorted(keys)
    first = _firsts(ordered)
    place = np.empty(len(keys), np.uint32)
    place[order] = np.repeat(np.arange(len(first), dtype=np.uint32), np.diff(first, append=len(keys)))
    return order, first, place


def _grams_of(words: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary, order: int):
    """For each token, and last for a context of begins: the place of what stands before, and for each order from 2
    the sorted hashes of the different n-grams, whether all their words are known, and the number of the token's own."""
    n = len(words)
    before = np.arange(-1, n)
    before[np.cumsum(lengths) - lengths] = n
    before[n] = n
    words = np.append(words, vocabulary.begin).astype(np.uint64)
    known_words = words != np.uint64(vocabulary.unknown)
    hashes, known, levels = gram_hashes(words[None]), known_words, {}
    for level in range(2, order + 1):
        hashes, known = _longer(hashes[before], words), known[before] & known_words
        by_hash, ordered = _sorted(hashes)
        first = _firsts(ordered)
        own = np.empty(len(hashes), np.uint32)
        own[by_hash] = np.repeat(np.arange(len(first), dtype=np.uint32), np.diff(first, append=len(hashes)))
        levels[level] = ordered[first], known[by_hash[first]], own
    return words, before, levels


def _longer(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of all words but the last, and the last."""
    state = (state ^ words) * np.uint64(0xBF58476D1CE4E5B9)
    state ^= state >> np.uint64(31)
    state *= np.uint64(0x94D049BB133111EB)
    state ^= state >> np.uint64(29)
    return state


def gram_hashes(grams: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each column of word numbers."""
    return reduce(_longer, grams, np.ones(grams.shape[1], np.uint64))


def _save_values(folder: str, name: str, small: np.ndarray, fit: np.ndarray, values: np.ndarray) -> None:
    """A byte for each small value, and a list of the columns that do not fit."""
    large = np.flatnonzero(~fit)
    arrays.save(folder, f"small-{name}", np.where(fit, small, FULL).astype(np.uint8))
    arrays.save(folder, f"large-{name}", np.stack([large.astype(np.uint64), *values[:, large]]))


def save_grams(folder: str, level: int, part: int, hashes: np.ndarray, values: np.ndarray) -> None:
    """The sorted hashes and the values of a part's n-grams.

    Hashes are stored as three arrays of 16 bits; the first 16 bits change seldom and are listed with their numbers.
    Values are one row (counts) or five: counts, and as a context what follows: in all, once, twice, more
    often. They take a byte each, the last three together one; those that do not fit are listed apart.
    """
    small = values[:2]
    fit = (small < FULL).all(axis=0)
    if len(values) > 1:
        _, _, ones, twos, more = values
        shape = ones + (twos << np.uint64(4)) + (more << np.uint64(6))
        fit &= (ones < 16) & (twos < 4) & (more < 4)
        small = np.stack([*small, shape])
    rests = np.ascontiguousarray(hashes.astype("<u8").view("<u2").reshape(-1, 4)[:, :3].T)
    tops = hashes >> np.uint64(48)
    first = _firsts(tops)
    arrays.save(folder, f"grams-{level}-{part}", rests)
    arrays.save(folder, f"tops-{level}-{part}", np.stack([tops[first], np.diff(first, append=len(tops)).astype(np.uint64)]))
    _save_values(folder, f"{level}-{part}", small, fit, values)


def load_grams(folder: str, level: int, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The sorted hashes of a part, and its mapped values, small and large; None if it has no n-grams."""
    if not arrays.exists(folder, f"grams-{level}-{part}"):
        return None
    rests, tops, small, large = (arrays.load(folder, f"{name}-{level}-{part}") for name in ("grams", "tops", "small", "large"))
    known = np.empty((rests.shape[1], 4), "<u2")
    known[:, :3] = rests.T
    known[:, 3] = np.repeat(tops[0].astype("<u2"), tops[1].astype(np.int64))
    return known.reshape(-1).view("<u8"), small, large


def values_of(grams: tuple[np.ndarray, np.ndarray, np.ndarray] | None, asked: np.ndarray, rows: int) -> np.ndarray:
    """The values of sorted hashes, from what ``load_grams`` gave; zero for those it does not have."""
    result = np.zeros((rows, len(asked)), np.uint64)
    if grams is None:
        return result
    known, small, large = grams
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    found = np.flatnonzero(known[at] == asked)
    at = at[found]
    values = small[:, at].astype(np.uint64)
    full = np.flatnonzero(values[0] == FULL)
    if rows > 1:
        shape = values[2]
        values = np.stack([*values[:2], shape & np.uint64(15), shape >> np.uint64(4) & np.uint64(3), shape >> np.uint64(6)])
    if len(full):
        values[:, full] = large[1:, np.searchsorted(large[0], at[full].astype(np.uint64))]
    result[:, found] = values
    return result


def load_values(folder: str, level: int, part: int, asked: np.ndarray, rows: int) -> np.ndarray:
    """The values of sorted hashes in a part; zero for those it does not have."""
    return values_of(load_grams(folder, level, part), asked, rows)


COUNT, BEFORE, AFTER, NUMBERS = range(4)  # kinds of rows
GRAM_FIELDS = "kind int, part int, grams array<binary>, values array<binary>, numbers array<bigint>"
GRAM_SCHEMA = pa.schema([
    ("kind", pa.int32()), ("part", pa.int32()), ("grams", pa.list_(pa.binary())), ("values", pa.list_(pa.binary())),
    ("numbers", pa.list_(pa.int64())),
])


def _gram_rows(kind: int, grams: np.ndarray, values: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """A row for each part that gets any of the n-grams, which stay in their order."""
    part = _part_of(gram_hashes(grams), parts).astype(np.uint16 if parts <= 1 << 16 else np.uint32)  # numbers of 16 bits sort faster
    order = np.argsort(part, kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=parts)).tolist()
    for k, (begin, end) in enumerate(zip([0, *ends[:-1]], ends)):
        if begin < end:
            places = order[begin:end]
            row = {
                "kind": kind, "part": k, "grams": [pack(column[places], not i) for i, column in enumerate(grams)],
                "values": [pack(v[places]) for v in values],
            }
            yield pa.RecordBatch.from_pylist([row], schema=GRAM_SCHEMA)


def _keys(grams: np.ndarray, base: int) -> np.ndarray:
    """One number for each n-gram, equal for equal ones and in their order. Words are less than ``base``."""
    keys, room = grams[0], base
    for column in grams[1:]:
        if room * base >= 1 << 64:
            keys, room = _distinct(keys)[2].astype(np.uint64), 1 << 32
        keys, room = keys * np.uint64(base) + column, room * base
    return keys


def block_grams(rows: DataFrame, vocabulary: Vocabulary, order: int) -> DataFrame:
    """The different training n-grams of highest order of each block, with their counts, dealt to parts."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def send(batches):
        vocabulary = shared.value
        for block in blocks(batches):
            numbers, _ = vocabulary.look_up(block.hashes)
            by_number = np.argsort(numbers)
            rank = np.empty(len(numbers) + 1, np.uint64)  # within the block, and last the begin
            rank[by_number] = np.arange(len(numbers))
            rank[-1] = len(numbers)
            numbers = np.append(numbers[by_number], vocabulary.begin).astype(np.uint64)
            begins = np.repeat(np.cumsum(block.lengths) - block.lengths, block.lengths)
            place = np.arange(len(block.tokens))
            columns = []
            for k in range(order - 1, -1, -1):
                at = place - k
                columns.append(rank[np.where(at >= begins, block.tokens[np.maximum(at, 0)], -1)])
            grams = np.stack(columns)
            in_order, ordered = _sorted(_keys(grams, len(numbers)))
            first = _firsts(ordered)
            counts = np.diff(np.append(first, len(place))).astype(np.uint64)[None]
            yield from _gram_rows(COUNT, numbers[grams[:, in_order[first]].astype(np.int64)], counts, vocabulary.parts)

    return rows.filter("NOT held_out").mapInArrow(send, GRAM_FIELDS)


def count_grams(sent: DataFrame, vocabulary: Vocabulary, level: int, order: int) -> DataFrame:
    """Sum and save the n-grams of one order; the result is what the order below gets.

    The count of an n-gram is, in a lower order, the number of different words before it.
    """
    shared, rows_of_values = sent.sparkSession.sparkContext.broadcast(vocabulary), 1 if level == order else 5

    def count(batches):
        vocabulary = shared.value
        part, columns, values = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                grams, given = (np.stack([unpack(x) for x in row[c]]) for c in ("grams", "values"))
                value = np.zeros((rows_of_values, grams.shape[1]), np.uint64)
                first = 1 if row["kind"] == AFTER else 0
                value[first : first + len(given)] = given
                columns.append(grams)
                values.append(value)
        if part is None:
            return
        grams, values = np.concatenate(columns, axis=1), np.concatenate(values, axis=1)
        columns.clear()
        hashes = gram_hashes(grams)
        by_hash, hashes = _sorted(hashes)
        first = _firsts(hashes)
        values = np.stack([np.add.reduceat(v[by_hash], first) for v in values])
        hashes, grams = hashes[first], grams[:, by_hash[first]]  # one of each
        del by_hash, first
        save_grams(vocabulary.folder, level, part, hashes, values)
        del hashes
        counts = values[0]
        del values
        seen = np.flatnonzero(counts)
        if not len(seen):
            return
        if len(seen) < len(counts):
            grams, counts = grams[:, seen], counts[seen]
        del seen
        if level == 2:  # each word is one number: the margins take it from here
            yield from _margin_rows(grams[0], grams[1], counts, _word_cuts(vocabulary.size + 2, vocabulary.parts))
            return
        numbers = [[int((counts == k).sum()) for k in range(1, 5)]]
        row = [pa.array([NUMBERS], pa.int32()), pa.array([part], pa.int32()), *([pa.array([None], pa.list_(pa.binary()))] * 2)]
        yield pa.RecordBatch.from_arrays([*row, pa.array(numbers, pa.list_(pa.int64()))], schema=GRAM_SCHEMA)
        for kind, shorter in ((AFTER, grams[:-1]), (BEFORE, grams[1:])):
            order_of, ordered = _sorted(_keys(shorter, vocabulary.size + 2))
            first = _firsts(ordered)
            del ordered
            given = [np.diff(first, append=len(counts))] if kind == BEFORE else _following(counts[order_of], first)
            yield from _gram_rows(kind, shorter[:, order_of[first]], np.stack(given).astype(np.uint64), vocabulary.parts)

    dealt = sent.filter(F.col("kind") != NUMBERS).repartitionById(vocabulary.parts, F.col("part"))
    return dealt.select("kind", "part", "grams", "values").mapInArrow(count, GRAM_FIELDS if level > 2 else MARGIN_FIELDS)


def _sums(rows: DataFrame, array: str, n: int) -> list[int]:
    found = rows.agg(*(F.sum(F.get(array, F.lit(i))) for i in range(n))).first()
    return [int(x or 0) for x in found]


def fit(rows: DataFrame, order: int, folder: str, part_bytes: int | None = None) -> Model:
    """Learn from the rows (id, held_out, text) that are not held out. The model's arrays go to ``folder``."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    with _small_batches(rows.sparkSession):
        return _fitted(rows, order, folder, part_bytes)


def _fitted(rows: DataFrame, order: int, folder: str, part_bytes: int | None) -> Model:
    vocabulary = count_words(rows, folder, part_number(rows, part_bytes))
    model = Model(vocabulary, order)
    sent, used = block_grams(rows, vocabulary, order), []
    for level in range(order, 1, -1):
        # The n-grams of the texts come in one go, and those that are stored in turns, so that little of them lies in shuffles.
        turns = TURNS if used else 1
        own = [sent.filter(F.col("part") % turns == turn) if used else sent for turn in range(turns)]
        paths = [shared_folder(rows.sparkSession, f"order-{level}") for _ in own]
        tables = [stored(count_grams(x, vocabulary, level, order), path=path) for x, path in zip(own, paths)]
        for path in used:
            delete_folder(rows.sparkSession, path)
        sent, used = reduce(DataFrame.union, tables), paths
        if level > 2:
            model.discounts[level] = _discounts(_sums(sent, "numbers", 4))
    _merge_margins(sent, model)
    for path in used:
        delete_folder(rows.sparkSession, path)
    return model


MARGIN_FIELDS = "part int, contexts binary, after array<binary>, words binary, before binary, numbers_of array<bigint>"
MARGIN_SCHEMA = pa.schema([
    ("part", pa.int32()), ("contexts", pa.binary()), ("after", pa.list_(pa.binary())), ("words", pa.binary()),
    ("before", pa.binary()), ("numbers_of", pa.list_(pa.int64())),
])


def _following(counts: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """What follows each context, whose n-grams stand together: in all, once, twice, more often."""
    if not len(counts):
        return [np.empty(0, np.uint64)] * 4
    rows = counts, counts == 1, counts == 2, counts > 2
    return [np.add.reduceat(row, first, dtype=np.uint64) for row in rows]


def _margin_rows(contexts: np.ndarray, words: np.ndarray, sums: np.ndarray, word_cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """From different bigrams and their counts, what each part of the words gets."""
    by_context, ordered = _sorted(contexts)
    after = [ordered[(first := _firsts(ordered))], *_following(sums[by_context], first)]
    ordered = np.sort(words)
    first = _firsts(ordered)
    before = ordered[first], np.diff(first, append=len(words))
    numbers_of = [int((sums == k).sum()) for k in range(1, 5)]
    for part in range(len(word_cuts) - 1):
        low, high = word_cuts[part], word_cuts[part + 1]
        a, b = np.searchsorted(after[0], [low, high])
        c, d = np.searchsorted(before[0], [low, high])
        if a < b or c < d or (part == 0 and len(sums)):
            yield pa.RecordBatch.from_pylist([{
                "part": part, "contexts": pack(after[0][a:b], True), "after": [pack(x[a:b]) for x in after[1:]],
                "words": pack(before[0][c:d], True), "before": pack(before[1][c:d]),
                "numbers_of": numbers_of if part == 0 else [0] * 4,
            }], schema=MARGIN_SCHEMA)


def _merge_margins(sent: DataFrame, model: Model) -> None:
    """Save the margins of the words, and sum up what holds for all of them."""
    vocabulary = model.vocabulary
    parts, folder = vocabulary.parts, vocabulary.folder
    word_cuts = _word_cuts(vocabulary.size + 2, parts)

    def merge(batches):
        part, numbers_of, margins = None, np.zeros(4, np.int64), None
        for batch in batches:
            for row in batch.to_pylist():
                if part is None:
                    part = row["part"]
                    low, high = int(word_cuts[part]), int(word_cuts[part + 1])
                    margins = np.zeros((5, high - low), np.uint64)
                np.add.at(margins[0], (unpack(row["words"]).astype(np.int64) - low), unpack(row["before"]))
                contexts = unpack(row["contexts"]).astype(np.int64) - low
                for k, values in enumerate(row["after"]):
                    np.add.at(margins[k + 1], contexts, unpack(values))
                numbers_of += row["numbers_of"]
        if part is None:
            return
        _save_values(folder, f"margins-{part}", margins, (margins < FULL).all(axis=0), margins)
        contexts = margins[0]
        words_with = [int((contexts == k).sum()) for k in range(1, 5)] + [int((contexts > 2).sum())]
        yield pa.RecordBatch.from_pylist([{
            "bigrams_with": numbers_of.tolist(), "words_with": [*words_with, int(contexts.sum(dtype=np.int64))],
        }])

    merged = sent.repartitionById(parts, F.col("part")).mapInArrow(merge, "bigrams_with array<bigint>, words_with array<bigint>")
    with finished(sent.sparkSession) as keep:
        found = keep(merged, "sums")
        model.discounts[2] = _discounts(_sums(found, "bigrams_with", 4))
        words_with = _sums(found, "words_with", 6)
    model.bigrams = words_with[5]
    model.word_discounts = _discounts(words_with[:4])
    numbers = [words_with[0], words_with[1], words_with[4]]
    if model.bigrams:
        model.word_mass = sum(d * n for d, n in zip(model.word_discounts, numbers)) / model.bigrams


def encode_blocks(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The texts as blocks: tokens, words, and what needs the vocabulary only."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    fields = f"block bigint, words binary, tokens binary, lengths array<bigint>, {BASE_FIELDS}"
    schema = StructType([*StructType.fromDDL(fields), StructField("ids", ArrayType(rows.schema["id"].dataType))])

    def encode(batches):
        arrow = None

        def typed(batches):
            nonlocal arrow
            for batch in batches:
                arrow = arrow or pa.schema([
                    ("block", pa.int64()), ("words", pa.binary()), ("tokens", pa.binary()), ("lengths", pa.list_(pa.int64())),
                    ("n_known", pa.list_(pa.int64())), ("base_score", pa.list_(pa.float64())),
                    ("held_out", pa.list_(pa.bool_())), ("ids", pa.list_(batch.schema.field("id").type)),
                ])
                yield batch

        for k, block in enumerate(blocks(typed(batches))):
            _, row = _block_row(block, shared.value)
            row["block"] = (TaskContext.get().partitionId() << 32) + k
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    return rows.mapInArrow(encode, schema)


def _asked(row: dict, vocabulary: Vocabulary, order: int):
    """Of a block: text lengths, the words, what stands before each token, the n-grams by order, and for each order from 2
    the sorted hashes of those without an unknown word, as no other is in training, and their places."""
    lengths = np.array(row["lengths"])
    words = unpack(row["words"]).astype(np.int64)[unpack(row["tokens"]).view(np.int64)]
    words, before, levels = _grams_of(words, lengths, vocabulary, order)
    asked = {}
    for level, (hashes, known, _) in levels.items():
        places = np.flatnonzero(known)
        asked[level] = hashes[places], places
    return lengths, words, before, levels, asked


def answers(encoded: DataFrame, model: Model) -> DataFrame:
    """The values of the n-grams of all blocks, from the stored arrays: a row for each block, order and part."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def ask(batches):
        vocabulary = shared.value.vocabulary
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                for level, (hashes, _) in _asked(row, vocabulary, model.order)[4].items():
                    for part, places in _in_parts(hashes, vocabulary.parts):
                        numbers = (pa.array([x], kind) for x, kind in ((level, pa.int32()), (part, pa.int32()), (row["block"], pa.int64())))
                        yield pa.RecordBatch.from_arrays([*numbers, pa.array([pack(hashes[places], True)])], names)

    def answer(batches):
        folder, grams = shared.value.vocabulary.folder, {}
        for batch in batches:
            for level, part, block, hashes in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (level, part) not in grams:
                    grams[level, part] = load_grams(folder, level, part)
                values = values_of(grams[level, part], unpack(hashes), 1 if level == model.order else 5)
                row = [[level], [part], [block], [[pack(v) for v in values]]]
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], ["level", "part", "block", "values"])

    names = ["level", "part", "block", "hashes"]
    asked = encoded.select("block", "words", "tokens", "lengths").mapInArrow(ask, "level int, part int, block bigint, hashes binary")
    dealt = asked.repartitionById(model.vocabulary.parts, F.col("part"))
    return dealt.mapInArrow(answer, "level int, part int, block bigint, values array<binary>")


def score(rows: DataFrame, model: Model, turns: int | None = None) -> DataFrame:
    """Per row of (id, held_out, text): ``id``, ``held_out``, ``n_tokens``, ``n_known``, ``base_score`` and ``score``.

    The texts need not be those that the model was learned from. Their blocks are answered and scored in ``turns`` (``TURNS``),
    each of which deletes what was asked and answered. The results are stored in the shared folder.
    """
    spark, scores, turns = rows.sparkSession, [], turns or TURNS
    with _small_batches(spark), finished(spark) as keep:
        encoded = keep(encode_blocks(rows, model.vocabulary), "blocks")
        tasks = max(input_tasks(spark), -(-encoded.count() // (4 * turns)))
        schema = StructType([
            StructField("id", encoded.schema["ids"].dataType.elementType),
            *StructType.fromDDL("held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"),
        ])
        for turn in range(turns):
            own = encoded.filter(F.pmod(F.xxhash64("block"), F.lit(turns)) == turn)
            with finished(spark) as keep_answers:
                joined = own.unionByName(keep_answers(answers(own, model), "answers"), allowMissingColumns=True)
                joined = joined.repartition(tasks, "block").sortWithinPartitions("block", F.col("level").asc_nulls_first(), "part")
                scores.append(stored(joined.mapInArrow(_block_scorer(model, schema.names), schema), "scores"))
    return reduce(DataFrame.union, scores)


def _block_scorer(model: Model, names: list[str]):
    order = model.order

    def scored(row, answers):
        lengths, words, before, levels, asked = _asked(row, model.vocabulary, order)
        by_word, first, ids = _distinct(words)
        probability, after, left = model.words(words[by_word[first]].astype(np.int64))
        likely = probability[ids]
        for level in range(2, order + 1):
            own = levels[level][2]
            values = np.zeros((1 if level == order else 5, len(levels[level][0])))
            hashes, places = asked[level]
            parts = list(_in_parts(hashes, model.vocabulary.parts))
            if len(parts) != len(answers.get(level, [])):
                raise RuntimeError("a block lacks the answer of a part")
            for (_, at), answer in zip(parts, answers.get(level, [])):
                values[:, places[at]] = [unpack(x) for x in answer]
            context, ids = ids[before], own
            likely = _discounted(values[0], model.discounts[level])[own] / np.maximum(after, 1)[context] + left[context] * likely
            if level < order:
                _, after, ones, twos, more = values
                d = model.discounts[level + 1]
                left = np.where(after > 0, (d[0] * ones + d[1] * twos + d[2] * more) / np.maximum(after, 1), 1.0)
        sums = np.add.reduceat(np.log10(likely[:-1]), np.cumsum(lengths) - lengths)
        return [row["ids"], row["held_out"], row["lengths"], row["n_known"], row["base_score"], sums]

    def run(batches):
        row, answers, kinds = None, {}, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(scored(row, answers), kinds)], names=names)

        for batch in batches:
            kinds = [batch.schema.field("ids").type.value_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            for i in range(batch.num_rows):
                new = batch.slice(i, 1).to_pylist()[0]
                if new["level"] is None:
                    if row is not None:
                        yield done()
                    row, answers = new, {}
                else:
                    answers.setdefault(new["level"], []).append(new["values"])
        if row is not None:
            yield done()

    return run


def training_rows(docs: DataFrame, id: str, text: str, folds: int, fold: int) -> DataFrame:
    columns = F.col(quoted(id)).alias("id"), held_out(id, folds, fold).alias("held_out"), F.col(quoted(text)).alias("text")
    return docs.select(*columns)


def language_model_scores(
    docs: DataFrame, id: str = "doc_id", text: str = "text", folds: int = 7, fold: int = 2, order: int = 2, part_bytes: int | None = None
) -> DataFrame:
    """Learn from the texts that are not held out and score all: id, ``held_out``,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one unigrams) and
    ``score``, the log10 probability of the text with its end by a model of words with ``order - 1``
    words of context.

    A NULL or blank text has the end as its only token. Words that are not in training
    share the probability of one more word. Without training texts every
    probability is 1. Repeated rows come back as often as they occur, an empty table
    gives an empty result, and other columns are ignored. The model is deleted when all are scored; ``fit`` keeps it.
    """
    rows = training_rows(docs, id, text, folds, fold)
    folder = shared_folder(docs.sparkSession, "kneser-ney")
    model = fit(rows, order, folder, part_bytes)
    scores = score(rows, model)
    delete_folder(docs.sparkSession, folder)
    return scores.select(
        F.col("id").alias(id), "held_out", "n_tokens", "n_known",
        F.lit(model.vocabulary.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
