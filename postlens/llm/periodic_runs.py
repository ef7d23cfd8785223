"""Periodic runs of words, found through recompression.

The words of several texts, kept apart by words that occur once, are compressed by turns:
blocks of equal symbols become one symbol each, then pairs of a left and a right symbol
do, until one is left. Equal stretches are compressed alike but for their edges, so the
levels of this run-length grammar answer how far two places agree in a few steps for each
level. A run of period p and length 2 p or more holds two neighbouring places of the grid
0, p, 2 p, ...; the places that agree there are extended to both sides by grammar queries.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.names import quoted
from postlens.llm.common import map_texts
from postlens.llm.line_quality import SPACE

MIN_LENGTH = 12
WORDS_AT_ONCE = 200_000
PAIRS_AT_ONCE = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Grammar:
    """Levels of symbols; level k + 1 has ``starts[k + 1]``, the place in level k where each symbol begins, and
    one more for the end. ``blocks[k]`` tells whether level k came from blocks or from pairs."""

    def __init__(self, symbols: np.ndarray):
        self.symbols, self.starts, self.blocks = [symbols], [np.empty(0, np.int64)], [False]
        self.names = int(symbols.max(initial=0)) + 1
        seed = 0
        while len(self.symbols[-1]) > 1:
            self._compress_blocks()
            seed = self._compress_pairs(seed)

    def _named(self, keys: np.ndarray) -> np.ndarray:
        different, place = np.unique(keys, return_inverse=True)
        self.names += len(different)
        return self.names - len(different) + place

    def _compress_blocks(self) -> None:
        below = self.symbols[-1]
        begins = np.concatenate([[0], np.flatnonzero(below[1:] != below[:-1]) + 1])
        if len(begins) == len(below):
            return
        starts = np.append(begins, len(below))
        lengths = np.diff(starts)
        symbols = below[begins]
        many = lengths > 1
        symbols[many] = self._named(symbols[many] * (lengths.max() + 1) + lengths[many])
        self._append(symbols, starts, True)

    def _compress_pairs(self, seed: int) -> int:
        """Symbols are dealt into left and right ones, the better way round of two."""
        below = self.symbols[-1]
        while len(below) > 1:
            seed += 1
            side = (below.astype(np.uint64) * _MIX + np.uint64(seed) * (_MIX >> np.uint64(7))) * _MIX >> np.uint64(63) > 0
            rising, falling = side[:-1] & ~side[1:], side[1:] & ~side[:-1]
            firsts = np.flatnonzero(rising if rising.sum() >= falling.sum() else falling)
            if len(firsts):
                break
        else:
            return seed
        begins = np.delete(np.arange(len(below)), firsts + 1)
        symbols = below[begins]
        named = self._named(below[firsts] * self.names + below[firsts + 1])
        symbols[firsts - np.arange(len(firsts))] = named
        self._append(symbols, np.append(begins, len(below)), False)
        return seed

    def _append(self, symbols: np.ndarray, starts: np.ndarray, blocks: bool) -> None:
        self.symbols.append(symbols)
        self.starts.append(starts)
        self.blocks.append(blocks)

    def mirrored(self) -> Grammar:
        """The grammar of the reversed sequence."""
        other = object.__new__(Grammar)
        other.symbols = [s[::-1] for s in self.symbols]
        other.blocks = self.blocks
        below = [0, *map(len, self.symbols)]
        other.starts = [(n - s)[::-1] for n, s in zip(below, self.starts)]
        return other

    def common_extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols agree from places ``a`` and from places ``b``.

        ``a`` and ``b`` differ everywhere, and the last symbol of the sequence occurs once.
        """
        first, number = a, np.arange(len(a))
        stopped = []  # by level: which pairs differ there, and where
        for level, symbols in enumerate(self.symbols):
            equal = symbols[a] == symbols[b]
            ends = [(number[~equal], a[~equal], b[~equal])]
            stopped.append(ends)
            number, a, b = number[equal], a[equal], b[equal]
            if not len(number):
                break
            starts = self.starts[level + 1]
            at, bt = (np.searchsorted(starts, x, side="right") - 1 for x in (a, b))
            begin = (starts[at] == a) & (starts[bt] == b)
            step = np.where(begin, 0, np.minimum(starts[at + 1] - a, starts[bt + 1] - b))
            a, b = a + step, b + step
            at, bt = at + (starts[at + 1] == a), bt + (starts[bt + 1] == b)
            # Pairs meet again after one symbol. Blocks of which different parts are left do not.
            begin = (starts[at] == a) & (starts[bt] == b)
            ends.append((number[~begin], a[~begin], b[~begin]))
            number, a, b = number[begin], at[begin], bt[begin]
        number, a, b = (np.empty(0, np.int64) for _ in range(3))
        for level in range(len(stopped) - 1, -1, -1):
            number, a, b = (np.concatenate([x, *parts]) for x, parts in zip((number, a, b), zip(*stopped[level])))
            if level:
                starts, symbols = self.starts[level], self.symbols[level - 1]
                size = np.minimum(starts[a + 1] - starts[a], starts[b + 1] - starts[b]) if self.blocks[level] else 1
                a, b = starts[a], starts[b]
                step = np.where(symbols[a] == symbols[b], size, 0)
                a, b = a + step, b + step
        result = np.empty(len(first), np.int64)
        result[number] = a - first[number]
        return result


def _grid(sizes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For all texts: number of the text, period, and place of all neighbouring grid places, in chunks."""
    halves = sizes // 2
    text = np.repeat(np.arange(len(sizes)), halves)
    period = np.arange(len(text)) - np.repeat(np.cumsum(halves) - halves, halves) + 1
    many = (sizes[text] - 1) // period
    total = np.cumsum(many)
    begin = 0
    while begin < len(text):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + PAIRS_AT_ONCE, side="right")))
        n = many[begin:end]
        step = np.repeat(period[begin:end], n)
        turn = np.arange(len(step)) - np.repeat(np.cumsum(n) - n, n)
        which = np.repeat(text[begin:end], n)
        yield which, step, offsets[which] + step * turn
        begin = end


def _candidates(sequence: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, min_length: int):
    """Grid places with as many agreeing neighbours on one side as every run has."""
    side = ((min_length + 1) // 2) // 2
    last = len(sequence) - 1
    found = []
    for which, step, place in _grid(sizes, offsets):
        agree = np.flatnonzero(sequence[place] == sequence[place + step])
        which, step, place = which[agree], step[agree], place[agree]
        wanted = np.zeros(len(place), bool)
        for direction in (1, -1):
            same = np.ones(len(place), bool)
            for k in range(1, side + 1):
                at = place + direction * k
                same &= sequence[np.clip(at, 0, last)] == sequence[np.clip(at + step, 0, last)]
            wanted |= same
        found.append((which[wanted], step[wanted], place[wanted]))
    return (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3


def runs_of(texts: list[np.ndarray], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """For each sequence of numbers its runs (start, length, smallest period), by start, then period.

    A run is a stretch of at least ``min_length`` and twice its smallest period that cannot be
    extended with that period.
    """
    result: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    sequence, offsets = _joined(texts, sizes)
    which, step, place = _candidates(sequence, sizes, offsets, min_length)
    if not len(which):
        return result
    # The grammar is of the texts with candidates only.
    used, which = np.unique(which, return_inverse=True)
    place = place - offsets[used][which]
    sequence, offsets = _joined([texts[i] for i in used], sizes[used])
    place = place + offsets[which]
    grammar = Grammar(sequence)
    ahead = grammar.common_extension(place, place + step)
    mirror, end = grammar.mirrored(), len(sequence)
    back = mirror.common_extension(end - place, end - place - step)
    length = back + step + ahead
    enough = length >= np.maximum(min_length, 2 * step)
    found = np.stack([which, place - back - offsets[which], length, step])[:, enough]
    # Of all periods that give the same stretch the smallest is the run's.
    found = found[:, np.lexsort(found[::-1])]
    new = np.ones(found.shape[1], bool)
    new[1:] = (found[:3, 1:] != found[:3, :-1]).any(0)
    found = found[:, new]
    found = found[:, np.lexsort((found[3], found[1], found[0]))]
    for text, start, size, period in found.T.tolist():
        result[used[text]].append((start, size, period))
    return result


def _joined(texts: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All sequences as one, with a number of its own before, between and behind them, and where each begins."""
    offsets = np.cumsum(sizes + 1) - sizes
    top = max((int(t.max(initial=0)) for t in texts), default=0) + 1
    sequence = np.empty(int(sizes.sum()) + len(texts) + 1, np.int64)
    sequence[np.concatenate([offsets - 1, [len(sequence) - 1]])] = top + np.arange(len(texts) + 1)
    for text, offset in zip(texts, offsets):
        sequence[offset : offset + len(text)] = text
    return sequence, offsets


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that any run has after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def text_runs(texts: list[str | None], min_length: int = MIN_LENGTH) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs and collapsed text of each text, some texts at a time."""
    held: list[list[bytes]] = []
    size = 0

    def done():
        names = defaultdict(count().__next__)
        numbers = [np.fromiter(map(names.__getitem__, words), np.int64, len(words)) for words in held]
        for words, runs in zip(held, runs_of(numbers, min_length)):
            yield runs, collapsed(words, runs)

    for text in texts:
        words = (text or "").encode().split()
        if held and size + len(words) > WORDS_AT_ONCE:
            yield from done()
            held, size = [], 0
        held.append(words)
        size += len(words)
    yield from done()


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """Replace the text by ``runs``, an array of (start, length, period) by start, then period, and
    ``collapsed``, the text without the repetitions, words joined by one space.

    Starts are numbers of words from 0. A NULL or blank text has no runs and collapses to the empty text.
    Other columns stay; repeated rows come back as often as they occur, an empty table gives an empty result.
    """
    fields = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def make():
        def work(texts):
            runs, left = zip(*text_runs(texts, min_length))
            rows = [[dict(zip(("start", "length", "period"), run)) for run in one] for one in runs]
            return [pa.array(rows, pa.list_(fields)), pa.array(left, pa.binary()).cast(pa.string())]

        return work

    return map_texts(docs, text, make, f"runs {RUNS}, collapsed string")


def with_planted_periods(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ``text``), where a tenth of the texts, chosen by crc32 of the id, repeats some of its words to its end.

    With h the crc32 and g = floor(h / 10), texts of n words with h % 10 = 0 repeat the p words from
    word a, for a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). A NULL id leaves its text as it is.
    """
    rows = docs.select(
        F.col(quoted(id)).alias("id"),
        F.col(quoted(text)).alias("text"),
        F.crc32(F.col(quoted(id)).cast("string")).alias("h"),
    )
    words = F.filter(F.split("text", f"{SPACE}+"), lambda word: word != "")
    rows = rows.select("id", "text", F.expr("h div 10").alias("g"), F.when(F.col("h") % 10 == 0, words).alias("words"))
    rows = rows.select("*", F.size("words").cast("bigint").alias("n"))
    rows = rows.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a"))
    rows = rows.select("*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))

    def word(i):
        return F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))

    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), word), " ")
    return rows.select(F.col("id").alias(id), F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def runs_digest(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one and digests, per row."""

    def better(best, run):
        more = best.isNull() | (run["length"] > best["length"])
        return F.when(more, run).otherwise(best)  # equal lengths come by start, then period

    run = "struct<start:bigint,length:bigint,period:bigint>"
    rows = found.select(
        F.col(quoted(id)).alias("id"),
        "runs",
        "collapsed",
        F.aggregate("runs", F.lit(None).cast(run), better).alias("longest"),
    )
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    return rows.select(
        F.col("id").alias(id),
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("longest.start").alias("start"),
        F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
