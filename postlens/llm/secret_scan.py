"""Secrets in texts: fixed patterns, and a small character network for what they miss.

Every candidate (a long run of key characters, without a digit only if very long) and what a
pattern's match leaves of a run is judged with its surrounding context by a convolutional network
over characters, written in numpy. Its window slides over the whole candidate, and the highest
score counts. It is trained on all of the corpus's own findings: windows that meet a pattern's match are
positive, all others negative. Tasks train on a part of the windows each, and their weights are averaged after each
epoch. Its scores are calibrated on all held-out findings, and its threshold
is the highest one that still finds the wanted share of them.
"""

from __future__ import annotations

import hashlib
import logging
import re
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postlens.functions.names import quoted
from postlens.llm.common import finished, map_texts, whole_row
from postlens.llm.language_id import letters

logger = logging.getLogger(__name__)

KINDS = ("assign", "access", "hex", "network")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
DIGITS = re.compile(r"[0-9]+")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
RUN_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
LONG = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z+/_.=-]{24,}+(?![0-9])")
MIXED = re.compile(r"[a-z][A-Z]")
CANDIDATE_CHARS = 8
MIXED_CHARS = 12
BEFORE, INSIDE, AFTER = 24, 40, 8
CODES = 131  # ASCII, then other letters, other characters and what is beyond the text
WIDTH, FILTERS = 5, 24
PART_WINDOWS = 1 << 15  # that a task trains on
EPOCHS = 12
HELD_OUT = 4  # one of so many windows of either label is for the calibration
BUCKETS = 1024  # that a search for a threshold counts at once
RECALL = 0.95
LEAST_PROBABILITY = 0.5  # a threshold below it is reported

Span = tuple[int, int, int]  # begin, end, index into KINDS


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns by begin and kind, in code points."""
    spans = []
    if "=" in text or ":" in text:
        spans += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(*m.span(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(*m.span(), 2) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def candidates(text: str) -> list[tuple[int, int]]:
    """Whole runs of key characters that are long enough: 8 with a digit, 12 with a capital after a
    small letter, 24 otherwise."""
    found = {m.span() for m in LONG.finditer(text)}
    for sign, least in ((DIGITS, CANDIDATE_CHARS), (MIXED, MIXED_CHARS)):
        end = 0
        for m in sign.finditer(text):
            if m.start() < end:
                continue
            begin = m.start()
            while begin > end and text[begin - 1] in RUN_CHARACTERS:
                begin -= 1
            end = RUN.match(text, m.start()).end()
            if end - begin >= least:
                found.add((begin, end))
    return sorted(found)


def pieces(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """What is to be judged: candidates, and of runs that matches cover in part what is left."""
    if not base:
        return candidates(text)
    covered: list[list[int]] = []
    for begin, end, _ in base:
        if covered and begin <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([begin, end])
    begins, found, last = [begin for begin, _ in covered], [], 0
    for begin, end in candidates(text):
        k = bisect_left(begins, end) - 1  # the last match that begins before the end
        if k < 0 or covered[k][1] <= begin:
            found.append((begin, end))
    for k, (begin, end) in enumerate(covered):
        left = begin
        while left > last and text[left - 1] in RUN_CHARACTERS:
            left -= 1
        if left < begin:
            found.append((left, begin))
        right = RUN.match(text, end, begins[k + 1] if k + 1 < len(covered) else len(text))
        last = right.end() if right else end
        if last > end:
            found.append((end, last))
    return sorted(found)


def codes_of(text: str) -> bytes:
    """A code for each character: ASCII as it is, 128 for other letters, 129 for all others."""
    if text.isascii():
        return text.encode()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, points, 129 - letters()[points]).astype(np.uint8).tobytes()


def window(text: str, begin: int, end: int) -> bytes:
    """Codes of the candidate's first characters and its context, beyond the text padded with 130."""
    before = codes_of(text[max(0, begin - BEFORE) : begin]).rjust(BEFORE, b"\x82")
    inside = codes_of(text[begin : min(end, begin + INSIDE)]).ljust(INSIDE, b"\x82")
    return before + inside + codes_of(text[end : end + AFTER]).ljust(AFTER, b"\x82")


def windows(text: str, begin: int, end: int) -> list[tuple[int, int]]:
    """Places of windows one beside the other over a candidate, the last one up to its end."""
    places = [*range(begin, end - INSIDE, INSIDE), max(begin, end - INSIDE)]
    return [(at, min(end, at + INSIDE)) for at in places]


def overlaps(spans: list[Span], begin: int, end: int) -> bool:
    return any(b < end and begin < e for b, e, _ in spans)


def _running_max(maps: np.ndarray, width: int) -> np.ndarray:
    """The maximum of each ``width`` rows that follow one another."""
    done = 1
    while done < width:
        step = min(done, width - done)
        maps, done = np.maximum(maps[:-step], maps[step:]), done + step
    return maps


class CharacterNetwork:
    """One convolution over character codes, the maximum over places, and a logistic unit.

    The codes are one-hot, so the convolution adds up a row of weights for each place
    of its window. Candidate and context are told apart by their fixed places.
    """

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.kernel = rng.normal(0, 0.2, (WIDTH, CODES, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        parts = 3  # maxima are taken before, inside and after the candidate
        self.out = rng.normal(0, 0.2, (parts * FILTERS,)).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)
        self.slope, self.shift, self.threshold = 1.0, 0.0, 1.0
        self.precision = self.recall = 0.0  # at the threshold, of the windows held out

    @staticmethod
    def _parts() -> list[slice]:
        places = BEFORE + INSIDE + AFTER - WIDTH + 1
        return [slice(0, BEFORE), slice(BEFORE, BEFORE + INSIDE), slice(BEFORE + INSIDE, places)]

    def _features(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = codes.shape[1] - WIDTH + 1
        maps = self.bias + sum(self.kernel[k][codes[:, k : k + places]] for k in range(WIDTH))
        at = [maps[:, part].argmax(axis=1) + part.start for part in self._parts()]
        best = [np.take_along_axis(maps, a[:, None, :], 1)[:, 0] for a in at]
        return np.maximum(np.concatenate(best, axis=1), 0), np.concatenate(at, axis=1)

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [self._features(codes[i : i + 512])[0] @ self.out for i in range(0, len(codes), 512)]
        return (np.concatenate(parts) if parts else np.empty(0)) + self.out_bias[0]

    def _calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -60, 60)))

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return self._calibrated(self.logits(codes))

    def highest(self, text: str, begin: int, end: int) -> float:
        """The highest probability of a window that slides over all places of a long candidate.

        At its end the window runs out of it, down to the length of the shortest candidate.
        """
        ends = [window(text, at, end) for at in range(end - INSIDE + 1, end - CANDIDATE_CHARS + 1)]
        best, step = self.logits(np.frombuffer(b"".join(ends), np.uint8).reshape(len(ends), -1)).max(), 8192
        for first in range(begin, end - INSIDE + 1, step):
            last = min(first + step, end - INSIDE + 1) + INSIDE - 1  # end of the last window
            codes = b"\x82" * max(0, BEFORE - first) + codes_of(text[max(0, first - BEFORE) : last + AFTER])
            codes = np.frombuffer(codes.ljust(last - first + BEFORE + AFTER, b"\x82"), np.uint8)
            places = len(codes) - WIDTH + 1
            maps = self.bias + sum(self.kernel[k][codes[k : k + places]] for k in range(WIDTH))
            n = last - first - INSIDE + 1
            parts = [_running_max(maps[p.start : n - 1 + p.stop], p.stop - p.start) for p in self._parts()]
            best = max(best, (np.maximum(np.concatenate(parts, axis=1), 0) @ self.out).max() + self.out_bias[0])
        return float(self._calibrated(np.array(best)))

    def _values(self) -> list[np.ndarray]:
        return [self.kernel, self.bias, self.out, self.out_bias]

    def state(self, moments: list[np.ndarray]) -> np.ndarray:
        """Weights and Adam's moments as one array."""
        return np.concatenate([v.ravel() for v in [*self._values(), *moments]])

    def restore(self, state: np.ndarray) -> list[np.ndarray]:
        """Take over the weights of a state; the result is its moments."""
        shapes = [v.shape for v in self._values()] * 3
        ends = np.cumsum([int(np.prod(shape)) for shape in shapes])
        found = [v.reshape(shape).astype(np.float32) for v, shape in zip(np.split(state, ends[:-1]), shapes)]
        self.kernel, self.bias, self.out, self.out_bias = found[:4]
        return found[4:]

    def moments(self) -> list[np.ndarray]:
        return [np.zeros_like(v) for v in self._values() * 2]

    def train(
        self, codes: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.01,
        share: float | None = None, done: int = 0, moments: list[np.ndarray] | None = None,
    ) -> None:
        """Adam on the logistic loss, both labels with equal weight.

        For a part of the windows ``share`` has the positive share of all. ``done`` epochs have gone before, and left ``moments``.
        """
        rng = np.random.default_rng(1)
        share = labels.mean() if share is None else share
        weights = np.where(labels, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
        values, moments = self._values(), moments or self.moments()
        first, second, step = moments[: len(values)], moments[len(values) :], done * -(-len(codes) // batch)
        for epoch in range(done + epochs):
            order = rng.permutation(len(codes))
            for i in range(0, len(order) if epoch >= done else 0, batch):
                chosen = order[i : i + batch]
                grads = self._gradients(codes[chosen], labels[chosen], weights[chosen])
                step += 1
                for value, grad, m, v in zip(values, grads, first, second):
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad * grad - v)
                    value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        features, at = self._features(codes)
        error = 1 / (1 + np.exp(-(features @ self.out + self.out_bias[0]))) - labels
        error = (error * weights / len(codes)).astype(np.float32)
        back = error[:, None] * self.out * (features > 0)
        kernel = np.zeros_like(self.kernel)
        column = np.arange(at.shape[1]) % FILTERS
        for k in range(WIDTH):
            np.add.at(kernel[k], (np.take_along_axis(codes, at + k, 1), column), back)
        bias = back.reshape(len(codes), -1, FILTERS).sum(axis=(0, 1))
        return [kernel, bias, error @ features, error.sum(keepdims=True)]

    def calibrate(self, codes: np.ndarray, labels: np.ndarray, recall: float = RECALL, drawn: tuple[float, float] = (1.0, 1.0)) -> None:
        """Platt scaling by Newton steps, then the highest threshold with the wanted recall.

        ``drawn`` has the shares in which windows of either label (False, True) were drawn, for the
        precision of the whole corpus.
        """
        x = self.logits(codes)
        self.calibrate_by(lambda work: [work(x, labels)], recall, drawn)

    def calibrate_by(self, over: Callable, recall: float = RECALL, drawn: tuple[float, float] = (1.0, 1.0)) -> None:
        """``calibrate`` for windows in parts: ``over`` calls a function of logits and labels for each part and
        returns its arrays, in the order of the parts."""
        negatives, n, total, squares, low, high = np.array(over(_moments_of)).T
        n, size = n.sum(), n.sum() + negatives.sum()
        # Smoothed targets keep the scale finite where the labels are separable.
        targets = (1 / (size - n + 2), (n + 1) / (n + 2))
        deviation = np.sqrt(max(squares.sum() / size - (total.sum() / size) ** 2, 0))
        scale = np.array([1 / max(deviation, 1e-6), 0.0])
        for _ in range(50):
            sums = np.sum(over(lambda x, labels: _newton_sums(x, labels, scale, targets)), axis=0)
            change = np.linalg.solve(sums[:4].reshape(2, 2) + 1e-6 * np.eye(2), sums[4:])
            scale = scale - change / max(1, np.abs(change).max())
            if np.abs(change).max() < 1e-9:
                break
        self.slope, self.shift = max(scale[0], 0.0), scale[1]
        at = _kth_positive(over, int((1 - recall) * n + 1e-9), low.min(), high.max())
        self.threshold = float(self._calibrated(np.array([at]))[0])
        found = sum(over(lambda x, labels: np.bincount(labels[self._calibrated(x) >= self.threshold], minlength=2)))
        wrong, right = (count / share for count, share in zip(found, drawn))
        self.precision, self.recall = float(right / (right + wrong)), float(found[1] / n)
        if self.threshold < LEAST_PROBABILITY:
            logger.warning("threshold %.3f: recall %.3f, precision %.3f", self.threshold, self.recall, self.precision)


def _moments_of(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Numbers of negative and positive logits, the sum of all and of their squares, least and greatest positive one."""
    x, positive = x.astype(np.float64), x[labels]
    ends = positive.min(initial=np.inf), positive.max(initial=-np.inf)
    return np.array([len(x) - len(positive), len(positive), x.sum(), (x * x).sum(), *ends])


def _newton_sums(x: np.ndarray, labels: np.ndarray, scale: np.ndarray, targets: tuple[float, float]) -> np.ndarray:
    """Hessian and gradient of the logistic loss."""
    design = np.stack([x, np.ones_like(x)], axis=1).astype(np.float64)
    p = 1 / (1 + np.exp(-np.clip(design @ scale, -60, 60)))
    hessian = design.T @ (design * (p * (1 - p))[:, None])
    return np.concatenate([hessian.ravel(), design.T @ (p - np.where(labels, targets[1], targets[0]))])


def _kth_positive(over: Callable, k: int, low: float, high: float) -> float:
    """The positive logit with ``k`` smaller ones, by counts in ever narrower ranges."""

    def count(x, labels):
        x = x[labels & (x >= low) & (x <= high)].astype(np.float64)
        bucket = np.minimum(((x - low) / (high - low) * BUCKETS).astype(np.int64), BUCKETS - 1)
        least, greatest = np.full(BUCKETS, np.inf), np.full(BUCKETS, -np.inf)
        np.minimum.at(least, bucket, x)
        np.maximum.at(greatest, bucket, x)
        return np.concatenate([np.bincount(bucket, minlength=BUCKETS), least, greatest])

    while low < high:
        counts, least, greatest = np.stack(over(count)).reshape(-1, 3, BUCKETS).swapaxes(0, 1)
        ends = np.cumsum(counts.sum(axis=0))
        at = int(np.searchsorted(ends, k, side="right"))
        k -= int(ends[at - 1]) if at else 0
        low, high = float(least[:, at].min()), float(greatest[:, at].max())
    return low


@dataclass
class Scanner:
    """Patterns and, where it could be trained, the network."""

    network: CharacterNetwork | None = None

    def scan_all(self, texts: list[str | None]) -> list[list[Span]]:
        """All spans of each text by begin and kind; the patterns' spans are always there."""
        texts = [t or "" for t in texts]
        spans = [base_spans(t) for t in texts]
        if self.network is None:
            return spans
        asked = []
        for i, t in enumerate(texts):
            for b, e in pieces(t, spans[i]):
                if e - b <= INSIDE:
                    asked.append((i, b, e))
                elif self.network.highest(t, b, e) >= self.network.threshold:
                    spans[i].append((b, e, 3))
        for first in range(0, len(asked), 512):
            part = asked[first : first + 512]
            codes = np.frombuffer(b"".join(window(texts[i], b, e) for i, b, e in part), np.uint8)
            found = self.network.probability(codes.reshape(len(part), -1)) >= self.network.threshold
            for (i, b, e), yes in zip(part, found):
                if yes:
                    spans[i].append((b, e, 3))
        return [sorted(s, key=lambda x: (x[0], x[2])) for s in spans]


def fit(docs: DataFrame, text: str = "text", recall: float = RECALL) -> Scanner:
    """Train on all of the corpus's findings, that is on all different windows.

    All texts are scanned for findings. Every fourth window of either label is held out for the calibration; where there
    is one only, it serves for both. Without any window of one of the labels there is nothing to learn, and no network.
    """

    def make():
        def work(texts):
            made, labels = [], []
            for t in texts:
                base = base_spans(t) if t else []
                found = candidates(t) if t else []
                found = [place for c in found for place in windows(t, *c)]
                made.append([window(t, *c) for c in found])
                labels.append([overlaps(base, *c) for c in found])
            return [pa.array(made, pa.list_(pa.binary())), pa.array(labels, pa.list_(pa.bool_()))]

        return work

    scanned = map_texts(docs.select(F.col(quoted(text)).alias("text")), "text", make, "windows array<binary>, labels array<boolean>")
    rows = scanned.select(F.explode(F.arrays_zip("windows", "labels")).alias("x"))
    rows = rows.groupBy(F.col("x.windows").alias("window")).agg(F.max("x.labels").alias("label"))
    with finished(docs.sparkSession) as keep:
        rows = keep(rows, "findings")
        sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
        if not (sizes.get(True) and sizes.get(False)):
            return Scanner()
        parts = keep(_in_parts(rows, -(-sum(sizes.values()) // PART_WINDOWS)), "parts")
        ranks = _ranks(parts)
        network = _trained(parts, ranks, sizes)
        _calibrate(keep(_held_out_logits(parts, ranks, network), "logits"), network, recall)
        return Scanner(network)


def _in_parts(rows: DataFrame, parts: int) -> DataFrame:
    """A row for each part of the windows, which their hashes deal: its windows in order and their labels."""

    def gather(batches):
        part, codes, labels = None, [], []
        for batch in batches:
            if batch.num_rows:
                part = batch.column(0)[0].as_py()
                codes += batch.column(1).to_pylist()
                labels += batch.column(2).to_pylist()
        if part is not None:
            row = [[part], [sum(labels)], [len(labels) - sum(labels)], [b"".join(codes)], [bytes(labels)]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], ["part", "positive", "negative", "codes", "labels"])

    part = F.pmod(F.xxhash64("window"), F.lit(parts)).cast("int").alias("part")
    dealt = rows.select(part, "window", "label").repartitionById(parts, F.col("part")).sortWithinPartitions("window")
    return dealt.mapInArrow(gather, "part int, positive bigint, negative bigint, codes binary, labels binary")


def _by_part(rows: DataFrame) -> list[Row]:
    return sorted(rows.collect(), key=lambda r: r["part"])


def _ranks(parts: DataFrame) -> dict[int, dict[bool, int]]:
    """For each part, how many windows of either label the parts before it have."""
    before, ranks = {True: 0, False: 0}, {}
    for r in _by_part(parts.select("part", "positive", "negative")):
        ranks[r["part"]] = before
        before = {True: before[True] + r["positive"], False: before[False] + r["negative"]}
    return ranks


def _of_parts(parts: DataFrame, ranks: dict[int, dict[bool, int]], work: Callable, fields: str) -> DataFrame:
    """A row of the part and what ``work`` returns, from the part's codes, labels and which windows are held out."""
    names = [f.name for f in StructType.fromDDL(fields)]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                part, codes, given = (batch.column(k)[i].as_py() for k in range(3))
                labels = np.frombuffer(given, np.uint8) > 0
                codes, held = np.frombuffer(codes, np.uint8).reshape(len(labels), -1), np.zeros(len(labels), bool)
                for label in (True, False):
                    own = np.flatnonzero(labels == label)
                    held[own[-ranks[part][label] % HELD_OUT :: HELD_OUT]] = True
                result = [pa.array([x]) for x in (part, *work(codes, labels, held))]
                yield pa.RecordBatch.from_arrays([result[0].cast(pa.int32()), *result[1:]], ["part", *names])

    return parts.select("part", "codes", "labels").mapInArrow(run, f"part int, {fields}")


def _trained(parts: DataFrame, ranks: dict[int, dict[bool, int]], sizes: dict[bool, int]) -> CharacterNetwork:
    """The network trained on all windows that are not held out. Each part goes on from the common weights; they
    are averaged after each epoch. One part needs no average and trains through."""
    learned = {label: n - -(-n // HELD_OUT) + (n == 1) for label, n in sizes.items()}
    share = learned[True] / sum(learned.values())
    network = CharacterNetwork()
    state, step = network.state(network.moments()), 1 if len(ranks) > 1 else EPOCHS
    for done in range(0, EPOCHS, step):

        def work(codes, labels, held):
            own = CharacterNetwork()
            moments, chosen = own.restore(state), ~held
            for label in (True, False):
                if sizes[label] == 1:
                    chosen |= labels == label
            if chosen.any():
                own.train(codes[chosen], labels[chosen], step, share=share, done=done, moments=moments)
            return int(chosen.sum()), own.state(moments).tobytes()

        found = _by_part(_of_parts(parts, ranks, work, "n bigint, state binary"))
        states = np.stack([np.frombuffer(r["state"], np.float32) for r in found])
        state = np.average(states, axis=0, weights=[r["n"] for r in found]).astype(np.float32)
    network.restore(state)
    return network


def _held_out_logits(parts: DataFrame, ranks: dict[int, dict[bool, int]], network: CharacterNetwork) -> DataFrame:
    def work(codes, labels, held):
        return network.logits(codes[held]).astype(np.float32).tobytes(), labels[held].tobytes()

    return _of_parts(parts, ranks, work, "logits binary, labels binary")


def _calibrate(logits: DataFrame, network: CharacterNetwork, recall: float) -> None:
    """``calibrate_by`` with the parts' numbers from tasks."""

    def over(work):
        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    x, labels = (np.frombuffer(batch.column(k)[i].as_py(), t) for k, t in ((1, np.float32), (2, bool)))
                    result = work(x, labels)
                    row = [pa.array([batch.column(0)[i].as_py()], pa.int32()), pa.array([result.astype(np.float64).ravel()])]
                    yield pa.RecordBatch.from_arrays(row, ["part", "found"])

        return [np.array(r["found"]) for r in _by_part(logits.mapInArrow(run, "part int, found array<double>"))]

    network.calibrate_by(over, recall)


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{begin}:{end}" for begin, end, kind in spans)


def scan_texts(docs: DataFrame, scanner: Scanner, text: str = "text") -> DataFrame:
    """Replace the text by its counts per pattern, the digest of the patterns' spans, and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(scanner)

    def make():
        def work(texts):
            found = shared.value.scan_all(texts)
            base = [[s for s in spans if s[2] < 3] for spans in found]
            counts = [pa.array([sum(s[2] == kind for s in spans) for spans in base], pa.int64()) for kind in range(3)]
            digests = [hashlib.sha256(_written(spans).encode()).hexdigest() for spans in base]
            return [*counts, pa.array(digests), pa.array(map(_written, found))]

        return work

    added = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_texts(docs, text, make, added)


def secret_scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans``.

    NULL and empty texts have no spans. Repeated rows come back as often as they occur,
    an empty table gives an empty result, and other columns are ignored.
    """
    return scan_texts(docs.select(F.col(quoted(id)), F.col(quoted(text))), fit(docs, text), text)


def redact(text: str, spans: list[Span], mark: str) -> str:
    """The text with each group of overlapping spans replaced by the mark."""
    parts, at = [], 0
    for begin, end, _ in sorted(spans):
        if begin >= at:
            parts += [text[at:begin], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact_secrets(
    docs: DataFrame, text: str = "text", n_chars: str = "n_chars", mark: str = "[SECRET]"
) -> DataFrame:
    """The same rows with all secrets replaced by ``mark``; a length column ``n_chars`` follows.

    A NULL text stays NULL.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, text))

    def make():
        def work(texts):
            found = shared.value.scan_all(texts)
            return [pa.array([t if t is None else redact(t, s, mark) for t, s in zip(texts, found)], pa.string())]

        return work

    rows = docs.select(whole_row(docs.drop(F.col(quoted(text)))), F.col(quoted(text)).alias("body"))
    rows = map_texts(rows, "body", make, "redacted string")
    values = {text: F.col("redacted"), n_chars: F.length("redacted").cast(dict(docs.dtypes).get(n_chars, "bigint"))}
    if text != n_chars and n_chars in docs.columns:
        values[n_chars] = F.when(F.col("redacted").isNull(), F.col("row")[n_chars]).otherwise(values[n_chars])
    return rows.select(*(values.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
