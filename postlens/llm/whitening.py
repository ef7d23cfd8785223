"""Whitening of embeddings by an incremental eigendecomposition.

Every task keeps the spectrum of the scatter of its centred vectors and changes it by one
rank for each vector: roots of the secular equation, with deflation, and eigenvectors
from the weights that fit the roots exactly. Spectra are combined, several at a time, by
the eigenpairs of one as successive rank-one updates of the other. A last pass over the
vectors refines the combined basis by Rayleigh-Ritz.

Vectors are whole numbers ``floor(64 * c) + 1000000`` for each entry ``c``, so counts, sums and
deviations from the mean are exact.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from postlens.functions.names import quoted
from postlens.llm.common import finished

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
FAN_IN = 32
SAFE = 1 << 62
EPS = float(np.finfo(float).eps)
ROUNDS = 100


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of ``1 + sum(weights / (poles - x))``, one above each pole, and ``poles - roots``.

    Poles rise strictly and weights are positive. Row i of the second result holds the
    distances of all poles from root i, computed from the pole that is nearest to the root, so
    they keep their relative accuracy.
    """
    n = len(poles)
    gaps = np.append(np.diff(poles), weights.sum())
    half = gaps / 2
    at = np.arange(n)
    apart = poles[None, :] - poles[:, None]
    upper = (1 + (weights / (apart - half[:, None])).sum(1) < 0) & (at < n - 1)  # root nearer to the next pole
    origin = at + upper
    apart = poles[None, :] - poles[origin][:, None]
    low = np.where(upper, -half, 0.0)
    high = np.where(upper, 0.0, half)
    high[-1] = gaps[-1] * (1 + 4 * n * EPS)
    step_from = np.where(upper, low, high)
    step_from[-1] = half[-1]
    below = np.tri(n)
    following = np.minimum(at + 1, n - 1)
    x, done = step_from, np.zeros(n, bool)
    for _ in range(ROUNDS):
        distance = apart - x[:, None]
        terms = weights / distance
        slopes = terms / distance
        psi = np.einsum("ij,ij->i", terms, below)
        psi_slope = np.einsum("ij,ij->i", slopes, below)
        total, slope = terms.sum(1), slopes.sum(1)
        value = 1 + total
        rounding = 1 + np.abs(psi) + np.abs(total - psi) + np.abs(x) * slope
        done |= np.abs(value) <= 8 * EPS * rounding
        if done.all():
            break
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        # Both sums are replaced by one pole each, with value and slope as they are here.
        here, there = distance[at, at], distance[at, following]
        rest = total - psi
        c = 1 + psi - psi_slope * here + rest - (slope - psi_slope) * there
        b = (here + there) * value - here * there * slope
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(b * b - 4 * c * value * here * there, 0))
            step = np.where(b > 0, 2 * value * here * there / (b + root), (b - root) / (2 * c))
            last = 1 + psi[-1] - psi_slope[-1] * here[-1]
            step[-1] = here[-1] + psi_slope[-1] * here[-1] * here[-1] / last
        new = x + step
        done |= np.abs(step) <= EPS * np.abs(x)
        inside = (new > low) & (new < high)
        x = np.where(done, x, np.where(inside, new, (low + high) / 2))
    distance = apart - x[:, None]
    return poles[origin] + x, distance


@dataclass
class Spectrum:
    """Eigenvalues, rising, and orthonormal eigenvectors of a sum of outer products.

    Only the space that the vectors span is kept, so there are at most as many
    eigenvectors as there were vectors.
    """

    values: np.ndarray
    basis: np.ndarray  # dimensions x values

    @classmethod
    def empty(cls, dimensions: int) -> Spectrum:
        return cls(np.empty(0), np.empty((dimensions, 0)))

    def add(self, vector: np.ndarray) -> None:
        """Add the outer product of the vector with itself."""
        size = float(np.sqrt(vector @ vector))
        if not size:
            return
        along = vector @ self.basis
        if self.basis.shape[1] < len(vector):
            across = vector - self.basis @ along
            again = across @ self.basis
            across -= self.basis @ again
            along = along + again
            height = float(np.sqrt(across @ across))
            if height > 64 * EPS * size:
                self.basis = np.column_stack([across / height, self.basis])
                self.values = np.append(0.0, self.values)
                along = np.append(height, along)
        self._update(along)

    def _update(self, along: np.ndarray) -> None:
        """Diagonal of ``values`` plus the outer product of ``along``, made diagonal again."""
        norm = float(along @ along)
        if not norm:
            return
        small = 8 * EPS * max(float(self.values[-1]), norm)
        along = along.copy()
        along[np.abs(along) * np.sqrt(norm) <= small] = 0  # these pairs stay as they are
        active = np.flatnonzero(along)
        if not len(active):
            return
        gap, near = np.diff(self.values[active]), along[active]
        if len(active) > 1 and (gap * np.abs(near[1:] * near[:-1]) <= small * (near[1:] ** 2 + near[:-1] ** 2)).any():
            self._rotate(along, active, small)
            active = np.flatnonzero(along)
        poles, part = self.values[active], along[active]
        roots, distance = secular_roots(poles, part * part)
        # The weights of which the computed roots are the exact ones give orthogonal vectors.
        ratios = np.subtract.outer(poles, poles)
        np.fill_diagonal(ratios, 1.0)
        weights = np.sqrt(np.abs(np.prod(distance / ratios, axis=0)))
        vectors = np.copysign(weights, part)[:, None] / distance.T
        vectors /= np.sqrt(np.einsum("ij,ij->j", vectors, vectors))
        if len(active) == len(self.values):
            self.basis, self.values = self.basis @ vectors, roots
            return
        self.basis[:, active] = self.basis[:, active] @ vectors
        self.values[active] = roots
        order = np.argsort(self.values, kind="stable")
        self.values, self.basis = self.values[order], self.basis[:, order]

    def _rotate(self, along: np.ndarray, active: np.ndarray, small: float) -> None:
        """Turn pairs of eigenvectors with close values so that one of them has no part in the update."""
        before = active[0]
        for at in active[1:]:
            size = float(np.hypot(along[before], along[at]))
            c, s = along[at] / size, along[before] / size
            low, high = self.values[before], self.values[at]
            if (high - low) * abs(c * s) <= small:
                one, two = self.basis[:, before].copy(), self.basis[:, at].copy()
                self.basis[:, before], self.basis[:, at] = c * one - s * two, s * one + c * two
                self.values[before], self.values[at] = low * c * c + high * s * s, low * s * s + high * c * c
                along[before], along[at] = 0.0, size
            before = at

    def merge(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.add(np.sqrt(value) * vector)


@dataclass
class Frame:
    """Size, exact sums and dimensions of the vectors."""

    n: int
    sums: np.ndarray  # of int64, or of Python's integers where these are too small

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact."""
        most = max([abs(int(s)) for s in self.sums] + [self.n * int(np.abs(x).max(initial=0))])
        if most < SAFE // 2:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * x.astype(object) - self.sums.astype(object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(float)


def squares(deviations: np.ndarray) -> pa.Array:
    """The sum of squares in each row, exact; NULL where it does not fit into 64 bits."""
    most = int(np.abs(deviations).max(initial=0))
    if most * most * max(1, deviations.shape[1]) < SAFE:
        return pa.array((deviations.astype(np.int64) ** 2).sum(1), pa.int64())
    exact = (deviations.astype(object) ** 2).sum(1)
    return pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())


def whole_numbers(column: pa.Array, dimensions: int) -> np.ndarray:
    """Rows of vectors as whole numbers."""
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    scaled = np.floor(SCALE * entries)
    if len(scaled) and np.abs(scaled).max() >= SAFE // OFFSET:
        raise ValueError(f"entries of {SAFE // OFFSET // SCALE} and more have no exact form")
    return (scaled.astype(np.int64) + OFFSET).reshape(-1, dimensions)


def usable_vectors(rows: DataFrame, id: str, vector: str) -> tuple[DataFrame, int]:
    """(``id``, ``vector``) of the rows that can be whitened, and the number of dimensions."""
    entries = F.col(quoted(vector)).cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.select(F.col(quoted(id)).alias("id"), entries.alias("vector")).filter(finite & (F.size("vector") > 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    dimensions = most["size"] if most else 0
    return rows.filter(F.size("vector") == dimensions), dimensions


def frame_of(rows: DataFrame, dimensions: int) -> Frame:
    def sums(batches: Iterator[pa.RecordBatch]):
        n, total = 0, np.zeros(dimensions, object)
        for batch in batches:
            x = whole_numbers(batch.column(0), dimensions)
            exact = x.sum(0) if int(np.abs(x).max(initial=0)) * len(x) < SAFE else x.astype(object).sum(0)
            n, total = n + len(x), total + exact.astype(object)
        values = [Decimal(n), *map(Decimal, total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimensions + 1)), pa.array(values, pa.decimal128(38, 0))], ["at", "value"]
        )

    parts = rows.select("vector").mapInArrow(sums, "at bigint, value decimal(38,0)")
    found = {r["at"]: int(r["value"]) for r in parts.groupBy("at").agg(F.sum("value").cast("decimal(38,0)").alias("value")).collect()}
    sizes = [found.get(i, 0) for i in range(dimensions + 1)]
    return Frame(sizes[0], np.array(sizes[1:], np.int64 if max(map(abs, sizes)) < SAFE else object))


def combined(rows: DataFrame, start: Callable[[Iterator[pa.RecordBatch]], object], merge: Callable[[object, object], object]):
    """One result of all tasks' results, in a tree of ``FAN_IN``, or None without rows.

    ``start`` makes the result of a task from its batches, None for none. Each level is
    written to the shared folder, and a task holds two results at a time.
    """

    def first(batches):
        result = start(batches)
        if result is not None:
            yield _row(TaskContext.get().partitionId(), result)

    def fold(batches):
        result, part = None, None
        for batch in batches:
            for number, blob in zip(batch.column("part").to_pylist(), batch.column("blob")):
                one = pickle.loads(blob.as_py())
                result, part = (one, number) if result is None else (merge(result, one), part)
        yield _row(part // FAN_IN, result)

    schema = "part bigint, blob binary"
    with finished(rows.sparkSession) as keep:
        level = keep(rows.mapInArrow(first, schema), "parts")
        while True:
            size = level.agg(F.count("*").alias("n"), F.max("part").alias("last")).first()
            if size["n"] <= 1:
                break
            # Each group is one partition, its rows in order, so sums come out alike in every run.
            groups = size["last"] // FAN_IN + 1
            by_group = level.withColumn("group", F.floor(F.col("part") / FAN_IN)).repartitionByRange(groups, "group")
            ordered = by_group.sortWithinPartitions("part").drop("group")
            level = keep(ordered.mapInArrow(_each_group(fold), schema), "parts")
        blob = level.select("blob").first()
        return pickle.loads(blob["blob"]) if blob else None


def _each_group(fold):
    """Call ``fold`` for the rows of each group; a partition may hold several, one after the other."""

    def run(batches):
        held, group = [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                number = row.column("part")[0].as_py() // FAN_IN
                if held and number != group:
                    yield from fold(iter(held))
                    held = []
                held, group = held + [row], number
        if held:
            yield from fold(iter(held))

    return run


def _row(part: int, result: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([pickle.dumps(result)], pa.binary())], ["part", "blob"])


def incremental_spectrum(rows: DataFrame, frame: Frame) -> Spectrum:
    """Spectrum of the scatter of all vectors, by one update for each."""
    dimensions = len(frame.sums)

    def start(batches):
        spectrum = Spectrum.empty(dimensions)
        for batch in batches:
            for vector in frame.centred(whole_numbers(batch.column(0), dimensions)):
                spectrum.add(vector)
        return spectrum if len(spectrum.values) else None

    def merge(one, two):
        one, two = (one, two) if len(one.values) >= len(two.values) else (two, one)
        one.merge(two)
        return one

    return combined(rows.select("vector"), start, merge) or Spectrum.empty(dimensions)


def summed_products(rows: DataFrame, frame: Frame, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Over all centred vectors projected on ``basis``: their sum, the sum of their outer products, and
    the sum of the squares of the vectors themselves."""
    shared = rows.sparkSession.sparkContext.broadcast(basis)
    dimensions = len(frame.sums)

    def start(batches):
        found = None
        for batch in batches:
            centred = frame.centred(whole_numbers(batch.column(0), dimensions))
            projected = centred @ shared.value
            one = projected.sum(0), projected.T @ projected, float((centred * centred).sum())
            found = one if found is None else merge(found, one)
        return found

    def merge(one, two):
        return tuple(a + b for a, b in zip(one, two))

    return combined(rows.select("vector"), start, merge)


@dataclass
class Whitening:
    """Components by falling variance; ``transform`` takes centred vectors to whitened ones."""

    frame: Frame
    variances: np.ndarray
    components: np.ndarray  # dimensions x components
    explained: np.ndarray
    transform: np.ndarray
    identity_error: float | None = None


def fit_whitening(rows: DataFrame, dimensions: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the vectors of ``rows``; None without rows.

    A component whose variance is below the rounding of the largest has none, and whitens to NULL.
    """
    frame = frame_of(rows, dimensions) if dimensions else Frame(0, np.empty(0))
    if not frame.n:
        return None
    count = min(components, dimensions)
    variances, axes, trace = np.zeros(count), np.zeros((dimensions, count)), 0.0
    spectrum = incremental_spectrum(rows, frame)
    if len(spectrum.values):
        basis, _ = np.linalg.qr(spectrum.basis)
        _, products, total = summed_products(rows, frame, basis)
        trace = total / frame.n
        ritz, turn = np.linalg.eigh((products + products.T) / (2 * frame.n))
        order = np.argsort(-ritz, kind="stable")[:count]
        variances[: len(order)] = np.maximum(ritz[order], 0)
        axes[:, : len(order)] = basis @ turn[:, order]
    real = variances > dimensions * EPS * variances.max(initial=0)
    transform = np.full((dimensions, count), np.nan)
    transform[:, real] = axes[:, real] / np.sqrt(variances[real])
    fitted = Whitening(frame, variances, axes, variances / trace if trace else variances, transform)
    if real.any():
        sums, products, _ = summed_products(rows, frame, transform[:, real])
        mean = sums / frame.n
        error = products / frame.n - np.outer(mean, mean) - np.eye(len(mean))
        fitted.identity_error = float(np.abs(error).max())
    return fitted


def whitened_rows(rows: DataFrame, fitted: Whitening, id: str = "vec_id") -> DataFrame:
    """One row for each vector and component."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)
    added = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    schema = StructType([StructField(id, rows.schema["id"].dataType), *StructType.fromDDL(added)])

    def run(batches):
        model = shared.value
        dimensions, count = model.transform.shape
        none = np.isnan(model.transform).any(0)
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                x = whole_numbers(part.column(1), dimensions)
                size = len(x)
                values = (model.frame.centred(x) @ np.where(none, 0, model.transform)).reshape(-1)
                each = np.repeat(np.arange(size), count)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * count, model.frame.n)),
                        squares(model.frame.deviations(x)).take(pa.array(each)),
                        pa.array(values, mask=np.tile(none, size)),
                        pa.array(np.tile(model.explained, size)),
                        pa.array([model.identity_error] * (size * count), pa.float64()),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component from 1: id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``
    and ``identity_error``.

    Left out are rows whose vector is NULL, empty, of another length than most (of equally
    frequent lengths, the largest) or holds NULL or non-finite entries. All other rows
    count, repeated ones as often as they occur, and a NULL id stays. ``whitened`` is NULL for
    a component without variance, as there are with fewer different vectors than components;
    ``identity_error`` covers the others. An empty table gives an empty result; other columns are ignored.
    """
    rows, dimensions = usable_vectors(vectors, id, vector)
    fitted = fit_whitening(rows, dimensions, components)
    if fitted is None:
        fitted = Whitening(Frame(0, np.empty(0)), *[np.empty(0)] * 3, np.empty((0, 0)))
        rows = rows.limit(0)
    return whitened_rows(rows, fitted, id)
