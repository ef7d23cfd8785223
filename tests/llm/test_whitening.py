from __future__ import annotations

import math

import numpy as np
import pytest

from postlens.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, n string, `a.b` int"


def table(spark, vectors, ids=None):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "no", 2) for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def naive(vectors, components=32):
    """Exact integers, then numpy's own eigendecomposition."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    deviations = [[n * a - s for a, s in zip(row, sums)] for row in x]
    centred = np.array([[a / n for a in row] for row in deviations])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    whitened = centred @ axes[:, :components] / np.sqrt(np.maximum(values[:components], 1e-300))
    return n, [sum(a * a for a in row) for row in deviations], whitened, values / values.sum()


def collected(found):
    rows = sorted(found.collect(), key=lambda r: (r["vec_id"], r["component"]))
    count = max(r["component"] for r in rows)
    return rows, np.array([r["whitened"] for r in rows]).reshape(-1, count)


@pytest.mark.parametrize("fan_in", [2, 32])
def test_equals_numpy(spark, monkeypatch, fan_in):
    monkeypatch.setattr(whitening, "FAN_IN", fan_in)
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(400, 12)) * np.geomspace(3, 0.3, 12) + rng.normal(size=12)).astype(np.float32)
    vectors[100:200] = vectors[100]  # a hot vector
    rows, found = collected(whitening.whiten(table(spark, vectors.tolist())))
    n, deviations, expected, explained = naive(vectors)
    assert [r["deviation"] for r in rows[::12]] == deviations and {r["n"] for r in rows} == {n}
    sign = np.sign((found * expected).sum(0))
    assert np.abs(found * sign - expected).max() < 1e-9
    assert [r["explained"] for r in rows[:12]] == pytest.approx(explained, rel=1e-10)
    assert rows[0]["identity_error"] < 1e-10
    assert np.abs(found.T @ found / n - np.eye(12)).max() < 1e-10


def test_query_on_the_given_table(spark, sf_dir):
    found = queries.queries()["op11_whitening"](spark, sf_dir)
    rows, values = collected(found)
    source = sorted(spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect(), key=lambda r: r["vec_id"])
    n, deviations, expected, explained = naive([r["embedding"] for r in source])
    assert values.shape == (len(source), 32)
    assert [r["deviation"] for r in rows[::32]] == deviations
    assert np.abs(np.abs(values) - np.abs(expected)).max() < 1e-8
    assert [r["explained"] for r in rows[:32]] == pytest.approx(explained[:32], rel=1e-9)
    assert rows[0]["identity_error"] < 1e-9


def test_unusable_rows_go_and_repeated_ones_stay(spark):
    vectors = [[1, 2], [1, 2], [3, -1], [0, 0.5], None, [], [None, 1], [float("nan"), 0], [float("inf"), 0], [1, 2, 3]]
    rows = whitening.whiten(table(spark, vectors, [7, 7, None, *range(10, 17)])).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"], r["component"]) for r in rows if r["vec_id"]) == [
        (False, 7, 1), (False, 7, 1), (False, 7, 2), (False, 7, 2), (False, 10, 1), (False, 10, 2)
    ]
    assert sum(r["vec_id"] is None for r in rows) == 2 and {r["n"] for r in rows} == {4}
    assert len({r["whitened"] for r in rows if r["vec_id"] == 7 and r["component"] == 1}) == 1


def test_tables_without_enough_variance(spark):
    assert whitening.whiten(table(spark, [[1.0]]).limit(0)).count() == 0
    assert whitening.whiten(table(spark, [None, []])).count() == 0
    same = whitening.whiten(table(spark, [[1, 2, 3]] * 5)).collect()
    assert len(same) == 15 and {(r["whitened"], r["deviation"], r["explained"], r["identity_error"]) for r in same} == {(None, 0, 0.0, None)}
    line = whitening.whiten(table(spark, [[k, 2 * k, 0] for k in range(6)])).collect()
    assert {r["component"] for r in line if r["whitened"] is None} == {2, 3}
    assert all(r["identity_error"] < 1e-12 for r in line)


def test_equal_variances(spark):
    corners = [[a, b, c] for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]
    rows, found = collected(whitening.whiten(table(spark, corners)))
    assert np.abs(found.T @ found / 8 - np.eye(3)).max() < 1e-12
    assert {round(r["explained"], 12) for r in rows} == {round(1 / 3, 12)}


def test_sums_beyond_64_bits_stay_exact():
    x = np.array([[10**12, 5], [-(10**12), 7]])
    frame = whitening.Frame(10**9, np.array([3, 10**30], object))
    assert frame.deviations(x).tolist() == [[10**21 - 3, 5 * 10**9 - 10**30], [-(10**21) - 3, 7 * 10**9 - 10**30]]
    assert whitening.squares(frame.deviations(x)).to_pylist() == [None, None]
    assert whitening.squares(np.array([[3, 4], [2**31, 2**30]])).to_pylist() == [25, 2**62 + 2**60]


def random_matrices():
    rng = np.random.default_rng(8)
    yield rng.normal(size=(300, 20)) * np.geomspace(1e6, 1e-3, 20)
    yield rng.integers(-2, 3, size=(300, 7)).astype(float)
    yield np.repeat(np.eye(6), 9, axis=0)
    yield rng.normal(size=(200, 3)) @ rng.normal(size=(3, 9))
    yield np.vstack([np.zeros((3, 4)), np.ones((50, 4)), np.diag([1e-9, 1, 1, 1e9])])


@pytest.mark.parametrize("vectors", list(random_matrices()))
def test_rank_one_updates_equal_the_scatter(vectors):
    exact = vectors.T @ vectors
    whole, left, right = (whitening.Spectrum.empty(vectors.shape[1]) for _ in range(3))
    for i, v in enumerate(vectors):
        whole.add(v)
        (left if i % 3 else right).add(v)
    left.merge(right)
    for spectrum in (whole, left):
        got = spectrum.basis * spectrum.values @ spectrum.basis.T
        assert np.abs(got - exact).max() <= 1e-12 * np.abs(exact).max()
        assert np.abs(spectrum.basis.T @ spectrum.basis - np.eye(len(spectrum.values))).max() < 1e-11
        assert (np.diff(spectrum.values) >= 0).all()


def test_secular_roots_equal_eigenvalues():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 17):
        poles = np.sort(rng.normal(size=n)) * 10
        poles += np.arange(n) * 1e-7
        weights = rng.exponential(size=n) * 10.0 ** rng.integers(-12, 3, size=n)
        roots, distance = whitening.secular_roots(poles, weights)
        exact = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(weights), np.sqrt(weights)))
        assert np.abs(roots - exact).max() < 1e-12 * max(1, np.abs(exact).max())
        assert (roots >= poles).all() and (distance.diagonal() < 0).all()
