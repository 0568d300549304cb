"""Whitening against a dense eigendecomposition, and its building blocks."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tenderlake.llm import whitening as W


@settings(max_examples=60, deadline=None)
@given(
    rows=st.integers(1, 40), dims=st.integers(1, 9), parts=st.integers(1, 4), batch=st.integers(1, 15), spread=st.sampled_from([0, 1, 3, 10**6]),
    seed=st.integers(0, 1000),
)
def test_spectrum_equals_dense_eigenvalues(rows, dims, parts, batch, spread, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-spread, spread + 1, (rows, dims)) * rng.choice([0, 1, 1000], dims)
    total = W.Spectrum.empty(dims)
    for part in np.array_split(x, parts):
        own = W.Spectrum.empty(dims)
        for at in range(0, len(part), batch):
            own.add(part[at : at + batch])
        total.combine(own)
    scatter = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    values = np.linalg.eigvalsh(scatter)
    scale = max(values[-1], 1.0)
    assert total.n == rows and (total.sums == x.sum(axis=0)).all()
    assert np.abs(total.values - values).max() <= 1e-11 * scale
    assert np.abs(total.basis.T @ total.basis - np.eye(dims)).max() <= 1e-11
    assert np.abs(scatter @ total.basis - total.basis * total.values).max() <= 1e-10 * scale


def test_secular_roots_between_close_poles():
    d = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0])
    z = np.array([1e-6, 1.0, 1e-4, 2.0])
    pole, offset = W.secular_roots(d, z)
    assert np.allclose(np.sort(d[pole] + offset), np.linalg.eigvalsh(np.diag(d) + np.outer(z, z)), rtol=0, atol=1e-14)


def reference(x, most):
    n = len(x)
    centred = x - x.sum(axis=0) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return centred @ axes[:, ::-1][:, :most] / np.sqrt(values[::-1][:most]), values[::-1]


def test_whitened_vectors_equal_dense_whitening(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN_IN", 2)
    rng = np.random.default_rng(4)
    c = rng.normal(size=(300, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.3])
    rows = [(i, [float(v) for v in r], "a") for i, r in enumerate(c)]
    rows += [(rows[0][0], rows[0][1], "a"), (None, rows[1][1], "a")]  # repeated rows and rows without id count
    bad = [(900, None, "a"), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], "a"), (902, [float("nan")] * 6, "a"), (903, [float("inf")] * 6, "a"), (904, [], "a")]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, component string").repartition(5)
    got = W.whiten_vectors(table, components=4).toPandas()
    x = np.floor(np.array([r[1] for r in rows]) * 64).astype(np.int64) + W.SHIFT
    n, sums = len(x), x.sum(axis=0)
    assert len(got) == 4 * n and set(got.n) == {n} and got.vec_id.isna().sum() == 4
    want, values = reference(x, 4)
    one = got.dropna(subset="vec_id").drop_duplicates(["vec_id", "component"]).sort_values(["vec_id", "component"])
    mine = one.whitened.to_numpy().reshape(-1, 4)
    assert np.abs(np.abs(mine) - np.abs(want[:300])).max() < 1e-9
    assert (one.deviation.to_numpy().reshape(-1, 4) == ((n * x - sums) ** 2).sum(axis=1)[:300, None]).all()
    assert np.allclose(one.explained.to_numpy()[:4], values[:4] / values.sum(), rtol=1e-12)
    z = got.sort_values(["component", "vec_id"], kind="stable").whitened.to_numpy().reshape(4, -1).T  # repeated rows are equal
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-12
    assert np.abs(z.T @ z / n - np.eye(4)).max() < 1e-12


def test_vectors_of_each_length_and_directions_without_variance(spark):
    rows = [(1, [1.0, 0.0]), (2, [3.0, 0.0]), (3, [1.0, 2.0, 3.0]), (4, [1.0, 2.0, 4.0]), (5, [0.5]), (6, [0.5])]
    got = W.whiten_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((r.vec_id, r.component, r.n, round(abs(r.whitened), 12), r.explained) for r in got) == [(i, 1, 2, 1.0, 1.0) for i in (1, 2, 3, 4)]
    assert {r.deviation for r in got} == {(2 * 64) ** 2, 64**2}


def test_nothing_to_whiten(spark):
    kind = "vec_id long, embedding array<float>"
    assert W.whiten_vectors(spark.createDataFrame([], kind)).count() == 0
    assert W.whiten_vectors(spark.createDataFrame([(1, None), (2, [])], kind)).count() == 0
    assert W.whiten_vectors(spark.createDataFrame([(1, [2.0, 1.0])], kind)).count() == 0


def test_what_a_long_cannot_hold_is_refused():
    huge = W.Whitening(1 << 40, np.array([0]), np.eye(1), np.ones(1), np.ones(1))
    with pytest.raises(OverflowError):
        huge.deviation(np.array([[1 << 40]]))
    exact = W.Whitening(3, np.array([1 << 30, 0]), np.eye(2), np.ones(2), np.ones(2)).deviation(np.array([[5, 7]]))
    assert exact.tolist() == [(15 - (1 << 30)) ** 2 + 21**2]
