"""Multi-index hashing against brute force."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tenderlake.llm import hash_search as H


def block_of(codes, vectors=None):
    order = np.argsort(codes.view(np.uint16), axis=0, kind="stable").T.astype(np.uint16)
    return H.Block(codes if vectors is None else vectors, codes, np.ascontiguousarray(order))


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 80), st.integers(0, 128), st.integers(0, 1000))
def test_probing_finds_every_code_within_the_radius(n, radius, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, (n, 2), dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (n, 2)).astype(np.uint64)
    codes = np.concatenate([base, base ^ flips, base])
    queries = codes[:7] ^ np.uint64(5)
    radii = np.minimum(radius + np.arange(len(queries)), 128)
    who, row = block_of(codes).within(queries, radii)
    apart = np.array([[H.distances(c, q) for c in codes] for q in queries])
    assert sorted(zip(who.tolist(), row.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(apart <= radii[:, None]))))


def test_balls():
    assert [len(H.ball(r)) for r in (0, 1, 2, 16)] == [1, 17, 137, 1 << 16]


def test_best_keeps_scores_then_small_ids():
    best = H.Best(2, 2)
    best.add(np.array([0, 0, 0, 1]), np.array([1.0, 2.0, 2.0, -1.0]), np.array([5, 9, 7, 3]), np.array([0, 1, 2, 3]))
    best.add(np.array([0, 1]), np.array([2.0, 4.0]), np.array([8, 1]), np.array([4, 5]))
    assert best.ids.tolist() == [[7, 8], [1, 3]] and best.rows.tolist() == [[2, 4], [5, 3]]


def by_hand(rows, asked, k):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for i, q in good:
        if asked(i):
            found = sorted({(-float((np.array(q) * np.array(v)).sum()), j) for j, v in good if j != i and len(v) == len(q)})
            out[i] = found[:k]
    return out


def listed(frame):
    got = sorted(tuple(r) for r in frame.select("query_id", "rank", "score", "vec_id").collect())
    return {q: [(-s, v) for _, _, s, v in rows] for q, rows in itertools.groupby(got, lambda r: r[0])}


@pytest.mark.parametrize("lengths", ["equal", "different"])
def test_answers_have_high_recall_and_exact_scores(spark, monkeypatch, lengths):
    monkeypatch.setattr(H, "BLOCK", 100)
    monkeypatch.setattr(H, "QUERY_BYTES", 4000)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 24)).repeat(40, axis=0) + rng.normal(size=(1200, 24)) * 0.7
    if lengths == "equal":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    got, want = listed(H.nearest_vectors(table, "vec_id % 20 = 0")), by_hand(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.97 * 20 * len(want)
    for q, found in got.items():
        assert found == sorted((-float((x[q] * x[j]).sum()), j) for _, j in found)


def test_copies_ties_and_few_vectors(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16)
    same, other = [1.0, 0.0, 0.0], [0.0, 2.0, 0.0]
    rows = [(i, same) for i in range(60)] + [(i, other) for i in range(60, 70)] + [(70, [0.5, 0.5, 0.0])]
    rows += [(80, None), (100, [0.0] * 3), (120, [1.0, None, 0.0]), (140, [float("nan")] * 3), (160, [float("inf")] * 3), (None, same), (180, [])]
    rows += [(200, [1.0, 2.0]), (201, [0.5, 0.5]), (220, [7.0])]  # other lengths meet only their own
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + rows[:5]], "vec_id long, embedding array<float>, score int, rank string")
    got = listed(H.nearest_vectors(table, "vec_id % 20 = 0"))
    assert got == {q: v for q, v in by_hand(rows, lambda i: i % 20 == 0, 20).items() if v}
    assert [j for _, j in got[0]] == list(range(1, 21)) and [j for _, j in got[40]] == list(range(20))


def test_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    assert H.nearest_vectors(spark.createDataFrame([], kind), "vec_id % 20 = 0").count() == 0
    assert H.nearest_vectors(spark.createDataFrame([(20, [1.0])], kind), "vec_id % 20 = 0").count() == 0
    assert H.nearest_vectors(spark.createDataFrame([(1, [1.0]), (2, [2.0])], kind), "vec_id % 20 = 0").count() == 0
