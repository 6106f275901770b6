import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetgrain.llm import centroid_walk as cw

SCHEMA = "vec_id long, embedding array<float>, label int, v long, cluster int, distance long"


def table(llm, rows):
    return llm.createDataFrame([(i, x, 1, 2, 3, 4) for i, x in rows], SCHEMA)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 20), st.integers(1, 6), st.sampled_from([1, 3, 100, 1 << 27]), st.integers(0, 2**32 - 1))
def test_the_walk_finds_the_nearest(k, dims, high, seed):
    rng = np.random.default_rng(seed)
    centroids, vectors = rng.integers(-high, high + 1, (k, dims)), rng.integers(-high, high + 1, (40, dims))
    number, distance = cw.SortedCentroids(centroids).nearest(vectors)
    every = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert number.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()


def test_the_walk_stops_early(monkeypatch):
    centroids = np.arange(1000)[:, None] * np.ones((1, 4), np.int64)
    lists = cw.SortedCentroids(centroids.astype(np.int64))
    rounds = []
    real = np.minimum
    monkeypatch.setattr(cw.np, "minimum", lambda *a, **k: rounds.append(1) or real(*a, **k))
    number, _ = lists.nearest(np.array([[500, 500, 500, 501]]))
    assert number.tolist() == [500] and len(rounds) < 20


def plain(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(64 * float(np.float32(c)))) for c in x]) for i, x in rows]
    order = sorted(kept, key=lambda r: hashlib.sha256(f"1:{r[0]}".encode()).hexdigest())
    cents = [list(v) for _, v in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min(range(len(cents)), key=lambda c: (far(v, cents[c]), c))
    for _ in range(rounds):
        found = [(near(v), v) for _, v in kept]
        for c in range(len(cents)):
            mine = [v for n, v in found if n == c]
            if mine:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = [(i, near(v), far(v, cents[near(v)])) for i, v in kept]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    total = {c: sum(d for _, n, d in out if n == c) for c in range(len(cents))}
    return sorted((i, c, d, total[c], sum(total.values()), names[c]) for i, c, d in out)


@pytest.mark.parametrize("spread", [0.02, 5.0])
def test_rounds_equal_plain_code(llm, spread):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=8) * spread).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)]
    got, _ = cw.cluster(table(llm, rows), k=7, rounds=3, dims=8)
    assert sorted(map(tuple, got.collect())) == plain(rows, 7, 3, 8)


def test_defined_cases(llm):
    inf, nan = float("inf"), float("nan")
    odd = [(1, None), (2, []), (3, [1.0, nan]), (4, [1.0, inf]), (5, [1.0, None]), (6, [1.0, 2.0, 3.0])]
    good = [(7, [0.5, 1.0]), (7, [0.5, 1.0]), (8, [3e38, -3e38]), (None, [0.5, 1.0])]
    got, centroids = cw.cluster(table(llm, odd + good), k=16, rounds=3, dims=2)
    rows = got.collect()
    assert sorted(str(r["vec_id"]) for r in rows) == ["7", "7", "8", "None"] and len(centroids) == 4
    assert all(r["distance"] == 0 for r in rows)
    # the same vectors in four centroids go to the one with the smallest number
    assert len({r["cluster"] for r in rows if r["vec_id"] != 8}) == 1
    assert cw.cluster(table(llm, odd), dims=2)[0].count() == 0
    assert cw.cluster(table(llm, []))[0].count() == 0
