"""Centroid clustering against a full search."""

import hashlib
import math

import numpy as np
import pytest

from clickstar.llm import centroids
from clickstar.llm.tables import Scratch

ROWS = "vec_id bigint, embedding array<float>, label int, cluster string, vector int, hash int"


def brute(rows, k, rounds, dim):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [max(-2 ** 27, min(2 ** 27, math.floor(64 * x))) for x in
                                  np.array(v, np.float32).astype(float).tolist()]))
    named = sorted((hashlib.sha256(b"1:" + (b"null" if i is None else str(i).encode())).hexdigest(), v)
                   for i, v in kept)
    centres = [v for _, v in named[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        centres = [[sum(col) // len(col) for col in zip(*[v for (_, v), a in zip(kept, at) if a == j])]
                   or c for j, c in enumerate(centres)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = [sum(d for _, c, d in found if c == j) for j in range(len(centres))]
    return sorted([(i, c, d, inertia[c], sum(inertia), hashlib.sha256(
        ",".join(map(str, centres[c])).encode()).hexdigest()) for i, c, d in found], key=repr)


def run(llm, rows, k=4, rounds=3, dim=3):
    df = llm.createDataFrame([(i, v, 1, "c", 2, 3) for i, v in rows], ROWS)
    state, final = centroids.cluster(centroids.whole_vectors(df, dim), Scratch(llm, "k"), k, rounds)
    return centroids.report(state, final)


def plain(df):
    return sorted([tuple(r)[:6] for r in df.collect()], key=repr)


@pytest.mark.parametrize("rounds", [0, 3, 6])
def test_equals_full_search(llm, rounds):
    rng = np.random.default_rng(rounds)
    middles = rng.normal(0, 2, (5, 3))
    rows = [(i, (middles[i % 5] + rng.normal(0, 0.3, 3)).tolist()) for i in range(300)]
    rows += [(i, [0.25 * (i % 3), 0.0, 0.0]) for i in range(300, 400)]  # many ties
    rows += rows[:10]
    assert plain(run(llm, rows, 7, rounds)) == brute(rows, 7, rounds, 3)


def test_awkward_vectors(llm):
    rows = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, None, 2.0]), (5, [1.0, float("nan"), 2.0]),
            (6, [1.0, float("inf"), 2.0]), (None, [1.0, 2.0, 3.0]), (7, [0.0, 0.0, 0.0]),
            (7, [1.0, 0.0, 0.0]), (8, [3e38, -3e38, 1.0]), (8, [3e38, -3e38, 1.0]), (9, [-0.001, 0.5, 1e-30])]
    for k in (1, 3, 20):
        assert plain(run(llm, rows, k)) == brute(rows, k, 3, 3)
    assert run(llm, rows[:6]).collect() == [] and run(llm, []).collect() == []


def test_bounds_spare_distances(llm):
    """Far fewer exact distances than a full search in each of the rounds."""
    rng = np.random.default_rng(3)
    middles = rng.normal(0, 10, (8, 16))
    rows = [(i, (middles[i % 8] + rng.normal(0, 0.2, 16)).tolist()) for i in range(800)]
    df = run(llm, rows, 8, 5, 16)
    assert plain(df) == brute(rows, 8, 5, 16)
    assert sum(r.evaluated for r in df.collect()) < 0.6 * 800 * 8 * 6


def test_a_centroid_that_returns_loosens_nothing():
    """The displacement counts, not the drifts of the rounds: going out and back costs nothing."""
    here, away = np.array([[0, 0], [100, 0]]), np.array([[30, 0], [100, 40]])
    history = centroids.History([here, away, here])
    x = np.array([[1, 0], [99, 0]])
    state = centroids.first_search(x, here)
    up, low = history.loosened(state["upper"], state["upper_round"], state["cluster"], state["lower"],
                               state["lower_round"])
    assert (up == state["upper"]).all() and not centroids.fails(up, low).any()
    centroids.assign(x, state, history)
    assert state["evaluated"].tolist() == [2, 2]
