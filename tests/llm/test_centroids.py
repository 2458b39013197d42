"""Ns-bounds: equal to full rounds, tighter than summed drifts, defined results for odd input."""

import hashlib
import random

import numpy as np
import pytest

from churnkit.llm import centroids as C

SCHEMA = "vec_id bigint, embedding array<double>, label int, cluster string"


def brute(rows, k, rounds, dims, scale=64, seed=1):
    """Full rounds in Python integers; rows of (vec_id, vector)."""
    ok = [(i, [min(max(int(np.floor(scale * x)) if abs(scale * x) < 9e18 else (C.LONG_MAX if x > 0 else -C.LONG_MAX - 1),
                       -C.LONG_MAX - 1), C.LONG_MAX) for x in v])
          for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(ok, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        groups = {}
        for _, v in ok:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, g in groups.items():
            cents[j] = [sum(x) // len(g) for x in zip(*g)]
    near = [(i, *nearest(v)) for i, v in ok]
    total = sum(d for _, d, _ in near)
    return sorted(((i is None, i or 0), j, min(d, C.LONG_MAX), min(sum(min(e, C.LONG_MAX) for _, e, q in near if q == j), C.LONG_MAX),
                   min(total, C.LONG_MAX) if total <= C.LONG_MAX else C.LONG_MAX,
                   hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, d, j in near)


def run(spark, rows, **kw):
    out = C.cluster(spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA), **kw).collect()
    return sorted(((r.vec_id is None, r.vec_id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out)


def test_equals_full_rounds_in_many_rounds(spark):
    g = np.random.default_rng(3)
    middle = g.normal(size=(12, 6)) * 2
    rows = [(i, (middle[i % 12] + g.normal(size=6) * 0.8).tolist()) for i in range(1500)]
    assert run(spark, rows, k=9, rounds=7, dims=6) == brute(rows, 9, 7, 6)


def test_bounds_save_work_and_total_displacement_beats_summed_drifts():
    g = np.random.default_rng(5)
    x = (g.normal(size=(4000, 8)) * 40 + g.integers(0, 6, (4000, 1)) * 150).astype(np.int64)
    history = [x[:12].copy()]
    a, bound = C.assign_full(x, history[0])
    seen = np.zeros_like(bound, dtype=np.int32)
    made, drifts = 0, []
    for _ in range(6):
        c = history[-1].copy()
        for j in np.unique(a):
            c[j] = x[a == j].sum(0) // (a == j).sum()
        drifts.append(C.root(C.squared(c, history[-1])))
        history.append(c)
        moved = C.displacements(history)
        assert (moved[0] <= sum(drifts) + 1e-6).all()
        a, bound, seen, n = C.assign_bounded(x, a, bound, seen, history, moved)
        made += n
        assert (a == C.assign_full(x, c)[0]).all()
    assert made < 0.5 * 6 * x.shape[0] * 12
    assert (moved[0] < sum(drifts) - 1).any()


def test_odd_rows_ties_repeats_and_few_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, -0.3]), (1, [0.5, -0.3]), (1, [0.1, 0.2]), (2, None), (3, [1.0]), (4, [nan, 0.0]), (5, [inf, 0.0]),
            (6, [None, 1.0]), (None, [0.25, 0.25]), (7, [0.0, 0.0]), (8, [1.0, 0.0]), (9, [0.5, 0.0]), (10, [])]
    assert run(spark, rows, k=2, rounds=3, dims=2) == brute(rows, 2, 3, 2)
    assert run(spark, rows[:2], k=16, rounds=2, dims=2) == brute(rows[:2], 16, 2, 2)


def test_huge_components_stay_exact(spark):
    r = random.Random(1)
    rows = [(i, [r.choice((-1, 1)) * r.random() * 10 ** r.choice((0, 7, 8)) for _ in range(3)]) for i in range(60)]
    assert run(spark, rows, k=5, rounds=3, dims=3) == brute(rows, 5, 3, 3)
    rows.append((99, [1e300, -1e300, 0.0]))
    assert len(run(spark, rows, k=5, rounds=3, dims=3)) == 61


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [1.0, 2.0, 3.0])]])
def test_no_vectors_give_no_rows(spark, rows):
    assert run(spark, rows, k=4, rounds=2, dims=2) == []
