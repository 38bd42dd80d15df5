"""Pivot-table clustering against plain rounds over all distances."""

import hashlib

import numpy as np
import pytest

from quayside.llm.pivot_clusters import LARGEST, cluster, nearest, spread, squared, to_pivots


def brute(rows, k=8, rounds=10, dims=64, seed=3):
    kept = []
    for vec_id, e, *_ in rows:
        if e is not None and len(e) == dims and all(x is not None and np.isfinite(x) for x in e):
            v = [int(np.floor(min(max(1024 * float(x), -LARGEST), LARGEST))) for x in e]
            kept.append((hashlib.sha256(f"{seed}:{'' if vec_id is None else vec_id}".encode()).hexdigest(), v, vec_id))
    kept.sort(key=lambda r: r[:2])
    centres = [v for _, v, _ in kept[:k]]

    def assign():
        out = []
        for _, v, _ in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)))
        return out

    for _ in range(rounds):
        near = assign()
        for n in range(len(centres)):
            mine = [v for (_, v, _), (_, c) in zip(kept, near) if c == n]
            if mine:
                centres[n] = [sum(x) // len(mine) for x in zip(*mine)]
    near = assign()
    sums = {n: sum(d for d, c in near if c == n) for n in range(len(centres))}
    long = lambda x: x if x < 1 << 63 else None
    return sorted(
        [(i, c, d, long(sums[c]), long(sum(sums.values())), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
         for (_, _, i), (d, c) in zip(kept, near)], key=repr)


def got(spark, rows, dims=64):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, cluster int")
    return sorted([tuple(r) for r in cluster(df.repartition(3), dims=dims).collect()], key=repr)


def test_groups_and_ties(spark):
    rng = np.random.default_rng(1)
    middles = rng.normal(0, 1, (5, 64))
    rows = [(i, (middles[i % 5] + rng.normal(0, 0.1, 64)).tolist()) for i in range(120)]
    rows += [(1000 + i, rows[0][1]) for i in range(80)]  # one vector makes up a third of the table
    rows += [rows[3], rows[3]]
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    good = [(i, [float(i % 3), -0.0004 * i, 2.0]) for i in range(5)]
    odd = [(20, None), (21, []), (22, [1.0, 2.0]), (23, [1.0, None, 2.0]), (24, [1.0, float("nan"), 2.0]),
           (25, [1.0, float("inf"), 2.0]), (26, [1e300, -1e300, 5.0]), (None, [0.5, 0.5, 0.5])]
    assert got(spark, good + odd, 3) == brute(good + odd, dims=3)
    huge = [(i, [1e300 * (-1) ** (i % 2)] * 64) for i in range(12)]
    assert got(spark, huge + [(99, [0.0] * 64)]) == brute(huge + [(99, [0.0] * 64)])
    assert got(spark, odd[:6], 3) == []
    assert got(spark, [], 3) == []


@pytest.mark.parametrize("scale", [3, 1000, LARGEST])
def test_bounds_leave_out_only_what_is_farther(scale):
    rng = np.random.default_rng(scale)
    middles = rng.integers(-scale, scale, (6, 16))
    v = middles[rng.integers(0, 6, 500)] + rng.integers(-(scale // 20) - 1, scale // 20 + 1, (500, 16))
    centres = np.concatenate([middles, middles[:1], v[:1]])
    pivots = spread(v[:64], 8)
    number, distance, computed = nearest(v, to_pivots(v, pivots), centres, to_pivots(centres, pivots))
    every = np.stack([squared(v, c) for c in centres], 1)
    assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert len(v) <= computed <= every.size and (scale < 1000 or computed < every.size / 2)
