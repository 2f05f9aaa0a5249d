import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import ball_kmeans as B

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    x = [[math.floor(4096 * float(np.float32(c))) for c in r[1]] for r in kept]
    x = [v + [0] * (parts * width - len(v)) for v in x]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in x]
    book = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def nearest(v, b):
        return min((sum((a - c) ** 2 for a, c in zip(v, e)), k) for k, e in enumerate(b))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for v in cut:
                members.setdefault(nearest(v[p], book[p])[1], []).append(v[p])
            for k, vs in members.items():
                book[p][k] = [sum(c) // len(vs) for c in zip(*vs)]
    digest = hashlib.sha256(",".join(str(c) for b in book for e in b for c in e).encode()).hexdigest()
    found = []
    for r, v in zip(kept, cut):
        best = [nearest(v[p], book[p]) for p in range(parts)]
        found.append((r[0], "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), r[2]))
    total = {}
    for f in found:
        total[f[3]] = total.get(f[3], 0) + f[2]
    return [(*f[:3], total[f[3]], digest) for f in found]


def check(df, rows):
    assert sorted(map(str, map(tuple, B.vector_codes(df).collect()))) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    scale = [1.0, 0.002, 30.0][seed]  # the small scale gives many ties
    rows = [(i * 3, [rng.gauss(i % 5, 1) * scale for _ in range(16)], rng.choice([None, 1, 2])) for i in range(200)]
    check(spark.createDataFrame(rows, SCHEMA).repartition(5), rows)


def test_odd_rows(spark):
    v = [0.25 * i for i in range(8)]
    rows = [(1, v, 1), (1, v, 1), (2, None, 1), (3, [None, *v[1:]], 1), (4, [float("nan"), *v[1:]], None),
            (5, [float("inf"), *v[1:]], None), (None, [x + 1 for x in v], None), (6, v[:4], 2), (7, [-x for x in v], None),
            (1, [x - 1 for x in v], 3), (8, [], 1)]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA + ", codes string, v string, is_sum string")
    check(df, rows)


def test_length_that_parts_do_not_divide(spark):
    rows = [(i, [float(i), i / 2, -i / 3], None) for i in range(20)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_one_vector_very_often(spark):
    rows = [(i, [1.0] * 8 if i % 3 else [i / 7, *[0.5] * 7], i % 2) for i in range(300)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_no_rows_and_no_vectors(spark):
    assert B.vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert B.vector_codes(spark.createDataFrame([(1, None, 2)], SCHEMA)).count() == 0


def test_very_large_components_are_cut(spark):
    rows = [(i, [1e30 if i % 2 else -1e30] + [0.0] * 7, 1) for i in range(40)]
    found = B.vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 40 and all(r.error >= 0 for r in found)


def test_balls_leave_out_only_what_cannot_be_nearest():
    rng = np.random.default_rng(1)
    for _ in range(50):
        book = rng.integers(-30, 30, (1, 16, 2))
        x = rng.integers(-40, 40, (300, 2))
        gap = ((x[:, None] - book[0]) ** 2).sum(2)
        own = rng.integers(0, 16, 300)
        far = [max([B._root_up(int(d)) for d in gap[own == e, e]], default=-1) for e in range(16)]
        entry, best = B.assign(x, 0, own, B.balls(book, np.array([far], object)))
        assert (entry == gap.argmin(1)).all() and (best == gap.min(1)).all()


def test_stable_cores_are_not_compared_again():
    """Two far groups around their entries: no ring reaches a member."""
    book = np.array([[[0, 0], [1000, 0]]])
    b = B.balls(book, np.array([[3, 3]], object))
    assert (b.ring == B._FAR).all()
