import hashlib
import math
import random

import numpy as np
import pytest

from tokenloom.llm.vector_codes import Tree, anchors, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, chunk long, code string, v long, trees string"


def brute(rows, entries=16, rounds=6):
    """(vec_id, code, error, label_error, sha) by plain loops."""
    vs = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], lab) for i, v, lab, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max([1] + [-(-len(v) // 8) for _, v, _ in vs]) * 8
    d = width // 8
    padded = [(i, tuple(v) + (0,) * (width - len(v)), lab, v) for i, v, lab in vs]
    first = sorted(padded, key=lambda r: (r[0] is None, r[0], r[3]))[:entries]
    cut = lambda v: [v[p * d : p * d + d] for p in range(8)]
    books = [[cut(r[1])[p] for r in first] for p in range(8)]
    dist = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    nearest = lambda x, book: min(range(len(book)), key=lambda e: (dist(x, book[e]), e))
    for _ in range(rounds):
        for p in range(8):
            of = {}
            for r in padded:
                of.setdefault(nearest(cut(r[1])[p], books[p]), []).append(cut(r[1])[p])
            for e, xs in of.items():
                books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs))
    out, by_label = [], {}
    for i, v, lab, _ in padded:
        codes = [nearest(x, b) for x, b in zip(cut(v), books)]
        error = sum(dist(x, b[c]) for x, b, c in zip(cut(v), books, codes))
        out.append((i, "".join(f"{c:02x}" for c in codes), error, lab))
        by_label[lab] = by_label.get(lab, 0) + error
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[lab], sha) for i, c, e, lab in out), key=str)


def table(n=330, d=16, seed=3):
    rng = random.Random(seed)
    rest = (5, "clash", 5, "clash")
    rows = [(i * 7 % 1000, [rng.gauss(i % 5, 0.4) for _ in range(d)], i % 4 if i % 3 else 9) for i in range(n)]
    rows += [(2000 + i, rows[4][1], None) for i in range(40)] + [rows[6], rows[6]]  # copies, repeated rows
    rows += [(3000 + i, [float(rng.randint(-1, 1)) for _ in range(d)], 1) for i in range(60)]  # many ties
    rows += [(4000, None, 0), (4001, [1.0, None], 0), (4002, [float("nan")] * d, 0), (4003, [float("inf")] * d, 0)]
    rows += [(None, [0.5] * d, 2), (4004, [], None), (4005, [-3.25], 2), (4006, [-1e-9] * d, 2)]
    return [r + rest for r in rows]


def test_equals_brute_force(spark):
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for chunk in (60, 2048):
        got = vector_codes(df, chunk=chunk)
        assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_few_rows_and_none(spark):
    rows = table()[:5] + [table()[0]]
    assert sorted(map(tuple, vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute(rows)
    assert vector_codes(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(Exception, match="in size"):
        vector_codes(spark.createDataFrame([(1, [1e30] * 8, 0, 0, "", 0, "")], SCHEMA)).collect()


def test_anchors_own_their_nearest_points():
    x = np.random.default_rng(0).normal(size=(400, 4))
    owner = anchors(x, 20)
    assert set(owner) == set(range(20))
    firsts = np.array([x[np.flatnonzero(owner == i)] .mean(axis=0) for i in range(20)])
    assert len(firsts) == 20
    assert set(anchors(np.ones((50, 3)), 7)) == {0}  # one place


def test_balls_hold_their_points_and_owned_ones_are_not_looked_at():
    rng = np.random.default_rng(2)
    centers = rng.integers(-9000, 9000, (16, 8))
    x = np.repeat(centers, 120, axis=0) + rng.integers(-60, 60, (1920, 8))
    t = Tree(x)
    assert sorted(t.order) == list(range(len(x)))
    for ball in range(len(t.count)):
        mine = x[t.order[t.start[ball] : t.end[ball]]]
        assert t.count[ball] == len(mine) and (t.sum[ball] == mine.sum(axis=0)).all()
        assert (np.sqrt(((mine - t.center[ball]) ** 2).sum(axis=1)) <= t.radius[ball]).all()
    exact = ((x[:, None] - centers[None]) ** 2).sum(axis=-1).argmin(axis=1)
    assert (t.codes(centers) == exact).all()
    looked = sum(len(f) for f, _ in t.walk(centers) if len(f) and f[0] < 0)
    balls = sum(len(f) for f, _ in t.walk(centers) if len(f) and f[0] >= 0)
    assert looked < 200 and balls < 200  # of 1,920 points
    total, count = t.sums(centers)
    assert (count == np.bincount(exact, minlength=16)).all() and (total.sum(axis=0) == x.sum(axis=0)).all()
