from collections import Counter, defaultdict

import pytest
from helpers import documents, frame

from tokenloom.llm.mixing import mix, mixed, multipliers


def plain_targets(size):
    """Sources by code point, null last, weights 5, 2, 1; excess shared again until none is above."""
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, capped, rest = {}, set(), 1.5 * sum(size.values())
    while True:
        free = [s for s in order if s not in capped]
        total = sum(weight[s] for s in free)
        share = {s: rest * weight[s] / total for s in free} if total else {}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = 2.0 * size[s]
            rest -= target[s]
            capped.add(s)


def many(n=900):
    return [(1000 + i, "w " * (1 + (i * 37) % 211), "en", f"s{i % 7}", 0, 0, 0, 0, "") for i in range(n)]


def test_targets_and_copies(spark):
    rows = many() + documents()
    got = mix(frame(spark, rows)).collect()
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len((r[1] or "").encode().split())
    target = plain_targets(size)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len((r[1] or "").encode().split())) for r in rows)
    assert all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in got)
    source = {r[0]: r[3] for r in rows}
    taken = defaultdict(int)
    for r in got:
        if r.doc_id is not None:
            assert r.source_size == size[source[r.doc_id]] and r.target == pytest.approx(target[source[r.doc_id]], rel=1e-9)
            taken[source[r.doc_id]] += r.taken
    for i in range(7):
        assert taken[f"s{i}"] == pytest.approx(target[f"s{i}"], rel=0.01)


def test_reruns_agree_whatever_the_partitions(spark):
    a = mix(frame(spark, many(), partitions=2)).collect()
    b = mix(frame(spark, many(), partitions=5)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_rows_of_the_mix(spark):
    rows = documents()
    docs = frame(spark, rows)
    out = mixed(docs)
    assert out.columns == docs.columns
    plan = Counter()
    for r in mix(docs).collect():
        plan[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in plan.items() if v})
    assert mix(frame(spark, [])).collect() == [] and mixed(frame(spark, [])).collect() == []


def test_multipliers_equal_an_independent_solver(spark):
    """Plain bisection of each source's constraint, in Python floats."""
    import math
    import random

    rng = random.Random(5)
    hist, targets = [], []
    for i, share in enumerate([0.02, 0.5, 1.0, 1.4, 1.99, 2.0, 0.0]):
        name = None if i == 3 else f"s{i}"
        sizes = {rng.randint(1, 20000 if i % 2 else 300): rng.randint(1, 400) for _ in range(200)}
        hist += [(name, s, n) for s, n in sizes.items()]
        targets.append((name, share * sum(s * n for s, n in sizes.items())))
    got = dict(map(tuple, multipliers(spark.createDataFrame(hist, "source string, size long, n long"), spark.createDataFrame(targets, "source string, target double")).collect()))
    assert got["s5"] == math.inf and got["s6"] == -math.inf

    def taken(name, lam):
        return sum(n * s * 2 / (1 + math.exp(min(max(-lam * s, -700), 700))) for x, s, n in hist if x == name)

    for name, target in targets[:5]:
        low, high = -60.0, 60.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if taken(name, mid) < target else (low, mid)
        assert taken(name, got[name]) == pytest.approx(target, rel=1e-5)
        assert got[name] == pytest.approx(low, rel=1e-3, abs=1e-8)
