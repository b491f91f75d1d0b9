import random

import numpy as np
import xxhash
from helpers import documents, frame, stored

from tokenloom.llm import simhash
from tokenloom.llm.components import connected_components


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in lower.encode().split()]
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values, bits=3):
    """Component number of each value, by brute force."""
    f = np.array(values, dtype=np.uint64)
    label = list(range(len(f)))
    changed = True
    while changed:
        changed = False
        for i in range(len(f)):
            near = np.flatnonzero(np.bitwise_count(f ^ f[i]) <= bits)
            low = min(label[j] for j in near)
            for j in near:
                changed |= label[j] != low
                label[j] = low
    return label


def test_equals_brute_force(spark):
    rows = documents()
    got = simhash.simhash_duplicates(frame(spark, rows)).collect()
    fps = [plain_fingerprint(r[1]) for r in rows]
    label = classes(fps)
    smallest = {}
    for r, x in zip(rows, label):
        if r[0] is not None:
            smallest[x] = min(smallest.get(x, r[0]), r[0])
    expected = sorted((str(r[0]), f"{f:016x}", str(smallest.get(x))) for r, f, x in zip(rows, fps, label))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected
    assert simhash.simhash_duplicates(frame(spark, [])).collect() == []


def test_large_buckets_are_refined_without_loss(spark):
    """Chains of near fingerprints, with buckets of at most 4 compared at once."""
    rng = random.Random(2)
    values = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            values.add(x)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
    values |= {rng.getrandbits(64) for _ in range(50)}
    values = sorted(values)
    fps = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    got = {r.node: r.label for r in connected_components(simhash.links(fps, group=4)).collect()}
    label = classes(values)
    mine = [got.get(simhash._signed(v), simhash._signed(v)) for v in values]
    assert len(set(zip(mine, label))) == len(set(label)) == len(set(mine))


def test_chain_budgets_never_prune_a_pair():
    rng = random.Random(5)
    roots = simhash.root_masks()
    for _ in range(2000):
        x = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        passed = [i for i, m in roots if x & m == 0 and simhash._close(np.array([x], dtype=np.uint64), np.array([i]), 3)[0]]
        assert passed


def test_one_of_each_keeps_the_first(spark, tmp_path):
    rows = documents()
    docs = stored(spark, tmp_path / "d", rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    label = classes([plain_fingerprint(r[1]) for r in rows])
    assert kept.count() == len(set(label))
    ids = [r.doc_id for r in kept.collect()]
    assert 5 in ids and 100 not in ids and ids.count(107) == 1
