"""The cutting-stock solver of operator 9, on the driver: a problem of fixed size.

Items come as a histogram over CLASSES length classes (class c holds lengths
up to c units); a bin holds CLASSES units.  The linear program over bin
patterns and cuts is solved by column generation: a revised simplex keeps the
basis inverse, a knapsack over the dual prices finds the best new pattern, and
a table of price differences the best new cut (an item of class c becomes one
of class a and one of class c - a, for a small cost).  The solution is rounded
down, and what is left is packed by first fit decreasing, again as patterns.
The work depends on the number of classes, never on the number of items.
"""

from __future__ import annotations

import numpy as np

#: Cost of one cut, in bins.
CUT_COST = 0.01
MAX_PIVOTS = 4000
#: The program is solved to this share above the material bound, or until it gains less in 256 pivots.
GAP = 0.002


def _best_pattern(price: np.ndarray) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of classes within the capacity."""
    m = len(price)
    value = np.zeros(m + 1)
    choice = np.zeros(m + 1, dtype=np.int64)  # class (1-based) taken last, 0: a unit left empty
    for w in range(1, m + 1):
        got = value[w - 1 :: -1][:w] + price[:w]  # value[w - c] + price of class c
        c = int(np.argmax(got))
        value[w], choice[w] = (got[c], c + 1) if got[c] > value[w - 1] else (value[w - 1], 0)
    pattern, w = np.zeros(m), m
    while w > 0:
        c = choice[w]
        if c:
            pattern[c - 1] += 1
        w -= c or 1
    return float(value[m]), pattern


def _best_cut(price: np.ndarray, cut_units: list[int]) -> tuple[float, int, int]:
    """Largest price[c] - price[a] - price[c - a] over classes c and allowed a < c."""
    best = (-1.0, 0, 0)
    m = len(price)
    for a in cut_units:
        if a < m:
            gain = price[a:] - price[a - 1] - price[: m - a]  # index i: class a + 1 + i into a and i + 1
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (float(gain[i]), a + 1 + i, a)
    return best


def solve(counts: np.ndarray, cut_units: list[int]) -> tuple[list[tuple[np.ndarray, float]], dict[tuple[int, int], float]]:
    """Fractional optimum: [(pattern, times)] and {(class, a): times cut}."""
    m = len(counts)
    demand = counts.astype(float) + 1e-6 * (1 + np.arange(m) / m)  # no ties between pivots
    basis: list[tuple] = [("p", _single(m, c)) for c in range(1, m + 1)]
    inverse = np.diag([1.0 / (m // c) for c in range(1, m + 1)])
    cost = np.ones(m)
    x = inverse @ demand
    scale = max(1.0, counts.sum())
    least = float(counts @ (np.arange(m) + 1.0)) / m  # no packing has fewer bins
    recent = np.inf
    for pivot in range(MAX_PIVOTS):
        now = float(cost @ x)
        stalled = pivot % 256 == 255 and now > recent * (1 - GAP / 10)
        if now <= least * (1 + GAP) or stalled and now <= least * (1 + 10 * GAP):
            break
        if pivot % 256 == 255:
            recent = now
        price = cost @ inverse
        value, pattern = _best_pattern(np.maximum(price, 0))
        gain, c, a = _best_cut(price, cut_units)
        negative = int(np.argmin(price))
        # reduced costs: pattern 1 - value, cut CUT_COST - gain, surplus of a class price
        offers = [(value - 1, "p"), (gain - CUT_COST, "c"), (-float(price[negative]), "s")]
        best, kind = max(offers)
        if best < 1e-7:
            break
        column = np.zeros(m)
        if kind == "p":
            column, entering, new_cost = pattern, ("p", pattern), 1.0
        elif kind == "c":
            column[c - 1] += 1
            column[a - 1] -= 1
            column[c - a - 1] -= 1
            entering, new_cost = ("c", (c, a)), CUT_COST
        else:
            column[negative] = -1
            entering, new_cost = ("s", negative), 0.0
        direction = inverse @ column
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / direction[up]
        out = int(np.argmin(ratio))
        step = ratio[out]
        x -= step * direction
        x[out] = step
        np.maximum(x, 0, out=x)
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        basis[out], cost[out] = entering, new_cost
    patterns = [(b[1], v) for b, v in zip(basis, x) if b[0] == "p" and v > 1e-9 * scale]
    cuts = {b[1]: v for b, v in zip(basis, x) if b[0] == "c" and v > 1e-9 * scale}
    return patterns, cuts


def _single(m: int, c: int) -> np.ndarray:
    p = np.zeros(m)
    p[c - 1] = m // c
    return p


def _first_fit(left: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Patterns for what is left: each takes the largest items that still fit, as often as they last."""
    left = left.copy()
    out = []
    while left.any():
        pattern, room = np.zeros(len(left), dtype=np.int64), len(left)
        for c in range(len(left), 0, -1):
            if left[c - 1] and c <= room:
                n = min(room // c, int(left[c - 1]))
                pattern[c - 1] += n
                room -= n * c
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        left[used] -= times * pattern[used]
        out.append((pattern, times))
    return out


def plan(counts: np.ndarray, cut_units: list[int]) -> tuple[list[tuple[np.ndarray, int]], dict[tuple[int, int], int]]:
    """Whole-numbered patterns that hold every item exactly once, and the cuts
    made before, from the largest class down: {(class, a): items}.  What a cut
    gives may be cut again.  counts[c - 1]: items of class c."""
    items = counts.astype(np.int64)
    if not items.any():
        return [], {}
    patterns, cuts = solve(items, cut_units)
    items = items.copy()
    whole_cuts: dict[tuple[int, int], int] = {}
    uncut = items.copy()
    for (c, a), times in sorted(cuts.items(), reverse=True):
        n = min(int(times + 1e-6), int(uncut[c - 1]))
        if n:
            whole_cuts[c, a] = n
            for k, by in ((c, -n), (a, n), (c - a, n)):
                items[k - 1] += by
                uncut[k - 1] += by
    out = []
    for pattern, times in sorted(patterns, key=lambda p: -p[1]):
        pattern = pattern.astype(np.int64)
        used = pattern > 0
        n = min(int(times + 1e-6), int((items[used] // pattern[used]).min()))
        if n > 0:
            items[used] -= n * pattern[used]
            out.append((pattern, n))
    return out + _first_fit(items), whole_cuts
