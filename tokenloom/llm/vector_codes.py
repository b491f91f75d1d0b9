"""Operator 11, vector code compression: product codes by Lloyd rounds on
anchors-hierarchy metric trees.

Components become integers, floor(4096 x).  Vectors are cut into PARTS equal
consecutive parts; each part position has a codebook of up to ENTRIES entries,
at first the parts of the vectors with the smallest ids.  A round assigns every
part to its nearest entry (squared distance, ties to the lower index) and moves
each entry to the floor of its parts' mean; after the last round parts are
assigned once more.  All of it is integer arithmetic, so the result does not
depend on how the vectors are dealt.

Vectors are dealt by hash into chunks of about CHUNK, and each chunk gets one
metric tree a part position, built once, middle-out: anchors take the points
nearest to them, a new anchor starting at the farthest point of the widest one
and looking only at points that the triangle inequality lets it win; anchors
are merged in pairs into balls up to the root and split in the same way down to
leaves.  A ball caches its points' sum and count, center and radius.

In a round a ball inherits its parent's list of candidate entries and drops
those that cannot be nearest to any point within its radius.  A ball with one
candidate left is wholly owned: its cached sum and count go to the entry and
its points are not looked at.  Leaves with more candidates compare theirs
exactly.  Dropping is only done clear of rounding, so ties reach the leaves.
A round is one map over the trees and one aggregation of at most PARTS x
ENTRIES rows; only these sums reach the driver, and only codebooks leave it.

Defined results: a vector that is null or holds null or non-finite components
is dropped; other rows each give one, repeated rows and null ids (which sort
last) included; rows with equal ids start codebooks in the order of their
components; vectors of unequal length, or of a length that PARTS does not
divide, count as ending in zeros; with fewer than ENTRIES rows the codebooks are
shorter; an empty table gives no rows; a component of 32,768 or more in size,
whose squares would not fit, raises; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import fits, written
from tokenloom.session import ship_package

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors of one chunk, about.
CHUNK = 2048
#: Points of a ball that is not split further.
LEAF = 12
#: Largest component, scaled: sums of squared distances then fit in 63 bits.
LARGEST = 1 << 27
#: Most labels sent to every task; beyond, they are joined by a shuffle.
MOST_LABELS = 1 << 17


# ----------------------------------------------------------- anchors hierarchy
def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return ((x - y) ** 2).sum(axis=-1)


def anchors(x: np.ndarray, k: int) -> np.ndarray:
    """The owner, below `k`, of each point: k anchors, or fewer if the points
    are fewer places, grown one at a time from the farthest point of the widest."""
    pivots = [x[0]]
    owner, far = np.zeros(len(x), np.int64), np.sqrt(_squares(x, x[0]))
    while len(pivots) < k:
        new = int(np.argmax(far))
        if far[new] == 0:
            break
        between = np.sqrt(_squares(np.array(pivots), x[new]))
        # a point nearer to its pivot than half way to the new one stays: no distance computed
        may = np.flatnonzero(far > between[owner] / 2)
        d = np.sqrt(_squares(x[may], x[new]))
        won = d < far[may]
        owner[may[won]], far[may[won]] = len(pivots), d[won]
        pivots.append(x[new])
    return owner


class Tree:
    """A metric tree over integer points, as arrays by ball: children (-1 in a
    leaf), range in `order`, count, sum, center and radius."""

    def __init__(self, points: np.ndarray):
        self.points, self._x = points, points.astype(np.float64)
        self.left, self.right, self.start, self.end = [], [], [], []
        self.order = np.arange(len(points))
        self._order: list[np.ndarray] = []
        self._at = 0
        self.root = self._grow(self.order)
        self.order = np.concatenate(self._order)
        self.left, self.right, self.start, self.end = (np.array(v) for v in (self.left, self.right, self.start, self.end))
        running = np.vstack([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points[self.order], axis=0)])
        self.sum, self.count = running[self.end] - running[self.start], self.end - self.start
        self.center = self.sum / self.count[:, None]
        # the farthest of a ball's points, widened against rounding
        ranged = self._x[self.order]
        far = [np.sqrt(_squares(ranged[s:e], c).max()) for s, e, c in zip(self.start, self.end, self.center)]
        self.radius = np.array(far) * (1 + 1e-9) + 1e-6
        del self._x, self._order

    def _node(self, left: int, right: int, start: int, end: int) -> int:
        for column, value in zip((self.left, self.right, self.start, self.end), (left, right, start, end)):
            column.append(value)
        return len(self.left) - 1

    def _grow(self, at: np.ndarray) -> int:
        """The ball over the points `at`."""
        owner = anchors(self._x[at], max(2, int(np.sqrt(len(at))))) if len(at) > LEAF else np.zeros(len(at), np.int64)
        groups = [at[owner == i] for i in range(int(owner.max()) + 1)]
        if len(groups) == 1:
            self._order.append(at)
            self._at += len(at)
            return self._node(-1, -1, self._at - len(at), self._at)
        # middle-out: first how the anchors merge, then each anchor's own ball, so that ranges are whole
        return self._merged(*self._plan(groups), groups)

    def _plan(self, groups: list[np.ndarray]) -> tuple[list[tuple[int, int]], int]:
        """The merges of anchors, each the pair whose ball is smallest: numbers
        from len(groups) on name the merged balls."""
        k, merges = len(groups), []
        size = np.array([len(g) for g in groups], dtype=np.float64)
        center = np.array([self._x[g].mean(axis=0) for g in groups])
        radius = np.array([np.sqrt(_squares(self._x[g], c).max()) for g, c in zip(groups, center)])
        name, alive = np.arange(k), np.ones(k, bool)
        cost = np.full((k, k), np.inf)

        def costs(i: int) -> np.ndarray:
            weight = size / (size + size[i])
            apart = np.sqrt(_squares(center, center[i]))
            return np.maximum(radius + apart * (1 - weight), radius[i] + apart * weight)

        for i in range(k):
            cost[i] = costs(i)
            cost[i, i] = np.inf
        for step in range(k - 1):
            i, j = divmod(int(np.argmin(cost)), k)
            merges.append((int(name[i]), int(name[j])))
            radius[i] = cost[i, j]
            center[i] = (center[i] * size[i] + center[j] * size[j]) / (size[i] + size[j])
            size[i], name[i], alive[j] = size[i] + size[j], k + step, False
            cost[j, :] = cost[:, j] = np.inf
            cost[i] = np.where(alive, costs(i), np.inf)
            cost[i, i] = np.inf
            cost[:, i] = cost[i]
        return merges, 2 * k - 2

    def _merged(self, merges: list[tuple[int, int]], top: int, groups: list[np.ndarray]) -> int:
        """Balls by the plan, depth first without recursion over merges."""
        k, done, todo = len(groups), {}, [(top, False)]
        while todo:
            n, ready = todo.pop()
            if n < k:
                done[n] = self._grow(groups[n])
            elif ready:
                left, right = (done[m] for m in merges[n - k])
                done[n] = self._node(left, right, self.start[left], self.end[right])
            else:
                left, right = merges[n - k]
                todo += [(n, True), (right, False), (left, False)]
        return done[top]

    def walk(self, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The balls that the candidates decide, a level at a time: (balls wholly
        owned, their entries), and last (leaves' points, their entries) as points
        are in `order`, told apart by a negative sign: point p is -1 - p."""
        entries = book.astype(np.float64)
        gap = np.sqrt(_squares(entries[:, None, :], entries[None, :, :]))
        balls, may = np.array([self.root]), np.ones((1, len(book)), bool)
        while len(balls):
            d2 = _squares(self.center[balls][:, None, :], entries[None, :, :])
            near = np.where(may, d2, np.inf).argmin(axis=1)
            # how far the plane midway to an entry is from the center, on the nearest entry's side;
            # beyond the radius, no point of the ball is as near to that entry
            with np.errstate(invalid="ignore", divide="ignore"):
                plane = (d2 - d2[np.arange(len(balls)), near][:, None]) / (2 * gap[near])
            clear = plane * (1 - 1e-9) - 1e-6 > self.radius[balls][:, None]
            # of equal entries only the lowest index is ever nearest
            twin = (gap[near] == 0) & (np.arange(len(book)) > near[:, None])
            may &= ~(clear | twin)
            sole = may.sum(axis=1) == 1
            yield balls[sole], may[sole].argmax(axis=1)
            balls, may = balls[~sole], may[~sole]
            leaf = self.left[balls] < 0
            if leaf.any():
                n = self.count[balls[leaf]]
                which = np.repeat(np.flatnonzero(leaf), n)
                first = np.repeat(self.start[balls[leaf]], n)
                at = self.order[first + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)]
                exact = ((self.points[at][:, None, :] - book[None, :, :]) ** 2).sum(axis=-1)
                yield -1 - at, np.where(may[which], exact, np.iinfo(np.int64).max).argmin(axis=1)
            balls, may = balls[~leaf], may[~leaf]
            balls, may = np.concatenate([self.left[balls], self.right[balls]]), np.concatenate([may, may])

    def sums(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sums, counts) of the points nearest to each entry of `book`."""
        total, count = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
        for found, entry in self.walk(book):
            points = len(found) and found[0] < 0
            np.add.at(total, entry, self.points[-1 - found] if points else self.sum[found])
            np.add.at(count, entry, 1 if points else self.count[found])
        return total, count

    def codes(self, book: np.ndarray) -> np.ndarray:
        """The nearest entry of each point."""
        out = np.zeros(len(self.points), np.int64)
        for found, entry in self.walk(book):
            if len(found) and found[0] < 0:
                out[-1 - found] = entry
            else:
                for ball, e in zip(found, entry):
                    out[self.order[self.start[ball] : self.end[ball]]] = e
        return out


# ------------------------------------------------------------------ operator
def quantized(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v array<long>) of the vectors that take part."""
    ship_package(vectors.sparkSession)
    x = F.transform(vectors["embedding"], lambda e: e.cast("double"))
    good = vectors["embedding"].isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    most = LARGEST / scale
    checked = F.when(F.forall(x, lambda e: F.abs(e) < most), F.transform(x, lambda e: F.floor(e * scale)))
    v = F.coalesce(checked, F.raise_error(F.lit(f"a component is {most} or more in size")).cast("array<bigint>"))
    return vectors.where(good).select(vectors["vec_id"].alias("vec_id"), vectors["label"].alias("label"), v.alias("v"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """The vectors as rows, zeros after their ends."""
    n = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    out = np.zeros((len(n), width), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def grown(points: DataFrame, width: int, chunks: int) -> DataFrame:
    """(rows array<struct<vec_id, label>>, trees binary) of each chunk."""

    def grow(batches):
        for b in batches:
            rows = b.column(0)
            for i in range(b.num_rows):
                chunk = rows.slice(i, 1).flatten()
                x = _matrix(chunk.field("v"), width)
                trees = [Tree(np.ascontiguousarray(p)) for p in np.split(x, PARTS, axis=1)]
                yield pa.RecordBatch.from_arrays([_named(rows.slice(i, 1)), pa.array([pickle.dumps(trees, protocol=5)], pa.binary())], ["rows", "trees"])

    numbered = points.withColumn("chunk", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)))
    dealt = numbered.repartition(chunks, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("vec_id", "label", "v")).alias("rows"))
    kinds = {f.name: f.dataType.simpleString() for f in points.schema}
    return dealt.select("rows").mapInArrow(grow, f"rows array<struct<vec_id:{kinds['vec_id']},label:{kinds['label']}>>, trees binary")


def _named(rows: pa.ListArray) -> pa.ListArray:
    """A list of (vec_id, label, v) without v."""
    flat = rows.flatten()
    named = pa.StructArray.from_arrays([flat.field("vec_id"), flat.field("label")], ["vec_id", "label"])
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), named)


def first_codebooks(points: DataFrame, width: int, entries: int) -> list[np.ndarray]:
    """By part, the parts of the vectors with the smallest ids."""
    rows = points.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    x = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        x[i, : len(r.v)] = r.v
    return [np.ascontiguousarray(p) for p in np.split(x, PARTS, axis=1)]


def moved(books: list[np.ndarray], trees: DataFrame) -> list[np.ndarray]:
    """The codebooks after one round over `trees`."""

    def run(batches):
        for b in batches:
            parts, entry, counts, sums = [], [], [], []
            for data in b.column(0):
                for p, (tree, book) in enumerate(zip(pickle.loads(data.as_py()), books)):
                    total, count = tree.sums(book)
                    used = np.flatnonzero(count)
                    parts += [p] * len(used)
                    entry += used.tolist()
                    counts += count[used].tolist()
                    sums += total[used].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts, pa.int64()), pa.array(sums, pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    found = trees.select("trees").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    # sums over the corpus may pass 63 bits where one chunk's cannot
    whole = [F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(books[0].shape[1])]
    out = [b.copy() for b in books]
    for r in found.groupBy("part", "entry").agg(F.sum("n"), *whole).collect():
        out[r[0]][r[1]] = [int(s) // r[2] for s in r[3:]]
    return out


def vector_codes(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, scale: int = SCALE, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for every vector
    (vec_id, embedding, label) that takes part."""
    spark = vectors.sparkSession
    points = written(quantized(vectors, scale), "points")
    n, longest = points.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(1, -(-(longest or 0) // PARTS)) * PARTS
    books = first_codebooks(points, width, entries)
    trees = written(grown(points, width, max(1, -(-n // chunk))), "trees")
    if n:
        for _ in range(rounds):
            books = moved(books, trees)
    last = books

    def code(batches):
        for b in batches:
            for i in range(b.num_rows):
                rows = b.column(0).slice(i, 1).flatten()
                at, error = [], np.zeros(len(rows), np.int64)
                for tree, book in zip(pickle.loads(b.column(1)[i].as_py()), last):
                    at.append(tree.codes(book))
                    error += ((tree.points - book[at[-1]]) ** 2).sum(axis=1)
                text = pa.array(["".join(f"{c:02x}" for c in row) for row in np.stack(at, axis=1).tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([rows.field("vec_id"), rows.field("label"), text, pa.array(error)], ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in points.schema}
    coded = written(trees.mapInArrow(code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "codes")
    labels = coded.groupBy(F.col("label").alias("l")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    labels = F.broadcast(labels) if fits(labels, MOST_LABELS) else labels
    numbers = itertools.chain.from_iterable(b.ravel().tolist() for b in last)
    sha = hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
    joined = coded.join(labels, F.col("label").eqNullSafe(F.col("l")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
