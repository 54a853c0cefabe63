"""Vector expressions over ``array<double>`` columns and the NumPy kernels behind them.

Distances are summed left to right over coordinates, the same order a scalar loop uses, so
equal inputs give bit-identical distances whichever form computes them:

* built-in higher-order functions (``zip_with``/``aggregate``) for single expressions;
* NumPy blocks over Arrow batches where many distances are needed. A batch's list column is
  flattened and reshaped without a Python object per vector.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Distances held at once in a task (a block of rows times a block of centers).
BLOCK_DISTANCES = 1 << 20
#: Coordinates of one broadcast block of centers (8 MB).
BLOCK_COORDS = 1 << 20


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sq_distance(a, b) -> Column:
    """Squared Euclidean distance between two equal-length double arrays."""
    diffs = F.zip_with(_col(a), _col(b), lambda p, q: (p - q) * (p - q))
    return F.aggregate(diffs, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def euclidean(a, b) -> Column:
    """Euclidean distance ``sqrt(sum((a_i - b_i)^2))``."""
    return F.sqrt(sq_distance(a, b))


def parse_vector(text) -> Column:
    """Comma-separated coordinates -> ``array<double>``.

    Trailing commas are dropped first (a plain line split ignores trailing empty
    fields); any other empty or malformed coordinate becomes null.
    """
    trimmed = F.regexp_replace(_col(text), ",+$", "")
    return F.transform(F.split(trimmed, ","), lambda t: F.trim(t).try_cast("double"))


def malformed(x) -> Column:
    """True for a null vector and for one with a null or NaN coordinate."""
    x = _col(x)
    return x.isNull() | F.coalesce(F.exists(x, lambda v: v.isNull() | F.isnan(v)), F.lit(False))


def check_vectors(points: DataFrame, what: str = "points", dim: int | None = None) -> int | None:
    """The common dimension of ``points`` (point_id, x), or ValueError: one aggregate of built-ins.

    None for no rows. ``dim`` is the dimension that the other side has.
    """
    row = points.agg(F.count_if(malformed("x") | F.col("point_id").isNull()).alias("bad"), F.min(F.size("x")).alias("lo"),
                     F.max(F.size("x")).alias("hi")).first()
    if row["bad"]:
        raise ValueError(f"{row['bad']} of the {what} have a missing id or a missing or malformed coordinate")
    if row["lo"] != row["hi"]:
        raise ValueError(f"{what} have mixed dimensions ({row['lo']} to {row['hi']})")
    if dim is not None and row["lo"] not in (None, dim):
        raise ValueError(f"{what} have dimension {row['lo']}, not {dim}")
    return row["lo"]


def matrix(col: pa.Array) -> np.ndarray:
    """A list column of equally long vectors without nulls as a (rows, dimension) array."""
    if len(col) == 0:
        return np.empty((0, 0))
    values = col.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return values.reshape(len(col), -1)


def vectors(block: np.ndarray) -> pa.Array:
    """The list column of a (rows, dimension) array."""
    offsets = np.arange(len(block) + 1, dtype=np.int32) * (block.shape[1] if len(block) else 0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(block).reshape(-1)))


def block_distances(a, b):
    """NumPy distance block ``(len(a), len(b))`` between two stacks of vectors.

    Squares are accumulated coordinate by coordinate from zero -- the same order as
    ``euclidean`` -- so a threshold test gives the same answer here and in SQL.
    Used inside Arrow tasks only; Spark partitions the work.
    """
    return np.sqrt(square_distances(a, b))


def square_distances(a, b):
    """The squares that ``block_distances`` takes the roots of."""
    if a.shape[0] and b.shape[0] and a.shape[1] != b.shape[1]:
        raise ValueError(f"vectors of dimension {a.shape[1]} and {b.shape[1]}")
    acc = np.zeros((a.shape[0], b.shape[0]))
    for d in range(a.shape[1]):
        diff = a[:, d, None] - b[None, :, d]
        acc += diff * diff
    return acc


def pair_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of row pairs, summed in the order of ``block_distances``."""
    acc = np.zeros(len(a))
    for d in range(a.shape[1]):
        diff = a[:, d] - b[:, d]
        acc += diff * diff
    return np.sqrt(acc)


def squares(a: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, a)


class Nearness:
    """Exact threshold tests on the distances of two stacks of vectors. Squared distances come from one
    matrix product with a bound on their error; only pairs within the error are computed
    coordinate by coordinate, so every answer is that of ``block_distances``."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b = a, b
        with np.errstate(over="ignore", invalid="ignore"):
            a2, b2 = squares(a), squares(b)
            self.approx = a2[:, None] + b2[None, :] - 2 * (a @ b.T)
            scale = (a2.max() if len(a) else 0.0) + (b2.max() if len(b) else 0.0)
        self.error = (a.shape[1] + 16) * 1e-15 * scale
        self.sure = bool(np.isfinite(self.error))
        self._exact: np.ndarray | None = None

    def exact(self) -> np.ndarray:
        if self._exact is None:
            self._exact = block_distances(self.a, self.b)
        return self._exact

    def within(self, radius: float) -> np.ndarray:
        """block_distances(a, b) <= radius"""
        square = radius * radius
        if not self.sure or not np.isfinite(square):
            return self.exact() <= radius
        margin = self.error + (self.a.shape[1] + 16) * 1e-15 * square
        inside = self.approx <= square + margin
        i, j = np.nonzero(inside & (self.approx >= square - margin))
        if 4 * len(i) > inside.size:
            return self.exact() <= radius
        inside[i, j] = pair_distances(self.a[i], self.b[j]) <= radius
        return inside

    def least(self, least: float, positive: float, apart: bool = False) -> tuple[float, float]:
        """The least and least positive distance, given those known so far. ``apart``: only of
        pairs (i, j) with i < j."""
        if not self.approx.size:
            return least, positive
        if not self.sure:
            d = self.exact()[np.triu_indices(len(self.a), 1)] if apart else self.exact().ravel()
            return min(least, d.min(initial=np.inf)), min(positive, np.where(d > 0, d, np.inf).min(initial=np.inf))
        bound = positive * positive if positive < 1e150 else np.inf
        i, j = np.nonzero(self.approx <= bound * (1 + 1e-12) + 2 * self.error)
        if apart:
            i, j = i[i < j], j[i < j]
        order = np.argsort(self.approx[i, j], kind="stable")
        for at in range(0, len(order), BLOCK_DISTANCES >> 4):
            some = order[at:at + (BLOCK_DISTANCES >> 4)]
            if self.approx[i[some[0]], j[some[0]]] > positive * positive * (1 + 1e-12) + 2 * self.error:
                break
            d = pair_distances(self.a[i[some]], self.b[j[some]])
            least = min(least, d.min())
            positive = min(positive, np.where(d > 0, d, np.inf).min())
        return least, positive


def nearest_rows(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of and distance to the closest center (the first of equals) of each row."""
    pos, dist = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
    step = max(1, BLOCK_DISTANCES // max(1, len(centers)))
    for i in range(0, len(x), step):
        block = block_distances(x[i:i + step], centers)
        pos[i:i + step] = block.argmin(axis=1)
        dist[i:i + step] = block[np.arange(len(block)), pos[i:i + step]]
    return pos, dist


def center_blocks(centers: DataFrame, order_col: str) -> list:
    """The centers in ``order_col`` order as broadcast blocks of at most ``BLOCK_COORDS`` coordinates
    (or one center). The driver holds one block at a time, so any number of centers can be used."""
    sc, out, rows, first = centers.sparkSession.sparkContext, [], [], 0
    for r in centers.select(order_col, "x").orderBy(order_col).toLocalIterator():
        if rows and (len(rows) + 1) * len(r["x"]) > BLOCK_COORDS:
            out.append(sc.broadcast((first, np.asarray(rows, dtype=float))))
            first, rows = first + len(rows), []
        rows.append(r["x"])
    if rows:
        out.append(sc.broadcast((first, np.asarray(rows, dtype=float))))
    return out


class Balls:
    """Centers grouped around pivots, so that most groups are passed over without a distance: a point
    whose distance to a pivot exceeds the group's radius by more than its best distance so far has no closer center
    there. ``computed`` counts distances."""

    def __init__(self, centers: np.ndarray, first: int = 0):
        k = len(centers)
        self.computed, self.groups = 0, []
        pivots = centers[np.linspace(0, k - 1, max(1, math.isqrt(k))).astype(int)] if k else centers
        at, d = nearest_rows(centers, pivots)
        self.pivots, radius = [], []
        for g in np.unique(at):
            rows = np.flatnonzero(at == g)  # ascending, so the first of equals is the lowest position
            self.groups.append((rows + first, centers[rows]))
            self.pivots.append(pivots[g])
            radius.append(d[rows].max())
        self.pivots, self.radius = np.array(self.pivots), np.array(radius)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``nearest_rows``: position of and distance to the closest center (the first of equals)."""
        pos, dist = np.full(len(x), -1, np.int64), np.full(len(x), np.inf)
        step = max(1, BLOCK_DISTANCES // max(1, len(self.groups)))
        for i in range(0, len(x), step):
            self._nearest(x[i:i + step], pos[i:i + step], dist[i:i + step])
        return pos, dist

    def _nearest(self, x: np.ndarray, pos: np.ndarray, dist: np.ndarray) -> None:
        to = block_distances(x, self.pivots)
        self.computed += to.size
        home = to.argmin(axis=1)
        at_least = to - self.radius - 1e-9 * (to + self.radius)  # rounding
        at_least[~np.isfinite(at_least)] = -np.inf
        for own in (True, False):  # the group of the closest pivot first: it sets a low best distance
            for g, (numbers, centers) in enumerate(self.groups):
                rows = np.flatnonzero(home == g if own else (home != g) & (at_least[:, g] <= dist))
                if not len(rows):
                    continue
                p, d = nearest_rows(x[rows], centers)
                self.computed += len(rows) * len(centers)
                closer = (d < dist[rows]) | ((d == dist[rows]) & ((numbers[p] < pos[rows]) | (pos[rows] < 0)))
                pos[rows[closer]], dist[rows[closer]] = numbers[p[closer]], d[closer]


def nearest_udf(blocks):
    """Arrow-batched UDF ``x -> struct(pos int, d double)`` against the centers of ``blocks``
    (broadcasts of (first position, matrix), or such pairs).

    ``pos`` is the first closest center (lowest position on ties). Distances are bit-identical
    to ``euclidean``. The x's must have the centers' dimension and no nulls (``check_vectors``). A task reads and groups a
    block of centers once if there is one, else once for every ``4 * BLOCK_COORDS`` coordinates of points; it holds one block at a time.
    """

    @arrow_udf("struct<pos:int,d:double>")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        only = None

        def grouped(block):
            nonlocal only
            if only is not None:
                return only
            first, centers = block if isinstance(block, tuple) else block.value
            if not isinstance(block, tuple):
                vars(block).pop("_value", None)
            balls = Balls(centers, first)
            if len(blocks) == 1:
                only = balls
            return balls

        def answered(held):
            x = np.concatenate([matrix(b) for b in held if len(b)]) if any(len(b) for b in held) else np.empty((0, 0))
            pos, dist = np.full(len(x), -1), np.full(len(x), np.inf)
            for block in blocks if len(x) else ():
                p, d = grouped(block).nearest(x)
                closer = (d < dist) | (pos < 0)
                pos, dist = np.where(closer, p, pos), np.where(closer, d, dist)
            return pa.StructArray.from_arrays([pa.array(pos.astype(np.int32)), pa.array(dist)], ["pos", "d"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.flatten())
            if size >= (4 * BLOCK_COORDS if len(blocks) > 1 else 1):
                yield answered(held)
                held, size = [], 0
        if held:
            yield answered(held)

    return nearest
