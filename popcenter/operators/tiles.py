"""Tiles: points packed near their neighbours, and the work units of tile pairs.

A weighted set ``(idx, x, w)`` is sorted by two coordinates (borders of the first by approximate
quantiles, the second within them), range-partitioned into ``strips`` and packed into rows of about ``TILE``
points with a center and a radius. By the triangle inequality these bound all distances between
two tiles: a pair of tiles may be skipped, or taken whole, without a distance being computed. Strips whose
points lie on few lines need no bounds: points are looked up on sorted lines, n log n for each line and guess.

Every unordered pair of strips is one work unit: the pairs of tiles between them, each looked at once for
both directions. A tile is copied to ``strips`` units, so the units hold ``strips`` times the set; the
number of strips follows from the number of tasks, and from the size of a strip (``STRIP_BYTES``, two
of which a task holds) only beyond ``strips * STRIP_BYTES`` of points. It does not grow with the number of tiles.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from popcenter.functions.vectors import block_distances, matrix, square_distances

TILE = 512
STRIP_BYTES = 64 << 20
#: Bytes of a point in a task beside its coordinates: ids, weights, and the sums of all guesses.
POINT_BYTES = 80
#: Points of a leaf, and the dimensions up to which tiles are looked at by leaves.
LEAF = 64
LEAF_DIMS = 8
#: Distances held at once between a leaf and others: they stay in the cache.
LEAF_DISTANCES = 1 << 16
#: Lines of a strip up to which it is looked at by lines, and coordinates above which it is not (their squares overflow).
MOST_LINES = 256
LINE_COORDS = 1e150
#: Points looked up on a line at once.
LINE_ROWS = 1 << 14
#: Coordinates whose spread is looked at to choose the two by which points are sorted.
SORT_DIMS = 8
MOST_RINGS = 2000

_TILE = "strip int, tile long, n int, ids binary, x binary, w binary, center binary, radius double"
_ARROW = pa.schema([("strip", pa.int32()), ("tile", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("x", pa.binary()),
                    ("w", pa.binary()), ("center", pa.binary()), ("radius", pa.float64())])


class Tile:
    """A tile in a task: its points (ids, x, w), center and radius."""

    def __init__(self, tile: int, ids: bytes, x: bytes, w: bytes, center: bytes, radius: float):
        self.tile, self.radius = tile, radius
        self.ids = np.frombuffer(ids, np.int64)
        self.x = np.frombuffer(x).reshape(len(self.ids), -1)
        self.w = np.frombuffer(w)
        self.center = np.frombuffer(center)[None, :]


def tiles_in(table: pa.Table) -> list[Tile]:
    cols = [table.column(c).to_pylist() for c in ("tile", "ids", "x", "w", "center", "radius")]
    return [Tile(*row) for row in sorted(zip(*cols), key=lambda r: r[0])]


def bounds(a: Tile, b: Tile) -> tuple[float, float]:
    """No point of ``a`` is nearer to a point of ``b`` than the first, or farther than the second."""
    d = float(block_distances(a.center, b.center)[0, 0])
    reach = a.radius + b.radius
    slack = 1e-9 * (d + reach)  # rounding
    return d - reach - slack, d + reach + slack


class Leaves:
    """The tiles of a strip in leaves of ``LEAF`` points (``_packer`` puts neighbours into one), with their centers and
    radii; a tile's last leaf is filled up with copies of weight 0. For one guess: weights and sums of its points."""

    def __init__(self, tiles: list[Tile], origin: np.ndarray):
        self.tiles = tiles
        self.center, self.radius = np.concatenate([t.center for t in tiles]), np.array([t.radius for t in tiles])
        size = np.array([-(-len(t.ids) // LEAF) for t in tiles])
        self.first = np.concatenate([[0], np.cumsum(size)])
        self.tile_of = np.repeat(np.arange(len(tiles)), size)
        filled = [np.pad(t.x, ((0, n * LEAF - len(t.ids)), (0, 0)), mode="edge") for t, n in zip(tiles, size)]
        self.x = np.concatenate(filled).reshape(len(self.tile_of), LEAF, -1)
        with np.errstate(over="ignore", invalid="ignore"):
            self.mid = self.x.mean(axis=1)
            off = self.x - self.mid[:, None, :]
            self.reach = np.sqrt((off * off).sum(axis=2).max(axis=1)) * (1 + 1e-12)
            # (x, x.x, 1) . (-2y, 1, y.y) is the squared distance but for rounding
            off = self.x - origin
            square, one = (off * off).sum(axis=2)[:, :, None], np.ones((*off.shape[:2], 1))
            self.left, self.right = np.concatenate([off, square, one], axis=2), np.concatenate([-2 * off, one, square], axis=2)
            self.scale = float(square.max())

    def weigh(self, weights: list[np.ndarray]) -> None:
        self.w = np.concatenate([np.pad(w, (0, -len(w) % LEAF)) for w in weights]).reshape(-1, LEAF)
        self.leaf_w = self.w.sum(axis=1)
        self.tile_w = np.array([w.sum() for w in weights])
        self.sums = np.zeros(self.w.shape)
        self.leaf_sums, self.tile_sums = np.zeros(len(self.w)), np.zeros(len(self.tiles))

    def totals(self) -> Iterator[tuple[int, np.ndarray]]:
        for k, t in enumerate(self.tiles):
            rows = slice(self.first[k], self.first[k + 1])
            yield t.tile, (self.sums[rows] + self.leaf_sums[rows, None]).reshape(-1)[:len(t.ids)] + self.tile_sums[k]


def _apart(a: np.ndarray, b: np.ndarray, reach: np.ndarray, ball: float) -> tuple[np.ndarray, np.ndarray]:
    """Which balls around the rows of ``a`` and ``b`` lie apart, and which within ``ball`` as a whole (see ``bounds``)."""
    d = block_distances(a, b)
    slack = 1e-9 * (d + reach)
    return d - reach - slack > ball, d + reach + slack <= ball


def square_limit(radius: float) -> float:
    """The largest double whose square root is at most ``radius``: a squared distance is within it exactly if the
    distance is within the radius."""
    if radius < 0 or radius == np.inf:
        return -1.0 if radius < 0 else radius
    s = min(radius * radius, sys.float_info.max)
    while math.sqrt(s) > radius:
        s = math.nextafter(s, 0.0)
    while (above := math.nextafter(s, math.inf)) < math.inf and math.sqrt(above) <= radius:
        s = above
    return s


def add_balls(a: Leaves, b: Leaves, ball: float) -> tuple[int, int, int]:
    """Adds to the sums of ``a`` the weight of ``b`` in the balls of its points, and the other way round (``b`` may
    be ``a``). The number of pairs of tiles, of those apart (or without weight) and of those taken as a whole."""
    limit, pairs, skipped, taken = square_limit(float(ball)), 0, 0, 0
    margin = (a.x.shape[2] + 16) * 1e-15 * (a.scale + b.scale + limit)
    if not 1000 * margin < limit:  # the product is too coarse for so small a ball, or overflows
        margin = None
    for i in range(len(a.tiles)):
        js = np.arange(i if a is b else 0, len(b.tiles))
        apart, inside = _apart(a.center[[i]], b.center[js], a.radius[i] + b.radius[js], ball)
        apart = apart[0] | ~((a.tile_w[i] > 0) | (b.tile_w[js] > 0))
        inside = inside[0] & ~apart
        pairs, skipped, taken = pairs + len(js), skipped + int(apart.sum()), taken + int(inside.sum())
        whole = js[inside]
        a.tile_sums[i] += b.tile_w[whole].sum()
        b.tile_sums[whole[whole != i] if a is b else whole] += a.tile_w[i]
        js = js[~apart & ~inside]
        if len(js):
            _add_leaves(a, i, b, js, ball, limit, margin)
    return pairs, skipped, taken


def _near(a: Leaves, r: int, b: Leaves, some: np.ndarray, limit: float, margin: float | None) -> np.ndarray:
    """block_distances(...) <= radius for the points of leaf ``r`` and of the leaves ``some``: by one matrix product,
    and coordinate by coordinate where its error leaves it open."""
    x, points = a.x[r], lambda: b.x[some].reshape(-1, a.x.shape[2])
    if margin is None:
        return square_distances(x, points()) <= limit
    product = a.left[r] @ b.right[some].reshape(-1, a.left.shape[2]).T
    near, maybe = product <= limit - margin, product <= limit + margin
    if np.count_nonzero(near) != np.count_nonzero(maybe):
        i, j = np.nonzero(near != maybe)
        diff = x[i] - points()[j]
        near[i, j] = sum(diff[:, k] * diff[:, k] for k in range(diff.shape[1])) <= limit
    return near


def _add_leaves(a: Leaves, i: int, b: Leaves, js: np.ndarray, ball: float, limit: float, margin: float | None) -> None:
    """``add_balls`` of tile ``i`` and the tiles ``js``."""
    rows, cols = np.arange(a.first[i], a.first[i + 1]), np.concatenate([np.arange(b.first[j], b.first[j + 1]) for j in js])
    back = (b.tile_of[cols] != i) if a is b else np.ones(len(cols), bool)  # a tile meets itself once, one way
    apart, inside = _apart(a.mid[rows], b.mid[cols], a.reach[rows, None] + b.reach[cols], ball)
    apart |= ~((b.leaf_w[cols] > 0) | ((a.leaf_w[rows, None] > 0) & back))
    inside &= ~apart
    a.leaf_sums[rows] += inside @ b.leaf_w[cols]
    b.leaf_sums[cols] += (a.leaf_w[rows] @ inside) * back
    step = max(1, LEAF_DISTANCES // LEAF ** 2)
    for r, open_ in zip(rows, ~apart & ~inside):
        met, forth = cols[open_], back[open_]
        for at in range(0, len(met), step):
            some = met[at:at + step]
            weight = b.leaf_w[some].sum()
            # whole weights: exact below 2^24, or below 2^53
            kind = np.float32 if max(weight, a.leaf_w[r]) < 1 << 24 else np.float64
            near = _near(a, r, b, some, limit, margin).astype(kind)
            if weight:
                a.sums[r] += near @ b.w[some].ravel().astype(kind)
            if a.leaf_w[r]:
                b.sums[some] += (a.w[r].astype(kind) @ near).reshape(-1, LEAF) * forth[at:at + step, None]


class Lines:
    """The tiles of a strip in lines along ``axis``: points that agree in all other coordinates, sorted by this one. Points
    that agree in all are one site. For one guess: weights and sums of its points."""

    def __init__(self, tiles: list[Tile], axis: int):
        self.tiles, self.axis = tiles, axis
        x = np.concatenate([t.x for t in tiles])
        others = [k for k in range(x.shape[1]) if k != axis]
        order = np.lexsort((x[:, axis], *(x[:, k] for k in others)))
        x = x[order]
        turn = np.ones(len(x), bool)  # a line's first point
        turn[1:] = (x[1:, others] != x[:-1, others]).any(axis=1)
        new = turn.copy()  # a site's first point
        new[1:] |= x[1:, axis] != x[:-1, axis]
        self.site = np.empty(len(x), np.int64)
        self.site[order] = np.cumsum(new) - 1
        self.at = x[new, axis]
        self.fixed = x[turn]
        self.start = np.append(np.flatnonzero(turn[new]), len(self.at))
        self.size = np.diff(self.start)
        self.low, self.high = self.at[self.start[:-1]], self.at[self.start[1:] - 1]

    def weigh(self, weights: list[np.ndarray]) -> None:
        self.upto = np.append(0.0, np.cumsum(np.bincount(self.site, np.concatenate(weights), len(self.at))))
        self.sums, self.line_sums = np.zeros(len(self.at)), np.zeros(len(self.size))

    def totals(self) -> Iterator[tuple[int, np.ndarray]]:
        sums, first = (self.sums + np.repeat(self.line_sums, self.size))[self.site], 0
        for t in self.tiles:
            yield t.tile, sums[first:first + len(t.ids)]
            first += len(t.ids)


def lines_of(own: list[Tile], other: list[Tile]) -> tuple[Lines, Lines] | None:
    """The lines of two strips (of one, if ``other`` is empty) along the coordinate with the most values; None, if there
    are too many lines for their points."""
    x = np.concatenate([t.x for t in own + other])
    if not x.shape[1] or not (np.abs(x) < LINE_COORDS).all():
        return None
    values = [len(np.unique(x[:, k])) for k in range(x.shape[1])]
    axis, x = int(np.argmax(values)), None
    if any(n > MOST_LINES for k, n in enumerate(values) if k != axis):
        return None
    a = Lines(own, axis)
    b = Lines(other, axis) if other else a
    return (a, b) if all(len(s.size) <= MOST_LINES and len(s.size) ** 2 <= len(s.site) for s in (a, b)) else None


def _line_reach(a: Lines, b: Lines, limit: float) -> np.ndarray:
    """For each line of ``a`` and of ``b`` the largest double ``t`` such that two of their points that differ by ``t`` along
    the lines are within the limit of squared distances, summed as ``square_distances`` does; -1, if there is none."""
    fixed = [(a.fixed[:, None, k] - b.fixed[None, :, k]) ** 2 for k in range(a.fixed.shape[1])]

    def within(t: np.ndarray) -> np.ndarray:
        return sum(t * t if k == a.axis else square for k, square in enumerate(fixed)) <= limit

    # doubles from 0 on are ordered as their bits are
    shape = (len(a.size), len(b.size))
    low, high = np.zeros(shape, np.int64), np.full(shape, np.float64(np.inf).view(np.int64))
    with np.errstate(over="ignore"):
        while (high - low > 1).any():
            mid = low + (high - low) // 2
            inside = within(mid.view(float))
            low, high = np.where(inside, mid, low), np.where(inside, high, mid)
        return np.where(within(np.zeros(shape)), low.view(float), -1.0)


def _cut(line: np.ndarray, at: np.ndarray, before) -> np.ndarray:
    """For each row the place in ``line`` where ``before(values, rows)`` turns false; it is true at the first and false at
    the last place. ``at`` has guesses."""
    at = np.clip(at, 1, len(line) - 1)
    wrong = np.flatnonzero(~before(line[at - 1], slice(None)) | before(line[at], slice(None)))
    low, high = np.zeros(len(wrong), np.int64), np.full(len(wrong), len(line) - 1)
    while (high - low > 1).any():
        mid = (low + high) // 2
        yes = before(line[mid], wrong)
        low, high = np.where(yes, mid, low), np.where(yes, high, mid)
    at[wrong] = high
    return at


def _add_lines(a: Lines, b: Lines, reach: np.ndarray) -> None:
    """Adds to the sums of ``a`` the weight of ``b`` in the balls of its points: on a line the points in a ball are
    consecutive, as differences of doubles are in order."""
    apart = (reach < 0) | (a.low[:, None] - b.high > reach) | (b.low - a.high[:, None] > reach)
    inside = ~apart & (a.high[:, None] - b.low <= reach) & (b.high - a.low[:, None] <= reach)
    a.line_sums += inside @ (b.upto[b.start[1:]] - b.upto[b.start[:-1]])
    for k, open_ in enumerate((~apart & ~inside).T):
        first, end = b.start[k], b.start[k + 1]
        if not open_.any() or b.upto[first] == b.upto[end]:
            continue
        rows, line = np.flatnonzero(np.repeat(open_, a.size)), b.at[first:end]
        t = np.repeat(reach[open_, k], a.size[open_])
        for at in range(0, len(rows), LINE_ROWS):
            some = rows[at:at + LINE_ROWS]
            low, high = _on_line(a.at[some], t[at:at + LINE_ROWS], line)
            a.sums[some] += b.upto[first + high] - b.upto[first + low]


def _on_line(y: np.ndarray, t: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the first place of ``line`` that is at most ``t`` from ``y``, and the first one after it that is not."""
    low = np.where(y - line[0] > t, len(line), 0)
    some = np.flatnonzero((low > 0) & (y - line[-1] <= t))
    if len(some):
        y_, t_ = y[some], t[some]
        low[some] = _cut(line, np.searchsorted(line, y_ - t_), lambda v, r: y_[r] - v > t_[r])
    high = np.where(line[-1] - y > t, 0, len(line))
    some = np.flatnonzero((high == 0) & (line[0] - y <= t))
    if len(some):
        above, reach = y[some], t[some]
        high[some] = _cut(line, np.searchsorted(line, above + reach, "right"), lambda v, r: v - above[r] <= reach[r])
    return low, high


def add_lines(a: Lines, b: Lines, ball: float) -> None:
    """As ``add_balls``, by lines: no distance is computed, each point is looked for on each line."""
    reach = _line_reach(a, b, square_limit(float(ball)))
    if b.upto[-1]:
        _add_lines(a, b, reach)
    if a is not b and a.upto[-1]:
        _add_lines(b, a, reach.T)


def _by_neighbours(x: np.ndarray) -> np.ndarray:
    """An order in which each ``LEAF`` points are neighbours: halved along the widest dimension again and again."""
    def order(rows: np.ndarray) -> list[np.ndarray]:
        if len(rows) <= LEAF:
            return [rows]
        rows = rows[np.argsort(x[rows, (x[rows].max(axis=0) - x[rows].min(axis=0)).argmax()], kind="stable")]
        half = LEAF * -(-len(rows) // (2 * LEAF))
        return order(rows[:half]) + order(rows[half:])

    return np.concatenate(order(np.arange(len(x))))


def _packer(tile: int):
    """For mapInArrow over the sorted rows (strip, idx, x, w) of one strip."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, k = [], 0, 0

        def out(strip, ids, x, w):
            if 0 < x.shape[1] <= LEAF_DIMS:
                at = _by_neighbours(x)
                ids, x, w = ids[at], x[at], w[at]
            center = x.mean(axis=0)
            radius = float(block_distances(x, center[None, :]).max())
            row = (strip, (strip << 32) + k, len(ids), ids.tobytes(), np.ascontiguousarray(x).tobytes(),
                   w.astype(float).tobytes(), center.tobytes(), radius)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.column(1).to_numpy(), matrix(batch.column(2)), batch.column(3).to_numpy()))
            strip, size = batch.column(0)[0].as_py(), size + batch.num_rows
            while size >= tile:
                ids, x, w = (np.concatenate(c) for c in zip(*held))
                yield out(strip, ids[:tile], x[:tile], w[:tile])
                k, size, held = k + 1, size - tile, [(ids[tile:], x[tile:], w[tile:])]
        if size:
            yield out(strip, *(np.concatenate(c) for c in zip(*held)))

    return pack


def strip_count(n: int, dim: int, tasks: int, tile: int = TILE) -> int:
    """Enough strips for the tasks to have a few units each, if there is work for them, and for a
    strip to fit ``STRIP_BYTES``."""
    wanted = min(math.ceil(math.sqrt((16 if dim <= LEAF_DIMS else 4) * tasks)), -(-n // (2 * tile)))
    return max(1, wanted, -(-n * (8 * dim + POINT_BYTES) // STRIP_BYTES))


def _ring(borders: np.ndarray):
    @arrow_udf("int")
    def ring(values: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(borders, values.to_numpy(zero_copy_only=False), "right").astype(np.int32))

    return ring


def _sort_keys(points: DataFrame, n: int, dim: int, tile: int) -> list:
    """What neighbours are sorted by: rings of the coordinate with the largest spread, then the one with
    the second largest, as many rings as make tiles about as wide as high. One tile needs no order but idx."""
    if n <= tile or not dim:
        return [F.col("idx")]
    parts = [F.get("x", F.lit(i)) for i in range(min(dim, SORT_DIMS))]
    if dim == 1:
        return [parts[0], F.col("idx")]
    row = points.agg(*[(F.max(p) - F.min(p)).alias(f"s{i}") for i, p in enumerate(parts)]).first()
    spread, at = zip(*sorted(((row[i], i) for i in range(len(parts))), key=lambda s: -s[0])[:2])
    first, second, tiles = parts[at[0]], parts[at[1]], -(-n // tile)
    flat = dim == 2 and 0 < spread[0] < math.inf
    if flat and spread[0] >= tiles * spread[1]:
        return [first, F.col("idx")]
    rings = min(MOST_RINGS, math.ceil(math.sqrt(tiles * (spread[0] / spread[1] if flat else 1))))
    if rings == 1:
        return [first, F.col("idx")]
    shares = F.array(*[F.lit(i / rings) for i in range(1, rings)])
    borders = points.agg(F.percentile_approx(first, shares, F.lit(max(1000, 20 * rings)))).first()[0]
    return [_ring(np.array(borders))(first), second, F.col("idx")]


def pack_tiles(points: DataFrame, n: int, dim: int, strips: int, tile: int = TILE) -> DataFrame:
    """The tiles of ``(idx, x, w)``, ``n`` points of ``dim`` dimensions."""
    keys = _sort_keys(points, n, dim, tile)
    named = points.select("idx", "x", F.col("w").cast("long").alias("w"), *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    by = [f"_k{i}" for i in range(len(keys))]
    laid = named.repartition(1) if strips == 1 else named.repartitionByRange(strips, *by)
    return laid.sortWithinPartitions(*by).select(F.spark_partition_id().alias("strip"), "idx", "x", "w").mapInArrow(
        _packer(tile), _TILE)


def work_units(tiles: DataFrame, strips: int) -> DataFrame:
    """Each tile once for every unit of its strip: ``unit`` = (lower strip, higher strip), ``held``: the
    tile is of the lower one. Partitioned by unit, which is what a task works on."""
    other = F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("other")
    copies = tiles.select(other, "*")
    low, high = F.least("strip", "other"), F.greatest("strip", "other")
    units = strips * (strips + 1) // 2
    return copies.select((low * strips + high).alias("unit"), (F.col("strip") == low).alias("held"), "tile", "n", "ids", "x", "w",
                         "center", "radius").repartition(units, "unit")
