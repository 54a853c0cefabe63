"""Round 2: weighted greedy k-center with z outliers (the 3-approximation of Charikar et al.).

For a radius guess r: repeat at most k times while uncovered weight remains -- pick the
point whose ball of radius ``(1+2*alpha)*r`` holds the most uncovered weight (every point
is a candidate, covered ones too; ties: the lowest order index), then mark every
uncovered point within ``(3+4*alpha)*r`` of it as covered. The guess is accepted when the
uncovered weight is at most z; otherwise r doubles.

Spark form. Guesses share no state, so all of them run side by side (a guess index ``g``). The
weighted set, of any size, is packed once into tiles of neighbouring points (``tiles``); pairs of strips
of tiles are the work units. Tiles and units are laid out once and cached, partitioned by tile and
by unit, and no vector moves after that. What changes is the cover state, a bitmap per tile and guess, and the
balls' weights, whole numbers in as few bytes as hold them.
A greedy step is two jobs:

1. a unit adds up, for each pair of its tiles and each guess, the uncovered weight of one tile in the balls of the
   other's points, both ways. Pairs that lie apart, and pairs that lie within the ball as a whole, are settled by the
   tiles' bounds without distances; in few dimensions the pairs left open are settled in the same way by leaves of
   ``LEAF`` points. Where a strip's points lie on few lines (``Lines``: one dimension, or all coordinates but one of few values)
   no distance is computed: a ball holds consecutive points of a line. The partial sums of a tile, one row per
   unit and guess, are added up where the tile lies; its best candidate (largest weight, then lowest idx)
   goes on with its vector, and the best of each guess is one row for the driver. The sums stay with the tile: after the
   first step only the weight that became covered is looked at, and taken off the balls it lies in. A point becomes
   covered once, so all steps after the first cost at most as much as the first one;
2. each tile's bitmap is updated by the newest center of each guess (a tile that lies outside of the
   cover radius, or inside as a whole, is decided by its center and radius), and the uncovered weights
   are added up: guesses that are finished, or too large to matter, go no further. The bitmaps of what became covered, an
   eighth of a byte per point and guess, go to the units of their tile.

Each distance between a point and a center is computed once a guess. The driver keeps the chosen centers (k per guess) and nothing that grows
with the set. It stops a guess once it is finished and drops every guess above the smallest
one already certain to be accepted (uncovered weight only decreases). The accepted guess is the smallest with
uncovered weight <= z, exactly as in the sequential loop. The guesses are fixed in advance:
enough doublings that the last one covers everything with one center (the diameter is bounded
by twice the largest distance from the first point). Pairs of tiles are quadratic in the set, as the
algorithm is, where bounds do not settle them; ``max_points`` is an optional guard, off by default.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcenter.functions.vectors import Nearness, block_distances, malformed, nearest_udf
from popcenter.operators.selection import kth_value
from popcenter.operators.tiles import (LEAF_DIMS, TILE, Leaves, Tile, add_balls, add_lines, bounds, lines_of, pack_tiles,
                                       strip_count, tiles_in, work_units)
from popcenter.session import checkpoint

#: Steps after which the lineage of the bitmaps is cut: the plan of a step grows with the steps before it.
CUT_STEPS = 2


def _check_params(k: int, z: int, alpha: float) -> None:
    if k < 1:
        raise ValueError(f"k must be >= 1, got {k}")
    if z < 0:
        raise ValueError(f"z must be >= 0, got {z}")
    if alpha < 0:
        raise ValueError(f"alpha must be >= 0, got {alpha}")


def _tasks(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


# ---------------------------------------------------------------- cover state

def _pack(covered: np.ndarray) -> bytes:
    return np.packbits(covered, axis=1).tobytes()


def _unpack(bits: bytes | None, guesses: int, n: int) -> np.ndarray:
    if bits is None:
        return np.zeros((guesses, n), bool)
    return np.unpackbits(np.frombuffer(bits, np.uint8).reshape(guesses, -1), axis=1, count=n).astype(bool)


def _bits_in(state: pa.Table) -> dict[int, bytes]:
    """The bitmaps by tile; the empty side of a cogroup has no columns."""
    return dict(zip(state.column("tile").to_pylist(), state.column("bits").to_pylist())) if state.num_rows else {}


def _covering(guesses: int, newest: dict[int, tuple[np.ndarray, float]]):
    """For a cogroup of tiles and their bitmaps: ``newest[g] = (center, cover radius)`` applied."""
    def run(key, tiles: pa.Table, old: pa.Table) -> pa.Table:
        out = []
        held = _bits_in(old)
        strip = dict(zip(tiles.column("tile").to_pylist(), tiles.column("strip").to_pylist()))
        for t in tiles_in(tiles):
            covered, computed = _unpack(held.get(t.tile), guesses, len(t.ids)), 0
            before = covered.copy()
            for g, (center, cover) in newest.items():
                d = float(block_distances(t.center, center[None, :])[0, 0])
                slack = 1e-9 * (d + t.radius)
                if d - t.radius - slack > cover:
                    continue
                if d + t.radius + slack <= cover:
                    covered[g] = True
                else:
                    covered[g] |= block_distances(t.x, center[None, :])[:, 0] <= cover
                    computed += len(t.ids)
            fresh = covered & ~before
            out.append((strip[t.tile], t.tile, _pack(covered), _pack(fresh) if fresh.any() else None, (~covered @ t.w).tolist(), computed))
        return pa.table([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_BITS)], schema=_BITS)

    return run


_BITS = pa.schema([("strip", pa.int32()), ("tile", pa.int64()), ("bits", pa.binary()), ("fresh", pa.binary()),
                   ("left", pa.list_(pa.float64())), ("computed", pa.int64())])


def cover(tiles: DataFrame, bits: DataFrame | None, guesses: int, newest: dict) -> DataFrame:
    """The bitmaps (strip, tile, bits, fresh, left, computed) after the newest centers; ``fresh`` has the points that
    only these cover (null: none), ``left`` is each guess's uncovered weight in the tile, ``computed`` counts distances."""
    old = tiles.select("tile", F.lit(None).cast("binary").alias("bits")).limit(0) if bits is None else bits.select("tile", "bits")
    return tiles.groupBy("tile").cogroup(old.groupBy("tile")).applyInArrow(
        _covering(guesses, newest), "strip int, tile long, bits binary, fresh binary, left array<double>, computed long")


def uncovered(bits: DataFrame) -> dict[int, int]:
    """Uncovered weight by guess."""
    left = bits.select(F.posexplode("left").alias("g", "w")).groupBy("g").agg(F.sum("w").alias("w"))
    return {r["g"]: int(r["w"]) for r in left.collect()}  # a row a guess


# ---------------------------------------------------------------- ball weights

_PARTIAL = pa.schema([("tile", pa.int64()), ("g", pa.int32()), ("sign", pa.int32()), ("base", pa.float64()), ("sums", pa.binary()),
                      ("pairs", pa.int64()), ("skipped", pa.int64()), ("taken", pa.int64())])


def _shrunk(sums: np.ndarray) -> tuple[float, bytes]:
    """Whole numbers as their least and what is above it, in as few bytes as hold it (none, if all are equal)."""
    base = sums.min()
    above = sums - base
    most = above.max()
    kind = next((k for k in (np.uint8, np.uint16, np.uint32) if most <= np.iinfo(k).max), np.float64)
    return float(base), above.astype(kind).tobytes() if most else b""


def _grown(base: float, above: bytes, n: int) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.float64}.get(len(above) // n)
    return base + (np.frombuffer(above, kind).astype(float) if kind else np.zeros(n))


def _by_tiles(own: list[Tile], other: list[Tile], weight, balls: dict[int, float]):
    """(tile, g, sums, pairs, skipped, taken): distances of a pair of tiles at once, for all guesses."""
    both = own + other
    weights = {t.tile: {g: weight(t, g) for g in balls} for t in both}
    some = {t: [w.any() for w in by.values()] for t, by in weights.items()}
    sums = {t.tile: {g: np.zeros(len(t.ids)) for g in balls} for t in both}
    pairs = skipped = taken = 0
    # within one strip each tile meets itself and those behind it, else all of the other strip
    meets = [(a, b) for a in own for b in other] if other else [(a, b) for i, a in enumerate(own) for b in own[i:]]
    for a, b in meets:
        low, high = bounds(a, b)
        near = None
        for (g, ball), has_a, has_b in zip(balls.items(), some[a.tile], some[b.tile]):
            wa, wb = weights[a.tile][g], weights[b.tile][g]
            pairs += 1
            if low > ball or not (has_a or has_b):
                skipped += 1
            elif high <= ball:
                taken += 1
                sums[a.tile][g] += wb.sum()
                if a is not b:
                    sums[b.tile][g] += wa.sum()
            else:
                near = near or Nearness(a.x, b.x)
                inside = near.within(ball).astype(float)  # whole weights: exact below 2^53
                if has_b:
                    sums[a.tile][g] += inside @ wb
                if has_a and a is not b:
                    sums[b.tile][g] += wa @ inside
    for t in both:
        for g in balls:
            yield t.tile, g, sums[t.tile][g], pairs, skipped, taken
            pairs = skipped = taken = 0


def _by_leaves(own: list[Tile], other: list[Tile], weight, balls: dict[int, float]):
    """As ``_by_tiles``, in few dimensions: pairs of tiles that bounds leave open are looked at by leaves. A guess
    at a time, so a task holds the weights and sums of one."""
    origin = own[0].x[0]
    a = Leaves(own, origin)
    b = Leaves(other, origin) if other else a
    for g, ball in balls.items():
        for side in {id(s): s for s in (a, b)}.values():
            side.weigh([weight(t, g) for t in side.tiles])
        pairs, skipped, taken = add_balls(a, b, ball) if a.tile_w.any() or b.tile_w.any() else (0, 0, 0)
        for side in {id(s): s for s in (a, b)}.values():
            for tile, sums in side.totals():
                yield tile, g, sums, pairs, skipped, taken
                pairs = skipped = taken = 0


def _by_lines(a, b, weight, balls: dict[int, float]):
    """As ``_by_tiles``, for strips of few lines (``lines_of``). All pairs of tiles count as taken, without distances."""
    sides = [a] if a is b else [a, b]
    met = len(a.tiles) * (len(a.tiles) + 1) // 2 if a is b else len(a.tiles) * len(b.tiles)
    for g, ball in balls.items():
        for side in sides:
            side.weigh([weight(t, g) for t in side.tiles])
        pairs = met if a.upto[-1] or b.upto[-1] else 0
        if pairs:
            add_lines(a, b, ball)
        for side in sides:
            for tile, sums in side.totals():
                yield tile, g, sums, pairs, 0, pairs
                pairs = 0


def _partial_sums(guesses: int, balls: dict[int, float], fresh: bool):
    """For a cogroup of a unit's tiles and bitmaps: per tile and guess the uncovered weight (``fresh``: the newly
    covered one, to be taken off) in the balls of the tile's points, of the points of this unit. ``balls[g]`` is the
    ball radius. Counts pairs of tiles and guesses, and those that the bounds settled."""
    def run(key, tiles: pa.Table, state: pa.Table) -> pa.Table:
        bits = _bits_in(state)
        if fresh and not bits:
            return _PARTIAL.empty_table()
        held = {t for t, h in zip(tiles.column("tile").to_pylist(), tiles.column("held").to_pylist()) if h}
        both = tiles_in(tiles)
        own, other = [t for t in both if t.tile in held], [t for t in both if t.tile not in held]

        def weight(t: Tile, g: int) -> np.ndarray:
            if t.tile not in bits:
                return t.w * (not fresh)
            row = np.frombuffer(bits[t.tile], np.uint8).reshape(guesses, -1)[g]
            return t.w * (np.unpackbits(row, count=len(t.ids)) == fresh)

        low = own[0].x.shape[1] <= LEAF_DIMS
        if low and (lines := lines_of(own, other)):
            found = _by_lines(*lines, weight, balls)
        else:
            found = (_by_leaves if low else _by_tiles)(own, other, weight, balls)
        out = [(tile, g, -1 if fresh else 1, *_shrunk(sums), *counts) for tile, g, sums, *counts in found if any(counts) or sums.any()]
        return pa.table([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_PARTIAL)], schema=_PARTIAL)

    return run


_BEST = ("g int, idx long, val double, x array<double>, tile long, sign int, base double, sums binary, "
         "pairs long, skipped long, taken long")
_BEST_ARROW = pa.schema([("g", pa.int32()), ("idx", pa.int64()), ("val", pa.float64()), ("x", pa.list_(pa.float64())), *[
    _PARTIAL.field(c) for c in ("tile", "sign", "base", "sums", "pairs", "skipped", "taken")]])


def _tile_sums(balls: dict[int, float], all_candidates: bool):
    """For a cogroup of a tile and its partial sums (and totals so far): per guess the totals and the best candidate,
    or all candidates."""
    def run(key, tiles: pa.Table, partial: pa.Table) -> pa.Table:
        out = []
        rows: dict[tuple, list] = {}
        if partial.num_rows:
            for tile, g, *rest in zip(*(partial.column(c).to_pylist() for c in _PARTIAL.names)):
                rows.setdefault((tile, g), []).append(rest)
        for t in tiles_in(tiles):
            for g in balls:
                sums, counts = np.zeros(len(t.ids)), [0, 0, 0]
                for sign, base, above, *more in rows.get((t.tile, g), ()):
                    sums += sign * _grown(base, above, len(t.ids))
                    counts = [a + b for a, b in zip(counts, more)]
                kept = (t.tile, 1, *_shrunk(sums), *counts)
                if all_candidates:
                    out += [(g, int(i), float(v), None, t.tile, None, None, None, 0, 0, 0) for i, v in zip(t.ids, sums)]
                elif sums.max() > 0:
                    at = np.flatnonzero(sums == sums.max())
                    best = at[t.ids[at].argmin()]
                    out.append((g, int(t.ids[best]), float(sums[best]), t.x[best].tolist(), *kept))
                else:
                    out.append((g, None, 0.0, None, *kept))
        return pa.table([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_BEST_ARROW)], schema=_BEST_ARROW)

    return run


@dataclass
class Layout:
    """A weighted set laid out for the greedy: tiles by tile, units by unit, both cached."""
    tiles: DataFrame
    units: DataFrame
    strips: int

    def close(self) -> None:
        self.units.unpersist()
        self.tiles.unpersist()


def lay_out(weighted: DataFrame, n: int, dim: int, tile: int = TILE, strips: int | None = None) -> Layout:
    """``strips`` times the set is copied, once; see ``tiles``."""
    strips = strips or strip_count(n, dim, _tasks(weighted), tile)
    packed = pack_tiles(weighted, n, dim, strips, tile)
    tiles = packed.repartition(min(4 * strips, -(-n // tile)), "tile").cache()
    return Layout(tiles, work_units(tiles, strips).cache(), strips)


def scored(layout: Layout, bits: DataFrame | None, guesses: int, balls: dict, all_candidates: bool = False,
           totals: DataFrame | None = None) -> DataFrame:
    """(g, idx, val, x, ...) per guess and tile (or candidate). ``totals`` are the rows of the step before: what ``bits``
    newly covers is taken off them, else the balls are added up from all uncovered points."""
    s = layout.strips
    if bits is None:
        state = layout.tiles.select(F.lit(0).alias("unit"), "tile", F.lit(None).cast("binary").alias("bits")).limit(0)
    else:
        low, high = F.least("strip", "other"), F.greatest("strip", "other")
        held = bits.select("strip", "tile", "bits") if totals is None else bits.where(F.col("fresh").isNotNull()).select(
            "strip", "tile", F.col("fresh").alias("bits"))
        state = held.select(F.explode(F.sequence(F.lit(0), F.lit(s - 1))).alias("other"), "strip", "tile", "bits").select(
            (low * s + high).alias("unit"), "tile", "bits")
    partial = layout.units.groupBy("unit").cogroup(state.groupBy("unit")).applyInArrow(
        _partial_sums(guesses, balls, totals is not None),
        "tile long, g int, sign int, base double, sums binary, pairs long, skipped long, taken long")
    if totals is not None:
        none = [F.lit(0).cast("long").alias(c) for c in ("pairs", "skipped", "taken")]
        partial = partial.unionByName(totals.where(F.col("g").isin(list(balls))).select("tile", "g", "sign", "base", "sums", *none))
    return layout.tiles.groupBy("tile").cogroup(partial.groupBy("tile")).applyInArrow(_tile_sums(balls, all_candidates), _BEST)


def best_candidates(scores: DataFrame) -> dict:
    """For every guess of ``scored`` rows a row with idx and x of the best candidate (null: no positive ball) and the
    counts pairs, skipped and taken of tile pairs."""
    rank = F.when(F.col("idx").isNotNull(), F.struct("val", -F.col("idx")))
    best = scores.groupBy("g").agg(
        F.max_by("idx", rank).alias("idx"), F.max_by("x", rank).alias("x"), *[F.sum(c).alias(c) for c in ("pairs", "skipped", "taken")])
    return {r["g"]: r for r in best.collect()}  # a row a guess


def ball_weights(weighted: DataFrame, radius: float, tile: int = TILE) -> DataFrame:
    """Ball weight of every point with all points uncovered: ``(idx, ball_weight)``."""
    ws = checkpoint(weighted.select("idx", "x", F.col("w").cast("long").alias("w")))
    size = ws.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dim")).first()
    if not size["n"]:
        return ws.select("idx", F.lit(0).cast("long").alias("ball_weight"))
    layout = lay_out(ws, size["n"], size["dim"], tile)
    out = checkpoint(scored(layout, None, 1, {0: float(radius)}, all_candidates=True).select(
        "idx", F.col("val").cast("long").alias("ball_weight")))
    layout.close()
    return out


# ---------------------------------------------------------------- first guess

_MINIMA = pa.schema([("d", pa.float64()), ("dpos", pa.float64()), ("blocks", pa.int64())])


def _tile_minima(batches):
    """For mapInArrow over tiles: the least and least positive distance within each."""
    for batch in batches:
        for t in tiles_in(pa.Table.from_batches([batch])):
            d, dpos = Nearness(t.x, t.x).least(np.inf, np.inf, apart=True)
            yield pa.RecordBatch.from_arrays([pa.array([d]), pa.array([dpos]), pa.array([1], pa.int64())], schema=_MINIMA)


def _unit_minima(least: float, positive: float):
    """For groups of a unit's tiles: the minima between different tiles, where their bounds and the
    minima known so far leave it open. Of a pair of tiles only the points near the other tile are compared."""
    def run(key, tiles):
        held = {t for t, h in zip(tiles.column("tile").to_pylist(), tiles.column("held").to_pylist()) if h}
        both = tiles_in(tiles)
        own, other = [t for t in both if t.tile in held], [t for t in both if t.tile not in held]
        d, dpos, blocks = least, positive, 0
        for a, b in [(a, b) for a in own for b in other] if other else [(a, b) for i, a in enumerate(own) for b in own[i + 1:]]:
            if bounds(a, b)[0] > dpos:
                continue
            reach = lambda t: (t.radius + dpos) * (1 + 1e-9)
            x = a.x[block_distances(a.x, b.center)[:, 0] <= reach(b)]
            y = b.x[block_distances(b.x, a.center)[:, 0] <= reach(a)]
            if len(x) and len(y):
                d, dpos = Nearness(x, y).least(d, dpos)
                blocks += 1
        return pa.table([pa.array([d]), pa.array([dpos]), pa.array([blocks], pa.int64())], schema=_MINIMA)

    return run


def closest_pair(points: DataFrame, n: int, dim: int, tile: int = TILE) -> tuple[float, float, int]:
    """The least and the least positive distance among ``points`` (idx, x, w), infinite if there is none,
    and the number of blocks of distances computed. Neighbours are packed into one tile, so the
    minima within tiles (linear in n) are near the minima of all and settle most pairs of tiles."""
    strips = strip_count(n, dim, _tasks(points), tile)
    tiles = pack_tiles(points, n, dim, strips, tile)
    if n > tile:
        tiles = tiles.cache()
    kernel = "d double, dpos double, blocks long"
    row = tiles.mapInArrow(_tile_minima, kernel).agg(F.min("d").alias("d"), F.min("dpos").alias("dpos"), F.sum("blocks").alias("b")).first()
    if n > tile:
        more = work_units(tiles, strips).groupBy("unit").applyInArrow(_unit_minima(row["d"], row["dpos"]), kernel)
        first, row = row["b"], more.agg(F.min("d").alias("d"), F.min("dpos").alias("dpos"), F.sum("blocks").alias("b")).first()
        tiles.unpersist()
        return row["d"], row["dpos"], first + row["b"]
    return row["d"], row["dpos"], row["b"]


def initial_radius(weighted: DataFrame, m: int, tile: int = TILE) -> DataFrame:
    """Half the least distance among the first ``m`` points by ``idx``.

    One row: ``(r0, r0_positive, head_size)``; ``r0_positive`` is half the least *positive*
    distance among them (null when all coincide), used when duplicates make ``r0`` zero. The
    m-th idx (they are distinct) is found by selection, and the closest pair of the head, of any size, from
    tiles of neighbouring points.
    """
    ws = weighted.select("idx", "x", F.lit(1).cast("long").alias("w"))
    stats = ws.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dim")).first()
    r0, positive, size = _initial_radius(ws, m, stats["n"], stats["dim"] or 0, tile)
    known = lambda v: F.lit(v).cast("double")
    return weighted.sparkSession.range(1).select(known(r0).alias("r0"), known(positive).alias("r0_positive"),
                                                 F.lit(size).cast("int").alias("head_size"))


def _initial_radius(ws: DataFrame, m: int, n: int, dim: int, tile: int) -> tuple[float | None, float | None, int]:
    size = min(m, n)
    if size < 2:
        return None, None, size
    head = ws if n <= m else ws.where(F.col("idx") <= kth_value(ws, "idx", m - 1))
    d, dpos, _ = closest_pair(head, size, dim, tile)
    return d / 2, (dpos / 2 if dpos < float("inf") else None), size


# ---------------------------------------------------------------- greedy

@dataclass
class GreedyResult:
    centers: DataFrame  # (step, idx, point_id, x)
    r_initial: float
    r_final: float
    guesses: int
    uncovered_weight: int
    schedule: list[float] = field(default_factory=list)
    center_idx: list[int] = field(default_factory=list)
    #: Pairs of tiles looked at over all steps and guesses, and those that bounds settled.
    tile_pairs: int = 0
    pruned_pairs: int = 0
    steps: int = 0


def guess_schedule(r0: float, r0_positive: float | None, fallback_positive: float | None,
                   diameter_bound: float, alpha: float) -> list[float]:
    """Radius guesses r0, 2*r0, 4*r0, ... up to one that surely succeeds.

    When duplicates make r0 = 0, the guess 0 is tried first and the doubling starts
    from half the least positive distance instead (doubling zero would never end).
    """
    cover = 3 + 4 * alpha
    out: list[float] = []
    start = r0
    if r0 == 0:
        out.append(0.0)
        start = r0_positive if r0_positive else fallback_positive
        if not start:
            return out  # all points coincide: radius 0 covers everything
    r = start
    out.append(r)
    while cover * r < diameter_bound:
        r *= 2
        out.append(r)
    return out


def _checked(ws: DataFrame, z: int, max_points: int | None):
    """Statistics of the set in one aggregate, or ValueError."""
    by_idx = ws.groupBy("idx").agg(
        F.count(F.lit(1)).alias("c"), F.sum("w").alias("w"), F.min("w").alias("wmin"), F.min(F.size("x")).alias("lo"),
        F.max(F.size("x")).alias("hi"), F.count_if(malformed("x") | F.col("idx").isNull()).alias("bad"))
    stats = by_idx.agg(
        F.sum("c").alias("c"), F.max("c").alias("cmax"), F.sum("w").alias("w"), F.min("wmin").alias("wmin"),
        F.min("idx").alias("head"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("bad").alias("bad")).first()
    if not stats["c"]:
        raise ValueError("empty point set")
    if stats["bad"]:
        raise ValueError(f"{stats['bad']} of the points have a missing id or a missing or malformed coordinate")
    if stats["lo"] != stats["hi"]:
        raise ValueError(f"points have mixed dimensions ({stats['lo']} to {stats['hi']})")
    if stats["cmax"] > 1:
        raise ValueError("duplicate point ids")
    if stats["wmin"] is None or stats["wmin"] < 1:
        raise ValueError("weights must be >= 1")
    if z >= stats["w"]:
        raise ValueError(f"z={z} must be smaller than the total weight ({stats['w']})")
    if max_points is not None and stats["c"] > max_points:
        raise ValueError(f"{stats['c']} points exceed max_points={max_points}")
    return stats["c"], stats["hi"], stats["head"], int(stats["w"])


def weighted_kcenter_outliers(weighted: DataFrame, k: int, z: int, alpha: float = 0.0, max_points: int | None = None,
                              tile: int = TILE, strips: int | None = None) -> GreedyResult:
    """Weighted greedy on ``(idx, point_id, x, w)``; ``idx`` orders the points (ties, head).

    Raises ValueError for malformed vectors, mixed dimensions, duplicate idx, weights below 1,
    and z not below the total weight.
    """
    _check_params(k, z, alpha)
    spark = weighted.sparkSession
    # written once: everything below, the centers included, reads the same rows
    ws = checkpoint(weighted.select("idx", "point_id", "x", F.col("w").cast("long").alias("w")))
    n, dim, head_idx, total_weight = _checked(ws, z, max_points)
    head = np.array(ws.where(F.col("idx") == head_idx).first()["x"], dtype=float)
    from_head = ws.select(nearest_udf([(0, head[None, :])])("x")["d"].alias("d"))
    far = from_head.agg(F.max("d").alias("dmax"), F.min(F.when(F.col("d") > 0, F.col("d"))).alias("dpos")).first()
    r0, r0_positive, _ = _initial_radius(ws, k + z + 1, n, dim, tile)
    schedule = guess_schedule(r0 or 0.0, r0_positive, far["dpos"] / 2 if far["dpos"] else None, 2 * far["dmax"], alpha)

    layout = lay_out(ws, n, dim, tile, strips)
    total = len(schedule)
    chosen: dict[int, list[int]] = {g: [] for g in range(total)}
    newest: dict[int, tuple[np.ndarray, float]] = {}
    wz = dict.fromkeys(range(total), total_weight)
    done: set[int] = set()
    steps, pairs, pruned = 0, 0, 0
    bits = scores = None
    live = list(range(total))
    try:
        while live:
            steps += 1
            totals = scores
            scores = scored(layout, bits, total, {g: (1 + 2 * alpha) * schedule[g] for g in live}, totals=totals)
            scores = checkpoint(scores) if steps % CUT_STEPS == 0 else scores.persist()
            best = best_candidates(scores)
            if totals is not None:
                totals.unpersist()
            for g in live:
                row = best[g]
                pairs, pruned = pairs + row["pairs"], pruned + row["skipped"] + row["taken"]
                # a guess with uncovered weight always has a positive ball; index 0 is
                # what a sequential scan keeps if it had none
                chosen[g].append(head_idx if row["idx"] is None else row["idx"])
                newest[g] = (head if row["idx"] is None else np.array(row["x"]), (3 + 4 * alpha) * schedule[g])
            before = bits
            bits = cover(layout.tiles, before, total, {g: newest[g] for g in live})
            bits = checkpoint(bits) if steps % CUT_STEPS == 0 else bits.persist()
            left = uncovered(bits)
            if before is not None:
                before.unpersist()
            wz |= {g: left[g] for g in live}
            done |= {g for g in live if wz[g] == 0 or len(chosen[g]) == k}
            certain = [g for g, v in wz.items() if v <= z]
            live = [g for g in live if g not in done and g <= min(certain, default=total)]
    finally:
        layout.close()
        for state in (bits, scores):
            if state is not None:
                state.unpersist()

    g_star = min(g for g in done if wz[g] <= z)
    steps_table = spark.createDataFrame([(s, i) for s, i in enumerate(chosen[g_star])], "step int, idx long")
    centers = ws.join(F.broadcast(steps_table), "idx").select("step", "idx", "point_id", "x")  # k rows
    return GreedyResult(centers=centers, r_initial=schedule[0], r_final=schedule[g_star], guesses=g_star + 1,
                        uncovered_weight=wz[g_star], schedule=schedule, center_idx=list(chosen[g_star]),
                        tile_pairs=pairs, pruned_pairs=pruned, steps=steps)
