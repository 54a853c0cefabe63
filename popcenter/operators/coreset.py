"""Round 1: farthest-first traversal (FFT) coreset with weights, per part.

For every part the traversal starts at the part's smallest ``point_id``; each next center is
the point farthest from the centers chosen so far (ties: smallest ``point_id``). A part stops
early when every point coincides with a center (no point is added twice, so no zero-weight
padding). The weight of a center is the number of the part's points whose closest center it is
(ties: the earlier center).

Distributed form. The points are written once, as tiles of at most ``TILE`` points of one part, bucketed by tile. What
changes is a narrow state per tile: every point's distance to its closest center so far and that center's position,
12 bytes a point whatever the dimension. It is a table in the same buckets, so points and state meet
without an exchange. A pass reads the points once:

1. the centers found since the state was written are applied to it within the task;
2. the ``TILE_TOP`` farthest points of each tile go on, of these the ``CANDIDATES`` farthest of each part, and
   the farthest distance left out (tasks cut theirs before the shuffle, which is merged in two levels). In
   one task per part, which holds these candidates alone, as many centers follow as are certain: distances only shrink, so as long as the best
   candidate, after the centers just added, is farther than the bound, it is the next center; on a tie with the
   bound a new pass decides. The new centers are appended to the table of centers. (Before the first center all
   distances are infinite, so the first one is the smallest id.)

A pass adds one center per part at least and usually many. Once ``PENDING`` centers a part have gathered, a new
state is written and its predecessor deleted: two at most exist, and a distance is computed once per pass until
then. No part is gathered into one task, however large or skewed. The driver passes the new centers on to the
tasks in broadcast blocks of bounded size, drops them when the state is written, and keeps a count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcenter.functions.vectors import BLOCK_COORDS, block_distances, malformed, matrix, nearest_rows, vectors
from popcenter.session import BucketedTable, checkpoint, remove_folder, scratch_folder

TILE = 2048
TILE_TOP = 512
CANDIDATES = 2048
PENDING = 16
BUCKET_BYTES = 128 << 20


@dataclass
class Traversal:
    coreset: DataFrame  # (part, pos, point_id, x, weight, rho)
    passes: int


def _checked(pts: DataFrame, dim: int | None) -> tuple[int, int]:
    """Number of points and their dimension, or ValueError: one aggregate of built-ins."""
    row = pts.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("lo"), F.max(F.size("x")).alias("hi"),
                  F.count_if(malformed("x") | F.col("point_id").isNull() | F.col("part").isNull()).alias("bad")).first()
    if not row["n"]:
        raise ValueError("empty point set")
    if row["bad"]:
        raise ValueError("some point has a missing id or part, or a missing or malformed coordinate")
    if row["lo"] != row["hi"] or (dim is not None and row["lo"] != dim):
        raise ValueError(f"points have mixed dimensions ({sorted({row['lo'], row['hi'], dim or row['lo']})})")
    return row["n"], row["lo"]


# ---------------------------------------------------------------- tiles and state

_TILE = pa.schema([("part", pa.int32()), ("tile", pa.int64()), ("ids", pa.binary()), ("x", pa.binary())])


def _packer(size: int):
    """For mapInArrow over rows (part, point_id, x) sorted by part and id: tiles of one part each."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k, held, part = TaskContext.get().partitionId(), 0, [], None

        def out():
            nonlocal k, held
            ids, x = (np.concatenate(c) for c in zip(*held))
            row = (part, (task << 32) + k, ids.tobytes(), np.ascontiguousarray(x).tobytes())
            k, held = k + 1, []
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _TILE)], schema=_TILE)

        for batch in batches:
            parts, ids, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), matrix(batch.column(2))
            at = 0
            while at < len(parts):
                if held and (parts[at] != part or sum(len(h[0]) for h in held) >= size):
                    yield out()
                part = int(parts[at])
                room = size - sum(len(h[0]) for h in held)
                to = min(at + room, int(np.searchsorted(parts, part, "right")))
                held.append((ids[at:to], x[at:to]))
                at = to
        if held:
            yield out()

    return pack


def _points_in(table) -> tuple[int, int, np.ndarray, np.ndarray]:
    row = {c: table.column(c)[0].as_py() for c in _TILE.names}
    ids = np.frombuffer(row["ids"], np.int64)
    return row["part"], row["tile"], ids, np.frombuffer(row["x"]).reshape(len(ids), -1)


def _state_in(table, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """d, pos and the number of centers so far; the empty side of a cogroup has no columns."""
    if not table.num_rows:
        return np.full(n, np.inf), np.full(n, -1, np.int32), 0
    return (np.frombuffer(table.column("d")[0].as_py()).copy(), np.frombuffer(table.column("pos")[0].as_py(), np.int32).copy(),
            table.column("chosen")[0].as_py())


_STATE = "part int, tile long, d binary, pos binary, chosen int"


def _applied(part: int, x: np.ndarray, state, blocks: list) -> tuple[np.ndarray, np.ndarray, int]:
    """d, pos and the number of centers after the pending centers of the part (``blocks``, in any order:
    of equally close centers the earlier one)."""
    d, pos, chosen = _state_in(state, len(x))
    for low, high, block in blocks:
        if low <= part <= high and part in block.value:
            numbers, centers = block.value[part]
            at, dist = nearest_rows(x, centers)
            closer = (dist < d) | ((dist == d) & (numbers[at] < pos))
            d[closer], pos[closer] = dist[closer], numbers[at][closer]
            chosen = max(chosen, int(numbers[-1]) + 1)
    return d, pos, chosen


def _applier(blocks: list):
    """For a cogroup of a tile and its state: the next state."""
    def run(key, points, state):
        part, tile, ids, x = _points_in(points)
        d, pos, chosen = _applied(part, x, state, blocks)
        return pa.table({"part": pa.array([part], pa.int32()), "tile": pa.array([tile]), "d": pa.array([d.tobytes()], pa.binary()),
                         "pos": pa.array([pos.astype(np.int32).tobytes()], pa.binary()), "chosen": pa.array([chosen], pa.int32())})

    return run


# ---------------------------------------------------------------- candidates

_CANDIDATE = pa.schema([("part", pa.int32()), ("chosen", pa.int32()), ("point_id", pa.int64()), ("x", pa.list_(pa.float64())),
                        ("d", pa.float64()), ("bound", pa.float64())])
_CANDIDATES = "part int, chosen int, point_id long, x array<double>, d double, bound double"


def _candidate_rows(part, chosen, ids, x, d, bound) -> pa.Table:
    n = len(ids)
    return pa.table([pa.array(np.broadcast_to(np.int32(part), n)), pa.array(np.broadcast_to(np.int32(chosen), n)), pa.array(ids),
                     vectors(x) if n else pa.array([], pa.list_(pa.float64())), pa.array(d), pa.array(np.broadcast_to(float(bound), n))],
                    schema=_CANDIDATE)


def _farthest(top: int, m: int, blocks: list):
    """For a cogroup of a tile and its state: after the pending centers, the farthest points (ties: lowest id) and the
    distance of the first one left out. Nothing for a part that has its m centers."""
    def run(key, points, state):
        part, _, ids, x = _points_in(points)
        d, _, chosen = _applied(part, x, state, blocks)
        order = np.lexsort((ids, -d))[:top + 1] if chosen < m else np.empty(0, int)
        order = order[d[order] > 0]
        bound = d[order[top]] if len(order) > top else 0.0
        order = order[:top]
        return _candidate_rows(part, chosen, ids[order], x[order], d[order], bound)

    return run


def _merged(rows: pa.Table, top: int) -> pa.Table:
    """The ``top`` farthest of the candidates of one part, and the bound that goes with them."""
    ids, d = rows.column("point_id").to_numpy(), rows.column("d").to_numpy()
    order = np.lexsort((ids, -d))
    bound = rows.column("bound").to_numpy().max()
    if len(order) > top:
        bound = max(bound, d[order[top]])
        order = order[:top]
    kept = rows.take(pa.array(order))
    return kept.set_column(kept.schema.get_field_index("bound"), "bound", pa.array(np.full(len(order), bound)))


def _merge_in_task(top: int):
    """For mapInArrow: the farthest candidates of each part in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, pa.Table] = {}
        for batch in batches:
            parts = batch.column(0).to_numpy()
            for p in np.unique(parts).tolist():
                rows = pa.Table.from_batches([batch]).filter(pa.array(parts == p))
                held[p] = _merged(pa.concat_tables([held[p], rows]) if p in held else rows, top)
        for rows in held.values():
            yield from rows.combine_chunks().to_batches()

    return run


def _next_centers(top: int, m: int):
    """For the candidates of one part: the centers that follow for certain, as (part, pos, point_id, x)."""
    def run(key, rows):
        rows = _merged(rows.select(_CANDIDATE.names), top)
        ids, d, x = rows.column("point_id").to_numpy(), rows.column("d").to_numpy().copy(), matrix(rows.column("x").combine_chunks())
        bound, chosen = rows.column("bound")[0].as_py(), rows.column("chosen")[0].as_py()
        out: list[int] = []
        while len(out) < m - chosen:
            best = np.lexsort((ids, -d))[0]
            if d[best] <= 0 or (out and not d[best] > bound):
                break
            out.append(int(best))
            d = np.minimum(d, block_distances(x, x[[best]])[:, 0])
            d[best] = 0.0
        part = rows.column("part")[0].as_py()
        return pa.table({"part": pa.array([part] * len(out), pa.int32()), "pos": pa.array(range(chosen, chosen + len(out)), pa.int32()),
                         "point_id": pa.array(ids[out], pa.int64()), "x": vectors(x[out])})

    return run


def _candidates(points: DataFrame, state: DataFrame, m: int, top: int, tile_top: int, buckets: int, blocks: list) -> DataFrame:
    """The farthest points of each part; tasks (and groups of tasks, if there are many) keep ``top`` of each."""
    far = points.groupBy("tile").cogroup(state.groupBy("tile")).applyInArrow(_farthest(tile_top, m, blocks), _CANDIDATES)
    far = far.mapInArrow(_merge_in_task(top), _CANDIDATES)
    groups = math.isqrt(buckets)
    if groups > 8:
        salted = far.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(groups)))
        merge = lambda key, rows: _merged(rows.select(_CANDIDATE.names), top)
        far = salted.groupBy("part", "salt").applyInArrow(merge, _CANDIDATES)
    return far


def _blocks(new: DataFrame, dim: int) -> tuple[list, int, int]:
    """The new centers as broadcast blocks of about ``BLOCK_COORDS`` coordinates, (first part, last part, {part:
    (positions, vectors)}), the number of centers and of parts that got their first one. The driver reads a slice of
    the table at a time and holds one block."""
    sc, out, held, size, total, parts = new.sparkSession.sparkContext, [], {}, 0, 0, 0

    def flush():
        block = {p: (np.array([k for k, _ in sorted(rows)], np.int32), np.array([x for _, x in sorted(rows)], dtype=float))
                 for p, rows in held.items()}
        out.append((min(block), max(block), sc.broadcast(block)))

    for r in new.coalesce(-(-max(1, new.rdd.getNumPartitions()) // 8)).toLocalIterator():
        if size + dim > BLOCK_COORDS and held:
            flush()
            held, size = {}, 0
        held.setdefault(r["part"], []).append((r["pos"], r["x"]))
        size, total, parts = size + dim, total + 1, parts + (r["pos"] == 0)
    if held:
        flush()
    return out, total, parts


# ---------------------------------------------------------------- traversal

def _bucket_count(n: int, dim: int, tasks: int, tile: int) -> int:
    return max(1, min(2 * tasks, -(-n // tile)), -(-n * (8 * dim + 8) // BUCKET_BYTES))


def fft_traversal(points: DataFrame, m: int, dim: int | None = None, candidates: int = CANDIDATES, tile: int = TILE,
                  tile_top: int = TILE_TOP) -> Traversal:
    """The coreset of ``fft_coreset`` and the number of passes over the points it took."""
    if m < 1:
        raise ValueError(f"coreset size per part must be >= 1, got {m}")
    spark, top = points.sparkSession, max(1, candidates)
    pts = points.select(F.col("part").cast("int").alias("part"), "point_id", "x")
    n, dim = _checked(pts, dim)
    buckets = _bucket_count(n, dim, spark.sparkContext.defaultParallelism, tile)
    # sorted first, so a task that is run again packs the same tiles
    packed = pts.sortWithinPartitions("part", "point_id").mapInArrow(_packer(tile), "part int, tile long, ids binary, x binary")
    tiles = BucketedTable(packed.repartition(buckets, "tile"), "tile", buckets)
    folder = scratch_folder(spark, "centers")
    center_schema = "part int, pos int, point_id long, x array<double>"
    state: BucketedTable | None = None
    parts, passes, total, since, blocks = 0, 0, 0, 0, []

    def known() -> DataFrame:
        if state is not None:
            return state.df
        none = F.lit(None).cast("binary")
        return tiles.df.select("part", "tile", none.alias("d"), none.alias("pos"), F.lit(0).alias("chosen")).limit(0)

    def applied() -> DataFrame:
        return tiles.df.groupBy("tile").cogroup(known().groupBy("tile")).applyInArrow(_applier(blocks), _STATE)

    try:
        while True:
            far = _candidates(tiles.df, known(), m, top, max(1, min(tile_top, top)), buckets, blocks)
            far.groupBy("part").applyInArrow(_next_centers(top, m), center_schema).write.parquet(f"{folder}/{passes}")
            new, added, first = _blocks(spark.read.schema(center_schema).parquet(f"{folder}/{passes}"), dim)
            blocks, total, since, passes, parts = blocks + new, total + added, since + added, passes + 1, parts + first
            if not added or total == parts * m:
                break
            if since > PENDING * parts:
                after = BucketedTable(applied(), "tile", buckets)
                if state is not None:
                    state.drop()
                for _, _, block in blocks:
                    block.destroy()
                state, since, blocks = after, 0, []
        centers = spark.read.schema(center_schema).parquet(*[f"{folder}/{k}" for k in range(passes)])
        out = checkpoint(centers.join(_weights(applied()), ["part", "pos"]).select("part", "pos", "point_id", "x", "weight", "rho"))
    finally:
        tiles.drop()
        if state is not None:
            state.drop()
        for _, _, block in blocks:
            block.destroy()
        remove_folder(spark, folder)
    return Traversal(out, passes)


def _tile_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over states: per tile and center the number of points and the largest distance."""
    for batch in batches:
        for part, d, pos in zip(*(batch.column(c).to_pylist() for c in range(3))):
            d, pos = np.frombuffer(d), np.frombuffer(pos, np.int32)
            weight = np.bincount(pos)
            rho = np.zeros(len(weight))
            np.maximum.at(rho, pos, d)
            some = np.flatnonzero(weight)
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(some), pa.int32()), pa.array(some.astype(np.int32)),
                                              pa.array(weight[some].astype(np.int64)), pa.array(rho[some])], ["part", "pos", "w", "r"])


def _weights(state: DataFrame) -> DataFrame:
    return state.select("part", "d", "pos").mapInArrow(_tile_weights, "part int, pos int, w long, r double").groupBy(
        "part", "pos").agg(F.sum("w").alias("weight"), F.max("r").alias("rho"))


def fft_coreset(points: DataFrame, m: int, dim: int | None = None) -> DataFrame:
    """Weighted FFT coreset of ``m`` points per part.

    ``points`` has ``part, point_id, x``. Returns ``(part, pos, point_id, x, weight, rho)``:
    ``pos`` is the traversal step (0-based), ``weight`` the number of points assigned to the
    center, ``rho`` the largest distance from one of them to it. At most ``m`` rows per
    non-empty part; empty parts emit none.
    """
    return fft_traversal(points, m, dim).coreset
