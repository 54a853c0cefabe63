"""Composite clustering jobs.

* ``kcenter_outliers``          -- weighted greedy directly on the points (unit weights).
                                   Quadratic in n; ``max_points`` is an optional guard.
* ``coreset_kcenter_outliers``  -- round 1: FFT coreset of k+z+1 points per part;
                                   round 2: weighted greedy on the coreset (alpha=2).
* ``clustering_summary``        -- the end-to-end job: n, both rounds, the objective over
                                   all points, timings, as a one-row DataFrame.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcenter.operators.coreset import fft_coreset
from popcenter.operators.kcenter import GreedyResult, weighted_kcenter_outliers
from popcenter.operators.objective import kcenter_objective
from popcenter.operators.partitioning import assign_parts


def _check(k: int, z: int) -> None:
    if k < 1:
        raise ValueError(f"k must be >= 1, got {k}")
    if z < 0:
        raise ValueError(f"z must be >= 0, got {z}")


def unit_weighted(points: DataFrame) -> DataFrame:
    """``(idx, point_id, x, w)`` with unit weights, ordered by ``point_id``."""
    return points.select(F.col("point_id").alias("idx"), "point_id", "x", F.lit(1).cast("long").alias("w"))


def kcenter_outliers(points: DataFrame, k: int, z: int, alpha: float = 0.0,
                     max_points: int | None = None) -> GreedyResult:
    """Sequential-algorithm semantics on all points, run as a Spark job."""
    _check(k, z)
    return weighted_kcenter_outliers(unit_weighted(points), k, z, alpha, max_points=max_points)


@dataclass
class CoresetResult:
    coreset: DataFrame  # (part, pos, point_id, x, weight, rho)
    greedy: GreedyResult
    round1_sec: float = 0.0
    round2_sec: float = 0.0


def coreset_weighted(coreset: DataFrame, m: int) -> DataFrame:
    """Coreset as a weighted set ordered by ``(part, pos)``."""
    return coreset.select((F.col("part").cast("long") * m + F.col("pos")).alias("idx"), "point_id", "x",
                          F.col("weight").alias("w"))


def coreset_kcenter_outliers(points: DataFrame, k: int, z: int, num_parts: int, alpha: float = 2.0,
                             part_method: str = "hash", max_points: int | None = None) -> CoresetResult:
    """Two rounds: per-part FFT coreset with weights, then the weighted greedy on it."""
    _check(k, z)
    m = k + z + 1
    n = points.count()
    if z >= n:
        raise ValueError(f"z={z} must be smaller than the number of points ({n})")
    t0 = time.perf_counter()
    parts = points if "part" in points.columns else assign_parts(points, num_parts, part_method)
    cs = fft_coreset(parts, m)
    t1 = time.perf_counter()
    greedy = weighted_kcenter_outliers(coreset_weighted(cs, m), k, z, alpha, max_points=max_points)
    t2 = time.perf_counter()
    return CoresetResult(coreset=cs, greedy=greedy, round1_sec=t1 - t0, round2_sec=t2 - t1)


def clustering_summary(points: DataFrame, k: int, z: int, num_parts: int, alpha: float = 2.0,
                       part_method: str = "hash") -> tuple[DataFrame, dict]:
    """End-to-end coreset clustering; returns (one-row summary DataFrame, timings).

    Columns: n, k, z, num_parts, coreset_size, coreset_weight, r_initial, r_final,
    guesses, num_centers, objective, rho, bound. ``bound`` = (3+4*alpha)*r_final + rho,
    where rho is the largest distance from a point to its coreset representative.
    """
    _check(k, z)
    pts = points.select("point_id", "x")
    t1 = time.perf_counter()
    res = coreset_kcenter_outliers(pts, k, z, num_parts, alpha, part_method)
    t2 = time.perf_counter()
    g = res.greedy
    # coreset statistics: one row over the bounded coreset; its weights sum to n, so the
    # points are never scanned just to be counted
    cs = res.coreset.agg(F.count(F.lit(1)).alias("size"), F.sum("weight").alias("weight"),
                         F.max("rho").alias("rho")).first()
    n = int(cs["weight"])
    num_centers = len(g.center_idx)
    obj = kcenter_objective(pts, g.centers, z)
    summary = obj.select(
        F.lit(n).cast("long").alias("n"), F.lit(k).alias("k"), F.lit(z).alias("z"),
        F.lit(num_parts).alias("num_parts"), F.lit(cs["size"]).cast("long").alias("coreset_size"),
        F.lit(cs["weight"]).cast("long").alias("coreset_weight"),
        F.lit(g.r_initial).alias("r_initial"), F.lit(g.r_final).alias("r_final"),
        F.lit(g.guesses).alias("guesses"), F.lit(num_centers).cast("long").alias("num_centers"), "objective",
        F.lit(cs["rho"]).cast("double").alias("rho"),
        (F.lit((3 + 4 * alpha) * g.r_final) + F.lit(cs["rho"])).alias("bound"))
    timings = {"round1": res.round1_sec, "round2": res.round2_sec, "total_rounds": t2 - t1}
    return summary, timings
