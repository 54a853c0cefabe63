"""Distance to the nearest center and the k-center objective with z outliers.

The centers, however many, are broadcast in blocks of bounded size; scoring the points is a
narrow projection with no join and no exchange on the points side. Points and centers are
checked first (one aggregate of built-ins each): malformed coordinates and mixed dimensions
raise instead of dropping out of the result.

The objective is the (z+1)-th largest nearest-center distance, found for every z by the same
exact selection: the distances are checkpointed (8 bytes a point) and histogram passes narrow
the range that holds the answer. No task keeps z rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcenter.functions.vectors import center_blocks, check_vectors, nearest_udf
from popcenter.operators.selection import kth_value
from popcenter.session import checkpoint


def nearest_center(points: DataFrame, centers: DataFrame, order_col: str = "step") -> DataFrame:
    """``(point_id, nearest, distance)``: closest center (position in ``order_col`` order,
    ties to the lowest) and the distance to it, for every point."""
    dim = check_vectors(centers.select(F.col(order_col).alias("point_id"), "x"), "centers")
    if dim is None:
        raise ValueError("no centers")
    check_vectors(points, dim=dim)
    scored = points.select("point_id", nearest_udf(center_blocks(centers, order_col))("x").alias("_n"))
    return scored.select("point_id", F.col("_n.pos").alias("nearest"), F.col("_n.d").alias("distance"))


def kcenter_objective(points: DataFrame, centers: DataFrame, z: int, order_col: str = "step") -> DataFrame:
    """One row ``(objective)``: largest nearest-center distance after dropping the z largest.

    Empty when z is not smaller than the number of points.
    """
    if z < 0:
        raise ValueError(f"z must be >= 0, got {z}")
    distances = checkpoint(nearest_center(points, centers, order_col).select("distance"))
    value = kth_value(distances, "distance", z, largest=True)
    rows = distances.sparkSession.range(0 if value is None else 1)
    return rows.select(F.lit(value).cast("double").alias("objective"))
