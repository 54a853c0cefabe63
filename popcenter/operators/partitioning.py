"""Coreset units: an explicit ``part`` column instead of physical RDD partitions.

The unit a coreset is computed for is a key, not a Spark partition, so the answer does
not change with cluster layout and Spark stays free to split a unit over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assign_parts(points: DataFrame, num_parts: int, method: str = "hash") -> DataFrame:
    """Add ``part int`` in ``[0, num_parts)``.

    ``hash`` (default) spreads any id distribution evenly; ``mod`` uses
    ``point_id mod num_parts`` and is reproducible outside Spark (oracle checks).
    """
    if num_parts < 1:
        raise ValueError(f"num_parts must be >= 1, got {num_parts}")
    if method == "mod":
        key = F.pmod(F.col("point_id"), F.lit(num_parts))
    elif method == "hash":
        key = F.pmod(F.xxhash64("point_id"), F.lit(num_parts))
    else:
        raise ValueError(f"unknown part method {method!r}")
    return points.withColumn("part", key.cast("int"))
