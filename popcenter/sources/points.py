"""Point sources: ``(point_id bigint, x array<double>)``.

A point has any number of dimensions; identity is an explicit ``point_id`` column
(ties in the clustering operators are broken by it, so results do not depend on how
the input happens to be split into partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popcenter.functions.vectors import parse_vector
from popcenter.session import checkpoint
from popcenter.sources.retail import table


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value): the lines of a text file or directory, numbered from 0 in the order of file paths and of
    positions in the files. The numbers do not depend on how the files are split into tasks.

    A first scan counts the lines of each split (file, start) and sums them up in order; a second one adds each
    line's place in its split. The list of splits is as long as the one that the scan itself is planned from.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    splits = lines.groupBy("file", "start").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    files = splits.groupBy("file").agg(F.sum("n").alias("lines"))
    files = files.select("file", (F.sum("lines").over(Window.orderBy("file")) - F.col("lines")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("file").orderBy("start")) - F.col("n")
    offsets = checkpoint(splits.withColumn("inside", inside).join(files, "file").select(
        "file", "start", (F.col("before") + F.col("inside") - F.col("first")).alias("shift")))
    return lines.join(offsets, ["file", "start"]).select((F.col("at") + F.col("shift")).alias("line"), "value")


def parse_points(lines: DataFrame, text_col: str = "value", id_col: str = "line") -> DataFrame:
    """Parse comma-separated coordinate lines into ``(point_id, x)``; blank lines are skipped."""
    kept = lines.where(F.length(F.trim(F.col(text_col))) > 0)
    return kept.select(F.col(id_col).cast("bigint").alias("point_id"), parse_vector(text_col).alias("x"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Read a text file (or directory) of comma-separated points. A point's id is the number of its
    line (see ``numbered_lines``), the same for any split size."""
    return parse_points(numbered_lines(spark, path))


def points_as_text(points: DataFrame) -> DataFrame:
    """Render ``(point_id, x)`` back to ``(point_id, value)`` text lines."""
    return points.select("point_id", F.array_join(F.col("x").cast("array<string>"), ",").alias("value"))


def points64_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-dimensional unit vectors from ``embeddings`` (stored as float, widened to double)."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("point_id"), F.col("embedding").cast("array<double>").alias("x"))


def points1_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-dimensional points ``(c_acctbal)`` from ``customer``: spread out, so a small radius
    covers few of them and the greedy takes several centers and guesses."""
    customer = table(spark, sf_dir, "customer")
    return customer.select(F.col("c_custkey").alias("point_id"), F.array(F.col("c_acctbal").cast("double")).alias("x"))


def points2_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2-dimensional points ``(p_size, p_retailprice)`` from ``part`` (has duplicates)."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("point_id"),
        F.array(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double")).alias("x"),
    )
