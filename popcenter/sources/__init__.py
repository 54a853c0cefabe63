"""Readers: retail rows, point files, and views over the driver's parquet tables."""

from popcenter.sources.points import (parse_points, points1_view, points2_view, points64_view, points_as_text,
                                      read_points)
from popcenter.sources.retail import read_transactions, parse_transactions, retail_view, table

__all__ = [
    "read_transactions",
    "parse_transactions",
    "retail_view",
    "table",
    "read_points",
    "parse_points",
    "points_as_text",
    "points64_view",
    "points1_view",
    "points2_view",
]
