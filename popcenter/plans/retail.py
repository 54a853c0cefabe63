"""Retail popularity report: the whole retail job as a set of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcenter.operators import retail as R
from popcenter.session import checkpoint


@dataclass
class RetailReport:
    row_count: DataFrame
    pair_count: DataFrame
    popularity: DataFrame
    top_products: DataFrame | None
    listing: DataFrame | None
    listing_two_stage: DataFrame | None
    pairs: DataFrame

    def rows(self) -> DataFrame:
        """The report as one DataFrame ``(section, position, product_id, value)``."""
        def lines(section, df, position, value):
            return df.select(F.lit(section).alias("section"), position.cast("bigint").alias("position"),
                             F.col("product_id").cast("string").alias("product_id"), F.col(value).alias("value"))

        none = F.lit(None).cast("string").alias("product_id")
        out = lines("rows", self.row_count.withColumn("product_id", none), F.lit(1), "row_count").unionByName(
            lines("pairs", self.pair_count.withColumn("product_id", none), F.lit(1), "pair_count"))
        if self.top_products is not None:
            return out.unionByName(lines("top", self.top_products, F.col("rank"), "popularity"))
        for section, df in (("popularity", self.listing), ("popularity_two_stage", self.listing_two_stage)):
            out = out.unionByName(lines(section, R.listing_positions(df), F.col("position"), "popularity"))
        return out


def retail_popularity(rows: DataFrame, country: str | None = "all", h: int = 0,
                      num_partitions: int | None = None) -> RetailReport:
    """Counts plus either the top-H products (h > 0) or both full listings (h == 0).

    The raw rows are read once: one pre-aggregated pass gives the distinct pairs and the number of rows, and is
    kept in the checkpoint folder; everything else comes from it. With h == 0 the two listings come from the two popularity
    computations (single aggregate and two-stage) so they can be compared, as a debugging aid. ``num_partitions``
    redistributes the raw rows (the four columns that are used) round-robin first: an extra shuffle; by default the scan's
    splits and AQE decide.
    """
    if h < 0:
        raise ValueError(f"h must be >= 0, got {h}")
    if num_partitions is not None:
        if num_partitions < 1:
            raise ValueError(f"num_partitions must be >= 1, got {num_partitions}")
        rows = rows.repartition(num_partitions)
    counted = checkpoint(R.counted_pairs(rows, country))
    pairs = counted.where("qualifies").select("product_id", "customer_id")
    popularity = R.popularity_of_pairs(pairs)
    return RetailReport(
        row_count=counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")),
        pair_count=pairs.agg(F.count(F.lit(1)).alias("pair_count")),
        popularity=popularity,
        top_products=R.top_products(popularity, h) if h > 0 else None,
        listing=R.popularity_listing(popularity) if h == 0 else None,
        listing_two_stage=R.popularity_listing(R.two_stage_of_pairs(pairs)) if h == 0 else None,
        pairs=pairs,
    )
