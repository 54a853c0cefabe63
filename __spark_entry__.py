"""

Every query reads the driver's tables whole (no id subsets or row caps); a ``limit``
appears only where it is the feature (top-H, the (z+1)-th largest distance, the first
k+z+1 points that define the initial radius).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_sql as O
from popcenter.operators import retail as R
from popcenter.operators.coreset import fft_coreset
from popcenter.operators.kcenter import ball_weights, initial_radius, weighted_kcenter_outliers
from popcenter.operators.objective import kcenter_objective, nearest_center
from popcenter.operators.partitioning import assign_parts
from popcenter.plans.kcenter import clustering_summary, coreset_weighted, kcenter_outliers
from popcenter.plans.retail import retail_popularity
from popcenter.session import scratch_folder
from popcenter.sources import (parse_points, points1_view, points2_view, points64_view, points_as_text, read_points, read_transactions,
                               retail_view)
from popcenter.sources.retail import parse_transactions

try:  # the training-data operators are an add-on: without them everything else still works
    import corpus_pipeline
    from popcenter.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

FLAGSHIP_DIR = "/root/testdata/sf0.001"

# fixed query parameters
COUNTRY = "NATION_1"
TOP_H = 10
PARTS = 4
K64, Z64 = 5, 3          # embeddings: k, z
K2, Z2 = 10, 3           # part points: k, z
K1, Z1 = 3, 60           # customer balances: several centers and guesses with alpha = 2
OBJECTIVE_Z = 3


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top-10 products by popularity over the sf0.001 retail view."""
    return R.top_products(R.product_popularity(retail_view(spark, FLAGSHIP_DIR)), TOP_H)


# ---------------------------------------------------------------- helpers

def _retail(spark, d):
    return retail_view(spark, d)


def _purchases(spark, d):
    return retail_view(spark, d, purchases_only=True)


def _faulty_text(spark, d) -> DataFrame:
    """The retail view as lines of which some are malformed, by rules on their keys: no number for
    a quantity (every 50th product), no customer (41st order), no country (77th customer)."""
    v = retail_view(spark, d)
    lost = F.col("customer_id") % 77 == 0
    fields = [F.col("transaction_id"), F.col("product_id"), F.lit("item"),
              F.when(F.col("product_id") % 50 == 0, "n/a").otherwise(F.col("quantity").cast("int").cast("string")),
              F.date_format("invoice_date", "yyyy-MM-dd HH:mm"), F.lit("1.0"),
              F.when((F.col("transaction_id") % 41 == 0) & ~lost, "").otherwise(F.col("customer_id").cast("string")),
              F.when(lost, "").otherwise(F.col("country"))]
    return v.select(F.concat_ws(",", *fields).alias("value"))


def _retail_rejects(spark, d) -> DataFrame:
    return R.rejected_rows(parse_transactions(_faulty_text(spark, d)), COUNTRY).select(
        "transaction_id", "product_id", "bad_country", "bad_quantity", "bad_customer")


def _retail_report(country, h):
    return lambda s, d: retail_popularity(_retail(s, d), country, h, num_partitions=PARTS).rows()


def _retail_as_text(spark, d) -> DataFrame:
    """The retail view rendered as comma-separated lines (the text source's input)."""
    v = retail_view(spark, d)
    fields = [F.col("transaction_id").cast("string"), F.col("product_id").cast("string"),
              F.coalesce(F.col("description"), F.lit("")), F.col("quantity").cast("int").cast("string"),
              F.date_format("invoice_date", "yyyy-MM-dd HH:mm"), F.col("unit_price").cast("string"),
              F.col("customer_id").cast("string"), F.col("country")]
    return v.select(F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in fields]).alias("value"))


def _text_popularity(spark, d) -> DataFrame:
    """Popularity from text files: the view is written as lines and read back by the text source."""
    folder = scratch_folder(spark, "retail-text")
    _retail_as_text(spark, d).write.text(folder)
    return R.product_popularity(read_transactions(spark, folder))


def _points_from_text(spark, d) -> DataFrame:
    """The part points, in the order of their ids, written as text files and read back: their ids are then
    the numbers of their lines."""
    folder = scratch_folder(spark, "points-text")
    lines = points_as_text(points2_view(spark, d))
    lines.repartitionByRange(PARTS, "point_id").sortWithinPartitions("point_id").select("value").write.text(folder)
    return read_points(spark, folder)


def _label_centers(spark, d) -> DataFrame:
    """One center per label: the label's smallest-id embedding (step = label)."""
    pts = spark.read.parquet(f"{d}/embeddings.parquet")
    return pts.groupBy("label").agg(
        F.min_by(F.col("embedding").cast("array<double>"), F.col("vec_id")).alias("x")
    ).select(F.col("label").cast("int").alias("step"), "x")


def _coreset(view, k, z):
    def build(spark, d):
        return fft_coreset(assign_parts(view(spark, d), PARTS, "mod"), k + z + 1)
    return build


def _coreset_out(cs: DataFrame) -> DataFrame:
    return cs.select("part", "pos", "point_id", "weight", F.round("rho", 9).alias("rho"))


def _centers_out(res) -> DataFrame:
    return res.centers.select(
        "step", "point_id",
        F.round(F.lit(res.r_initial), 9).alias("r_initial"),
        F.round(F.lit(res.r_final), 9).alias("r_final"),
        F.lit(res.guesses).cast("int").alias("guesses"),
    )


def _weighted_kcenter(view, k, z, alpha):
    def run(spark, d):
        cs = _coreset(view, k, z)(spark, d)
        return _centers_out(weighted_kcenter_outliers(coreset_weighted(cs, k + z + 1), k, z, alpha))
    return run


def _kcenter_outliers(view, k, z, alpha=0.0):
    def run(spark, d):
        return _centers_out(kcenter_outliers(view(spark, d), k, z, alpha))
    return run


def _initial_radius(spark, d):
    m = K2 + Z2 + 1
    cs = _coreset(points2_view, K2, Z2)(spark, d)
    r = initial_radius(coreset_weighted(cs, m), m)
    return r.select(F.round("r0", 9).alias("r0"), F.round("r0_positive", 9).alias("r0_positive"),
                    F.col("head_size").cast("int").alias("head_size"))


def _ball_weights(spark, d):
    """Ball weights on the part-points coreset at radius (1+2*2)*r0 (alpha = 2)."""
    m = K2 + Z2 + 1
    cs = _coreset(points2_view, K2, Z2)(spark, d)
    ws = coreset_weighted(cs, m)
    r0 = initial_radius(ws, m).first()["r0"]
    bw = ball_weights(ws, 5 * r0)
    return bw.join(ws.select("idx", "point_id"), "idx").select("point_id", "ball_weight")


def _summary(view, k, z):
    def run(spark, d):
        summary, _ = clustering_summary(view(spark, d), k, z, PARTS, 2.0, part_method="mod")
        return summary.select(
            "n", "k", "z", "num_parts", "coreset_size", "coreset_weight",
            *[F.round(c, 9).alias(c) for c in ("r_initial", "r_final")],
            F.col("guesses").cast("int").alias("guesses"), "num_centers",
            *[F.round(c, 9).alias(c) for c in ("objective", "rho", "bound")])
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **(llm_queries.queries() | {"pipeline": corpus_pipeline.run} if llm_queries else {}),
        # retail popularity
        "row_count": lambda s, d: R.row_count(_retail(s, d)),
        "product_customer_pairs": lambda s, d: R.product_customer_pairs(_purchases(s, d)),
        "product_customer_pairs_country": lambda s, d: R.product_customer_pairs(_purchases(s, d), COUNTRY),
        "pair_count": lambda s, d: R.pair_count(_purchases(s, d)),
        "pair_count_country": lambda s, d: R.pair_count(_purchases(s, d), COUNTRY),
        "product_popularity": lambda s, d: R.product_popularity(_purchases(s, d)),
        "popularity_two_stage": lambda s, d: R.popularity_two_stage(_purchases(s, d)),
        "popularity_listing": lambda s, d: R.popularity_listing(R.product_popularity(_purchases(s, d), COUNTRY)),
        "top_products": lambda s, d: R.top_products(R.product_popularity(_purchases(s, d)), TOP_H),
        "top_products_country": lambda s, d: R.top_products(R.product_popularity(_purchases(s, d), COUNTRY), TOP_H),
        "retail_text_popularity": _text_popularity,
        "popularity_listing_positions": lambda s, d: R.listing_positions(R.product_popularity(_purchases(s, d))),
        "retail_report_top": _retail_report(None, TOP_H),
        "retail_report_listing": _retail_report(COUNTRY, 0),
        "retail_rejects": _retail_rejects,
        # points and distances
        "parse_points": lambda s, d: parse_points(points_as_text(points2_view(s, d)), id_col="point_id"),
        "read_points": _points_from_text,
        "kcenter_outliers_text": _kcenter_outliers(_points_from_text, K2, Z2),
        "nearest_center": lambda s, d: nearest_center(points64_view(s, d), _label_centers(s, d)).select(
            "point_id", "nearest", F.round("distance", 9).alias("distance")),
        "kcenter_objective": lambda s, d: kcenter_objective(points64_view(s, d), _label_centers(s, d),
                                                            OBJECTIVE_Z).select(F.round("objective", 9).alias("objective")),
        # round 1
        "fft_coreset": lambda s, d: _coreset_out(_coreset(points64_view, K64, Z64)(s, d)),
        "fft_coreset_points2": lambda s, d: _coreset_out(_coreset(points2_view, K2, Z2)(s, d)),
        # round 2 pieces
        "initial_radius": _initial_radius,
        "ball_weights": _ball_weights,
        "weighted_kcenter": _weighted_kcenter(points2_view, K2, Z2, 2.0),
        "weighted_kcenter_alpha0": _weighted_kcenter(points2_view, K2, Z2, 0.0),
        "weighted_kcenter_points1": _weighted_kcenter(points1_view, K1, Z1, 2.0),
        "kcenter_objective_half": lambda s, d: kcenter_objective(
            points64_view(s, d), _label_centers(s, d), points64_view(s, d).count() // 2).select(
            F.round("objective", 9).alias("objective")),
        # composite jobs
        "kcenter_outliers_points1": _kcenter_outliers(points1_view, K1, Z1, 2.0),
        "clustering_summary_points1": _summary(points1_view, K1, Z1),
        "kcenter_outliers": _kcenter_outliers(points2_view, K2, Z2),
        "kcenter_outliers_points64": _kcenter_outliers(points64_view, K64, Z64),
        "coreset_kcenter_outliers": _weighted_kcenter(points64_view, K64, Z64, 2.0),
        "clustering_summary": _summary(points2_view, K2, Z2),
        "clustering_summary_points64": _summary(points64_view, K64, Z64),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each query (same column names)."""
    m64, m2, m1 = K64 + Z64 + 1, K2 + Z2 + 1, K1 + Z1 + 1
    cs1 = O.fft_ctes(O.POINTS1, PARTS, m1)
    unit1 = f"SELECT point_id AS idx, point_id, x, CAST(1 AS BIGINT) AS w FROM ({O.POINTS1}) u"
    cs2 = O.fft_ctes(O.POINTS2, PARTS, m2)
    cs64 = O.fft_ctes(O.POINTS64, PARTS, m64)
    unit2 = f"SELECT point_id AS idx, point_id, x, CAST(1 AS BIGINT) AS w FROM ({O.POINTS2}) u"
    lines2 = f"SELECT row_number() OVER (ORDER BY point_id) - 1 AS point_id, x FROM ({O.POINTS2}) u"
    unit_lines2 = f"SELECT point_id AS idx, point_id, x, CAST(1 AS BIGINT) AS w FROM ({lines2}) v"
    unit64 = f"SELECT point_id AS idx, point_id, x, CAST(1 AS BIGINT) AS w FROM ({O.POINTS64}) u"
    return {
        **(llm_queries.oracle_sql() if llm_queries else {}),
        "row_count": f"SELECT count(*) AS row_count FROM ({O.RETAIL}) r",
        "product_customer_pairs": O.retail_pairs(None),
        "product_customer_pairs_country": O.retail_pairs(COUNTRY),
        "pair_count": f"SELECT count(*) AS pair_count FROM ({O.retail_pairs(None)}) p",
        "pair_count_country": f"SELECT count(*) AS pair_count FROM ({O.retail_pairs(COUNTRY)}) p",
        "product_popularity": O.retail_popularity(None),
        "popularity_two_stage": O.retail_popularity(None),
        "popularity_listing": O.retail_popularity(COUNTRY) + " ORDER BY product_id",
        "top_products": O.retail_top(None, TOP_H),
        "top_products_country": O.retail_top(COUNTRY, TOP_H),
        "retail_text_popularity": (f"SELECT CAST(product_id AS VARCHAR) AS product_id, popularity "
                                   f"FROM ({O.retail_popularity(None)}) q"),
        "popularity_listing_positions": O.retail_listing(None),
        "retail_report_top": O.retail_report(None, TOP_H),
        "retail_report_listing": O.retail_report(COUNTRY, 0),
        "retail_rejects": O.retail_rejects(COUNTRY),
        "parse_points": O.parse_points_sql(),
        "read_points": lines2,
        "kcenter_outliers_text": O.greedy_centers("", unit_lines2, K2, Z2, 0.0),
        "nearest_center": O.nearest(O.POINTS64, O.LABEL_CENTERS),
        "kcenter_objective": O.objective(O.POINTS64, O.LABEL_CENTERS, OBJECTIVE_Z),
        "fft_coreset": O.fft_coreset(O.POINTS64, PARTS, m64),
        "fft_coreset_points2": O.fft_coreset(O.POINTS2, PARTS, m2),
        "initial_radius": O.initial_radius_sql(cs2, O.coreset_weighted(m2), m2),
        "ball_weights": O.ball_weights_sql(cs2, O.coreset_weighted(m2), m2, 5.0),
        "weighted_kcenter": O.greedy_centers(cs2, O.coreset_weighted(m2), K2, Z2, 2.0),
        "weighted_kcenter_alpha0": O.greedy_centers(cs2, O.coreset_weighted(m2), K2, Z2, 0.0),
        "weighted_kcenter_points1": O.greedy_centers(cs1, O.coreset_weighted(m1), K1, Z1, 2.0),
        "kcenter_objective_half": O.objective(O.POINTS64, O.LABEL_CENTERS, "(SELECT count(*) // 2 FROM embeddings)"),
        "kcenter_outliers_points1": O.greedy_centers("", unit1, K1, Z1, 2.0),
        "clustering_summary_points1": O.summary_sql(O.POINTS1, cs1, O.coreset_weighted(m1), K1, Z1, PARTS, 2.0),
        "kcenter_outliers": O.greedy_centers("", unit2, K2, Z2, 0.0),
        "kcenter_outliers_points64": O.greedy_centers("", unit64, K64, Z64, 0.0),
        "coreset_kcenter_outliers": O.greedy_centers(cs64, O.coreset_weighted(m64), K64, Z64, 2.0),
        "clustering_summary": O.summary_sql(O.POINTS2, cs2, O.coreset_weighted(m2), K2, Z2, PARTS, 2.0),
        "clustering_summary_points64": O.summary_sql(O.POINTS64, cs64, O.coreset_weighted(m64), K64, Z64,
                                                     PARTS, 2.0),
    }
