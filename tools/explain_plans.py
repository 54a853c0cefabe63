"""Write PLANS.md: physical plans of the headline operators at one scale factor.

Usage: python tools/explain_plans.py [sf_dir]   (default /root/testdata/sf0.1)
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")
import numpy as np  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from popcenter.operators import coreset as C  # noqa: E402
from popcenter.operators import kcenter as K  # noqa: E402
from popcenter.operators import retail as R  # noqa: E402
from popcenter.operators.objective import nearest_center  # noqa: E402
from popcenter.operators.partitioning import assign_parts  # noqa: E402
from popcenter.plans.kcenter import unit_weighted  # noqa: E402
from popcenter.session import BucketedTable, local_session  # noqa: E402
from popcenter.sources import points64_view, retail_view  # noqa: E402


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    view = retail_view(spark, sf, purchases_only=True)
    points = points64_view(spark, sf)
    layout = K.lay_out(unit_weighted(points).select("idx", "x", "w"), points.count(), 64, strips=3)
    layout.tiles.count(), layout.units.count()
    bits = K.cover(layout.tiles, None, 1, {0: (np.zeros(64), 1.0)}).persist()
    bits.count()
    pts = assign_parts(points, 8).select("part", "point_id", "x")
    packed = pts.sortWithinPartitions("part", "point_id").mapInArrow(C._packer(C.TILE), "part int, tile long, ids binary, x binary")
    tiles = BucketedTable(packed.repartition(8, "tile"), "tile", 8)
    start = tiles.df.groupBy("tile").applyInArrow(lambda key, t: C._applier([])(key, t, t.slice(0, 0)), C._STATE)
    state = BucketedTable(start, "tile", 8)
    applied = tiles.df.groupBy("tile").cogroup(state.df.groupBy("tile")).applyInArrow(C._applier([]), C._STATE)
    label_centers = spark.read.parquet(f"{sf}/embeddings.parquet").groupBy("label").agg(
        F.min_by(F.col("embedding").cast("array<double>"), "vec_id").alias("x")).select(
        F.col("label").alias("step"), "x")
    shown = [
        ("Top-10 products of one country (T1 over A3, F1, F2)",
         R.top_products(R.product_popularity(view, "NATION_1"), 10)),
        ("Two-stage popularity (A2)", R.popularity_two_stage(view)),
        ("State of an FFT traversal (A4): points and state in the same buckets", applied),
        ("Candidates of an FFT pass (A4): cut in the task",
         C._candidates(tiles.df, state.df, 9, C.CANDIDATES, C.TILE_TOP, 8, [])),
        ("Cover state of a greedy step (J3, F7, A9): bitmaps by tile", K.cover(layout.tiles, bits, 1, {0: (np.ones(64), 1.0)})),
        ("Ball weights of a greedy step (A6/A7): units read where they lie, partial sums to their tiles",
         K.scored(layout, bits, 1, {0: 1.0})),
        ("Nearest center (J2)", nearest_center(points64_view(spark, sf), label_centers)),
    ]
    out = ["# PLANS", "", f"Physical plans (`explain(\"formatted\")`, before execution) at `{sf}`,",
           "generated by `python tools/explain_plans.py`. Cached inputs are materialized first, as in",
           "the jobs themselves. At this size AQE broadcasts the small join sides after checking their",
           "real sizes; at scale the same size check picks sort-merge joins.", ""]
    for title, df in shown:
        out += [f"## {title}", "", "```", plan(df).strip(), "```", ""]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(out))
    tiles.drop()
    state.drop()
    spark.stop()


if __name__ == "__main__":
    main()
