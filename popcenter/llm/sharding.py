"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows of each source are put in a seeded random order; row number r of n in its source has
the fractional rank (2r - 1) / (2n). All rows are sorted by it (ties: by source) and cut into
``n_shards`` runs whose lengths differ by one at most, so every shard holds the sources in the
proportions of the whole.

How it scales: a source is never ordered as one group. The random order is cut into cells of
about 1,024 rows, or the square root of all rows if that is more; cell counts give offsets, and a window numbers the rows of one
(source, cell). The place of a row in the order over all sources follows in closed form from
the row counts of the sources (how many rows of each other source have a smaller fractional
rank), so no second sort is needed: whole rows are shuffled once. Sources are the components
of a mixture: their counts, one row per source, travel as one array.

Results in special cases: null sources form a source of their own; rows that are equal in
every column are interchangeable; an empty table gives an empty result; with fewer rows than
shards some shards are empty; input columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from popcenter.llm.common import cell_count, keep_columns, read, unit


def interleave(docs: DataFrame, n_shards: int, seed: int = 7, source: str = "source",
               keys: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """All rows of ``docs`` with ``shard`` (int) and ``slot`` (long, gapless from 0)."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    kept = keep_columns(docs, "shard", "slot")
    total = docs.count()
    cells = cell_count(total)
    u = unit(seed, *[F.col(k) for k in keys])
    rows = docs.select(F.struct(*kept).alias("row"), F.col(source).alias("src"), u.alias("u"))
    rows = rows.withColumn("cell", F.floor(F.col("u") * cells).cast("int"))
    counts = docs.select(F.col(source).alias("src"), F.floor(u * cells).cast("int").alias("cell")) \
        .groupBy("src", "cell").agg(F.count("*").alias("n_cell"))
    by_source = Window.partitionBy("src")
    offsets = counts.select(
        "src", "cell",
        (F.sum("n_cell").over(by_source.orderBy("cell")) - F.col("n_cell")).alias("before"),
        F.sum("n_cell").over(by_source).alias("n"))
    per_source = counts.groupBy("src").agg(F.sum("n_cell").alias("n"))
    sizes = per_source.select(F.collect_list(F.struct("src", "n"))).scalar()

    in_cell = Window.partitionBy("src", "cell").orderBy("u", *[F.col(f"row.`{k}`") for k in keys])
    o = offsets.select(F.col("src").alias("o_src"), F.col("cell").alias("o_cell"), "before", "n")
    numbered = rows.withColumn("r", F.row_number().over(in_cell)).join(
        o, F.col("src").eqNullSafe(F.col("o_src")) & (F.col("cell") == F.col("o_cell")))
    numbered = numbered.withColumn("r", F.col("r") + F.col("before")).withColumn("sizes", sizes)
    # rows of another source (n2 of them) with (2j - 1) / (2 n2) below (or, for sources that
    # sort earlier, not above) this row's (2r - 1) / (2n); decimals, because the products pass 2^63
    smaller = F.expr("""
        aggregate(sizes, 0L, (acc, s) -> acc + CASE
          WHEN s.src <=> src THEN r - 1
          WHEN src IS NULL OR s.src < src THEN
            ((CAST(2 * r - 1 AS DECIMAL(19, 0)) * CAST(s.n AS DECIMAL(19, 0))) div n + 1) div 2
          ELSE ((CAST(2 * r - 1 AS DECIMAL(19, 0)) * CAST(s.n AS DECIMAL(19, 0)) - 1) div n + 1) div 2
        END)""")
    placed = numbered.select("row", smaller.alias("place"))
    k = F.expr(f"CAST((CAST(place AS DECIMAL(19, 0)) * {n_shards}) div {max(total, 1)} AS INT)")
    start = F.expr(f"(CAST(shard AS DECIMAL(19, 0)) * {total} + {n_shards - 1}) div {n_shards}")
    return placed.withColumn("shard", k).select("row.*", "shard", (F.col("place") - start).alias("slot"))


N_SHARDS = 40


def op3_interleaved_shards(spark, sf_dir: str) -> DataFrame:
    slim = read(spark, sf_dir, "documents").select(
        "doc_id", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    return interleave(slim, N_SHARDS, keys=("doc_id", "text_crc32")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


def shard_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with ``shard`` and ``slot``."""
    return interleave(docs, N_SHARDS)
