"""Retail popularity operators.

Popularity of a product = number of distinct customers who bought a positive quantity
of it (optionally only customers of one country). Plans, as Catalyst builds them:

* distinct pairs: ``HashAggregate(partial, p, c) -> Exchange hash(p, c) -> HashAggregate``;
  rows of one product are never gathered together, only rows of one (product, customer).
* popularity: a second ``partial_count`` by product on the distinct pairs, then
  ``Exchange hash(p)`` of at most one row per product per partition. A product holding
  a third of all rows is therefore pre-aggregated before it is shuffled.
* top-H: ``TakeOrderedAndProject`` (per-partition top-H, then a merge of H rows per
  partition) up to ``HEAP`` rows; beyond that a threshold by exact selection and a range-partitioned sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popcenter.operators.selection import kth_value
from popcenter.session import checkpoint

ALL_COUNTRIES = "all"
#: Rows that a task may keep for a top-H report.
HEAP = 10_000


def row_count(rows: DataFrame) -> DataFrame:
    """Number of input rows, as a one-row DataFrame ``(row_count)``."""
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


def _qualifies(country: str | None):
    cond = (F.col("quantity") > 0) & F.col("customer_id").isNotNull() & F.col("product_id").isNotNull()
    return cond if _all(country) else cond & (F.col("country") == F.lit(country))


def qualifying_rows(rows: DataFrame, country: str | None = None) -> DataFrame:
    """Rows with ``quantity > 0`` and, unless country is None or ``"all"``, ``country = S``.

    The comparison is exact and case-sensitive. Rows whose quantity or customer did not
    parse (null) never qualify.
    """
    return rows.where(_qualifies(country))


def _all(country: str | None) -> bool:
    return country is None or country == ALL_COUNTRIES


def _faults(country: str | None):
    """Conditions (country field missing, bad quantity, bad customer) under which a positional
    parser fails on a row: with a country it looks at that field of every row first and parses
    the quantity of matching rows only; without one it parses every quantity. The customer is
    parsed where the quantity is positive. An absent, empty or non-integer field is malformed."""
    short = F.lit(False) if _all(country) else F.col("country").isNull()
    looked_at = F.lit(True) if _all(country) else F.coalesce(F.col("country") == F.lit(country), F.lit(False))
    quantity = looked_at & F.col("quantity").isNull()
    customer = looked_at & F.coalesce(F.col("quantity") > 0, F.lit(False)) & F.col("customer_id").isNull()
    return short, quantity, customer


def rejected_rows(rows: DataFrame, country: str | None = None) -> DataFrame:
    """Rows on which strict parsing fails, with the reason.

    Permissive mode drops them silently (they never qualify); this lists them with
    ``bad_country``, ``bad_quantity`` and ``bad_customer``, as one filter over the rows.
    """
    short, quantity, customer = _faults(country)
    return rows.where(short | quantity | customer).select(
        "*", short.alias("bad_country"), quantity.alias("bad_quantity"), customer.alias("bad_customer"))


def check_strict(rows: DataFrame, country: str | None = None) -> None:
    """Strict mode: raise ``ValueError`` if ``rejected_rows`` has any (one aggregation job)."""
    short, quantity, customer = _faults(country)
    row = rows.agg(*[F.count_if(c).alias(n) for c, n in ((short, "s"), (quantity, "q"), (customer, "c"))]).first()
    if row["s"] or row["q"] or row["c"]:
        raise ValueError(f"malformed rows: {row['s']} without a country field, {row['q']} quantity field(s), "
                         f"{row['c']} customer field(s) on qualifying rows")


def product_customer_pairs(rows: DataFrame, country: str | None = None) -> DataFrame:
    """Distinct ``(product_id, customer_id)`` pairs of qualifying rows."""
    return qualifying_rows(rows, country).select("product_id", "customer_id").distinct()


def pair_count(rows: DataFrame, country: str | None = None) -> DataFrame:
    """Number of distinct qualifying pairs ``(pair_count)``."""
    return product_customer_pairs(rows, country).agg(F.count(F.lit(1)).alias("pair_count"))


def product_popularity(rows: DataFrame, country: str | None = None) -> DataFrame:
    """``(product_id, popularity)``: distinct customers per product, map-side combined."""
    return popularity_of_pairs(product_customer_pairs(rows, country))


def popularity_of_pairs(pairs: DataFrame) -> DataFrame:
    """``(product_id, popularity)`` from distinct pairs."""
    return pairs.groupBy("product_id").agg(F.count(F.lit(1)).alias("popularity"))


def counted_pairs(rows: DataFrame, country: str | None = None) -> DataFrame:
    """(product_id, customer_id, qualifies, n): the distinct qualifying pairs with their numbers of rows, and one
    row without a pair for all other rows. One pass gives both the pairs and the row count; rows are
    pre-aggregated before they move, those that do not qualify to one row a task."""
    ok = F.coalesce(_qualifies(country), F.lit(False))
    return rows.groupBy(F.when(ok, F.col("product_id")).alias("product_id"), F.when(ok, F.col("customer_id")).alias("customer_id"),
                        ok.alias("qualifies")).agg(F.count(F.lit(1)).alias("n"))


def popularity_two_stage(rows: DataFrame, country: str | None = None, buckets: int | None = None) -> DataFrame:
    """Popularity computed in two explicit stages: partial counts, then their sum.

    Pairs are made distinct first. Stage 1 counts each product's customers inside ``buckets`` disjoint slices
    of customers (slice = hash of the customer id); stage 2 sums the partial counts per
    product. Every exchange has a partial aggregate below it: of the rows of one (product, customer)
    a task sends one, however many there are; of the pairs of one (product, slice) again one. One very
    popular product is spread over ``buckets`` tasks. The result equals ``product_popularity``.
    """
    return two_stage_of_pairs(product_customer_pairs(rows, country), buckets)


def two_stage_of_pairs(pairs: DataFrame, buckets: int | None = None) -> DataFrame:
    """The two stages over distinct (product, customer) pairs."""
    if buckets is None:
        setting = pairs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
        buckets = int(setting) if str(setting).isdigit() else 200
    sliced = pairs.select("product_id", F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).alias("slice"))
    partial = sliced.groupBy("product_id", "slice").agg(F.count(F.lit(1)).alias("partial_popularity"))
    return partial.groupBy("product_id").agg(F.sum("partial_popularity").cast("bigint").alias("popularity"))


def top_products(popularity: DataFrame, h: int) -> DataFrame:
    """The ``h`` most popular products ``(rank, product_id, popularity)``, for any ``h``.

    Ties in popularity are broken by ascending product id. Up to ``HEAP`` products are kept
    by each task and merged (the window sees ``h`` rows). Beyond that the popularity of the h-th product is
    found by exact selection, and only the products that reach it are sorted, over ranges, and
    numbered: no task holds ``h`` rows.
    """
    if h <= 0:
        raise ValueError(f"h must be positive for a top-H report, got {h}")
    if h > HEAP:
        counted = checkpoint(popularity)
        least = kth_value(counted, "popularity", h - 1, largest=True)
        reached = counted if least is None else counted.where(F.col("popularity") >= F.lit(least))
        return _numbered(reached.select("product_id", "popularity"), "rank", F.col("popularity").desc(), F.col("product_id").asc()).where(
            F.col("rank") <= h).select(F.col("rank").cast("int").alias("rank"), "product_id", "popularity")
    top = popularity.orderBy(F.col("popularity").desc(), F.col("product_id").asc()).limit(h)
    order = Window.orderBy(F.col("popularity").desc(), F.col("product_id").asc())
    return top.select(F.row_number().over(order).cast("int").alias("rank"), "product_id", "popularity")


def popularity_listing(popularity: DataFrame) -> DataFrame:
    """Full listing ordered by increasing product id (range-partitioned sort)."""
    return popularity.orderBy(F.col("product_id").asc())


def _numbered(rows: DataFrame, name: str, *order) -> DataFrame:
    """``rows`` with their 1-based place in ``order``. They are range-partitioned, numbered inside
    their range and shifted by the row counts of the ranges before; no task holds all rows. The ranges
    are checkpointed first, because Spark samples their borders."""
    ranged = checkpoint(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))  # one row per range
    before = counts.select("_range", (F.sum("n").over(Window.orderBy("_range")) - F.col("n")).alias("_before"))
    placed = ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return placed.join(before, "_range").select((F.col("_before") + F.col("_r")).cast("bigint").alias(name), *rows.columns)


def listing_positions(popularity: DataFrame) -> DataFrame:
    """``(position, product_id, popularity)``: the listing with its 1-based order made explicit.
    Products are compared as text."""
    by_text = popularity.select(F.col("product_id").cast("string").alias("product_id"), "popularity")
    return _numbered(by_text, "position", F.col("product_id").asc())
