"""Retail transaction sources.

Two ways in, same columns out::

    transaction_id, product_id, description, quantity int, invoice_date,
    unit_price double, customer_id, country

* ``read_transactions`` reads comma-separated text, one transaction line per row, with
  no header and no quoting. Fields are taken by position after a plain split on ``,``
  (a comma inside the description shifts the later fields, exactly like a positional
  split would). Trailing empty fields are dropped first, and numbers go through
  ``try_cast`` so a malformed number becomes null instead of failing the job; rows with
  a null quantity or customer never pass the popularity predicate.
* ``retail_view`` builds the same columns from the parquet star schema: quantity is
  negated for returned lines (``l_returnflag = 'R'``) so the positive-quantity predicate
  has something to drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RETAIL_COLUMNS = [
    "transaction_id",
    "product_id",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _token(tokens: Column, i: int) -> Column:
    # get() is 0-based and returns null past the end (no ANSI index error)
    return F.get(tokens, i)


def _tokens(column: str):
    return F.split(F.regexp_replace(F.col(column), ",+$", ""), ",")


def parse_transactions(lines: DataFrame, column: str = "value", keep_raw: bool = False) -> DataFrame:
    """Split text lines into the eight retail fields (all JVM-side expressions).

    With ``keep_raw`` the unparsed quantity and customer tokens are kept as
    ``raw_quantity`` / ``raw_customer`` (for strict validation and reject listings).
    """
    tokens = _tokens(column)
    raw = [F.trim(_token(tokens, 3)).alias("raw_quantity"), F.trim(_token(tokens, 6)).alias("raw_customer")]
    return lines.select(
        _token(tokens, 0).alias("transaction_id"),
        _token(tokens, 1).alias("product_id"),
        _token(tokens, 2).alias("description"),
        _try_cast(F.trim(_token(tokens, 3)), "int").alias("quantity"),
        _token(tokens, 4).alias("invoice_date"),
        _try_cast(F.trim(_token(tokens, 5)), "double").alias("unit_price"),
        _try_cast(F.trim(_token(tokens, 6)), "int").alias("customer_id"),
        _token(tokens, 7).alias("country"),
        *(raw if keep_raw else []),
    )


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Read retail text file(s) or a directory of them; every line is one row.

    Blank lines are kept as rows (their fields are null), so ``row_count`` counts
    lines the way a line-oriented reader does.
    """
    return parse_transactions(spark.read.text(path))


def retail_view(spark: SparkSession, sf_dir: str, with_description: bool = False,
                purchases_only: bool = False) -> DataFrame:
    """Retail rows from lineitem, orders, customer and nation (and part for the description).

    Join order is written small-side first: nation into customer, the result to orders on
    the customer key, and only then to lineitem on the order key, so the biggest table is
    shuffled once; Spark picks the join strategies by size. A country predicate applied
    downstream is pushed by Catalyst into the nation scan. ``purchases_only`` keeps the rows
    of positive quantity by a predicate on the stored columns, which reaches the parquet scan
    (a predicate on the signed quantity does not).
    """
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    if purchases_only:
        returned = F.col("l_returnflag") == "R"
        sold = F.col("l_returnflag").isNull() | (F.col("l_returnflag") != "R")
        lineitem = lineitem.where((sold & (F.col("l_quantity") > 0)) | (returned & (F.col("l_quantity") < 0)))

    cust_country = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", "n_name")
    order_country = orders.join(cust_country, orders.o_custkey == cust_country.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderdate", "n_name"
    )
    rows = lineitem.join(order_country, lineitem.l_orderkey == order_country.o_orderkey)
    if with_description:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
        rows = rows.join(part, rows.l_partkey == part.p_partkey)
        description = F.col("p_name")
    else:
        description = F.lit(None).cast("string")

    signed_qty = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return rows.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("l_partkey").alias("product_id"),
        description.alias("description"),
        signed_qty.alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("o_custkey").alias("customer_id"),
        F.col("n_name").alias("country"),
    )
