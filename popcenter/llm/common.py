"""Column helpers that several operators of this package share."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Word separators of the operators that split on white space: U+0020, U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it within lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unit(seed: int, *cols: Column) -> Column:
    """A seeded uniform number in (0, 1): 52 bits of the MD5 of ``seed|col|...`` (nulls left out).
    The same at every run, on any partitioning, and in any engine that has MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def words(text: Column) -> Column:
    """The words of a text as an array, none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cell_count(rows: int) -> int:
    """Cells into which an order over ``rows`` rows is cut: of 1,024 rows, or the square root of
    ``rows`` if that is more, so that neither a cell nor the list of cells gets too long for a window."""
    return max(1, -(-rows // max(1024, math.isqrt(rows))))


def keep_columns(df: DataFrame, *added: str) -> list[Column]:
    """Columns of ``df`` that an operator hands on: all but those whose name it adds itself
    (an input column of the same name, in any letter case, gives way)."""
    taken = {a.lower() for a in added}
    return [named(c) for c in df.columns if c.lower() not in taken]


def named(column: str) -> Column:
    """A column by its whole name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
