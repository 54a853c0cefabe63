"""Exact selection of the k-th value of a numeric column, for any k, in few scans.

1. A mergeable quantile sketch (``percentile_approx``) of the whole column gives borders of equal shares
   of the rows, whatever the distribution. Its rank error is bounded, so the wanted rank lies between two
   borders a few thousandths of the rows apart.
2. As long as more than ``LIST`` rows are expected between the two, the rows below are counted and the rows
   between are sketched again: each such scan leaves about a 400th.
3. The rows below are counted exactly, together with the rows at each value between: the k-th value.

Two scans up to some millions of rows, three up to some billions, whether the values are even, heavy-tailed or
mostly equal. A rank among the first ``END`` needs one scan: tasks keep their first ``END`` values. Each scan
is a partial aggregate; the driver gets about ``LIST`` values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
BORDERS = 1000
LIST = 10_000
END = 1000


def _sketch(c):
    return F.percentile_approx(c, F.array(*[F.lit(i / BORDERS) for i in range(1, BORDERS)]), F.lit(ACCURACY)).alias("borders")


def _narrow(lo, hi, n: int, rank: int, borders: list) -> tuple:
    """Values around a rank of n rows in [lo, hi], and about how many rows lie between them."""
    slack = 3 / ACCURACY
    share = (rank + 0.5) / n
    first = max(0, int((share - slack) * BORDERS))
    last = min(BORDERS, int((share + slack) * BORDERS) + 1)
    below = lo if first == 0 else borders[first - 1]
    above = hi if last == BORDERS else borders[last - 1]
    if isinstance(lo, int):  # the sketch keeps doubles: whole numbers beyond 2^53 are rounded
        below, above = max(lo, below - (abs(below) >> 51)), min(hi, above + (abs(above) >> 51))
    return below, above, n * (last - first) / BORDERS


def kth_value(df: DataFrame, column: str, k: int, largest: bool = False):
    """The ``k``-th (0-based) smallest, or largest, value of ``column``, or None if there are at
    most ``k`` rows. The column has no nulls. ``df`` is read a few times: give it a checkpointed frame."""
    c = F.col(column)
    if k < END:
        row = df.select(c).orderBy(c.desc() if largest else c.asc()).offset(k).limit(1).first()
        return row[0] if row else None
    row = df.agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"), _sketch(c)).first()
    n, least, most = row["n"], row["lo"], row["hi"]
    if n <= k:
        return None
    rank = n - 1 - k if largest else k
    lo, hi, rows = _narrow(least, most, n, rank, row["borders"])
    while lo < hi and rows > LIST:
        # the two ends may each have any number of rows: they are counted apart
        inside = (c > F.lit(lo)) & (c < F.lit(hi))
        row = df.agg(F.count_if(c < F.lit(lo)).alias("below"), F.count_if(c == F.lit(lo)).alias("first"),
                     F.count_if(inside).alias("n"), F.count_if(c == F.lit(hi)).alias("last"), _sketch(F.when(inside, c)),
                     F.min(F.when(inside, c)).alias("lo"), F.max(F.when(inside, c)).alias("hi")).first()
        at = rank - row["below"]
        if not 0 <= at < row["first"] + row["n"] + row["last"]:
            raise AssertionError("a quantile sketch exceeded its error bound")
        if at < row["first"]:
            return lo
        if at >= row["first"] + row["n"]:
            return hi
        lo, hi, rows = _narrow(row["lo"], row["hi"], row["n"], at - row["first"], row["borders"])
    if lo == hi:
        return lo
    value = F.when(c >= F.lit(lo), c)  # null: below
    counts = {r["v"]: r["n"] for r in df.where(c <= F.lit(hi)).groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()}
    at = rank - counts.pop(None, 0)
    for v in sorted(counts):
        if 0 <= at < counts[v]:
            return v
        at -= counts[v]
    raise AssertionError("a quantile sketch exceeded its error bound")
