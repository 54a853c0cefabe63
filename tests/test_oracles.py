"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import re

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


SPARK_TO_DUCK = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "array<double>": "DOUBLE[]"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["rank", "product_id", "popularity"] and len(rows) == 10


def _add_on(name):
    """Training-data queries; tests/llm has their tests."""
    return re.match(r"op\d+_", name) or name == "pipeline"


def test_every_query_has_an_oracle():
    assert {q for q in E.queries() if not _add_on(q)} <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(q for q in E.oracle_sql() if not _add_on(q)))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted((c, SPARK_TO_DUCK.get(t, t)) for c, t in df.dtypes) == \
        sorted((c, str(t)) for c, t in zip(rel.columns, rel.types))
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(rel.columns, rel.fetchall())
