"""The training-data queries against their DuckDB SQL on the smallest tables."""

import math

import duckdb
import pytest
from conftest import SF001

import corpus_pipeline
from popcenter.llm.queries import oracle_sql, queries

TYPES = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    value = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v
    return [cols[i] for i in order], sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries()) and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF001)
    rel = con.sql(oracle_sql()[name])
    assert sorted((c, TYPES[t]) for c, t in df.dtypes) == sorted((c, str(t)) for c, t in zip(rel.columns, rel.types))
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())
