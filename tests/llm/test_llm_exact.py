"""Exact dedup with the persistent index, against plain Python."""

import hashlib

import llm_brute as B
import pytest
from conftest import SF001

from popcenter.llm import exact
from popcenter.llm.queries import queries


def brute(rows):
    """[(doc_id, keep_id, group_size, kept, sha)], kept for the first of equal rows."""
    groups = {}
    for k, (d, t) in enumerate(rows):
        groups.setdefault(B.lower(t or ""), []).append((d is not None, d, -k))
    out = []
    for k, (d, t) in enumerate(rows):
        g = groups[B.lower(t or "")]
        top = max(g)
        out.append((d, top[1], len(g), top[2] == -k, hashlib.sha256(B.lower(t or "").encode()).hexdigest()))
    return out


ROWS = [(1, "Same Text"), (2, "same text"), (3, "SAME TEXT"), (4, None), (5, ""), (6, "ÄB"), (7, "äB"), (8, "Äb"), (9, " same text"),
        (10, "x" * 100_000), (11, "X" * 100_000), (12, "other"), (12, "other"), (None, "other"), (None, "nobody"), (None, "nobody")]


def key(r):
    return tuple((x is not None, x) for x in r)


@pytest.fixture
def index(spark, tmp_path):
    made = exact.open_index(spark, f"{tmp_path}/index", buckets=3)
    yield made
    made.delete()


def got(decisions):
    return sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["digest"].hex()) for r in decisions.collect()], key=key)


@pytest.mark.parametrize("hot", [0, 1000])
def test_one_batch(spark, index, monkeypatch, hot):
    monkeypatch.setattr(exact, "HOT_ROWS", hot)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    assert got(exact.ingest(docs, index, "a")) == sorted(brute(ROWS), key=key)
    kept = {B.lower(t or "") for _, t in ROWS}
    assert index.rows().count() == len(kept)


def test_batches_reopened_and_repeated(spark, index):
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    second = spark.createDataFrame([(9, "b"), (8, "c"), (7, "C"), (6, None)], "doc_id long, text string")
    exact.ingest(first, index, "one").collect()
    spark.sql(f"DROP TABLE {index.table}")  # a new session knows the folder only
    again = exact.open_index(spark, index.path, buckets=99)
    assert again.buckets == 3 and again.rows().count() == 2
    want = {9: (2, False, True), 8: (8, True, False), 7: (8, False, False), 6: (6, True, False)}
    for _ in range(2):  # a batch run again decides alike and adds nothing
        out = {r["doc_id"]: (r["keep_id"], r["kept"], r["known"]) for r in exact.ingest(second, again, "two").collect()}
        assert out == want and again.rows().count() == 4


def test_drop_copies_keeps_rows_whole(spark, index):
    rows = [(d, t, k, "x") for k, (d, t) in enumerate(ROWS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int, `_digest.a` string").repartition(3)
    out = exact.drop_copies(docs, index, "a")
    assert out.columns == docs.columns
    kept = out.collect()
    texts = [B.lower(r["text"] or "") for r in kept]
    assert len(texts) == len(set(texts)) == len({B.lower(t or "") for _, t in ROWS})
    top = {s: k for _, k, _, stays, s in brute(ROWS) if stays}
    assert {hashlib.sha256(t.encode()).hexdigest(): r["doc_id"] for t, r in zip(texts, kept)} == top
    assert exact.drop_copies(docs, index, "b").count() == 0


def test_empty_batch(spark, index):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact.ingest(docs, index, "a").collect() == [] and index.rows().count() == 0


def test_anti_join_reads_the_index_without_exchange(spark, index):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    groups = docs.select(exact.digest(docs["text"]).alias("digest"), "doc_id")
    plan = exact.new_digests(groups, index)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("Exchange") == 1
    assert "Bucketed: true" in plan


def test_op12(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    out = queries()["op12_digest_index"](spark, SF001).collect()
    assert sorted(map(tuple, out)) == sorted(brute(docs))
