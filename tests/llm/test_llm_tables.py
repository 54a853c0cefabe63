"""The registered queries over the driver's small tables, and the pipeline."""

import llm_brute as B
import pyarrow.parquet as pq
import pytest
from conftest import SF001

import corpus_pipeline
from popcenter.llm.queries import queries


@pytest.fixture(scope="module")
def table():
    return {name: pq.read_table(f"{SF001}/{name}.parquet").to_pylist()
            for name in ("documents", "benchmark", "pages", "labels")}


def rows(spark, name, *cols):
    return sorted(map(tuple, queries()[name](spark, SF001).select(*cols).collect()))


def test_op3(spark, table):
    got = queries()["op3_interleaved_shards"](spark, SF001).collect()
    size = {r["doc_id"]: (len((r["text"] or "").encode()) + 16, B.crc(r["text"])) for r in table["documents"]}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == size
    rows = [(r["doc_id"], r["doc_id"], B.crc(r["text"]), r["source"]) for r in table["documents"]]
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in got) == sorted(B.shards(rows, 40))
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


def test_op4(spark, table):
    want = B.near_duplicates([(r["doc_id"], r["text"]) for r in table["documents"]])
    assert rows(spark, "op4_near_duplicates", "doc_id", "n_shingles", "component_id", "kept") == sorted(want)


def test_op5(spark, table):
    want = B.substrings([(r["doc_id"], r["text"]) for r in table["documents"]])
    assert rows(spark, "op5_substrings", "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want)


def test_op7_held_out(spark, table):
    good = {r["doc_id"]: r["quality"] for r in table["labels"]}
    got = queries()["op7_quality"](spark, SF001).collect()
    assert len(got) == len(table["documents"])
    held = [r for r in got if r["held_out"] and r["doc_id"] in good]
    assert sum(r["predicted"] == good[r["doc_id"]] for r in held) >= 0.9 * len(held)


def test_op10(spark, table):
    want = B.leaks([(r["doc_id"], r["text"]) for r in table["documents"]], [(r["item_id"], r["text"]) for r in table["benchmark"]])
    assert rows(spark, "op10_suffix_arrays", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(want)


def test_pipeline(spark, table):
    docs, read = spark.read.parquet(f"{SF001}/documents.parquet"), set()
    source = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF001)
        if k < 4:
            assert out.columns == source.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        read.add(name)
    assert len(read) == 5 and {"shard", "slot"} <= set(docs.columns)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF001).collect())) == sorted(map(tuple, docs.collect()))


def test_pipeline_on_odd_tables(spark, tmp_path):
    """An empty table, and one of nulls and repeated rows, go through all stages."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    odd = docs.limit(20).unionByName(docs.limit(20)).unionByName(docs.selectExpr(*[f"CAST(NULL AS {t}) AS {c}" for c, t in docs.dtypes]).limit(3))
    odd.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "shard", "slot"]
    out.collect()
