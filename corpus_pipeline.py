"""A training-corpus pipeline over the table ``documents``: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet into the shared checkpoint folder and reads it again as the next stage's input, so a
lost executor costs one stage's tasks at most and no stage's plan grows with those before it.
All stages but the last return the columns of ``documents``; the last adds ``shard`` and ``slot``.

Results in special cases: an empty table gives an empty result; rows with nulls are judged like empty texts (each
stage's docstring has the details); of repeated rows and of copies without an id the near-duplicate stage keeps
one; texts without words are kept by it; the mix may repeat a document, as its targets ask. The stages' folders stay
below the checkpoint directory, as the result is read from the last one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from popcenter.llm.common import read
from popcenter.llm.decontamination import drop_leaks
from popcenter.llm.mixing import mix_documents
from popcenter.llm.neardup import drop_near_duplicates
from popcenter.llm.quality import keep_good
from popcenter.llm.sharding import shard_documents
from popcenter.session import ensure_checkpoint_dir

STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_documents),
    ("sharding", shard_documents),
]

#: The classifier and the sketches have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
