"""Exact dedup against a persistent digest index (DataFrame functions and tables only).

The index is a table of one row per distinct text, ``(digest, doc_id, batch)``, bucketed and sorted by
``digest`` (SHA-256 of the text in UTF-8 after lower-casing A-Z; null counts as empty). Its
folder outlives the session: ``open_index`` registers it again, with the number of buckets it was made with.

``ingest`` deduplicates one batch of new data and appends what is new:

1. every text is reduced to its digest within the scan; ``(doc_id, digest, row)`` is
   checkpointed, and no later step reads or moves a text;
2. equal digests are pre-aggregated, then summed up, per digest: the row with the largest id and
   the number of rows. These groups are laid out in the index's buckets (distinct digests only);
3. a sort-merge anti-join with the index leaves the new digests. The index side has no exchange,
   and the new rows are written as one sorted file a bucket;
4. every row of the batch gets its group's verdict. Groups of more than ``HOT_ROWS`` rows and more than
   1 / ``HOT_GROUPS`` of the batch, of which there can be ``HOT_GROUPS`` at most, are
   broadcast (about 6 MB as the bound); all others, small by definition, come by an equi-join.

Thus one text that makes up a third of all rows is one pre-aggregated row per task and one row of a
broadcast. Work is linear in the batch, plus one read of the index's digests.

Which row stays: the one already in the index, if the text is known; otherwise the one with
the largest id of the batch. A batch has a name: run again under the same name after a failure
or a success, it decides alike and appends nothing twice.

Results in special cases: null and empty texts are one text; a null id stays only if its
group has no other; repeated rows (same id, same text) are copies, of which exactly one stays;
other columns, whatever their names, are handed on by ``drop_copies``; an empty batch gives an empty result and
an unchanged index.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popcenter.llm.common import keep_columns, read
from popcenter.session import checkpoint, ensure_checkpoint_dir

#: Choose it so that a bucket of the full index is a few hundred MB (about 50 bytes a distinct text).
BUCKETS = 64
HOT_ROWS = 1000
HOT_GROUPS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER).cast("binary"), 256))


@dataclass(frozen=True)
class DigestIndex:
    spark: SparkSession
    table: str
    path: str
    buckets: int

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def delete(self) -> None:
        """Forget the table and remove its folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def open_index(spark: SparkSession, path: str, buckets: int = BUCKETS, id_type: str = "bigint") -> DigestIndex:
    """The index in the shared folder ``path``, made if it is not there. An index that is there keeps
    its own number of buckets (written beside its rows) and id type."""
    layout = f"{path}/_layout"
    folder = spark._jvm.org.apache.hadoop.fs.Path(layout)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        known = spark.read.schema("buckets int, id_type string").json(layout).first()
        buckets, id_type = known["buckets"], known["id_type"]
    else:
        spark.createDataFrame([(buckets, id_type)], "buckets int, id_type string").coalesce(1).write.json(layout)
    table = "digests_" + hashlib.sha256(path.encode()).hexdigest()[:20]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (digest BINARY, doc_id {id_type}, batch STRING) USING parquet "
              f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return DigestIndex(spark, table, path, buckets)


def new_digests(groups: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``groups`` whose digest the index does not hold, in the index's buckets."""
    laid_out = groups.repartition(index.buckets, "digest")
    return laid_out.hint("merge").join(index.rows().select("digest"), "digest", "left_anti")


def ingest(docs: DataFrame, index: DigestIndex, batch: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Add a batch to the index. One row per row of ``docs``: doc_id, digest, keep_id (the id of the row
    that stays), group_size (rows of the batch with that text), kept, known (the text came in an
    earlier batch)."""
    rows = checkpoint(docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("digest"),
                                  F.monotonically_increasing_id().alias("row")))
    groups = checkpoint(rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("top"),
                                                   F.count(F.lit(1)).alias("group_size")))
    fresh = new_digests(groups.select("digest", F.col("top.doc_id").alias("doc_id")), index)
    fresh.select("digest", "doc_id", F.lit(batch).alias("batch")).write.insertInto(index.table)
    index.spark.catalog.refreshTable(index.table)
    mine = F.col("batch") == F.lit(batch)
    verdicts = checkpoint(groups.repartition(index.buckets, "digest").hint("merge").join(
        index.rows().withColumnRenamed("doc_id", "keep_id"), "digest").select(
        "digest", "keep_id", "group_size", F.when(mine, F.col("top.row")).alias("keep_row"), (~mine).alias("known")))
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    hot = F.col("group_size") > max(HOT_ROWS, total / HOT_GROUPS)
    few = F.broadcast(verdicts.where(hot))  # at most HOT_GROUPS rows, see above
    decided = rows.join(few, "digest").unionByName(
        rows.join(few.select("digest"), "digest", "left_anti").join(verdicts.where(~hot), "digest"))
    return decided.select("doc_id", "digest", "keep_id", "group_size",
                          F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"), "known")


def drop_copies(docs: DataFrame, index: DigestIndex, batch: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents of a batch whose text is new, one of each, with all their columns; the index
    has grown by them. Only the documents that stay are joined to their texts."""
    stay = ingest(docs, index, batch, text, doc_id).where("kept").select(
        F.col("doc_id").alias("_keep_id"), F.col("digest").alias("_keep_digest"))
    marked = docs.select(*keep_columns(docs, "_digest"), digest(F.col(text)).alias("_digest"))
    same = (F.col("_digest") == F.col("_keep_digest")) & F.col(doc_id).eqNullSafe(F.col("_keep_id"))
    return marked.join(stay, same, "left_semi").dropDuplicates(["_digest"]).drop("_digest")


def op12_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as the first batch of a new index."""
    index = open_index(spark, f"{ensure_checkpoint_dir(spark)}/digests-{uuid.uuid4()}")
    out = ingest(read(spark, sf_dir, "documents"), index, "documents")
    index.delete()  # the result reads checkpoints
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
