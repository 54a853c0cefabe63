"""Quality rules with cross-document line frequency (DataFrame functions only).

Base measures are taken from every whole text. The method: lines are normalised (lower case,
white space collapsed) and hashed; for each host (the document's ``source``) the distinct
documents (``doc_id``) that hold a line are counted, copies of a text included. A
line in more than ``max(MIN_DOCS, MAX_SHARE * documents of the host)`` of them is boilerplate and
goes: ``kept_text`` is the text without such lines, all other lines as they were. A document that
loses more than ``MAX_LOST`` of its words that way is depleted and rejected.

How it scales: the line counts are distinct (host, line, document) triples, pre-aggregated before
the shuffle and counted again. A host has at most 1 / MAX_SHARE times as many boilerplate lines as
its documents have lines on average; their hashes, one row a host, are written to the checkpoint
folder, so Spark knows their size and joins them to the documents: broadcast where they are small
(texts are then not shuffled), else by a sort-merge join that AQE can split at a large host. Lines
are filtered within the row.

Repeated 3-word windows are found inside a row in n log n: each window is a long of hash bits
above and its position below, the longs are sorted, and neighbours of equal hash bits are
compared as words before they count, so a collision of hashes changes nothing.

Results in special cases: null and empty texts have no words and fail the base rule, and stay null
and empty; rejected documents have a ``kept_text`` too (``kept`` is false); null
sources are one host; repeated rows (one ``doc_id``) are one document, rows without an id are told apart by their text; all rows are judged,
repeated ones alike; columns other than doc_id, source and text are not handed on; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popcenter.llm.common import SPACE, let, read, word_count, words
from popcenter.session import ensure_checkpoint_dir

MIN_DOCS = 20
MAX_SHARE = 0.05
MAX_LOST = 0.5
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that are found twice or more in the array ``w``."""
    def packed(v):
        bits = F.length(F.bin(F.size(v).cast("long")))
        starts = F.sequence(F.lit(0), F.size(v) - 3)
        return F.sort_array(F.transform(starts, lambda i: F.call_function(
            "shiftleft", F.xxhash64(F.get(v, i), F.get(v, i + 1), F.get(v, i + 2)), bits).bitwiseOR(i.cast("long"))))

    def suspects(v, s):
        bits = F.length(F.bin(F.size(v).cast("long")))
        top = lambda x: F.call_function("shiftrightunsigned", x, bits)
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        near = F.filter(s, lambda x, i: let(top(x), lambda t: F.coalesce(
            top(F.get(s, i + 1)) == t, F.lit(False)) | F.when(i > 0, top(F.get(s, i - 1)) == t).otherwise(F.lit(False))))
        return F.transform(near, lambda x: x.bitwiseAND(low).cast("int"))

    def checked(v, at):
        rows = F.array_sort(F.transform(at, lambda p: F.struct(
            F.array(F.get(v, p), F.get(v, p + 1), F.get(v, p + 2)).alias("g"), p.alias("p"))))
        same = let(rows, lambda s: F.filter(s, lambda x, i: F.coalesce(
            F.get(s, i + 1)["g"] == x["g"], F.lit(False)) | F.when(i > 0, F.get(s, i - 1)["g"] == x["g"]).otherwise(F.lit(False))))
        cover = F.transform(same, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))
        return F.size(F.array_distinct(F.flatten(cover)))

    found = let(w, lambda v: F.when(F.size(v) < 4, F.lit(0)).otherwise(
        let(packed(v), lambda s: let(suspects(v, s), lambda at: F.when(F.size(at) == 0, F.lit(0)).otherwise(checked(v, at))))))
    return found.cast("long")


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, SPACE, " ")))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, text) with the base measures and ``lines``: the hashes of the
    lines that have a word."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    measured = F.struct(
        let(words(F.col("text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"))).alias("w"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda v: F.struct(
            (F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("n_dup_lines"),
            F.transform(v, lambda x: F.xxhash64(normal(x))).alias("lines"))).alias("l"))
    return docs.select("doc_id", "source", "text", F.explode(F.array(measured)).alias("m")).select(
        "doc_id", "source", "text", "m.w.n_words", "m.w.word_chars", "m.n_symbols", "m.l.n_dup_lines",
        "m.w.n_repeat_words", "m.l.lines")


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """host, line (hash), n_docs of the lines above the limit."""
    text = F.coalesce(F.col("text"), F.lit(""))
    document = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.lit("id"), "doc_id")).otherwise(F.xxhash64(text, F.length(text)))
    base = docs.select(F.col("source").alias("host"), document.alias("t"), text.alias("text"))
    lines = F.array_distinct(F.transform(F.split(F.col("text"), "\n"), normal))
    each = base.select("host", "t", F.explode(F.array_remove(lines, "")).alias("y")) \
        .select("host", "t", F.xxhash64("y").alias("line")).distinct()
    per_line = each.groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > min_docs)
    hosts = base.select("host", "t").distinct().groupBy(F.col("host").alias("d_host")).agg(F.count("*").alias("all_docs"))
    return per_line.join(hosts, F.col("host").eqNullSafe(F.col("d_host"))) \
        .where(F.col("n_docs") > F.col("all_docs") * max_share).select("host", "line", "n_docs")


def host_lines(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """host, boilerplate (the hashes of its frequent lines), written and read again."""
    spark = docs.sparkSession
    out = f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4()}"
    frequent_lines(docs, min_docs, max_share).groupBy("host").agg(F.collect_list("line").alias("boilerplate")).write.parquet(out)
    return spark.read.parquet(out)


def line_rules(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
               max_lost: float = MAX_LOST) -> DataFrame:
    """doc_id, source, the measures, kept_text, n_lost_words, base_failed and kept, one row per
    input row."""
    names = ("doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    joined = measures(docs).join(host_lines(docs, min_docs, max_share), F.col("source").eqNullSafe(F.col("host")), "left")
    gone = F.array_intersect("lines", F.coalesce("boilerplate", F.array().cast("array<bigint>")))
    rest = lambda g: F.array_join(F.filter(
        F.split("text", "\n"), lambda x: ~F.array_contains(g, F.xxhash64(normal(x)))), "\n")
    done = lambda text, n: F.struct(text.alias("kept_text"), n.cast("long").alias("n_lost_words"))
    cleaned = let(gone, lambda g: F.when(F.size(g) == 0, done(F.col("text"), F.lit(0))).otherwise(
        let(rest(g), lambda t: done(t, F.col("n_words") - word_count(t)))))
    out = joined.select(*names, F.explode(F.array(cleaned)).alias("c")).select(*names, "c.kept_text", "c.n_lost_words")
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return out.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("n_lost_words") <= F.col("n_words") * max_lost))


def op9_line_frequency(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                   "base_failed", "kept", "n_lost_words")
