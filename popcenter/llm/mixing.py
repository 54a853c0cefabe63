"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Sources in code point order (null last) weigh 3, 1, 2, repeating, and share ``share`` times
all sizes; a target stops at twice its source's size and the excess goes to the others by
weight. The common level L of that water-filling, target = min(2 * size, L * weight), is the
largest solution of the lines that hold when the k sources of smallest 2 * size / weight are full.

A document's key is -ln(u) / w for a seeded hash u and its quality weight w; ascending keys
are an Efraimidis-Spirakis order. A source takes floor(target / size) complete epochs of all
its documents, then documents in key order up to the remaining budget: a document is taken if
its middle word lies within the budget, so the total misses the target by half a document at most.

How it scales: rows are written once with their size and key, and judged on these alone. Prefix sums within a
source are summed over cells of the key's order first, then within a cell; cells have even numbers of rows for any weights, so no window
holds a whole source. The verdicts are joined to the whole rows by a row number: these are shuffled once.

Quality weights are a column of the caller's. The query weighs documents that the labels call good
2, bad ones 0.5, all others 1; the pipeline stage weighs by the variety of a text's words.

Results in special cases: null text has size 0; a source of size 0 has target 0; null sources
are one source, the last; equal rows are interchangeable; a null or non-positive weight counts
as 1; input columns with the names of the added ones are replaced; an empty table stays empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from popcenter.llm.common import cell_count, keep_columns, let, named, read, unit, word_count, words
from popcenter.session import scratch_folder

ADDED = ("size", "source_size", "target", "epochs", "selected", "taken")


def targets(per_source: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
            most: float = 2.0) -> DataFrame:
    """src, source_size, target from (src, source_size), one row per source."""
    ranked = per_source.withColumn("i", F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())))
    ranked = ranked.withColumn("w", F.get(F.array(*[F.lit(float(w)) for w in weights]),
                                          (F.col("i") - 1) % len(weights)))
    cap = F.col("source_size") * most
    order = Window.orderBy(cap / F.col("w"), "i")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - cap
    open_w = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = ranked.withColumn("line", (F.sum("source_size").over(everything) * share - filled) / open_w) \
        .withColumn("level", F.max("line").over(everything))
    return level.select("src", "source_size",
                        F.least(cap, F.greatest(F.lit(0.0), F.col("level") * F.col("w"))).alias("target"))


BORDERS = 1000


def cells_by_rank(rows: DataFrame) -> DataFrame:
    """``rows`` with ``cell``: about as many as ``cell_count`` says, in the order of ``key`` and of even sizes
    whatever the weights. A quantile sketch cuts the keys at ``BORDERS`` equal shares of the rows; within a share the
    key is cut evenly, and beyond the last border, where keys fall off exponentially, by that law."""
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(
        "key", F.array(*[F.lit(i / BORDERS) for i in range(1, BORDERS)]), F.lit(10 * BORDERS)).alias("q"),
        F.min("key").alias("lo")).first()
    if not stats["n"]:
        return rows.withColumn("cell", F.lit(0).cast("long"))
    inner = -(-cell_count(stats["n"]) // BORDERS)
    if inner == 1:  # every border would be a cell: take as many of them as there are to be cells
        wanted = cell_count(stats["n"])
        borders = sorted({stats["q"][round(i * BORDERS / wanted) - 1] for i in range(1, wanted)})
    else:
        borders = sorted(set(stats["q"]))
    low = [stats["lo"], *borders]
    literal = lambda values: F.array(*[F.lit(float(v)) for v in values])
    coarse = F.size(F.filter(literal(borders), lambda b: b <= F.col("key"))) if borders else F.lit(0)
    if inner == 1:
        return rows.withColumn("cell", coarse.cast("long"))
    rate = math.log(BORDERS) / max(low[-1], 1e-300)  # of the tail, were all weights equal
    begin, width = F.get(literal(low), F.col("_c")), F.get(literal([b - a for a, b in zip(low, low[1:])] + [1.0]), F.col("_c"))
    share = F.when(F.col("_c") < len(low) - 1, (F.col("key") - begin) / width).otherwise(1 - F.exp((begin - F.col("key")) * rate))
    fine = F.least(F.floor(share * inner), F.lit(inner - 1))
    return rows.withColumn("_c", coarse).withColumn("cell", (F.col("_c") * inner + fine).cast("long")).drop("_c")


def mix(docs: DataFrame, size: Column, weight: Column, seed: int = 11, source: str = "source",
        keys: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """All rows of ``docs`` with size, source_size, target, epochs, selected and taken."""
    kept = keep_columns(docs, *ADDED)
    w = F.when(weight > 0, weight).otherwise(F.lit(1.0))
    key = -F.log(unit(seed, *[F.col(k) for k in keys])) / w
    folder = scratch_folder(docs.sparkSession, "mix")
    docs.select(F.struct(*kept).alias("row"), F.col(source).alias("src"), size.cast("long").alias("size"), key.alias("key"),
                F.monotonically_increasing_id().alias("id"), F.struct(*[F.col(k) for k in keys]).alias("tie")).write.parquet(folder)
    stored = docs.sparkSession.read.parquet(folder)  # texts are read and measured once
    rows = cells_by_rank(stored.select("src", "size", "key", "id", "tie"))
    sums = rows.groupBy("src", "cell").agg(F.sum("size").alias("s_cell"))
    goal = targets(sums.groupBy("src").agg(F.sum("s_cell").alias("source_size")))
    g = goal.select(F.col("src").alias("g_src"), "source_size", "target")
    offsets = sums.select(
        "src", "cell",
        (F.sum("s_cell").over(Window.partitionBy("src").orderBy("cell")) - F.col("s_cell")).alias("before"),
    ).join(g, F.col("src").eqNullSafe(F.col("g_src"))).select(
        F.col("src").alias("o_src"), F.col("cell").alias("o_cell"), "before", "source_size", "target")
    in_cell = Window.partitionBy("src", "cell").orderBy("key", "tie", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn("up_to", F.sum("size").over(in_cell)).join(
        offsets, F.col("src").eqNullSafe(F.col("o_src")) & (F.col("cell") == F.col("o_cell")))
    out = out.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                         .otherwise(F.lit(0)).cast("long"))
    left = F.col("target") - F.col("epochs") * F.col("source_size")
    middle = F.col("before") + F.col("up_to") - F.col("size") / 2.0
    out = out.withColumn("selected", (left > 0) & (middle <= left))
    taken = F.col("size") * (F.col("epochs") + F.col("selected").cast("long"))
    judged = out.select("id", "size", "source_size", "target", "epochs", "selected", taken.alias("taken"))
    return stored.select("id", "row").join(judged, "id").select("row.*", "size", "source_size", "target", "epochs", "selected", "taken")


def label_weights(spark, sf_dir: str) -> DataFrame:
    """label_id, weight: 2 for documents labelled good, 0.5 for bad ones."""
    labels = read(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull())
    return labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.when(F.min("quality") >= 1, F.lit(2.0)).otherwise(F.lit(0.5)).alias("label_weight"))


def op8_mix(spark, sf_dir: str) -> DataFrame:
    slim = read(spark, sf_dir, "documents").select(
        "doc_id", "source", F.md5(F.col("text").cast("binary")).alias("text_hash"), word_count(F.col("text")).alias("words"))
    weighed = slim.join(label_weights(spark, sf_dir), F.col("doc_id") == F.col("label_id"), "left")
    mixed = mix(weighed, F.col("words"), F.col("label_weight"), keys=("doc_id", "text_hash"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "source")


def variety(text: Column) -> Column:
    """A quality weight from the text alone: 0.5 plus the share of its words that are distinct."""
    return let(words(text), lambda w: F.when(F.size(w) > 0, F.size(F.array_distinct(w)) / F.size(w)).otherwise(0.0)) + 0.5


def mix_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents of the mix; one taken k times comes as k rows. Documents
    weigh by the variety of their words, which needs no join to the labels."""
    inner = {c: f"__{c}" if c.lower() in ADDED else c for c in docs.columns}  # extra columns keep their values
    hashed = docs.withColumnsRenamed(inner).withColumn("__text_hash", F.md5(F.col("text").cast("binary")))
    mixed = mix(hashed, word_count(F.col("text")), variety(F.col("text")), keys=("doc_id", "__text_hash"))
    copies = (F.col("epochs") + F.col("selected").cast("long")).cast("int")
    return mixed.select(*[named(inner[c]).alias(c) for c in docs.columns],
                        F.explode(F.array_repeat(F.lit(0), copies)).alias("__copy")).drop("__copy")
