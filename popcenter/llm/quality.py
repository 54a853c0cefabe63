"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates, scored as sparse dot products.

Features of a text are its words and word pairs, hashed into ``2 ** BITS`` slots; letters and
digits form words and each other ASCII sign is a word of its own. A pair of equal words is the
same feature for every word ("a word twice"). A feature's value is its count over the square
root of the number of all n-grams. Nothing but the text is read: no label, language, source or id.

Training rows: labelled documents whose crc32(doc_id as text) mod 3 is not 1. A seeded hash of
the id picks about ``MAX_ROWS`` of them at most (the documented bound of the sample), so the
sample's ids are small enough to broadcast whatever the corpus holds. The sample is dealt into
``SHARDS`` groups by another hash; each is one FTRL run and the weights are averaged, so the
model does not depend on the cluster. Scoring reads each whole text once, with no shuffle.

Results in special cases: null and empty texts have the bias as their only feature; labels
without a document, with a null label or given more than once with different values are not
learnt from; without usable labels every score is 0.5; repeated rows score alike.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from popcenter.llm.common import read, unit
from popcenter.llm.text import Grams, buffer, slices, word_hashes, word_spans

BITS = 18
MAX_ROWS = 16_000
SHARDS = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1


def features(buf: np.ndarray, offs: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams, document after document, and the first of each document."""
    sign = np.zeros(256, bool)
    sign[0x21:0x30] = sign[0x3A:0x41] = sign[0x5B:0x61] = sign[0x7B:0x7F] = True
    inside = np.arange(256) >= 0x30
    inside &= ~sign
    inside[0x7F] = False
    starts, ends, first = word_spans(buf, offs, inside, sign)
    w = word_hashes(buf, starts, ends)
    n = np.diff(first)
    last = first[1:][n > 0] - 1  # a document's last word begins no pair
    begins = np.ones(len(w), bool)
    begins[last] = False
    pairs = np.flatnonzero(begins)
    two = Grams(w).at(pairs, 2)
    two[w[pairs] == w[pairs + 1]] = 1
    slots = np.empty(len(w) + len(pairs), np.int64)
    # words first, then pairs, within each document
    doc_w = np.repeat(np.arange(len(n)), n)
    n_pairs = np.maximum(n - 1, 0)
    doc_p = np.repeat(np.arange(len(n)), n_pairs)
    before_pairs = np.cumsum(n_pairs) - n_pairs
    shift = np.uint64(64 - bits)
    slots[np.arange(len(w)) + before_pairs[doc_w]] = (w >> shift).astype(np.int64)
    slots[np.arange(len(pairs)) + first[1:][doc_p]] = (two >> shift).astype(np.int64)
    return slots, np.concatenate([[0], np.cumsum(n + n_pairs)])


def ftrl(texts: pa.Array, labels: np.ndarray, epochs: int = EPOCHS, bits: int = BITS) -> np.ndarray:
    """Weights (one per slot, the bias last) after FTRL-proximal over the rows in order."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    buf, offs = buffer(texts)
    rows = []
    for i, j in slices(offs):
        slots, at = features(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], bits)
        for d in range(j - i):
            idx, count = np.unique(slots[at[d]:at[d + 1]], return_counts=True)
            total = max(1, at[d + 1] - at[d])
            rows.append((np.append(idx, 1 << bits), np.append(count / np.sqrt(total), 1.0)))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(epochs):
        for (idx, x), y in zip(rows, labels):
            zi, ni = z[idx], n[idx]
            w = weights(zi, ni)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            z[idx] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[idx] = ni + g * g
    return weights(z, n)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, shards: int = SHARDS,
          bits: int = BITS) -> np.ndarray:
    """The model: one weight per slot and the bias."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).where(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("y2")) \
        .where(F.col("y") == F.col("y2")).select(F.col("doc_id").alias("label_id"), F.col("y").cast("double"))
    rows = usable.count()
    sample = usable.where(unit(3, F.col("label_id")) < max_rows / max(rows, 1))
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")) \
        .withColumn("u", unit(5, F.col("doc_id"))).withColumn("shard", F.floor(F.col("u") * shards).cast("int"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["u", "text"], na_position="first")
        w = ftrl(pa.array(pdf["text"].tolist(), pa.large_string()), pdf["y"].to_numpy(), bits=bits)
        return pd.DataFrame({"w": [w.astype(np.float64).tobytes()]})

    found = picked.groupBy("shard").applyInPandas(fit, "w binary").collect()  # at most `shards` rows
    if not found:
        return np.zeros((1 << bits) + 1)
    return np.mean([np.frombuffer(bytes(r["w"]), np.float64) for r in found], axis=0)


def scorer(model: np.ndarray, bits: int = BITS):
    """A column function: the probability that a text is good."""
    weights = model.astype(np.float32)

    @arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        buf, offs = buffer(text)
        out = np.zeros(len(text))
        for i, j in slices(offs):
            slots, at = features(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], bits)
            sums = np.concatenate([[0.0], np.cumsum(weights[slots], dtype=np.float64)])
            n = np.diff(at)
            out[i:j] = (sums[at[1:]] - sums[at[:-1]]) / np.sqrt(np.maximum(n, 1))
        return pa.array(1 / (1 + np.exp(-np.clip(out + float(model[-1]), -35, 35))))

    return score


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    score = scorer(train(docs, read(spark, sf_dir, "labels")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), score("text").alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the classifier calls good. The model is trained on the
    labelled rows of the table ``documents``, the scores are those of ``docs``."""
    score = scorer(train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))
    return docs.where(score("text") >= 0.5)
