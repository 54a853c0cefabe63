"""Substring dedup: seed and extend on winnowed anchors, exact for windows of ``WINDOW`` words.

A word is removed if a window of ``WINDOW`` words around it starts at any other place too, in
another document or the same. Windows are judged on the input alone.

Seeds: each window of ``WINDOW`` words has an anchor, the first of its GRAM-word sequences with
the smallest hash. The anchor depends on the window's words only, so equal windows have equal
anchors at equal offsets. A run of windows with one anchor (a seed) covers the text around it.

1. Seeds whose anchor hash is found once cannot hold a repeat. The others are joined to their
   anchors and written to the checkpoint folder.
2. Extension of a whole seed: seeds are grouped by (anchor, hash of all words that the run of
   windows covers). If two seeds agree there, the match extends both ways over the whole run,
   and all its windows are repeated. Copies of any number meet in a pre-aggregated count.
3. Extension of parts: where seeds of one anchor differ in what they cover (a repeat begins or
   ends there), one seed of each kind has its text read again and its windows listed; a window
   found in two kinds, or in a kind that repeats, is repeated. No pairs of seeds are listed.
4. The repeated windows of a document, joined into maximal spans, come to its text.

Sequences are compared by hashes: 128 bits for windows and 128 for seeds.

How it scales: all joins and groups are on hashes and linear in the text: about one seed for
fifteen words, pre-aggregated before the shuffle, and windows only at the ends of repeats. Whole
texts are shuffled by document for steps 3 and 4. No group is gathered.

Results in special cases: null and empty texts have no words (kept_sha256 is that of no bytes);
shorter texts than a window lose nothing; repeated rows repeat each other, so texts of a window
or more lose all their words; a null doc_id is a document like any other; an empty table stays
empty; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from popcenter.llm.common import read
from popcenter.llm.text import (Grams, U, buffer, list_array, mix, not_space, ranges, signed, slices, word_hashes,
                                word_spans)
from popcenter.session import checkpoint

WINDOW = 35
GRAM = 8


class Seeds:
    """Seeds of a slice: place of the anchor, its hash, first and last window (places of words)."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, window: int, gram: int):
        starts, ends, self.first = word_spans(buf, offs, not_space())
        words = word_hashes(buf, starts, ends)
        n = np.diff(self.first)
        self.grams, self.check = Grams(words, 1), Grams(words, 2)
        grams = max(0, len(words) - gram + 1)
        value = self.grams.at(np.arange(grams), gram)
        place = np.arange(grams)
        span, step = window - gram + 1, 1  # grams in a window
        while step < span:  # the smallest of twice as many grams, the first of equals
            step2 = min(step, span - step)
            a, b = value[:-step2] if step2 < len(value) else value[:0], value[step2:]
            later = b < a
            place = np.where(later, place[step2:], place[:len(a)])
            value = np.where(later, b, a)
            step += step2
        count = np.maximum(n - window + 1, 0)
        begin = ranges(self.first[:-1], count)
        owner = place[begin]
        new = np.ones(len(begin), bool)
        doc = np.repeat(np.arange(len(n)), count)
        new[1:] = (np.diff(owner) != 0) | (np.diff(doc) != 0)
        at = np.flatnonzero(new)
        self.doc, self.place = doc[at], owner[at]
        self.low, self.high = begin[at], begin[np.append(at[1:], len(begin)) - 1] if len(at) else begin
        self.anchor = self.grams.at(self.place, gram)

    def context(self, window: int) -> np.ndarray:
        """Hash of all words that a seed's windows cover, and of the anchor's offset in them."""
        h = self.check.at(self.low, self.high - self.low + window)
        return mix(h ^ mix((self.place - self.low).astype(U) + U(1)))


def anchors_of(window: int, gram: int):
    """A column function: the anchor hash of each seed of a text."""

    @arrow_udf("array<bigint>")
    def anchors(text: pa.Array) -> pa.Array:
        buf, offs = buffer(text)
        out, counts = [np.empty(0, U)], [np.empty(0, np.int64)]
        for i, j in slices(offs):
            s = Seeds(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], window, gram)
            out.append(s.anchor)
            counts.append(np.bincount(s.doc, minlength=j - i))
        return list_array(signed(np.concatenate(out)), np.concatenate(counts))

    return anchors


def seeds_of(window: int, gram: int):
    """A column function: anchor, context, first and last window of each seed of a text."""

    @arrow_udf("array<struct<anchor:bigint,context:bigint,low:int,high:int>>")
    def seeds(text: pa.Array) -> pa.Array:
        buf, offs = buffer(text)
        cols, counts = [[], [], [], []], [np.empty(0, np.int64)]
        for i, j in slices(offs):
            s = Seeds(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], window, gram)
            for c, x in zip(cols, (s.anchor, s.context(window), s.low - s.first[s.doc], s.high - s.first[s.doc])):
                c.append(x)
            counts.append(np.bincount(s.doc, minlength=j - i))
        cat = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
        rows = pa.StructArray.from_arrays(
            [signed(cat(cols[0], U)), signed(cat(cols[1], U)),
             *[pa.array(cat(c, np.int64).astype(np.int32)) for c in cols[2:]]], ["anchor", "context", "low", "high"])
        return list_array(rows, np.concatenate(counts))

    return seeds


def windows_of(window: int):
    """A column function of (text, first windows, last windows): two hashes and the place of
    every window in the given runs."""

    @arrow_udf("array<struct<h1:bigint,h2:bigint,start:int,run:int>>")
    def windows(text: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
        buf, offs = buffer(text)
        runs = np.concatenate([[0], np.cumsum(low.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        lows = low.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        highs = high.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        h1, h2, start, run, counts = [], [], [], [], [np.empty(0, np.int64)]
        for i, j in slices(offs):
            b, o = buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            s, e, first = word_spans(b, o, not_space())
            words = word_hashes(b, s, e)
            own = np.repeat(np.arange(j - i), np.diff(runs[i:j + 1]))
            lo, size = lows[runs[i]:runs[j]], highs[runs[i]:runs[j]] - lows[runs[i]:runs[j]] + 1
            at, who = ranges(lo, size), np.repeat(np.arange(len(own)), size)
            h1.append(Grams(words, 1).at(at + first[own[who]], window))
            h2.append(Grams(words, 2).at(at + first[own[who]], window))
            start.append(at)
            run.append(who - (runs[i:j] - runs[i])[own[who]])
            counts.append(np.bincount(own[who], minlength=j - i))
        cat = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
        rows = pa.StructArray.from_arrays(
            [signed(cat(h1, U)), signed(cat(h2, U)), *[pa.array(cat(c, np.int64).astype(np.int32)) for c in (start, run)]],
            ["h1", "h2", "start", "run"])
        return list_array(rows, np.concatenate(counts))

    return windows


def remover(window: int):
    """A column function of (text, first windows, last windows): word counts and the text left."""

    @arrow_udf("struct<n_words:bigint,n_removed:bigint,kept:string>")
    def remove(text: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
        buf, offs = buffer(text)
        runs = np.concatenate([[0], np.cumsum(low.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        lows = low.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        highs = high.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        n_words, n_removed, kept = [], [], []
        for i, j in slices(offs):
            b, o = buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            s, e, first = word_spans(b, o, not_space())
            own = first[np.repeat(np.arange(j - i), np.diff(runs[i:j + 1]))]
            edge = np.zeros(len(s) + 1, np.int64)
            np.add.at(edge, own + lows[runs[i]:runs[j]], 1)
            np.add.at(edge, own + highs[runs[i]:runs[j]] + window, -1)
            stays = np.cumsum(edge[:-1]) == 0
            left = np.concatenate([[0], np.cumsum(stays)])[first]
            n_words.append(np.diff(first))
            n_removed.append(np.diff(first) - np.diff(left))
            # the words that stay, each with one space behind it, then cut by document
            s, size = s[stays], (e - s)[stays] + 1
            chars = np.concatenate([b, np.array([0x20], np.uint8)])[np.minimum(ranges(s, size), len(b))] if len(s) else b[:0]
            stop = np.cumsum(size)
            chars[stop - 1] = 0x20
            cut = np.concatenate([[0], stop])[left]
            data = chars.tobytes()
            kept += [data[cut[d]:max(cut[d], cut[d + 1] - 1)] for d in range(j - i)]
        cat = lambda x: np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(cat(n_words)), pa.array(cat(n_removed)), pa.array(kept, pa.binary()).cast(pa.string())],
            ["n_words", "n_removed", "kept"])

    return remove


def repeated_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, text_hash, low, high: runs of repeated windows, as numbers of their first words."""
    base = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    anchors = base.select(F.explode(anchors_of(window, gram)("text")).alias("r_anchor"))
    # written out, so that the join's sides are plain shuffles and Spark can split a hot anchor
    again = checkpoint(anchors.groupBy("r_anchor").agg(F.count("*").alias("c")).where(F.col("c") > 1).select("r_anchor"))
    seeds = base.select("doc_id", "text_hash", F.explode(seeds_of(window, gram)("text")).alias("s")).select(
        "doc_id", "text_hash", "s.*")
    seeds = checkpoint(seeds.join(again, F.col("anchor") == F.col("r_anchor"), "left_semi"))

    kinds = checkpoint(seeds.groupBy("anchor", "context").agg(
        F.count("*").alias("c"), F.min(F.struct("doc_id", "text_hash", "low", "high")).alias("one")))
    whole = kinds.where(F.col("c") > 1).select(F.col("anchor").alias("w_anchor"), F.col("context").alias("w_context"))
    full = seeds.join(whole, (F.col("anchor") == F.col("w_anchor")) & (F.col("context") == F.col("w_context")), "left_semi") \
        .select("doc_id", "text_hash", "low", "high")

    mixed = kinds.groupBy(F.col("anchor").alias("m_anchor")).agg(F.count("*").alias("k")).where(F.col("k") > 1).select("m_anchor")
    ask = kinds.join(mixed, F.col("anchor") == F.col("m_anchor"), "left_semi").groupBy(
        F.col("one.doc_id").alias("a_id"), F.col("one.text_hash").alias("a_hash")).agg(
        F.collect_list(F.struct("one.low", "one.high", (F.col("c") > 1).alias("whole"))).alias("runs"))
    same = F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("text_hash") == F.col("a_hash"))
    # equal rows share their id and text: one of them lists the windows
    texts = base.join(ask, same).groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"), F.first("runs").alias("runs"))
    listed = texts.select("doc_id", "text_hash", "runs", F.explode(
        windows_of(window)(F.col("text"), F.col("runs.low"), F.col("runs.high"))).alias("w")).select(
        "doc_id", "text_hash", "w.h1", "w.h2", "w.start", F.get("runs.whole", F.col("w.run")).alias("whole"))
    listed = checkpoint(listed)
    found = listed.groupBy(F.col("h1").alias("f1"), F.col("h2").alias("f2")).agg(
        F.count("*").alias("c"), F.max("whole").alias("w")).where((F.col("c") > 1) | F.col("w")).select("f1", "f2")
    parts = listed.where(~F.col("whole")).join(found, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")), "left_semi") \
        .select("doc_id", "text_hash", F.col("start").alias("low"), F.col("start").alias("high"))
    return full.unionByName(parts)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one space) of every row."""
    if not 1 <= gram <= window:
        raise ValueError("an anchor has 1 to `window` words")
    runs = repeated_runs(docs, window, gram).groupBy(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash")).agg(
        F.collect_list(F.struct("low", "high")).alias("runs"))
    base = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash"))
    none = F.array().cast("array<struct<low:int,high:int>>")
    joined = base.join(runs, same, "left").withColumn("runs", F.coalesce("runs", none))
    return joined.select("doc_id", remover(window)(F.col("text"), F.col("runs.low"), F.col("runs.high")).alias("r")) \
        .select("doc_id", "r.*")


def op5_substrings(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
